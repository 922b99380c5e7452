"""Joins, dense numbers and positions when one key is hot."""

from collections import Counter

import pytest
from pyspark.sql import functions as F, Window

from plenary.operators.aggregates import join_texts
from plenary.operators.dedup import first_per_key
from plenary.operators.index import dense_index, group_position, materialize
from plenary.session import spread


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on key 0, some null keys, the rest spread."""
    k = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 97)
    return spark.range(3000).select("id", k.cast("bigint").alias("k"))


def test_hot_key_is_split_by_adaptive_execution(spark, hot, tmp_path):
    """Both sides are stored, so the plain join of a hot key is cut into several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = materialize(hot.repartition(8).withColumn("pad", F.sha2(F.col("id").cast("string"), 256)))
        right = materialize(spark.range(97).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")))
        joined = left.join(right, "k").select("id", "k", "v", F.spark_partition_id().alias("p"))
        rows = joined.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == hot.where("k IS NOT NULL").count() and len({r["p"] for r in rows if r["k"] == 0}) > 1


def test_dense_index_matches_row_number(hot):
    expected = hot.withColumn("p", F.row_number().over(Window.orderBy("k", "id")) - 1)
    got = dense_index(hot, ["k", "id"], "p")
    assert Counter(map(tuple, got.select("id", "p").collect())) == Counter(map(tuple, expected.select("id", "p").collect()))
    assert dense_index(hot.where("id < 0"), ["id"], "p").count() == 0


def test_group_position_matches_row_number(hot):
    some = hot.where("k IS NOT NULL")
    expected = some.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    got = group_position(some, ["k"], ["id"], "p")
    assert Counter(map(tuple, got.select("id", "p").collect())) == Counter(map(tuple, expected.select("id", "p").collect()))


def test_first_rows_are_cut_before_the_shuffle(hot):
    plan = first_per_key(hot, ["k"], ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_join_texts_parts(spark):
    df = spark.createDataFrame(
        [("a", 2, "y"), ("a", 1, "x"), ("a", 3, None), ("a", 1001, "z"), ("b", 1, None), (None, 1, "lost")],
        "url string, n int, content string")
    assert sorted(map(tuple, join_texts(df, "url", "content", "n").collect())) == [("a", "x / y / z"), ("b", "")]
    parts = join_texts(df, "url", "content", "n", part=F.floor(F.col("n") / 1000))
    assert sorted(map(tuple, parts.collect())) == [("a", 0, "x / y"), ("a", 1, "z"), ("b", 0, "")]


def test_spread_leaves_large_tables_alone(spark, hot, monkeypatch):
    assert spread(hot, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("plenary.session.SPREAD_BYTES", 1)
    assert spread(hot, "id") is hot


def test_parts_of_a_spread_table_do_not_grow_with_it(spark, hot, monkeypatch):
    monkeypatch.setattr("plenary.session.PART_BYTES", 1000)
    assert spread(hot, "id").rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
