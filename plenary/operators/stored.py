"""Tables stored bucketed by key, so that joins and counts on the key need no shuffle on later runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from plenary.operators.index import materialize

BUCKET_BYTES = 256 << 20


@dataclass(frozen=True)
class Stored:
    """A table in two parts under one folder: keys of ordinary size in buckets, hot keys and null keys beside them."""

    spark: SparkSession
    name: str
    path: str
    key: str

    @property
    def even(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def hot(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/hot")

    def rows(self) -> DataFrame:
        return self.even.unionByName(self.hot)

    def forget(self) -> None:
        """Takes the table's name out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Keys with more than `rows` rows, from map-side partial counts."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(key)


def bucket_count(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for that many bytes: tables that are to meet must be given the same number, that of the largest."""
    return max(-(-size // bucket_bytes), 1)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, hot: DataFrame) -> Stored:
    """The table written once, bucketed and sorted by the key, one file a bucket.

    Args:
        hot: keys (column `key`) whose rows are too many for one bucket. They and null keys are written plainly beside
            the buckets, and adaptive execution splits them when joined. Tables that are to meet take the same keys.
    """
    spark = df.sparkSession
    df.join(hot, key, "left_anti").where(F.col(key).isNotNull()).repartition(buckets, key).write.mode("overwrite").format("parquet") \
        .bucketBy(buckets, key).sortBy(key).option("path", f"{path}/even").saveAsTable(name)
    df.join(hot, key, "left_semi").unionByName(df.where(F.col(key).isNull())).write.mode("overwrite").parquet(f"{path}/hot")
    return Stored(spark, name, path, key)


def join_stored(left: Stored, right: Stored, how: str = "left") -> DataFrame:
    """Both tables joined on their key: bucket beside bucket without an exchange, hot keys by a plain join."""
    return left.even.join(right.even, left.key, how).unionByName(left.hot.join(right.hot, left.key, how))


def counts_of_stored(table: Stored, columns: Sequence[str]) -> DataFrame:
    """Rows per key and columns, counted inside the buckets; hot keys by partial counts."""
    count = F.count(F.lit(1)).alias("n")
    return table.even.groupBy(table.key, *columns).agg(count).unionByName(table.hot.groupBy(table.key, *columns).agg(count))


def store_together(tables: dict[str, DataFrame], path: str, key: str, buckets: int, hot_rows: int = 50_000_000) -> dict[str, Stored]:
    """Several tables bucketed alike, for joins with one another; a key that is hot in one of them is kept apart in all."""
    found = [hot_keys(df, key, hot_rows) for df in tables.values()]
    hot = found[0]
    for more in found[1:]:
        hot = hot.union(more)
    hot = materialize(hot.distinct())
    return {name: write_bucketed(df, name, f"{path}/{name}", key, buckets, hot) for name, df in tables.items()}
