"""Dense row numbers over a whole table without gathering it into one task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from plenary.session import checkpoint_dir

_PART_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def materialize(df: DataFrame) -> DataFrame:
    """The table written to the cluster's shared checkpoint folder and read back.

    It is computed once, survives lost executors, cuts the lineage, is read column by column, and has
    its real size, by which later joins are chosen.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/plenary-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dense_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Adds 0, 1, 2, … in the order of `order_by`, which must be unique per row.

    Rows are range-partitioned and sorted, so a hot leading key is cut by the later columns. The
    numbered rows are stored: recomputing a range partitioning may move its borders, and the
    offsets below must match the rows they were counted on. Keep `df` narrow (keys only).
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = materialize(
        df.repartitionByRange(parts, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_seat", F.monotonically_increasing_id())
    )
    part = F.shiftright("_seat", _PART_BITS).cast("int")
    # One count per range partition comes to the driver: as many numbers as there are partitions.
    counts = {r[0]: r[1] for r in numbered.groupBy(part).agg(F.count(F.lit(1))).collect()}
    sizes = [counts.get(p, 0) for p in range(max(counts, default=0) + 1)]
    offsets = F.lit([0, *accumulate(sizes)][: len(sizes)]).cast("array<bigint>")
    within = F.col("_seat").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return numbered.withColumn(name, F.get(offsets, part) + within).drop("_seat")


def group_position(df: DataFrame, group: Sequence[str], order_by: Sequence[str],
                   name: str = "position") -> DataFrame:
    """1-based position within each group, for groups too large for one task's window."""
    indexed = dense_index(df, [*group, *order_by], "_index")
    starts = materialize(indexed.groupBy(*group).agg(F.min("_index").alias("_start")))
    return (
        indexed.join(starts, list(group))
        .withColumn(name, F.col("_index") - F.col("_start") + 1)
        .drop("_index", "_start")
    )
