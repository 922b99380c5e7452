"""Session defaults, the checkpoint folder and plan-size checks."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "plenary", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and Korean code pages switched on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.legacy.javaCharsets", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a fresh one of our own in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="plenary-checkpoint-"))
    return context.getCheckpointDir()


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables a plan reads. Estimates of joins multiply their sides; this does not."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


# Below this size a shuffle is cheaper than leaving most cores idle.
SPREAD_BYTES = 1 << 30
_UNKNOWN_BYTES = 1 << 60
PART_BYTES = 16 << 20  # of a table that one task takes when it is spread


def part_count(df: DataFrame) -> int:
    """Parts for the tables a plan reads: one a core at least, and more as they grow, so that no part grows with them.

    A table whose size Spark does not know (it then states the greatest number) gets as many as a shuffle.
    """
    spark, size = df.sparkSession, input_bytes(df)
    if size >= _UNKNOWN_BYTES:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, size // PART_BYTES)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A small table spread over all cores before costly row work; a large one is returned as it is.

    Parquet is split at row groups, so a small file can arrive as one task. Large tables have row
    groups enough and are not shuffled.
    """
    if input_bytes(df) >= SPREAD_BYTES:
        return df
    return df.repartition(part_count(df), *keys)
