"""Keep-first and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], n: int = 1) -> DataFrame:
    """The first `n` rows of each key in a stated order.

    Spark cuts each map task to `n` rows per key before the shuffle, so a hot key sends at most
    `n` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values, such as the URLs still to fetch."""
    return df.where(F.col(column).isNotNull()).select(column).distinct()
