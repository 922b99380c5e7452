"""Queries on the shared test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Test tables by attribute: `Tables(spark, folder).lineitem`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of `Tables` under its own name, with its oracle where SQL can say it."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        name = build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
