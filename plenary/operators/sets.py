"""Unions of per-term and per-source tables, samples and heads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plenary.operators.project import require_columns

BILL_COLUMNS = ("age", "title", "bill_id", "bill_number", "content")


def union_sources(sources: Mapping[str, DataFrame], required: Sequence[str] = BILL_COLUMNS) -> DataFrame:
    """Named tables checked for the required columns, cut to them and put together."""
    tables = [require_columns(df, required, name).select(*required) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, tables)


def union_terms(terms: Mapping[int, DataFrame], column: str = "age") -> DataFrame:
    """Per-term tables with the term as a column; a column missing in one term is null there."""
    tables = [df.withColumn(column, F.lit(term)) for term, df in terms.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def complement(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def head(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def random_rows(df: DataFrame, n: int = 3, seed: int | None = None) -> DataFrame:
    return df.orderBy(F.rand(seed)).limit(n)
