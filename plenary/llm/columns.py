"""Keeps a caller's extra columns out of the way of an operator's own names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def shield(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The table with every other column renamed, and the way back: restore(df, *added) with the old names and order."""
    inner = [c if c in needed else f"extra{i}" for i, c in enumerate(df.columns)]
    names = df.columns

    def restore(out: DataFrame, *added: str) -> DataFrame:
        kept = [i for i, c in enumerate(names) if c not in added]
        return out.select(*[inner[i] for i in kept], *added).toDF(*[names[i] for i in kept], *added)

    return df.toDF(*inner), restore
