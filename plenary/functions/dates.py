"""Vote dates and class labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from plenary.functions import lexicon


def vote_date(c: Column) -> Column:
    """The first eight characters as a date; anything else gives null."""
    return F.try_to_date(F.left(c.cast("string"), F.lit(8)), "yyyyMMdd")


def vote_date_text(c: Column) -> Column:
    """The first eight characters as `yyyy-MM-dd` text; anything else is an error."""
    return F.date_format(F.to_date(F.left(c, F.lit(8)), "yyyyMMdd"), "yyyy-MM-dd")


def bucket_label(c: Column, bounds: Sequence[float] = lexicon.AGE_BOUNDS,
                 labels: Sequence[str] = lexicon.AGE_LABELS) -> Column:
    """Left-closed classes; values outside every class, and non-numbers, give null."""
    value = c.try_cast("double")
    label = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(bounds, bounds[1:], labels))):
        label = F.when((value >= low) & (value < high), F.lit(name)).otherwise(label)
    return label
