"""Row filters and the predicates behind them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from plenary.functions import lexicon
from plenary.functions.text import is_uuid_shaped, strip


def passed(df: DataFrame, result: str = "PROC_RSLT", key: str = "BILL_ID",
           values: Sequence[str] = lexicon.PASSED_RESULTS) -> DataFrame:
    return df.where(F.col(result).isin(*values) & F.col(key).isNotNull())


def of_term(df: DataFrame, term: int | str, column: str = "age") -> DataFrame:
    return df.where(F.col(column) == term)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a null in any column."""
    return df.where(reduce(or_, (F.col(c).isNull() for c in columns or df.columns)))


def title_matches(title: Column, words: Sequence[str] = lexicon.PROCEDURAL_TITLE_WORDS) -> Column:
    """True where the title holds one of the words; a null title does not."""
    pattern = "|".join(re.escape(w) for w in dict.fromkeys(words))
    return F.coalesce(title.rlike(pattern), F.lit(False))


def flag_procedural(df: DataFrame, title: str = "title", flag: str = "removed",
                    words: Sequence[str] = lexicon.PROCEDURAL_TITLE_WORDS) -> DataFrame:
    """Both halves of the split in one table: `removed` tells them apart."""
    return df.withColumn(flag, title_matches(F.col(title), words))


def not_blank(c: Column) -> Column:
    return strip(c) != ""


def is_valid_content(c: Column) -> Column:
    """Not null, and not blank, `nan` or (in any case) `none` once trimmed."""
    text = strip(c.cast("string"))
    return F.coalesce((text != "") & (text != "nan") & (F.lower(text) != "none"), F.lit(False))


def clean_content(df: DataFrame, column: str = "content") -> DataFrame:
    return df.where(is_valid_content(F.col(column)))


def is_missing_content(c: Column) -> Column:
    return c.isNull() | (c == "")


def missing_content(df: DataFrame, column: str = "content") -> DataFrame:
    return df.where(is_missing_content(F.col(column)))


def is_web_url(c: Column) -> Column:
    return F.coalesce(c.startswith("http"), F.lit(False))


def any_field(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a non-empty value in at least one of the columns."""
    return df.where(reduce(or_, (F.coalesce(F.col(c) != "", F.lit(False)) for c in columns)))


def length_between(c: Column, low: int, high: int) -> Column:
    return F.length(c).between(low, high)


def is_valid_file_id(c: Column) -> Column:
    return F.coalesce(is_uuid_shaped(c), F.lit(False))
