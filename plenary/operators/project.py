"""Column selection, renaming and casting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

VOTE_COLUMNS = ("AGE", "MONA_CD", "BILL_NAME", "BILL_NO", "BILL_ID", "RESULT_VOTE_MOD", "VOTE_DATE", "BILL_URL")

# Published column names.
VOTE_NAMES = {
    "AGE": "age", "MONA_CD": "member_id", "BILL_NAME": "title", "BILL_NO": "bill_number",
    "BILL_ID": "bill_id", "RESULT_VOTE_MOD": "result", "VOTE_DATE": "date", "BILL_URL": "url",
}
MEMBER_NAMES = {"대수": "age", "monaCode": "member_id", "이름": "name", "정당": "party",
                "선거구": "SIDO_SGG", "성별": "gender"}


def select_present(df: DataFrame, wanted: Sequence[str] = VOTE_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*(c for c in wanted if c in df.columns))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def require_columns(df: DataFrame, required: Sequence[str], source: str = "table") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise KeyError(f"{source} lacks required columns: {', '.join(missing)}")
    return df


def add_if_absent(df: DataFrame, column: str, value: str = "") -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def with_term(df: DataFrame, term: int, column: str = "age") -> DataFrame:
    return df.withColumn(column, F.lit(term))


def keep_original(df: DataFrame, column: str = "content", copy: str = "original_content") -> DataFrame:
    return df.withColumn(copy, F.col(column))


def as_text_key(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def as_number_text(df: DataFrame, column: str = "bill_number") -> DataFrame:
    """Whole-number text with missing or invalid values as `0`."""
    return df.withColumn(column, F.coalesce(F.col(column).try_cast("bigint"), F.lit(0)).cast("string"))


def as_number(df: DataFrame, column: str, kind: str = "double") -> DataFrame:
    """Numeric cast; invalid values give null."""
    return df.withColumn(column, F.col(column).try_cast(kind))
