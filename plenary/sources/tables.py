"""CSV, line and binary files."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plenary.functions.html import is_pdf

_CORRUPT = "_corrupt_row"
# Java names of the encodings tried, in order. MS949 covers cp949 and euc-kr.
_KOREAN = "MS949"


# Cell texts that stand for a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def missing_to_null(df: DataFrame, markers: Sequence[str] = MISSING) -> DataFrame:
    """Text cells that stand for a missing value become null."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*markers), F.col(f"`{c}`")) for c in texts})


def _csv(spark: SparkSession, paths, schema: T.StructType, encoding: str, multi_line: bool) -> DataFrame:
    rows = spark.read.csv(
        paths, schema=schema, header=True, encoding=encoding, multiLine=multi_line, escape='"', enforceSchema=True)
    return missing_to_null(rows)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header row, UTF-8 with or without a byte-order mark, and a stated schema.

    Quoted fields may hold line ends. Where none does, `multi_line=False` lets Spark split each file.
    """
    return _csv(spark, paths, schema, "UTF-8", multi_line)


def read_csv_lenient(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                     multi_line: bool = True) -> DataFrame:
    """CSV that loses rows with too many fields; rows with too few are padded with nulls."""
    with_raw = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(with_raw).option("columnPruning", False)  # a pruned parse misses surplus fields
        .csv(paths, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, multiLine=multi_line, escape='"')
    )
    return missing_to_null(rows.where(_field_count() <= len(schema.fields)).drop(_CORRUPT))


def _field_count() -> Column:
    outside_quotes = F.regexp_replace(F.col(_CORRUPT), '"[^"]*"', "")
    return F.coalesce(F.regexp_count(outside_quotes, F.lit(",")), F.lit(0)) + 1


def csv_rejects(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """(path, row, fields) of the rows that `read_csv_lenient` leaves out."""
    with_raw = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = spark.read.schema(with_raw).option("columnPruning", False).csv(
        paths, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, multiLine=multi_line, escape='"')
    # Spark refuses to read the raw row alone, so a parsed field is part of the expression, with no character of it.
    raw = F.concat(F.col(_CORRUPT), F.left(F.coalesce(F.col(f"`{schema.fields[0].name}`"), F.lit("")), F.lit(0)))
    found = rows.select(F.col("_metadata.file_path").alias("path"), raw.alias("row"), _field_count().alias("fields"))
    return found.where(F.col("fields") > len(schema.fields))


def korean_charsets(spark: SparkSession) -> None:
    """Spark 4 knows a short list of encodings; Korean code pages need the wider Java list."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")


@contextmanager
def _replacing_bad_bytes(spark: SparkSession):
    """Expressions built inside decode bad bytes to U+FFFD; by default they raise."""
    name = "spark.sql.legacy.codingErrorAction"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def csv_encodings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, encoding) of each file: UTF-8 if every line is valid UTF-8, else the Korean code page.

    Lines are tested in parallel, so a file is never held in one piece. `encoding` is null for a
    file that neither can decode.
    """
    korean_charsets(spark)
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("raw"))
    is_utf8 = F.is_valid_utf8(F.col("raw").cast("string"))
    with _replacing_bad_bytes(spark):
        decoded = F.decode("raw", _KOREAN)
        return lines.groupBy("path").agg(
            F.when(F.bool_and(is_utf8), F.lit("UTF-8"))
            .when(F.bool_and(~decoded.contains("\ufffd")), F.lit(_KOREAN)).alias("encoding")
        )


def read_csv_any_encoding(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                          multi_line: bool = True) -> DataFrame:
    """CSV files each read in the first encoding that fits; an error names the files none fits."""
    # One row per input file: the same list the reader keeps on the driver anyway.
    found = {r["path"]: r["encoding"] for r in csv_encodings(spark, paths).collect()}
    unreadable = sorted(p for p, e in found.items() if e is None)
    if unreadable:
        raise ValueError(f"no supported encoding fits: {', '.join(unreadable)}")
    parts = [
        _csv(spark, [p for p, e in found.items() if e == encoding], schema, encoding, multi_line)
        for encoding in sorted(set(found.values()))
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def file_term(path: Column) -> Column:
    """The first run of digits in a file name as the term number."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_extract(name, r"(\d+)", 1).try_cast("int")


def read_terms(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, term: str = "age",
               multi_line: bool = True) -> DataFrame:
    """All per-term files in one scan, the term taken from each file's name."""
    rows = spark.read.csv(paths, schema=schema, header=True, multiLine=multi_line, escape='"')
    return missing_to_null(rows.select("*", file_term(F.col("_metadata.file_path")).alias(term)))


def terms_present(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct terms that the CSV file names of a folder mention, in order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")
    return files.select(file_term(F.col("path")).alias("age")).where("age IS NOT NULL").distinct().orderBy("age")


def read_key_list(spark: SparkSession, path: str, column: str = "bill_id") -> DataFrame:
    schema = T.StructType([T.StructField(column, T.StringType())])
    return read_csv(spark, path, schema).select(column)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path)


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, content, is_pdf) of each file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content", is_pdf(F.col("content")).alias("is_pdf"))


def rows_to_table(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A small literal table, such as the parties or a test fixture."""
    return spark.createDataFrame(rows, schema)

