"""A ledger of landed API pages: each run reads only what has landed since, and reports sets that are not complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from plenary.sources.landed import page_facts
from plenary.sources.tables import file_term

_FILES = "file string, length bigint, modified timestamp"
_META = ("_metadata.file_path AS file", "_metadata.file_size AS length", "_metadata.file_modification_time AS modified")
_LEDGER = f"{_FILES}, service string, term int, pages bigint, parsed_pages bigint, row_pages bigint, landed_rows bigint, stated_rows int"


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, length, modified, path) of every landed file; contents are not read. `path` is what a reader takes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.selectExpr(*_META, "path")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; an empty one where none has been written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger lacks, or that have changed in size or time since they were read."""
    return files.join(ledger.select("file", "length", "modified"), ["file", "length", "modified"], "left_anti")


def read_new_pages(spark: SparkSession, folder: str, ledger: DataFrame) -> DataFrame:
    """(body, file, length, modified) of the pages in files that the ledger lacks, one page a line.

    The names of the new files come to the driver, where Spark's reader keeps such a list for any scan; no other file
    is opened.
    """
    fresh = [r["path"] for r in new_files(landed_files(spark, folder), ledger).select("path").collect()]
    if not fresh:
        return spark.createDataFrame([], f"body string, {_FILES}")
    return spark.read.text(fresh).selectExpr("value AS body", *_META)


def ledger_rows(pages: DataFrame, service: str) -> DataFrame:
    """One ledger row per file: its term, pages, pages that parse, pages with rows, rows, and the greatest stated total."""
    return pages.select("file", "length", "modified", *page_facts(service)).groupBy("file", "length", "modified").agg(
        F.lit(service).alias("service"), file_term(F.col("file")).alias("term"), F.count(F.lit(1)).alias("pages"),
        F.count_if("parsed").alias("parsed_pages"), F.count("rows").alias("row_pages"),
        F.sum(F.coalesce("rows", F.lit(0))).cast("bigint").alias("landed_rows"), F.max("stated").alias("stated_rows"))


def enter(rows: DataFrame, path: str) -> None:
    """Appends to the ledger. Do this after the run's results are written: a run that fails is then read again."""
    rows.select(*[c.split()[0] for c in _LEDGER.split(", ")]).write.mode("append").parquet(path)


def latest(ledger: DataFrame) -> DataFrame:
    """One row per file, the last that was read."""
    order = F.struct("modified", "length", "landed_rows", "stated_rows")
    names = [c for c in ledger.columns if c != "file"]
    return ledger.groupBy("file").agg(F.max_by(F.struct(*names), order).alias("_row")).select("file", "_row.*")


def set_report(ledger: DataFrame, by: Sequence[str] = ("service", "term")) -> DataFrame:
    """Files, pages, rows and the stated total per service and term, and whether the set is complete.

    A set is complete if every page parses and as many rows have landed as the pages state; without a stated total it
    is not known to be, and so is not.
    """
    sums = latest(ledger).groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), *[F.sum(c).alias(c) for c in ("pages", "parsed_pages", "row_pages", "landed_rows")],
        F.max("stated_rows").alias("stated_rows"))
    whole = (F.col("parsed_pages") == F.col("pages")) & (F.col("landed_rows") >= F.col("stated_rows"))
    return sums.withColumn("complete", F.coalesce(whole, F.lit(False)))


def incomplete_sets(ledger: DataFrame, by: Sequence[str] = ("service", "term")) -> DataFrame:
    return set_report(ledger, by).where(~F.col("complete"))
