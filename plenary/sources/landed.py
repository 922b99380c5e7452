"""Landed API pages, HTML pages and GeoJSON as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenary.functions.html import bill_content, bill_file_id, page_title
from plenary.operators.dedup import first_per_key
from plenary.operators.project import VOTE_COLUMNS, select_present

# The service names under which the API nests its rows.
BILL_SERVICE = "BILLRCP"
VOTE_SERVICE = "nojepdqqaweusdfbi"


def _rows_schema(service: str, columns: Sequence[str]) -> str:
    fields = ", ".join(f"{c}: string" for c in columns)
    return f"{service} array<struct<head: array<struct<list_total_count: int>>, row: array<struct<{fields}>>>>"


def api_rows(pages: DataFrame, service: str, columns: Sequence[str], body: str = "body") -> DataFrame:
    """Rows of landed JSON pages; pages that lack the row block, or do not parse, give none."""
    parts = F.from_json(F.col(body), _rows_schema(service, columns))[service]
    # The row block is the second part; `get` is null where there is none, and null inlines to no rows.
    return pages.select(F.inline(F.get(parts, F.lit(1))["row"]))


def page_facts(service: str, body: str = "body") -> list[Column]:
    """Of a page: whether it parses, its rows (null without a row block), and the total that it states."""
    parsed = F.from_json(F.col(body), _rows_schema(service, ("BILL_ID",)))[service]
    return [parsed.isNotNull().alias("parsed"), F.size(F.get(parsed, F.lit(1))["row"]).alias("rows"),
            F.get(F.get(parsed, F.lit(0))["head"], F.lit(0))["list_total_count"].alias("stated")]


def page_report(pages: DataFrame, service: str, body: str = "body") -> DataFrame:
    """One row: pages, those that parse, those with a row block, rows landed, and the greatest stated total.

    Fewer rows than the stated total, or pages that do not parse, tell that the landing is incomplete.
    """
    return pages.select(*page_facts(service, body)).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("parsed").alias("parsed_pages"), F.count("rows").alias("row_pages"),
        F.sum(F.coalesce("rows", F.lit(0))).alias("landed_rows"), F.max("stated").alias("stated_rows"))


def bill_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    return api_rows(pages, BILL_SERVICE, ("BILL_ID", "PROC_RSLT"), body)


def vote_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    return select_present(api_rows(pages, VOTE_SERVICE, VOTE_COLUMNS, body), VOTE_COLUMNS)


def read_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One landed response per line."""
    return spark.read.text(path).withColumnRenamed("value", "body")


def bill_texts(pages: DataFrame) -> DataFrame:
    return pages.select("url", bill_content(F.col("html")).alias("content"))


def bill_titles(pages: DataFrame) -> DataFrame:
    return pages.select("url", page_title(F.col("html")).alias("bill_title"))


def bill_files(pages: DataFrame) -> DataFrame:
    """The file id of each page that links one."""
    return pages.select("url", bill_file_id(F.col("html")).alias("file_id")).where("file_id IS NOT NULL")


def boundaries(collections: DataFrame, body: str | Column = "body", code: str = "SGG_Code", file: str | None = None,
               place: str | None = None) -> DataFrame:
    """(code, boundary) of GeoJSON features, the geometry as raw JSON; a repeated code keeps its last.

    The last one is that of the last file by the `file` column, and within a file the last by the `place` column, then
    in its collection.
    """
    schema = f"features array<struct<properties: struct<{code}: string>, geometry: string>>"
    name, at = F.lit("") if file is None else F.col(file), F.lit(0) if place is None else F.col(place)
    features = collections.select(name.alias("file"), at.alias("place"), F.from_json(F.col(body) if isinstance(body, str) else body, schema).alias("c"))
    rows = features.select("file", "place", F.posexplode("c.features").alias("position", "f")).select(
        F.col(f"f.properties.{code}").alias(code), F.col("f.geometry").alias("boundary"), "file", "place", "position")
    return first_per_key(rows, [code], [F.desc("file"), F.desc("place"), F.desc("position"), "boundary"]).drop("file", "place", "position")


def read_geojson(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Whole collections, one file each; a later path wins. Files larger than a cell are landed by lines instead."""
    files = spark.read.text(path, wholetext=True).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("file"))
    return boundaries(files, file="file")


def read_feature_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One feature per line, so files of any size are read by many tasks; a later path wins, then a later line.

    A line's place is the start of its split and its number within the task, which reads a split from front to back.
    """
    lines = spark.read.text(path).select(
        F.concat(F.lit('{"features":['), F.rtrim(F.col("value"), F.lit(", ")), F.lit("]}")).alias("body"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line")).alias("place"))
    return boundaries(lines, file="file", place="place")
