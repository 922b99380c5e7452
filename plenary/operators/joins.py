"""Enrichment, lookup and existence joins, all on equal keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plenary.functions.text import join_nullable, last4_key, strip, zero_fill
from plenary.operators.dedup import first_per_key
from plenary.operators.filters import not_blank
from plenary.operators.index import materialize


def attach_content(votes: DataFrame, texts: DataFrame, url: str = "BILL_URL", text_url: str = "url",
                   content: str = "content") -> DataFrame:
    """Votes with their bill text; votes without any text row are dropped.

    An empty text is kept: it stands for a page that was read and lacked the element.
    """
    right = texts.select(F.col(text_url).alias(url), content).where(F.col(content).isNotNull())
    return votes.join(right, url, "inner")


def attach_results(votes: DataFrame, bills: DataFrame, columns: Sequence[str], on: str = "bill_id",
                   content: str = "content", cleaned: str = "cleaned") -> DataFrame:
    """Per-bill results on every vote; the bill's processed text replaces the vote's raw text."""
    right = bills.select(on, F.col(content).alias(cleaned), *columns)
    return votes.drop(content).join(right, on, "left")


def fill_from_extracts(missing: DataFrame, extracts: DataFrame, term: str = "age",
                       number: str = "bill_number", reason: str = "reason", main: str = "main") -> DataFrame:
    """Bills lacking text with the extracted text of the same term, one row per bill that finds one.

    An equal number (without leading zeros) decides. Bills and extracts that find no equal number meet
    on the last four digits. The extracts of a key are joined into one text in order, and `matches`
    tells how many there are, so the result grows with the bills.
    """
    full, short = "_full", "_last4"
    plain = lambda c: F.regexp_replace(strip(c), "^0+(?=.)", "")
    keys = lambda df: [plain(F.col(number)).alias(full), last4_key(strip(F.col(number))).alias(short)]
    bills = missing.drop("content", "matches").select("*", *keys(missing))
    found = extracts.select(term, *keys(extracts), join_nullable(F.col(reason), F.col(main)).alias("_text")).where(not_blank(F.col("_text")))
    # An extract is meant for the bills of its own number if there are any, for those of its last four digits otherwise.
    numbers = bills.select(term, full).distinct().withColumn("_exact", F.lit(True))
    aimed = found.join(numbers, [term, full], "left").select(
        term, F.coalesce("_exact", F.lit(False)).alias("_exact"), F.when(F.col("_exact"), F.col(full)).otherwise(F.col(short)).alias("_key"), "_text")
    texts = materialize(aimed.where("_key IS NOT NULL").groupBy(term, "_exact", "_key").agg(
        F.array_join(F.array_sort(F.collect_list("_text")), " / ").alias("content"), F.count(F.lit(1)).alias("matches")))

    def named(exact: bool, key: str, mark: str) -> DataFrame:
        rows = texts.where(F.col("_exact") == F.lit(exact))
        return rows.select(term, F.col("_key").alias(key), F.col("content").alias(f"_content{mark}"), F.col("matches").alias(f"_matches{mark}"))

    both = bills.join(named(True, full, "1"), [term, full], "left").join(named(False, short, "2"), [term, short], "left")
    chosen = {c: F.coalesce(f"_{c}1", f"_{c}2") for c in ("content", "matches")}
    return both.withColumns(chosen).where(F.col("matches").isNotNull()).drop(full, short, "_content1", "_content2", "_matches1", "_matches2")


def key_multiplicity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys occur once, twice, …: the report to read before an m:n join."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_per_key"))
        .groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("keys"))
    )


def lookup_update(bills: DataFrame, fills: DataFrame, key: str = "bill_number", content: str = "content",
                  order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """New content where the key has some, the old content otherwise; one fill per key."""
    fills = fills.withColumn(key, F.col(key).cast("string"))
    order = order_by or [F.col(content).asc_nulls_last()]
    fill = first_per_key(fills, [key], order).select(key, F.col(content).alias("_new"))
    names = bills.columns
    return (
        bills.withColumn(key, F.col(key).cast("string")).join(fill, key, "left")
        .withColumn(content, F.coalesce("_new", content))
        .select(*names)
    )


def update_report(before: DataFrame, after: DataFrame, fills: DataFrame, key: str = "bill_number",
                  content: str = "content") -> DataFrame:
    """One row: filled before, filled after, newly filled, and fill rows whose key has a bill."""
    keys = before.select(F.col(key).cast("string").alias("_key")).distinct()
    # Fill rows are counted per key before the join, so a hot key is one row on either side.
    matched = (
        fills.groupBy(F.col(key).cast("string").alias("_key")).agg(F.count(F.lit(1)).alias("n"))
        .join(keys, "_key", "left_semi")
        .select(F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("a"), "n")
    )
    zero = F.lit(0).cast("bigint")
    old = before.agg(F.count(content).alias("b")).select("b", zero.alias("a"), zero.alias("n"))
    new = after.agg(F.count(content).alias("a")).select(zero.alias("b"), "a", zero.alias("n"))
    return (
        old.unionByName(new).unionByName(matched)
        .agg(F.sum("b").alias("filled_before"), F.sum("a").alias("filled_after"), F.sum("n").alias("matched"))
        .withColumn("newly_filled", F.col("filled_after") - F.col("filled_before"))
    )


def enrich_bills(bills: DataFrame, clusters: DataFrame, summaries: DataFrame, on: str = "bill_id") -> DataFrame:
    """Bills with their cluster columns, then their summary."""
    return bills.join(clusters, on, "left").join(summaries, on, "left")


def join_page_text(votes: DataFrame, texts: DataFrame, url: str = "BILL_URL", text_url: str = "url",
                   order_by: Sequence[str] = ()) -> DataFrame:
    """One row per trimmed bill URL, joined to text rows with the same trimmed URL."""
    bills = first_per_key(votes.withColumn(url, strip(F.col(url))), [url], order_by or [url])
    right = texts.withColumn(url, strip(F.col(text_url)))
    return bills.join(right.drop(text_url) if text_url != url else right, url)


def attach_members(votes: DataFrame, members: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Member attributes on every vote; by name, or better by (term, member id)."""
    return votes.join(members, on, "left")


def attach_bill_number(votes: DataFrame, bills: DataFrame, on: str = "bill_id", number: str = "bill_number") -> DataFrame:
    """The bill's number, as text, on every vote; null for a bill the table lacks."""
    return votes.join(bills.select(on, F.col(number).cast("string").alias(number)), on, "left")


def attach_boundary(districts: DataFrame, boundaries: DataFrame, code: str = "SGG_Code", width: int = 7) -> DataFrame:
    """District rows with the boundary of their zero-filled code; null where there is none."""
    return districts.withColumn(code, zero_fill(F.col(code), width)).join(boundaries, code, "left")


def with_key_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key).distinct(), key, "left_semi")


def with_key_not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other table lacks: unmatched bills, or members who never voted."""
    return df.join(other.select(key).distinct(), key, "left_anti")
