"""Text for bills whose page had none: titles, extracted fields, fill, filter and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plenary.functions.dates import bucket_label, vote_date_text
from plenary.functions.text import format_keywords, query_param, repair_commas, split_district, split_title
from plenary.operators.filters import clean_content, flag_procedural, missing_content
from plenary.operators.joins import enrich_bills, fill_from_extracts, lookup_update
from plenary.operators.project import MEMBER_NAMES, as_text_key, rename
from plenary.operators.sets import BILL_COLUMNS, union_sources, union_terms


def titled_bills(titles: DataFrame, url: str = "url", title: str = "bill_title") -> DataFrame:
    """Bill id from the page URL, number and title from the page heading."""
    return (
        titles.withColumn("bill_id", query_param(F.col(url), "billId"))
        .withColumn("_title", split_title(F.col(title)))
        .select(*(c for c in titles.columns if c not in (url, title)), "bill_id",
                F.col("_title.bill_number").alias("bill_number"), F.col("_title.title").alias("title"))
    )


def recovered_bills(titles: DataFrame, extracts: DataFrame) -> DataFrame:
    """Bills whose text was found in their document, for all terms at once."""
    return fill_from_extracts(titled_bills(titles), extracts).select(*BILL_COLUMNS)


def merged_bills(recovered: DataFrame, published: DataFrame) -> DataFrame:
    return union_sources({"recovered": recovered, "published": published})


def still_missing(bills: DataFrame) -> DataFrame:
    """Bills without text, with procedural items flagged as removed."""
    return flag_procedural(missing_content(bills))


def repaired_lines(lines: DataFrame, fields: int = 5) -> DataFrame:
    return lines.select(repair_commas(F.col("value"), fields).alias("value"))


def filled_bills(bills: DataFrame, fills: DataFrame) -> DataFrame:
    """Missing texts filled by bill number, then rows without usable text dropped."""
    return clean_content(lookup_update(bills, fills))


def age_classes(bills: DataFrame, column: str = "age", name: str = "age_group") -> DataFrame:
    return bills.withColumn(name, bucket_label(F.col(column)))


def enriched_bills(bills: DataFrame, topics: DataFrame, summaries: DataFrame) -> DataFrame:
    """Bills with cleaned text, summary, cluster and formatted keywords."""
    clusters = topics.select("bill_id", F.col("topic").alias("cluster"),
                             F.col("topic_label").alias("cluster_keyword"), F.col("content").alias("cleaned"))
    summary = summaries.select("bill_id", F.col("content").alias("summary"))
    joined = enrich_bills(bills.select("age", "title", "bill_id", "bill_number"), clusters, summary)
    return joined.withColumn("cluster_keyword", format_keywords(F.col("cluster_keyword"))).select(
        "age", "title", "bill_id", "bill_number", "cleaned", "summary", "cluster", "cluster_keyword")


def member_table(terms: dict[int, DataFrame]) -> DataFrame:
    return rename(union_terms(terms), MEMBER_NAMES).select(
        "age", "name", "party", "SIDO_SGG", "member_id", "gender")


def district_table(members: DataFrame, column: str = "SIDO_SGG") -> DataFrame:
    parts: Column = split_district(F.col(column))
    return members.select("age", F.col(column).alias("sido_sgg"), parts.alias("_d")).select(
        "age", "sido_sgg", "_d.sido", "_d.sgg")


def vote_table(votes: DataFrame) -> DataFrame:
    """Published votes: bill id dropped, names published, date as `yyyy-MM-dd` (bad dates are errors)."""
    named = rename(votes.drop("BILL_ID"), {
        "AGE": "age", "MONA_CD": "member_id", "BILL_NO": "bill_number", "RESULT_VOTE_MOD": "result",
        "VOTE_DATE": "date"})
    return as_text_key(named, "bill_number").withColumn("date", vote_date_text(F.col("date")))
