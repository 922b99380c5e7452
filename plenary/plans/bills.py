"""From landed votes and pages to votes with cleaned text, summary and slogan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plenary.functions.dates import vote_date
from plenary.functions.text import drop_stop_words, preprocess, split_url_cell
from plenary.operators.aggregates import join_long_texts, join_texts
from plenary.operators.dedup import distinct_values
from plenary.operators.filters import passed
from plenary.operators.index import materialize
from plenary.operators.joins import attach_content, with_key_in
from plenary.operators.project import VOTE_NAMES, rename
from plenary.operators.responses import cleaned_texts, fetched_content, slogans, summaries
from plenary.session import spread
from plenary.sources.landed import bill_rows, vote_rows


def passed_ids(id_pages: DataFrame) -> DataFrame:
    """Distinct ids of the bills passed as proposed or as amended."""
    return passed(bill_rows(id_pages)).select(F.col("BILL_ID").alias("bill_id")).distinct()


def term_votes(id_pages: DataFrame, vote_pages: DataFrame) -> DataFrame:
    """Votes on passed bills."""
    ids = passed_ids(id_pages).withColumnRenamed("bill_id", "BILL_ID")
    return with_key_in(vote_rows(vote_pages), ids, "BILL_ID")


def split_cells(votes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Votes with plain page URLs, and the (url, content) texts that `url,text` cells brought along."""
    cell = split_url_cell(F.col("BILL_URL"))
    texts = votes.select(cell.alias("cell")).distinct().select("cell.*").where("content IS NOT NULL")
    return votes.withColumn("BILL_URL", cell["url"]), texts


def urls_to_fetch(votes: DataFrame) -> DataFrame:
    """Pages to read: cells that are a URL alone; a cell with a text needs no fetch."""
    return distinct_values(votes.where(~F.col("BILL_URL").contains(",")), "BILL_URL")


def page_texts(fetches: DataFrame, given: DataFrame | None = None, cell_chars: int | None = None) -> DataFrame:
    """One text per URL: the contents of fetched pages and of `given` texts joined, the empty string where there is none.

    With `cell_chars`, a URL with more text than that comes in numbered parts (`join_long_texts`).
    """
    texts = fetched_content(fetches).select("url", "content")
    if given is not None:
        texts = texts.unionByName(given.select("url", "content"))
    if cell_chars is not None:
        return join_long_texts(texts, "url", "content", "content", cell_chars)
    return join_texts(texts, "url", "content", order_by="content")


def published_votes(votes: DataFrame) -> DataFrame:
    """Published column names and a date; an unreadable date is null."""
    return rename(votes, VOTE_NAMES).withColumn("date", vote_date(F.col("date")))


def votes_with_text(votes: DataFrame, texts: DataFrame) -> DataFrame:
    return published_votes(attach_content(votes, texts))


def unique_bills(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(bill_id, content): one row per bill that has a text, before the costly text work.

    `pairs` holds the bills' pages. A bill with several pages keeps the first by URL, which is chosen
    before the texts are touched.
    """
    read = pairs.join(texts.select(F.col("url").alias("BILL_URL")), "BILL_URL", "left_semi")
    chosen = read.groupBy(F.col("BILL_ID").alias("bill_id")).agg(F.min("BILL_URL").alias("url"))
    return chosen.join(texts, "url").select("bill_id", "content")


def preprocess_bills(bills: DataFrame, column: str = "content", stop_words: Sequence[str] = ()) -> DataFrame:
    """Cleaned text with the source text kept beside it."""
    text = preprocess(F.col(column))
    if stop_words:
        text = drop_stop_words(text, stop_words)
    return bills.withColumn("original_content", F.col(column)).withColumn(column, text)


def assemble_term(votes: DataFrame, fetches: DataFrame, summary_responses: DataFrame,
                  slogan_responses: DataFrame, stop_words: Sequence[str] = (),
                  stop_word_responses: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five stage tables of one term; write them with `sinks.write_stages`.

    Texts are read, cleaned and answered once per bill and meet the votes again only in the last join. Stage 03
    holds keys and the length of the text, which itself is in stage 02. Votes are stored, as several stages read
    them. `stop_word_responses` are the model's answers to the third cleaning step; with a column `part` they answer
    requests over CLASSIFY_CHARS characters each (`prompts.prompt_parts`) and are put together again.
    """
    votes, given = split_cells(materialize(votes))
    texts = materialize(page_texts(spread(fetches, "url"), given))
    # A vote's bill and page.
    keyed = votes.withColumn("_bill", F.coalesce("BILL_ID", F.lit("")))
    pairs = materialize(keyed.select("_bill", "BILL_ID", "BILL_URL").distinct())
    bills = preprocess_bills(unique_bills(pairs, texts), stop_words=stop_words).drop("original_content")
    if stop_word_responses is not None:
        bills = cleaned_texts(bills, stop_word_responses)
    bills = materialize(slogans(summaries(bills, summary_responses), slogan_responses))
    results = bills.select(F.coalesce("bill_id", F.lit("")).alias("_bill"), F.col("content").alias("cleaned"),
                           "summary", "card_news_content")
    read = pairs.join(texts.select(F.col("url").alias("BILL_URL")), "BILL_URL", "left_semi")
    per_page = materialize(read.select("_bill", "BILL_URL").join(results, "_bill", "left"))
    final = keyed.join(per_page, ["_bill", "BILL_URL"])
    return {
        "01_votes": votes,
        "02_page_texts": texts,
        "03_votes_with_text": votes_with_text(votes, texts.select("url", F.length("content").alias("content"))).withColumnRenamed("content", "content_chars"),
        "04_unique_bills": bills,
        "05_final": published_votes(final.drop("_bill")),
    }
