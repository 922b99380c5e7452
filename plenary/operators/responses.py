"""The first acceptable answer per item from a table of attempts, with its fallback.

Model and fetch results are landed tables: `responses(item_id, attempt, text, error)` and
`fetches(url, attempt, html, error)`, with attempts counted from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plenary.functions import lexicon
from plenary.functions.html import bill_content
from plenary.functions.jsons import bill_fields, json_strings
from plenary.functions.text import (
    clean_slogan, clean_text, convert_to_sentence, first_sentence, java_regex, strip, tidy)
from plenary.operators.dedup import first_per_key
from plenary.operators.filters import any_field, length_between
from plenary.operators.prompts import CLASSIFY_CHARS, text_parts


def first_accepted(items: DataFrame, attempts: DataFrame, key: str, answer: Column, accept: Column,
                   name: str, attempt: str = "attempt") -> DataFrame:
    """Adds the answer of the lowest accepted attempt of all; null where no attempt is accepted."""
    usable = attempts.select(key, attempt, answer.alias(name), accept.alias("_accept")).where("_accept")
    first = first_per_key(usable, [key], [attempt, name]).select(key, name)
    return items.join(first, key, "left")


def _clear(error: str = "error") -> Column:
    return F.col(error).isNull()


def summaries(bills: DataFrame, responses: DataFrame, key: str = "bill_id", text: str = "content",
              name: str = "summary", failure: str | Column | None = None) -> DataFrame:
    """One-line summaries; blank texts pass through, and unanswered ones keep their text.

    `failure` gives the text used instead when every attempt failed: a constant, or a column such as the
    last error of `last_errors` (the file job's variant).
    """
    answers = responses.withColumnRenamed("item_id", key)
    raw = strip(F.col("text"))
    joined = first_accepted(
        bills, answers, key, raw, F.coalesce(_clear() & (raw != ""), F.lit(False)), "_answer")
    blank = F.col(text).isNull() | (strip(F.col(text)) == "")
    fallback = F.col(text) if failure is None else failure if isinstance(failure, Column) else F.lit(failure)
    summary = F.when(blank, F.col(text)).when(
        F.col("_answer").isNotNull(), convert_to_sentence(F.col("_answer"))
    ).otherwise(fallback)
    return joined.withColumn(name, summary).drop("_answer")


def slogans(bills: DataFrame, responses: DataFrame, key: str = "bill_id", text: str = "summary",
            name: str = "card_news_content", low: int = 7, high: int = 35) -> DataFrame:
    """Slogans of 7 to 35 characters; a stock phrase without one, and a marker for empty input."""
    answers = responses.withColumnRenamed("item_id", key).withColumn("_slogan", clean_slogan(F.col("text")))
    accept = F.coalesce(_clear() & length_between(F.col("_slogan"), low, high), F.lit(False))
    joined = first_accepted(bills, answers, key, F.col("_slogan"), accept, "_answer")
    empty = F.col(text).isNull() | (F.col(text) == "")
    slogan = F.when(empty, lexicon.EMPTY_SLOGAN).otherwise(
        F.coalesce("_answer", F.lit(lexicon.DEFAULT_SLOGAN)))
    return joined.withColumn(name, slogan).drop("_answer")


def last_errors(items: DataFrame, responses: DataFrame, key: str, name: str = "error") -> DataFrame:
    """Adds the error of each item's latest failed attempt, null without one."""
    failed = responses.where(F.col("error").isNotNull()).withColumnRenamed("item_id", key).select(key, "attempt", F.col("error").alias(name))
    return items.join(first_per_key(failed, [key], [F.desc("attempt"), name]).select(key, name), key, "left")


def cleaned_texts(bills: DataFrame, responses: DataFrame, key: str = "bill_id", text: str = "content", chars: int = CLASSIFY_CHARS) -> DataFrame:
    """Texts replaced by the first usable stop-word answer, its white space collapsed; else the text itself.

    Answers with a `part` belong to requests over `chars` characters each and are merged by `cleaned_parts`.
    """
    if "part" in responses.columns:
        return cleaned_parts(bills, responses, chars, key, text)
    answers = responses.withColumnRenamed("item_id", key).withColumnRenamed("text", "_raw")
    answer = tidy(F.col("_raw"))
    joined = first_accepted(bills, answers, key, answer, F.coalesce(_clear() & (answer != ""), F.lit(False)), "_answer")
    blank = F.col(text).isNull() | (strip(F.col(text)) == "")
    return joined.withColumn(text, F.when(blank, F.col(text)).otherwise(F.coalesce("_answer", text))).drop("_answer")


def merged_parts(responses: DataFrame) -> DataFrame:
    """Answers to requests that came in parts as attempts of the whole item: earlier parts first.

    For tasks with one answer per item: a later part speaks where no earlier one does. Answers that add up are merged
    by `cleaned_parts`, `extracted_parts` and `keyword_parts`.
    """
    order = F.coalesce(F.col("part"), F.lit(0)).cast("bigint") * (1 << 31) + F.col("attempt")
    return responses.withColumn("attempt", order).drop("part")


def first_parts(responses: DataFrame, answer: Column, accept: Column) -> DataFrame:
    """(item_id, answers): of each part of an item the first accepted answer, as (part, answer) in order."""
    part = F.coalesce(F.col("part"), F.lit(0)).cast("int").alias("part")
    usable = responses.select("item_id", part, "attempt", answer.alias("answer"), accept.alias("_accept")).where("_accept")
    first = first_per_key(usable, ["item_id", "part"], ["attempt", "answer"])
    return first.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("part", "answer"))).alias("answers"))


def cleaned_parts(bills: DataFrame, responses: DataFrame, chars: int, key: str = "bill_id", text: str = "content") -> DataFrame:
    """Texts asked for in parts of `chars` characters, each part replaced by its first usable stop-word answer.

    A part without one keeps its own text. Answers are set apart by a blank, as their ends are trimmed; parts that
    both keep their text meet as they did. A blank text stays as it is.
    """
    answer = tidy(F.col("text"))
    first = first_parts(responses, answer, F.coalesce(_clear() & (answer != ""), F.lit(False)))
    joined = bills.join(first.select(F.col("item_id").alias(key), F.map_from_entries("answers").alias("_answers")), key, "left")
    pieces = F.transform(text_parts(F.col(text), chars), lambda piece, i: F.struct(
        F.coalesce(F.try_element_at("_answers", i), piece).alias("text"), F.try_element_at("_answers", i).isNull().alias("own")))
    begin = F.struct(F.lit("").alias("text"), F.lit(None).cast("boolean").alias("own"))  # nothing stands before the first part

    def append(acc: Column, piece: Column) -> Column:
        gap = F.when(acc["own"].isNull() | (acc["own"] & piece["own"]), "").otherwise(" ")
        return F.struct(F.concat(acc["text"], gap, piece["text"]).alias("text"), piece["own"].alias("own"))

    merged = F.aggregate(pieces, begin, append, lambda acc: acc["text"])
    blank = F.col(text).isNull() | (strip(F.col(text)) == "")
    return joined.withColumn(text, F.when(blank, F.col(text)).otherwise(merged)).drop("_answers")


def extracted_parts(responses: DataFrame, key: str = "file_name") -> DataFrame:
    """`extracted_fields` of files asked for in parts, from the first usable answer to each part.

    The bill number is the first one found. Reason and main content may run over several parts: what the parts hold
    of them is joined in order by a blank, equal pieces once.
    """
    named = bill_fields(F.col("text"))
    found = F.greatest(*[F.length(named[c]) for c in ("bill_no", "reason", "main")]) > 0
    rows = first_parts(responses, named, F.coalesce(_clear() & found, F.lit(False)))
    each = lambda c: F.array_distinct(F.filter(F.transform("answers", lambda a: a["answer"][c]), lambda v: v != ""))
    return rows.select(F.col("item_id").alias(key), F.coalesce(F.get(each("bill_no"), F.lit(0)), F.lit("")).alias("bill_number"),
                       F.array_join(each("reason"), " ").alias("reason"), F.array_join(each("main"), " ").alias("main"))


def keyword_parts(items: DataFrame, responses: DataFrame, key: str, name: str = "keywords") -> DataFrame:
    """The keywords of all parts of each item, in order and each once; the default keywords without a usable answer.

    A part's answer is usable if it came without an error and holds a list of strings.
    """
    asked = json_strings(F.col("text"), default=[""])
    first = first_parts(responses, asked, F.coalesce(_clear() & (asked != F.array(F.lit(""))), F.lit(False)))
    words = F.array_distinct(F.flatten(F.col("answers.answer")))
    joined = items.join(first.select(F.col("item_id").cast(items.schema[key].dataType).alias(key), words.alias(name)), key, "left")
    return joined.withColumn(name, F.coalesce(name, F.array(*(F.lit(d) for d in lexicon.DEFAULT_KEYWORDS))))


def nicknames(topics: DataFrame, responses: DataFrame, key: str = "topic", name: str = "nickname") -> DataFrame:
    answers = responses.withColumn(key, F.col("item_id").cast(topics.schema[key].dataType))
    raw = strip(F.col("text"))
    return first_accepted(topics, answers, key, raw, F.coalesce(_clear() & (raw != ""), F.lit(False)), name)


def extracted_fields(responses: DataFrame, key: str = "file_name") -> DataFrame:
    """Bill number, reason and main content of each file's first usable answer; all-empty rows are dropped.

    An answer is usable if it came without an error and names one of the fields. Answers with a `part` are merged by
    `extracted_parts`.
    """
    if "part" in responses.columns:
        return any_field(extracted_parts(responses, key), ["bill_number", "reason", "main"])
    named = bill_fields(F.col("text"))
    usable = responses.where(_clear()).withColumn("_f", named).where(F.coalesce(
        *[F.when(F.col(f"_f.{c}") != "", True) for c in ("bill_no", "reason", "main")], F.lit(False)))
    first = first_per_key(usable, ["item_id"], ["attempt", F.col("text").asc_nulls_last()])
    fields = first.select(F.col("item_id").alias(key), bill_fields(F.col("text")).alias("f"))
    return any_field(
        fields.select(key, F.col("f.bill_no").alias("bill_number"), F.col("f.reason").alias("reason"),
                      F.col("f.main").alias("main")),
        ["bill_number", "reason", "main"],
    )


def first_sentence_answers(bills: DataFrame, key: str = "bill_id", text: str = "content") -> DataFrame:
    """A response table without a model: each text answered by its own first sentence."""
    return bills.select(
        F.col(key).cast("string").alias("item_id"), F.lit(1).alias("attempt"),
        F.rtrim(first_sentence(F.col(text)), F.lit(".!?。")).alias("text"), F.lit(None).cast("string").alias("error"))


def section_answers(files: DataFrame, key: str = "file_name", text: str = "text") -> DataFrame:
    """A response table without a model: number, reason and main sections found by their headings."""
    body = F.col(text)
    fields = F.struct(
        F.regexp_extract(body, java_regex(r"의안\s*번호\s*[:：]?\s*(?:제\s*)?(\d+)"), 1).alias("bill_no"),
        F.regexp_extract(body, java_regex(r"(?s)제안\s*이유\s*(?!및)(.*?)(?=주요\s*내용|주\s문|\z)"), 1).alias("reason"),
        F.regexp_extract(body, java_regex(r"(?s)(?:주요\s*내용|주\s문)\s*(.*)\z"), 1).alias("main"),
    )
    return files.select(
        F.col(key).cast("string").alias("item_id"), F.lit(1).alias("attempt"), F.to_json(fields).alias("text"),
        F.lit(None).cast("string").alias("error"))


def fetched_content(fetches: DataFrame) -> DataFrame:
    """Bill text per URL from its first successful fetch, else `ERROR: ` and the last error.

    A page read without the content element has a null content.
    """
    failed = F.col("error").isNotNull()
    content = F.when(failed, F.concat(F.lit("ERROR: "), F.col("error"))).otherwise(
        clean_text(bill_content(F.col("html"))))
    # The text is taken from the page before rows are moved: pages are many times larger.
    read = fetches.select(
        "url", "attempt", content.alias("content"), failed.alias("is_error"))
    order = ["is_error", F.when(~F.col("is_error"), F.col("attempt")), F.desc("attempt"), "content"]
    return first_per_key(read, ["url"], order).drop("attempt")
