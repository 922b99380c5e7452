"""Keywords from responses, and the tf-idf default when there are none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plenary.functions.jsons import json_strings
from plenary.functions.text import join_list
from plenary.operators.dedup import first_per_key
from plenary.operators.index import dense_index, materialize
from plenary.operators.responses import keyword_parts
from plenary.session import part_count, spread

TOP_TERMS = 4
FREQUENT = 1 << 17  # most terms whose weights are sent to all tasks
LEAST_RATIO = 10.83  # of a phrase: one chance in a thousand that its terms meet by accident
# Particles and counters that join or number other words; callers pass their own list where they have one.
PARTICLES = ("등", "및", "또는", "그", "이", "의", "을", "를", "은", "는", "에", "와", "과")


def words(text: Column) -> Column:
    """Lower-case runs of letters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))


def is_term(word: Column, stop: Sequence[str] = PARTICLES) -> Column:
    return ~word.isin(*stop)


def tokens(text: Column, stop: Sequence[str] = PARTICLES) -> Column:
    """The terms of a text as an array, stop words left out."""
    return F.filter(words(text), lambda w: is_term(w, stop))


def term_counts(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """(key, term, n), stored; the texts of a key meet in one task, so that nothing but the texts is moved."""
    found = docs.repartition(part_count(docs), key).select(key, F.explode(terms).alias("term"))
    return materialize(found.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n")))


def _weigh(counts: DataFrame, containing: DataFrame, total: int) -> DataFrame:
    """Adds `score`: a term's count times the logarithm of its rarity among all documents.

    Both tables are stored. Terms with more than one in FREQUENT of all rows, and so at most FREQUENT of them, are sent to
    the tasks; only the rows of the others are moved.
    """
    rows = containing.agg(F.sum("containing")).first()[0] or 0
    frequent = F.broadcast(containing.where(F.col("containing") > rows / FREQUENT))
    rest = counts.join(frequent, "term", "left_anti").join(containing.where(F.col("containing") <= rows / FREQUENT), "term")
    joined = counts.join(frequent, "term").unionByName(rest)
    rarity = F.log(F.lit(1.0 + total) / (F.lit(1.0) + F.col("containing")))
    return joined.withColumn("score", F.round(F.col("n") * rarity, 6))


def _top(scored: DataFrame, key: str, n: int) -> DataFrame:
    return first_per_key(scored.select(key, "term", "score"), [key], [F.desc("score"), "term"], n)


def cluster_term_scores(docs: DataFrame, cluster: str, text: str = "content", top: int = TOP_TERMS,
                        stop: Sequence[str] = PARTICLES) -> DataFrame:
    """Terms shared by many documents of a cluster and by few others: the best `top` per cluster.

    A document counts a term once, inside its own row, so only partial (cluster, term) counts are
    shuffled; they are stored, and texts are taken apart once.
    """
    pairs = spread(docs).select(cluster, F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
    counts = materialize(
        pairs.where(is_term(F.col("term"), stop)).groupBy(cluster, "term").agg(F.count(F.lit(1)).alias("n")))
    containing = materialize(
        counts.groupBy("term").agg(F.sum("n").alias("containing")))
    return _top(_weigh(counts, containing, docs.count()), cluster, top)


def doc_term_scores(docs: DataFrame, key: str, text: str = "content", top: int = TOP_TERMS,
                    stop: Sequence[str] = PARTICLES) -> DataFrame:
    """The best `top` terms of each document by term count and rarity.

    Texts are taken apart once, into stored (key, term, count) rows; everything else reads those.
    """
    counts = term_counts(docs, key, tokens(F.col(text), stop))
    containing = materialize(counts.groupBy("term").agg(F.count(F.lit(1)).alias("containing")))
    return _top(_weigh(counts, containing, docs.count()), key, top)


def neighbours(text: Column, stop: Sequence[str] = PARTICLES) -> Column:
    """Every two terms of a text that follow each other, joined by a blank; a stop word between them keeps them apart."""
    every = words(text)
    # The array is given a name once, so that it isn't made anew for each of its places.
    return F.get(F.transform(F.array(every), lambda w: F.filter(
        F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                   lambda a, b: F.when(is_term(a, stop) & is_term(b, stop), F.concat_ws(" ", a, b))), lambda p: p.isNotNull())), 0)


def phrase_scores(docs: DataFrame, text: str = "content", least: float = LEAST_RATIO, support: int = 2, stop: Sequence[str] = PARTICLES,
                  key: str | None = None) -> DataFrame:
    """(phrase, n, ratio): neighbouring terms that meet more often than chance has it, over all texts.

    With a `key`, also `containing`: the number of keys whose texts hold the phrase.

    `ratio` is Dunning's log-likelihood ratio of the pair's four counts: both, the first without the second, the second
    without the first, neither. Pairs that meet less often than expected, or in fewer than `support` places, are no phrases.
    """
    pair = F.explode(neighbours(F.col(text), stop)).alias("phrase")
    if key is None:
        counts = materialize(spread(docs).select(pair).groupBy("phrase").agg(F.count(F.lit(1)).alias("n")))
    else:
        own = docs.repartition(part_count(docs), key).select(key, pair).groupBy(key, "phrase").agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(own.groupBy("phrase").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("containing")))
    more = [c for c in counts.columns if c == "containing"]
    split = counts.select("phrase", "n", *more, F.split("phrase", " ")[0].alias("first"), F.split("phrase", " ")[1].alias("second"))
    firsts = materialize(split.groupBy("first").agg(F.sum("n").alias("n_first")))
    seconds = materialize(split.groupBy("second").agg(F.sum("n").alias("n_second")))
    total = F.lit(float(counts.agg(F.sum("n")).first()[0] or 1))
    rows = split.where(F.col("n") >= support).join(firsts, "first").join(seconds, "second")
    n, a, b = (F.col(c).cast("double") for c in ("n", "n_first", "n_second"))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(F.greatest(seen, F.lit(1.0)) / expected)).otherwise(0.0)

    cells = [(n, a * b / total), (a - n, a * (total - b) / total), (b - n, (total - a) * b / total), (total - a - b + n, (total - a) * (total - b) / total)]
    ratio = 2 * sum((part(seen, F.greatest(expected, F.lit(1e-9))) for seen, expected in cells[1:]), part(*cells[0]))
    return rows.select("phrase", "n", *more, F.round(F.when(n > a * b / total, ratio).otherwise(0.0), 6).alias("ratio")).where(F.col("ratio") >= least)


def doc_phrase_scores(docs: DataFrame, key: str, text: str = "content", top: int = TOP_TERMS, least: float = LEAST_RATIO, support: int = 2,
                      stop: Sequence[str] = PARTICLES) -> DataFrame:
    """The best `top` terms or phrases of each document, by count and rarity; only the corpus' phrases compete with single terms."""
    phrases = materialize(phrase_scores(docs, text, least, support, stop, key).select(F.col("phrase").alias("term"), "containing"))
    singles = term_counts(docs, key, tokens(F.col(text), stop))
    containing = materialize(singles.groupBy("term").agg(F.count(F.lit(1)).alias("containing")))
    total = docs.count()
    best = materialize(_top(_weigh(singles, containing, total), key, top))
    # A phrase's score is at most that of one in a single document; those that cannot pass the last of `top` terms are left out at once.
    last = best.groupBy(F.col(key).alias("_key")).agg(F.when(F.count(F.lit(1)) >= top, F.min("score")).alias("_last"))
    texts = docs.select(key, text).join(last, F.col(key).eqNullSafe(F.col("_key")), "left").select(key, text, "_last")
    pairs = texts.repartition(part_count(docs), key).select(key, "_last", F.explode(neighbours(F.col(text), stop)).alias("term"))
    counts = pairs.groupBy(key, "_last", "term").agg(F.count(F.lit(1)).alias("n"))
    able = F.col("_last").isNull() | (F.col("n") * F.log(F.lit((1.0 + total) / 2)) >= F.col("_last") - 1e-4)
    counts = materialize(counts.where(able).select(key, "term", "n"))
    return _top(_weigh(counts, phrases, total).select(*best.columns).unionByName(best), key, top)


def as_keyword_list(scores: DataFrame, key: str, name: str = "keywords") -> DataFrame:
    """The scored terms of a key as one array, best first."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("term").alias("t"))))
    return scores.groupBy(key).agg(F.transform(rows, lambda r: r["t"]).alias(name))


def keywords_from_responses(items: DataFrame, responses: DataFrame, key: str, name: str = "keywords",
                            limit: int = TOP_TERMS) -> DataFrame:
    """Parsed keyword answers; items without a usable one get the default keywords.

    Answers with a `part` are merged: the first `limit` of an item's keywords over all its parts.
    """
    if "part" in responses.columns:
        merged = keyword_parts(items, responses, key, name)
        return merged.withColumn(name, F.slice(name, 1, limit))
    answers = responses.where(F.col("error").isNull()).withColumn(
        key, F.col("item_id").cast(items.schema[key].dataType))
    first = first_per_key(answers, [key], ["attempt", "text"]).select(key, "text")
    joined = items.join(first, key, "left")
    return joined.withColumn(name, json_strings(F.coalesce("text", F.lit("")), limit)).drop("text")


def single_topics(docs: DataFrame, key: str, topic: str = "topic") -> DataFrame:
    """Unclustered documents (topic -1 or null) get the id -(row number + 2)."""
    numbers = dense_index(docs.select(key), [key], "_number")
    own = -(F.col("_number") + 2)
    unclustered = F.coalesce(F.col(topic) == -1, F.lit(True))
    return docs.join(numbers, key).withColumn(topic, F.when(unclustered, own).otherwise(F.col(topic))) \
        .drop("_number")


def keyword_label(keywords: Column) -> Column:
    return join_list(F.coalesce(keywords, F.array().cast("array<string>")))
