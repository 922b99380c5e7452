"""Compound spacing learnt from the corpus: words cut where frequent words fill them better than they are found themselves."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from plenary.functions.text import tidy
from plenary.operators.index import materialize
from plenary.operators.keywords import FREQUENT
from plenary.session import spread

AT_LEAST = 20  # texts' uses of a word before it counts as a part of others
SHORTEST = 2   # letters of a part
LONGEST = 64   # letters of a compound; a longer run of letters is not taken for a word


def word_counts(texts: DataFrame, column: str = "content") -> DataFrame:
    """(word, n) of the words, in lower case, that consist of letters and are at most LONGEST long."""
    words = F.split(F.lower(tidy(F.col(column))), " ")
    rows = texts.select(F.explode(words).alias("word"))
    return rows.where(F.col("word").rlike(rf"^\p{{L}}{{1,{LONGEST}}}$")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_split(word: str, pieces: dict[tuple[int, int], float], own: float) -> tuple[str, float]:
    """The cut of a word into known pieces with the greatest sum of log shares, if that is greater than the word's own.

    Of equal sums the one with fewer pieces wins, then the one with the longer last piece, and so on to the front.

    Args:
        pieces: log share by (start, length).
    """
    best: list[tuple[float, int, int] | None] = [(0.0, 0, 0)] + [None] * len(word)
    ends: dict[int, list[tuple[int, float]]] = {}
    for (start, length), value in pieces.items():
        ends.setdefault(start + length, []).append((start, value))
    for end in sorted(ends):
        for start, value in sorted(ends[end]):
            before = best[start]
            if before is not None:
                here = (before[0] + value, -(-before[1] + 1), start)
                if best[end] is None or here[:2] > best[end][:2]:
                    best[end] = here
    whole = best[len(word)]
    if whole is None or whole[0] <= own or whole[1] > -2:
        return word, own
    cuts, at = [], len(word)
    while at:
        cuts.append(word[best[at][2]: at])
        at = best[at][2]
    return " ".join(reversed(cuts)), whole[0]


def learnt_splits(counts: DataFrame, at_least: int = AT_LEAST, shortest: int = SHORTEST) -> DataFrame:
    """(word, n, spaced) of the words that are cut: a unigram model of the corpus decides.

    A word's share is its count among all. Its parts are words of `shortest` letters and `at_least` uses; a cut counts
    if the product of its parts' shares is greater than the word's own share. Each distinct word gives its inner
    stretches, at most LONGEST squared over 2, which meet the parts in one join; the texts are not moved for it.
    """
    counts = materialize(counts)
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return counts.select("word", "n", F.col("word").alias("spaced"))
    # Stored, so that Spark knows its real size: a small list of parts is broadcast and no stretch is moved, a large one is not.
    known = materialize(counts.where((F.col("n") >= at_least) & (F.length("word") >= shortest)).select(
        F.col("word").alias("piece"), F.log(F.col("n") / F.lit(total)).alias("value")))
    lengths = [r[0] for r in known.select(F.length("piece")).distinct().collect()]  # at most LONGEST numbers
    letters = F.length("word")
    sizes = F.explode(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>")).alias("length")
    wide = spread(counts.where((letters >= 2 * shortest) & F.lit(bool(lengths))))
    # Logs of shares are negative, so no cut is worth more than its first and last part: most words are out by these alone.
    ends = wide.select("word", "n", sizes).where(F.col("length") < letters).select("word", "n", F.inline(F.array(
        F.struct(F.lit(True).alias("front"), F.expr("left(word, length)").alias("piece")),
        F.struct(F.lit(False).alias("front"), F.expr("right(word, length)").alias("piece")))))
    bound = F.max(F.when(F.col("front"), F.col("value"))) + F.max(F.when(~F.col("front"), F.col("value")))
    kept = materialize(ends.join(known, "piece").groupBy("word", "n").agg(bound.alias("_bound"))
                       .where(F.col("_bound") > F.log(F.col("n") / F.lit(total)) - 1e-9).select("word", "n"))
    starts = spread(kept).select("word", "n", F.explode(F.sequence(F.lit(0), letters - shortest)).alias("start"))
    stretches = starts.select("word", "n", "start", sizes).where(
        (F.col("start") + F.col("length") <= letters) & (F.col("length") < letters)).select(
        "word", "n", "start", "length", F.expr("substring(word, start + 1, length)").alias("piece"))
    edges = stretches.join(known, "piece").groupBy("word", "n").agg(F.collect_list(F.struct("start", "length", "value")).alias("edges"))

    @F.pandas_udf(T.StringType())
    def cut(words: pd.Series, uses: pd.Series, edges: pd.Series) -> pd.Series:
        found = ({(e["start"], e["length"]): e["value"] for e in row} for row in edges)
        return pd.Series([best_split(w, pieces, math.log(n / total))[0] for w, n, pieces in zip(words, uses, found)])

    return edges.select("word", "n", cut("word", "n", "edges").alias("spaced")).where("spaced <> word")


def space_compounds(texts: DataFrame, splits: DataFrame, column: str = "content") -> DataFrame:
    """Texts with their compounds spaced; words are compared in lower case and keep their own letters.

    White space becomes single blanks. Texts without a compound, and null texts, keep their words. A text's distinct words
    meet the splits, named by the text's hash, so ids need not be unique; the texts themselves are joined once.
    """
    text = tidy(F.col(column))
    name = F.unhex(F.left(F.sha2(F.col(column), 256), F.lit(32)))
    words = texts.select(name.alias("_text"), F.array_distinct(F.split(F.lower(text), " ")).alias("_words")).select("_text", F.explode("_words").alias("word"))
    splits = materialize(splits.select("word", "spaced"))
    # Words that fill more than one in FREQUENT of all rows are few: the tasks get them with their cut, if any. Only rows of other words are moved.
    uses = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    often = uses.where(F.col("n") > float(uses.agg(F.sum("n")).first()[0] or 0) / FREQUENT)
    frequent = materialize(often.join(splits, "word", "left").select("word", "spaced", F.lit(True).alias("_known")))
    met = materialize(words.join(F.broadcast(frequent), "word", "left").where("_known IS NULL OR spaced IS NOT NULL"))
    rest = met.where("_known IS NULL").select("_text", "word").join(splits, "word")
    pairs = F.collect_set(F.struct("word", "spaced"))
    hits = met.where("_known").select("_text", "word", "spaced").unionByName(rest).groupBy("_text").agg(pairs.alias("_pairs"))

    @F.pandas_udf(T.StringType())
    def spaced(values: pd.Series, pairs: pd.Series) -> pd.Series:
        def one(value, found):
            if value is None or found is None:
                return value
            cuts, out = {p["word"]: p["spaced"].split(" ") for p in found}, []
            for word in value.split(" "):
                at = 0
                parts = cuts.get(word.lower())
                for part in parts or ():
                    out.append(word[at: at + len(part)])
                    at += len(part)
                if parts is None:
                    out.append(word)
            return " ".join(out)

        return pd.Series([one(v, p) for v, p in zip(values, pairs)], dtype=object)

    joined = texts.withColumn("_text", name).join(hits, "_text", "left")
    return joined.withColumn(column, spaced(text, "_pairs")).drop("_text", "_pairs")
