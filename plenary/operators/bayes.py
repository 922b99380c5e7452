"""Classes learnt from answered bills: naive Bayes with complement weights, in DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plenary.functions import lexicon
from plenary.operators.index import materialize
from plenary.operators import keywords
from plenary.operators.keywords import FREQUENT, PARTICLES, tokens

SMOOTHING = 1.0


def term_counts(docs: DataFrame, key: str, text: str = "content", stop: Sequence[str] = PARTICLES) -> DataFrame:
    """(key, term, n), stored; a text's terms are added up in its own task."""
    return keywords.term_counts(docs, key, tokens(F.col(text), stop))


def complement_scores(counts: DataFrame, labels: DataFrame, key: str, label: str = "category", smoothing: float = SMOOTHING) -> DataFrame:
    """(key, label, words, score): how badly each text fits the texts of all *other* classes; the greatest score is its class.

    With T a term's count over all labelled texts, N its count in a class, and a the smoothing, a term of a text speaks
    for the class by -ln((T - N + a) / (T_all - N_all + a V)). A class is a candidate for a text if they share a term;
    terms of no labelled text say nothing. The part of the sum that is the same for all classes is left out:
        score = words * ln(T_all - N_all + a V) - sum n * ln((T - N + a) / (T + a))
    so only (term, class) pairs that occur are ever joined.

    Args:
        counts: `term_counts` of all texts, labelled or not.
        labels: (key, label) of the labelled texts; null labels are left out.
    """
    known = labels.where(F.col(label).isNotNull()).select(key, label)
    model = materialize(counts.join(known, key).groupBy("term", label).agg(F.sum("n").alias("n_class")))
    terms = materialize(model.groupBy("term").agg(F.sum("n_class").alias("n_all")))
    total, vocabulary = terms.agg(F.sum("n_all"), F.count(F.lit(1))).first()
    rest = materialize(model.groupBy(label).agg((F.lit(float(total or 0)) - F.sum("n_class") + smoothing * (vocabulary or 0)).alias("rest")))
    weight = F.log((F.col("n_all") - F.col("n_class") + smoothing) / (F.col("n_all") + smoothing))
    # One row a term: its weight for each class, and for a class of no name a weight of one, whose sum is the text's length.
    every = F.concat(F.collect_list(F.struct(F.col(label), weight.alias("weight"))),
                     F.array(F.struct(F.lit(None).cast(model.schema[label].dataType).alias(label), F.lit(1.0).alias("weight"))))
    weights = materialize(model.join(terms, "term").groupBy("term", "n_all").agg(every.alias("weights")))
    # Terms with more than that share of all uses are few, and so are their weights: the tasks get them, and only the rows of other terms are moved.
    often = F.col("n_all") > float(total or 0) * max(rest.count(), 1) / FREQUENT
    frequent = F.broadcast(weights.where(often).select("term", "weights"))
    others = counts.join(frequent, "term", "left_anti").join(weights.where(~often).select("term", "weights"), "term")
    parts = [rows.select(key, "n", F.inline("weights")).groupBy(key, label).agg(F.sum(F.col("n") * F.col("weight")).alias("fit"))
             for rows in (counts.join(frequent, "term"), others)]
    sums = materialize(parts[0].unionByName(parts[1]).groupBy(key, label).agg(F.sum("fit").alias("fit")))
    lengths = sums.where(F.col(label).isNull()).select(key, F.col("fit").cast("bigint").alias("words"))
    score = F.col("words") * F.log("rest") - F.col("fit")
    return sums.join(rest, label).join(lengths, key).select(key, label, "words", F.round(score, 6).alias("score"))


def learnt_classes(docs: DataFrame, labels: DataFrame, key: str, text: str = "content", label: str = "category", smoothing: float = SMOOTHING,
                   stop: Sequence[str] = PARTICLES) -> DataFrame:
    """(key, label, confidence) of every text that shares a term with a labelled one.

    The confidence is the class's share of exp(score) among the text's candidates. Equal scores go to the first label.
    """
    scores = materialize(complement_scores(term_counts(docs, key, text, stop), labels, key, label, smoothing))
    best = scores.groupBy(key).agg(F.max(F.struct("score", F.lit(0).alias("_"))).alias("top"))
    # Summed relative to the best score, so that nothing overflows.
    joined = scores.join(best.select(key, F.col("top.score").alias("_best")), key)
    return joined.groupBy(key).agg(
        F.min(F.when(F.col("score") == F.col("_best"), F.col(label))).alias(label),
        F.round(1 / F.sum(F.exp(F.col("score") - F.col("_best"))), 6).alias("confidence"))


def fill_classes(docs: DataFrame, classified: DataFrame, key: str = "bill_id", text: str = "content") -> DataFrame:
    """`classified` (key, category, subcategory, confidence, ...) with learnt categories where no answer gave one.

    Documents with the default class are filled from those with another; their subcategory stays the default.
    """
    empty = (F.col("category") == lexicon.DEFAULT_CATEGORY) & (F.col("subcategory") == lexicon.DEFAULT_SUBCATEGORY) & (F.col("confidence") == lexicon.DEFAULT_CONFIDENCE)
    classified = materialize(classified)
    learnt = learnt_classes(docs.select(key, text), classified.where(~empty).select(key, "category"), key, text)
    found = learnt.select(key, F.col("category").alias("_category"), F.col("confidence").alias("_confidence"))
    joined = classified.join(found, key, "left")
    fill = empty & F.col("_category").isNotNull()
    return joined.withColumns({
        "category": F.when(fill, F.col("_category")).otherwise(F.col("category")),
        "confidence": F.when(fill, F.col("_confidence")).otherwise(F.col("confidence"))}).drop("_category", "_confidence")
