"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are stretches of letters and digits in lower case. Features of a text are the distinct hashes of its
words, its neighbouring pairs, and its pairs with one word between. Per-coordinate rates and an L1 term leave
few weights that are not zero; those are what is sent to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plenary.llm import tokens

BITS = 20
SAMPLE_PER_CLASS = 4000


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by ascending feature number, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


def text_features(column: pa.Array, bits: int = BITS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, feature numbers with repeats, text number of each) per stretch of rows."""
    for row, end, data, starts in tokens.chunks(pc.utf8_lower(column.fill_null(""))):
        _, _, word, offsets = tokens.find_words(data, starts, tokens.PUNCTUATION)
        doc = tokens.owner(offsets)
        parts, owners = [word], [doc]
        for gap, salt in ((1, 0x94D049BB133111EB), (2, 0xD6E8FEB86659FD93)):
            if len(word) > gap:
                same = doc[gap:] == doc[:-gap]
                parts.append(tokens.mix(word[:-gap] * np.uint64(3) + word[gap:] * np.uint64(salt))[same])
                owners.append(doc[gap:][same])
        numbers = (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64)
        yield row, end, numbers, np.concatenate(owners)


def _distinct(numbers: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((doc << bits) | numbers)
    return keys & ((1 << bits) - 1), keys >> bits


def training_sample(docs: DataFrame, labels: DataFrame, label: str, usable, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(label, features) of at most `per_class` usable documents per class, first by a hash of the id.

    A document with several labels counts as toxic if one of them says so.
    """
    truth = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_y"))
    ranked = truth.where(usable).withColumn("_h", F.xxhash64("doc_id"))
    chosen = None
    for value in (0, 1):
        part = ranked.where(F.col("_y") == value).orderBy("_h", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "_y")), "doc_id")  # at most 2 * per_class ids

    def extract(batches):
        for batch in batches:
            y = batch.column(batch.schema.get_field_index("_y"))
            for row, end, numbers, doc in text_features(batch.column(batch.schema.get_field_index("text"))):
                number, doc = _distinct(numbers, doc, BITS)
                offsets = np.searchsorted(doc, np.arange(end - row + 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(number, pa.int32()))
                yield pa.RecordBatch.from_arrays([y.slice(row, end - row).cast(pa.int32()), lists], ["y", "features"])

    return rows.mapInArrow(extract, "y int, features array<int>")


def fit(samples: list[tuple[int, np.ndarray]], share: float | None = None, epochs: int = 6, alpha: float = 3.0,
        beta: float = 1.0, l1: float = 8.0, l2: float = 0.01, bits: int = BITS, seed: int = 7) -> Model:
    """FTRL-proximal over (label, distinct feature numbers) pairs.

    `share` is the share of label 1 among all labelled rows; the intercept is moved to it, as the sample is
    taken by class. No sample gives a model that scores `share` (0 if unknown) everywhere.
    """
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    bias = 1 << bits
    rng = np.random.default_rng(seed)
    samples = [(y, np.append(x, bias).astype(np.int32)) for y, x in samples]

    def weights(i):
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - np.where(i == bias, 0.0, l1), 0.0)
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            y, x = samples[k]
            w = weights(x)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(n[x])
            n[x] += g * g
            z[x] += g - (np.sqrt(n[x]) - root) / alpha * w
    every = weights(np.arange(bias + 1))
    kept = np.flatnonzero(every[:bias])
    positives = sum(y for y, _ in samples)
    intercept = float(every[bias])
    if share is not None:
        share = min(max(share, 1e-6), 1 - 1e-6)
        odds = np.log((positives or 1) / ((len(samples) - positives) or 1)) if samples else 0.0
        intercept += float(np.log(share / (1 - share)) - odds)
    elif not samples:
        intercept = -35.0
    return Model(kept, every[kept], intercept)


def score(docs: DataFrame, model: Model, bits: int = BITS) -> DataFrame:
    """(doc_id, score) for every row; null and empty texts get the intercept's score."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for row, end, numbers, doc in text_features(batch.column(1)):
                at = np.minimum(np.searchsorted(model.features, numbers), max(len(model.features) - 1, 0))
                known = model.features[at] == numbers if len(model.features) else np.zeros(len(numbers), bool)
                number, of = _distinct(numbers[known], doc[known], bits)
                weight = model.weights[np.searchsorted(model.features, number)]
                total = np.bincount(of, weight, end - row) + model.intercept
                value = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                yield pa.RecordBatch.from_arrays([ids.slice(row, end - row), pa.array(value)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, usable, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Scores every document with a model learnt from a bounded sample of the usable labelled ones.

    Args:
        docs: `doc_id`, `text`; other columns are ignored. Rows may repeat; each gets its score.
        labels: `doc_id` and the label column; values other than 0 and 1 are ignored.
        usable: condition on `doc_id` that marks the documents to learn from.
        per_class: most documents of each label to learn from.

    Returns:
        `doc_id`, `score` (0 to 1), one row per row of `docs`.
    """
    rows = training_sample(docs, labels, label, usable, per_class).toArrow().combine_chunks()
    samples = []
    for y, x in zip(rows.column("y").chunks, rows.column("features").chunks):
        lists = np.split(x.flatten().to_numpy(), x.offsets.to_numpy()[1:-1] - x.offsets[0].as_py())
        samples += zip(y.to_pylist(), lists)
    samples.sort(key=lambda s: (s[0], len(s[1]), s[1].tobytes()))
    counted = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(usable)
    share = counted.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return score(docs, fit(samples, share))
