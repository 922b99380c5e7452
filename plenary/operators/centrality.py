"""Extractive summaries: the sentence that is most central among those of its text."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

STEPS, CLOSE = 50, 1e-9
_SENTENCE = re.compile(r".*?[.!?。](?= |$)|.+$")
_TERM = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[str]:
    """Stretches up to a full stop, exclamation or question mark before a blank or the end; white space is collapsed."""
    return [s for s in (m.strip() for m in _SENTENCE.findall(" ".join(text.split()))) if s]


def centralities(parts: list[str]) -> np.ndarray:
    """How central each sentence is: the leading eigenvector of the sentences' cosine similarities.

    A sentence is its terms, each weighing its count times ln(1 + sentences / sentences with it). The similarities are
    the product of the weight matrix with itself, so a step of the power iteration runs over the matrix' entries twice
    and no pair of sentences is ever made.
    """
    found = [_TERM.findall(p.lower()) for p in parts]
    size = np.array([len(f) for f in found])
    if not size.sum():
        return np.zeros(len(parts))
    _, term = np.unique(np.array([w for f in found for w in f]), return_inverse=True)
    row = np.repeat(np.arange(len(parts)), size)
    cell, count = np.unique(row * (term.max() + 1) + term, return_counts=True)
    row, term = cell // (term.max() + 1), cell % (term.max() + 1)
    weight = count * np.log1p(len(parts) / np.bincount(term)[term])
    weight /= np.sqrt(np.bincount(row, weight * weight, len(parts)))[row]
    rank = np.ones(len(parts)) / np.sqrt(len(parts))
    for _ in range(STEPS):
        new = np.bincount(row, weight * np.bincount(term, weight * rank[row])[term], len(parts))
        new /= np.sqrt((new * new).sum())
        moved, rank = np.abs(new - rank).max(), new
        if moved < CLOSE:
            break
    return rank


def central_sentence(text: str | None) -> str | None:
    """The most central sentence, of equal ones (to 6 decimals) the first; None for a text without a sentence."""
    parts = sentences(text or "")
    if not parts:
        return None
    return parts[int(np.argmax(np.round(centralities(parts), 6)))]


def central_sentence_answers(bills: DataFrame, key: str = "bill_id", text: str = "content") -> DataFrame:
    """A response table without a model: each text answered by its most central sentence, without its closing mark.

    A null or blank text has an empty answer, which no task accepts. Each text is worked on in its own row, whole.
    """

    def run(batches):
        for batch in batches:
            found = [central_sentence(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["item_id", "text"])

    rows = bills.select(F.col(key).cast("string"), text).mapInArrow(run, "item_id string, text string")
    return rows.select("item_id", F.lit(1).alias("attempt"), F.rtrim(F.coalesce("text", F.lit("")), F.lit(".!?。")).alias("text"), F.lit(None).cast("string").alias("error"))
