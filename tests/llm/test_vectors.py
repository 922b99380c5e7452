"""Exact top-k search beside SQL and a plain loop, with ties, repeats and unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plenary.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, ids string, block int, part int"


def plain(rows, k):
    usable = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ints = [int(np.floor(float(np.float32(x)) * 1024)) for x in v]
        usable[i] = min(usable.get(i, ints), ints)
    out = []
    for q, a in usable.items():
        if q % 10 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_beside_a_plain_loop(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=9) * rng.choice([0.1, 1, 5])).astype(float).tolist(), "c", 1, 2) for i in range(150)]
    rows += [(i, rows[3][1], "c", 1, 2) for i in range(200, 260)]  # many equal vectors
    rows += [(300, None, "c", 1, 2), (310, [1.0, None], "c", 1, 2), (320, [float("nan")], "c", 1, 2), (330, [float("inf")] * 9, "c", 1, 2),
             (None, [1.0] * 9, "c", 1, 2), (340, [], "c", 1, 2), (350, [2.0, 3.0], "c", 1, 2), (7, rows[8][1], "c", 1, 2), (7, rows[7][1], "c", 1, 2), (-10, rows[9][1], "c", 1, 2)]
    found = topk.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, k=10)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 10)


def test_blocks_and_bounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * 2.0 ** -(i % 9)).tolist(), "c", 1, 2) for i in range(400)]
    found = topk.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, k=3)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 3)


def test_query_blocks_are_never_broadcast(spark):
    """A query block comes once per range partition; the driver would collect them all for a broadcast."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist(), "c", 1, 2) for i in range(100)]
    plan = topk.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_counted_vectors_fill_their_blocks(spark):
    rows = [(i, [float(i), 1.0], "c", 1, 2) for i in range(40)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    held = [np.frombuffer(r["ids"], np.int64) for r in topk.blocks(vectors, 2, 16, 40).orderBy("block").collect()]
    assert [len(ids) for ids in held] == [16, 16, 8]
    assert np.concatenate(held).tolist() == list(range(39, -1, -1))
    assert topk.blocks(vectors.where("id < 0"), 2, 16, 0).isEmpty()


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 2.0], "c", 1, 2), (1, [3.0, -1.0], "c", 1, 2)]
    assert [tuple(r) for r in topk.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0).collect()] == [(0, 1, 1, 1024 * 1024)]
    assert topk.search(spark.createDataFrame([], SCHEMA), F.col("id") == 0).isEmpty()
    assert topk.search(spark.createDataFrame(rows[1:], SCHEMA), F.col("id") % 10 == 0).isEmpty()


def test_large_values_stay_exact():
    rng = np.random.default_rng(0)
    queries, vectors = (rng.integers(-(1 << 30), 1 << 30, (n, 5)) for n in (3, 40))
    vectors = vectors[np.argsort(-np.sqrt((vectors.astype(float) ** 2).sum(1)))]
    row, found, score = topk.best_in_block(queries, np.arange(100, 103), vectors, np.arange(40), np.full(3, -np.inf), np.eye(5), 4)
    for q in range(3):
        want = sorted(((-int(sum(int(a) * int(b) for a, b in zip(queries[q], v))), i) for i, v in enumerate(vectors)))[:4]
        assert [(-s, i) for s, i in zip(score[row == q].tolist(), found[row == q].tolist())] == want


