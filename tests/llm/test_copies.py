"""Near-duplicate classes, components, SpotSigs and mixing beside plain versions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plenary.llm import mixing, neardup, spotsigs
from plenary.llm.components import components
from tests.llm.fixtures import no_documents, odd_documents, odd_rows, prose


def groups_of(pairs, nodes):
    label = {n: n for n in nodes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        label[root(a)] = root(b)
    out = {}
    for n in nodes:
        out.setdefault(root(n), []).append(n)
    return sorted(sorted(v) for v in out.values())


def test_components_beside_union_find(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(40)] + [(200, 200 + i) for i in range(1, 30)]
    found = components(spark.createDataFrame(links, "a int, b int")).collect()
    nodes = {n for p in links for n in p}
    got = {}
    for r in found:
        got.setdefault(r.label, []).append(r.key)
    assert sorted(sorted(v) for v in got.values()) == groups_of(links, nodes)
    assert all(label == min(v) for label, v in got.items())


def plain_shingles(text, weight):
    words = (text or "").lower().split()
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    out = Counter()
    for g in grams:
        out[g] += sum(weight[w] for w in g)
    return out


def plain_classes(texts):
    """Classes of row numbers by comparing every pair."""
    df = Counter(w for t in texts for w in set((t or "").lower().split()))
    weight = {w: math.log(1 + len(texts) / max(n, neardup.RARE * len(texts))) for w, n in df.items()}
    sets = [plain_shingles(t, weight) for t in texts]
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            union = sum(max(a[g], b[g]) for g in a | b)
            if (texts[i] or "") == (texts[j] or "") or union and sum(min(a[g], b[g]) for g in a & b) >= (0.8 - 1e-6) * union:
                pairs.append((i, j))
    return groups_of(pairs, range(len(texts)))


def copies(seed=8):
    """A hub with many variants, a chain of edits, exact copies and short texts."""
    rng = random.Random(seed)
    base = prose(rng, "en", 150).split()

    def edit(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = prose(rng, "de", 1)
        return words

    texts = [" ".join(base)] + [" ".join(edit(base, rng.randint(1, 5))) for _ in range(60)]
    chain = prose(rng, "fr", 200).split()
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = edit(chain, 2)
    texts += ["a b c", "a b c d", "A  B C", "", None, "   ", texts[3], texts[3]] + [prose(rng, "en", 60) for _ in range(30)]
    return texts


@pytest.mark.parametrize("unit", [512, 7])
def test_classes_beside_all_pairs(spark, unit):
    texts = copies()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id int, text string, key string, label int")
    found = {r.doc_id: r for r in neardup.classes(df, unit=unit).collect()}
    got = {}
    for i, r in found.items():
        got.setdefault(r.class_id, []).append(i)
    assert sorted(sorted(v) for v in got.values()) == plain_classes(texts)
    assert all(min(v) == k and all(found[i].class_size == len(v) for i in v) for k, v in got.items())


def test_one_document_of_each_class_stays(spark):
    texts = copies()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id int, text string, _who string, _key int")
    kept = neardup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [min(v) for v in plain_classes(texts)]


def test_unlike_texts_under_one_id(spark):
    one, other = prose(random.Random(1), "en", 60), prose(random.Random(2), "de", 60)
    df = spark.createDataFrame([(5, one), (5, other), (5, one + " end"), (7, other), (None, "alone"), (None, "single")], "doc_id int, text string")
    found = neardup.classes(df).collect()
    assert len({r.class_key for r in found}) == 4 and sorted((r.class_id is None, r.class_id or 0, r.class_size) for r in found) == [
        (False, 5, 2)] * 4 + [(True, 0, 1)] * 2
    assert sorted(str(r.doc_id) for r in neardup.keep_first(df).collect()) == ["5", "5", "None", "None"]


def test_classes_of_odd_documents(spark):
    docs = odd_documents(spark)
    found = neardup.classes(docs)
    rows = odd_rows()
    want = Counter(len(c) for c in plain_classes([r[1] for r in rows]))
    assert found.count() == len(rows)
    sizes = found.groupBy("class_key", "class_id", "class_size").count().collect()
    assert all(r["count"] == r.class_size for r in sizes) and len(sizes) == sum(want.values())
    assert Counter(r.class_size for r in found.select("key", "class_size").collect()) == Counter(n for n, k in want.items() for _ in range(n * k))
    assert neardup.classes(no_documents(spark)).isEmpty() and neardup.keep_first(no_documents(spark)).isEmpty()


def test_draws_match_as_often_as_sets_are_alike():
    rng = np.random.default_rng(6)
    a = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    for common in (100, 250, 380):
        b = np.sort(np.concatenate([a[:common], rng.integers(0, 1 << 63, 400 - common).astype(np.uint64)]))
        wa = rng.uniform(1, 30, 400).astype(np.float32)
        value = dict(zip(a.tolist(), wa.tolist()))
        wb = np.array([value.get(x, 10.0) for x in b.tolist()], np.float32)
        drawn = neardup.samples(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 400, 800]), 256)
        assert (drawn[0] == drawn[1]).mean() == pytest.approx(neardup.weighted_jaccard(a, wa, b, wb), abs=0.1)


def test_draws_do_not_depend_on_neighbours():
    rng = np.random.default_rng(7)
    sizes = [3, 0, 70000, 5, 40]
    grams = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    weights = [rng.uniform(1, 9, n).astype(np.float32) for n in sizes]
    whole = neardup.samples(np.concatenate(grams), np.concatenate(weights), np.concatenate([[0], np.cumsum(sizes)]), 8)
    for i, (g, w) in enumerate(zip(grams, weights)):
        assert (neardup.samples(g, w, np.array([0, len(g)]), 8)[0] == whole[i]).all()


def plain_signatures(text, anchors):
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if ord(c) < 128 and not (c.isalnum() or c == "'"):
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    out = set()
    for i, w in enumerate(words):
        chain = [x for x in words[i + 1:] if x not in anchors][:spotsigs.CHAIN]
        if w in anchors and len(chain) == spotsigs.CHAIN:
            out.add((w, *chain))
    return out


def test_signatures_beside_plain_ones():
    rng = random.Random(9)
    texts = [prose(rng, "en", n) for n in (0, 1, 5, 200, 900)] + [None, "the the the", "the cat sat down, and the dog too"]
    anchors = set(spotsigs.ANCHORS)
    sets, offsets = spotsigs.signature_sets(pa.array(texts), spotsigs.anchor_hashes(spotsigs.ANCHORS))
    for i, text in enumerate(texts):
        assert offsets[i + 1] - offsets[i] == max(len(plain_signatures(text, anchors)), 1)
    a, b = (plain_signatures(t, anchors) for t in (texts[3] + " " + texts[4], texts[4]))
    sets, offsets = spotsigs.signature_sets(pa.array([texts[3] + " " + texts[4], texts[4]]), spotsigs.anchor_hashes(spotsigs.ANCHORS))
    got = spotsigs.pruned_jaccard(*np.split(sets, offsets[1:-1]))
    assert got == pytest.approx(len(a & b) / len(a | b))


def test_pruned_jaccard_keeps_all_that_reach_the_threshold():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        for least in (0.0, 0.3, 0.5, 0.8):
            got = spotsigs.pruned_jaccard(a, b, least)
            assert got == pytest.approx(true) if true >= least else got in (-1.0, pytest.approx(true))


def test_edited_texts_and_likeness(spark):
    rows = [r for r in odd_rows() if r[0] is not None]
    rows = list({r[0]: r for r in reversed(rows)}.values())  # one row per id
    rows.sort(key=lambda r: r[0])
    df = spark.createDataFrame(rows, odd_documents(spark).schema)
    found = {r.doc_id: r for r in spotsigs.edited_fingerprints(df).collect()}
    assert len(found) == len(rows)
    texts = [r[1] or "" for r in rows]
    for i, r in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        got = found[r[0]]
        assert got.n_chars == len(text) and got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (set(x[k:k + 8] for k in range(0, len(x), 8)) for x in (got.fingerprint, got.edited_fingerprint, found[rows[(i + 1) % len(rows)][0]].fingerprint))
        assert got.near_edited == pytest.approx(len(a & b) / len(a | b)) and got.near_next == pytest.approx(len(a & c) / len(a | c))
    assert found[0].fingerprint == found[40].fingerprint  # equal texts


def test_repeated_rows_single_rows_and_none(spark):
    docs = odd_documents(spark)
    assert spotsigs.edited_fingerprints(docs).count() == docs.count()
    one = docs.where("doc_id = 1")
    got = spotsigs.edited_fingerprints(one).first()
    assert got.near_next == 1.0
    assert spotsigs.edited_fingerprints(no_documents(spark)).isEmpty()


def test_similar_pairs_beside_all_pairs(spark):
    texts = copies(11)[:70]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    prints = spotsigs.fingerprints(df)
    sets = {r.doc_id: frozenset(r.signatures) for r in prints.collect()}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    ids = sorted(first.values())
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    got = spotsigs.similar(prints.where(F.col("doc_id").isin(ids)), 0.6).collect()
    assert len(want) > 5 and {(r.doc_id, r.other_id) for r in got} == want and len(got) == len(want)


def test_mixture_counts_and_order(spark):
    docs = odd_documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c not in ("copy", "rate")] + ["copy", "rate", "shuffle_key"]
    sizes = Counter()
    for r in odd_rows():
        sizes[r[3]] += len(r[1] or "")
    used = [s for s, n in sizes.items() if n]
    rate = {s: sum(sizes.values()) / len(used) / sizes[s] for s in used}
    times = Counter((r.doc_id, r.text) for r in mixed.collect())
    for (i, text), rows in Counter((r[0], r[1]) for r in odd_rows()).items():
        source = next(r[3] for r in odd_rows() if (r[0], r[1]) == (i, text))
        u = int(hashlib.sha256(f"20|{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        lam, k, below = rate.get(source, 0.0), 0, 0.0
        while True:
            below += math.exp(-lam + k * math.log(lam) - math.lgamma(k + 1)) if lam else 1.0
            if below > u:
                break
            k += 1
        assert times[(i, text)] == k * rows
    assert mixing.mix(no_documents(spark)).isEmpty()


def test_weights_and_target(spark):
    rows = [(i, "x" * 10, "big" if i % 10 else "small") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    shares = {r.source: r["count"] for r in mixing.mix(df, {"big": 1.0, "small": 3.0, "absent": 9.0}, target=80000).groupBy("source").count().collect()}
    assert shares["small"] == pytest.approx(6000, rel=0.06) and shares["big"] == pytest.approx(2000, rel=0.06)
    large = mixing.mix(df.where("doc_id = 0"), target=1e4).count()
    assert 800 < large < 1200  # a rate of 1000 does not underflow
