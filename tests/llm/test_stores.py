"""Token-id store, periodic runs and Merkle proofs beside plain versions of them."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plenary.llm import idstore, merkle, queries, runs, tokens
from tests.conftest import SMALL
from tests.llm.fixtures import no_documents, odd_documents, odd_rows

BPE = queries.byte_bpe()


# Token ids

def plain_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids + [queries.END_ID]


def encoded(encoder, texts, size):
    out = []
    for _, _, data, starts in tokens.chunks(pa.array(texts), size):
        ids, counts = encoder.encode(data, starts, queries.END_ID)
        out += [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=list("ab cZ\n\t\r\x0b\x1c\x85\xa0　​'s,-é×中😀.12́"), max_size=40), min_size=1, max_size=20))
def test_pieces_have_the_ids_of_whole_texts(texts):
    found = encoded(idstore.Encoder(BPE), texts, 200)
    assert found == [plain_ids(t) for t in texts]


def test_added_tokens_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(idstore, "CACHE", 16)
    texts = ["a <|endoftext|>b", "it's<|endoftext|>", "", "one two three four five six", "seven eight nine ten one two"] * 5
    assert encoded(idstore.Encoder(BPE), texts, 60) == [plain_ids(t) for t in texts]


@pytest.mark.parametrize("count", [0, 1, 2, 63, 1000, 20000])
def test_minimal_perfect_hash(count):
    rng = np.random.default_rng(count)
    one, two = rng.integers(0, 1 << 63, (2, count), dtype=np.uint64)
    body = idstore.write_index(one, two, [np.arange(count), np.arange(count) * 3])
    index = idstore.Index(body)
    assert sorted(index.hashed.rows(one, two)) == list(range(count))
    there, columns = index.find(one, two)
    assert there.all() and (columns[0] == np.arange(count)).all() and (columns[1] == 3 * np.arange(count)).all()
    strange = rng.integers(0, 1 << 63, (2, 1000), dtype=np.uint64)
    assert not index.find(*strange)[0].any()


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        idstore.PerfectHash.of(np.array([5, 5], np.uint64), np.array([7, 7], np.uint64))


def test_store_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(idstore, "SHARD_IDS", 2000)
    store, keys = idstore.build(odd_documents(spark), BPE, queries.END_ID, bucket_keys=8)
    got = sorted(((r.doc_id is not None, r.doc_id, r.copy), r) for r in idstore.fetch(store, keys).collect())
    start = 0
    for _, r in got:
        assert r.start == start and len(r.ids) == 4 * r.n_tokens
        start += r.n_tokens
    seen = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for _, r in got)
    assert seen == sorted((str(r[0]), plain_ids(r[1])) for r in odd_rows())
    assert store.shards.count() > 1 and store.shards.agg(F.sum("ids")).first()[0] == start
    # Single documents, without Spark, and keys that are not there.
    reader = idstore.Reader(store)
    for _, r in got:
        assert reader.ids(r.doc_id, r.copy).tolist() == np.frombuffer(r.ids, "<u4").tolist()
    assert reader.ids(10 ** 9) is None and reader.ids(0, 7) is None
    asked = spark.createDataFrame([(3, 0), (3, 0), (-5, 0), (2, 1), (None, 0)], "doc_id bigint, copy bigint")
    assert sorted((str(r.doc_id), r.copy) for r in idstore.fetch(store, asked).collect()) == [("2", 1), ("3", 0), ("3", 0), ("None", 0)]
    again = idstore.open_store(spark, store.folder, store.width)
    assert idstore.fetch(again, asked).count() == 4


def test_store_of_the_documents(spark):
    got = {r.doc_id: r for r in queries.op11_idstore(spark, SMALL).collect()}
    docs = {r.doc_id: r.text for r in queries.table(spark, SMALL, "documents").collect()}
    assert got.keys() == docs.keys()
    start = 0
    for doc_id in sorted(docs):
        ids = plain_ids(docs[doc_id])
        assert (got[doc_id].start, got[doc_id].n_tokens) == (start, len(ids))
        assert got[doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_empty_store(spark):
    store, keys = idstore.build(no_documents(spark), BPE, queries.END_ID)
    assert keys.isEmpty() and idstore.fetch(store, keys).isEmpty() and idstore.Reader(store).ids(1) is None


# Periodic runs

def plain_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.randrange(2) for _ in range(rng.randrange(200))]
    if kind == 1:
        part = [rng.randrange(2) for _ in range(rng.randint(1, 12))]
        lead = [rng.choice(part) for _ in range(rng.randrange(30))]
        return lead + part * rng.randint(2, 9) + lead + part * rng.randint(1, 6) + part[: rng.randrange(len(part))]
    if kind == 2:
        a, b = [0], [0, 1]
        for _ in range(rng.randint(2, 9)):
            a, b = b, b + a
        return b
    if kind == 3:
        word = [0]
        for _ in range(rng.randint(2, 6)):
            word = word + [rng.randrange(2)] * rng.randint(1, 3) + word
        return word
    return [rng.randrange(4)] * rng.randrange(90)


@pytest.mark.parametrize("least", [6, 8, 12])
def test_runs_beside_a_plain_search(least):
    rng = random.Random(least)
    for _ in range(400):
        words = repetitive(rng)
        start, end, period = runs.find_runs(np.array([*(w + 5 for w in words), 99], np.uint64), least)
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == plain_runs(words, least)


def test_range_successor():
    rng = np.random.default_rng(2)
    values = rng.permutation(500)
    tree = runs.RangeSuccessor(values, 500)
    low = rng.integers(0, 499, 200)
    high = low + rng.integers(1, 500 - low + 1)
    bound = rng.integers(0, 700, 200)
    below = tree.below(low, high, bound)
    assert below.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
    rank = rng.integers(0, high - low)
    assert tree.smallest(low, high, rank).tolist() == [int(np.sort(values[a:b])[r]) for a, b, r in zip(low, high, rank)]


def by_id(rows):
    return sorted(rows, key=lambda r: tuple(str(x) for x in r))


def test_runs_of_odd_texts(spark):
    rng = random.Random(9)
    rows = [(r[0], r[1], r[2]) for r in odd_rows()] + [(500 + i, "\t ".join(f"w{w}" for w in repetitive(rng)), None) for i in range(60)]
    rows += [(900, "so " * 20000, "en"), (901, "so " * 20000, "en"), (901, "so " * 20000, "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    got = by_id((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(df).collect())
    want = []
    for doc_id, text, _ in rows:
        words = (text or "").encode().split()
        words = [w.decode() for w in words]
        found = plain_runs(words) if len(words) < 5000 else [(0, len(words), 1)]
        want.append((doc_id, len(words), found, plain_collapsed(words, found)))
    assert got == by_id((d, n, f, c) for d, n, f, c in want)


def test_runs_of_the_documents(spark):
    got = {r.doc_id: r for r in queries.op12_runs(spark, SMALL).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    seen = 0
    for doc in queries.table(spark, SMALL, "documents").collect():
        words, h = [w.decode() for w in (doc.text or "").encode().split()], zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found, r = plain_runs(words), got[doc.doc_id]
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == digest("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == digest(plain_collapsed(words, found))
        seen += len(found)
    assert seen > 5


# Merkle proofs

def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([merkle.digest_of(levels[-1][i: i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


@pytest.mark.parametrize("count", [1, 2, 3, 4, 10, 27, 28, 100])
def test_multiproof_needs_no_more_than_it_must(count):
    rng = random.Random(count)
    levels = plain_levels([merkle.digest_of([str(i)]) for i in range(count)])
    for _ in range(20):
        held = sorted(rng.sample(range(count), rng.randint(1, count)))
        wanted = merkle.missing(held, count)
        derivable = [set(held)]
        for level in levels[1:]:
            derivable.append({i // 3 for i in derivable[-1]})
        assert len(wanted) == len(set(wanted)) and not any(i in derivable[level] for level, i in wanted)
        known = merkle.derive({i: levels[0][i] for i in held}, count, {c: levels[c[0]][c[1]] for c in wanted})
        assert known[-1] == {0: levels[-1][0]}
        for i in held:
            assert merkle.fold(levels[0][i], merkle.siblings(known, i, count)) == levels[-1][0]


def plain_proofs(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root) of (doc_id, group, leaf, other) rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[g] = plain_levels([r[2] for r in groups[g]])
    top = plain_levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            proof, node = [], r[3]
            for levels, at in ((trees[g], i), (top, k)):
                for level in levels[:-1]:
                    run = range(at - at % 3, min(at - at % 3 + 3, len(level)))
                    proof += [level[j] for j in run if j != at]
                    node = merkle.digest_of([node if j == at else level[j] for j in run])
                    at //= 3
            out.append((r[0], r[2], trees[g][-1][0], top[-1][0], proof, node))
    return out


@pytest.mark.parametrize("groups", [1, 2, 40])
def test_proofs_beside_a_plain_tree(spark, monkeypatch, groups):
    rng = random.Random(groups)
    digest = lambda x: hashlib.sha256(str(x).encode()).hexdigest()
    rows = []
    for i in range(2600):
        group = None if i % 53 == 0 else f"g{0 if rng.random() < 0.5 else rng.randrange(groups)}é"
        rows.append((None if i % 71 == 0 else i // 2, group, digest(i), digest(i if i % 3 else -i)))
    rows += [rows[5], rows[5]]
    got = merkle.prove(spark.createDataFrame(rows, "doc_id bigint, `group` string, leaf string, other string")).collect()
    want = plain_proofs(rows)
    assert by_id((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in got) == by_id(want)
    assert all(r.verified == (r.folded_root == r.root) for r in got) and {r.verified for r in got} == {True, False}


def test_leaves_of_odd_documents(spark):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    got = odd_documents(spark).select("doc_id", merkle.leaf(*map(F.col, columns)).alias("leaf")).collect()
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = [(r[0], merkle.digest_of([text(v) for v in (r[0], r[3], r[2], r[4], r[1])])) for r in odd_rows()]
    assert by_id(tuple(r) for r in got) == by_id(want)


def test_no_leaves(spark):
    assert merkle.prove(spark.createDataFrame([], "doc_id bigint, `group` string, leaf string, other string")).isEmpty()
    assert runs.periodic_runs(no_documents(spark)).isEmpty()
