"""SentencePiece by suffix array beside the library's own encoder."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from plenary.llm import pieces, queries
from tests.llm.fixtures import no_documents, odd_documents, odd_rows

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def loaded():
    return pieces.load(queries.PIECE_MODEL)


def random_texts(n=400):
    rng = random.Random(1)
    return ["".join(rng.choice("ab cdé\n the中😀1-_  ") for _ in range(rng.randrange(80))) for _ in range(n)]


ODD = ["", " ", "   ", "  a  b\n\tc ", "ﬁ①", "<s> </s> <0x41> <unk>", "中文字符測試😀", "a" * 3000, "ab" * 700 + " x", "x" * 5 + " " * 40 + "y", "\x00\x01z", "trail "]


def test_same_ids_as_the_library(model, loaded):
    texts = ODD + random_texts() + [r[1] for r in odd_rows() if r[1]]
    ids, offsets = pieces.encode_batch(pa.array(texts), loaded)
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == model.encode(text), text[:50]
    data, bounds = pieces.decode_batch(ids, offsets, loaded)
    assert [data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])] == texts


def test_slices_and_heap_give_the_same(model, loaded, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE_BYTES", 50)
    monkeypatch.setattr(pieces, "LONG", 6)
    texts = ODD + random_texts(60)
    ids, offsets = pieces.encode_batch(pa.array(texts), loaded)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [model.encode(t) for t in texts]


def test_occurrences_beside_a_plain_search():
    text = b"abcabcabcabcabcabcabc\0xabcdefghijklmnopqrstuvwxyz"
    items = [b"a", b"abc", b"abcabcabc", b"abcabcabcabcabcabca", b"ghijklmnopqrstuvw", b"zz", b"bcd"]
    place, number = pieces.SuffixArray(np.frombuffer(text, np.uint8)).occurrences(pieces.Patterns(items))
    want = sorted((i, k) for k, p in enumerate(items) for i in range(len(text)) if text.startswith(p, i))
    assert sorted(zip(place.tolist(), number.tolist())) == want


def test_tables_round_trip(spark, model):
    docs = odd_documents(spark)
    encoded = pieces.encode(docs, queries.PIECE_MODEL)
    assert encoded.columns == [*docs.columns, "ids", "round_trip"]
    decoded = pieces.decode(encoded, queries.PIECE_MODEL)
    rows = decoded.collect()
    assert len(rows) == docs.count() and all(r.round_trip and r.decoded == (r.text or "") for r in rows)
    assert all(r.ids == model.encode(r.text or "") for r in rows)
    assert pieces.encode(no_documents(spark), queries.PIECE_MODEL).isEmpty()


def test_the_mark_itself_counts_as_a_blank(spark):
    df = spark.createDataFrame([("a▁b", "old")], "text string, ids string")
    row = pieces.decode(pieces.encode(df, queries.PIECE_MODEL), queries.PIECE_MODEL).first()
    assert row.decoded == "a b" and row.round_trip is False


def test_a_batch_stays_within_its_memory(loaded):
    """Two tasks of an executor hold a batch each beside Spark's own memory."""
    rng = np.random.default_rng(3)
    lexicon = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(2, 10, 40_000)]
    body = " ".join(lexicon[k] for k in rng.zipf(1.3, 1_500_000) % len(lexicon)).encode()[: pieces.BATCH_BYTES]
    text = pa.array([body[a: a + 2000].decode() for a in range(0, len(body), 2000)])
    tracemalloc.start()
    try:
        ids, offsets = pieces.encode_batch(text, loaded)
        same = pieces.round_trip(text, *pieces.decode_batch(ids, offsets, loaded))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert same.all() and len(text) == -(-len(body) // 2000) and len(body) == pieces.BATCH_BYTES
    assert peak < 150 << 20, peak
