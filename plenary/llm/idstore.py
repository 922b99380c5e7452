"""Token ids in flat files, found again through minimal perfect hashing.

A store is a folder of payload files, index files and two small tables.

* `ids-*.bin`: the ids of whole documents one after another, in ascending order of doc_id over all files, each
  document closed by the end id; little-endian, 2 bytes an id if the vocabulary allows it, else 4. Nothing else.
* `index-*.bin`: for the keys of one bucket a minimal perfect hash, a 32-bit fingerprint of every key, and where its
  document lies. A key is looked up in one file, by a few bit probes and one rank, whatever the size of the store.
* `shards` and `buckets`: Parquet tables that number the payload and index files.

Files carry the number of the task attempt that wrote them. Only attempts that Spark has committed are named in the
tables, so a lost executor leaves a file that nobody reads, never half a document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenary.llm import tokens
from plenary.operators.index import materialize
from plenary.session import checkpoint_dir, input_bytes

SHARD_IDS = 1 << 25  # after which a task begins another payload file
SHARD_BYTES = 64 << 20  # of input for each task that writes
UNKNOWN = 1 << 60  # Spark's size of a table that it knows nothing about is greater
BUCKET_KEYS = 1 << 16  # keys of an index file, on average
READ_BYTES = 4 << 20  # of payload read or sent on at a time; a longer document is read alone
CACHE = 1 << 20  # distinct pieces of text whose ids a worker remembers
SPREAD = 2  # bits of a level for each key that is still without a place
MAGIC = 0x31484D4449


# Text to ids

# White space, letters, digits, punctuation; everything else is of no class.
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_CLASS = np.array([_SPACE if tokens.SPACES[b] else _OTHER if b < 33 or b > 126 else _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _MARK for b in range(256)], np.uint8)
_PLAIN = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]+)")  # one word, whatever its surroundings
# Byte-level BPE writes printable bytes as they are and the others, in order, as the characters from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def pieces(data: np.ndarray, starts: np.ndarray, fine: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of stretches of texts that byte-level BPE encodes by themselves.

    Its rule for words never joins white space to what stands before, so a text may be cut before any white space that
    follows another character. Nor does it join letters, digits and punctuation, but for an apostrophe before letters.
    Cuts are made at ASCII white space, where no Unicode white space may precede it, and (`fine`) between classes.
    """
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # accented Latin letters
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    before, after = kind[:-1], kind[1:]
    cut = np.zeros(len(data) + 1, bool)
    at = np.flatnonzero((after == _SPACE) & (before != _SPACE)) + 1
    second, third = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    wide = (second == 0xC2) & np.isin(data[at - 1], [0x85, 0xA0])
    wide |= np.isin(third, [0xE1, 0xE2, 0xE3]) & np.isin(second, [0x80, 0x81, 0x9A])
    cut[at[~wide]] = True
    if fine:
        named = lambda k: (k >= _LETTER) & (k <= _MARK)
        cut[1:-1] |= named(before) & named(after) & (before != after) & (data[:-1] != ord("'"))
    cut[starts] = True
    border = np.flatnonzero(cut)
    return border[:-1], border[1:]


class Encoder:
    """The library's ids of texts. Every distinct piece is encoded once and remembered, by a 64-bit hash of its bytes."""

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        # Texts are cut only for tokenizers of the kind that `pieces` describes, and not within an added token.
        self.cuts, self.added = _is_byte_level(tokenizer_file)
        self.names, self.sizes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, names: np.ndarray, texts: list[bytes]) -> None:
        lists: list = [None] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if self.cuts and _PLAIN.fullmatch(text):  # the model alone; the rule for words has nothing to cut
                lists[i] = [t.id for t in self.model.tokenize(text.decode("latin-1").translate(_WRITTEN))]
            else:
                rest.append(i)
        for at in range(0, len(rest), 4096):
            some = rest[at: at + 4096]
            for i, found in zip(some, self.tokenizer.encode_batch_fast([texts[i].decode() for i in some], add_special_tokens=False)):
                lists[i] = found.ids
        if len(self.names) + len(names) > CACHE:
            self.names, self.sizes, self.places, self.pool = self.names[:0], self.sizes[:0], self.places[:0], self.pool[:0]
        sizes = np.array([len(x) for x in lists], np.int64)
        places = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))])
        seat = np.searchsorted(self.names, names)  # both ascending
        self.names, self.sizes, self.places = (np.insert(x, seat, y) for x, y in ((self.names, names), (self.sizes, sizes), (self.places, places)))

    def encode(self, data: np.ndarray, starts: np.ndarray, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has); `last` closes every text, also an empty one."""
        body = data.tobytes()
        if self.cuts:
            begin, end = pieces(data, starts, not any(a in body for a in self.added))
        else:
            begin, end = (x[np.diff(starts) > 0] for x in (starts[:-1], starts[1:]))
        sizes = places = np.zeros(0, np.int64)
        if len(begin):
            name, first, which = np.unique(tokens.stretch_hashes(data, begin, end), return_index=True, return_inverse=True)
            new = np.ones(len(name), bool)
            if len(self.names):
                new = self.names[np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)] != name
            if new.any() and len(self.names) + new.sum() > CACHE:
                new[:] = True  # the memory is emptied, so all pieces of this stretch are needed
            if new.any():
                rows = first[new]
                self._learn(name[new], [body[b:e] for b, e in zip(begin[rows].tolist(), end[rows].tolist())])
            seat = np.searchsorted(self.names, name)
            sizes, places = self.sizes[seat][which], self.places[seat][which]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        of_text = bounds[np.searchsorted(begin, starts)]
        ids = self.pool[np.repeat(places - bounds[:-1], sizes) + np.arange(bounds[-1])]
        if last is None:
            return ids, np.diff(of_text)
        return np.insert(ids, of_text[1:], np.uint32(last)), np.diff(of_text) + 1


@lru_cache(2)
def encoder(tokenizer_file: str) -> Encoder:
    """One encoder for each worker process, so that tasks go on with what earlier ones remember."""
    return Encoder(tokenizer_file)


def _is_byte_level(tokenizer_file: str) -> tuple[bool, list[bytes]]:
    """Whether the tokenizer is plain byte-level BPE, and its added tokens, which stand for themselves in any text."""
    with open(tokenizer_file, encoding="utf-8") as file:
        found = json.load(file)
    way, added = found.get("pre_tokenizer") or {}, [t for t in found.get("added_tokens") or []]
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or any(c.isspace() for c in t["content"]) for t in added)
    kind = found["model"].get("type") == "BPE" and way.get("type") == "ByteLevel" and way.get("use_regex", True) and not way.get("add_prefix_space")
    return bool(plain and kind and not found.get("normalizer")), [t["content"].encode() for t in added]


# Keys to rows

def _probe(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
    return (tokens.mix(one + tokens.mix(two + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64)))) % np.uint64(size)).astype(np.int64)


def key_halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


class PerfectHash:
    """Minimal perfect hash of 128-bit keys: n different keys take the rows 0 to n - 1.

    Level by level, every key that has a bit for itself gets it; the others try the next level. A key's row is the
    number of bits before its own.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, one: np.ndarray, two: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        while len(one):
            if len(sizes) == 64:
                raise ValueError("keys must differ")
            size = -(-SPREAD * len(one) // 64) * 64
            at = _probe(one, two, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little"))
            again = ~alone[at]
            one, two = one[again], two[again]
        words = np.concatenate(parts).view(np.uint64) if parts else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), words)

    def rows(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The row of each key; -1 or any row for a key that is not one of those hashed."""
        result, open_, base = np.full(len(one), -1, np.int64), np.arange(len(one)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + _probe(one[open_], two[open_], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            rank = self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            result[open_[hit]] = rank[hit]
            open_, base = open_[~hit], base + size
        return result


def write_index(one: np.ndarray, two: np.ndarray, columns: list[np.ndarray]) -> bytes:
    """The bytes of an index file: header, level sizes, bits, fingerprints, then the columns in the order of the rows."""
    hashed = PerfectHash.of(one, two)
    order = np.argsort(hashed.rows(one, two))
    head = np.array([MAGIC, len(one), len(hashed.sizes), len(hashed.words), len(columns)], "<i8")
    return b"".join([head.tobytes(), hashed.sizes.astype("<i8").tobytes(), hashed.words.astype("<u8").tobytes(),
                     two[order].astype("<u4").tobytes(), *[c[order].astype("<i8").tobytes() for c in columns]])


class Index:
    """An index file that has been read."""

    def __init__(self, body: bytes):
        magic, self.keys, levels, words, columns = np.frombuffer(body, "<i8", 5).tolist()
        if magic != MAGIC:
            raise ValueError("not an index file")
        at = 40
        sizes, at = np.frombuffer(body, "<i8", levels, at), at + 8 * levels
        bits, at = np.frombuffer(body, "<u8", words, at), at + 8 * words
        self.marks, at = np.frombuffer(body, "<u4", self.keys, at), at + 4 * self.keys
        self.columns = np.frombuffer(body, "<i8", columns * self.keys, at).reshape(columns, self.keys)
        self.hashed = PerfectHash(sizes, bits)

    def find(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are there, their columns). A strange key passes its fingerprint once in 2^32 times."""
        rows = self.hashed.rows(one, two)
        there = rows >= 0
        there[there] = self.marks[rows[there]] == two[there].astype(np.uint32)
        return there, self.columns[:, rows[there]]


# The store

def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI and the folder's path on it."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return (pafs.LocalFileSystem(), folder) if "://" not in folder else pafs.FileSystem.from_uri(folder)


def hashed_key(doc_id: Column, copy: Column) -> Column:
    """16 bytes for a document's key: its id, and which of the rows with that id it is."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("/"), copy.cast("string"))))


@dataclass
class Store:
    """`shards`: (shard, file, ids, base, documents); `buckets`: (bucket, file, keys)."""

    folder: str
    shards: DataFrame
    buckets: DataFrame
    count: int  # of buckets
    width: int  # bytes of an id


def _payload(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, width: int) -> DataFrame:
    """(doc_id, shard, file, row, offset, n): where each document was written, stored."""

    def run(batches):
        disk, root = filesystem(folder)
        context, texts = TaskContext.get(), encoder(tokenizer_file)
        number, out, written, row = 0, None, 0, 0
        for batch in batches:
            for first, stop, data, starts in tokens.chunks(batch.column(1)):
                if out is None:
                    name = f"ids-{context.partitionId():07d}-{number:04d}-{context.taskAttemptId()}.bin"
                    out, written, row = disk.open_output_stream(f"{root}/{name}"), 0, 0
                ids, counts = texts.encode(data, starts, end_id)
                out.write(ids.astype(f"<u{width}").tobytes())
                n = stop - first
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(np.full(n, (context.partitionId() << 20) + number)), pa.array([name] * n),
                    pa.array(np.arange(row, row + n)), pa.array(written + np.cumsum(counts) - counts), pa.array(counts)],
                    ["doc_id", "shard", "file", "row", "offset", "n"])
                written, row = written + len(ids), row + n
                if written >= SHARD_IDS:
                    out.close()
                    out, number = None, number + 1
        if out is not None:
            out.close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts, size = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(rows)
    if size < UNKNOWN:
        parts = max(parts, -(-size // SHARD_BYTES))
    # Equal ids are ordered by their texts; rows alike in both are dealt out by their places in the input.
    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    order = ["doc_id", "_tie", "_row"]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return materialize(ranged.mapInArrow(run, "doc_id bigint, shard bigint, file string, row bigint, offset bigint, n bigint"))


def build(docs: DataFrame, tokenizer_file: str, end_id: int, folder: str | None = None, bucket_keys: int = BUCKET_KEYS) -> tuple[Store, DataFrame]:
    """Writes all texts as token ids, with an index of their keys.

    Args:
        docs: `doc_id`, `text`; other columns are ignored. A null text is empty. Null ids come first.
        tokenizer_file: of the tokenizers library; no special tokens are added.
        end_id: closes every document, an empty one too.
        folder: on a file system that all executors share; by default a new one beside the checkpoints.
        bucket_keys: keys of an index file on average.

    Returns:
        The store and its keys (`doc_id`, `copy`), one per row of `docs`. Rows that share an id are numbered by
        `copy` from 0, in the order of a hash of their texts; identical rows are stored as often as they occur. An
        empty table makes a store without files.
    """
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/idstore-{uuid.uuid4().hex}"
    disk, root = filesystem(folder)
    disk.create_dir(root, recursive=True)
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    places = _payload(docs, folder, tokenizer_file, end_id, width)
    # One row for every payload file, at most one file for each SHARD_BYTES of input or task.
    files = places.groupBy("shard").agg(F.first("file"), F.sum("n"), F.count(F.lit(1))).orderBy("shard").collect()
    starts, rows = [0, *accumulate(f[2] for f in files)], [0, *accumulate(f[3] for f in files)]
    schema = "shard bigint, file string, ids bigint, base bigint, documents bigint, documents_before bigint"
    numbered = [(f[0], f[1], f[2], starts[i], f[3], rows[i]) for i, f in enumerate(files)]
    spark.createDataFrame(pa.Table.from_pylist([dict(zip(["shard", "file", "ids", "base", "documents", "documents_before"], r)) for r in numbered], _arrow(schema))).write.parquet(f"{folder}/shards")
    shards = spark.read.schema(schema).parquet(f"{folder}/shards")
    # Which of the rows with one id: its place among all documents less that of the first of them.
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    placed = places.drop("file").join(shards.select("shard", "base", "documents_before"), "shard").select(
        "doc_id", name.alias("name"), "shard", "offset", "n", (F.col("base") + F.col("offset")).alias("start"), (F.col("documents_before") + F.col("row")).alias("place"))
    repeated = materialize(placed.groupBy("name").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("name", "first"))
    counted = placed.join(repeated, "name", "left").withColumn("copy", F.coalesce(F.col("place") - F.col("first"), F.lit(0)))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows[-1] // bucket_keys))
    keyed = counted.select("doc_id", "copy", hashed_key(F.col("doc_id"), F.col("copy")).alias("key"), "shard", "start", "offset", "n")
    keyed = materialize(keyed.withColumn("bucket", F.crc32("key") % buckets))

    def index(table: pa.Table) -> pa.Table:
        disk, root = filesystem(folder)
        bucket = table.column("bucket")[0].as_py()
        name = f"index-{bucket:09d}-{TaskContext.get().taskAttemptId()}.bin"
        columns = [table.column(c).to_numpy() for c in ("shard", "start", "offset", "n")]
        with disk.open_output_stream(f"{root}/{name}") as out:
            out.write(write_index(*key_halves(table.column("key").to_pylist()), columns))
        return pa.table({"bucket": [bucket], "file": [name], "keys": [table.num_rows]})

    made = keyed.select("bucket", "key", "shard", "start", "offset", "n").groupBy("bucket").applyInArrow(index, "bucket bigint, file string, keys bigint")
    made.write.parquet(f"{folder}/buckets")
    return Store(folder, shards, spark.read.schema("bucket bigint, file string, keys bigint").parquet(f"{folder}/buckets"), buckets, width), keyed.select("doc_id", "copy")


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def locate(store: Store, keys: DataFrame) -> DataFrame:
    """(doc_id, copy, shard, start, offset, n) of keys (doc_id, copy), found through the index; keys that are not there are left out."""
    asked = keys.select("doc_id", "copy", hashed_key(F.col("doc_id"), F.col("copy")).alias("key"))
    asked = asked.withColumn("bucket", F.crc32("key") % store.count).join(store.buckets.select("bucket", "file"), "bucket")
    folder = store.folder

    def run(batches):
        disk, root = filesystem(folder)
        file, index = None, None
        for batch in batches:
            names = batch.column(3).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else [0]
            one, two = key_halves(batch.column(2).to_pylist())
            for low, high in zip(edges, edges[1:]):
                if names[low] != file:
                    file = names[low]
                    with disk.open_input_stream(f"{root}/{file}") as stream:
                        index = Index(stream.read())
                there, columns = index.find(one[low:high], two[low:high])
                mine = batch.slice(low, high - low).filter(pa.array(there))
                yield pa.RecordBatch.from_arrays([mine.column(0), mine.column(1), *[pa.array(c) for c in columns]], ["doc_id", "copy", "shard", "start", "offset", "n"])

    dealt = asked.repartition("bucket").sortWithinPartitions("file").select("doc_id", "copy", "key", "file")
    return dealt.mapInArrow(run, "doc_id bigint, copy bigint, shard bigint, start bigint, offset bigint, n bigint")


def fetch(store: Store, keys: DataFrame) -> DataFrame:
    """The documents of some keys, read back from the payload files.

    Args:
        keys: `doc_id` and `copy` (0 where ids are unique); repeated keys give repeated rows.

    Returns:
        `doc_id`, `copy`, `start` (ids of all documents before it), `n_tokens` (with the end id) and `ids`, in
        little-endian unsigned 32-bit integers. Keys that are not in the store give no row.
    """
    found = materialize(locate(store, keys)).join(store.shards.select("shard", "file"), "shard")
    folder, width = store.folder, store.width

    def run(batches):
        disk, root = filesystem(folder)
        name, source = None, None
        for batch in batches:
            files, offsets, counts = batch.column(3).to_pylist(), batch.column(4).to_numpy(), batch.column(5).to_numpy()
            at = 0
            while at < len(files):
                # Neighbouring documents of one file are read together.
                stop, held = at + 1, int(counts[at])
                while stop < len(files) and files[stop] == files[at] and offsets[stop] == offsets[at] + held and (held + counts[stop]) * width <= READ_BYTES:
                    held, stop = held + int(counts[stop]), stop + 1
                if files[at] != name:
                    name = files[at]
                    source = disk.open_input_file(f"{root}/{name}")
                body = np.frombuffer(source.read_at(held * width, int(offsets[at]) * width), f"<u{width}").astype("<u4")
                bounds = 4 * np.concatenate([[0], np.cumsum(counts[at:stop])])
                ids = pa.Array.from_buffers(pa.binary(), stop - at, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(body)])
                rows = batch.slice(at, stop - at)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), rows.column(5), ids], ["doc_id", "copy", "start", "n_tokens", "ids"])
                at = stop

    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartitionByRange(parts, "shard", "offset").sortWithinPartitions("shard", "offset").select("doc_id", "copy", "start", "file", "offset", "n")
    return dealt.mapInArrow(run, "doc_id bigint, copy bigint, start bigint, n_tokens bigint, ids binary")


def open_store(spark: SparkSession, folder: str, width: int) -> Store:
    """A store that was built before."""
    shards, buckets = spark.read.parquet(f"{folder}/shards"), spark.read.parquet(f"{folder}/buckets")
    return Store(folder, shards, buckets, (buckets.agg(F.max("bucket")).first()[0] or 0) + 1, width)


class Reader:
    """Keyed access without Spark: one index file and one read of the payload for each document."""

    def __init__(self, store: Store):
        self.disk, self.root = filesystem(store.folder)
        self.count, self.width = store.count, store.width
        self.shards = {r["shard"]: r["file"] for r in store.shards.select("shard", "file").toLocalIterator()}
        self.buckets = {r["bucket"]: r["file"] for r in store.buckets.select("bucket", "file").toLocalIterator()}
        self.index = lru_cache(64)(self._index)

    def _index(self, bucket: int) -> Index | None:
        if bucket not in self.buckets:
            return None
        with self.disk.open_input_stream(f"{self.root}/{self.buckets[bucket]}") as stream:
            return Index(stream.read())

    def ids(self, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
        """The ids of a document, None if the store does not hold it."""
        key = hashlib.md5(f"{'-' if doc_id is None else doc_id}/{copy}".encode()).digest()
        index = self.index(zlib.crc32(key) % self.count)
        if index is None:
            return None
        there, columns = index.find(*key_halves([key]))
        if not there[0]:
            return None
        shard, _, offset, n = columns[:, 0].tolist()
        with self.disk.open_input_file(f"{self.root}/{self.shards[shard]}") as source:
            return np.frombuffer(source.read_at(n * self.width, offset * self.width), f"<u{self.width}")
