"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

A text is its set of five-word shingles. A shingle weighs its count times the summed inverse document frequency of
its words. Consistent weighted sampling draws, per hash function, one shingle so that two texts draw the same with a
probability of their weighted Jaccard similarity. Draws are banded; texts that share a band are candidates, and
candidates are verified by their exact weighted Jaccard similarity. Classes are the connected components of the
verified pairs.

Copies collapse to one text first. In every bucket the text with the most bucket mates is compared with all others,
which joins nearly all of a large group without its pairs. Where a bucket still holds several classes, the texts
outside its greatest class are compared with every text of another class, in units of bounded size. So each pair of
candidates is either verified or already connected, and no bucket is cut short.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from plenary.llm import tokens
from plenary.llm.columns import shield
from plenary.llm.components import components
from plenary.operators.index import materialize

WORDS, LEAST = 5, 0.8
SLACK = 1e-6
UNIT = 512  # texts of either side that are compared in one unit
BANDS, ROWS = 16, 4
# Words in a smaller share of the documents all weigh the same: the table of words is bounded, and a few rare words
# that an edit brought in do not outweigh the rest of a copy.
RARE = 5e-2

_TABLE_BITS = 15
_rng = np.random.default_rng(977)


def _gamma(n: int) -> np.ndarray:
    return -np.log(_rng.random(n) * _rng.random(n) + 1e-300)


# Variates of the sampling (two gammas and a uniform) by a hash of hash function and shingle.
_RATE = np.maximum(_gamma(1 << _TABLE_BITS), 1e-3).astype(np.float32)
_SHIFT = _rng.random(1 << _TABLE_BITS).astype(np.float32)
_LOG_SCALE = np.log(np.maximum(_gamma(1 << _TABLE_BITS), 1e-30)).astype(np.float32)
_SPIN = _rng.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)


def shingles(column: pa.Array, words: np.ndarray, idf: np.ndarray, rarest: float, n: int = WORDS):
    """(first row, end row, shingle hashes, weights, offsets): distinct shingles of each text, ascending.

    `words` (ascending hashes) have the weight `idf`; all others have `rarest`.
    """
    for row, end, data, starts in tokens.chunks(pc.utf8_lower(column.fill_null(""))):
        _, _, word, offsets = tokens.find_words(data, starts)
        weight = np.full(len(word), rarest, np.float32)
        if len(words):
            at = np.minimum(np.searchsorted(words, word), len(words) - 1)
            known = words[at] == word
            weight[known] = idf[at[known]]
        gram, bounds = tokens.grams(word, offsets, n)
        total = np.concatenate([[0], np.cumsum(weight, dtype=float)])
        size = np.minimum(np.diff(offsets), n)
        first = np.repeat(offsets[:-1] - bounds[:-1], np.diff(bounds)) + np.arange(len(gram))
        value = (total[first + np.repeat(size, np.diff(bounds))] - total[first]).astype(np.float32)
        doc = tokens.owner(bounds)
        order = np.lexsort((gram, doc))
        gram, value = gram[order], value[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        summed = np.add.reduceat(value, at) if len(at) else value
        yield row, end, gram[at], summed, np.searchsorted(doc[at], np.arange(end - row + 1))


def samples(gram: np.ndarray, weight: np.ndarray, offsets: np.ndarray, functions: int = BANDS * ROWS) -> np.ndarray:
    """(text, function): 32-bit names of the drawn (shingle, level) pairs; texts without a shingle have zeros.

    Improved consistent weighted sampling: with gammas r and c and a uniform b of the function and the shingle,
    t = floor(ln w / r + b), and the shingle with the least ln c - r (t - b + 1) is drawn, together with t.
    """
    out = np.zeros((len(offsets) - 1, functions), np.uint32)
    sizes = np.diff(offsets)
    used = np.flatnonzero(sizes)
    at = 0
    while at < len(used):  # some 64k shingles at a time stay in the cache
        stop = max(int(np.searchsorted(offsets[used], offsets[used[at]] + (1 << 16), "right")) - 1, at + 1)
        stop = len(used) if offsets[-1] <= offsets[used[at]] + (1 << 16) else stop
        rows = used[at:stop]
        part = slice(offsets[rows[0]], offsets[rows[-1] + 1])
        h, log_w = gram[part], np.log(weight[part])
        starts, counts = offsets[rows] - offsets[rows[0]], sizes[rows]
        for k in range(functions):
            slot = ((h * _SPIN[k]) >> np.uint64(64 - _TABLE_BITS)).astype(np.int32)
            rate, shift = _RATE[slot], _SHIFT[slot]
            level = np.floor(log_w / rate + shift)
            value = _LOG_SCALE[slot] - rate * (level - shift + 1)
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == np.repeat(least, counts))
            first = hit[np.searchsorted(hit, starts)]  # ties go to the least hash
            name = tokens.mix(h[first] + _SPIN[k] * level[first].astype(np.int64).view(np.uint64))
            out[rows, k] = (name >> np.uint64(32)).astype(np.uint32)
        at = stop
    return out


def band_keys(drawn: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(text, band): a 64-bit hash of the band's number and draws."""
    keys = np.zeros((len(drawn), bands), np.uint64)
    for r in range(rows):
        keys = tokens.mix(keys + drawn[:, r::rows][:, :bands].astype(np.uint64) * np.uint64(2 * r + 3))
    return tokens.mix(keys + np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of least weights over sum of greatest ones, of two ascending sets of shingles."""
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    both = b[at] == a if len(b) else np.zeros(len(a), bool)
    common = float(np.minimum(wa[both], wb[at[both]]).sum(dtype=float))
    union = float(wa.sum(dtype=float) + wb.sum(dtype=float)) - common
    return common / union if union > 0 else 0.0


def text_key(text: Column) -> Column:
    """16 bytes that name a text; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def word_weights(docs: DataFrame, rare: float = RARE) -> tuple[np.ndarray, np.ndarray, float]:
    """(word hashes, their inverse document frequencies, that of all other words), from all documents.

    The weight is ln(1 + N / max(df, rare * N)). A text of w distinct words adds w to the sum of all document
    frequencies, so at most (mean w) / rare words reach `rare * N`; only those come to the driver.
    """

    def count(batches):
        for batch in batches:
            for _, _, data, starts in tokens.chunks(pc.utf8_lower(batch.column(0).fill_null(""))):
                _, _, word, offsets = tokens.find_words(data, starts)
                doc = tokens.owner(offsets)
                order = np.lexsort((doc, word))
                word, doc = word[order], doc[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
                word, n = np.unique(word[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    total = docs.count()
    counts = docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    table = counts.where(F.col("n") >= rare * total).toArrow()
    words = table.column("word").to_numpy().view(np.uint64)
    idf = np.log(1 + total / table.column("n").to_numpy()).astype(np.float32)
    order = np.argsort(words)
    return words[order], idf[order], float(np.log(1 + 1 / rare))


def signatures(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray, float], bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, key, mass, bands): a text's summed shingle weight and band keys, none for a text without a word."""

    def run(batches):
        for batch in batches:
            for row, end, gram, weight, offsets in shingles(batch.column(2), *weights):
                filled = np.diff(offsets) > 0
                keys = band_keys(samples(gram, weight, offsets, bands * rows), bands, rows)
                counts = np.where(filled, bands, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(keys[filled].ravel().view(np.int64)))
                mass = np.bincount(tokens.owner(offsets), weight, end - row)
                yield pa.RecordBatch.from_arrays([*(c.slice(row, end - row) for c in batch.columns[:2]), pa.array(mass), lists], ["doc_id", "key", "mass", "bands"])

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    return rows_in.mapInArrow(run, "doc_id bigint, key binary, mass double, bands array<bigint>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, weights: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """(key, gram, weight): the shingle set of each wanted text, as 32-bit names and 32-bit floats in bytes.

    `wanted` names one row per text by (key, doc_id), so of many copies one text is read on.
    """
    who = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")).alias("who")
    rows = docs.select(text_key(F.col("text")).alias("key"), who, "text")
    names = wanted.select("key", who)
    chosen = rows.join(names.hint("shuffle_hash"), ["key", "who"], "left_semi").dropDuplicates(["key", "who"])

    def run(batches):
        for batch in batches:
            for row, end, gram, weight, offsets in shingles(batch.column(1), *weights):
                name = (gram >> np.uint64(32)).astype(np.uint32)  # ascending like the hashes
                parts = [(name[a:b].tobytes(), weight[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
                grams, values = zip(*parts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(grams, pa.binary()), pa.array(values, pa.binary())], ["key", "gram", "weight"])

    return chosen.select("key", "text").mapInArrow(run, "key binary, gram binary, weight binary")


def _verify(least: float):
    """For one unit: the verified pairs that connect classes not yet connected."""

    def run(table: pa.Table) -> pa.Table:
        keys, labels = table.column("key").to_pylist(), table.column("label").to_pylist()
        left = table.column("left").to_numpy(zero_copy_only=False).astype(bool)
        rest = table.column("rest").to_numpy(zero_copy_only=False).astype(bool)
        band = table.column("band")[0].as_py()
        grams = [np.frombuffer(g, np.uint32) for g in table.column("gram").to_pylist()]
        weights = [np.frombuffer(w, np.float32) for w in table.column("weight").to_pylist()]
        mass = np.array([w.sum(dtype=float) for w in weights])
        bands = np.array(table.column("bands").to_pylist(), np.int64) if band > 0 else None
        right_rows, left_rows = np.flatnonzero(~left), np.flatnonzero(left)
        found: list[tuple[bytes, bytes]] = []
        if len(right_rows) and len(left_rows):
            vocabulary, number = np.unique(np.concatenate(grams), return_inverse=True)
            number = np.split(number, np.cumsum([len(g) for g in grams])[:-1])
            flat, value = np.concatenate([number[i] for i in right_rows]), np.concatenate([weights[i] for i in right_rows])
            sizes = np.array([len(grams[i]) for i in right_rows])
            starts = np.cumsum(sizes) - sizes
            parent = {x: x for x in labels}

            def root(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            dense = np.zeros(len(vocabulary), np.float32)
            for i in left_rows:
                dense[number[i]] = weights[i]
                common = np.add.reduceat(np.minimum(dense[flat], value), starts, dtype=float)
                dense[number[i]] = 0
                fit = common >= (least - SLACK) * (mass[i] + mass[right_rows] - common)
                if bands is not None:  # a pair that shares an earlier band is compared there
                    fit &= ~(bands[right_rows, :band] == bands[i, :band]).any(1)
                for j in right_rows[fit]:
                    if (rest[j] and keys[j] <= keys[i]) or root(labels[i]) == root(labels[j]):
                        continue
                    parent[root(labels[j])] = root(labels[i])
                    found.append((keys[i], keys[j]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})

    return run


def compare(units: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) of units of (unit, left, rest, key, label, band, bands), each left text against all others."""
    return units.join(sets, "key").groupBy("unit").applyInArrow(_verify(least), "a binary, b binary")


def classes(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS, unit: int = UNIT) -> DataFrame:
    """The near-duplicate class of every document.

    Args:
        docs: `doc_id` and `text`; other columns are ignored. Rows may repeat.
        least: weighted Jaccard similarity of near copies.
        bands, rows: bands of so many draws each.
        unit: most texts on either side of a unit of comparison.

    Returns:
        `doc_id`, `key` (of the text), `class_id` (least non-null doc_id of the class), `class_key` and `class_size`
        (documents), one row per row of `docs`. Unlike texts may share a doc_id, so classes may share a class_id;
        `class_key`, the key of the text with the least (doc_id, key), names one class only. Texts without a word, null
        and empty ones included, are alike only if equal.
    """
    weights = word_weights(docs)
    signed = materialize(signatures(docs, weights, bands, rows))
    texts = materialize(signed.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("mass").alias("mass"), F.first("bands").alias("bands")))
    places = texts.select("key", "mass", F.posexplode("bands").alias("band", "bucket"))
    shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(places.join(materialize(shared), "bucket"))  # texts that share a bucket, by bucket
    degrees = materialize(members.groupBy("key").agg(F.sum(F.col("n") - 1).alias("degree")))
    sets = materialize(shingle_sets(docs, degrees.select("key").join(texts.select("key", "doc_id"), "key"), weights))
    # In every bucket, the text with the most bucket mates meets all others whose mass allows the similarity.
    ranked = members.join(degrees, "key")
    pivots = materialize(ranked.groupBy("bucket").agg(F.max(F.struct("degree", "key", "mass")).alias("top")).select(
        "bucket", F.col("top.key").alias("pivot"), F.col("top.mass").alias("pivot_mass")))
    near = F.least("mass", "pivot_mass") >= (least - SLACK) * F.greatest("mass", "pivot_mass")
    star = materialize(members.join(pivots, "bucket").where((F.col("key") != F.col("pivot")) & near).select("pivot", "key").distinct())
    spread = star.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / unit).cast("int").alias("parts"))
    dealt = star.join(materialize(spread), "pivot").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    common = lambda left, rest, label, band, bands: [F.lit(left).alias("left"), F.lit(rest).alias("rest"), label.alias("label"), band.alias("band"), bands.alias("bands")]
    plain = (F.lit(0), F.lit(None).cast("array<bigint>"))
    name = F.struct("pivot", "part").alias("unit")
    first = dealt.select(name, F.col("pivot").alias("key"), *common(True, False, F.col("pivot"), *plain)).distinct().unionByName(
        dealt.select(name, "key", *common(False, False, F.col("key"), *plain)))
    links = materialize(compare(first, sets, least))
    # Buckets that still hold several classes: those outside the greatest class meet all texts of other classes.
    labels = components(links)
    told = members.where("n > 2").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    told = materialize(told.select("bucket", "band", "key", "label", "n"))
    counted = told.groupBy("bucket", "label", "n").agg(F.count(F.lit(1)).alias("held"))
    main = counted.groupBy("bucket", "n").agg(F.max(F.struct("held", "label")).alias("top")).where(F.col("top.held") < F.col("n"))
    main = materialize(main.select("bucket", F.col("top.label").alias("main"), (F.col("n") - F.col("top.held")).alias("outside")))
    open_ = materialize(told.join(main, "bucket").withColumn("rest", F.col("label") != F.col("main")))
    chunk = lambda count: F.ceil(F.col(count) / unit).cast("int")
    mine = lambda count: F.pmod(F.xxhash64("key", "bucket"), chunk(count)).cast("int")
    lefts = open_.where("rest").select("bucket", "band", "key", "label", mine("outside").alias("i"), F.explode(F.sequence(F.lit(0), chunk("n") - 1)).alias("j"), F.lit(True).alias("left"), "rest")
    rights = open_.select("bucket", "band", "key", "label", F.explode(F.sequence(F.lit(0), chunk("outside") - 1)).alias("i"), mine("n").alias("j"), F.lit(False).alias("left"), "rest")
    both = lefts.unionByName(rights).select(F.struct("bucket", "i", "j").alias("unit"), "key", "left", "rest", "label", "band")
    second = materialize(compare(both.join(texts.select("key", "bands"), "key"), sets, least))
    labels = components(links.unionByName(second))
    named = materialize(texts.join(labels, "key", "left").select("key", "doc_id", "copies", F.coalesce("label", "key").alias("label")))
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key"))
    groups = materialize(named.groupBy("label").agg(first.alias("first"), F.sum("copies").alias("class_size")))
    of_text = materialize(named.select("key", "label").join(groups, "label").select(
        "key", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("class_key"), "class_size"))
    return signed.select("doc_id", "key").join(of_text, "key").select("doc_id", "key", "class_id", "class_key", "class_size")


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """One document of each class with all its columns: the least id; of equal ids the least key, then any one row."""
    docs, restore = shield(docs, "doc_id", "text")
    found = classes(docs, **settings)
    named = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    kept = materialize(found.select(named("class_id").alias("_who"), F.col("class_key").alias("_key")).distinct())
    keyed = docs.withColumn("_who", named("doc_id")).withColumn("_key", text_key(F.col("text")))
    return restore(keyed.join(kept.hint("shuffle_hash"), ["_who", "_key"], "left_semi").dropDuplicates(["_who", "_key"]))
