"""Document fingerprints: SpotSigs.

Wherever a common word (an anchor) stands, the chain of content words that follow it is a signature; a text's
fingerprint is its set of signatures. Two fingerprints are alike by their Jaccard coefficient. Sets of very unequal
length cannot be alike, so they are partitioned by length, only partitions within reach of each other meet, and a
comparison stops once the threshold is out of reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from plenary.llm import tokens
from plenary.operators.index import materialize

# Articles, prepositions and forms of "to be" in English, German, French and Spanish.
ANCHORS = """a an the of to in is was be by with for and that this
der die das den dem des ein eine und ist zu mit von auf
le la les un une des de du et est dans par pour que
el los las una y es en con por para del""".split()
CHAIN, DISTANCE = 3, 1
ROUNDING = 1e-9


def _no_signature(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=4).digest(), "big")


def signature_sets(column: pa.Array, anchors: np.ndarray, chain: int = CHAIN, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 32-bit signatures of every text, ascending, end to end, and their offsets per text.

    A text in which no anchor is followed by a whole chain has one signature, a hash of all of it, so that equal
    texts have equal sets and no set is empty.
    """
    keys = []
    for row, _, data, starts in tokens.chunks(pc.utf8_lower(column.fill_null(""))):
        _, _, word, offsets = tokens.find_words(data, starts, tokens.PUNCTUATION)
        doc = tokens.owner(offsets)
        at = np.minimum(np.searchsorted(anchors, word), len(anchors) - 1)
        is_anchor = anchors[at] == word
        content = np.flatnonzero(~is_anchor)
        spot = np.flatnonzero(is_anchor)
        first = spot - np.searchsorted(spot, spot)  # content words before an anchor: the next one's number
        last = first + (chain - 1) * distance
        fits = last < len(content)
        fits[fits] = doc[content[last[fits]]] == doc[spot[fits]]
        spot, first = spot[fits], first[fits]
        value = word[spot] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(chain):
            value = tokens.mix(value + word[content[first + k * distance]])
        keys.append(((doc[spot] + row).astype(np.uint64) << np.uint64(32)) | (value >> np.uint64(32)))
    found = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    counts = np.bincount((found >> np.uint64(32)).astype(np.int64), minlength=len(column))
    bare = np.flatnonzero(counts == 0)
    if len(bare):
        whole = [_no_signature((column[int(i)].as_py() or "").encode()) for i in bare]
        found = np.sort(np.concatenate([found, (bare.astype(np.uint64) << np.uint64(32)) | np.array(whole, np.uint64)]))
        counts[bare] = 1
    return (found & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.concatenate([[0], np.cumsum(counts)])


def pruned_jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient of two ascending sets, or -1 as soon as it is known to be under `least`.

    Lengths alone bound it by shorter / longer. Then stretches are compared in turn, and the search ends when the
    elements without a partner so far leave too few.
    """
    shorter, longer = sorted((len(a), len(b)))
    if longer == 0:
        return 1.0
    if shorter < least * longer - ROUNDING:
        return -1.0
    need = least / (1 + least) * (len(a) + len(b)) - ROUNDING  # common elements that the threshold asks for
    common, done = 0, 0
    for stop in (len(a) // 8, len(a) // 2, len(a)):
        part = a[done:stop]
        at = np.searchsorted(b, part)
        common += int((b[np.minimum(at, len(b) - 1)] == part).sum()) if len(b) else 0
        done = stop
        if common + len(a) - done < need:
            return -1.0
    return common / (len(a) + len(b) - common)


def likeness(a: np.ndarray, a_offsets: np.ndarray, b: np.ndarray, b_offsets: np.ndarray) -> np.ndarray:
    """Jaccard coefficients of the i-th sets of two columns of sets."""
    number = np.arange(len(a_offsets) - 1, dtype=np.uint64)
    left = (np.repeat(number, np.diff(a_offsets)) << np.uint64(32)) | a
    right = (np.repeat(number, np.diff(b_offsets)) << np.uint64(32)) | b
    at = np.minimum(np.searchsorted(right, left), max(len(right) - 1, 0))
    both = left[right[at] == left] if len(right) else left[:0]
    common = np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=len(number))
    return common / np.maximum(np.diff(a_offsets) + np.diff(b_offsets) - common, 1)


def anchor_hashes(words: list[str]) -> np.ndarray:
    return np.sort(np.array([tokens.word_hash(w) for w in words], np.uint64))


def fingerprints(docs: DataFrame, anchors: list[str] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, signatures): the ascending signature set of every row's text; a null text is an empty one."""
    hashes = anchor_hashes(anchors)

    def run(batches):
        for batch in batches:
            sets, offsets = signature_sets(batch.column(1), hashes, chain, distance)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(sets.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "signatures"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, signatures array<bigint>")


def _hex(sets: np.ndarray, offsets: np.ndarray) -> list[str]:
    whole = sets.astype(">u4").tobytes().hex()
    return [whole[8 * a: 8 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, guard, doc_id, text): rows dealt by stretches of ids and sorted, each stretch ended by a guard.

    The guard of a stretch is the first row of the next one, and the last stretch's guard is the first row of all.
    So every row that is no guard is followed by its successor, and each text is moved once. Repeated ids stand in
    the order of their texts; a null id comes first, as the least number there is.
    """
    spark = docs.sparkSession
    parts = parts or 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
    cuts = rows.select(F.percentile_approx("key", [i / parts for i in range(1, parts)], 10000)).first()[0] or []
    borders = sorted({float(c) for c in cuts}) or [0.0]
    splits = [-float("inf"), *borders, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="place", outputCol="part").transform(rows.withColumn("place", F.col("key").cast("double")))
    ranged = ranged.withColumn("part", F.col("part").cast("int"))
    # The least row of each stretch: as many as there are stretches.
    least = ranged.groupBy("part").agg(F.min(F.struct("key", F.xxhash64("text").alias("h"))).alias("m")).collect()
    firsts = {r["part"]: (r["m"]["key"], r["m"]["h"]) for r in least}
    order = sorted(firsts)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    size = max(order, default=0) + 1
    known = lambda f, empty: F.lit([f(p) if p in firsts else empty for p in range(size)])
    is_first = ((F.get(known(lambda p: firsts[p][0], 0), F.col("part")) == F.col("key"))
                & (F.get(known(lambda p: firsts[p][1], 0), F.col("part")) == F.xxhash64("text")))
    places = F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("guard")))
    guard = F.array(F.struct(F.get(known(lambda p: before[p], 0), F.col("part")).cast("int").alias("part"), F.lit(1).alias("guard")))
    dealt = ranged.select("doc_id", "key", "text", F.explode(F.when(is_first, F.concat(places, guard)).otherwise(places)).alias("at"))
    dealt = dealt.select("at.part", "at.guard", "doc_id", "key", F.xxhash64("text").alias("h"), "text")
    return dealt.repartition(parts, "part").sortWithinPartitions("part", "guard", "key", "h").select("part", "guard", "doc_id", "text")


def edited_fingerprints(docs: DataFrame, anchors: list[str] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """Fingerprints of every whole text and of its edited form, and how alike they and the next document's are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document by ascending id, the first one being next to the last.

    Returns:
        `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint` (8 hexadecimal digits per
        signature, ascending), `near_edited`, `near_next`. One row per row of `docs`; a single document is its own
        next one; a null text counts as empty.
    """
    hashes = anchor_hashes(anchors)
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [part.split()[0] for part in schema.split(", ")]

    def finish(rows: list[tuple]) -> pa.RecordBatch | None:
        """Rows that are followed by their successor; the last row is only a successor."""
        own = [i for i in range(len(rows) - 1) if not rows[i][1]]
        if not own:
            return None
        texts = [r[3] for r in rows]
        edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in own]
        sets, offsets = signature_sets(pa.array(texts, pa.large_string()), hashes, chain, distance)
        new, new_offsets = signature_sets(pa.array(edited, pa.large_string()), hashes, chain, distance)
        own_at = np.array(own)
        mine, mine_offsets = _taken(sets, offsets, own_at)
        after, after_offsets = _taken(sets, offsets, own_at + 1)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(_hex(mine, mine_offsets)),
            pa.array(_hex(new, new_offsets)), pa.array(likeness(mine, mine_offsets, new, new_offsets)),
            pa.array(likeness(mine, mine_offsets, after, after_offsets))], names)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                held.append(row)
                size += len(row[3])
                if size > tokens.CHUNK and len(held) > 1:
                    out = finish(held)
                    if out is not None:
                        yield out
                    held, size = held[-1:], len(row[3])
        out = finish(held)
        if out is not None:
            yield out

    return with_next(docs).mapInArrow(run, schema)


def _taken(sets: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(offsets)[rows]
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return sets[np.repeat(offsets[rows] - bounds[:-1], counts) + np.arange(bounds[-1])], bounds


def length_partition(size: F.Column, least: float) -> F.Column:
    """Number of a length's partition; borders grow by 1 / least, so sets two partitions apart cannot reach `least`."""
    return F.floor(F.log(size.cast("double")) / -F.log(F.lit(least))).cast("int")


def similar(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, other_id, likeness) of different fingerprints that reach `least`, each pair once, smaller id first.

    Args:
        prints: `doc_id` and `signatures` of `fingerprints`, one row per distinct set: reduce copies to their least
            id beforehand, so that they are not paired with each other.

    Every signature is ranked by how few sets hold it. Two sets that reach the threshold share one of their rarest
    n - ceil(least * n) + 1 signatures, so only those are put into the index, by length partition; a set looks into
    its own partition and the next one. Candidates are compared through `pruned_jaccard`.
    """
    narrow = prints.select("doc_id", "signatures", F.size("signatures").alias("n"))
    stored = materialize(narrow.withColumn("part", length_partition(F.col("n"), least)))
    flat = stored.select("doc_id", "n", "part", F.explode("signatures").alias("sig"))
    held = flat.groupBy("sig").agg(F.count(F.lit(1)).alias("held"))
    ranked = flat.join(held, "sig").groupBy("doc_id", "n", "part").agg(F.array_sort(F.collect_list(F.struct("held", "sig"))).alias("sigs"))
    prefix = F.slice("sigs", F.lit(1), F.col("n") - F.ceil(F.col("n") * least - ROUNDING).cast("int") + 1)
    index = materialize(ranked.select("doc_id", "n", "part", F.explode(prefix).alias("s")).where("s.held > 1").select("doc_id", "n", "part", F.col("s.sig").alias("sig")))
    other = index.select(F.col("doc_id").alias("other_id"), F.col("n").alias("m"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), "sig", F.col("part").alias("home"))
    pairs = index.join(other, ["part", "sig"]).where(
        ((F.col("part") < F.col("home")) | (F.col("doc_id") < F.col("other_id"))) & (F.least("n", "m") >= least * F.greatest("n", "m") - ROUNDING))
    pairs = materialize(pairs.select(F.least("doc_id", "other_id").alias("doc_id"), F.greatest("doc_id", "other_id").alias("other_id")).distinct())
    left = stored.select("doc_id", F.col("signatures").alias("a"))
    right = stored.select(F.col("doc_id").alias("other_id"), F.col("signatures").alias("b"))

    def compare(batches):
        for batch in batches:
            ids, others, a, b = batch.columns
            values = [pruned_jaccard(x.values.to_numpy(), y.values.to_numpy(), least) for x, y in zip(a, b)]
            keep = pa.array([v >= least - ROUNDING for v in values])
            yield pa.RecordBatch.from_arrays([ids.filter(keep), others.filter(keep), pa.array(values, pa.float64()).filter(keep)], ["doc_id", "other_id", "likeness"])

    both = pairs.join(left, "doc_id").join(right, "other_id").select("doc_id", "other_id", "a", "b")
    return both.mapInArrow(compare, "doc_id bigint, other_id bigint, likeness double")
