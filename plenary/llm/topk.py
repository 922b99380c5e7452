"""Exact top-k inner products: vectors by descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Vectors are turned into the axes of their second-moment matrix, so the first coordinates carry most of an inner
product. What the other coordinates can add is at most the product of the two residual lengths. A pair whose partial
sum and bound stay under the query's k-th best score so far is pruned; the rest are scored exactly in integers.
Vectors and queries are stored in blocks of rows; a query block only meets the vector blocks that are long enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from plenary.operators.index import materialize

VECTOR_ROWS, QUERY_ROWS = 2048, 256
_EXACT = float(1 << 53)


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int = 1024) -> DataFrame:
    """(id, ints): floor(scale * x) per component. Vectors or components that are null or not finite take no part.

    A null id takes no part either. An id that repeats counts once, with its least vector. Components beyond
    64 bits saturate.
    """
    usable = F.col(vector).isNotNull() & F.col(key).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return rows.where(usable).groupBy(F.col(key).cast("bigint").alias("id")).agg(F.min(ints).alias("ints"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Integer rows; shorter ones are filled up with zeros."""
    counts = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(counts), width), np.int64)
    out[np.repeat(np.arange(len(counts)), counts), np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = flat
    return out


def _length(ints: Column) -> Column:
    return F.sqrt(F.aggregate(ints, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def blocks(vectors: DataFrame, width: int, rows: int, count: int | None = None) -> DataFrame:
    """(block, longest, ids, data): stretches of at most `rows` vectors in descending order of length, stored.

    Order is by range partition, so a block lies within one partition's stretch of lengths. Where the count of
    vectors is given, partitions are few enough for full blocks.
    """
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    if count is not None:
        parts = min(parts, count // (4 * rows) + 1)
    ordered = (vectors.withColumn("length", _length(F.col("ints"))).repartitionByRange(parts, F.desc("length"), "id")
               .sortWithinPartitions(F.desc("length"), "id"))

    def pack(batches):
        held: list[tuple] = []
        count = 0

        def flush():
            ids, lengths, data = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([
                pa.array([float(lengths[0])]), pa.array([ids.tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())],
                ["longest", "ids", "data"])

        for batch in batches:
            ids, lists, lengths = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy()
            for at in range(0, batch.num_rows, rows):
                part = slice(at, at + rows)
                size = len(ids[part])
                if count + size > rows and held:
                    yield flush()
                    held, count = [], 0
                held.append((ids[part], lengths[part], _matrix(lists.slice(at, rows), width)))
                count += size
        if held:
            yield flush()

    packed = ordered.select("id", "ints", "length").mapInArrow(pack, "longest double, ids binary, data binary")
    return materialize(packed.withColumn("block", F.monotonically_increasing_id()))


def rotation(packed: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, greatest singular value first, from their summed outer products."""

    def outer(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for data in batch.column(0):
                rows = np.frombuffer(data.as_py(), np.int64).reshape(-1, width).astype(float)
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "value"])

    cells = packed.select("data").mapInArrow(outer, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    moment = np.zeros(width * width)
    for row in cells.collect():  # width * width numbers
        moment[row["cell"]] = row["value"]
    values, axes = np.linalg.eigh(moment.reshape(width, width))
    return axes[:, np.argsort(-values)]


def best_in_block(queries, query_ids, vectors, vector_ids, least, axes, k):
    """(query row, vector id, score) of each query's k best vectors of a block that reach `least`.

    `least` is the k-th best score that each query is known to reach; smaller ids win ties.
    """
    q, v = queries.astype(float), vectors.astype(float)
    q_len, v_len = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
    slack = 1e-9 * q_len * v_len.max(initial=0.0) + 1e-6
    need = least - slack
    turned_q, turned_v = q @ axes, v @ axes
    q_rest, v_rest = q_len ** 2, v_len ** 2
    width = queries.shape[1]
    shortest = np.where(q_len > 0, need / np.maximum(q_len, 1e-300), np.where(need <= 0, -np.inf, np.inf))
    reach = int(np.searchsorted(-v_len, -shortest.min(initial=np.inf), "right"))  # vectors come by descending length
    turned_v, v_rest, vectors, vector_ids = turned_v[:reach], v_rest[:reach], vectors[:reach], vector_ids[:reach]
    partial, alive, done = np.zeros((len(q), reach)), np.ones((len(q), reach), bool), 0
    for depth in sorted({max(width // 8, 1), max(width // 2, 1)}):
        part_q, part_v = turned_q[:, done:depth], turned_v[:, done:depth]
        partial += part_q @ part_v.T
        q_rest = np.maximum(q_rest - (part_q * part_q).sum(1), 0)
        v_rest = np.maximum(v_rest - (part_v * part_v).sum(1), 0)
        alive = partial + np.outer(np.sqrt(q_rest), np.sqrt(v_rest)) >= need[:, None]
        done = depth
        if alive.mean() < 0.05:
            break
    alive &= query_ids[:, None] != vector_ids[None, :]
    row, col = np.nonzero(alive)
    safe = q_len.max(initial=0.0) * v_len.max(initial=0.0) < _EXACT
    if safe and alive.mean() > 0.2:
        score = (q @ v[:reach].T)[row, col].astype(np.int64)  # whole numbers under 2^53, so sums are exact
    else:
        score = np.empty(len(row), np.int64)
        for at in range(0, len(row), 1 << 16):
            part = slice(at, at + (1 << 16))
            score[part] = np.einsum("ij,ij->i", queries[row[part]], vectors[col[part]])
    fit = score >= least[row]
    row, col, score = row[fit], col[fit], score[fit]
    order = np.lexsort((vector_ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], vector_ids[col[rank < k]], score[rank < k]


def _bounds(asked: DataFrame, seed: tuple[bytes, bytes], width: int, axes: np.ndarray, k: int) -> DataFrame:
    """Query blocks with each query's k-th best score in one block of vectors, -inf where it has fewer."""
    ids = np.frombuffer(seed[0], np.int64)
    vectors = np.frombuffer(seed[1], np.int64).reshape(-1, width)

    def run(batches):
        for batch in batches:
            least, lowest = [], []
            for query_ids, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                query_ids, queries = np.frombuffer(query_ids, np.int64), np.frombuffer(data, np.int64).reshape(-1, width)
                row, _, score = best_in_block(queries, query_ids, vectors, ids, np.full(len(query_ids), -np.inf), axes, k)
                bound = np.full(len(query_ids), -np.inf)
                full = np.flatnonzero(np.bincount(row, minlength=len(bound)) == k)
                bound[full] = score[np.searchsorted(row, full) + k - 1]
                least.append(bound.tobytes())
                lowest.append(float(bound.min()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.binary()), pa.array(lowest)], ["query_ids", "queries", "longest", "least", "lowest"])

    return asked.select("ids", "data", "longest").mapInArrow(run, "query_ids binary, queries binary, longest double, least binary, lowest double")


def _search(pairs: DataFrame, width: int, axes: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score) candidates of every pair of blocks."""

    def run(batches):
        for batch in batches:
            for query_ids, queries, least, ids, data in zip(*[c.to_pylist() for c in batch.columns]):
                query_ids = np.frombuffer(query_ids, np.int64)
                at, found, score = best_in_block(
                    np.frombuffer(queries, np.int64).reshape(-1, width), query_ids, np.frombuffer(data, np.int64).reshape(-1, width),
                    np.frombuffer(ids, np.int64), np.frombuffer(least, float), axes, k)
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[at]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    return pairs.select("query_ids", "queries", "least", "ids", "data").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def search(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           scale: int = 1024) -> DataFrame:
    """Each query's k greatest integer inner products over every other vector; ties go to the smaller id.

    Args:
        rows: ids and vectors; other columns are ignored. Vectors of unequal length are filled up with zeros.
        is_query: condition on `id` (bigint) that marks the queries.

    Returns:
        `query_id`, `rank` (from 1), `vec_id`, `score`; fewer than k rows where there are fewer other vectors.
        No usable vector or query gives no row. Scores are exact while they fit 64 bits.
    """
    spark = rows.sparkSession
    vectors = materialize(integer_vectors(rows, key, vector, scale))
    most, count = vectors.agg(F.max(F.size("ints")), F.count_if(is_query)).first()
    width = max(most or 0, 1)
    part = F.shiftright("block", 33).cast("int")  # the range partition, the longest vectors first
    packed = blocks(vectors, width, VECTOR_ROWS).withColumn("part", part)
    axes = rotation(packed, width)
    first = packed.select("longest", "block").orderBy(F.desc("longest"), "block").first()  # numbers only: each task sends its first row
    if first is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    seed = packed.where(F.col("block") == first["block"]).select("ids", "data").collect()  # one block
    asked = blocks(vectors.where(is_query), width, QUERY_ROWS, count)
    ready = materialize(_bounds(asked, tuple(map(bytes, seed[0])), width, axes, k))
    # One number per range partition: a query block skips those whose longest vector cannot reach its bounds.
    longest = dict(packed.groupBy("part").agg(F.max("longest")).collect())
    lengths = F.lit([longest.get(p, -1.0) for p in range(max(longest) + 1)])
    reach = F.when(F.col("lowest") <= 0, 0.0).otherwise(F.col("lowest") / F.col("longest") * (1 - 1e-9))
    parts = F.filter(F.sequence(F.lit(0), F.lit(max(longest))), lambda p: F.get(lengths, p) >= reach)
    paired = ready.withColumn("part", F.explode(parts)).drop("longest", "lowest")
    # Query blocks come once per range partition, which no size estimate shows: the driver must not collect them for a broadcast.
    found = _search(paired.hint("merge").join(packed.select("part", "ids", "data"), "part"), width, axes, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
