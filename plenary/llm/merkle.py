"""Merkle manifest of a dataset, proved by octopus multiproofs.

Every row is a leaf; the leaves of a group form a tree whose runs of three nodes become their digest, and the groups'
roots form one more tree. Leaves are packed into partitions: a block of 3^6 neighbouring leaves of one group, or whole
small groups that follow each other. Each partition hashes what lies below it by itself; only its top goes on to be
joined with those of others, a level of blocks at a time.

For the proofs, each partition works out the least union of node coordinates that it can't derive from its own leaves:
the siblings at the border of what it holds, on the way to the root. They are fetched once, by one join for all
partitions. Then a partition derives the interiors that its leaves share and expands every leaf's own proof.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plenary.operators.index import dense_index, materialize

ARITY = 3
LEVELS = 6  # of a partition
BLOCK = ARITY ** LEVELS
ALL = "*"  # the tree over the groups' roots; names of groups begin with another character
PACKED = "unit struct<big:boolean,n:bigint>, trees array<struct<tree:string,place:bigint,count:bigint,first:bigint,rows:bigint>>, doc_ids array<bigint>, leaves binary, changed binary"


def digest_of(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as UTF-8 byte count, colon and text; `-` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


# One tree

def height(count: int) -> int:
    """Levels from the leaves to the root."""
    levels = 0
    while count > 1:
        count, levels = -(-count // ARITY), levels + 1
    return levels


def missing(held: list[int], count: int, levels: int | None = None) -> list[tuple[int, int]]:
    """(level, place) of the nodes without which the root can't be derived from the held leaves; the least union.

    Args:
        held: places of leaves, ascending.
        count: leaves of the tree.
        levels: how far to go up; by default to the root.
    """
    out, level = [], 0
    while count > 1 and (levels is None or level < levels):
        runs = sorted({i // ARITY for i in held})
        have = set(held)
        out += [(level, i) for r in runs for i in range(ARITY * r, min(ARITY * r + ARITY, count)) if i not in have]
        held, count, level = runs, -(-count // ARITY), level + 1
    return out


def derive(held: dict[int, str], count: int, fetched: dict[tuple[int, int], str], levels: int | None = None) -> list[dict[int, str]]:
    """Per level the nodes known: held or fetched, and each run's digest, up to the root."""
    known = [dict(held)]
    while count > 1 and (levels is None or len(known) <= levels):
        level = len(known) - 1
        here, runs = known[-1], sorted({i // ARITY for i in known[-1]})
        for r in runs:
            for i in range(ARITY * r, min(ARITY * r + ARITY, count)):
                if i not in here:
                    here[i] = fetched[level, i]
        known.append({r: digest_of([here[i] for i in range(ARITY * r, min(ARITY * r + ARITY, count))]) for r in runs})
        count = -(-count // ARITY)
    return known


def siblings(known: list[dict[int, str]], place: int, count: int) -> list[tuple[list[str], list[str]]]:
    """(left, right) siblings of a leaf's path, level by level to the root."""
    path = []
    for level in range(len(known) - 1):
        first = place - place % ARITY
        path.append(([known[level][i] for i in range(first, place)], [known[level][i] for i in range(place + 1, min(first + ARITY, count))]))
        place, count = place // ARITY, -(-count // ARITY)
    return path


def fold(node: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that follows from a node and the siblings of its path."""
    for left, right in path:
        node = digest_of([*left, node, *right])
    return node


# All trees

def _tops(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, level, place, count, digest) a block higher; with `inner`, all levels between, the given one too."""

    def run(table: pa.Table) -> pa.Table:
        tree, level, count = (table.column(c)[0].as_py() for c in ("tree", "level", "count"))
        held = dict(zip(table.column("place").to_pylist(), table.column("digest").to_pylist()))
        first, size = min(held) // BLOCK * BLOCK, count
        known = derive(held, count, {}, LEVELS)
        rows = []
        for up, nodes_here in enumerate(known):
            rows += [(tree, level + up, i, size, d, up == len(known) - 1) for i, d in nodes_here.items()]
            size = -(-size // ARITY)
        assert first // BLOCK == max(held) // BLOCK
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
                        names=["tree", "level", "place", "count", "digest", "top"])

    blocks = nodes.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("tree", "block")
    return blocks.applyInArrow(run, "tree string, level bigint, place bigint, count bigint, digest string, top boolean")


def grow(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all nodes (tree, level, place, digest), roots (tree, digest)) of trees given by one level of nodes each, stored.

    Every round hashes blocks of 3^6 nodes, so a tree of n leaves takes log(n) / log(729) rounds of distributed work.
    """
    columns = ["tree", "level", "place", "count", "digest"]
    current, every, roots = materialize(nodes.select(columns)), [], []
    while True:
        roots.append(current.where("count = 1").select("tree", "digest"))
        every.append(current.where("count = 1").select("tree", "level", "place", "digest"))
        open_ = current.where("count > 1")
        if open_.isEmpty():
            break
        made = materialize(_tops(open_))
        every.append(made.where("not top").select("tree", "level", "place", "digest"))
        current = made.where("top").select(columns)
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return union(every), union(roots)


def _pack(table: pa.Table) -> pa.Table:
    """One row for a partition of leaves."""
    table = table.sort_by([("place", "ascending"), ("position", "ascending")])
    trees, places, counts, positions = (table.column(c).to_pylist() for c in ("tree", "place", "count", "position"))
    starts = [i for i in range(len(trees)) if i == 0 or places[i] != places[i - 1]]
    held = [{"tree": trees[a], "place": places[a], "count": counts[a], "first": positions[a], "rows": b - a} for a, b in zip(starts, [*starts[1:], len(trees)])]
    kind = pa.list_(pa.struct([("tree", pa.string()), ("place", pa.int64()), ("count", pa.int64()), ("first", pa.int64()), ("rows", pa.int64())]))
    blob = lambda name: pa.array([b"".join(table.column(name).to_pylist())], pa.binary())
    return pa.table({"unit": table.column("unit")[:1], "trees": pa.array([held], kind), "doc_ids": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                     "leaves": blob("leaf"), "changed": blob("other")})


def _hexes(body: bytes) -> list[str]:
    text = body.hex()
    return [text[i: i + 64] for i in range(0, len(text), 64)]


def _segments(trees: list[dict], leaves: list[str]):
    at = 0
    for t in trees:
        yield t, dict(zip(range(t["first"], t["first"] + t["rows"]), leaves[at: at + t["rows"]])), at
        at += t["rows"]


def prove(rows: DataFrame) -> DataFrame:
    """Leaves, roots and every leaf's proof, checked against a leaf that may have been tampered with.

    Args:
        rows: `doc_id`, `group` (string), `leaf` and `other` (hex digests); `other` is the leaf that is put to the test.

    Returns:
        `doc_id`, `leaf`, `subroot`, `root`, `proof` (sibling digests, level by level, left to right), `folded_root` and
        `verified`; one row per row. Leaves of a group ascend by doc_id (null first), then by digest; groups ascend
        bytewise, null first. A repeated row is a leaf of its own. An empty table has no root and gives no row.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit(""))
    narrow = rows.select(name.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex("leaf").alias("leaf"), F.unhex("other").alias("other"))
    # The last column only tells rows apart that are alike.
    indexed = dense_index(narrow.withColumn("row", F.monotonically_increasing_id()), ["tree", "doc_id", "leaf", "row"], "seat").drop("row")
    groups = materialize(indexed.groupBy("tree").agg(F.min("seat").alias("start"), F.count(F.lit(1)).alias("count")))
    groups = dense_index(groups, ["tree"], "place")
    group_count = groups.count()
    position = F.col("seat") - F.col("start")
    block = lambda x: F.floor(x / BLOCK).cast("bigint")
    big = F.col("count") > BLOCK
    unit = F.struct(big.alias("big"), F.when(big, F.col("start") + block(position)).otherwise(block(F.col("start"))).alias("n"))
    placed = indexed.join(groups, "tree").select("tree", "place", "count", "doc_id", "leaf", "other", position.alias("position"), unit.alias("unit"))
    packs = materialize(placed.groupBy("unit").applyInArrow(_pack, PACKED))

    def tops(batches):
        for batch in batches:
            out = []
            for trees, leaves in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for t, held, _ in _segments(trees, _hexes(leaves)):
                    known, count = derive(held, t["count"], {}, LEVELS), t["count"]
                    for _ in known[1:]:
                        count = -(-count // ARITY)
                    out += [(t["tree"], len(known) - 1, i, count, d) for i, d in known[-1].items()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["tree", "level", "place", "count", "digest"])

    inner, subroots = grow(packs.select("trees", "leaves").mapInArrow(tops, "tree string, level bigint, place bigint, count bigint, digest string"))
    upper = subroots.join(groups.select("tree", "place"), "tree").select(
        F.lit(ALL).alias("tree"), F.lit(0).cast("bigint").alias("level"), "place", F.lit(group_count).cast("bigint").alias("count"), "digest")
    outer, _ = grow(upper)
    nodes = materialize(inner.unionByName(outer))

    def ask(batches):
        for batch in batches:
            for unit, trees in zip(batch.column(0), batch.column(1).to_pylist()):
                wanted = [(t["tree"], *c) for t in trees for c in missing(list(range(t["first"], t["first"] + t["rows"])), t["count"])]
                wanted += [(ALL, *c) for c in missing([t["place"] for t in trees], group_count)]
                # The subroot of a big group is not known from one of its blocks; nor need it be fetched, as it is derived.
                if wanted:
                    tree, level, place = zip(*wanted)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([unit.as_py()] * len(tree), batch.column(0).type), pa.array(tree), pa.array(level, pa.int64()), pa.array(place, pa.int64())], ["unit", "tree", "level", "place"])

    asked = materialize(packs.select("unit", "trees").mapInArrow(ask, "unit struct<big:boolean,n:bigint>, tree string, level bigint, place bigint"))
    fetched = materialize(asked.join(nodes, ["tree", "level", "place"])).groupBy("unit").agg(F.collect_list(F.struct("tree", "level", "place", "digest")).alias("fetched"))

    def expand(batches):
        for batch in batches:
            for trees, ids, leaves, changed, found in zip(*[c.to_pylist() for c in batch.columns]):
                yield _expanded(trees, ids, _hexes(leaves), _hexes(changed), found or [], group_count)

    whole = packs.join(fetched, "unit", "left").select("trees", "doc_ids", "leaves", "changed", "fetched")
    return whole.mapInArrow(expand, "doc_id bigint, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean")


def _expanded(trees: list[dict], ids: list, leaves: list[str], changed: list[str], found: list[dict], group_count: int) -> pa.RecordBatch:
    by_tree: dict[str, dict] = {}
    for f in found:
        by_tree.setdefault(f["tree"], {})[f["level"], f["place"]] = f["digest"]
    inner = [(t, derive(held, t["count"], by_tree.get(t["tree"], {})), at) for t, held, at in _segments(trees, leaves)]
    outer = derive({t["place"]: known[-1][0] for t, known, _ in inner}, group_count, by_tree.get(ALL, {}))
    root = outer[-1][0]
    subroots, proofs, folded = [], [], []
    for t, known, at in inner:
        above = siblings(outer, t["place"], group_count)
        for i in range(t["rows"]):
            path = [*siblings(known, t["first"] + i, t["count"]), *above]
            proofs.append([d for left, right in path for d in (*left, *right)])
            folded.append(fold(changed[at + i], path))
            subroots.append(known[-1][0])
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(leaves), pa.array(subroots), pa.array([root] * len(ids)), pa.array(proofs, pa.list_(pa.string())),
        pa.array(folded), pa.array([f == root for f in folded])], ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"])
