"""Subgroups of a class without a model: communities of titles that share rare terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plenary.operators.index import dense_index, materialize
from plenary.operators.keywords import PARTICLES, tokens

SHARED_BY, LEAST, ROUNDS = 20, 0.3, 8


def title_terms(docs: DataFrame, key: str, group: str, title: str = "title", shared_by: int = SHARED_BY, stop: Sequence[str] = PARTICLES) -> DataFrame:
    """(key, group, term, weight) of terms that 2 to `shared_by` titles of a group hold, stored.

    Rarer terms weigh more: ln(1 + titles of the group / titles with the term). A term that more titles share tells
    less and would link all of them; one that no other title holds links nothing.
    """
    terms = materialize(docs.select(key, group, F.explode(F.array_distinct(tokens(F.col(title), stop))).alias("term")))
    sizes = docs.groupBy(group).agg(F.count(F.lit(1)).alias("_titles"))
    held = materialize(terms.groupBy(group, "term").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n").between(2, shared_by)))
    weighed = held.join(sizes, group).select(group, "term", F.log1p(F.col("_titles") / F.col("_n")).alias("weight"))
    return materialize(terms.join(materialize(weighed), [group, "term"]).select(key, group, "term", "weight"))


def similar_titles(terms: DataFrame, key: str, group: str, least: float = LEAST) -> DataFrame:
    """(a, b, group, weight), a < b: pairs of titles of a group whose cosine over the shared terms reaches `least`, stored.

    A posting holds at most `shared_by` titles, so a title has at most as many pairs for each of its terms.
    """
    norms = materialize(terms.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")))
    named = terms.join(norms, key).select(key, group, "term", (F.col("weight") / F.col("norm")).alias("w"))
    postings = named.groupBy(group, "term").agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), "w"))).alias("held"))
    first = postings.select(group, "held", F.posexplode("held").alias("i", "x"))
    pairs = first.select(group, "x", F.explode(F.slice("held", F.col("i") + 2, F.size("held"))).alias("y"))
    scored = pairs.groupBy(group, F.col("x.k").alias("a"), F.col("y.k").alias("b")).agg(F.round(F.sum(F.col("x.w") * F.col("y.w")), 9).alias("weight"))
    return materialize(scored.where(F.col("weight") >= least))


def propagate(links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, label) of the nodes of weighted links (a, b, weight): communities by label propagation, stored.

    Every node begins with its own name. In each round it takes the label with the greatest summed weight among its
    neighbours and itself (a node backs its own label with its strongest link); ties go to the least label. It stops
    when no label changes, at the latest after `rounds`.
    """
    both = materialize(links.select(F.col("a").alias("node"), F.col("b").alias("other"), "weight").unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"), "weight")))
    own = both.groupBy("node").agg(F.max("weight").alias("weight"))
    own = materialize(own.select("node", F.col("node").alias("other"), "weight"))
    every = materialize(both.unionByName(own))
    labels = materialize(own.select("node", F.col("node").alias("label")))
    for _ in range(rounds):
        votes = every.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node", "label").agg(F.round(F.sum("weight"), 9).alias("weight"))
        best = votes.groupBy("node").agg(F.min(F.struct((-F.col("weight")).alias("w"), "label")).alias("best"))
        after = materialize(best.select("node", F.col("best.label").alias("label")))
        changed = after.join(labels.withColumnRenamed("label", "_before"), "node").where(F.col("label") != F.col("_before"))
        done = changed.isEmpty()
        labels = after
        if done:
            break
    return labels


def title_subgroups(docs: DataFrame, key: str = "bill_id", group: str = "topic_group", title: str = "title", over: int = 10, shared_by: int = SHARED_BY,
                    least: float = LEAST, rounds: int = ROUNDS) -> DataFrame:
    """(key, group, subgroup): groups of more than `over` titles cut into communities, the others whole (subgroup 0).

    Subgroups are numbered from 1 over all groups, in the order of (group, least key); titles that are like no other are
    the rest of their group, subgroup 0.
    """
    large = docs.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > over).select(group)
    wanted = materialize(docs.select(key, group, title).join(large, group))
    links = similar_titles(title_terms(wanted, key, group, title, shared_by), key, group, least)
    labels = propagate(links, rounds)
    placed = materialize(wanted.select(F.col(key).alias("node"), group).join(labels, "node"))
    firsts = dense_index(placed.groupBy(group, "label").agg(F.min("node").alias("first")), [group, "first"], "_number")
    numbered = placed.join(firsts.select("label", (F.col("_number") + 1).alias("subgroup")), "label").select(F.col("node").alias(key), "subgroup")
    return docs.select(key, group).join(numbered, key, "left").withColumn("subgroup", F.coalesce("subgroup", F.lit(0).cast("bigint")))
