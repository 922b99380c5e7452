"""Connected components of a link table, by least neighbours and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plenary.operators.index import materialize


def components(links: DataFrame) -> DataFrame:
    """(key, label): every node of the links (a, b), labelled with the least node of its component.

    Each round takes the least label among the neighbours and then the label's own label, so a chain's length
    halves at least. Labels are stored per round; the driver only learns how many have changed.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialize(both)
    labels = materialize(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "key"))
    while True:
        heard = edges.join(labels, edges["b"] == labels["key"]).groupBy("a").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, labels["key"] == heard["a"]).select("key", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        lower = materialize(lower)
        jump = lower.select(F.col("key").alias("at"), F.col("label").alias("further"))
        moved = lower.join(jump, lower["label"] == jump["at"], "left").select("key", "was", F.least("label", F.coalesce("further", "label")).alias("label"))
        moved = materialize(moved)
        labels = moved.select("key", "label")
        if moved.where(F.col("was") != F.col("label")).isEmpty():
            return labels
