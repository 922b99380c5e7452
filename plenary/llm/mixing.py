"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

Every document of a source repeats, on average, as often as the source needs to reach its share of the mixture.
The count is the Poisson distribution inverted at a uniform number hashed from a seed and the document's id, so
it does not depend on partitions or order and needs no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plenary.llm.columns import shield
from plenary.operators.index import materialize

_BITS = 52  # hex digits 1 to 13 of a hash as a number in [0, 1)


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from SHA-256 of the seed and the parts, a null being an empty part."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << _BITS))


def poisson_steps(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), … up to a number that no 52-bit uniform exceeds in practice.

    Probabilities are added up from their logarithms, so a large rate does not underflow.
    """
    top = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    log_rate = F.ln(F.greatest(rate, F.lit(1e-300)))
    first = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + log_rate - F.ln(k.cast("double"))
        total = acc["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.array_append(acc["steps"], total).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), top), first, step, lambda acc: acc["steps"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0,
                 size: Column | None = None, target: float | None = None) -> DataFrame:
    """(source, rate, steps): the mean repetitions that bring each source to its weight's share of `target`.

    Args:
        weights: target weight by source; the others get `default_weight`. Weights are scaled to add up to one
            over the sources that occur with a size above zero.
        size: a document's size, by default its characters; `target` is in the same unit, by default their total.

    A null source is a source of its own. A source of size zero gets rate zero. One row per source.
    """
    size = F.coalesce(F.length("text") if size is None else size, F.lit(0)).cast("double")
    totals = docs.select("source", size.alias("_size")).groupBy("source").agg(F.sum("_size").alias("_size"))
    weight = F.lit(float(default_weight))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    totals = materialize(totals.withColumn("_weight", F.when(F.col("_size") > 0, weight).otherwise(0.0)))
    all_weights, all_sizes = totals.agg(F.sum("_weight"), F.sum("_size")).first()
    budget = float(all_sizes or 0.0) if target is None else float(target)
    wanted = F.col("_weight") / F.lit(all_weights or 1.0) * F.lit(budget) / F.col("_size")
    rates = totals.select("source", F.when(F.col("_size") > 0, wanted).otherwise(0.0).alias("rate"))
    return materialize(rates.withColumn("steps", poisson_steps(F.col("rate"))))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0,
        target: float | None = None, seed: int = 20) -> DataFrame:
    """Documents repeated to the target weights and dealt out anew over all partitions in a random order.

    Args:
        docs: `doc_id`, `text`, `source` and any other columns, all of which are kept.
        target: characters of the mixture; by default as many as there are now.
        seed: another seed gives another draw.

    Returns:
        The columns of `docs`, and `copy` (1, 2, …), `rate` and `shuffle_key` (the place in the global order), which
        take the place of columns of the same names.
        Documents drawn zero times are not in the mixture. Rows that repeat a `doc_id` draw the same count. A
        null `doc_id` draws as the empty id; a null text has size zero; an empty table gives no row.
    """
    docs, restore = shield(docs, "doc_id", "text", "source")
    rates = source_rates(docs, weights, default_weight, target=target)
    rates = rates.select(F.col("source").alias("_source"), "rate", "steps")
    joined = docs.join(rates, docs["source"].eqNullSafe(rates["_source"]))
    times = F.size(F.filter("steps", lambda p: p <= uniform(seed, F.col("doc_id"))))
    copies = joined.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    keyed = copies.select(*docs.columns, "rate", "copy", uniform(seed + 1, F.col("doc_id"), F.col("copy")).alias("shuffle_key"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = keyed.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")
    return restore(dealt, "copy", "rate", "shuffle_key")
