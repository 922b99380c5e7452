"""Cross-tabs, string aggregation and counters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, Window

from plenary.functions.text import strip
from plenary.operators.filters import is_valid_content
from plenary.operators.index import materialize


def join_texts(df: DataFrame, key: str, value: str, order_by: str, separator: str = " / ",
               part: Column | None = None) -> DataFrame:
    """Non-null values of a key joined in order; a key with nulls only gives the empty string.

    One cell per key is the default. Where a key can hold more text than one task or one cell
    should, `part` cuts it into numbered stretches of the ordering column: each (key, part) is then
    aggregated on its own, nothing is dropped, and the parts joined in order are the same text.
    """
    keys = [F.col(key)] + ([part.alias("part")] if part is not None else [])
    pair = F.struct(F.col(order_by).alias("_order"), F.col(value).alias("_text"))
    ordered = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), pair)))
    text = F.array_join(F.transform(ordered, lambda x: x["_text"]), separator).alias(value)
    return df.where(F.col(key).isNotNull()).groupBy(*keys).agg(text)


def join_long_texts(df: DataFrame, key: str, value: str, order_by: str, cell_chars: int = 1 << 24,
                    separator: str = " / ") -> DataFrame:
    """`join_texts` as (key, part, value) for keys of any size: a text over `cell_chars` characters comes in numbered parts.

    Sizes are added up first. A key that fits one cell is joined as it is, as part 0. The values of a larger key are
    range-sorted by (order, value), and each goes to the part in which its first character stands, counted with the
    separators before it; so a part holds fewer than `cell_chars` characters and one more value, and the parts joined
    in order are the whole text. No task holds more than one range of rows or one part. Part numbers rise, and one is
    missing where a value is longer than a cell. Null keys are left out, null values add nothing, and a key with nulls
    only gives the empty string.
    """
    width = F.when(F.col(value).isNotNull(), F.length(value) + len(separator)).otherwise(0).cast("bigint")
    rows = df.where(F.col(key).isNotNull()).select(key, F.col(order_by).alias("_by"), F.col(value).alias("_value"), width.alias("_chars"))
    sizes = materialize(rows.groupBy(key).agg(F.sum("_chars").alias("_size")))
    # Separators count as one more than there are, so a text of exactly one cell still is one part.
    long = sizes.where(F.col("_size") > cell_chars + len(separator)).select(key)
    whole = join_texts(rows.join(long, key, "left_anti"), key, "_value", "_by", separator, part=F.lit(0).cast("bigint"))

    ranged = materialize(
        rows.where("_value IS NOT NULL").join(long, key, "left_semi")
        .repartitionByRange(key, "_by", F.col("_value")).sortWithinPartitions(key, "_by", "_value")
        .withColumn("_seat", F.monotonically_increasing_id()))
    seated = ranged.withColumn("_range", F.shiftright("_seat", 33))
    # A key's ranges are at most as many as the partitions; within a range the running sum is a window of its own.
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = seated.groupBy(key, "_range").agg(F.sum("_chars").alias("_sum")).select(
        key, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(key, "_range").orderBy("_seat").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        seated.select(key, "_range", "_seat", "_chars").withColumn("_at", F.coalesce(F.sum("_chars").over(within), F.lit(0)))
        .join(starts, [key, "_range"])
        .select("_seat", F.floor((F.col("_start") + F.col("_at")) / cell_chars).cast("bigint").alias("part")))
    parts = join_texts(ranged.join(placed, "_seat"), key, "_value", "_by", separator, part=F.col("part"))
    return whole.unionByName(parts).withColumnRenamed("_value", value)


def crosstab(df: DataFrame, rows: str | Sequence[str], column: str, values: Sequence) -> DataFrame:
    """Rows per group and column value, zero where none, for a stated list of values."""
    names = [rows] if isinstance(rows, str) else list(rows)
    counts = [F.count_if(F.col(column) == v).alias(str(v)) for v in values]
    return df.dropna(subset=[*names, column]).groupBy(*names).agg(*counts)


def with_ratios(counts: DataFrame, values: Sequence, prefix: str = "ratio_", digits: int = 6) -> DataFrame:
    """Each cross-tab column divided by its row total."""
    total = reduce(add, (F.col(f"`{v}`") for v in values))
    return counts.withColumns({
        f"{prefix}{v}": F.round(F.try_divide(F.col(f"`{v}`").cast("double"), total.cast("double")), digits)
        for v in values
    })


def group_counts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Several cross-tabs of one key in long form: (key, attribute, value, n).

    One shuffle of partial counts serves all columns and any number of values. Nulls are not counted.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in columns])
    rows = df.select(key, F.explode(pairs).alias("p")).select(key, "p.attribute", "p.value")
    return rows.where(F.col("value").isNotNull()).groupBy(key, "attribute", "value").agg(F.count(F.lit(1)).alias("n"))


def attach_counts(details: DataFrame, counts: DataFrame, key: str, columns: Sequence[str],
                  form: Callable[[Column], Column] | None = None) -> DataFrame:
    """A key's long-form counts on every detail row as one map per column, empty where there are none.

    `form` turns a map into what the rows shall hold, such as a text; it is worked out once per key, before the join.
    The results are stored: both sides of the join are then plain scans, so adaptive execution can split a key
    with very many details.
    """
    form = form or (lambda c: c)
    none = form(F.create_map().cast("map<string,bigint>"))
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("attribute") == c, F.struct("value", "n"))))).alias(f"{c}_counts") for c in columns]
    per_key = counts.groupBy(key).agg(*maps).withColumns({f"{c}_counts": form(F.col(f"{c}_counts")) for c in columns})
    joined = details.join(materialize(per_key), key, "left")
    return joined.withColumns({f"{c}_counts": F.coalesce(f"{c}_counts", none) for c in columns})


def content_audit(df: DataFrame, column: str = "content") -> DataFrame:
    """Null, empty, marker, valid and removable rows in one pass."""
    text = strip(F.coalesce(F.col(column).cast("string"), F.lit("nan")))
    valid = is_valid_content(F.col(column))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(column).isNull()).alias("null_rows"),
        F.count_if(text == "").alias("empty_rows"),
        F.count_if(text == "nan").alias("nan_text_rows"),
        F.count_if(F.lower(text) == "none").alias("none_text_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("removed_rows"),
    )


def missing_report(df: DataFrame, column: str = "content") -> DataFrame:
    null, empty = F.col(column).isNull(), F.coalesce(F.col(column) == "", F.lit(False))
    return df.agg(
        F.count_if(null).alias("null_rows"),
        F.count_if(empty).alias("empty_rows"),
        F.count_if(null | empty).alias("missing_rows"),
    )


def value_frequency(df: DataFrame, column: str | Column, name: str = "value", at_least: int = 1) -> DataFrame:
    """Rows per distinct non-null value, with an optional minimum."""
    value = F.col(column) if isinstance(column, str) else column
    return (
        df.select(value.alias(name)).where(F.col(name).isNotNull())
        .groupBy(name).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)
    )


def fill_change(before: DataFrame, after: DataFrame, column: str = "content") -> DataFrame:
    """Non-null counts of a column before and after a step, and their difference."""
    zero = F.lit(0).cast("bigint")
    counts = before.agg(F.count(column).alias("before_rows")).withColumn("after_rows", zero).unionByName(
        after.agg(F.count(column).alias("after_rows")).withColumn("before_rows", zero)
    )
    return counts.agg(F.sum("before_rows").alias("before_rows"), F.sum("after_rows").alias("after_rows")) \
        .withColumn("added_rows", F.col("after_rows") - F.col("before_rows"))


def topic_summary(df: DataFrame, topic: str = "topic", title: str = "title", label: str = "topic_label",
                  order_by: str = "bill_id") -> DataFrame:
    """Titles per topic and the label of its first bill, largest topic first."""
    return (
        df.where(F.col(topic).isNotNull())
        .groupBy(topic)
        .agg(F.count(title).alias("document_count"), F.min_by(label, order_by).alias(label))
        .orderBy(F.desc("document_count"), topic)
    )


def topic_count(df: DataFrame, topic: str = "topic") -> DataFrame:
    """One row: the number of distinct topics."""
    return df.agg(F.countDistinct(topic).alias("topics"))
