"""One-to-one matching of bills and extracts whose numbers agree in full, or else in their last four digits.

Both sides are put into one order: block, number, title, id. Neighbours of unlike kind within a block are candidates; a
candidate closer than those on either side of it is the best of both its rows and is settled. Rows settled leave the
order, which brings others together, for some rounds; what is left of a block is then paired in order. Neighbours meet
by their place in the whole order, so a block of any size is spread over all tasks and no pair is made but those of neighbours.

Most blocks hold many more bills than extracts. Only bills near an extract, and the first ones of a block, can get one;
the others are left out once all rows have their places, so the rounds go over few times as many rows as there are extracts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plenary.functions.text import join_nullable, last4_key, strip
from plenary.operators.filters import not_blank
from plenary.operators.index import dense_index, group_position, materialize
from plenary.operators.keywords import words

ROUNDS = 3
FAR = 1 << 40  # a distance beyond all numbers


def plain_number(number: Column) -> Column:
    """A bill number without blanks around it or zeros before it."""
    return F.regexp_replace(strip(number), "^0+(?=.)", "")


def title_words(title: Column) -> Column:
    return F.array_sort(F.array_distinct(words(F.coalesce(title, F.lit("")))))


def overlap(a: Column, b: Column) -> Column:
    """Shared words of two word sets over all their words, in thousandths; 0 where neither has a word."""
    every = F.size(F.array_union(a, b))
    return F.when(every > 0, F.floor(F.size(F.array_intersect(a, b)) * 1000 / F.greatest(every, F.lit(1)))).otherwise(0).cast("bigint")


def _reachable(rows: DataFrame, rounds: int) -> DataFrame:
    """The extracts, and all bills that can get one of them; stored.

    In a round a stretch of bills between two extracts loses at most its first and its last one, so within the rounds only
    the `rounds` bills next to an extract on either side can be settled. Of the rest, the first bills of a block are paired,
    as many as it has extracts left; these are among its first bills, as many as it has extracts, and so among its first
    rows, twice as many. An id that repeats leaves several places at once, and a null one leaves none: blocks that hold such
    an id are kept whole.
    """
    placed = dense_index(rows, ["block", "value", "title", "extract", "id"], "_at")
    blocks = materialize(placed.groupBy("block").agg(F.min("_at").alias("_start"), F.count_if("extract").alias("_extracts")).where("_extracts > 0"))
    near = materialize(placed.where("extract").select(F.explode(F.sequence(F.col("_at") - rounds, F.col("_at") + rounds)).alias("_at")).distinct())
    odd = materialize(placed.groupBy(F.col("extract").alias("_kind"), F.col("id").alias("_id")).count().where("count > 1 OR _id IS NULL"))
    whole = placed.join(odd, (F.col("extract") == F.col("_kind")) & F.col("id").eqNullSafe(F.col("_id"))).select("block").distinct()
    blocks = materialize(blocks.join(whole.withColumn("_whole", F.lit(True)), "block", "left"))
    joined = placed.join(blocks, "block").join(near.withColumn("_near", F.lit(True)), "_at", "left")
    able = F.col("extract") | F.col("_whole").isNotNull() | F.col("_near").isNotNull() | (F.col("_at") - F.col("_start") < 2 * F.col("_extracts"))
    return materialize(joined.where(able).select(*rows.columns))


def _neighbours(open_: DataFrame) -> DataFrame:
    """(at, bill, extract, round rank): rows of unlike kind that follow each other within a block; `at` is the first one's place."""
    placed = dense_index(open_, ["block", "value", "title", "extract", "id"], "at")
    # Of a pair one is an extract, so every extract asks for the rows before and behind it; no other rows meet.
    names = ("block", "value", "title", "id")
    beside = placed.where(~F.col("extract")).select(F.col("at").alias("bill_at"), *[F.col(c).alias(f"bill_{c}") for c in names])
    asked = placed.where("extract").withColumn("bill_at", F.explode(F.array(F.col("at") - 1, F.col("at") + 1)))
    pairs = asked.join(beside, "bill_at").where(F.col("block") == F.col("bill_block"))
    gap = F.coalesce(F.abs(F.col("bill_value") - F.col("value")), F.lit(FAR))
    at = F.least("at", "bill_at").alias("at")
    return materialize(pairs.select(at, F.col("bill_id").alias("bill"), F.col("id").alias("file"), F.struct(
        F.least(gap, F.lit(FAR)).alias("distance"), (-overlap(F.col("title"), F.col("bill_title"))).alias("overlap"), at).alias("rank")))


def _settled(pairs: DataFrame) -> DataFrame:
    """The candidates better than those that share a row with them."""
    beside = lambda step, name: pairs.select((F.col("at") + step).alias("at"), F.col("rank").alias(name))
    joined = pairs.join(beside(1, "before"), "at", "left").join(beside(-1, "behind"), "at", "left")
    best = F.coalesce(F.col("rank") < F.col("before"), F.lit(True)) & F.coalesce(F.col("rank") < F.col("behind"), F.lit(True))
    return joined.where(best).select("bill", "file", F.col("rank.distance").alias("distance"), (-F.col("rank.overlap")).alias("overlap"))


def match_rows(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(bill, file, distance, overlap, round) of rows (block, value, title, extract, id), stored; each id is used once.

    Args:
        rows: `extract` tells the two kinds apart; `value` may be null, `title` is an array of words; ids are unique by kind.
        rounds: of mutual choice; the rest of a block is paired in its order, as round `rounds`.

    Every block ends with as many pairs as the lesser of its two kinds has rows. Bills that no extract can reach are left out first.
    """
    open_, found = _reachable(materialize(rows), rounds), []
    for turn in range(rounds):
        best = materialize(_settled(_neighbours(open_)).withColumn("round", F.lit(turn)))
        found.append(best)
        gone = best.select(F.lit(False).alias("extract"), F.col("bill").alias("id")).unionByName(best.select(F.lit(True).alias("extract"), F.col("file").alias("id")))
        open_ = materialize(open_.join(gone, ["extract", "id"], "left_anti"))
    order = ["block", "value", "title", "id"]
    side = lambda kind: group_position(open_.where(F.col("extract") == kind).select(*order), ["block"], order[1:], "nth")
    left, right = (side(kind).select("block", "nth", *[F.col(c).alias(f"{name}_{c}") for c in order[1:]]) for kind, name in ((False, "l"), (True, "r")))
    gap = F.least(F.coalesce(F.abs(F.col("l_value") - F.col("r_value")), F.lit(FAR)), F.lit(FAR))
    rest = left.join(right, ["block", "nth"]).select(
        F.col("l_id").alias("bill"), F.col("r_id").alias("file"), gap.alias("distance"), overlap(F.col("l_title"), F.col("r_title")).alias("overlap"), F.lit(rounds).alias("round"))
    return materialize(reduce(DataFrame.unionByName, [*found, rest]))


def match_extracts(bills: DataFrame, extracts: DataFrame, rounds: int = ROUNDS, bill: str = "bill_id", file: str = "file_name", term: str = "age",
                   number: str = "bill_number", title: str = "title", reason: str = "reason", main: str = "main") -> tuple[DataFrame, DataFrame]:
    """Every bill with the one extract that is its own, and the extracts that no bill takes.

    Equal numbers (without leading zeros) of a term decide first; bills and extracts left over meet on the last four
    digits. Within such a block the closer number, then the greater share of common title words, then the earlier place wins.

    Args:
        bills: `bill` (unique), `term`, `number`, `title`; other columns are kept, `content` is replaced.
        extracts: `file` (unique), `term`, `number`, `title`, `reason`, `main`. Blank texts are no extracts.

    Returns:
        One row per bill with `content` (of its extract alone), `file`, `distance`, `overlap`, `round`, all null without
        an extract; and the unused extracts' (`file`, `term`, `number`). Null terms or numbers match nothing.
    """
    text = join_nullable(F.col(reason), F.col(main))
    sides = (bills.select(F.col(bill).cast("string").alias("id"), term, number, title, F.lit(False).alias("extract")),
             extracts.where(not_blank(text)).select(F.col(file).cast("string").alias("id"), term, number, title, F.lit(True).alias("extract")))
    full = plain_number(F.col(number))
    rows = materialize(sides[0].unionByName(sides[1]).where(F.col(term).isNotNull() & F.col(number).isNotNull()).select(
        "id", "extract", F.struct(F.col(term).cast("string").alias("term"), full.alias("key")).alias("full"),
        F.struct(F.col(term).cast("string").alias("term"), last4_key(strip(F.col(number))).alias("key")).alias("short"),
        full.try_cast("bigint").alias("value"), title_words(F.col(title)).alias("title")))
    # Only numbers that both sides have can meet.
    shared = materialize(rows.groupBy("full").agg(F.min("extract").alias("a"), F.max("extract").alias("b")).where("a <> b").select("full"))
    equal = match_rows(rows.join(shared, "full").select("id", "extract", F.col("full").alias("block"), "value", "title"), rounds)
    used = equal.select(F.lit(False).alias("extract"), F.col("bill").alias("id")).unionByName(equal.select(F.lit(True).alias("extract"), F.col("file").alias("id")))
    close = match_rows(rows.join(used, ["extract", "id"], "left_anti").select("id", "extract", F.col("short").alias("block"), "value", "title"), rounds)
    pairs = equal.unionByName(close)
    texts = extracts.select(F.col(file).cast("string").alias("_file"), text.alias("content"))
    content = pairs.join(texts, F.col("file") == F.col("_file")).select(F.col("bill").alias("_bill"), "content", F.col("file").alias(file), "distance", "overlap", "round")
    matched = bills.drop("content", file, "distance", "overlap", "round").withColumn("_bill", F.col(bill).cast("string")).join(content, "_bill", "left").drop("_bill")
    unused = extracts.withColumn("_file", F.col(file).cast("string")).join(pairs.select(F.col("file").alias("_file")), "_file", "left_anti")
    return matched, unused.select(file, term, number)
