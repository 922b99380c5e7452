"""Spans of patterns in texts, in DataFrame functions alone; places are code points, the end exclusive."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


BLOCK = 64  # array items handled by one loop; a loop copies what it has collected at each step


def once(value: Column, use) -> Column:
    """`use(value)` with the value worked out a single time, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def blocks(items: Column) -> Column:
    """An array cut into arrays of BLOCK items. `items` must be a lambda's variable, so that it isn't worked out again for each."""
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, BLOCK))).otherwise(F.array(F.slice(items, 1, 0)))


def running(values: Column, start: Column, join, told=None) -> Column:
    """For each item in turn `told(state, item)`, a number (by default the state): `start` joined with all items before it.

    Items are taken in blocks, so what has been collected is copied within a block or block by block, never as a whole.
    """
    told = told or (lambda state, item: state)
    none, lists = F.array().cast("array<bigint>"), F.array().cast("array<array<bigint>>")

    def item_step(acc: Column, x: Column) -> Column:
        return F.struct(join(acc["now"], x).alias("now"), F.array_append(acc["list"], told(acc["now"], x)).alias("list"))

    def block_step(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["now"].alias("now"), none.alias("list")), item_step)
        return once(done, lambda d: F.struct(d["now"].alias("now"), F.array_append(acc["parts"], d["list"]).alias("parts")))

    first = F.struct(start.alias("now"), lists.alias("parts"))
    return once(values, lambda v: F.flatten(F.aggregate(blocks(v), first, block_step, lambda acc: acc["parts"])))


def find(text: Column, number: int, pattern: str, keep=None, screen: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as (start, kind number, end, value), failing ones dropped.

    The text between matches and the matches themselves add up to the text, so their lengths give the places.

    Args:
        keep: value -> condition that a match must pass; it does not make the search try again.
        screen: a cheap condition without which a text holds no match; by default the pattern itself.
    """
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    zero = F.lit(0).cast("bigint")

    def placed(found: Column) -> Column:
        sizes = F.transform(found, lambda p: (F.length(p["gap"]) + F.coalesce(F.length(p["hit"]), F.lit(0))).cast("bigint"))
        spans = F.zip_with(found, running(sizes, zero, lambda a, b: a + b), lambda p, at: F.struct(
            (at + F.length(p["gap"])).alias("start"), F.lit(number).alias("kind"), (at + F.length(p["gap"]) + F.length(p["hit"])).alias("end"), p["hit"].alias("value")))
        return F.filter(spans, lambda s: s["value"].isNotNull() if keep is None else s["value"].isNotNull() & keep(s["value"]))

    return F.when(text.rlike(pattern) if screen is None else screen, once(pieces, placed)).otherwise(F.array().cast(SPAN))


def apart(some: Column, others: Column) -> Column:
    """Those of `some` spans that overlap none of the others, by start; both are merged by start and gone over twice."""
    far = F.lit((1 << 62)).cast("bigint")
    tag = lambda spans, other: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(other).alias("other"), s["kind"].alias("kind"), s["value"].alias("value")))

    def merged(every: Column) -> Column:
        ends = running(F.transform(every, lambda s: F.when(s["other"], s["end"]).otherwise(0)), F.lit(0).cast("bigint"), lambda a, b: F.greatest(a, b))
        starts = F.reverse(running(F.reverse(F.transform(every, lambda s: F.when(s["other"], s["start"]).otherwise(far))), far, lambda a, b: F.least(a, b)))
        near = F.arrays_zip(every.alias("s"), ends.alias("before"), starts.alias("after"))
        free = F.filter(near, lambda n: ~n["s"]["other"] & (n["before"] <= n["s"]["start"]) & (n["after"] >= n["s"]["end"]))
        return F.transform(free, lambda n: F.struct(n["s"]["start"].alias("start"), n["s"]["kind"].alias("kind"), n["s"]["end"].alias("end"), n["s"]["value"].alias("value")))

    return F.when(F.size(some) > 0, once(F.array_sort(F.concat(tag(some, False), tag(others, True))), merged)).otherwise(some)


def written(spans: Column, kinds: list[str]) -> Column:
    """`kind:start:end`, comma-joined, of spans sorted by start and kind."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("bigint")


def replaced(text: Column, spans: Column, marker) -> Column:
    """The text with each span replaced by `marker(span)`; of overlapping spans the first one counts.

    Spans are taken in blocks: a block's stretch of the text is cut out once, and its spans are replaced within it.
    """
    def whole(every: Column) -> Column:
        # For a span that counts, where the one before it ended; -1 for one that overlaps it.
        at = running(every, F.lit(0).cast("bigint"), lambda at, s: F.when(s["start"] >= at, s["end"]).otherwise(at),
                     lambda at, s: F.when(s["start"] >= at, at).otherwise(F.lit(-1).cast("bigint")))
        kept = F.filter(F.arrays_zip(every.alias("s"), at.alias("at")), lambda z: z["at"] >= 0)
        return once(kept, lambda k: once(blocks(k), joined))

    def joined(cut: Column) -> Column:
        done = F.transform(cut, stretch)
        last = F.element_at(F.element_at(cut, -1), -1)["s"]["end"]
        return F.concat(F.array_join(done, ""), F.substring(text, (last + 1).cast("int"), F.length(text)))

    def stretch(part: Column) -> Column:
        begin, end = F.get(part, F.lit(0))["at"], F.element_at(part, -1)["s"]["end"]
        body = F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))
        return once(body, lambda b: F.array_join(F.transform(part, lambda z: F.concat(
            F.substring(b, (z["at"] - begin + 1).cast("int"), (z["s"]["start"] - z["at"]).cast("int")), marker(z["s"]))), ""))

    return F.when(F.size(spans) > 0, once(spans, whole)).otherwise(text)
