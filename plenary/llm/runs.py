"""Periodic runs of words by internal pattern matching.

All texts of a stretch are put end to end, as symbols that differ from text to text. Prefix doubling sorts the suffixes
and names every stretch of 1, 2, 4, … symbols, so the occurrences of an aligned block of 2^k symbols are one interval of
the suffix array. A wavelet tree over that interval's places answers range successors: the first, second and last
occurrence in each of the windows after the block. Within a window no longer than the block they form an arithmetic
progression, so these three tell all of them.

Every distance from a block to a later occurrence is a candidate period; common extensions in both directions, read off
the names, turn it into a maximal run. None is missed: a run of period q and length l holds an aligned block of L symbols
whose copy stands q further on, L being the greatest power of two with 2 L - 1 <= l - q, and then q <= 4 L - 2.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plenary.llm import tokens

LEAST = 12  # words of a run
SEED = LEAST // 2  # words that a run of LEAST or more repeats a period further on
STRETCH_BYTES = 4 << 20  # of text handled together; a longer text is handled alone
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class RangeSuccessor:
    """A wavelet tree (in matrix form) over distinct numbers below `top`: order statistics of any interval of places."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels, self.top = [], top
        for bit in range(max(top.bit_length(), 1) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)])
            self.levels.append((bit, words, before, len(ones) - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        return before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of the places low <= i < high are less than `bound`."""
        bound = np.minimum(bound, self.top)
        count = np.zeros(len(low), np.int64)
        for bit, words, before, zeros in self.levels:
            left, right = self._ones(words, before, low), self._ones(words, before, high)
            up = (bound >> bit & 1).astype(bool)
            count += np.where(up, (high - right) - (low - left), 0)
            low, high = np.where(up, zeros + left, low - left), np.where(up, zeros + right, high - right)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of this rank, from 0, among those of the places low <= i < high."""
        result = np.zeros(len(low), np.int64)
        for bit, words, before, zeros in self.levels:
            left, right = self._ones(words, before, low), self._ones(words, before, high)
            small = (high - right) - (low - left)
            up = rank >= small
            rank = np.where(up, rank - small, rank)
            result |= up.astype(np.int64) << bit
            low, high = np.where(up, zeros + left, low - left), np.where(up, zeros + right, high - right)
        return result


def doubling(symbols: np.ndarray):
    """(suffixes in order, names, repeated places): names[k][i] names the 2^k symbols from i.

    A name is the first place, in the order of suffixes, of those that begin with the stretch. `repeated` has, per k, the
    stretches that occur more than once, as (place in the text, number of occurrences).
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    names, repeated, seat, key, name = [], [], np.arange(n), symbols[order], np.zeros(n, np.int32)
    at = order
    while True:
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        width = np.diff(np.append(first, len(key)))
        name = name.copy()
        name[at] = np.repeat(seat[first], width)
        names.append(name)
        wide = np.repeat(width, width)
        keep = wide > 1
        repeated.append((at[keep], wide[keep]))
        seat, at = seat[keep], at[keep]
        if not len(seat):
            return order, names, repeated
        further = at + (1 << len(names) - 1)
        key = name[at].astype(np.int64) * (n + 1) + np.where(further < n, name[np.minimum(further, n - 1)] + 1, 0)
        turn = np.argsort(key)  # old groups stay in place, as the key begins with their names
        at, key = at[turn], key[turn]
        order[seat] = at


def extension(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """Length of the longest common stretch that begins at i and at j > i (`back`: that ends there)."""
    n, length = len(names[0]), np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        a, b = (i - length - (1 << k) + 1, j - length - (1 << k) + 1) if back else (i + length, j + length)
        inside = (a >= 0) & (b < n)
        same = names[k][np.where(inside, a, 0)] == names[k][np.where(inside, b, 0)]
        length += (inside & same).astype(np.int64) << k
    return length


def candidates(order: np.ndarray, names: list[np.ndarray], repeated: list) -> tuple[np.ndarray, np.ndarray]:
    """(place of a block, distance to a later occurrence), every pair that can belong to a run's smallest period."""
    kept = np.zeros(len(order), bool)
    kept[repeated[1][0]] = True  # suffixes whose first two symbols recur; all others stand alone in every interval
    seats = kept[order]
    shift = np.concatenate([[0], np.cumsum(seats)])
    tree = RangeSuccessor(order[seats].astype(np.int64), len(order))
    blocks, gaps = [], []
    for k in range(1, len(repeated)):
        size = 1 << k
        aligned = repeated[k][0] % size == 0
        block = repeated[k][0][aligned].astype(np.int64)
        low = shift[names[k][block]]
        high = low + repeated[k][1][aligned]
        edges = [block + 1, block + 1 + size, block + 1 + 2 * size, block + 1 + 3 * size, block + 4 * size - 1]
        ranks = [tree.below(low, high, e) for e in edges]
        chain = block.copy()  # last occurrence of the progression that the block itself begins
        step = np.zeros(len(block), np.int64)  # its difference, 0 once it has ended
        for turn, (since, until) in enumerate(zip(ranks, ranks[1:])):
            hit = np.flatnonzero(until > since)
            if not len(hit):
                step[:] = 0
                continue
            count = (until - since)[hit]
            first = tree.smallest(low[hit], high[hit], since[hit])
            several = np.flatnonzero(count > 1)
            gap, last = np.zeros(len(hit), np.int64), first.copy()
            gap[several] = tree.smallest(low[hit][several], high[hit][several], since[hit][several] + 1) - first[several]
            last[several] = tree.smallest(low[hit][several], high[hit][several], until[hit][several] - 1)
            # Occurrences one after another at the block's own period lie in one run with it: only the first distance counts.
            ahead = first - chain[hit]
            same = (count > 2) & (ahead == gap) & ((step[hit] == gap) if turn else True)
            listed = np.where(same, 1 if turn == 0 else 0, count)
            of = np.repeat(np.arange(len(hit)), listed)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(listed) - listed, listed)
            blocks.append(block[hit][of])
            gaps.append(first[of] + nth * gap[of] - block[hit][of])
            step[:] = np.where(np.bincount(hit[same], minlength=len(step)) > 0, step, 0)
            step[hit[same]], chain[hit[same]] = gap[same], last[same]
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(blocks), np.concatenate(gaps)


def find_runs(symbols: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all maximal stretches of two periods and `least` symbols or more, by start and period."""
    none = np.zeros(0, np.int64)
    if len(symbols) < 2:
        return none, none, none
    order, names, repeated = doubling(symbols)
    if len(repeated) < 2:
        return none, none, none
    block, period = candidates(order, names, repeated)
    start = block - extension(names, block - 1, block + period - 1, back=True)
    end = block + period + extension(names, block, block + period)
    long = np.flatnonzero(end - start >= np.maximum(2 * period, least))
    # A stretch with several periods is one run, of the smallest of them.
    turn = long[np.lexsort((period[long], end[long], start[long]))]
    start, end, period = start[turn], end[turn], period[turn]
    first = np.ones(len(turn), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    turn = np.lexsort((period, start))
    return start[turn], end[turn], period[turn]


def with_repeats(words: np.ndarray, offsets: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Numbers of the texts in which some `seed` words in a row occur twice; no other text has a run of 2 * seed words."""
    gram, bounds = tokens.grams(words, offsets, seed)
    of = tokens.owner(bounds)
    gram = tokens.mix(gram + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    turn = np.argsort(gram)
    return np.unique(of[turn[1:][gram[turn[1:]] == gram[turn[:-1]]]])


def woven(count: int, number: int) -> np.ndarray:
    """Which word stands at each place of a text of `count` words that is made to repeat itself, as `number` says."""
    since = number % count
    places = np.arange(count)
    return np.where(places < since, places, since + (places - since) % (1 + (count - since) // (3 + number % 8)))


def _stretch(ids: pa.Array, numbers: pa.Array, data: np.ndarray, starts: np.ndarray, least: int) -> pa.RecordBatch:
    begin, end, words, offsets = tokens.find_words(data, starts)
    sizes = np.diff(offsets)
    known = np.asarray(numbers.is_valid())
    weave = np.asarray(numbers.fill_null(0))
    places = {}  # of the words of each rewoven text
    for d in np.flatnonzero(known & (sizes > 0)):
        places[d] = woven(int(sizes[d]), int(weave[d]))
        words[offsets[d]: offsets[d + 1]] = words[offsets[d]: offsets[d + 1]][places[d]]
    open_ = with_repeats(words, offsets, least // 2)
    # One symbol after each text occurs nowhere else, and symbols of different texts differ.
    size, seed = sizes[open_], tokens.mix(open_.astype(np.uint64) + np.uint64(1))
    ends = np.cumsum(size + 1) - 1
    symbols = np.zeros(int((size + 1).sum()), np.uint64)
    inner = np.ones(len(symbols), bool)
    inner[ends] = False
    take = np.repeat(offsets[open_] - (ends - size) + np.arange(len(open_)), size) + np.flatnonzero(inner) - np.repeat(np.arange(len(open_)), size)
    symbols[inner] = tokens.mix(words[take] + np.repeat(seed, size))
    symbols[ends] = tokens.mix(seed ^ np.uint64(0xD1B54A32D192ED03))
    start, stop, period = find_runs(symbols, least)
    of = np.searchsorted(ends, start)
    base = (ends - size)[of]
    fields = [pa.array(start - base), pa.array(stop - start), pa.array(period)]
    bounds = np.searchsorted(open_[of], np.arange(len(sizes) + 1))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    # Words that a run holds after its first period go.
    gone = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, stop, -1)
    gone = np.cumsum(gone) > 0
    at = dict(zip(open_.tolist(), (ends - size).tolist()))
    body, texts = data.tobytes(), []
    for d in range(len(sizes)):
        parts = body[starts[d]: starts[d + 1]].split()
        if d in places:
            parts = [parts[i] for i in places[d].tolist()]
        if bounds[d + 1] > bounds[d]:
            parts = [w for w, out in zip(parts, gone[at[d]: at[d] + len(parts)].tolist()) if not out]
        texts.append(b" ".join(parts))
    return pa.RecordBatch.from_arrays([ids, pa.array(sizes), lists, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, weave: Column | None = None, least: int = LEAST) -> DataFrame:
    """All periodic runs of words of every whole text, and the text without their repetitions.

    A run is a stretch of at least `least` words and two smallest periods that no neighbouring word extends.

    Args:
        docs: `doc_id` and `text`; other columns are ignored.
        weave: a number at which a text is first made to repeat itself (`woven`); null leaves it as it is.
        least: words of a run, an even number from 6 on.

    Returns:
        `doc_id`, `n_words`, `runs` of (start word, length, period) by start and period, and `collapsed`: the words that
        no run holds after its first period, joined by one blank. One row per row of `docs`; repeated rows are rows of
        their own. A null, empty or blank text has no word, no run and an empty `collapsed`. Words are compared by 64-bit
        hashes. No rows are moved between tasks.
    """

    def run(batches):
        for batch in batches:
            for row, end, data, starts in tokens.chunks(batch.column(1), STRETCH_BYTES):
                yield _stretch(batch.column(0).slice(row, end - row), batch.column(2).slice(row, end - row), data, starts, least)

    number = F.lit(None).cast("bigint") if weave is None else weave.cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", number.alias("weave"))
    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")
