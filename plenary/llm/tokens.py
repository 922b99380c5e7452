"""Words of Arrow string columns as numpy arrays: borders and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20  # bytes of text handled at a time; a longer text is a chunk of its own

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []

# Python's and the contract's white space: blank and the control characters 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
# For word features: all of ASCII that is neither a letter, a digit nor an apostrophe.
PUNCTUATION = np.array([b < 128 and not (chr(b).isalnum() or b == 39) for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the splitmix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, CHUNK + 1)
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)])) for b in (_BASE, _INVERSE)]
    return _powers


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, text offsets) for stretches of a string column; nulls are empty texts."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def find_words(data: np.ndarray, starts: np.ndarray, separators: np.ndarray = SPACES):
    """Maximal stretches of bytes that are no separators: (begin, end, hash, word offsets per text)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = starts[:-1][starts[:-1] < len(data)]
    tails = starts[1:][starts[1:] > 0] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, stretch_hashes(data, begin, end), np.searchsorted(begin, starts)


def stretch_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the non-empty stretches of bytes from `begin` to before `end`."""
    power, inverse = _tables(len(data))
    total = np.cumsum(_BYTE[data] * power[: len(data)])
    value = total[end - 1] - np.where(begin > 0, total[begin - 1], np.uint64(0))
    return mix(value * inverse[begin] + (end - begin).astype(np.uint64))


def word_hash(word: str) -> int:
    """The hash that `find_words` gives a word that holds no separator."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(find_words(data, np.array([0, len(data)]), np.zeros(256, bool))[2][0])


def owner(offsets: np.ndarray) -> np.ndarray:
    """The text number of each item, given the items' offsets per text."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def grams(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words within a text, and their offsets per text.

    A text of fewer than n words, but at least one, has a single gram of all its words.
    """
    counts = np.diff(offsets)
    if len(hashes) == 0:
        return hashes, np.zeros(len(offsets), np.int64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    left = np.repeat(offsets[1:], counts) - np.arange(len(hashes))  # words from here to the text's end
    value = np.zeros(len(hashes), np.uint64)
    for k in range(n):
        part = padded[k: k + len(hashes)] * np.uint64((0x632BE59BD9B4E019 * (2 * k + 3)) % (1 << 64) | 1)
        value += np.where(left > k, part, np.uint64(0))
    start = np.arange(len(hashes)) == np.repeat(offsets[:-1], counts)
    keep = (left >= n) | (start & (left < n))
    kept = np.concatenate([[0], np.cumsum(keep)])
    return mix(value[keep]), kept[offsets]
