"""SentencePiece encoding and decoding through a suffix array of the batch.

The words of a batch (each with the blanks before it; no piece goes on beyond a word) are listed once and put end to
end. A suffix array of that text is binary-searched for every piece, which gives the ranges of its occurrences, and
these are the edges. Edges are sorted by word, rank and position and relaxed in rounds: in every word the best
edge that joins two neighbouring symbols takes effect, as byte-pair encoding asks, until none is left.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from plenary.llm import tokens

_BLANK = "▁"
SLICE_BYTES = 1 << 19  # of distinct words handled at a time; a longer word is handled alone
BATCH_BYTES = 3 << 20  # of text that is indexed together
LONG = 400  # words of more symbols are relaxed with a heap


@dataclass(frozen=True)
class Pieces:
    """Piece bytes by id (blank for the mark, one raw byte for byte pieces) and the ids that can match a text."""

    data: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray  # matching pieces, best score first
    byte_ids: np.ndarray
    unknown: int


def load(model_file: str) -> Pieces:
    """Reads the pieces and scores of a model; the library is used for nothing else."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    body, usable, byte_ids = [], [], np.full(256, -1, np.int64)
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            body.append(bytes([int(piece[1:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            body.append(b"" if model.is_control(i) else " ⁇ ".encode())
        else:
            body.append(piece.replace(_BLANK, " ").encode())
            if not model.is_unused(i):
                usable.append(i)
    usable.sort(key=lambda i: (-model.get_score(i), i))
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in body])])
    return Pieces(np.frombuffer(b"".join(body), np.uint8), offsets, np.array(usable, np.int64), byte_ids, model.unk_id())


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, … (lengths[0] numbers), starts[1], …"""
    total = int(lengths.sum())
    kind = np.int32 if total + (int(starts.max()) if len(starts) else 0) < 1 << 31 else np.int64
    shift = starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(starts) else starts
    out = np.repeat(shift.astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def _keys(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight bytes from each place, and the eight after them, as numbers that sort like the bytes."""
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    key = np.zeros(len(text) + 8, np.uint64)
    for k in range(8):
        key <<= np.uint64(8)
        key |= padded[k: k + len(text) + 8]
    return key[:-8], key[8:]


def _number(piece: bytes, filler: bytes) -> int:
    return int.from_bytes((piece + filler * 8)[:8], "big")


class Patterns:
    """Byte strings to search for, with the numbers that their binary search and comparison need."""

    def __init__(self, items: list[bytes]):
        self.items = items
        self.size = np.array([len(p) for p in items], np.int32)
        self.first = np.array([_number(p, b"\0") for p in items], np.uint64)
        self.last = np.array([_number(p, b"\xff") for p in items], np.uint64)
        self.rest = np.array([_number(p[8:], b"\0") for p in items], np.uint64)
        self.mask = np.array([_number(b"\xff" * min(len(p[8:]), 8), b"\0") for p in items], np.uint64)


class SuffixArray:
    """Places of a text in the order of the eight bytes that follow them, to be searched for pieces."""

    def __init__(self, text: np.ndarray):
        self.text = text
        high, self.low = _keys(text)
        self.order = np.argsort(high)
        self.keys = high[self.order]

    def occurrences(self, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
        """(place, pattern number) of all occurrences: ranges by binary search, longer patterns read on at the place."""
        first = np.searchsorted(self.keys, patterns.first, "left")
        counts = np.searchsorted(self.keys, patterns.last, "right") - first
        place = self.order[spread(first, counts)]
        number = np.repeat(np.arange(len(counts)), counts)
        at = np.flatnonzero(patterns.size[number] > 8)
        if len(at):
            keep = np.ones(len(place), bool)
            keep[at] = (self.low[place[at]] & patterns.mask[number[at]]) == patterns.rest[number[at]]
            at = at[keep[at] & (patterns.size[number[at]] > 16)]
            if len(at):
                whole = self.text.tobytes()
                keep[at] = [whole.startswith(patterns.items[number[e]], int(place[e])) for e in at]
            place, number = place[keep], number[keep]
        return place, number


def _relax_rounds(place, end, rank, word, following, symbol):
    """One merge per word and round: the first edge of the word that joins exactly two symbols.

    `following` holds the end of the symbol that starts at a place, and 0 where none does any more.
    """
    while len(place):
        middle = following[place]
        alive = (middle > 0) & (middle < end) & (following[end] > 0)
        place, end, rank, word, middle = place[alive], end[alive], rank[alive], word[alive], middle[alive]
        at = np.flatnonzero(following[middle] == end)
        if len(at) == 0:
            return
        of = word[at]
        best = at[np.concatenate([[True], of[1:] != of[:-1]])]
        following[middle[best]] = 0  # the second symbol ends to be one
        following[place[best]] = end[best]
        symbol[place[best]] = rank[best]
        moved = np.zeros(int(word[-1]) + 1, bool)
        moved[of] = True
        alive = moved[word]  # without a merge a word is done
        place, end, rank, word = place[alive], end[alive], rank[alive], word[alive]


def _relax_heap(begin, stop, place, end, rank, following, symbol):
    """The same for one long word, with a heap over the edges that join two symbols."""
    edges = {(int(a), int(b)): int(r) for a, b, r in zip(place, end, rank)}
    before, p, last = {}, begin, -1
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int):
        m = int(following[a])
        if m < stop:
            b = int(following[m])
            r = edges.get((a, b))
            if r is not None:
                heapq.heappush(heap, (r, a, m, b))

    while p < stop:
        before[p], last = last, p
        p = int(following[p])
    p = begin
    while p < stop:
        offer(p)
        p = int(following[p])
    while heap:
        r, a, m, b = heapq.heappop(heap)
        if following[a] != m or m not in before or following[m] != b:
            continue
        following[a], following[m] = b, 0
        del before[m]
        symbol[a] = r
        if b < stop:
            before[b] = a
            offer(a)
        if before[a] >= 0:
            offer(before[a])


def encode_words(data: np.ndarray, begin: np.ndarray, size: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of each word of a text, end to end, and how many each word has."""
    body = pieces.data.tobytes()
    items = [body[pieces.offsets[i]: pieces.offsets[i + 1]] for i in pieces.ids]
    patterns, chars = Patterns(items), np.array([len(p.decode()) for p in items])
    out, counts, done = [], [], 0
    total = np.cumsum(size + 1)
    while done < len(begin):
        limit = (total[done - 1] if done else 0) + SLICE_BYTES
        stop = max(int(np.searchsorted(total, limit, "right")), done + 1)
        ids, n = _encode_slice(data, begin[done:stop], size[done:stop], pieces, patterns, chars)
        out.append(ids)
        counts.append(n)
        done = stop
    return np.concatenate(out) if out else np.zeros(0, np.int64), np.concatenate(counts) if counts else np.zeros(0, np.int64)


def _encode_slice(data, begin, size, pieces, patterns, chars):
    text = np.zeros(int((size + 1).sum()), np.uint8)  # a zero byte, which no piece holds, ends each word
    head = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    inside = spread(head, size)
    text[inside] = data[spread(begin, size)]
    word_of = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)
    starts = (text & 0xC0) != 0x80
    starts[head + size] = False
    ends = np.flatnonzero(starts).astype(np.int32)
    following = np.zeros(len(text), np.int32)
    following[ends] = np.minimum(np.append(ends[1:], len(text)), (head + size)[word_of[ends]])
    following[head + size] = 1  # a word's end stays a border
    symbol = np.full(len(text), -1, np.int32)
    place, rank = SuffixArray(text).occurrences(patterns)
    fits = starts[place]
    place, rank = place[fits], rank[fits]
    single = chars[rank] == 1
    symbol[place[single]] = rank[single]
    place, rank = place[~single], rank[~single]
    low, high = len(text).bit_length(), len(patterns.items).bit_length()
    edges = (word_of[place].astype(np.int64) << (low + high)) | (rank << low) | place
    edges.sort()  # by word, then rank, then place
    word, rank, place = (edges >> (low + high)), (edges >> low) & ((1 << high) - 1), edges & ((1 << low) - 1)
    word, rank, place = word.astype(np.int32), rank.astype(np.int32), place.astype(np.int32)
    end = place + patterns.size[rank]
    long = np.bincount(word_of[ends], minlength=len(size)) > LONG
    if long.any():
        for w in np.flatnonzero(long):
            a, b = np.searchsorted(word, [w, w + 1])
            _relax_heap(int(head[w]), int(head[w] + size[w]), place[a:b], end[a:b], rank[a:b], following, symbol)
        short = ~long[word]
        place, end, rank, word = place[short], end[short], rank[short], word[short]
    _relax_rounds(place, end, rank, word, following, symbol)
    following[head + size] = 0
    at = np.flatnonzero(following)
    best = symbol[at]
    known = best >= 0
    if known.all():
        return pieces.ids[best], np.bincount(word_of[at], minlength=len(size))
    by_byte = pieces.byte_ids[0] >= 0
    spans = np.where(known | (not by_byte), 1, following[at] - at)
    flat = np.repeat(np.where(known, pieces.ids[np.maximum(best, 0)], pieces.unknown), spans)
    if by_byte:
        raw = np.repeat(~known, spans)
        flat[raw] = pieces.byte_ids[text[spread(at, spans)[raw]]]
    return flat, np.bincount(word_of[at], spans, len(size)).astype(np.int64)


def encode_batch(column: pa.Array, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts end to end, and their offsets per text."""
    column = pc.replace_substring(column.fill_null(""), _BLANK, " ")
    marked = pc.if_else(pc.equal(pc.binary_length(column), 0), "", pc.binary_join_element_wise(" ", column, ""))
    begins, sizes, hashes, per_text, buffers, shift = [], [], [], [], [], 0
    blank = np.zeros(256, bool)
    blank[32] = True
    for _, _, data, starts in tokens.chunks(marked):
        is_blank = blank[data]
        head = is_blank.copy()
        head[1:] &= ~is_blank[:-1]
        head[starts[:-1][starts[:-1] < len(data)]] = True
        begin = np.flatnonzero(head)
        size = np.diff(np.append(begin, len(data)))
        hashes.append(tokens.stretch_hashes(data, begin, begin + size))
        per_text.append(np.diff(np.searchsorted(begin, starts)))
        begins.append(begin + shift)
        sizes.append(size)
        buffers.append(data)
        shift += len(data)
    if not buffers:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    data, begin, size = np.concatenate(buffers), np.concatenate(begins), np.concatenate(sizes)
    _, sample, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    ids, counts = encode_words(data, begin[sample], size[sample], pieces)
    first = np.concatenate([[0], np.cumsum(counts)])
    repeat = counts[inverse]
    flat = ids[spread(first[inverse], repeat)]
    words = np.concatenate([[0], np.cumsum(np.concatenate(per_text))])
    return flat, np.concatenate([[0], np.cumsum(repeat)])[words]


def decode_batch(ids: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and their offsets; the mark before the first word is taken away."""
    lengths = np.diff(pieces.offsets)
    parts, counts = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)]
    for at in range(0, len(ids), 1 << 19):  # places of half a million pieces at a time
        part = ids[at: at + (1 << 19)]
        size = lengths[part]
        parts.append(pieces.data[spread(pieces.offsets[part], size)])
        counts.append(size)
    data = np.concatenate(parts)
    bounds = np.cumsum(np.concatenate(counts))[offsets]
    keep = np.ones(len(data), bool)
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    keep[heads[data[heads] == 32]] = False
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def encode(docs: DataFrame, model_file: str, column: str = "text") -> DataFrame:
    """`docs` with `ids` (array of int) and `round_trip` (decoding gives the text back) in place of same-named columns.

    A null or empty text has no ids. The mark U+2581 counts as a blank, so a text that holds it decodes to blanks and
    its `round_trip` is false. Rows may repeat and texts may be of any length; each is encoded whole.

    Args:
        model_file: a SentencePiece BPE model, read on the driver once.
    """
    pieces = load(model_file)
    names = [c for c in docs.columns if c not in ("ids", "round_trip")]
    place = names.index(column)

    def run(batches):
        for batch in batches:
            at, rows = 0, batch.num_rows
            sizes = np.cumsum(pc.binary_length(batch.column(place).fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < rows:
                end = max(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_BYTES, "right")), at + 1)
                part = batch.slice(at, end - at)
                text = part.column(place).fill_null("")
                ids, offsets = encode_batch(text, pieces)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                same = round_trip(text, *decode_batch(ids, offsets, pieces))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(same)], names=[f"c{i}" for i in range(len(names) + 2)])
                at = end

    schema = ", ".join(f"c{i} {docs.schema[n].dataType.simpleString()}" for i, n in enumerate(names))
    plain = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))])
    out = plain.mapInArrow(run, f"{schema}, c{len(names)} array<int>, c{len(names) + 1} boolean")
    return out.toDF(*names, "ids", "round_trip")


def round_trip(text: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the decoded bytes of each row are its text."""
    whole = text.cast(pa.large_binary())
    wanted = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset: whole.offset + len(whole) + 1]
    given = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[wanted[0]: wanted[-1]]
    same = np.diff(wanted) == np.diff(offsets)
    if same.all() and len(given) == len(data):
        wrong = np.flatnonzero(given != data)
        same[np.unique(np.searchsorted(offsets, wrong, "right") - 1)] = False
        return same
    body, source = data.tobytes(), given.tobytes()
    shift = wanted - wanted[0]
    return np.array([body[a:b] == source[c:d] for a, b, c, d in zip(offsets[:-1], offsets[1:], shift[:-1], shift[1:])], bool)


def decode(encoded: DataFrame, model_file: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`encoded` with the text of its ids in a new column; null or no ids give an empty text."""
    pieces = load(model_file)
    columns = [c for c in encoded.columns if c != name]
    place = columns.index(ids)

    def run(batches):
        for batch in batches:
            lists = batch.column(place)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            data, offsets = decode_batch(flat, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), pieces)
            body = data.tobytes()
            texts = [body[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[f"c{i}" for i in range(len(columns) + 1)])

    schema = ", ".join(f"c{i} {encoded.schema[n].dataType.simpleString()}" for i, n in enumerate(columns))
    plain = encoded.select(*columns).toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.mapInArrow(run, f"{schema}, c{len(columns)} string").toDF(*columns, name)

