"""Language ID: cross-parsing entropy with one suffix automaton per language.

A text is cut into the longest phrases that occur in a language's sample. The fewer phrases per byte, weighed by
the bits that name a place in the sample, the closer the language. Bytes of letters count in lower case, every
other stretch as one separator. All texts are parsed side by side: each step reads one byte of every lane and
follows one table, which gives the automaton's move or, where there is none, a new phrase from the start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from plenary.llm import tokens

SAMPLE_TEXTS = 60
SAMPLE_BYTES = 16 << 10
LANE = 512  # bytes per lane; a longer text is parsed as several lanes whose phrases are added up
MOST_BITS = 5.5  # random letters need more, prose of a learnt language about half
TELLING_BYTES = 64  # from here on prose (some 13 phrases of 14 bits) is three standard deviations below the 25 of MOST_BITS
_NEW = np.int32(-(1 << 31))

_SIGNS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def suffix_automaton(symbols: bytes | list[int]) -> list[dict[int, int]]:
    """Moves of the automaton that accepts every substring; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in symbols:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return moves


@dataclass(frozen=True)
class Model:
    """Languages, one table of moves for all, the byte classes, and each language's bits per phrase."""

    languages: list[str]
    roots: np.ndarray
    table: np.ndarray
    classes: np.ndarray
    bits: np.ndarray


def normal_bytes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every stretch of signs as one blank; texts begin anew."""
    if len(data) == 0:
        return data, starts
    sign = _SIGNS[data]
    drop = np.zeros(len(data), bool)
    drop[1:] = sign[1:] & sign[:-1]
    heads = starts[:-1][starts[:-1] < len(data)]
    drop[heads] = False
    kept = np.concatenate([[0], np.cumsum(~drop)])
    return np.where(sign, np.uint8(32), data)[~drop], kept[starts]


def train(samples: dict[str, list[str]], sample_bytes: int = SAMPLE_BYTES) -> Model:
    """One automaton per language over whole sample texts, up to `sample_bytes` (at least one text) each."""
    languages, coded = sorted(samples), {}
    for name in languages:
        column, body = pa.array([t.lower() for t in samples[name]], pa.string()), b""
        for _, _, data, starts in tokens.chunks(column):
            data, starts = normal_bytes(data, starts)
            for a, b in zip(starts[:-1], starts[1:]):
                if not body or len(body) + b - a <= sample_bytes:
                    body += data[a:b].tobytes() + b" "
        coded[name] = body
    used = sorted(set(b"".join(coded.values())))
    classes = np.ones(256, np.int32)  # 0 fills lanes up, 1 is a byte that no sample holds
    classes[used] = np.arange(2, len(used) + 2)
    width, tables, roots, bits, base = len(used) + 2, [], [], [], 0
    for name in languages:
        moves = suffix_automaton(classes[np.frombuffer(coded[name], np.uint8)].tolist())
        moves.append({})  # the state between phrases, in which every byte begins a new one
        start = np.full(width, (base + len(moves) - 1) * width, np.int64)
        for c, state in moves[0].items():
            start[c] = (base + state) * width
        table = np.tile(start.astype(np.int32) | _NEW, (len(moves), 1))
        for state, out in enumerate(moves):
            table[state, 0] = (base + state) * width
            if out:
                table[state, list(out)] = (base + np.fromiter(out.values(), np.int64)) * width
        tables.append(table)
        roots.append((base + len(moves) - 1) * width)
        bits.append(np.log2(max(len(coded[name]), 2)))
        base += len(moves)
    table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
    return Model(languages, np.array(roots, np.int32), table, classes, np.array(bits))


def phrases(model: Model, column: pa.Array, lane: int = LANE):
    """(first row, end row, phrase counts by language and text, bytes parsed) per stretch of rows."""
    for row, end, data, starts in tokens.chunks(pc.utf8_lower(column.fill_null(""))):
        data, starts = normal_bytes(data, starts)
        code = model.classes[data]
        sizes = np.diff(starts)
        lanes = -(-sizes // lane)
        doc = np.repeat(np.arange(len(sizes)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = starts[doc] + nth * lane
        size = np.minimum(sizes[doc] - nth * lane, lane)
        order = np.argsort(-size, kind="stable")
        grid = np.zeros((int(size.max(initial=0)), len(doc)), np.int32)
        column_of = np.empty(len(doc), np.int64)
        column_of[order] = np.arange(len(doc))
        within = np.arange(len(code)) - np.repeat(begin, size)
        grid[within, np.repeat(column_of, size)] = code
        state = np.repeat(model.roots[:, None], len(doc), 1)
        count = np.zeros((len(model.languages), len(doc)), np.int32)
        longest = size[order]
        for step in range(int(longest[0]) if len(longest) else 0):
            live = int(np.searchsorted(-longest, -step, "left"))  # lanes longer than `step` come first
            move = model.table[state[:, :live] + grid[step, :live]]
            count[:, :live] -= move >> 31
            state[:, :live] = move & 0x7FFFFFFF
        total = np.stack([np.bincount(doc[order], c, len(sizes)) for c in count]) if len(count) else np.zeros((0, len(sizes)))
        yield row, end, total, sizes


def decide(model: Model, total: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number, score, bits per byte) of each text; -1, 0 and 0 if the model knows no language.

    The score is the runner-up's share of the two least entropies together, so 0.5 is a tie; with a single
    language it is 1. Ties go to the name that sorts first.
    """
    if not model.languages:
        return np.full(len(sizes), -1), np.zeros(len(sizes)), np.zeros(len(sizes))
    bits = total * model.bits[:, None] / np.maximum(sizes, 1)
    least = np.sort(bits, 0)[:2]
    score = least[1] / np.maximum(least.sum(0), 1e-12) if len(least) == 2 else np.ones(len(sizes))
    return np.argmin(bits, 0), score, least[0]


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte), one row per row of `docs`; `und`, 0 and 0 without a letter."""
    names = np.array([*model.languages, "und"], object)

    def run(batches):
        for batch in batches:
            ids, lettered = batch.column(0), np.asarray(batch.column(2).fill_null(False))
            for row, end, total, sizes in phrases(model, batch.column(1)):
                best, score, bits = decide(model, total, sizes)
                known = lettered[row:end] & (best >= 0)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(row, end - row), pa.array(names[np.where(known, best, -1)], pa.string()),
                    pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, bits, 0.0))],
                    ["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.col("text").rlike(r"\p{L}"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, bits_per_byte double")


def fit(docs: DataFrame, usable, sample_texts: int = SAMPLE_TEXTS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from at most `sample_texts` whole texts per non-null `lang`.

    Texts of up to a quarter of `sample_bytes` come first; if a language has none, one longer text is taken.
    """
    fits = docs.where(usable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    narrow = fits.select("doc_id", "lang", F.xxhash64("text").alias("_h"), (F.octet_length("text") > sample_bytes // 4).alias("_long"))
    order = Window.partitionBy("lang").orderBy("_long", F.xxhash64("doc_id"), "doc_id", "_h")
    ranked = narrow.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample_texts)
    chosen = ranked.where(~F.col("_long") | (F.col("_n") == 1)).drop("_n", "_long")
    rows = (fits.select("doc_id", "lang", "text", F.xxhash64("text").alias("_h"))
            .join(F.broadcast(chosen), ["doc_id", "lang", "_h"], "left_semi")  # sample_texts ids per language
            .select("lang", "text").distinct().collect())
    samples: dict[str, list[str]] = {}
    for name, text in sorted(rows):
        samples.setdefault(name, []).append(text)
    return train(samples, sample_bytes)


def identify(docs: DataFrame, usable, sample_texts: int = SAMPLE_TEXTS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Predicts the language of every whole text from `doc_id`, `text`, `lang`; other columns are ignored.

    Args:
        usable: condition on `doc_id` that marks the documents whose `lang` may be learnt from.

    Returns:
        `doc_id`, `lang_pred`, `score`, `bits_per_byte`; repeated rows each get theirs; nothing learnt means `und`.
    """
    return classify(docs, fit(docs, usable, sample_texts, sample_bytes))


def accepted(docs: DataFrame, model: Model, most_bits: float = MOST_BITS, telling_bytes: int = TELLING_BYTES) -> DataFrame:
    """The rows of `docs` whose text is in a learnt language, all columns as they are.

    A text is rejected if it is null, has no letter, or needs more than `most_bits` bits per byte even in its best
    language, as strings of random letters do. A text of fewer than `telling_bytes` normalised bytes is not judged by
    its bits, since one unseen word or the last phrase weighs too much in it: with a letter it stays. A model of no
    language rejects everything. The decision is taken beside the rows, so nothing is joined.
    """
    names = docs.columns
    place = names.index("text")

    def run(batches):
        for batch in batches:
            *columns, lettered = batch.columns
            keep = np.asarray(lettered.fill_null(False)).copy()
            for row, end, total, sizes in phrases(model, columns[place]):
                best, _, bits = decide(model, total, sizes)
                keep[row:end] &= (best >= 0) & ((bits <= most_bits) | (sizes < telling_bytes))
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in columns], names=[f"c{i}" for i in range(len(columns))])

    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    tagged = docs.toDF(*[f"c{i}" for i in range(len(names))])
    tagged = tagged.withColumn("_lettered", F.col(f"c{place}").rlike(r"\p{L}"))
    return tagged.mapInArrow(run, schema).toDF(*names)
