"""LM scoring: a gated recurrent network with a class-factored softmax over frequent words.

Texts become blocks of word numbers with the block's own vocabulary. Exact corpus counts come from exchanging the
blocks' vocabularies, cut into buckets by word hash: each bucket adds up its words over all blocks and answers every
block. The network is trained in numpy by backpropagation through windows, the state being carried from one window
to the next. Every token of every training document is learnt from: in each round all tasks go on from the same
weights over their own blocks, and the weights are averaged by the tokens seen. It predicts the class of the next word
and then the word within its class; words outside the frequent ones form one class, in which the smoothed corpus
counts decide.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from plenary.llm import tokens
from plenary.operators.index import materialize

BLOCK_BYTES = 8 << 20
SCORED_ROWS, LONGEST = 1 << 13, 1 << 10  # states computed at a time when scoring, and most words of a text among them
SCORED_TEXTS = 256  # read side by side when scoring
FREQUENT, CLASSES, HIDDEN = 1024, 32, 32
WINDOW, WIDE = 20, 256  # words a window, and most streams at a time, which share the cost of a step
LONGER = 8  # times a window's words, where few streams are left
TASK_TOKENS = 4 << 20  # of a task that are made into one set of streams
BUCKET_BYTES = 16 << 20  # of word hashes and counts that are added up together
ROUNDS = np.array([0, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 1])  # borders of the documents' shares after which weights are averaged
NEAR = 60  # exponentials of numbers up to this stay within 32-bit numbers, and so do their sums
MANY = 24  # rows of a word that are added up by themselves
TASKS, GATHERED = 3, 2  # tasks a core that learn at least, if there are as many stored parts, and most parts that one of them takes
SLICES = 64  # into which the weights are cut to be averaged
END = np.uint64(0x5DEECE66D1234567)  # stands for the end of a text among the word hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def encode(docs: DataFrame, train: Column) -> DataFrame:
    """(block, doc_ids, sizes, codes, words, trained, learnt): blocks of documents as numbers of the block's words, stored.

    `words` are the block's distinct hashes, ascending; `trained` counts them in the documents to learn from, which `learnt` marks.
    """

    def block(parts):
        ids, flags, hashes, sizes = zip(*parts)
        words, codes = np.unique(np.concatenate(hashes), return_inverse=True)
        size = np.concatenate(sizes)
        learnt = np.repeat(np.concatenate(flags), size)
        trained = np.bincount(codes[learnt], minlength=len(words)).astype(np.int64)
        blob = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)),
            blob(size.astype(np.int32)), blob(codes.astype(np.int32)), blob(words), blob(trained),
            blob(np.concatenate(flags)), pa.array([int(np.concatenate(flags).sum())])], ["doc_ids", "sizes", "codes", "words", "trained", "learnt", "texts"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for row, end, data, starts in tokens.chunks(batch.column(1)):
                _, _, word, offsets = tokens.find_words(_LOWER[data], starts)
                ids = batch.column(0).slice(row, end - row)
                flags = np.asarray(batch.column(2).slice(row, end - row).fill_null(False)).astype(bool)
                parts.append((ids, flags, word, np.diff(offsets)))
                held += len(data)
                if held >= BLOCK_BYTES:
                    yield block(parts)
                    parts, held = [], 0
        if parts:
            yield block(parts)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", train.alias("train"))
    out = rows.mapInArrow(run, "doc_ids array<bigint>, sizes binary, codes binary, words binary, trained binary, learnt binary, texts bigint")
    return materialize(out.withColumn("block", F.monotonically_increasing_id()))


def exchange(blocks: DataFrame, buckets: int, frequent: int = FREQUENT) -> DataFrame:
    """(block, bucket, counts, known, total, top): corpus counts for the words of each block and bucket, stored.

    `counts` is in the order of the block's words in that bucket. Rows with block -1 tell a bucket's distinct words
    and tokens, and its `frequent` most counted words.
    """
    bits = max(buckets - 1, 1).bit_length()

    def split(batches):
        for batch in batches:
            for number, words, trained in zip(*[c.to_pylist() for c in batch.columns]):
                words, trained = np.frombuffer(words, np.uint64), np.frombuffer(trained, np.int64)
                edges = np.searchsorted(words >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                used = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays([
                    pa.array(used, pa.int32()), pa.array(np.full(len(used), number)),
                    pa.array([words[edges[u]: edges[u + 1]].tobytes() for u in used], pa.binary()),
                    pa.array([trained[edges[u]: edges[u + 1]].tobytes() for u in used], pa.binary())], ["bucket", "block", "words", "trained"])

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        numbers = table.column("block").to_pylist()
        words = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
        trained = np.concatenate([np.frombuffer(c, np.int64) for c in table.column("trained").to_pylist()])
        distinct, inverse = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, inverse, trained)
        known = totals > 0
        order = np.lexsort((distinct, -totals))[:frequent]
        order = order[known[order]]
        top = np.stack([distinct[order].view(np.int64), totals[order]]).tobytes()
        answers = [a.tobytes() for a in np.split(totals[inverse], np.cumsum([len(w) for w in words])[:-1])]
        n = len(numbers)
        return pa.table({
            "block": pa.array([*numbers, -1], pa.int64()), "bucket": pa.array([bucket] * (n + 1), pa.int32()),
            "counts": pa.array([*answers, None], pa.binary()), "known": pa.array([0] * n + [int(known.sum())], pa.int64()),
            "total": pa.array([0] * n + [int(totals.sum())], pa.int64()), "top": pa.array([None] * n + [top], pa.binary())})

    asked = blocks.select("block", "words", "trained").mapInArrow(split, "bucket int, block bigint, words binary, trained binary")
    return materialize(asked.groupBy("bucket").applyInArrow(count, "block bigint, bucket int, counts binary, known bigint, total bigint, top binary"))


@dataclass
class Corpus:
    """What the whole corpus says: training tokens, distinct ones, texts, and the most frequent words with counts."""

    tokens: int
    distinct: int
    texts: int
    words: np.ndarray
    counts: np.ndarray

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one probability of tokens with these counts."""
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))


def corpus(blocks: DataFrame, answers: DataFrame, frequent: int = FREQUENT) -> Corpus:
    """Totals, and the `frequent` most counted tokens, of which the end of a text is always one."""
    texts = blocks.agg(F.sum("texts")).first()[0] or 0
    sums = answers.where("block = -1")
    known, total = sums.agg(F.sum("known"), F.sum("total")).first()

    def listed(batches):
        for batch in batches:
            for top in batch.column(0).to_pylist():
                words, counts = np.frombuffer(top, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], ["word", "n"])

    top = sums.select("top").mapInArrow(listed, "word bigint, n bigint").orderBy(F.desc("n"), "word").limit(frequent - 1).collect()
    words = np.array([END, *np.array([r["word"] for r in top], np.int64).view(np.uint64)], np.uint64)
    counts = np.array([texts, *[r["n"] for r in top]], np.int64)
    order = np.argsort(words)
    return Corpus((total or 0) + texts, (known or 0) + (texts > 0), texts, words[order], counts[order])


class Network:
    """The recurrent network. Word numbers follow `corpus.words`; one more stands for all rare words."""

    def __init__(self, seen: Corpus, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 3):
        rng = np.random.default_rng(seed)
        n = len(seen.words)
        self.rare, self.start, self.hidden = n, n + 1, hidden
        self.rooms: dict[str, np.ndarray] = {}  # work space, kept from one window to the next
        self.learnt = 0  # tokens, ends of texts included, that all rounds together learnt from
        # Frequent words go into classes of equal summed square roots of their counts, most frequent first.
        order = np.argsort(-seen.counts, kind="stable")
        weight = np.cumsum(np.sqrt(seen.counts[order] + 1.0))
        group = np.minimum((weight / weight[-1] * classes).astype(np.int64), classes - 1)
        group = np.unique(group, return_inverse=True)[1]
        self.word_class = np.empty(n + 1, np.int64)
        self.word_class[order] = group
        self.word_class[n] = self.classes = int(group[-1]) + 1
        self.by_class = np.argsort(self.word_class[:n], kind="stable")
        self.place = np.empty(n, np.int64)
        self.place[self.by_class] = np.arange(n)
        self.edges = np.searchsorted(self.word_class[:n][self.by_class], np.arange(self.classes + 1))
        share = (seen.counts + 1.0) / (seen.tokens + seen.distinct + 1)
        self.rare_share = max(1.0 - share.sum(), 1e-12)
        mass = np.append(np.bincount(self.word_class[:n], share, self.classes), self.rare_share)
        f = np.float32
        self.p = {
            "W": rng.normal(0, 0.1, (n + 2, 3 * hidden)).astype(f), "U": rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(f),
            "b": np.zeros(3 * hidden, f), "A": rng.normal(0, 0.02, (hidden, self.classes + 1)).astype(f), "a": np.log(mass).astype(f),
            "B": rng.normal(0, 0.02, (hidden, n)).astype(f), "c": np.log(share[self.by_class]).astype(f)}

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array of no particular content. Memory given back and asked for anew in each window would cost more than the sums."""
        size, kind = math.prod(shape), self.p["U"].dtype
        held = self.rooms.get(name)
        if held is None or held.size < size or held.dtype != kind:
            held = self.rooms[name] = np.empty(size, kind)
        return held[:size].reshape(shape)

    def outputs(self, states: np.ndarray, target: np.ndarray, learn: bool = False, chosen: np.ndarray | None = None):
        """ln probability of each target (rare words: of their class), and gradients of its negative if wanted.

        `chosen` are the rows of `states` that the targets belong to, by default all; the other rows have gradients of 0.
        """
        p = self.p
        # Rows are put in the order of their classes, so that each class is a slice.
        order = np.argsort(self.word_class[target].astype(np.uint16), kind="stable")
        n, h, kind, every = len(target), self.hidden, p["U"].dtype, len(states)
        source, target = order if chosen is None else chosen[order], target[order]
        states = np.take(states, source, 0, mode="clip", out=self.room("output", n, h)) if states.dtype == kind else states[source]
        bounds = np.searchsorted(self.word_class[target], np.arange(self.classes + 2)).tolist()
        place, ones = self.place[target[: bounds[-2]]], np.ones(max(self.classes + 1, int(np.diff(self.edges).max())), kind)
        shares = np.matmul(states, p["A"], out=self.room("shares", n, self.classes + 1))
        shares += p["a"]
        # No number is further from 0 than this; where all are near, their exponentials need no common factor taken out.
        reach = max(float(states.max(initial=1)), -float(states.min(initial=-1)))
        far = lambda weights, offset: float((np.abs(weights).sum(0) * reach + np.abs(offset)).max(initial=0)) > NEAR
        if far(p["A"], p["a"]):
            shares -= shares.max(1, keepdims=True)
        distant = far(p["B"], p["c"])
        value = np.empty(len(target), shares.dtype)
        for k in range(self.classes + 1):
            value[bounds[k]: bounds[k + 1]] = shares[bounds[k]: bounds[k + 1], k]
        np.exp(shares, out=shares)
        total = shares @ ones[: self.classes + 1]
        value -= np.log(total)
        grad_states = grads = None
        if learn:
            shares *= (1 / total)[:, None]
            for k in range(self.classes + 1):
                shares[bounds[k]: bounds[k + 1], k] -= 1
            every_one = np.ones(n, kind)
            grads = {"A": states.T @ shares, "a": every_one @ shares, "B": np.zeros_like(p["B"]), "c": np.zeros_like(p["c"])}
            grad_states = np.matmul(shares, p["A"].T, out=self.room("grad", n, h))
        for k in range(self.classes):
            low, high = bounds[k], bounds[k + 1]
            part = slice(self.edges[k], self.edges[k + 1])
            size = part.stop - part.start
            if low == high or size == 1:  # the only word of its class is certain
                continue
            weights, mine = p["B"][:, part], states[low:high]
            inner = np.matmul(mine, weights, out=self.room("inner", high - low, size))
            inner += p["c"][part]
            if distant:
                inner -= inner.max(1, keepdims=True)
            # Places in the unbroken memory of `inner`.
            at = np.arange(0, inner.size, size)
            at += place[low:high]
            at -= part.start
            picked = inner.ravel()[at]
            np.exp(inner, out=inner)
            sums = inner @ ones[:size]
            picked -= np.log(sums)
            value[low:high] += picked
            if learn:
                inner *= (1 / sums)[:, None]
                inner.ravel()[at] -= 1
                grads["B"][:, part] = mine.T @ inner
                grads["c"][part] = every_one[: high - low] @ inner
                grad_states[low:high] += inner @ weights.T
        result = np.empty(len(order))
        result[order] = value
        if learn:
            back = self.room("back", every, h)
            if every > n:
                back[:] = 0
            back[source] = grad_states
            grad_states = back
        return result, grad_states, grads

    def train(self, lanes: np.ndarray, window: int = WINDOW, rate: float = 0.01, moments: dict | None = None) -> list[float]:
        """Adam over the windows of parallel word streams (time, lane), once; returns the mean loss of each window.

        Args:
            lanes: longest first, filled up with start marks; a lane is left when none of its words remain.
            moments: Adam's moments and its number of updates, carried from one call to the next.
        """
        moments = {} if moments is None else moments
        for k, v in self.p.items():
            moments.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
        length = len(lanes) - np.argmax((lanes != self.start)[::-1], 0)
        losses, state = [], np.zeros((self.hidden, lanes.shape[1]), np.float32)
        at = 0
        while at + 1 < len(lanes):
            live = max(int(np.searchsorted(-length, -at - 1, "left")), 1)
            # Where few lanes are left, windows are longer, so that each still holds many words.
            span = window * min(lanes.shape[1] // live, LONGER)
            loss, grads, state = self._window(lanes[at: at + span + 1, :live], state[:, :live])
            losses.append(loss)
            at += span
            update = moments["updates"] = moments.get("updates", 0) + 1
            for k, g in grads.items():
                first, second = moments[k]
                step, square = self.room("step", *g.shape), self.room("square", *g.shape)
                np.subtract(g, first, out=step)
                step *= np.float32(0.1)
                first += step
                np.multiply(g, g, out=square)
                square -= second
                square *= np.float32(0.001)
                second += square
                np.multiply(second, np.float32(1 / (1 - 0.999 ** update)), out=square)
                np.sqrt(square, out=square)
                square += np.float32(1e-8)
                np.multiply(first, np.float32(rate / (1 - 0.9 ** update)), out=step)
                step /= square
                self.p[k] -= step
        return losses

    def forward(self, words: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """(states, the two gates, the state's part of the candidate, candidate), each (time, lane, unit), of words by (time, lane).

        `states` has one more step than the words: place t is the state that word t meets, which is empty where the word is a
        start mark, and the state after word t is at t + 1. `state` is (lane, unit). The results are overwritten by the next
        call, which may begin with the last state of this one.
        """
        p, (span, lanes), h = self.p, words.shape, self.hidden
        # The logistic function is (tanh(x / 2) + 1) / 2; its first half goes into the weights.
        factor = np.repeat(np.array([0.5, 1], p["U"].dtype), [2 * h, h])
        table, into = (p["W"] + p["b"]) * factor, p["U"] * factor
        begin = words == self.start
        resets = begin.any(1).tolist()
        first, half = state.copy(), p["U"].dtype.type(0.5)
        states, gates = self.room("states", span + 1, lanes, h), self.room("gates", span, 2, lanes, h)
        un, new = self.room("un", span, lanes, h), self.room("new", span, lanes, h)
        x, u = self.room("x", lanes, 3 * h), self.room("u", lanes, 3 * h)
        x_gates, u_gates = (part.reshape(lanes, 3, h)[:, :2].transpose(1, 0, 2) for part in (x, u))
        states[0] = first
        for t in range(span):
            held, gate, n, after = states[t], gates[t], new[t], states[t + 1]
            if resets[t]:
                held[begin[t]] = 0
            np.take(table, words[t], 0, mode="clip", out=x)
            np.matmul(held, into, out=u)
            np.add(x_gates, u_gates, out=gate)
            np.tanh(gate, out=gate)
            gate += 1
            gate *= half
            un[t] = u[:, 2 * h:]
            np.multiply(gate[1], u[:, 2 * h:], out=n)
            n += x[:, 2 * h:]
            np.tanh(n, out=n)
            np.subtract(held, n, out=after)
            after *= gate[0]
            after += n
        return states, gates[:, 0], gates[:, 1], un, new

    def _window(self, words: np.ndarray, state: np.ndarray):
        """Loss, gradients and the last state (unit, lane) of one window; a text's first word meets an empty state.

        A stream holds the start mark before each text. The mark is read but never predicted, so the state before it is not needed.
        """
        p, (span, lanes), h = self.p, (len(words) - 1, words.shape[1]), self.hidden
        kind, read = p["U"].dtype, words[:span].ravel()
        states, z, r, un, new = self.forward(words[:span], state.T)
        begin = words[:span] == self.start
        resets = begin.any(1).tolist()
        target = words[1:].ravel()
        real = np.flatnonzero(target != self.start)
        value, grad, grads = self.outputs(states[1:].reshape(-1, h), target[real], learn=True, chosen=real)
        scale = kind.type(1 / max(len(real), 1))
        for g in grads.values():
            g *= scale
        grad *= scale
        inner, flat = grad.reshape(span, lanes, h), self.room("flat", span, lanes, 3 * h)
        u_grad, back = np.zeros_like(p["U"]), np.ascontiguousarray(p["U"].T)
        later, rest, of, direct = np.zeros((lanes, h), kind), *(self.room(name, lanes, h) for name in ("rest", "of", "direct"))
        for t in range(span - 1, -1, -1):
            dh, mine, n = inner[t], flat[t], new[t]
            dh += later
            np.multiply(dh, z[t], out=later)
            np.subtract(dh, later, out=rest)  # what goes into the candidate
            np.subtract(states[t], n, out=of)
            of *= z[t]
            np.multiply(of, rest, out=mine[:, :h])
            np.multiply(n, n, out=of)
            np.subtract(1, of, out=of)
            np.multiply(of, rest, out=direct)
            np.multiply(direct, r[t], out=of)
            mine[:, 2 * h:] = of
            of *= un[t]
            np.subtract(1, r[t], out=rest)
            np.multiply(of, rest, out=mine[:, h: 2 * h])
            u_grad += states[t].T @ mine
            later += mine @ back
            mine[:, 2 * h:] = direct
            if resets[t]:
                later[begin[t]] = 0
        grads["U"] = u_grad
        order = np.argsort(read.astype(np.uint16), kind="stable")
        seen, starts = np.unique(read[order], return_index=True)
        sorted_ = np.take(flat.reshape(-1, 3 * h), order, 0, mode="clip", out=self.room("sorted", span * lanes, 3 * h))
        grads["W"] = np.zeros_like(p["W"])
        grads["W"][seen] = _sums(sorted_, starts)
        grads["b"] = grads["W"].sum(0)
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        if norm > 1:
            for g in grads.values():
                g /= kind.type(norm)
        return float(-value.mean()) if len(value) else 0.0, grads, states[-1].T


def _sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the stretches of rows that begin at `starts`; large ones as products, which are faster."""
    sums, ends = np.empty((len(starts), rows.shape[1]), rows.dtype), np.append(starts[1:], len(rows))
    large = np.flatnonzero(ends - starts > MANY)
    ones = np.ones(int((ends - starts).max(initial=0)), rows.dtype)
    at = 0
    for k in [*large.tolist(), len(starts)]:
        if at < k:
            np.add.reduceat(rows[: ends[k - 1]], starts[at: k], 0, out=sums[at: k])
        if k < len(starts):
            np.matmul(ones[: ends[k] - starts[k]], rows[starts[k]: ends[k]], out=sums[k])
        at = k + 1
    return sums


def _numbers(hashes: np.ndarray, seen: Corpus) -> np.ndarray:
    at = np.minimum(np.searchsorted(seen.words, hashes), len(seen.words) - 1)
    return np.where(seen.words[at] == hashes, at, len(seen.words))


def _number_type(seen: Corpus) -> type:
    return np.uint16 if len(seen.words) < 1 << 16 else np.int32


def streams(texts: list[np.ndarray], net: Network, end: int, lanes: int, window: int = WINDOW) -> np.ndarray:
    """Words by (time, lane), longest lane first, for whole windows; every text stands in one lane, whole.

    A text stands after the start mark and before the end mark, so the state is carried through it to its end. Long
    texts are dealt first. Short lanes are filled up with start marks.
    """
    rows: list[list[np.ndarray]] = [[] for _ in range(lanes)]
    sizes = [(0, lane) for lane in range(lanes)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        size, lane = heapq.heappop(sizes)
        rows[lane] += [[net.start], texts[i], [end]]
        heapq.heappush(sizes, (size + len(texts[i]) + 2, lane))
    order = sorted((-size, lane) for size, lane in sizes if size)
    length = -order[0][0] if order else 1
    words = np.full((-(-(length - 1) // window) * window + 1, len(order)), net.start, np.int32)
    for i, (size, lane) in enumerate(order):
        words[:-size, i] = np.concatenate(rows[lane])
    return words


def share_of(documents: int) -> np.ndarray:
    """Where in [0, 1) each training document of a block stands; evenly spread, so every round has its part of each block."""
    return (np.arange(documents) * 0.6180339887498949) % 1.0


def deal(blocks: DataFrame, seen: Corpus, rounds: np.ndarray = ROUNDS) -> DataFrame:
    """(sizes0, numbers0, sizes1, …): each block's training documents as the network's word numbers, by round, stored.

    A round reads its own columns only, so no task holds the blocks' codes and words while it learns.
    """
    names = [f"{name}{turn}" for turn in range(len(rounds) - 1) for name in ("sizes", "numbers")]
    kind = _number_type(seen)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                sizes, codes, words, flags = (c[i].as_py() for c in batch.columns)
                sizes, codes = np.frombuffer(sizes, np.int32), np.frombuffer(codes, np.int32)
                number, offsets = _numbers(np.frombuffer(words, np.uint64), seen).astype(kind), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                usable = np.flatnonzero(np.frombuffer(flags, bool))
                place, parts = share_of(len(usable)), []
                for low, high in zip(rounds[:-1], rounds[1:]):
                    chosen = usable[(place >= low) & (place < high)]
                    texts = [codes[offsets[d]: offsets[d + 1]] for d in chosen]
                    parts += [sizes[chosen].tobytes(), number[np.concatenate(texts)].tobytes() if texts else b""]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], names)

    return materialize(blocks.select("sizes", "codes", "words", "learnt").mapInArrow(run, ", ".join(f"{x} binary" for x in names)))


def train(blocks: DataFrame, seen: Corpus, passes: int = 1, rounds: np.ndarray = ROUNDS, rate: float = 0.01) -> Network:
    """A network trained on every token of all training documents of the blocks.

    Each round takes its share of the documents of every block. All tasks begin with the same weights, learn from their
    blocks by themselves, `passes` times, and the weights are averaged by the tokens learnt. The weights depend on how
    the documents lie in blocks and tasks.
    """
    net = Network(seen)
    if seen.tokens == 0:
        return net
    end, kind = int(_numbers(np.array([END]), seen)[0]), _number_type(seen)
    shapes = [(k, v.shape) for k, v in net.p.items()]

    def learn(rate: float):
        def run(batches):
            mine, moments, learnt, task = copy.deepcopy(net), {}, 0, TaskContext.get().partitionId()

            def go_over(texts: list[np.ndarray], count: int) -> None:
                # At least 20 windows a lane, so that small shares take many steps too.
                lanes = streams(texts, mine, end, min(max(count // (20 * WINDOW), 1), WIDE))
                for _ in range(passes):
                    mine.train(lanes, rate=rate, moments=moments)

            texts, held = [], 0
            for batch in batches:
                for sizes, numbers in zip(*batch.columns):
                    sizes, numbers = np.frombuffer(sizes.as_py(), np.int32), np.frombuffer(numbers.as_py(), kind)
                    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).tolist()
                    texts += [numbers[begin:after] for begin, after in zip(offsets[:-1], offsets[1:])]
                    held += offsets[-1] + len(sizes)
                    if held >= TASK_TOKENS:
                        go_over(texts, held)
                        learnt, texts, held = learnt + held, [], 0
            batch = sizes = numbers = None  # not held while the last streams are learnt from
            if held:
                go_over(texts, held)
                learnt += held
            if learnt:
                flat = np.concatenate([mine.p[k].ravel() for k, _ in shapes]).astype(np.float64) * learnt
                parts = np.array_split(flat, SLICES)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(SLICES), pa.int32()), pa.array([task] * SLICES, pa.int32()), pa.array([learnt] * SLICES, pa.int64()),
                    pa.array([x.tobytes() for x in parts], pa.binary())], ["slice", "task", "learnt", "weights"])

        return run

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = np.sum([np.frombuffer(w, np.float64) for w in table.column("weights").to_pylist()], 0)
        learnt = sum(table.column("learnt").to_pylist())
        return pa.table({"slice": table.column("slice")[:1], "learnt": pa.array([learnt], pa.int64()),
                         "weights": pa.array([(total / learnt).astype(np.float32).tobytes()], pa.binary())})

    # Some parts in one task fill the streams better, and a task's fixed cost comes once.
    dealt = deal(blocks, seen, rounds)
    parts = dealt.rdd.getNumPartitions()
    gathered = dealt.coalesce(max(min(parts, TASKS * blocks.sparkSession.sparkContext.defaultParallelism), -(-parts // GATHERED), 1))
    for turn in range(len(rounds) - 1):
        sums = gathered.select(f"sizes{turn}", f"numbers{turn}").mapInArrow(
            learn(rate / (1 + turn)), "slice int, task int, learnt bigint, weights binary")
        rows = sums.groupBy("slice").applyInArrow(add, "slice int, learnt bigint, weights binary").collect()
        if not rows:
            continue
        flat, at = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(rows, key=lambda r: r["slice"])]), 0
        weights = {}
        for k, shape in shapes:
            size = int(np.prod(shape))
            weights[k] = flat[at: at + size].reshape(shape).copy()
            at += size
        net.p = weights
        net.learnt += rows[0]["learnt"]
    return net


def _score_block(net: Network, seen: Corpus, sizes: np.ndarray, codes: np.ndarray, words: np.ndarray, counts: np.ndarray, rows: int = SCORED_ROWS):
    """(tokens, known tokens, base score, network's score) of each text of a block."""
    log_rare, end = np.log10(net.rare_share), int(_numbers(np.array([END]), seen)[0])
    number = _numbers(words, seen)
    base = seen.base(counts)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    of = np.repeat(np.arange(len(sizes)), sizes)
    end_base = float(seen.base(np.array(seen.texts)))
    base_score = np.bincount(of, base[codes], len(sizes)) + end_base
    known = np.bincount(of, counts[codes] > 0, len(sizes)).astype(np.int64) + (seen.texts > 0)
    if seen.tokens == 0:
        return sizes + 1, known, base_score, base_score
    # A rare word costs its class and its share of the class's corpus mass.
    within = np.where(number == net.rare, base - log_rare, 0.0)
    score = np.bincount(of, within[codes], len(sizes))
    order = np.argsort(-sizes, kind="stable")
    length, begin = sizes[order] + 1, offsets[:-1][order]
    # Texts of like length are read side by side, so that a step's arrays stay in the fast memory.
    for begins in range(0, len(sizes), SCORED_TEXTS):
        mine = slice(begins, begins + SCORED_TEXTS)
        size, first, total = length[mine], begin[mine], np.zeros(len(length[mine]))
        state, t = np.zeros((len(size), net.hidden), np.float32), 0
        while t < size[0]:
            live = int(np.searchsorted(-size, -t, "left"))  # longer texts come first
            span = int(min(max(rows // live, 1), LONGEST, size[0] - t))
            # Place k of a text is its k-th word, read after the one before it; its last place is the end mark.
            place = t + np.arange(span + 1)[:, None] - 1
            word = np.full((span + 1, live), end)
            if len(codes):
                word = np.where(place < size[:live] - 1, number[codes[np.clip(first[:live] + place, 0, len(codes) - 1)]], end)
            if t == 0:
                word[0] = net.start
            states = net.forward(word[:-1], state[:live])[0]
            state = states[-1]
            inside = np.flatnonzero((place[1:] < size[:live]).ravel())
            value = net.outputs(states[1:].reshape(-1, net.hidden), word[1:].ravel()[inside], chosen=inside)[0]
            total[:live] += np.bincount(inside % live, value, live)
            t += span
        score[order[mine]] += total / np.log(10)
    return sizes + 1, known, base_score, score


def score(docs: DataFrame, usable: Column, buckets: int | None = None, frequent: int = FREQUENT, **settings) -> DataFrame:
    """log10 likelihood of every whole text, by corpus counts and by the recurrent network.

    Args:
        docs: `doc_id`, `text`; other columns are ignored. A null text is empty: its only token is the end.
        usable: condition on `doc_id` that marks the documents to learn from; a null id is not learnt from.
        buckets: into how many the vocabulary is cut; by default four per shuffle partition, more where they would be large.
        frequent: how many words the network tells apart; the others share one class.

    Returns:
        `doc_id`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`; one row per row of `docs`, repeated rows
        included. Where nothing may be learnt from, both scores are 0; an empty table gives no row.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    blocks = encode(docs, F.coalesce(usable, F.lit(False)))
    held, parts = blocks.agg(F.sum(F.length("words")), F.greatest(F.count(F.lit(1)), F.lit(1))).first()
    if buckets is None:
        buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * (held or 0) // BUCKET_BYTES))
    answers = exchange(blocks, buckets, frequent)
    seen = corpus(blocks, answers, frequent)
    net = train(blocks, seen, **settings)
    # As many parts as blocks, so that few blocks meet in one task, whatever the number of shuffle partitions.
    replies = answers.where("block >= 0").repartition(parts, "block").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "counts"))).alias("replies"))
    ready = blocks.select("block", "doc_ids", "sizes", "codes", "words").repartition(parts, "block").join(
        replies.select("block", F.col("replies.counts").alias("replies")), "block", "left")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, ids, sizes, codes, words, replies = (c[i] for c in batch.columns)
                sizes, codes = np.frombuffer(sizes.as_py(), np.int32).astype(np.int64), np.frombuffer(codes.as_py(), np.int32)
                counts = np.frombuffer(b"".join(replies.as_py() or []), np.int64)
                n, known, base, value = _score_block(net, seen, sizes, codes, np.frombuffer(words.as_py(), np.uint64), counts)
                yield pa.RecordBatch.from_arrays([
                    ids.values, pa.array(n), pa.array(known), pa.array(np.full(len(n), seen.tokens)), pa.array(base), pa.array(value)],
                    ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return ready.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
