"""Language ID, toxicity and the recurrent language model."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plenary.llm import language, queries, recurrent, tokens, toxicity
from tests.conftest import SMALL
from tests.llm.fixtures import no_documents, odd_documents, odd_rows, prose, remainder


def plain_phrases(sample: str, text: str) -> int:
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at:at + size] in sample:
            size += 1
        at += max(size - 1, 1)
        count += 1
    return count


def test_phrases_beside_a_plain_search():
    samples = {"a": ["the cat sat on the mat and then ran"], "b": ["le chat est dans la maison rouge"]}
    model = language.train(samples)
    for text in ("then the cat ran", "la maison est dans le chat", "zzz cat", "t", "mat mat mat mat"):
        _, _, total, sizes = next(language.phrases(model, pa.array([text])))
        for k, name in enumerate(model.languages):
            sample = samples[name][0] + " "
            assert total[k][0] == plain_phrases(sample, text), (name, text)
        assert sizes[0] == len(text)


def test_suffix_automaton_accepts_exactly_the_substrings():
    word = [1, 2, 1, 1, 2, 3, 1, 2]
    moves = language.suffix_automaton(word)

    def accepted(s):
        state = 0
        for c in s:
            state = moves[state].get(c)
            if state is None:
                return False
        return True

    inside = {tuple(word[a:b]) for a in range(len(word)) for b in range(a + 1, len(word) + 1)}
    for n in range(1, 5):
        for code in range(3 ** n):
            s = tuple(1 + code // 3 ** i % 3 for i in range(n))
            assert accepted(s) == (s in inside)


def test_language_of_odd_documents(spark):
    docs = odd_documents(spark)
    found = language.identify(docs, queries.remainder(4) != 2).collect()
    assert len(found) == docs.count()
    truth = Counter((r[0], r[1]) for r in odd_rows())
    und = sorted(str(r.doc_id) for r in found if r.lang_pred == "und")
    want = sorted(str(i) for (i, t), n in truth.items() for _ in range(n) if not re.search(r"[^\W\d_]", t or ""))
    assert und == want
    assert all(0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0) for r in found)
    langs = {r[0]: r[2] for r in odd_rows()[:40]}
    assert np.mean([langs[r.doc_id] == r.lang_pred for r in found if r.doc_id in langs]) > 0.9


def test_language_held_out_accuracy(spark):
    docs = queries.table(spark, SMALL, "documents")
    found = language.identify(docs, queries.remainder(4) != 2).join(docs.select("doc_id", "lang"), "doc_id").where(queries.remainder(4) == 2)
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.9


def test_language_lanes_and_rejection(spark):
    docs = odd_documents(spark)
    model = language.fit(docs, queries.remainder(4) != 2)
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert None not in texts and "12345 --- !!!" not in texts and sum(t in {r[1] for r in odd_rows()[:40]} for t in texts) >= 40
    assert language.identify(no_documents(spark), F.lit(True)).isEmpty()
    unlearnt = language.identify(docs, F.lit(False)).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in unlearnt] == [("und", 0.0)]


def test_short_clean_texts_stay(spark):
    rng = random.Random(8)
    samples = {lang: [prose(rng, lang, 200) for _ in range(5)] for lang in ("en", "de", "fr")}
    model = language.train(samples)
    short = ["A.", "Ok", "Hi", "é", "Yes.", "Jawohl!", "Grüße", "Voilà", "merci", "A.\nAll rights reserved.", "Ered. pathetic loser",
             *[prose(rng, lang, 1) for lang in samples]]
    junk = "".join(rng.choice("bcdfghjklmnpqrtvwxyz") for _ in range(400))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*short, junk, "12 3", "", None])], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in language.accepted(docs, model).collect()) == list(range(len(short)))


def toxic_rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(400):
        text = [words[k] for k in rng.integers(0, 400, 40)]
        bad = i % 4 == 0
        if bad:
            text[int(rng.integers(40))] = "vile"
            text[int(rng.integers(40))] = "nasty"
        rows.append((i, " ".join(text), "clash"))
        labels.append((i, int(bad)))
    rows += [(1000, None, "c"), (1001, "", "c"), (1002, "vile nasty " * 5000, "c"), (4, rows[4][1], "c"), (None, "no id", "c")]
    return rows, labels + [(5, None), (None, 1), (6, 7), (8, 0)]


def test_toxicity_learns_and_scores_every_row(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity.toxicity(docs, marks, queries.remainder(5) != 0).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    score = {r.doc_id: r.score for r in found}
    held = [i for i in range(400) if remainder(i, 5) == 0]
    assert np.mean([(score[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    assert score[1000] == score[1001] < 0.5 <= score[1002]


def test_toxicity_without_labels(spark):
    rows, _ = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    found = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id bigint, toxic int"), F.lit(True))
    assert found.where("score < 0.5").count() == len(rows)
    assert toxicity.toxicity(docs.limit(0), spark.createDataFrame([], "doc_id bigint, toxic int"), F.lit(True)).isEmpty()


def test_features_beside_plain_ones():
    texts = ["One two, one three", "", None, "x"]
    (row, end, number, doc), = toxicity.text_features(pa.array(texts))
    assert (row, end) == (0, 4) and sorted(Counter(doc.tolist()).items()) == [(0, 4 + 3 + 2), (3, 1)]
    one = tokens.word_hash("one") >> (64 - toxicity.BITS)
    assert (number[doc == 0] == one).sum() == 2


def test_word_hashes_do_not_depend_on_place():
    texts = ["alpha beta", "  beta\talpha", "", "gamma", "béta alpha\n"]
    column = pa.array(texts)
    _, _, data, starts = next(tokens.chunks(column))
    _, _, h, off = tokens.find_words(data, starts)
    split = [h[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
    want = [[tokens.word_hash(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t)] for t in texts]
    assert split == want
    pieces = [p for c in [list(tokens.chunks(column, limit=4))] for p in c]
    assert [p[:2] for p in pieces][0][0] == 0 and pieces[-1][1] == 5


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def test_base_scores_beside_plain_counts(spark):
    docs = odd_documents(spark)
    found = recurrent.score(docs, queries.remainder(7) != 2, buckets=8).collect()
    rows = [(r[0], plain_words(r[1] or "") + [None]) for r in odd_rows()]
    counts = Counter(w for i, ws in rows if i is not None and remainder(i, 7) != 2 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((str(i), len(ws), sum(counts[w] > 0 for w in ws), total,
                   round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws), 5)) for i, ws in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_nothing_to_learn_from(spark):
    found = recurrent.score(odd_documents(spark), F.lit(False)).collect()
    assert all(r.score == r.base_score == 0 and r.train_tokens == 0 for r in found)
    assert recurrent.score(no_documents(spark), F.lit(True)).isEmpty()


def small_network():
    words = np.arange(1, 12, dtype=np.uint64) * np.uint64(7919)
    words[3] = recurrent.END
    seen = recurrent.Corpus(200, 15, 9, np.sort(words), np.array([30, 5, 9, 20, 2, 2, 8, 40, 1, 6, 3]))
    return seen, recurrent.Network(seen, hidden=4, classes=3)


def test_probabilities_add_up_to_one():
    seen, net = small_network()
    state = np.random.default_rng(0).normal(size=(1, 4)).astype(np.float32)
    every = np.arange(len(seen.words) + 1)
    value = net.outputs(np.repeat(state, len(every), 0), every)[0]
    assert np.exp(value).sum() == pytest.approx(1, abs=1e-5)


def test_gradients_beside_differences():
    seen, net = small_network()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(1)
    words = rng.integers(0, net.start + 1, (7, 3))
    words[0] = net.start
    state = np.zeros((4, 3))
    grads = net._window(words, state)[1]
    slopes, found = [], []
    for name in net.p:
        at = np.unravel_index(int(np.abs(grads[name]).argmax()), grads[name].shape)
        old = net.p[name][at]
        sides = []
        for step in (1e-5, -1e-5):
            net.p[name][at] = old + step
            sides.append(net._window(words, state)[0])
        net.p[name][at] = old
        slopes.append((sides[0] - sides[1]) / 2e-5)
        found.append(float(grads[name][at]))
    # Gradients longer than 1 are cut to that length, all by the same factor.
    factor = max(slopes[0] / found[0], 1.0)
    assert slopes == pytest.approx([f * factor for f in found], rel=2e-2, abs=1e-6)


def plain_step(net, state, word):
    p, h = net.p, net.hidden
    x, u = p["W"][word] + p["b"], state @ p["U"]
    gates = 1 / (1 + np.exp(-(x[:, : 2 * h] + u[:, : 2 * h])))
    new = np.tanh(x[:, 2 * h:] + gates[:, h:] * u[:, 2 * h:])
    return new + gates[:, :h] * (state - new)


def test_block_scores_beside_one_text_at_a_time():
    seen, net = small_network()
    rng = np.random.default_rng(2)
    words = np.sort(np.concatenate([seen.words[[0, 2, 5]], np.array([11, 13], np.uint64)]))
    counts = np.array([4, 0, 3, 2, 1])
    sizes = np.array([0, 90, 3, 1])
    codes = rng.integers(0, 5, sizes.sum())
    _, _, base, score = recurrent._score_block(net, seen, sizes, codes, words, counts, rows=8)
    number = recurrent._numbers(words, seen)
    end = int(recurrent._numbers(np.array([recurrent.END]), seen)[0])
    at = 0
    for i, n in enumerate(sizes):
        state, before, total = np.zeros((1, 4), np.float32), np.array([net.start]), 0.0
        for c in [*codes[at:at + n], None]:
            target = np.array([end if c is None else number[c]])
            state = plain_step(net, state, before)
            total += net.outputs(state, target)[0][0] / np.log(10)
            if c is not None and number[c] == net.rare:
                total += seen.base(counts[c]) - np.log10(net.rare_share)
            before = target
        assert score[i] == pytest.approx(total, rel=1e-4)
        at += n


def test_scoring_many_texts_keeps_little_work_space():
    seen, _ = small_network()
    net = recurrent.Network(seen)
    sizes = np.full(3000, 40)
    words = np.sort(seen.words)
    codes = np.random.default_rng(6).integers(0, len(words), sizes.sum())
    value = recurrent._score_block(net, seen, sizes, codes, words, np.full(len(words), 3))[3]
    assert sum(held.nbytes for held in net.rooms.values()) < 14 << 20
    for some in (slice(0, 1), slice(700, 703), slice(2999, 3000)):  # as if they were the block's only texts
        alone = recurrent._score_block(net, seen, sizes[some], codes[some.start * 40: some.stop * 40], words, np.full(len(words), 3))[3]
        assert value[some] == pytest.approx(alone, rel=1e-4)


def test_sums_of_large_and_small_stretches():
    rows = np.random.default_rng(5).normal(size=(400, 3))
    for starts in ([0], [0, 1, 2], [0, 100, 101, 103, 350], [0, 30, 60, 399], list(range(400))):
        assert np.allclose(recurrent._sums(rows, np.array(starts)), np.add.reduceat(rows, starts, 0))


def test_outputs_of_chosen_states():
    seen, net = small_network()
    rng = np.random.default_rng(8)
    states, chosen = rng.uniform(-1, 1, (9, 4)).astype(np.float32), np.array([1, 2, 5, 8])
    target = rng.integers(0, net.rare + 1, 4)
    value, grad, grads = net.outputs(states, target, learn=True, chosen=chosen)
    found = value.copy(), grad.copy()
    plain = net.outputs(states[chosen], target, learn=True)
    assert np.allclose(found[0], plain[0]) and np.allclose(found[1][chosen], plain[1]) and (np.delete(found[1], chosen, 0) == 0).all()
    assert all(np.allclose(grads[k], plain[2][k], atol=1e-6) for k in grads)
    net.p["A"][:], net.p["c"][0] = 500, 300  # logits beyond what exponentials hold
    assert np.isfinite(net.outputs(states * 1.0, target)[0]).all()


def test_training_lowers_the_loss():
    seen, net = small_network()
    lanes = np.tile(np.array([net.start, 1, 2, 7, 1, 2, 7, 3]), 60)[:, None].repeat(4, 1)
    losses = net.train(lanes, window=10, rate=0.02)
    assert np.mean(losses[-5:]) < 0.7 * np.mean(losses[:5])


def test_streams_hold_every_word_once():
    seen, net = small_network()
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, net.rare, n) for n in (0, 3, 95, 700, 1, 40)]
    words = recurrent.streams(texts, net, 3, lanes=4, window=5)
    assert (len(words) - 1) % 5 == 0 and (words[0] == net.start).all()
    assert Counter(words[words != net.start].tolist()) == Counter(w for t in texts for w in [*t.tolist(), 3])
    lanes = [[w for w in lane.tolist()] for lane in words.T]
    for t in texts:  # each whole, between its marks
        whole = [net.start, *t.tolist(), 3]
        assert any(lane[i: i + len(whole)] == whole for lane in lanes for i in range(len(lane)))
    sizes = [len(np.trim_zeros(lane != net.start, "b")) for lane in words.T]
    assert sizes == sorted(sizes, reverse=True)


def test_training_reads_the_whole_corpus(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(1 + i % 40)), "x") for i in range(1500)]
    rows += [(5000, "one two three " * 1500, "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, copy string").repartition(4)
    blocks = recurrent.encode(docs, F.coalesce(queries.remainder(7) != 2, F.lit(False)))
    seen = recurrent.corpus(blocks, recurrent.exchange(blocks, 8))
    usable = [t for i, t, _ in rows if i is not None and remainder(i, 7) != 2]
    assert len(usable) > 800 and seen.tokens == sum(len(t.split()) + 1 for t in usable)
    assert recurrent.train(blocks, seen).learnt == seen.tokens


def test_a_round_reads_only_its_share_of_the_training_words(spark, monkeypatch):
    rows = [(i, None if i % 9 == 0 else "".join(f"w{j % 7} x{i} " for j in range(i))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    blocks = recurrent.encode(docs, F.coalesce(queries.remainder(7) != 2, F.lit(False)))
    seen = recurrent.corpus(blocks, recurrent.exchange(blocks, 8))
    wanted = sum(r["texts"] for r in blocks.collect())
    turns, tables = range(len(recurrent.ROUNDS) - 1), []
    deal = recurrent.deal
    monkeypatch.setattr(recurrent, "deal", lambda *given: tables.append(deal(*given)) or tables[0])
    assert recurrent.train(blocks, seen).learnt == seen.tokens
    found = tables[0].collect()
    sizes = [np.concatenate([np.frombuffer(r[f"sizes{k}"], np.int32) for r in found]) for k in turns]
    numbers = np.concatenate([np.frombuffer(r[f"numbers{k}"], np.uint16) for r in found for k in turns])
    assert sum(map(len, sizes)) == wanted == seen.texts and 0 < len(sizes[0]) < wanted / 4
    # Every word of every training document stands in one round, once, in two bytes.
    assert len(numbers) == sum(x.sum() for x in sizes) == seen.tokens - seen.texts
    of_end = recurrent._numbers(np.array([recurrent.END]), seen)[0]
    counts = np.bincount(numbers, minlength=len(seen.words) + 1)
    counts[of_end] += seen.texts
    assert np.array_equal(counts[:-1], seen.counts) and counts[-1] == 0


def test_scoring_deals_blocks_into_as_many_parts_as_there_are(spark):
    rows = [(i, f"w{i % 5} and x{i}", "x") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, copy string").repartition(9)
    scored = recurrent.score(docs, queries.remainder(7) != 2, rounds=np.array([0, 1]))
    assert scored.rdd.getNumPartitions() == 9 and sorted(r["doc_id"] for r in scored.collect()) == list(range(90))
