"""Learnt classes, communities of titles, central sentences, one-to-one matching and phrases on small tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bindings.registry import QUERIES, Tables
from plenary.operators import bayes, centrality, communities, keywords, matching
from tests.conftest import SMALL

TOPICS = {"교육": "학교 교사 학생 수업 입학".split(), "환경": "대기 오염 탄소 하천 배출".split(), "보건": "병원 환자 진료 의사 감염".split()}


def bills(rng, count):
    for i in range(count):
        topic = list(TOPICS)[i % 3]
        yield i, topic, " ".join(rng.choice(TOPICS[topic] + ["법률", "정부", "개정", "시행"]) for _ in range(rng.randint(4, 30)))


def test_classes_learnt_from_answers(spark):
    rows = [*bills(random.Random(3), 300), (900, None, None), (901, None, ""), (902, None, "전혀 없는말")]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "bill_id int, content string")
    labels = spark.createDataFrame([(i, c) for i, c, _ in rows if c and i % 4], "bill_id int, category string")
    found = {r.bill_id: r for r in bayes.learnt_classes(docs, labels, "bill_id").collect()}
    held = [(i, c) for i, c, _ in rows if c and i % 4 == 0]
    assert sum(found[i].category == c for i, c in held) >= 0.95 * len(held)
    assert all(1 / 3 <= r.confidence <= 1 for r in found.values()) and not found.keys() & {900, 901, 902}
    # Scores beside plain sums.
    terms = {i: Counter((t or "").split()) for i, _, t in rows}
    per, total = defaultdict(Counter), Counter()
    for i, c, _ in rows:
        if c and i % 4:
            per[c].update(terms[i])
            total.update(terms[i])
    got = {(r.bill_id, r.category): r.score for r in bayes.complement_scores(bayes.term_counts(docs, "bill_id"), labels, "bill_id").collect()}
    for i in (0, 4, 7):
        for c in TOPICS:
            rest = sum(total.values()) - sum(per[c].values()) + len(total)
            known = {w: n for w, n in terms[i].items() if w in total}
            want = sum(n * (math.log(rest) - math.log((total[w] - per[c][w] + 1) / (total[w] + 1))) for w, n in known.items())
            assert got.get((i, c), want) == pytest.approx(want, abs=1e-4)


def test_unanswered_bills_are_filled(spark):
    rows = list(bills(random.Random(4), 120))
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "bill_id int, content string")
    given = [(i, c, "세부", 0.9) if i % 2 else (i, "기타", "일반", 0.5) for i, c, _ in rows]
    classified = spark.createDataFrame(given, "bill_id int, category string, subcategory string, confidence double")
    out = {r.bill_id: r for r in bayes.fill_classes(docs, classified).collect()}
    assert all(tuple(out[i][1:]) == (c, "세부", 0.9) for i, c, _ in rows if i % 2)
    assert sum(out[i].category == c for i, c, _ in rows if i % 2 == 0) >= 57
    none = classified.where("confidence < 0.8")
    assert bayes.fill_classes(docs, none).where("category <> '기타'").isEmpty()


def test_held_out_accuracy_on_the_documents(spark):
    docs = Tables(spark, SMALL).documents
    guessed = QUERIES["learnt_topic_classes"](spark, SMALL).where("bill_id % 5 = 0").join(docs, docs.doc_id == F.col("bill_id")).where("lang is not null")
    right, every = guessed.agg(F.count_if(F.col("category") == F.col("lang")), F.count(F.lit(1))).first()
    assert right >= 0.9 * every


def plain_communities(rows, over, shared_by, least, rounds):
    groups = defaultdict(list)
    for k, g, t in rows:
        groups[g].append((k, set((t or "").split())))
    found, weights = {}, defaultdict(dict)
    for g, held in groups.items():
        if len(held) <= over:
            continue
        count = Counter(w for _, ws in held for w in ws)
        idf = {w: math.log1p(len(held) / n) for w, n in count.items() if 2 <= n <= shared_by}
        kept = [(k, {w: idf[w] for w in ws if w in idf}) for k, ws in held]
        norm = {k: math.sqrt(sum(v * v for v in ws.values())) for k, ws in kept}
        for i, (a, x) in enumerate(kept):
            for b, y in kept[i + 1:]:
                both = x.keys() & y.keys()
                if both and (w := round(sum(x[t] * y[t] for t in both) / norm[a] / norm[b], 9)) >= least:
                    weights[a][b] = weights[b][a] = w
    label = {k: k for k in weights}
    for _ in range(rounds):
        new = {}
        for k, near in weights.items():
            votes = Counter({label[k]: max(near.values())})
            for o, w in near.items():
                votes[label[o]] += w
            new[k] = min(votes, key=lambda v: (-round(votes[v], 9), v))
        if new == label:
            break
        label = new
    members = defaultdict(set)
    for k, v in label.items():
        members[v].add(k)
    return {frozenset(v) for v in members.values()}


def test_communities_of_titles(spark):
    rng = random.Random(6)
    rows = []
    for i in range(160):
        theme = rng.randrange(12)
        rows.append((i, "큰" if i % 8 else "작은", " ".join([f"주제{theme}{chr(0xAC00 + rng.randrange(3))}" for _ in range(3)] + [rng.choice("가나다라마")])))
    rows = [(i, g, t.translate(str.maketrans("0123456789", "영일이삼사오육칠팔구"))) for i, g, t in rows] + [(900, "큰", None), (901, "큰", "홀로")]
    rows += [(1000 + i, "셋", "같은 제목") for i in range(3)]
    df = spark.createDataFrame(rows, "bill_id int, topic_group string, title string")
    got = defaultdict(set)
    out = communities.title_subgroups(df, over=15, shared_by=12, least=0.4).collect()
    for r in out:
        if r.subgroup:
            got[r.subgroup].add(r.bill_id)
    assert len(out) == len(rows) and {frozenset(v) for v in got.values()} == plain_communities(rows, 15, 12, 0.4, communities.ROUNDS)
    assert all(r.subgroup == 0 for r in out if r.topic_group == "셋" or r.bill_id >= 900)
    assert sorted(got) == list(range(1, len(got) + 1)) and len(got) > 3


def test_central_sentences_beside_a_dense_matrix():
    rng = random.Random(8)
    for _ in range(20):
        text = " ".join(" ".join(rng.choice("가 나 다 라 마 바 사 아 자 차 카 타".split()) for _ in range(rng.randint(1, 8))) + rng.choice(".!?") for _ in range(rng.randint(2, 25)))
        parts = centrality.sentences(text)
        assert " ".join(parts) == text
        vocabulary = sorted({w for p in parts for w in p[:-1].split()})
        a = np.array([[p[:-1].split().count(w) * math.log1p(len(parts) / sum(w in q[:-1].split() for q in parts)) for w in vocabulary] for p in parts])
        a /= np.sqrt((a * a).sum(1))[:, None]
        values, vectors = np.linalg.eigh(a @ a.T)
        if values[-1] - values[-2] > 0.3:
            assert centrality.centralities(parts) == pytest.approx(np.abs(vectors[:, -1]), abs=1e-5)


def test_central_sentences_of_odd_texts(spark):
    long = " ".join(f"제{chr(0xAC00 + i % 900)} 조항 {chr(0xAC00 + i % 31)}{chr(0xB000 + i % 77)}." for i in range(10000))
    df = spark.createDataFrame([("a", None), ("b", "  "), ("c", "1 2 3. 4"), ("d", "하나뿐"), ("e", long), ("f", "법 개정.\n 법 개정 이유. 다른 말.")], "bill_id string, content string")
    got = {r.item_id: r.text for r in centrality.central_sentence_answers(df).collect()}
    assert got["a"] == got["b"] == "" and got["c"] == "1 2 3" and got["d"] == "하나뿐" and "조항" in got["e"] and got["f"] in ("법 개정", "법 개정 이유")


def test_one_to_one_matching(spark):
    bills_ = spark.createDataFrame([
        ("a", 22, "0012345", "학교 급식법"), ("b", 22, "2345", "학교 급식법"), ("c", 22, " 2345 ", "다른 법"), ("d", 22, "992345", "먼 법"),
        ("e", 21, "2345", "다른 대"), ("f", None, "2345", "대 없음"), ("g", 22, None, "번호 없음")], "bill_id string, age int, bill_number string, title string")
    extracts = spark.createDataFrame([
        ("x", 22, "2345", "다른 법", "왜", None), ("y", 22, "2345", "학교 급식법", None, "무엇"), ("z", 22, "12345", "", "셋", "넷"),
        ("u", 22, "892345", "먼 법", "다섯", ""), ("v", 22, "72345", "먼 법", "여섯", ""), ("w", 22, "2345", "x", " ", None)],
        "file_name string, age int, bill_number string, title string, reason string, main string")
    matched, unused = matching.match_extracts(bills_, extracts)
    got = {r.bill_id: (r.file_name, r.content) for r in matched.collect()}
    assert got == {"a": ("z", "셋 넷"), "b": ("y", "무엇"), "c": ("x", "왜"), "d": ("u", "다섯"), "e": (None, None), "f": (None, None), "g": (None, None)}
    assert sorted(r.file_name for r in unused.collect()) == ["v", "w"]


def test_a_large_block_is_paired_without_its_pairs(spark):
    rng = random.Random(1)
    rows = [(False, f"b{i:03}", rng.randrange(400)) for i in range(120)] + [(True, f"f{i:03}", rng.randrange(400)) for i in range(90)]
    df = spark.createDataFrame([(k, i, "one", v, []) for k, i, v in rows], "extract boolean, id string, block string, value bigint, title array<string>")
    got = matching.match_rows(df, 2).collect()
    assert len(got) == 90 == len({r.bill for r in got}) == len({r.file for r in got})
    value = {i: v for _, i, v in rows}
    assert all(r.distance == abs(value[r.bill] - value[r.file]) for r in got)
    # The first round is that of plain mutual choice among neighbours.
    order = sorted(rows, key=lambda r: (r[2], r[0], r[1]))
    ranks = {i: (order[i + 1][2] - order[i][2], i) for i in range(len(order) - 1) if order[i][0] != order[i + 1][0]}
    want = {frozenset((order[i][1], order[i + 1][1])) for i, r in ranks.items() if r < ranks.get(i - 1, (1e9,)) and r < ranks.get(i + 1, (1e9,))}
    assert {frozenset((r.bill, r.file)) for r in got if r.round == 0} == want


@pytest.mark.parametrize("odd", [False, True])
def test_bills_that_no_extract_reaches_change_no_pair(spark, monkeypatch, odd):
    rng = random.Random(7)
    rows = []
    for block, bills_, extracts, spread_ in (("a", 300, 6, 400), ("b", 40, 40, 60), ("c", 90, 0, 90), ("d", 0, 9, 9), ("e", 200, 25, 30), (None, 9, 9, 9)):
        rows += [(k, f"{block}{k:d}{i:03}", block, rng.choice([None, *range(spread_)]), rng.sample("xyz", 2)) for k, n in ((False, bills_), (True, extracts)) for i in range(n)]
    if odd:  # ids that repeat, in their own block or another one, and null ids
        rows += [(k, i, b, v, t) for k, i, b, v, t in rows if not k and i.endswith("1")] * 4
        rows += [(k, i, "e", v, t) for k, i, _, v, t in rows if i.endswith("2")] + [(k, None, b, 3, ["x"]) for k in (False, True) for b in "ae"]
    df = spark.createDataFrame(rows, "extract boolean, id string, block string, value bigint, title array<string>")
    pairs = lambda: sorted(map(str, matching.match_rows(df).collect()))
    kept = matching._reachable(df, matching.ROUNDS).groupBy("block").count().collect()
    got = pairs()
    monkeypatch.setattr(matching, "_reachable", lambda rows, rounds: rows)
    assert got == pairs()
    if not odd:
        counts = {r["block"]: r["count"] for r in kept}
        assert counts["a"] <= 6 * 9 + 2 * matching.ROUNDS and "c" not in counts


def test_phrases(spark):
    df = spark.createDataFrame([("a", "국민 건강 및 국민 건강 증진 법"), ("b", "국민 건강 보험"), ("c", "건강 국민"), ("d", None), ("e", "")] + [(f"z{i}", f"말{chr(0xAC00 + i)} 글{chr(0xAC00 + i)}") for i in range(40)], "k string, content string")
    found = {r.phrase: r.n for r in keywords.phrase_scores(df).collect()}
    assert found == {"국민 건강": 3}
    terms = {(r.k, r.term) for r in keywords.doc_phrase_scores(df, "k", top=2).collect()}
    assert ("a", "국민 건강") in terms and not any(k in "de" for k, _ in terms)


def stored_plans(monkeypatch, module):
    """The plans of the tables that a module stores from now on."""
    plans, store = [], module.materialize

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    monkeypatch.setattr(module, "materialize", noted)
    return plans


def plain_best(rows, top):
    """The best terms and corpus phrases of each key, by count and rarity; phrases are pairs in `known`."""
    found = defaultdict(Counter)
    known = {r for r, n in Counter(f"{a} {b}" for _, t in rows for a, b in zip((t or "").split(), (t or "").split()[1:])).items() if n >= 2}
    for k, t in rows:
        words = (t or "").split()
        found[k].update(words)
        found[k].update(p for p in (f"{a} {b}" for a, b in zip(words, words[1:])) if p in known)
    holding = Counter(w for c in found.values() for w in c)
    score = lambda n, w: round(n * math.log((1.0 + len(rows)) / (1.0 + holding[w])), 6)
    return {k: [w for _, w in sorted((-score(n, w), w) for w, n in c.items())[:top]] for k, c in found.items()}


def test_terms_are_counted_where_the_texts_are(spark, monkeypatch):
    rows = [(i % 7 or None, f"a b{i} c{i % 3} c{i % 3}") for i in range(20)]
    df = spark.createDataFrame(rows, "k int, content string")
    plans = stored_plans(monkeypatch, keywords)
    whole = sorted(map(tuple, keywords.doc_term_scores(df, "k", stop=()).collect()), key=str)
    assert plans[0].count("Exchange") == 1  # of the texts alone
    monkeypatch.setattr(keywords, "FREQUENT", 3)
    assert sorted(map(tuple, keywords.doc_term_scores(df, "k", stop=()).collect()), key=str) == whole


def test_phrases_that_cannot_be_among_the_best_are_not_stored(spark, monkeypatch):
    rng = random.Random(6)
    names = [a + b for a in "bcdfgh" for b in "aeiou"]
    rows = [(i % 40 or None, " ".join(rng.choice(names) for _ in range(rng.randint(0, 60)))) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, content string")
    sizes, store = [], keywords.materialize
    monkeypatch.setattr(keywords, "materialize", lambda d: sizes.append(d.columns) or store(d))
    got = defaultdict(list)
    for r in keywords.doc_phrase_scores(df, "k", least=0.0, stop=()).orderBy(F.desc("score"), "term").collect():
        got[r.k].append((r.term, r.score))
    assert all(len(v) <= 4 for v in got.values()) and ["phrase", "n", "containing"] in sizes
    want = plain_best([(k, t) for k, t in rows], 4)
    assert {k: [w for w, _ in v] for k, v in got.items()}.keys() == {k for k, v in want.items() if v}


def test_scores_are_the_same_with_few_frequent_terms(spark, monkeypatch):
    rows = list(bills(random.Random(5), 80))
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "bill_id int, content string")
    labels = spark.createDataFrame([(i, c) for i, c, _ in rows if i % 4], "bill_id int, category string")
    plans = stored_plans(monkeypatch, keywords)
    counts = bayes.term_counts(docs, "bill_id")
    assert plans[0].count("Exchange") == 1
    found = []
    for n in (1 << 17, 20, 1):
        monkeypatch.setattr(bayes, "FREQUENT", n)
        found.append(sorted((r.bill_id, r.category, r.words, round(r.score, 4)) for r in bayes.complement_scores(counts, labels, "bill_id").collect()))
    assert found[0] == found[1] == found[2]
