"""Bucketed tables, upserts, the ledger of landed pages, long cells, learnt compounds and feature lines."""

import itertools
import math
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plenary.functions import text
from plenary.operators import compounds, stored
from plenary.operators.aggregates import join_long_texts, join_texts
from plenary.operators.joins import fill_from_extracts
from plenary.plans.bills import page_texts
from plenary.sources import landed, ledger, sinks


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_second_run_needs_no_exchange(spark, tmp_path):
    votes = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 97).alias("bill"), "id")
    texts = spark.range(97).select(F.col("id").alias("bill"), F.concat(F.lit("text "), "id").alias("content"))
    counts = votes.groupBy("bill").agg(F.count(F.lit(1)).alias("n"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    tables = stored.store_together({"b_votes": votes, "b_texts": texts, "b_counts": counts}, str(tmp_path), "bill", 4, hot_rows=500)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = tables["b_votes"].even.join(tables["b_texts"].even, "bill", "left").join(tables["b_counts"].even, "bill", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        counted = tables["b_votes"].even.groupBy("bill").agg(F.count(F.lit(1)))
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
        assert rows(stored.join_stored(tables["b_votes"], tables["b_texts"])) == rows(votes.join(texts, "bill", "left"))
        assert rows(stored.counts_of_stored(tables["b_votes"], [])) == rows(counts)
        assert {r[0] for r in tables["b_votes"].hot.select("bill").distinct().collect()} == {0, None}
        assert len(list(Path(tmp_path, "b_votes", "even").glob("*.parquet"))) == 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for table in tables.values():
            table.forget()


def files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "bills")
    schema = "bill string, content string, age int"
    table = spark.createDataFrame([("a", "x", 20), ("b", "y", 20), ("c", None, 21), ("d", "z", 22), ("e", "w", 23), (None, "n", None)], schema)
    sinks.write_by_value(table, path, "age")
    untouched = {f for f in files(path) if "age=22" in f or "DEFAULT" in f}
    changes = spark.createDataFrame([("a", "new", 20), ("a", "newer", 20), ("c", "moved", 24), (None, "lost", 22)], schema)
    removals = spark.createDataFrame([("e",), ("absent",), (None,)], "bill string")
    done = sinks.upsert(spark, path, changes, "bill", "age", removals)
    assert sorted(r[0] for r in done.collect()) == [20, 21, 23, 24]
    after = spark.read.schema(schema).parquet(path)
    held = rows(after)
    assert held == Counter([("a", "new", 20), ("b", "y", 20), ("c", "moved", 24), ("d", "z", 22), (None, "n", None)])
    assert untouched and untouched <= files(path) and not any("age=23" in f for f in files(path))
    # Nothing to do: no file changes.
    now = files(path)
    assert sinks.upsert(spark, path, changes.limit(0), "bill", "age").count() == 0 and files(path) == now
    # The last row of the null partition goes.
    sinks.upsert(spark, path, spark.createDataFrame([("f", "v", None)], schema), "bill", "age")
    sinks.upsert(spark, path, changes.limit(0), "bill", "age", spark.createDataFrame([("f",)], "bill string"))
    assert rows(spark.read.schema(schema).parquet(path)) == held


def test_failed_upsert_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "bills")
    schema = "bill string, content string, age int"
    sinks.write_by_value(spark.createDataFrame([("a", "x", 20), ("b", "y", 21)], schema), path, "age")
    held = files(path)
    broken = spark.createDataFrame([("a", "x", 20)], schema).withColumn("content", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sinks.upsert(spark, path, broken, "bill", "age")
    assert files(path) == held and spark.read.schema(schema).parquet(path).count() == 2


def page(total, *ids):
    inner = ",".join('{"BILL_ID":"%s"}' % i for i in ids)
    return '{"BILLRCP":[{"head":[{"list_total_count":%d}]},{"row":[%s]}]}' % (total, inner)


def test_ledger_reads_new_pages_only(spark, tmp_path):
    folder, book = tmp_path / "landed pages", str(tmp_path / "ledger")
    folder.mkdir()
    (folder / "ids20.jsonl").write_text(page(3, "a", "b") + "\n" + page(3, "c") + "\n")
    (folder / "ids21.jsonl").write_text(page(4, "d") + "\nbusy\n")

    def run():
        pages = ledger.read_new_pages(spark, str(folder), ledger.read_ledger(spark, book))
        found = landed.bill_rows(pages).select("BILL_ID")
        result = sorted(r[0] for r in found.collect()), {Path(f).name for f in pages.inputFiles()}
        ledger.enter(ledger.ledger_rows(pages, "BILLRCP"), book)
        return result

    assert run() == (["a", "b", "c", "d"], {"ids20.jsonl", "ids21.jsonl"})
    report = ledger.set_report(ledger.read_ledger(spark, book)).orderBy("term").collect()
    assert [(r["term"], r["files"], r["pages"], r["parsed_pages"], r["landed_rows"], r["stated_rows"], r["complete"]) for r in report] == [
        (20, 1, 2, 2, 3, 3, True), (21, 1, 2, 1, 1, 4, False)]
    (folder / "ids21_2.jsonl").write_text(page(4, "e", "f", "g") + "\n")
    assert run() == (["e", "f", "g"], {"ids21_2.jsonl"})
    assert [r["term"] for r in ledger.incomplete_sets(ledger.read_ledger(spark, book)).collect()] == [21]
    # A file that is landed again takes the place of what it held.
    (folder / "ids21.jsonl").write_text(page(4, "d") + "\n" + page(4) + "\n")
    assert run()[1] == {"ids21.jsonl"}
    assert ledger.incomplete_sets(ledger.read_ledger(spark, book)).count() == 0
    assert run() == ([], set())


def test_long_texts_come_in_parts(spark):
    data = [("hot", i // 3, f"value {i}" if i % 7 else None) for i in range(2000)] + [("a", 1, "x"), ("a", 0, "y"), ("b", 1, None), (None, 1, "lost")]
    df = spark.createDataFrame(data, "url string, n int, content string").repartition(7)
    whole = dict(map(tuple, join_texts(df, "url", "content", "n").collect()))
    parts = join_long_texts(df, "url", "content", "n", 500).orderBy("url", "part").collect()
    for url, joined in whole.items():
        mine = [r for r in parts if r["url"] == url]
        assert " / ".join(r["content"] for r in mine) == joined
        assert len({r["part"] for r in mine}) == len(mine) and all(len(r["content"]) < 500 + len("value 1999") for r in mine)
    assert len([r for r in parts if r["url"] == "hot"]) == math.ceil((len(whole["hot"]) + 3) / 500)
    assert join_long_texts(df.limit(0), "url", "content", "n").count() == 0
    exact = spark.createDataFrame([("k", 1, "a" * 5), ("k", 2, "b" * 5)], df.schema)
    assert join_long_texts(exact, "url", "content", "n", 13).count() == 1


def test_page_texts_in_parts(spark):
    fetches = spark.createDataFrame([("u", 1, '<div id="summaryContentDiv" class="textType02">one</div>', None)], "url string, attempt int, html string, error string")
    given = spark.createDataFrame([("u", "two"), ("u", "three")], "url string, content string")
    assert rows(page_texts(fetches, given)) == Counter([("u", "one / three / two")])
    got = page_texts(fetches, given, 6).orderBy("part").collect()
    assert [(r["part"], r["content"]) for r in got] == [(0, "one"), (1, "three"), (2, "two")]


def plain_split(word, shares, own):
    """All cuts of a word, by brute force."""
    best = (own, 0, word)
    for marks in itertools.product([False, True], repeat=len(word) - 1):
        cuts = "".join(c + (" " if m else "") for c, m in zip(word, [*marks, False])).split(" ")
        if len(cuts) > 1 and all(c in shares for c in cuts):
            value = sum(shares[c] for c in cuts)
            if value > best[0] + 1e-12 or (abs(value - best[0]) <= 1e-12 and best[1] and len(cuts) < best[1]):
                best = (value, len(cuts), " ".join(cuts))
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=8), st.dictionaries(st.text("ab", min_size=1, max_size=4), st.floats(-9, -0.5), max_size=8), st.floats(-12, -1))
def test_best_split_beside_all_cuts(word, shares, own):
    pieces = {(i, n): shares[word[i: i + n]] for i in range(len(word)) for n in range(1, len(word) - i + 1) if n < len(word) and word[i: i + n] in shares}
    spaced, value = compounds.best_split(word, pieces, own)
    expected = plain_split(word, shares, own)
    assert spaced.replace(" ", "") == word and value == pytest.approx(expected[0])


def test_learnt_splits_and_spacing(spark):
    base = ["출입국 관리 제도 개선"] * 40 + ["national archive office"] * 40
    docs = [(i, t) for i, t in enumerate(base + ["출입국관리 제도", "NationalArchive, 출입국관리 office", "", None, "archives"])]
    df = spark.createDataFrame(docs, "id int, content string")
    splits = compounds.learnt_splits(compounds.word_counts(df))
    assert {(r["word"], r["spaced"]) for r in splits.collect()} == {("출입국관리", "출입국 관리")}
    got = {r["id"]: r["content"] for r in compounds.space_compounds(df, splits).collect()}
    assert got[80] == "출입국 관리 제도" and got[81] == "NationalArchive, 출입국 관리 office" and got[82] == "" and got[83] is None
    assert got[0] == base[0] and len(got) == len(docs)
    # The fixed pairs come before and stay as they are.
    fixed = spark.createDataFrame([(1, "사후관리 법적근거")], "id int, content string")
    spaced = fixed.withColumn("content", text.preprocess(F.col("content")))
    assert rows(compounds.space_compounds(spaced, splits)) == rows(spaced) == Counter([(1, "사후 관리 법적 근거")])
    none = compounds.learnt_splits(compounds.word_counts(df.limit(0)))
    assert none.count() == 0 and rows(compounds.space_compounds(df, none)) == rows(df)
    few = compounds.learnt_splits(compounds.word_counts(df), at_least=1000)
    assert few.count() == 0


def test_every_distinct_word_beside_brute_force(spark):
    words = ["ab"] * 30 + ["abc"] * 25 + ["ca"] * 40 + ["bca"] * 22 + ["abca", "abcab", "abcaab", "caabca", "cabca", "abab", "zz"]
    df = spark.createDataFrame([(w,) for w in words], "content string")
    counts = Counter(words)
    shares = {w: math.log(n / len(words)) for w, n in counts.items() if n >= 20}
    got = {r["word"]: r["spaced"] for r in compounds.learnt_splits(compounds.word_counts(df)).collect()}
    expected = {w: plain_split(w, shares, math.log(n / len(words))) for w, n in counts.items()}
    assert got and got == {w: e[2] for w, e in expected.items() if e[1]}


def test_last_feature_line_wins(spark, tmp_path):
    line = '{"properties":{"SGG_Code":"1"},"geometry":{"type":"Point","coordinates":[%d,0]}},'
    path = tmp_path / "lines.json"
    path.write_text("\n".join(line % n for n in (5, 9, *range(100, 3000), 7)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = landed.read_feature_lines(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 1 and "[7,0]" in got[0]["boundary"]


def test_extract_of_its_own_number_comes_first(spark):
    bills = spark.createDataFrame([(20, "0012345 ", "t"), (20, "2345", "u"), (21, "12345", "v"), (20, None, "w")], "age int, bill_number string, title string")
    extracts = spark.createDataFrame([(20, "12345", "own", None), (20, "992345", "spare", None), (20, "882345", " ", None), (20, None, "none", None)],
                                     "age int, bill_number string, reason string, main string")
    got = {r["title"]: (r["content"], r["matches"]) for r in fill_from_extracts(bills, extracts).collect()}
    assert got == {"t": ("own", 1), "u": ("spare", 1)}


def test_only_rows_of_rare_words_meet_the_splits(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"the the Rainfall w{i}") for i in range(30)] + [(30, None), (30, "the x")], "id int, content string")
    splits = spark.createDataFrame([("rainfall", 30, "rain fall"), ("w7", 1, "w 7")], "word string, n bigint, spaced string")
    sizes, store = [], compounds.materialize

    def noted(d):
        out = store(d)
        if "_text" in d.columns:
            sizes.append(out.groupBy("word").count().count())
        return out

    monkeypatch.setattr(compounds, "materialize", noted)
    want = Counter([(i, f"the the Rain fall {'w 7' if i == 7 else f'w{i}'}") for i in range(30)] + [(30, None), (30, "the x")])
    for frequent in (1 << 17, 20, 1):
        monkeypatch.setattr(compounds, "FREQUENT", frequent)
        assert Counter(map(tuple, compounds.space_compounds(df, splits).collect())) == want
    # rainfall and w7 alone; with few words known, w0 to w29 and x beside rainfall; with none, "the" too.
    assert sizes == [2, 32, 33]
