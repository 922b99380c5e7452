"""Whole jobs on small Korean fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from plenary import schemas
from plenary.operators import aggregates, filters, joins, project, sets
from plenary.plans import backfill, bills, crosstabs, topic_labels


@pytest.fixture(scope="module")
def landed(spark):
    ids = spark.createDataFrame([(
        '{"BILLRCP":[{"head":[]},{"row":[{"BILL_ID":"B1","PROC_RSLT":"원안가결"},{"BILL_ID":"B2","PROC_RSLT":"수정가결"},'
        '{"BILL_ID":"B3","PROC_RSLT":"폐기"}]}]}',)], "body string")
    row = '{"AGE":"22","MONA_CD":"%s","BILL_NAME":"%s","BILL_NO":"%s","BILL_ID":"%s","RESULT_VOTE_MOD":"%s","VOTE_DATE":"20241114 101112","BILL_URL":"%s"}'
    votes = [("M1", "가법", "2200001", "B1", "찬성", "u1"), ("M2", "가법", "2200001", "B1", "반대", "u1"),
             ("M1", "나법", "2200002", "B2", "찬성", "u2"), ("M2", "다법", "2200003", "B3", "찬성", "u3")]
    pages = spark.createDataFrame(
        [('{"nojepdqqaweusdfbi":[{"head":[]},{"row":[' + ",".join(row % v for v in votes) + "]}]}",)], "body string")
    page = '<div id="summaryContentDiv" class="textType02">{}</div>'
    fetches = spark.createDataFrame([
        ("u1", 1, page.format("■ 제안이유 및 주요내용 안 제5조에 따라 의료 인력을 늘림"), None), ("u2", 1, "<p></p>", None)], schemas.FETCH)
    return ids, pages, fetches


def test_assemble_term(spark, landed):
    ids, pages, fetches = landed
    votes = bills.term_votes(ids, pages)
    assert sorted(r[0] for r in bills.passed_ids(ids).collect()) == ["B1", "B2"]
    assert sorted(r[0] for r in bills.urls_to_fetch(votes).collect()) == ["u1", "u2"]
    answers = spark.createDataFrame([("B1", 0, "의료 인력을 늘림", None)], schemas.RESPONSE)
    stages = bills.assemble_term(votes, fetches, answers, answers)
    assert list(stages) == ["01_votes", "02_page_texts", "03_votes_with_text", "04_unique_bills", "05_final"]
    assert stages["01_votes"].count() == 3
    # a page without the element counts as empty text and its votes stay
    assert sorted(map(tuple, stages["02_page_texts"].collect())) == [("u1", "안 제5조에 따라 의료 인력을 늘림"), ("u2", "")]
    final = {(r["member_id"], r["bill_id"]): r for r in stages["05_final"].collect()}
    assert len(final) == 3
    first = final[("M2", "B1")]
    assert (first["age"], first["title"], first["bill_number"], first["result"], first["url"]) == ("22", "가법", "2200001", "반대", "u1")
    assert first["date"] == datetime.date(2024, 11, 14)
    assert first["cleaned"] == "에 따라 의료 인력을 늘림"
    assert first["summary"] == "의료 인력을 늘림함" and first["card_news_content"] == "의료 인력을 늘림"
    assert final[("M1", "B2")]["cleaned"] == "" and final[("M1", "B2")]["card_news_content"] == "내용 없음"
    assert "content" not in stages["05_final"].columns
    third = stages["03_votes_with_text"]
    assert "content" not in third.columns and {r["content_chars"] for r in third.collect()} == {len("안 제5조에 따라 의료 인력을 늘림"), 0}
    cleaned = spark.createDataFrame([("B1", 0, "의료  인력", None)], schemas.RESPONSE)
    again = bills.assemble_term(votes, fetches, answers, answers, stop_word_responses=cleaned)["05_final"]
    assert {r["cleaned"] for r in again.where("bill_id = 'B1'").collect()} == {"의료 인력"}


def test_label_bills(spark):
    table = spark.createDataFrame([
        (22, "가", "B1", "1", "의료 인력 의료 수급"), (22, "나", "B2", "2", "의료 위원회 의료"), (22, "다", "B3", "3", "교육 법률안"),
    ], "age int, title string, bill_id string, bill_number string, content string")
    classes = spark.createDataFrame([
        ("B1", 1, '{"category": "보건의료"}', None), ("B2", 1, '{"category": "보건의료"}', None)], schemas.RESPONSE)
    none = spark.createDataFrame([], schemas.RESPONSE)
    got = topic_labels.label_bills(table, classes, none)
    assert got.columns == list(topic_labels.LABEL_COLUMNS)
    rows = {r["bill_id"]: r for r in got.collect()}
    assert rows["B1"]["topic"] == rows["B2"]["topic"] != rows["B3"]["topic"]
    assert "의료" in rows["B1"]["topic_label"].split(", ") and rows["B3"]["content"] == "교육 법률"
    answered = spark.createDataFrame([("1", 1, '["가", "나"]', None)], schemas.RESPONSE)
    labels = {r["bill_id"]: r["topic_label"] for r in topic_labels.label_bills(table, classes, none, answered).collect()}
    number = {b: r["topic"] for b, r in rows.items()}
    assert labels == {b: "가, 나" if number[b] == 1 else "법안, 개정, 정책, 시행" for b in number}
    summary = aggregates.topic_summary(got).collect()
    assert [r["document_count"] for r in summary] == [2, 1]


def test_backfill_chain(spark):
    titles = spark.createDataFrame([
        (22, "http://x?billId=PRC_1", "[2207521] 가 감사요구안(위원장)"), (22, "http://x?billId=PRC_2", "[2203533] 나 법률안"),
        (21, "http://x?billId=PRC_3", "다 법률안")], "age int, url string, bill_title string")
    extracts = spark.createDataFrame([
        (22, " 7521", " 이유", None), (22, "3533", None, " "), (21, "", "빈 번호", "내용"), (20, "7521", "다른 대수", None)],
        "age int, bill_number string, reason string, main string")
    recovered = backfill.recovered_bills(titles, extracts)
    assert sorted(map(tuple, recovered.collect())) == [
        (21, "다 법률안", "PRC_3", "", "빈 번호 내용"), (22, "가 감사요구안(위원장)", "PRC_1", "2207521", "이유")]
    published = spark.createDataFrame([(22, "라", "PRC_4", "2200004", None), (22, "예산안", "PRC_5", "2200005", ""),
                                       (22, "마", "PRC_6", "2200006", " NONE ")], schemas.BILL)
    merged = backfill.merged_bills(recovered, published)
    assert merged.count() == 5
    with pytest.raises(KeyError, match="published.*content"):
        backfill.merged_bills(recovered, published.drop("content"))
    assert {r["bill_id"]: r["removed"] for r in backfill.still_missing(merged).collect()} == {"PRC_4": False, "PRC_5": True}
    fills = spark.createDataFrame([("2200004", "나중"), ("2200004", "가장 먼저"), ("2200006", None)], "bill_number string, content string")
    filled = {r["bill_id"]: r["content"] for r in backfill.filled_bills(merged, fills).collect()}
    assert filled == {"PRC_1": "이유", "PRC_3": "빈 번호 내용", "PRC_4": "가장 먼저"}
    assert {r["age_group"] for r in backfill.age_classes(merged).collect()} == {"20대"}


def test_numbers_before_last_digits(spark):
    bills_ = spark.createDataFrame([(22, "a", "B1", "2207521"), (22, "b", "B2", "1107521"), (22, "c", "B3", "3307521"), (21, "d", "B4", "2207521")],
                                   "age int, title string, bill_id string, bill_number string")
    extracts = spark.createDataFrame([(22, "2207521", "own", None), (22, " 01107521", "other", "x"), (22, "7521", "short", None), (22, "97521", "also", None)],
                                     "age int, bill_number string, reason string, main string")
    got = joins.fill_from_extracts(bills_, extracts).select("bill_id", "content", "matches").collect()
    assert sorted(map(tuple, got)) == [("B1", "own", 1), ("B2", "other x", 1), ("B3", "also / short", 2)]


def test_enriched_and_published_tables(spark):
    table = spark.createDataFrame([(22, "가", "B1", "1", "c"), (22, "나", "B2", "2", "c")], schemas.BILL)
    topics = spark.createDataFrame([("B1", 3, "(의료, 인력)", "의료")], "bill_id string, topic int, topic_label string, content string")
    summaries = spark.createDataFrame([("B2", "요약함")], "bill_id string, content string")
    got = {r["bill_id"]: tuple(r)[4:] for r in backfill.enriched_bills(table, topics, summaries).collect()}
    assert got == {"B1": ("의료", None, 3, "[의료, 인력]"), "B2": (None, "요약함", None, "[]")}
    members = {t: spark.createDataFrame([(f"M{t}", "가", "무소속", "울산 울주군", "남")], schemas.MEMBER) for t in (21, 22)}
    published = backfill.member_table(members)
    assert published.columns == ["age", "name", "party", "SIDO_SGG", "member_id", "gender"]
    assert sorted(map(tuple, backfill.district_table(published).collect())) == [
        (21, "울산 울주군", "울산", "울주군"), (22, "울산 울주군", "울산", "울주군")]
    votes = spark.createDataFrame([("22", "M1", "B1", "2200001", "찬성", "20241114 10")],
                                  "AGE string, MONA_CD string, BILL_ID string, BILL_NO string, RESULT_VOTE_MOD string, VOTE_DATE string")
    assert backfill.vote_table(votes).first().asDict() == {
        "age": "22", "member_id": "M1", "bill_number": "2200001", "result": "찬성", "date": "2024-11-14"}


def test_vote_summary_finds_its_columns(spark):
    votes = spark.createDataFrame([("가법", "김", "찬성"), ("가법", "이", "반대"), ("나법", "김", "찬성"), ("나법", "박", "찬성")],
                                  "BILL_NAME string, HG_NM string, ` RESULT ` string")
    members = spark.createDataFrame([("김", "p", "남", "서울 종로"), ("이", "q", "여", "비례대표")],
                                    "HG_NM string, party string, gender string, district string")
    joined = crosstabs.member_votes(votes, members, "HG_NM", ["RESULT", "BILL_NAME", "party", "gender", "district"])
    got = crosstabs.vote_summary(joined, "BILL_NAME", ["party", "gender", "district"], ["HG_NM", "RESULT"])
    assert got.columns == ["BILL_NAME", "HG_NM", "RESULT", "party_counts", "gender_counts", "district_counts"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == [
        ("가법", "김", "찬성", {"p": 1, "q": 1}, {"남": 1, "여": 1}, {"비례대표": 1, "서울 종로": 1}),
        ("가법", "이", "반대", {"p": 1, "q": 1}, {"남": 1, "여": 1}, {"비례대표": 1, "서울 종로": 1}),
        ("나법", "김", "찬성", {"p": 1}, {"남": 1}, {"서울 종로": 1})]
    assert crosstabs.vote_counts(joined, "BILL_NAME", ["party"]).count() == 3
    shares = crosstabs.result_shares(joined, ["BILL_NAME", "party"], "RESULT", ["찬성", "반대"])
    assert sorted(map(tuple, shares.collect())) == [
        ("가법", "p", 1, 0, 1.0, 0.0), ("가법", "q", 0, 1, 0.0, 1.0), ("나법", "p", 1, 0, 1.0, 0.0)]


def test_invariants(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "nan"), (4, " None"), (5, "본문"), (6, "　")], "id int, content string")
    audit = aggregates.content_audit(df).first()
    assert audit["valid_rows"] == filters.clean_content(df).count() == 1
    assert audit["valid_rows"] + audit["removed_rows"] == audit["total_rows"]
    assert (audit["null_rows"], audit["empty_rows"], audit["nan_text_rows"], audit["none_text_rows"]) == (1, 2, 2, 1)
    flagged = filters.flag_procedural(df.withColumn("title", F.lit(None).cast("string")))
    assert flagged.where("removed").count() == 0
    assert sets.complement(df, F.col("content") == "").count() == 5
    before, after = df, df.na.fill("x", ["content"])
    assert tuple(aggregates.fill_change(before, after).first()) == (5, 6, 1)


def test_null_safe_helpers(spark):
    df = spark.createDataFrame([("a", "12"), ("b", "x"), ("c", None)], "k string, bill_number string")
    assert [r[1] for r in project.as_number_text(df).orderBy("k").collect()] == ["12", "0", "0"]
    assert [r[1] for r in project.as_number(df, "bill_number").orderBy("k").collect()] == [12.0, None, None]
    assert project.add_if_absent(df, "content").first()["content"] == ""
    assert joins.key_multiplicity(df, ["k"]).first()[:] == (1, 3)
