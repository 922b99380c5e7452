"""Attempts, prompts, keywords and topics on literal rows."""

import pytest
from pyspark.sql import functions as F

from plenary import schemas
from plenary.operators import keywords, prompts, responses, topics


def answers(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], schemas.RESPONSE)


def by_key(df, *columns):
    return {r[0]: tuple(r)[1:] if len(columns) > 2 else r[1] for r in df.select(*columns).collect()}


def test_summaries(spark):
    bills = spark.createDataFrame(
        [("a", "본문"), ("b", None), ("c", "  "), ("d", "원문 그대로"), ("e", "본문")], "bill_id string, content string")
    tried = answers(spark, ("a", 0, None, "503"), ("a", 1, "  "), ("a", 2, " 제도를 → 개선 "), ("a", 3, "늦음"),
                    ("b", 0, "무시"), ("d", 0, None, "429"), ("d", 7, "너무 늦음"), ("e", 0, "강화함"))
    assert by_key(responses.summaries(bills, tried), "bill_id", "summary") == {
        "a": "제도를  개선함", "b": None, "c": "  ", "d": "너무 늦음함", "e": "강화함"}
    tried = tried.where("attempt < 7")
    failed = responses.summaries(bills, tried, failure="오류: 응답 없음")
    assert by_key(failed, "bill_id", "summary")["d"] == "오류: 응답 없음"
    own = responses.summaries(responses.last_errors(bills, tried, "bill_id", "why"), tried, failure=F.concat(F.lit("오류: "), "why"))
    assert by_key(own, "bill_id", "summary")["d"] == "오류: 429"


def test_slogans(spark):
    bills = spark.createDataFrame([("a", "x"), ("b", ""), ("c", None), ("d", "x"), ("e", "x")], "bill_id string, summary string")
    tried = answers(spark, ("a", 0, "짧음"), ("a", 1, "**우리 동네가 더 안전해져요!**\n둘째"), ("d", 0, "가" * 36),
                    ("e", 0, None, "x"), ("e", 4, "세 번을 넘긴 시도입니다"))
    stock = "더 나은 사회를 위한 변화!"
    assert by_key(responses.slogans(bills, tried), "bill_id", "card_news_content") == {
        "a": "우리 동네가 더 안전해져요!", "b": "내용 없음", "c": "내용 없음", "d": stock, "e": "세 번을 넘긴 시도입니다"}


def test_extracted_fields(spark):
    tried = answers(spark, ("1.pdf", 1, '{"bill_no": "제22호", "reason": "a\\nb", "main": ""}'), ("2.pdf", 1, "오류"), ("4.pdf", 1, None, "x"), ("4.pdf", 5, '{"bill_no": "7"}'),
                    ("3.pdf", 1, '{"bill_no": "", "reason": "", "main": ""}'))
    assert sorted(map(tuple, responses.extracted_fields(tried).collect())) == [("1.pdf", "22", "a b", ""), ("4.pdf", "7", "", "")]


def test_answers_without_a_model(spark):
    files = spark.createDataFrame([
        ("1.pdf", "의안번호 : 제 2207521\n제안이유\n가나\n다\n주요내용\n라마"), ("2.pdf", "의 안\n주 문\n바사"), ("3.pdf", "없음")],
        "file_name string, text string")
    got = responses.extracted_fields(responses.section_answers(files))
    assert sorted(map(tuple, got.collect())) == [("1.pdf", "2207521", "가나 다", "라마"), ("2.pdf", "", "", "바사")]
    bills = spark.createDataFrame([("a", "제도를 개선함. 둘째."), ("b", " ")], "bill_id string, content string")
    answered = responses.summaries(bills, responses.first_sentence_answers(bills))
    assert by_key(answered, "bill_id", "summary") == {"a": "제도를 개선함", "b": " "}


def test_fetched_content(spark):
    page = '<div id="summaryContentDiv" class="textType02">■ 제안이유 {}</div>'
    fetches = spark.createDataFrame([
        ("u1", 1, None, "timeout"), ("u1", 2, page.format("둘째"), None), ("u1", 3, page.format("셋째"), None),
        ("u2", 1, None, "first"), ("u2", 2, None, "last"), ("u2", 4, page.format("늦음"), None),
        ("u3", 1, "<p>없음</p>", None)], schemas.FETCH)
    assert by_key(responses.fetched_content(fetches), "url", "content", "is_error") == {
        "u1": ("둘째", False), "u2": ("늦음", False), "u3": (None, False)}


def test_nicknames(spark):
    got = responses.nicknames(spark.createDataFrame([(1,), (2,)], "topic bigint"), answers(spark, ("1", 1, " 별 ")))
    assert by_key(got, "topic", "nickname") == {1: "별", 2: None}


def test_stop_word_answers(spark):
    bills = spark.createDataFrame([("a", "원문"), ("b", None), ("c", "원문"), ("d", " ")], "bill_id string, content string")
    tried = answers(spark, ("a", 0, " "), ("a", 9, " 법률 \n 개정 "), ("b", 0, "무시"), ("c", 0, None, "x"), ("d", 0, "무시"))
    assert by_key(responses.cleaned_texts(bills, tried), "bill_id", "content") == {"a": "법률 개정", "b": None, "c": "원문", "d": " "}


def test_prompt_parts_add_up_to_the_text(spark):
    texts = {"a": "가나다" * 2500, "b": "", "c": None, "d": "라" * 3000}
    df = spark.createDataFrame([(k, None, v) for k, v in texts.items()], "bill_id string, title string, content string")
    for request in (lambda x: prompts.classify_prompt(F.col("title"), x), lambda x: prompts.keyword_prompt(F.col("title"), x),
                    prompts.stop_word_prompt, prompts.extract_prompt):
        plain = prompts.prompt_parts(df, "bill_id", "content", 3000, lambda x: x).collect()
        asked = {(r.item_id, r.part): r.prompt for r in prompts.prompt_parts(df, "bill_id", "content", 3000, request).collect()}
        for key, text in texts.items():
            parts = sorted((r.part, r.prompt) for r in plain if r.item_id == key)
            assert "".join(p for _, p in parts) == (text or "") and [p for p, _ in parts] == list(range(len(parts)))
            assert all(piece in asked[(key, i)] for i, piece in parts)
    whole = prompts.prompt_table(df, "bill_id", prompts.summary_prompt(F.col("content"))).where("item_id = 'a'").first()["prompt"]
    assert texts["a"] in whole


def test_answers_to_parts(spark):
    rows = [("a", 0, 1, None, "x"), ("a", 1, 0, '["나"]', None), ("a", 0, 2, '["가"]', None)]
    tried = spark.createDataFrame(rows, "item_id string, part int, attempt int, text string, error string")
    merged = responses.merged_parts(tried)
    items = spark.createDataFrame([("a",)], "bill_id string")
    assert keywords.keywords_from_responses(items, merged, "bill_id").first()["keywords"] == ["가"]


def test_every_part_is_merged(spark):
    rows = [("a", 0, 1, None, "x"), ("a", 0, 2, " P  0 ", None), ("a", 0, 3, "later", None), ("a", 3, 1, "P3", None), ("b", 0, 1, " ", None)]
    tried = spark.createDataFrame(rows, "item_id string, part int, attempt int, text string, error string")
    bills = spark.createDataFrame([("a", "0000111122223333"), ("b", "00001111"), ("c", None), ("d", " ")], "bill_id string, content string")
    assert by_key(responses.cleaned_parts(bills, tried, 4), "bill_id", "content") == {"a": "P 0 11112222 P3", "b": "00001111", "c": None, "d": " "}


def test_fields_and_keywords_of_every_part(spark):
    rows = [("f", 0, 1, '{"bill_no": "12", "reason": "r", "main": ""}', None), ("f", 1, 1, '{"bill_no": "", "reason": "", "main": "m1"}', None),
            ("f", 1, 2, '{"bill_no": "9", "reason": "", "main": "later"}', None), ("f", 2, 1, '{"bill_no": "", "reason": "r", "main": "m2"}', None),
            ("g", 0, 1, "none", None), ("k", 0, 1, '["a","b"]', None), ("k", 1, 0, "none", None), ("k", 1, 1, '["b","c"]', None), ("k", 2, 1, '["d"]', "x")]
    tried = spark.createDataFrame(rows, "item_id string, part int, attempt int, text string, error string")
    assert [tuple(r) for r in responses.extracted_parts(tried).collect()] == [("f", "12", "r", "m1 m2")]
    items = spark.createDataFrame([("k",), ("g",)], "topic string")
    assert by_key(responses.keyword_parts(items, tried, "topic"), "topic", "keywords") == {"k": ["a", "b", "c"], "g": ["법안", "개정", "정책", "시행"]}


def test_samples_and_titles(spark):
    df = spark.createDataFrame([(i, "g", f"text{i}", f"title{i}") for i in range(20)], "id int, topic string, content string, title string")
    pages = {r.page: (r.sample_text, r.sample_title) for r in prompts.cluster_samples(df, "topic", "id").collect()}
    assert len(pages) == 7 and pages[0] == ("text0 text1 text2", "title0") and pages[6] == ("text18 text19", "title18")
    lines = {r.page: r.titles.split("\n") for r in prompts.numbered_titles(df, "topic", "id").collect()}
    assert lines[0][0] == "1. title0" and len(lines[0]) == 15 and lines[1] == [f"{i + 1}. title{i}" for i in range(15, 20)]


@pytest.fixture(scope="module")
def labelled(spark):
    """Groups A_x and C_일반 are split as answered; B_y has an unusable answer; the rest stay whole."""
    docs = [(f"a{i:02d}", "A", "x") for i in range(1, 13)] + [(f"b{i:02d}", "B", "y") for i in range(1, 12)]
    docs += [("c1", "C", None), ("c2", "C", None), ("d1", None, None)]
    bills = spark.createDataFrame([(d, f"{d} text") for d, *_ in docs], "bill_id string, content string")
    classes = answers(spark, *[
        (d, 1, "none" if c is None else '{"category": "%s"%s}' % (c, f', "subcategory": "{s}"' if s else ""))
        for d, c, s in docs])
    groups = answers(
        spark, ("A_x", 1, '{"groups": [{"name": "p", "bills": [1, 3, 99, 0]}, {"name": "q", "bills": [3, 2]}, {"name": "r", "bills": [1]}]}'),
        ("B_y", 1, "broken {"), ("C_일반", 1, '{"groups": [{"name": "p", "bills": [1]}]}'))
    return bills, classes, groups


def test_clusters(labelled):
    got = by_key(topics.cluster(*labelled), "bill_id", "topic_group", "topic")
    assert got["a01"] == got["a03"] == ("A_x", 0)
    assert got["a02"] == ("A_x", 1)
    assert {got[f"a{i:02d}"] for i in range(4, 13)} == {("A_x", 2)}
    assert {got[f"b{i:02d}"] for i in range(1, 12)} == {("B_y", 3)}
    assert (got["c1"], got["c2"], got["d1"]) == (("C_일반", 4), ("C_일반", 5), ("기타_일반", 6))


def test_keyword_answers(spark):
    items = spark.createDataFrame([(0,), (1,)], "topic bigint")
    got = keywords.keywords_from_responses(items, answers(spark, ("0", 1, '["a","b","c","d","e"]')), "topic")
    assert by_key(got, "topic", "keywords") == {0: ["a", "b", "c", "d"], 1: ["법안", "개정", "정책", "시행"]}


def test_term_scores(spark):
    import math

    docs = spark.createDataFrame([
        (1, "p", "의료 의료 인력 등"), (2, "p", "의료 수급 공통"), (3, "q", "교육 학교 공통"), (4, "q", None)],
        "id int, topic string, content string")
    got = {(r["topic"], r["term"]): r["score"] for r in keywords.cluster_term_scores(docs, "topic").collect()}
    assert got[("p", "의료")] == round(2 * math.log(5 / 3), 6)
    assert got[("q", "교육")] == round(math.log(5 / 2), 6)
    assert ("p", "등") not in got
    single = {(r["id"], r["term"]): r["score"] for r in keywords.doc_term_scores(docs, "id").collect()}
    assert single[(1, "의료")] == round(2 * math.log(5 / 3), 6) and single[(3, "공통")] == round(math.log(5 / 3), 6)
    best = keywords.as_keyword_list(keywords.cluster_term_scores(docs, "topic"), "topic")
    assert by_key(best, "topic", "keywords")["p"][0] == "의료"


def test_single_topics(spark):
    docs = spark.createDataFrame([("b", -1), ("a", 5), ("c", None)], "bill_id string, topic bigint")
    assert by_key(keywords.single_topics(docs, "bill_id"), "bill_id", "topic") == {"a": 5, "b": -3, "c": -4}
