"""Prompt texts per row: a template and the row's values.

A task that takes a limited number of characters gets a long text in numbered parts, which add up to the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plenary.functions import lexicon
from plenary.operators.index import group_position, materialize

# Characters of text that one request of a task takes, and titles and documents on one page.
CLASSIFY_CHARS = 3000
KEYWORD_CHARS = 3000
EXTRACT_CHARS = 6000
TITLES_PER_PAGE = 15
DOCS_PER_PAGE = 3

_KEYWORD_ANSWER = '["첫째", "둘째", "셋째", "넷째"]'


def _prompt(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def classify_prompt(title: Column, content: Column) -> Column:
    choices = ", ".join(lexicon.CATEGORIES)
    return _prompt(
        "법안을 주제 분류 하나로 나누세요. 목록에 없으면 새 분류를 쓰세요.\n분류: ", choices, "\n제목: ", title,
        "\n내용: ", content, '\n답: {"category": "분류", "subcategory": "세부", "confidence": 0.9}',
    )


def keyword_prompt(title: Column, content: Column) -> Column:
    return _prompt("내용에 나오는 핵심어 4개를 고르세요.\n제목: ", title, "\n내용: ", content, "\n답: ", _KEYWORD_ANSWER)


def stop_word_prompt(content: Column) -> Column:
    return _prompt("조사와 어미, 불용어를 빼고 법률 용어는 남기세요.\n내용: ", content)


def grouping_prompt(group: Column, titles: Column) -> Column:
    return _prompt("같은 분류의 법안을 비슷한 것끼리 묶고 번호로 답하세요.\n분류: ", group, "\n", titles,
                   '\n답: {"groups": [{"name": "묶음", "bills": [1, 2]}]}')


def summary_prompt(content: Column) -> Column:
    return _prompt("핵심 조치와 이유를 한 문장으로 요약하고 '함'으로 끝내세요. → · | , 는 쓰지 마세요.\n내용: ",
                   content, "\n요약: ")


def slogan_prompt(content: Column) -> Column:
    return _prompt("시민에게 알리는 20자 안팎의 한 줄 문구로 바꾸세요.\n내용: ", content, "\n문구: ")


def extract_prompt(text: Column) -> Column:
    return _prompt("의안번호, 제안이유, 주요내용을 찾으세요. 없으면 빈값.\n원문: ", text,
                   '\n답: {"bill_no": "", "reason": "", "main": ""}')


def nickname_prompt(keywords: Column) -> Column:
    return _prompt("이 핵심어들에 어울리는 한국어 별명을 하나 지어 주세요.\n핵심어: ", keywords, "\n별명: ")


def text_parts(text: Column, chars: int) -> Column:
    """The text in stretches of `chars` characters; an empty or null text is one empty stretch."""
    whole = F.coalesce(text, F.lit(""))
    last = F.greatest(F.ceil(F.length(whole) / chars).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(whole, i * chars + 1, F.lit(chars)))


def prompt_table(df: DataFrame, key: str, prompt: Column) -> DataFrame:
    """The landing request of a task that takes whole texts: (item_id, prompt)."""
    return df.select(F.col(key).cast("string").alias("item_id"), prompt.alias("prompt"))


def prompt_parts(df: DataFrame, key: str, text: str, chars: int, prompt: Callable[[Column], Column]) -> DataFrame:
    """The landing request of a task that takes `chars` characters: (item_id, part, parts, prompt), parts from 0.

    `prompt` makes the request of one stretch; the stretches of an item in order are its text.
    """
    cut = df.withColumn("_parts", text_parts(F.col(text), chars))
    rows = cut.select("*", F.size("_parts").alias("parts"), F.posexplode("_parts").alias("part", "_text"))
    return rows.select(F.col(key).cast("string").alias("item_id"), "part", "parts", prompt(F.col("_text")).alias("prompt"))


def _pages(df: DataFrame, group: str, order_by: str, per_page: int) -> DataFrame:
    """Adds `position` (from 1) and `page` (from 0) of each row in its group, however large the group is."""
    keys = materialize(df.select(group, order_by).where(F.col(group).isNotNull()))
    placed = group_position(keys, [group], [order_by]).withColumn("page", F.floor((F.col("position") - 1) / per_page).cast("int"))
    return df.join(placed, [group, order_by])


def numbered_titles(df: DataFrame, group: str, order_by: str, title: str = "title", per_page: int = TITLES_PER_PAGE) -> DataFrame:
    """(group, page, titles): all titles of each group as numbered lines, whole, some per page.

    `order_by` must be unique within a group. The numbers are the positions in the whole group.
    """
    placed = _pages(df.select(group, order_by, title), group, order_by, per_page)
    line = F.concat(F.col("position").cast("string"), F.lit(". "), F.coalesce(title, F.lit("")))
    lines = F.array_sort(F.collect_list(F.struct("position", line.alias("line"))))
    return placed.groupBy(group, "page").agg(F.array_join(F.transform(lines, lambda r: r["line"]), "\n").alias("titles"))


def cluster_samples(df: DataFrame, cluster: str, order_by: str, text: str = "content", title: str = "title",
                    per_page: int = DOCS_PER_PAGE) -> DataFrame:
    """(cluster, page, sample_text, sample_title): all whole texts of each cluster, some documents per page.

    The title is that of the page's first document. `order_by` must be unique within a cluster.
    """
    placed = _pages(df.select(cluster, order_by, text, title), cluster, order_by, per_page)
    rows = F.array_sort(F.collect_list(F.struct("position", F.coalesce(text, F.lit("")).alias(text), title)))
    return placed.groupBy(cluster, "page").agg(
        F.array_join(F.transform(rows, lambda r: r[text]), " ").alias("sample_text"), F.get(rows, F.lit(0))[title].alias("sample_title"))
