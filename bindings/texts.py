"""Text cleaning, HTML extraction and key repair on documents, pages, orders and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query
from bindings.sqltext import SPACE, article_text, content_clean, strip, tidy
from plenary.functions import html, jsons, lexicon, text
from plenary.operators.filters import is_valid_file_id, is_web_url
from plenary.session import spread
from plenary.sources.landed import bill_files
from plenary.sources.tables import file_term

_HEADINGS = (r"The\s*that", r"that", r"de\s*la", r"token\s*=", r"of\s*the\s*and", r"[*%$#&]{3}")


@query(f"SELECT doc_id, {content_clean('text', _HEADINGS)} AS content FROM documents")
def clean_text_rules(t):
    """Controls, quotes, commas and headings out; longest heading first."""
    return spread(t.documents, "doc_id").select(
        "doc_id", text.clean_text(F.col("text"), lexicon.HEADINGS + _HEADINGS).alias("content"))


# RE2 spells white space as a class and knows no Unicode word border.
_LAW = "|".join(p.replace("'", "''").replace(r"\s", SPACE).replace(r"\b", "") for p in lexicon.LAW_PATTERNS)
_PREPROCESSED = tidy(f"regexp_replace(coalesce(text, ''), '{_LAW}', ' ', 'g')")


@query(f"SELECT doc_id, {_PREPROCESSED} AS content FROM documents")
def law_pattern_removal(t):
    """Statute references, quotes, percentages and filler out, then compounds apart."""
    return spread(t.documents, "doc_id").select("doc_id", text.preprocess(F.col("text")).alias("content"))


_STOP = ("the", "that", "and", "de", "la", "of", "und", "der", "en", "in")
_KEEP = ("of", "und")
_DROPPED = ", ".join(f"'{w}'" for w in _STOP if w not in _KEEP)


@query(f"""SELECT doc_id, array_to_string(list_filter(
  string_split({tidy('text')}, ' '), lambda w: w <> '' AND w NOT IN ({_DROPPED})), ' ') AS content FROM documents""")
def stopword_filter(t):
    """Stop words out, preserved words kept."""
    return spread(t.documents, "doc_id").select(
        "doc_id", text.drop_stop_words(F.col("text"), _STOP, _KEEP).alias("content"))


@query(f"SELECT page_id, {article_text('html')} AS content FROM pages")
def page_content(t):
    """Text of the content element of each page."""
    return spread(t.pages, "page_id").select("page_id", html.element_text(F.col("html"), "article").alias("content"))


@query(f"SELECT page_id, {article_text('html', 'h1', '')} AS bill_title, '의안명 없음' AS missing_title FROM pages")
def page_title(t):
    """The classed heading, else the first heading, else the default."""
    return spread(t.pages, "page_id").select("page_id", html.page_title(F.col("html"), "h1").alias("bill_title"),
                          html.page_title(F.col("html")).alias("missing_title"))


@query(f"""SELECT page_id, {content_clean(article_text('html'))} AS content, false AS is_missing FROM pages""")
def bill_page_content(t):
    """The id-and-class content block of pages whose article stands for it."""
    block = F.replace(F.replace(
        F.col("html"), F.lit("<article>"), F.lit('<div class="x textType02" id="summaryContentDiv"><div></div>')),
        F.lit("</article>"), F.lit("</div>"))
    return spread(t.pages, "page_id").select("page_id", text.clean_text(html.bill_content(block)).alias("content"),
                          html.bill_content(block).isNull().alias("is_missing"))


_UUID = "substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21)"


@query(f"""WITH m AS (SELECT url, md5(url) AS m FROM pages WHERE url NOT LIKE '%.html')
SELECT url, {_UUID} AS file_id FROM m""")
def file_id_extract(t):
    """The first UUID-shaped id among a page's file links; links with other ids are passed over."""
    digest = F.md5("url")
    uuid = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.substring(digest, 13, 4),
                       F.substring(digest, 17, 4), F.substring(digest, 21, 12))
    link = "<a class=\"f\" href=\"javascript:openBillFile('http://x','%s','%s')\">"
    no_file = F.col("url").endswith(".html")
    linked = F.concat(
        F.col("html"), F.format_string(link, F.substring(digest, 1, 36), F.lit("0")),
        F.format_string(link, F.when(no_file, digest).otherwise(uuid), F.lit("1")))
    return bill_files(spread(t.pages, "page_id").select("url", linked.alias("html"))).where(is_valid_file_id(F.col("file_id")))


@query("""SELECT page_id, coalesce(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
  coalesce(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, url LIKE 'http%' AS is_web,
  'a b/ü' AS decoded FROM pages""")
def url_param(t):
    """Query parameters of page URLs, decoded, empty without one."""
    url = F.col("url")
    encoded = F.concat(F.regexp_replace(url, r"[?#].*", ""), F.lit("?x=1&billId=a+b%2F%C3%BC&billId=2#top"))
    return spread(t.pages, "page_id").select(
        "page_id", text.query_param(url, "utm_source").alias("utm_source"), text.query_param(url, "ref").alias("ref"),
        is_web_url(url).alias("is_web"), text.query_param(encoded, "billId").alias("decoded"))


@query("""SELECT page_id, try_cast(regexp_extract(split_part(url, '/', -1), '([0-9]+)', 1) AS INT) AS age FROM pages""")
def file_terms(t):
    """The term number in the last part of a path, null without one."""
    return t.pages.select("page_id", file_term(F.col("url")).alias("age"))


@query(r"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE split_part(o_orderpriority, '-', 1) END AS bill_number,
  CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
       WHEN contains(o_orderpriority, '-') THEN substr(o_orderpriority, 3) ELSE '' END AS title,
  regexp_replace(o_orderpriority, '[^0-9]', '', 'g') AS digits FROM orders""")
def title_split(t):
    """`[number] text` titles taken apart; titles without a bracket stay whole."""
    priority = F.col("o_orderpriority")
    bracketed = F.concat(F.lit("[ "), F.substring_index(priority, "-", 1), F.lit("] "),
                         F.when(priority.contains("-"), F.substring(priority, 3, 100)).otherwise(""))
    title = text.split_title(F.when(F.col("o_orderstatus") == "P", priority).otherwise(bracketed))
    return t.orders.select("o_orderkey", title["bill_number"].alias("bill_number"), title["title"].alias("title"),
                           text.digits_only(priority).alias("digits"))


_LINE = "doc_id || ',' || lang || ',' || source || ',' || n_chars || ',' || replace(text, chr(10), ' ')"


@query(f"""SELECT doc_id, doc_id || ',' || lang || ',' || source || ',' || n_chars || ',' ||
  replace(replace(text, chr(10), ' '), ',', '') AS value, lang || ',' || source AS short_value FROM documents""")
def comma_repair(t):
    """Commas beyond the fourth separator out; lines with fewer fields untouched."""
    line = F.concat_ws(",", "doc_id", "lang", "source", "n_chars", text.flatten_lines(F.concat(F.lit("|"), F.col("text"))))
    repaired = F.replace(text.repair_commas(line), F.lit(",|"), F.lit(","))
    return spread(t.documents, "doc_id").select("doc_id", F.regexp_replace(repaired, "^$", "").alias("value"),
                              text.repair_commas(F.concat_ws(",", "lang", "source")).alias("short_value"))


@query(f"""SELECT doc_id, lang || '/' || source AS url, {content_clean('text')} AS content FROM documents""")
def url_cell_split(t):
    """`url,text` cells split at the first comma, the text cleaned."""
    cell = F.concat(F.lit(" "), F.concat_ws("/", "lang", "source"), F.lit(" ,"), F.col("text"))
    parts = text.split_url_cell(cell)
    return spread(t.documents, "doc_id").select("doc_id", parts["url"].alias("url"), parts["content"].alias("content"))


@query("""SELECT p_partkey, CASE WHEN p_size < 3 THEN '[]' WHEN p_size < 5 THEN '[]'
  ELSE '[' || replace(p_name, ' ', ', ') || ']' END AS cluster_keyword,
  CASE WHEN p_size < 3 THEN '법안, 개정, 정책, 시행' ELSE replace(p_name, ' ', ', ') END AS topic_label FROM part""")
def format_keywords(t):
    """Keyword labels without numbers, quotes and brackets; keyword lists as text."""
    raw = F.concat(F.lit(' 12  ("'), F.replace(F.col("p_name"), F.lit(" "), F.lit('",   "')), F.lit('") ,'))
    raw = F.when(F.col("p_size") < 3, F.lit(None)).when(F.col("p_size") < 5, ' 3 ("") ').otherwise(raw)
    words = F.when(F.col("p_size") < 3, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    return t.part.select("p_partkey", text.format_keywords(raw).alias("cluster_keyword"),
                         text.join_list(words).alias("topic_label"))


@query("""SELECT p_partkey, CASE WHEN contains(p_name, 'steel') THEN '세종'
    WHEN contains(p_name, 'widget') OR p_size < 5 THEN NULL ELSE split_part(p_name, ' ', 1) END AS sido,
  CASE WHEN contains(p_name, 'steel') THEN CASE WHEN p_size < 5 THEN replace(p_name, ' ', '') ELSE p_name END
    WHEN contains(p_name, 'widget') OR p_size < 5 THEN NULL ELSE split_part(p_name, ' ', 2) END AS sgg FROM part""")
def district_split(t):
    """District names cut in two; proportional seats and unspaced names have no parts."""
    name = F.when(F.col("p_size") < 5, F.replace(F.col("p_name"), F.lit(" "), F.lit(""))).otherwise(F.col("p_name"))
    parts = text.split_district(name, proportional="widget", special="steel")
    return t.part.select("p_partkey", parts["sido"].alias("sido"), parts["sgg"].alias("sgg"))


_SENTENCE = strip("translate(text, '→·|,', '')")


@query(f"""SELECT conv_id, turn, CASE WHEN {_SENTENCE} LIKE '%함' OR {_SENTENCE} LIKE '%요' THEN {_SENTENCE}
  ELSE {_SENTENCE} || '함' END AS summary FROM conversations""")
def sentence_form(t):
    """Summaries without bullet characters, closed the way all summaries are."""
    return t.conversations.select("conv_id", "turn", text.convert_to_sentence(F.col("text")).alias("summary"))


_FIRST_LINE = strip(f"split_part({strip('text')}, chr(10), 1)")


@query(f"""SELECT conv_id, turn, {_FIRST_LINE} AS slogan, length({_FIRST_LINE}) BETWEEN 7 AND 35 AS accepted FROM conversations""")
def slogan_clean(t):
    """First line of an answer without emphasis marks and label, and whether its length is accepted."""
    slogan = text.clean_slogan(F.concat(F.lit(" **카드뉴스 문구:** "), F.col("text")))
    return t.conversations.select("conv_id", "turn", slogan.alias("slogan"), F.length(slogan).between(7, 35).alias("accepted"))


@query(r"""SELECT event_id, CASE WHEN event_type = 'error' THEN '기타' ELSE event_type END AS category,
  CASE WHEN event_type = 'error' OR event_type = 'view' THEN '일반' ELSE 'k' || regexp_extract(props, '([0-9]+)', 1) END AS subcategory,
  CASE WHEN event_type = 'error' THEN 0.5 ELSE value END AS confidence,
  CASE WHEN event_type = 'click' THEN '법안|개정|정책|시행' ELSE event_type || '|b, c|d|e' END AS keywords FROM events""")
def json_extract(t):
    """JSON objects and arrays found inside prose, with defaults where none parses."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    answer = F.when(F.col("event_type") == "error", F.concat(F.lit('see {"category": '), F.col("props"))).when(
        F.col("event_type") == "view",
        F.format_string('ok\n{"category": "%s", "confidence": %s,\n "extra": %s}\nend', "event_type",
                        F.col("value").cast("string"), "props"),
    ).otherwise(F.format_string('```json\n{"category": "%s", "subcategory": "k%s", "confidence": %s}\n```',
                                "event_type", k, F.col("value").cast("string")))
    words = F.when(F.col("event_type") == "click", "no list here [1, 2]").otherwise(
        F.format_string('Keywords: ["%s" , "b, c",\n"d", "e", "f"] done ["g"]', "event_type"))
    parsed = jsons.classification(answer)
    return spread(t.events, "event_id").select(
        "event_id", parsed["category"].alias("category"), parsed["subcategory"].alias("subcategory"),
        parsed["confidence"].alias("confidence"), F.array_join(jsons.json_strings(words), "|").alias("keywords"))
