"""First acceptable answers: conversations stand for response and fetch attempts, events for extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindings.registry import Tables, query
from bindings.sqltext import content_clean, strip, tidy
from plenary.operators import prompts, responses
from plenary.operators.centrality import central_sentence_answers
from plenary.operators.keywords import keyword_label, keywords_from_responses
from plenary.operators.responses import extracted_fields, fetched_content
from plenary.operators.topics import classify
from plenary.session import spread


def _attempts(t: Tables) -> DataFrame:
    """Assistant turns as attempts; every fourth conversation's second turns failed."""
    failed = F.when((F.col("conv_id") % 4 == 0) & (F.col("turn") % 4 == 1), "429")
    return t.conversations.where("role = 'assistant'").select(
        F.col("conv_id").cast("string").alias("item_id"), F.col("turn").cast("int").alias("attempt"), "text",
        failed.alias("error"))


def _items(t: Tables) -> DataFrame:
    """One bill per conversation with its opening turn as text; a system opening leaves it empty."""
    opening = F.min_by(F.when(F.col("role") == "system", "").otherwise(F.col("text")), "turn")
    return t.conversations.groupBy(F.col("conv_id").cast("string").alias("bill_id")).agg(opening.alias("content"))


_ANSWERS = f"""items AS (SELECT conv_id, arg_min(CASE WHEN role = 'system' THEN '' ELSE text END, turn) AS content
  FROM conversations GROUP BY conv_id),
ok AS (SELECT conv_id, turn, {strip('text')} AS answer FROM conversations
  WHERE role = 'assistant' AND NOT (conv_id % 4 = 0 AND turn % 4 = 1)),
sums AS (SELECT conv_id, arg_min(answer, turn) AS answer FROM ok WHERE answer <> '' GROUP BY conv_id),
bills AS (SELECT i.conv_id, i.content, CASE WHEN i.content = '' THEN '' WHEN answer IS NULL THEN i.content
  ELSE {strip("translate(answer, '→·|,', '')")} || '함' END AS summary FROM items i LEFT JOIN sums USING (conv_id)),
lines AS (SELECT conv_id, turn, {strip("split_part(answer, chr(10), 1)")} AS line FROM ok),
slogans AS (SELECT conv_id, arg_min(line, turn) AS line FROM lines WHERE length(line) BETWEEN 7 AND 35 GROUP BY conv_id)"""


@query(f"""WITH {_ANSWERS} SELECT b.conv_id::VARCHAR AS bill_id, content, summary,
  CASE WHEN summary = '' THEN '내용 없음' ELSE coalesce(line, '더 나은 사회를 위한 변화!') END AS card_news_content
FROM bills b LEFT JOIN slogans USING (conv_id)""")
def first_valid_attempt(t):
    """Summary and slogan per bill: the first accepted attempt, else the fallback."""
    attempts = _attempts(t)
    return responses.slogans(responses.summaries(_items(t), attempts), attempts)


_TIDY = tidy("text")
_FIRST = f"CASE WHEN regexp_matches({_TIDY}, '^.*?[.!?。]( |$)') THEN regexp_extract({_TIDY}, '^(.*?[.!?。])(?: |$)', 1) ELSE {_TIDY} END"
_BARE = strip(f"rtrim({_FIRST}, '.!?。')")
_CLOSED = strip(f"translate({_BARE}, '→·|,', '')")


@query(f"""SELECT doc_id AS bill_id, CASE WHEN {_TIDY} = '' OR {_BARE} = '' THEN text WHEN {_CLOSED} LIKE '%함' OR {_CLOSED} LIKE '%요' THEN {_CLOSED}
  ELSE {_CLOSED} || '함' END AS summary FROM documents""")
def first_sentence_summary(t):
    """Summaries without a model: the first sentence of each text in the closing form."""
    docs = spread(t.documents, "doc_id").select(F.col("doc_id").alias("bill_id"), F.col("text").alias("content"))
    return responses.summaries(docs, responses.first_sentence_answers(docs)).select("bill_id", "summary")


@query(f"""WITH f AS (SELECT 'conv/' || conv_id AS url, turn, text,
    CASE WHEN role = 'user' THEN 'HTTP ' || length(text) END AS error FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY error IS NOT NULL,
    CASE WHEN error IS NULL THEN turn END, turn DESC) AS rn FROM f)
SELECT url, CASE WHEN error IS NULL THEN {content_clean('text')} ELSE 'ERROR: ' || error END AS content,
  error IS NOT NULL AS is_error FROM r WHERE rn = 1""")
def fetch_outcome(t):
    """Page text of the first successful fetch, else the last error."""
    failed = F.col("role") == "user"
    page = F.concat(F.lit('<div id="summaryContentDiv" class="textType02"><p>'), F.col("text"), F.lit("</p></div>"))
    fetches = t.conversations.select(
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("url"), F.col("turn").cast("int").alias("attempt"),
        F.when(~failed, page).alias("html"),
        F.when(failed, F.concat(F.lit("HTTP "), F.length("text").cast("string"))).alias("error"))
    return fetched_content(fetches)


@query("""SELECT event_id || '.pdf' AS file_name,
  CASE WHEN event_type = 'signup' THEN '' ELSE regexp_extract(props, '([0-9]+)', 1) END AS bill_number,
  event_type || ' on ' || user_id AS reason, CASE WHEN event_type = 'click' THEN '' ELSE 'main text' END AS main
FROM events WHERE event_type NOT IN ('error', 'view')""")
def field_extract(t):
    """Bill number, reason and main content parsed from answers; empty answers are dropped."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    full = F.format_string(
        'Result: {"bill_no": "%s", "reason": " %s\\non %s ", "main": "%s"} end',
        F.when(F.col("event_type") == "signup", "none").otherwise(F.concat(F.lit("No. "), k)), "event_type",
        F.col("user_id").cast("string"), F.when(F.col("event_type") == "click", "").otherwise("main text"))
    answer = F.when(F.col("event_type") == "error", '{"bill_no": "", "reason": "", "main": ""}').when(
        F.col("event_type") == "view", F.concat(F.lit('{"bill_no": '), k)).otherwise(full)
    rows = spread(t.events, "event_id").select(F.concat(F.col("event_id").cast("string"), F.lit(".pdf")).alias("item_id"),
                           F.lit(1).alias("attempt"), answer.alias("text"), F.lit(None).cast("string").alias("error"))
    return extracted_fields(rows)


@query("""WITH p AS (SELECT *, greatest(ceil(length(text) / 3000.0)::INT, 1) AS parts FROM documents),
c AS (SELECT *, unnest(range(0, parts))::INT AS part FROM p)
SELECT doc_id::VARCHAR AS item_id, part, parts, '법안을 주제 분류 하나로 나누세요. 목록에 없으면 새 분류를 쓰세요.
분류: 교육정책, 보건의료, 경제금융, 환경에너지, 사회복지, 국방안보, 법무사법, 행정안전, 과학기술, 문화체육, 농림수산, 국토교통, 외교통일, 디지털정보통신, 출입국관리, 기타
제목: ' || source || '
내용: ' || substr(text, part * 3000 + 1, 3000) || '
답: {"category": "분류", "subcategory": "세부", "confidence": 0.9}' AS prompt FROM c""")
def prompt_table(t):
    """Classification requests over whole texts, long ones in parts."""
    docs = spread(t.documents, "doc_id")
    return prompts.prompt_parts(docs, "doc_id", "text", prompts.CLASSIFY_CHARS, lambda part: prompts.classify_prompt(F.col("source"), part))


@query("""SELECT doc_id::VARCHAR AS item_id, '핵심 조치와 이유를 한 문장으로 요약하고 ''함''으로 끝내세요. → · | , 는 쓰지 마세요.
내용: ' || text || '
요약: ' AS prompt FROM documents""")
def summary_prompts(t):
    """Summary prompts over whole texts."""
    return prompts.prompt_table(t.documents, "doc_id", prompts.summary_prompt(F.col("text")))


@query("""SELECT lang AS item_id, '이 핵심어들에 어울리는 한국어 별명을 하나 지어 주세요.
핵심어: ' || string_agg(DISTINCT source, ', ' ORDER BY source) || '
별명: ' AS prompt FROM documents GROUP BY lang""")
def nickname_prompt(t):
    """Nickname prompts from keyword labels."""
    labels = t.documents.select("lang", "source").distinct().groupBy("lang").agg(
        F.array_join(F.array_sort(F.collect_list("source")), ", ").alias("keywords"))
    return prompts.prompt_table(labels, "lang", prompts.nickname_prompt(F.col("keywords")))


@query(f"""WITH one AS (SELECT conv_id, arg_min({strip('text')}, turn) AS nickname FROM conversations
  WHERE role = 'assistant' AND NOT (conv_id % 4 = 0 AND turn % 4 = 1) AND {strip('text')} <> '' GROUP BY conv_id)
SELECT DISTINCT c.conv_id AS topic, nickname FROM conversations c LEFT JOIN one USING (conv_id)""")
def topic_nicknames(t):
    """The first usable nickname of each topic, null without one."""
    topics = t.conversations.select(F.col("conv_id").alias("topic")).distinct()
    return responses.nicknames(topics, _attempts(t))


@query(f"""WITH ok AS (SELECT conv_id, turn, {tidy('text')} AS answer FROM conversations
  WHERE role = 'assistant' AND NOT (conv_id % 4 = 0 AND turn % 4 = 1)),
a AS (SELECT conv_id, arg_min(answer, turn) AS answer FROM ok WHERE answer <> '' GROUP BY conv_id)
SELECT doc_id AS bill_id, CASE WHEN {strip('text')} = '' THEN text ELSE coalesce(answer, text) END AS content
FROM documents LEFT JOIN a ON doc_id = conv_id""")
def stop_word_answers(t):
    """Texts replaced by the first usable stop-word answer, the text itself without one."""
    bills = t.documents.select(F.col("doc_id").cast("string").alias("bill_id"), F.col("text").alias("content"))
    cleaned = responses.cleaned_texts(bills, _attempts(t))
    return cleaned.select(F.col("bill_id").cast("bigint").alias("bill_id"), "content")


@query(f"""WITH p AS (SELECT doc_id, text, unnest(range(0, greatest(ceil(length(text) / 3000.0)::INT, 1)))::INT AS part FROM documents),
c AS (SELECT *, substr(text, part * 3000 + 1, 3000) AS piece, (doc_id + part) % 3 = 0 AS own FROM p),
b AS (SELECT *, lag(own) OVER (PARTITION BY doc_id ORDER BY part) AS before FROM c)
SELECT doc_id AS bill_id, CASE WHEN {strip('text')} = '' THEN text ELSE string_agg(
  CASE WHEN part = 0 OR own AND before THEN '' ELSE ' ' END || CASE WHEN own THEN piece ELSE 'part ' || part || ' of ' || length(piece) END,
  '' ORDER BY part) END AS content FROM b GROUP BY doc_id, text""")
def stop_word_parts(t):
    """Whole texts from the stop-word answers to their parts; every third part has none and keeps its text."""
    bills = spread(t.documents, "doc_id").select(F.col("doc_id").alias("bill_id"), F.col("text").alias("content"))
    pieces = prompts.prompt_parts(bills, "bill_id", "content", prompts.CLASSIFY_CHARS, F.length)
    reply = F.concat(F.lit(" part  "), F.col("part").cast("string"), F.lit(" of "), F.col("prompt").cast("string"))
    failed = F.when((F.col("item_id").cast("bigint") + F.col("part")) % 3 == 0, "429")
    tried = pieces.select("item_id", "part", F.lit(1).alias("attempt"), reply.alias("text"), failed.alias("error"))
    cleaned = responses.cleaned_parts(bills.withColumn("bill_id", F.col("bill_id").cast("string")), tried, prompts.CLASSIFY_CHARS)
    return cleaned.select(F.col("bill_id").cast("bigint").alias("bill_id"), "content")


@query("""SELECT lang || '_' || source AS item_id, ((rn - 1) // 15)::INT AS part, '같은 분류의 법안을 비슷한 것끼리 묶고 번호로 답하세요.
분류: ' || lang || '_' || source || '
' || string_agg(rn || '. ' || text, chr(10) ORDER BY rn) || '
답: {"groups": [{"name": "묶음", "bills": [1, 2]}]}' AS prompt
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rn FROM documents) GROUP BY lang, source, part""")
def grouping_prompts(t):
    """Grouping requests: every title of every class, some per request."""
    docs = t.documents.select("doc_id", F.concat_ws("_", "lang", "source").alias("topic"), F.col("text").alias("title"))
    pages = prompts.numbered_titles(docs, "topic", "doc_id")
    return pages.select(F.col("topic").alias("item_id"), F.col("page").alias("part"),
                        prompts.grouping_prompt(F.col("topic"), F.col("titles")).alias("prompt"))


_PARTS = """p AS (SELECT doc_id, source, text, unnest(range(0, greatest(ceil(length(text) / 3000.0)::INT, 1)))::INT AS part FROM documents),
c AS (SELECT *, length(substr(text, part * 3000 + 1, 3000)) AS n, (doc_id + part) % 3 = 0 AS failed FROM p)"""


def _part_answers(t: Tables, answer) -> DataFrame:
    """An answer for each part of each text, `answer(part number, part length)`; every third one failed."""
    docs = spread(t.documents, "doc_id")
    pieces = prompts.prompt_parts(docs, "doc_id", "text", prompts.CLASSIFY_CHARS, F.length)
    failed = F.when((F.col("item_id").cast("bigint") + F.col("part")) % 3 == 0, "429")
    return pieces.select("item_id", "part", F.lit(1).alias("attempt"), answer(F.col("part").cast("string"), F.col("prompt").cast("string")).alias("text"), failed.alias("error"))


@query(f"""WITH {_PARTS},
w AS (SELECT doc_id, part, 0 AS k, 'part' || part // 2 AS word FROM c WHERE NOT failed UNION ALL SELECT doc_id, part, 1, 'of' || n FROM c WHERE NOT failed),
f AS (SELECT doc_id, word, min(part * 2 + k) AS pl FROM w GROUP BY doc_id, word),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pl) AS rn FROM f)
SELECT doc_id, coalesce(string_agg(word, ', ' ORDER BY rn) FILTER (rn <= 4), '법안, 개정, 정책, 시행') AS keywords
FROM documents LEFT JOIN r USING (doc_id) GROUP BY doc_id""")
def keyword_part_answers(t):
    """Keywords of long texts from the answers to all their parts, the default ones where every part failed."""
    half = lambda part: F.floor(part.cast("int") / 2).cast("string")
    tried = _part_answers(t, lambda part, n: F.concat(F.lit('Keys: ["part'), half(part), F.lit('", "of'), n, F.lit('"]')))
    found = keywords_from_responses(t.documents.select("doc_id"), tried, "doc_id")
    return found.select("doc_id", keyword_label(F.col("keywords")).alias("keywords"))


@query(f"""WITH {_PARTS}
SELECT doc_id::VARCHAR AS file_name, coalesce(arg_min(n::VARCHAR, part) FILTER (part > 0), '') AS bill_number,
  string_agg('why ' || part, ' ' ORDER BY part) AS reason, coalesce(string_agg('what ' || n || ' ' || part, ' ' ORDER BY part) FILTER (part > 0), '') AS main
FROM c WHERE NOT failed GROUP BY doc_id""")
def field_part_answers(t):
    """Number, reason and main content of long texts from the answers to all their parts."""
    later = lambda part, value: F.when(part == "0", "").otherwise(value)
    tried = _part_answers(t, lambda part, n: F.format_string(
        '{"bill_no": "%s", "reason": "why %s", "main": "%s"}', later(part, n), part, later(part, F.concat_ws(" ", F.lit("what"), n, part))))
    return extracted_fields(tried)


@query(f"""WITH {_PARTS}, s AS (SELECT *, round(0.5 + n / 10000.0, 4) AS sure FROM c WHERE NOT failed),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sure DESC, part) AS rn FROM s)
SELECT documents.doc_id, coalesce(b.source, '기타') AS category, coalesce('part ' || part, '일반') AS subcategory, coalesce(sure, 0.5)::DOUBLE AS confidence
FROM documents LEFT JOIN b ON b.doc_id = documents.doc_id AND rn = 1""")
def class_part_answers(t):
    """The class of a long text is the most confident answer to any of its parts."""
    docs = t.documents.select("doc_id", F.col("source").alias("_source"))
    tried = _part_answers(t, lambda part, n: F.concat_ws("|", part, n))
    named = tried.join(docs.select(F.col("doc_id").cast("string").alias("item_id"), "_source"), "item_id")
    cut = F.split("text", r"\|")
    sure = F.round(0.5 + cut[1].cast("int") / 10000, 4)
    answer = F.concat(F.lit('{"category": "'), F.col("_source"), F.lit('", "subcategory": "part '), cut[0], F.lit('", "confidence": '), sure.cast("string"), F.lit("}"))
    return classify(docs.select("doc_id"), named.withColumn("text", answer).drop("_source"), "doc_id")


@query()
def central_sentence_summary(t):
    """Summaries without a model: the most central sentence of each text in the closing form."""
    docs = spread(t.documents, "doc_id").select(F.col("doc_id").alias("bill_id"), F.col("text").alias("content"))
    named = docs.withColumn("bill_id", F.col("bill_id").cast("string"))
    return responses.summaries(named, central_sentence_answers(named)).select(F.col("bill_id").cast("bigint").alias("bill_id"), "summary")
