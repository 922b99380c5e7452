"""Whole jobs on the test tables: landed JSON, one term's votes with text, and the backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindings.registry import Tables, query
from bindings.sqltext import article_text, content_clean, strip, tidy
from bindings.tables import extract_number, matched
from bindings.texts import _LAW
from plenary.plans import backfill, bills
from plenary.session import spread
from plenary.sources import landed
from plenary.sources.landed import vote_rows


def _text(name: str):
    return F.col(name).cast("string")


def _vote_pages(t: Tables) -> DataFrame:
    """One landed page per order; orders in work have an error page without rows, some cells a text."""
    cell = F.concat(F.lit("page/"), _text("o_custkey"), F.when(
        F.col("o_custkey") % 7 == 0, F.concat(F.lit(", note "), _text("o_orderstatus"))).otherwise(""))
    row = F.format_string(
        '{"AGE":"22","MONA_CD":"M%s","BILL_NAME":"%s","BILL_NO":"%s","BILL_ID":"PRC_%s","RESULT_VOTE_MOD":"%s",'
        '"VOTE_DATE":"%s","BILL_URL":"%s","SEQ":%s}',
        _text("o_orderkey"), "o_orderpriority", F.lpad(_text("o_custkey"), 7, "0"), _text("o_custkey"), "o_orderstatus",
        F.date_format("o_orderdate", "yyyyMMdd HHmmss"), cell, _text("o_orderkey"))
    page = F.concat(F.lit('{"nojepdqqaweusdfbi":[{"head":[{"list_total_count":1}]},{"row":['), row, F.lit("]}]}"))
    error = F.lit('{"RESULT":{"CODE":"INFO-200","MESSAGE":"none"}}')
    orders = spread(t.orders, "o_orderkey")
    return orders.select(F.when(F.col("o_orderpriority") == "5-LOW", error).otherwise(page).alias("body"))


_LANDED = """SELECT '22' AS "AGE", 'M' || o_orderkey AS "MONA_CD", o_orderpriority AS "BILL_NAME",
  lpad(o_custkey::VARCHAR, 7, '0') AS "BILL_NO", 'PRC_' || o_custkey AS "BILL_ID", o_orderstatus AS "RESULT_VOTE_MOD",
  strftime(o_orderdate, '%Y%m%d %H%M%S') AS "VOTE_DATE", 'page/' || o_custkey || CASE WHEN o_custkey % 7 = 0 THEN ', note ' || o_orderstatus ELSE '' END AS "BILL_URL"
FROM orders WHERE o_orderpriority <> '5-LOW'"""


@query(_LANDED)
def landed_votes(t):
    """Vote rows of landed JSON pages; error pages give none."""
    return vote_rows(_vote_pages(t))


@query("""SELECT DISTINCT 'PRC_' || o_custkey AS bill_id FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def landed_passed_ids(t):
    """Ids of passed bills from landed JSON pages."""
    result = F.when(F.col("o_orderstatus") == "F", "원안가결").when(F.col("o_orderstatus") == "O", "수정가결").otherwise("폐기")
    body = F.concat(
        F.lit('{"BILLRCP":[{"head":[{"list_total_count":2}]},{"row":[{"PROC_RSLT":"원안가결"},{"BILL_ID":"PRC_'),
        _text("o_custkey"), F.lit('","PROC_RSLT":"'), result, F.lit('"}]}]}'))
    return bills.passed_ids(t.orders.select(body.alias("body")))


@query("""SELECT count(*) AS pages, count(*) FILTER (o_orderpriority <> '1-URGENT') AS parsed_pages,
  count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '5-LOW')) AS row_pages,
  count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '5-LOW'))::BIGINT AS landed_rows, count(*)::INT AS stated_rows FROM orders""")
def landed_report(t):
    """Pages that parse, rows landed and rows stated, before anything is read from the pages."""
    head = F.lit('{"BILLRCP":[{"head":[{"list_total_count":%d}]}' % t.orders.count())
    full = F.concat(head, F.lit(',{"row":[{"BILL_ID":"'), _text("o_orderkey"), F.lit('"}]}]}'))
    body = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("<html>busy")).when(
        F.col("o_orderpriority") == "5-LOW", F.concat(head, F.lit("]}"))).otherwise(full)
    return landed.page_report(t.orders.select(body.alias("body")), landed.BILL_SERVICE)


def _fetches(t: Tables) -> DataFrame:
    """Pages whose article stands for the content block, fetched at the second attempt."""
    html = F.replace(F.replace(F.col("html"), F.lit("<article>"), F.lit('<div id="summaryContentDiv" class="textType02">')),
                     F.lit("</article>"), F.lit("</div>"))
    url = F.concat(F.lit("page/"), _text("page_id"))
    null = F.lit(None).cast("string")
    pages = spread(t.pages, "page_id")
    return pages.select(url.alias("url"), F.lit(1).alias("attempt"), null.alias("html"), F.lit("timeout").alias("error")).unionByName(
        pages.select(url.alias("url"), F.lit(2).alias("attempt"), html.alias("html"), null.alias("error")))


def _responses(t: Tables) -> DataFrame:
    return t.conversations.where("role = 'assistant'").select(
        F.concat(F.lit("PRC_"), _text("conv_id")).alias("item_id"), F.col("turn").cast("int").alias("attempt"), "text",
        F.lit(None).cast("string").alias("error"))


_CLEANED = tidy(f"regexp_replace(content, '{_LAW}', ' ', 'g')")


@query(f"""WITH v AS ({_LANDED}), t AS (SELECT 'page/' || page_id AS url, {content_clean(article_text('html'))} AS content FROM pages
  UNION ALL SELECT DISTINCT split_part("BILL_URL", ',', 1), {strip("split_part(\"BILL_URL\", ',', 2)")} FROM v WHERE "BILL_URL" LIKE '%,%'),
p AS (SELECT url, string_agg(content, ' / ' ORDER BY content) AS content FROM t GROUP BY url),
b AS (SELECT 'PRC_' || substr(url, 6) AS bill_id, url, {_CLEANED} AS cleaned FROM p),
a AS (SELECT 'PRC_' || conv_id AS bill_id, turn, {strip('text')} AS answer FROM conversations WHERE role = 'assistant'),
s AS (SELECT bill_id, arg_min(answer, turn) AS answer FROM a WHERE answer <> '' GROUP BY bill_id),
l AS (SELECT bill_id, turn, {strip("split_part(answer, chr(10), 1)")} AS line FROM a),
c AS (SELECT bill_id, arg_min(line, turn) AS line FROM l WHERE length(line) BETWEEN 7 AND 35 GROUP BY bill_id),
done AS (SELECT b.*, CASE WHEN cleaned = '' OR answer IS NULL THEN cleaned ELSE answer END AS raw, answer, line
  FROM b LEFT JOIN s USING (bill_id) LEFT JOIN c USING (bill_id)),
final AS (SELECT bill_id, url, cleaned, CASE WHEN cleaned = '' OR answer IS NULL THEN cleaned
  ELSE {strip("translate(answer, '→·|,', '')")} || '함' END AS summary, line FROM done)
SELECT "AGE" AS age, "MONA_CD" AS member_id, "BILL_NAME" AS title, "BILL_NO" AS bill_number, v."BILL_ID" AS bill_id,
  "RESULT_VOTE_MOD" AS result, strptime("VOTE_DATE", '%Y%m%d %H%M%S')::DATE AS date, f.url, cleaned, summary,
  CASE WHEN summary = '' THEN '내용 없음' ELSE coalesce(line, '더 나은 사회를 위한 변화!') END AS card_news_content
FROM v JOIN final f ON f.url = split_part(v."BILL_URL", ',', 1)""")
def term_assembly(t):
    """One term from landed votes, pages and texts in page cells to votes with cleaned text, summary and slogan."""
    answers = _responses(t)
    return bills.assemble_term(vote_rows(_vote_pages(t)), _fetches(t), answers, answers)["05_final"]


@query(f"""WITH {matched("c_name || ' ' || c_mktsegment")},
m AS (SELECT age, title, bill_id, bill_number, content FROM matched
  UNION ALL SELECT 99, p_name, 'P' || p_partkey, p_partkey::VARCHAR, CASE WHEN p_size > 40 THEN p_type END FROM part),
f AS (SELECT p_partkey::VARCHAR AS bill_number, min(l_returnflag || l_linestatus) AS fill FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE p_size > 20 GROUP BY ALL)
SELECT age, title, bill_id, bill_number, coalesce(fill, content) AS content FROM m LEFT JOIN f USING (bill_number)
WHERE coalesce(fill, content) IS NOT NULL""")
def backfill_bills(t):
    """Titles and extracts merged, put together with published bills, filled by number and cleaned."""
    titles = spread(t.orders, "o_orderkey").select(
        (F.col("o_orderkey") % 2).cast("int").alias("age"),
        F.concat(F.lit("http://x/y?a=1&billId=PRC%5F"), _text("o_orderkey")).alias("url"),
        F.concat(F.lit("["), F.lpad(_text("o_orderkey"), 7, "0"), F.lit("] "), F.col("o_orderpriority")).alias("bill_title"))
    extracts = t.customer.select(
        (extract_number() % 2).cast("int").alias("age"), extract_number().cast("string").alias("bill_number"),
        F.col("c_name").alias("reason"), F.col("c_mktsegment").alias("main"))
    published = t.part.select(
        F.lit(99).alias("age"), F.col("p_name").alias("title"), F.concat(F.lit("P"), _text("p_partkey")).alias("bill_id"),
        _text("p_partkey").alias("bill_number"), F.when(F.col("p_size") > 40, F.col("p_type")).alias("content"))
    fills = t.lineitem.join(t.part.where("p_size > 20"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").alias("bill_number"), F.concat("l_returnflag", "l_linestatus").alias("content"))
    merged = backfill.merged_bills(backfill.recovered_bills(titles, extracts), published)
    return backfill.filled_bills(merged, fills)


@query("""SELECT doc_id AS bill_id, CASE WHEN quality IS NULL THEN '[]' ELSE '[' || source || ', ' || quality || ']' END AS cluster_keyword,
  toxic AS cluster, d.lang AS title, 22 AS age, doc_id::VARCHAR AS bill_number, CASE WHEN quality IS NOT NULL THEN d.lang END AS cleaned, url AS summary
FROM documents d LEFT JOIN labels USING (doc_id) LEFT JOIN pages ON page_id = doc_id""")
def enriched_bills(t):
    """Bills with cleaned text, summary, cluster and formatted keywords."""
    docs = t.documents.select(F.lit(22).alias("age"), F.col("lang").alias("title"), F.col("doc_id").alias("bill_id"),
                              _text("doc_id").alias("bill_number"))
    topics = t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id").select(
        F.col("doc_id").alias("bill_id"), F.col("toxic").alias("topic"),
        F.format_string('12 ("%s",  "%s")', "source", _text("quality")).alias("topic_label"), F.col("lang").alias("content"))
    summaries = t.pages.select(F.col("page_id").alias("bill_id"), F.col("url").alias("content"))
    return backfill.enriched_bills(docs, topics, summaries)


@query(f"""SELECT '22' AS age, 'M' || o_orderkey AS member_id, o_orderpriority AS "BILL_NAME",
  lpad(o_custkey::VARCHAR, 7, '0') AS bill_number, o_orderstatus AS result, strftime(o_orderdate, '%Y-%m-%d') AS date,
  'page/' || o_custkey || CASE WHEN o_custkey % 7 = 0 THEN ', note ' || o_orderstatus ELSE '' END AS "BILL_URL" FROM orders WHERE o_orderpriority <> '5-LOW'""")
def published_votes(t):
    """The published vote table, dates as text."""
    return backfill.vote_table(vote_rows(_vote_pages(t)))
