"""Long cells, bucketed tables, upserts, the ledger of landed pages and learnt compounds."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.registry import Tables, query
from plenary.operators import compounds, stored
from plenary.operators.aggregates import join_long_texts
from plenary.session import checkpoint_dir, input_bytes
from plenary.sources import landed, ledger, sinks


def _folder(t: Tables) -> str:
    return f"{checkpoint_dir(t.spark)}/stores-{uuid.uuid4().hex}"


_CELL = 1 << 16


@query(f"""WITH v AS (SELECT source, doc_id, text, CASE WHEN text IS NULL THEN 0 ELSE length(text) + 3 END AS w FROM documents WHERE source IS NOT NULL),
s AS (SELECT source, sum(w) AS size FROM v GROUP BY source),
p AS (SELECT v.*, CASE WHEN size <= {_CELL + 3} THEN 0 ELSE coalesce(sum(w) OVER (PARTITION BY v.source ORDER BY doc_id, text
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {_CELL} END AS part FROM v JOIN s ON v.source = s.source WHERE text IS NOT NULL OR size <= {_CELL + 3})
SELECT source, part::BIGINT AS part, coalesce(string_agg(text, ' / ' ORDER BY doc_id, text), '') AS content FROM p GROUP BY ALL""")
def long_cells(t):
    """All texts of a source in order, in numbered parts of 65,536 characters where they do not fit one."""
    return join_long_texts(t.documents.withColumnRenamed("text", "content"), "source", "content", "doc_id", _CELL)


@query("""WITH n AS (SELECT l_partkey, count(*) AS votes, count(*) FILTER (l_returnflag = 'R') AS against FROM lineitem GROUP BY ALL)
SELECT l_orderkey AS vote_no, l_linenumber AS seat, lineitem.l_partkey AS bill_id, p_name AS content, votes, against
FROM lineitem LEFT JOIN part ON lineitem.l_partkey = p_partkey LEFT JOIN n ON n.l_partkey = lineitem.l_partkey""")
def bucketed_votes(t):
    """Votes with their bill's text and counts from tables bucketed alike by bill."""
    votes = t.lineitem.select(F.col("l_partkey").alias("bill_id"), F.col("l_orderkey").alias("vote_no"), F.col("l_linenumber").alias("seat"),
                              F.col("l_returnflag").alias("result"))
    counts = votes.groupBy("bill_id").agg(F.count(F.lit(1)).alias("votes"), F.count_if(F.col("result") == "R").alias("against"))
    texts = t.part.select(F.col("p_partkey").alias("bill_id"), F.col("p_name").alias("content"))
    mark = uuid.uuid4().hex
    tables = stored.store_together({f"votes_{mark}": votes.drop("result"), f"texts_{mark}": texts, f"counts_{mark}": counts},
                                   _folder(t), "bill_id", stored.bucket_count(input_bytes(votes)))
    votes, texts, counts = tables.values()
    even = votes.even.join(texts.even, "bill_id", "left").join(counts.even, "bill_id", "left")
    return even.unionByName(votes.hot.join(texts.hot, "bill_id", "left").join(counts.hot, "bill_id", "left"))


@query("""SELECT o_orderkey AS bill_id, CASE WHEN o_custkey % 10 = 0 AND o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END AS term,
  CASE WHEN o_custkey % 10 = 0 AND o_orderstatus = 'F' THEN 'moved' ELSE o_orderpriority END AS content
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT -o_orderkey, 'new', 'added' FROM orders WHERE o_custkey % 10 = 1""")
def upserted_table(t):
    """A table by term after rows have moved from one term to another, a term has come, and one has been removed."""
    path = _folder(t)
    rows = t.orders.select(F.col("o_orderkey").alias("bill_id"), F.col("o_orderpriority").alias("content"), F.col("o_orderstatus").alias("term"))
    sinks.write_by_value(rows, path, "term")
    moved = t.orders.where("o_custkey % 10 = 0 AND o_orderstatus = 'F'").select(F.col("o_orderkey").alias("bill_id"), F.lit("moved").alias("content"), F.lit("O").alias("term"))
    added = t.orders.where("o_custkey % 10 = 1").select((-F.col("o_orderkey")).alias("bill_id"), F.lit("added").alias("content"), F.lit("new").alias("term"))
    sinks.upsert(t.spark, path, moved.unionByName(added), "bill_id", "term", rows.where("term = 'P'").select("bill_id"))
    return t.spark.read.schema(rows.schema).parquet(path)


@query("""WITH p AS (SELECT o_custkey % 5 + 18 AS term, o_orderpriority = '1-URGENT' AND o_custkey % 5 = 2 AS bad FROM orders)
SELECT 'BILLRCP' AS service, term::INT AS term, count(*)::BIGINT AS pages, count(*) FILTER (NOT bad)::BIGINT AS parsed_pages,
  count(*) FILTER (NOT bad)::BIGINT AS landed_rows, any_value(s.n)::INT AS stated_rows,
  count(*) FILTER (NOT bad) = count(*) AND count(*) FILTER (NOT bad) >= any_value(s.n) AS complete
FROM p JOIN (SELECT o_custkey % 5 + 18 AS term, count(*) + CASE WHEN o_custkey % 5 = 4 THEN 1 ELSE 0 END AS n FROM orders GROUP BY o_custkey % 5) s USING (term) GROUP BY term""")
def landed_ledger(t):
    """What has landed per term, by a ledger filled in two runs of which the second reads new files only."""
    folder, book = _folder(t), _folder(t)
    term = F.col("o_custkey") % 5
    stated = t.orders.groupBy(term.alias("t")).agg((F.count(F.lit(1)) + F.when(F.col("t") == 4, 1).otherwise(0)).alias("n"))
    page = F.concat(F.lit('{"BILLRCP":[{"head":[{"list_total_count":'), F.col("n").cast("string"), F.lit('}]},{"row":[{"BILL_ID":"'),
                    F.col("o_orderkey").cast("string"), F.lit('"}]}]}'))
    body = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("t") == 2), F.lit("<html>busy")).otherwise(page)
    pages = t.orders.withColumn("t", term).join(stated, "t").select(body.alias("value"), F.col("t"), F.col("o_orderkey"))
    for half in (0, 1):
        for n in range(5):
            pages.where((F.col("t") == n) & (F.col("o_orderkey") % 2 == half)).select("value").write.text(f"{folder}/bills/{half}-{n}")
        rows = ledger.read_new_pages(t.spark, folder, ledger.read_ledger(t.spark, book))
        named = ledger.ledger_rows(rows, landed.BILL_SERVICE)
        place = F.element_at(F.split("file", "/"), -2)
        ledger.enter(named.withColumn("term", F.regexp_extract(place, r"-(\d)", 1).cast("int") + 18), book)
    return ledger.set_report(ledger.read_ledger(t.spark, book)).drop("files", "row_pages")


@query()
def learnt_compounds(t):
    """Words of all documents that frequent words fill better than they are found themselves, and their cut."""
    return compounds.learnt_splits(compounds.word_counts(t.documents, "text"))


@query()
def spaced_texts(t):
    """All documents with their learnt compounds spaced."""
    splits = compounds.learnt_splits(compounds.word_counts(t.documents, "text"))
    return compounds.space_compounds(t.documents.select("doc_id", F.col("text").alias("content")), splits)
