"""Sinks and scans on whole tables: each query writes a table and reads the files back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from bindings.registry import Tables, query
from plenary.functions.html import is_pdf
from plenary.operators.index import materialize
from plenary.operators.project import require_columns
from plenary.plans.backfill import repaired_lines
from plenary.sources import sinks, tables
from plenary.session import checkpoint_dir


def _folder(t: Tables) -> str:
    return f"{checkpoint_dir(t.spark)}/files-{uuid.uuid4().hex}"


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@query("""SELECT lpad(c_custkey::VARCHAR, 7, '0') AS bill_number, c_name AS title,
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment || ', "x"' END AS content FROM customer""")
def csv_sink_scan(t):
    """A published CSV file read back with string keys: zeros, quotes, commas and nulls survive."""
    path = _folder(t)
    rows = t.customer.select(
        F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("bill_number"), F.col("c_name").alias("title"),
        F.when(F.col("c_acctbal") >= 0, F.concat("c_mktsegment", F.lit(', "x"'))).alias("content"))
    sinks.write_csv(rows, path)
    return tables.read_csv(t.spark, path, _texts("bill_number", "title", "content"))


@query("SELECT doc_id::VARCHAR AS bill_id, text AS content FROM documents")
def csv_text_scan(t):
    """Whole texts with line ends, quotes and commas through a CSV file."""
    path = _folder(t)
    sinks.write_csv(t.documents.select(F.col("doc_id").cast("string").alias("bill_id"), F.col("text").alias("content")), path)
    return tables.read_csv(t.spark, path, _texts("bill_id", "content"))


@query("""SELECT p_partkey || ',' || CASE WHEN p_size > 25 THEN p_name ELSE 'NULL' END AS value FROM part""")
def csv_null_text(t):
    """Lines of a CSV file whose nulls are spelled out."""
    path = _folder(t)
    rows = t.part.select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_name")).alias("name"))
    sinks.write_csv(rows, path, null_as="NULL")
    return tables.read_lines(t.spark, path).where("value <> 'p_partkey,name'")


@query('''SELECT '"' || p_partkey || '","' || p_name || ' ""' || p_brand || '"""' AS value FROM part''')
def csv_quoted_lines(t):
    """Lines of a CSV file with every field quoted."""
    path = _folder(t)
    sinks.write_csv(t.part.select("p_partkey", F.concat("p_name", F.lit(' "'), "p_brand", F.lit('"')).alias("name")),
                    path, quote_all=True)
    return tables.read_lines(t.spark, path).where(F.col("value") != '"p_partkey","name"')


@query(r"""SELECT doc_id || ',' || replace(replace(replace(text, chr(10), ' '), '\', '\\'), ',', '\,') AS value FROM documents""")
def csv_unquoted_lines(t):
    """Lines of an unquoted CSV file: separators and escapes are escaped."""
    path = _folder(t)
    sinks.write_unquoted(t.documents.select("doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit(" ")).alias("content")), path)
    return tables.read_lines(t.spark, path).where("value <> 'doc_id,content'")


@query("""SELECT p_partkey::VARCHAR AS id, CASE WHEN p_size < 5 THEN NULL ELSE p_name END AS name,
  CASE WHEN p_size < 10 THEN NULL ELSE p_brand || ',"' END AS brand FROM part WHERE p_size <= 40""")
def csv_lenient_scan(t):
    """Rows with too many fields are dropped, rows with too few are padded."""
    return tables.read_csv_lenient(t.spark, _lenient_file(t), _texts("id", "name", "brand"))


@query('''SELECT p_partkey || ',' || p_name || ',"' || p_brand || ',""",surplus' AS row, 4 AS fields FROM part WHERE p_size > 40''')
def csv_rejected_rows(t):
    """The rows that the lenient scan leaves out."""
    return tables.csv_rejects(t.spark, _lenient_file(t), _texts("id", "name", "brand")).select("row", "fields")


def _lenient_file(t: Tables) -> str:
    path = _folder(t)
    full = F.concat(F.col("p_partkey").cast("string"), F.lit(","), "p_name", F.lit(',"'), "p_brand", F.lit(',"""'))
    line = (
        F.when(F.col("p_size") < 5, F.col("p_partkey").cast("string"))
        .when(F.col("p_size") < 10, F.concat(F.col("p_partkey").cast("string"), F.lit(","), "p_name"))
        .when(F.col("p_size") > 40, F.concat(full, F.lit(",surplus"))).otherwise(full)
    )
    sinks.write_lines(t.part.select(line.alias("value")), path, "id,name,brand")
    return path


@query("""SELECT c_custkey::VARCHAR AS party, '정당 ' || c_name AS color FROM customer
UNION ALL SELECT s_suppkey::VARCHAR, '무소속 ' || s_name FROM supplier""")
def csv_encoding_scan(t):
    """Files in UTF-8 and in a Korean code page read in one table."""
    tables.korean_charsets(t.spark)
    paths = [_folder(t), _folder(t)]
    first = t.customer.select(F.col("c_custkey").cast("string").alias("party"), F.concat(F.lit("정당 "), "c_name").alias("color"))
    second = t.supplier.select(F.col("s_suppkey").cast("string").alias("party"), F.concat(F.lit("무소속 "), "s_name").alias("color"))
    first.write.csv(paths[0], header=True)
    second.write.csv(paths[1], header=True, encoding="MS949")
    return tables.read_csv_any_encoding(t.spark, paths, _texts("party", "color"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def partitioned_sink(t):
    """One folder per value, read back as one table."""
    path = _folder(t)
    sinks.write_by_value(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), path, "o_orderstatus")
    return t.spark.read.parquet(path)


@query("""SELECT p_partkey, p_name, CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%bolt%' THEN 'true' ELSE 'false' END AS removed FROM part""")
def split_sink(t):
    """Kept and removed rows in two folders of one table."""
    path = _folder(t)
    sinks.write_split(t.part.select("p_partkey", "p_name", F.col("p_name").rlike("ring|bolt").alias("removed")), path)
    return t.spark.read.schema("p_partkey bigint, p_name string, removed string").parquet(path)


@query("""SELECT 'parts' AS stage, p_partkey AS id FROM part UNION ALL SELECT 'members', s_suppkey FROM supplier
UNION ALL SELECT 'backup', c_custkey FROM customer""")
def stage_sink(t):
    """Named stage tables and a backup copy, read back."""
    path = _folder(t)
    sinks.write_stages({"parts": t.part.select(F.col("p_partkey").alias("id")),
                        "members": t.supplier.select(F.col("s_suppkey").alias("id"))}, path)
    backup = sinks.write_backup(t.customer.select(F.col("c_custkey").alias("id")), f"{path}/backup")
    result = backup.select(F.lit("backup").alias("stage"), "id")
    for stage in ("parts", "members"):
        result = result.unionByName(t.spark.read.parquet(f"{path}/{stage}").select(F.lit(stage).alias("stage"), "id"))
    return require_columns(result, ["stage", "id"])


@query("SELECT page_id, url NOT LIKE '%.html' AS is_pdf FROM pages")
def pdf_magic(t):
    """Binary contents told apart by their magic number."""
    content = F.encode(F.when(F.col("url").endswith(".html"), F.col("html")).otherwise(F.concat(F.lit("%PDF-1.4 "), "html")), "UTF-8")
    return t.pages.select("page_id", is_pdf(content).alias("is_pdf"))


@query("""SELECT doc_id || ',' || lang || ',' || source || ',' || n_chars || ',' ||
  replace(replace(text, chr(10), ' '), ',', '') AS value FROM documents""")
def line_file_repair(t):
    """Comma-broken lines of a text file repaired, whatever the length of the last field."""
    path = _folder(t)
    line = F.concat_ws(",", "doc_id", "lang", "source", "n_chars", F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    t.documents.select(line.alias("value")).write.text(path)
    return repaired_lines(tables.read_lines(t.spark, path))


@query("SELECT o_custkey AS bill_id, count(*) AS n FROM orders GROUP BY o_custkey")
def stored_table(t):
    """A table stored in the shared folder and read back with its real size."""
    return materialize(t.orders.groupBy(F.col("o_custkey").alias("bill_id")).agg(F.count(F.lit(1)).alias("n")))


@query("""SELECT 'members' || (c_custkey % 3 + 20) || '.csv' AS file, (c_custkey % 3 + 20)::INT AS age, count(*) AS members, min(c_name) AS first
FROM customer GROUP BY ALL""")
def term_files_scan(t):
    """Per-term files read in one scan, the term taken from each file's name."""
    path = _folder(t)
    members = t.customer.select(F.col("c_custkey").cast("string").alias("member_id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 3 + 20).alias("term"))
    for term in (20, 21, 22):
        sinks.write_csv(members.where(F.col("term") == term).drop("term"), f"{path}/members{term}.csv")
    rows = t.spark.read.option("recursiveFileLookup", True).schema(_texts("member_id", "name")).csv(path, header=True)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    named = rows.select("name", folder.alias("file"), tables.file_term(folder).alias("age"))
    return named.groupBy("file", "age").agg(F.count(F.lit(1)).alias("members"), F.min("name").alias("first"))


@query("SELECT 'PRC_' || o_orderkey AS bill_id FROM orders")
def key_list_scan(t):
    """A file of keys read as a table of keys."""
    path = _folder(t)
    sinks.write_csv(t.orders.select(F.concat(F.lit("PRC_"), F.col("o_orderkey").cast("string")).alias("bill_id")), path)
    return tables.read_key_list(t.spark, path)
