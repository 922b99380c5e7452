"""One-to-one matching of orders (bills) and customers (extracts), beside the same rounds in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindings.registry import Tables, query
from plenary.functions.text import zero_fill
from plenary.operators import matching

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_WORDS = "list_sort(list_distinct(regexp_extract_all(lower({}), '\\p{{L}}+')))"


def _bills(t: Tables) -> DataFrame:
    return t.orders.select(
        (F.col("o_orderkey") % 2).cast("int").alias("age"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("PRC_"), F.col("o_orderkey").cast("string")).alias("bill_id"), zero_fill(F.col("o_orderkey"), 7).alias("bill_number"))


def _extracts(t: Tables) -> DataFrame:
    """Numbers that several customers share, in full or in their last four digits; some have no text."""
    number = F.floor(F.col("c_custkey") / 2) * 37 % 95000
    names = F.array(*[F.lit(p) for p in _PRIORITIES])
    return t.customer.select(
        F.concat(F.lit("f"), F.col("c_custkey").cast("string")).alias("file_name"), (number % 2).cast("int").alias("age"),
        number.cast("string").alias("bill_number"), F.get(names, (F.col("c_custkey") % 5).cast("int")).alias("title"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("reason"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("main"))


def _rounds(name: str, rows: str, rounds: int = matching.ROUNDS) -> str:
    """CTEs that end in `{name}(bill, file, distance, overlap, round)`, from a CTE (block, value, title, extract, id)."""
    overlap = "CASE WHEN len(list_distinct(list_concat(title, nt))) > 0 THEN len(list_intersect(title, nt)) * 1000 // len(list_distinct(list_concat(title, nt))) ELSE 0 END"
    order = "PARTITION BY block ORDER BY value NULLS FIRST, title, extract, id"
    parts, before = [], rows
    for i in range(rounds):
        o, p, s = f"{name}_o{i}", f"{name}_p{i}", f"{name}_s{i}"
        parts.append(f"""{o} AS (SELECT *, row_number() OVER ({order}) AS pl, lead(extract) OVER w AS ne, lead(id) OVER w AS ni,
  lead(value) OVER w AS nv, lead(title) OVER w AS nt FROM {before} WINDOW w AS ({order})),
{p} AS (SELECT block, pl, CASE WHEN extract THEN ni ELSE id END AS bill, CASE WHEN extract THEN id ELSE ni END AS file,
  least(coalesce(abs(nv - value), {matching.FAR}), {matching.FAR}) AS distance, {overlap} AS overlap FROM {o} WHERE ne <> extract),
{s} AS (SELECT p.* FROM {p} AS p LEFT JOIN {p} AS b ON b.block = p.block AND b.pl = p.pl - 1 LEFT JOIN {p} AS f ON f.block = p.block AND f.pl = p.pl + 1
  WHERE (b.pl IS NULL OR (p.distance, -p.overlap, p.pl) < (b.distance, -b.overlap, b.pl)) AND (f.pl IS NULL OR (p.distance, -p.overlap, p.pl) < (f.distance, -f.overlap, f.pl))),
{name}_r{i} AS (SELECT block, value, title, extract, id FROM {before} WHERE NOT extract AND id NOT IN (SELECT bill FROM {s}) OR extract AND id NOT IN (SELECT file FROM {s}))""")
        before = f"{name}_r{i}"
    own = "PARTITION BY block, extract ORDER BY value NULLS FIRST, title, id"
    parts.append(f"""{name}_n AS (SELECT *, row_number() OVER ({own}) AS nth FROM {before}),
{name}_x AS (SELECT l.id AS bill, r.id AS file, least(coalesce(abs(l.value - r.value), {matching.FAR}), {matching.FAR}) AS distance, l.title AS title, r.title AS nt
  FROM {name}_n AS l JOIN {name}_n AS r ON l.block = r.block AND l.nth = r.nth AND NOT l.extract AND r.extract)""")
    union = " UNION ALL ".join([*(f"SELECT bill, file, distance, overlap, {i}::INT AS round FROM {name}_s{i}" for i in range(rounds)),
                                f"SELECT bill, file, distance, {overlap} AS overlap, {rounds}::INT AS round FROM {name}_x"])
    parts.append(f"{name} AS ({union})")
    return ",\n".join(parts)


_MATCHED = f"""WITH b AS (SELECT 'PRC_' || o_orderkey AS id, o_orderkey AS n, (o_orderkey % 2)::INT AS age, lpad(o_orderkey::VARCHAR, 7, '0') AS number, o_orderpriority AS title FROM orders),
c AS (SELECT 'f' || c_custkey AS id, ((c_custkey // 2) * 37) % 95000 AS n, {list(_PRIORITIES)}[c_custkey % 5 + 1] AS title,
  trim(coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, '') || ' ' || coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END, '')) AS content FROM customer),
rows_ AS (SELECT id, false AS extract, age, n::VARCHAR AS f, right(number, 4) AS k, n AS value, {_WORDS.format('title')} AS title FROM b
  UNION ALL SELECT id, true, (n % 2)::INT, n::VARCHAR, lpad(right(n::VARCHAR, 4), 4, '0'), n, {_WORDS.format('title')} FROM c WHERE content <> ''),
e_rows AS (SELECT age || '/' || f AS block, value, title, extract, id FROM rows_ WHERE (age, f) IN (SELECT (age, f) FROM rows_ GROUP BY age, f HAVING count(DISTINCT extract) = 2)),
{_rounds("e", "e_rows")},
s_rows AS (SELECT age || '/' || k AS block, value, title, extract, id FROM rows_ WHERE NOT extract AND id NOT IN (SELECT bill FROM e) OR extract AND id NOT IN (SELECT file FROM e)),
{_rounds("s", "s_rows")},
pairs AS (FROM e UNION ALL FROM s)"""


@query(f"""{_MATCHED} SELECT b.age, b.title, b.id AS bill_id, b.number AS bill_number, c.content, pairs.file AS file_name, distance, overlap, round
FROM b LEFT JOIN pairs ON pairs.bill = b.id LEFT JOIN c ON c.id = pairs.file""")
def one_to_one_extracts(t):
    """Every bill with at most one extract, and no extract used twice: by number, else by the last four digits."""
    return matching.match_extracts(_bills(t), _extracts(t))[0]


@query(f"{_MATCHED} SELECT id AS file_name, (n % 2)::INT AS age, n::VARCHAR AS bill_number FROM c WHERE id NOT IN (SELECT file FROM pairs)")
def unused_extracts(t):
    """Extracts that no bill takes."""
    return matching.match_extracts(_bills(t), _extracts(t))[1]
