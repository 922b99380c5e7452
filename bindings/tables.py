"""Projections, filters, joins, unions and counters on the relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindings.registry import Tables, query
from bindings.sqltext import strip
from plenary.functions.dates import vote_date, vote_date_text
from plenary.functions.text import strip as strip_text, zero_fill
from plenary.operators import aggregates, dedup, filters, joins, project, sets
from plenary.plans import backfill, bills
from plenary.sources.landed import boundaries


@query("""SELECT DISTINCT o_custkey AS bill_id FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_custkey IS NOT NULL""")
def passed_ids(t):
    """Distinct ids whose result is one of the passing ones."""
    return filters.passed(t.orders, "o_orderstatus", "o_custkey", ("F", "P")).select(
        F.col("o_custkey").alias("bill_id")).distinct()


@query("""SELECT 22 AS age, l_suppkey::VARCHAR AS member_id, l_partkey::VARCHAR AS bill_number,
  l_returnflag AS result, l_partkey AS original_number, coalesce(l_quantity::BIGINT, 0)::VARCHAR AS quantity
FROM lineitem""")
def lenient_projection_rename(t):
    """Trimmed names, the wanted columns that exist, renames, a literal term, a copy and casts."""
    raw = t.lineitem.withColumnsRenamed({
        "l_suppkey": "MONA_CD", "l_partkey": " BILL_NO", "l_returnflag": "RESULT_VOTE_MOD ",
        "l_quantity": "quantity"})
    wanted = (*project.VOTE_COLUMNS, "quantity")
    votes = project.rename(project.select_present(project.trim_names(raw), wanted), project.VOTE_NAMES)
    votes = project.keep_original(votes, "bill_number", "original_number")
    votes = project.as_number_text(project.as_text_key(votes, "bill_number", "member_id"), "quantity")
    return project.with_term(votes, 22).select(
        "age", "member_id", "bill_number", "result", "original_number", "quantity")


_ORDER = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_shipdate"


@query(f"""SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {_ORDER}) AS rn FROM lineitem) WHERE rn = 1""")
def keep_first_dedup(t):
    """The first row of each key."""
    return dedup.first_per_key(t.lineitem, ["l_partkey"], _ORDER.split(", ")).select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t):
    return dedup.distinct_rows(t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus"))


@query("SELECT DISTINCT url FROM pages WHERE url IS NOT NULL")
def distinct_urls(t):
    """The URLs still to fetch."""
    return dedup.distinct_values(t.pages, "url")


@query("""SELECT conv_id, turn // 1000 AS part,
  coalesce(string_agg(CASE WHEN role <> 'user' THEN text END, ' / ' ORDER BY turn), '') AS content
FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL""")
def content_string_agg(t):
    """Non-null texts of a key joined in order; long keys come in numbered stretches of 1000 turns."""
    rows = t.conversations.select(
        "conv_id", "turn", F.when(F.col("role") != "user", F.col("text")).alias("content"))
    part = F.floor(F.col("turn") / 1000)
    return aggregates.join_texts(rows, "conv_id", "content", "turn", part=part)


_VOTE_ROWS = """SELECT '22' AS age, o_orderkey::VARCHAR AS member_id, o_orderpriority AS title,
  'no-' || o_custkey AS bill_number, o_custkey AS bill_id, o_orderstatus AS result,
  o_orderdate::DATE AS date, 'page/' || o_custkey AS url FROM orders"""


@query(f"""WITH v AS ({_VOTE_ROWS}),
p AS (SELECT 'page/' || page_id AS url FROM pages WHERE url IS NOT NULL)
SELECT v.*, d.source AS cleaned, d.lang AS summary, d.n_chars AS card_news_content
FROM v JOIN p ON v.url = p.url LEFT JOIN documents d ON d.doc_id = v.bill_id""")
def left_enrich_dropna(t):
    """Votes with page text (rows without any dropped), then per-bill results on every vote."""
    votes = t.orders.select(
        F.lit("22").alias("AGE"), F.col("o_orderkey").cast("string").alias("MONA_CD"),
        F.col("o_orderpriority").alias("BILL_NAME"),
        F.concat(F.lit("no-"), F.col("o_custkey").cast("string")).alias("BILL_NO"),
        F.col("o_custkey").alias("BILL_ID"), F.col("o_orderstatus").alias("RESULT_VOTE_MOD"),
        F.date_format("o_orderdate", "yyyyMMdd HHmmss").alias("VOTE_DATE"),
        F.concat(F.lit("page/"), F.col("o_custkey").cast("string")).alias("BILL_URL"))
    texts = t.pages.select(F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("url"),
                           F.col("url").alias("content"))
    results = t.documents.select(F.col("doc_id").alias("bill_id"), F.col("source").alias("content"),
                                 F.col("lang").alias("summary"), F.col("n_chars").alias("card_news_content"))
    return joins.attach_results(bills.votes_with_text(votes, texts), results, ["summary", "card_news_content"])


def matched(content: str) -> str:
    """CTEs that end in `matched`: orders with the customers' texts, by equal number, else by last four digits."""
    return f"""l AS (SELECT (o_orderkey % 2)::INT AS age, o_orderpriority AS title, 'PRC_' || o_orderkey AS bill_id,
  lpad(o_orderkey::VARCHAR, 7, '0') AS bill_number, o_orderkey::VARCHAR AS f, right(lpad(o_orderkey::VARCHAR, 7, '0'), 4) AS k FROM orders),
c AS (SELECT *, ((c_custkey // 2) * 37) % 15000 AS n FROM customer),
r AS (SELECT (n % 2)::INT AS age, n::VARCHAR AS f, right(lpad(n::VARCHAR, 4, '0'), 4) AS k, {content} AS x FROM c WHERE {content} <> ''),
e AS (SELECT age, f, string_agg(x, ' / ' ORDER BY x) AS content, count(*) AS matches FROM r GROUP BY age, f),
s AS (SELECT age, k, string_agg(x, ' / ' ORDER BY x) AS content, count(*) AS matches FROM r ANTI JOIN l USING (age, f) GROUP BY age, k),
matched AS (SELECT l.age, title, bill_id, bill_number, content, matches FROM l JOIN e USING (age, f)
  UNION ALL SELECT l.age, title, bill_id, bill_number, content, matches FROM (FROM l ANTI JOIN e USING (age, f)) AS l JOIN s USING (age, k))"""


def extract_number() -> Column:
    """Numbers that several customers share, in full or in their last four digits."""
    return F.floor(F.col("c_custkey") / 2) * 37 % 15000


@query(f"""WITH {matched(strip("coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, '') || ' ' || coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END, '')"))}
SELECT * FROM matched""")
def last4_key_join(t):
    """Bills without text joined to extracts of their term by number, else on its last four digits."""
    missing = t.orders.select(
        (F.col("o_orderkey") % 2).cast("int").alias("age"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("PRC_"), F.col("o_orderkey").cast("string")).alias("bill_id"),
        zero_fill(F.col("o_orderkey"), 7).alias("bill_number"))
    extracts = t.customer.select(
        (extract_number() % 2).cast("int").alias("age"),
        F.concat(F.lit(" "), extract_number().cast("string")).alias("bill_number"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("reason"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("main"))
    return joins.fill_from_extracts(missing, extracts).select("age", "title", "bill_id", "bill_number", "content", "matches")


@query("""WITH k AS (SELECT count(*) AS rows_per_key FROM orders GROUP BY o_custkey)
SELECT rows_per_key, count(*) AS keys FROM k GROUP BY rows_per_key""")
def key_multiplicity(t):
    """How many keys occur once, twice, … before an m:n join."""
    return joins.key_multiplicity(t.orders, ["o_custkey"])


def _update_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = t.customer.select(
        "c_custkey", F.col("c_nationkey").alias("bill_number"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("content"))
    new = t.supplier.select(F.col("s_nationkey").alias("bill_number"),
                            F.when(F.col("s_acctbal") >= 2000, F.col("s_name")).alias("content"))
    return old, new


_UPDATE = """b AS (SELECT c_custkey, c_nationkey::VARCHAR AS bill_number,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS content FROM customer),
f AS (SELECT s_nationkey::VARCHAR AS bill_number, CASE WHEN s_acctbal >= 2000 THEN s_name END AS content FROM supplier),
one AS (SELECT bill_number, min(content) AS fill FROM f GROUP BY bill_number),
u AS (SELECT c_custkey, bill_number, coalesce(fill, content) AS content FROM b LEFT JOIN one USING (bill_number))"""


@query(f"WITH {_UPDATE} SELECT * FROM u")
def lookup_update(t):
    """New text by key where there is some, the old text otherwise."""
    return joins.lookup_update(*_update_tables(t))


@query(f"""WITH {_UPDATE}
SELECT (SELECT count(content) FROM b) AS filled_before, (SELECT count(content) FROM u) AS filled_after,
  (SELECT count(*) FROM f WHERE bill_number IN (SELECT bill_number FROM b)) AS matched,
  (SELECT count(content) FROM u) - (SELECT count(content) FROM b) AS newly_filled""")
def lookup_update_report(t):
    old, new = _update_tables(t)
    return joins.update_report(old, joins.lookup_update(old, new), new)


@query(f"""WITH {_UPDATE}
SELECT (SELECT count(content) FROM b) AS before_rows, (SELECT count(content) FROM u) AS after_rows,
  (SELECT count(content) FROM u) - (SELECT count(content) FROM b) AS added_rows""")
def fill_change(t):
    """Non-null counts before and after a fill."""
    old, new = _update_tables(t)
    return aggregates.fill_change(old, joins.lookup_update(old, new))


@query("""SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def unmatched_keys(t):
    """Rows whose key has no match."""
    orders = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.with_key_not_in(t.customer.select("c_custkey", "c_name"), orders, "c_custkey")


@query("""SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') ORDER BY s_suppkey LIMIT 5""")
def unmatched_first(t):
    """The first five unmatched rows, for the report."""
    orders = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("s_suppkey"))
    return sets.head(joins.with_key_not_in(t.supplier.select("s_suppkey", "s_name"), orders, "s_suppkey"),
                     5, ["s_suppkey"])


@query("SELECT count(*) AS matched FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier)")
def matched_count(t):
    """Rows whose key the other table has."""
    keys = t.supplier.select(F.col("s_suppkey").alias("o_custkey"))
    return joins.with_key_in(t.orders, keys, "o_custkey").agg(F.count(F.lit(1)).alias("matched"))


@query("""SELECT doc_id AS bill_id, lang, source, quality, toxic, url FROM documents
LEFT JOIN labels USING (doc_id) LEFT JOIN pages ON page_id = doc_id""")
def two_step_enrich(t):
    """Bills with cluster columns, then a summary column."""
    docs = t.documents.select(F.col("doc_id").alias("bill_id"), "lang", "source")
    labels = t.labels.withColumnRenamed("doc_id", "bill_id")
    pages = t.pages.select(F.col("page_id").alias("bill_id"), "url")
    return joins.enrich_bills(docs, labels, pages)


@query(f"""WITH v AS (SELECT {strip("'  part-' || l_partkey || chr(160)")} AS url, l_orderkey, l_linenumber,
  row_number() OVER (PARTITION BY l_partkey ORDER BY {_ORDER}) AS rn FROM lineitem)
SELECT v.url AS "BILL_URL", l_orderkey, l_linenumber, p_name FROM v
JOIN part ON v.url = 'part-' || p_partkey WHERE rn = 1""")
def trimmed_inner_join(t):
    """One row per trimmed URL, joined to texts with the same trimmed URL."""
    votes = t.lineitem.withColumn("BILL_URL", F.concat(
        F.lit("  part-"), F.col("l_partkey").cast("string"), F.lit(" ")))
    texts = t.part.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string"), F.lit(" \t")).alias("url"), "p_name")
    joined = joins.join_page_text(votes, texts, order_by=_ORDER.split(", "))
    return joined.select("BILL_URL", "l_orderkey", "l_linenumber", "p_name")


@query("""SELECT lpad(c_custkey::VARCHAR, greatest(7, length(c_custkey::VARCHAR))::INT, '0') AS "SGG_Code", c_name,
  CASE WHEN s_suppkey IS NOT NULL THEN '{"type":"Point","coordinates":[' || s_suppkey || ',' || CASE WHEN s_suppkey % 2 = 0 THEN 99 ELSE s_nationkey END || ']}' END AS boundary
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def boundary_lookup(t):
    """Zero-filled codes with the geometry text of their GeoJSON feature; codes repeat in files and across them."""
    code, key = F.lpad(F.col("s_suppkey").cast("string"), 7, "0"), F.col("s_suppkey").cast("string")
    feature = '{"type":"Feature","properties":{"SGG_Code":"%s"},"geometry":{"type":"Point","coordinates":[%s,%s]}}'
    first = F.format_string('{"type":"FeatureCollection","features":[' + feature + "," + feature + "]}",
                            code, key, F.lit("7"), code, key, F.col("s_nationkey").cast("string"))
    later = F.format_string('{"type":"FeatureCollection","features":[' + feature + "]}", code, key, F.lit("99"))
    collections = t.supplier.select(first.alias("body"), F.lit("a.json").alias("file")).unionByName(
        t.supplier.where("s_suppkey % 2 = 0").select(later.alias("body"), F.lit("b.json").alias("file")))
    districts = t.customer.select(F.col("c_custkey").alias("SGG_Code"), "c_name")
    return joins.attach_boundary(districts, boundaries(collections, file="file"))


_WORDS = ("token", "license", "@", "%%")


@query("""SELECT doc_id, coalesce(regexp_matches(text, 'token|license|@|%%'), false) AS removed FROM documents""")
def keyword_filter_split(t):
    """Kept and removed rows of a title filter, told apart by a flag."""
    return filters.flag_procedural(t.documents, "text", words=_WORDS).select("doc_id", "removed")


@query("SELECT p_partkey, p_name FROM part WHERE NOT coalesce(regexp_matches(p_name, 'ring|bolt'), false)")
def filter_complement(t):
    return sets.complement(t.part, filters.title_matches(F.col("p_name"), ("ring", "bolt"))).select(
        "p_partkey", "p_name")


def _damaged(t: Tables) -> DataFrame:
    content = (
        F.when(F.col("source") == "src1", F.lit(None)).when(F.col("source") == "src2", "nan")
        .when(F.col("source") == "src3", " NONE ").when(F.col("source") == "src4", " \t ")
        .when(F.col("source") == "src5", "").otherwise(F.col("text"))
    )
    return t.documents.select("doc_id", content.alias("content"))


_DAMAGED = """d AS (SELECT doc_id, CASE source WHEN 'src1' THEN NULL WHEN 'src2' THEN 'nan' WHEN 'src3' THEN ' NONE '
  WHEN 'src4' THEN ' ' || chr(9) || ' ' WHEN 'src5' THEN '' ELSE text END AS content FROM documents),
s AS (SELECT doc_id, content, """ + strip("content") + " AS c FROM d)"
_VALID = "content IS NOT NULL AND c <> '' AND c <> 'nan' AND lower(c) <> 'none'"


@query(f"""WITH {_DAMAGED} SELECT count(*) AS total_rows, count(*) FILTER (content IS NULL) AS null_rows,
  count(*) FILTER (c = '') AS empty_rows, count(*) FILTER (coalesce(c, 'nan') = 'nan') AS nan_text_rows,
  count(*) FILTER (lower(c) = 'none') AS none_text_rows, count(*) FILTER ({_VALID}) AS valid_rows,
  count(*) - count(*) FILTER ({_VALID}) AS removed_rows FROM s""")
def content_audit(t):
    """Kinds of unusable text counted in one pass."""
    return aggregates.content_audit(_damaged(t))


@query(f"WITH {_DAMAGED} SELECT doc_id, content FROM s WHERE {_VALID}")
def content_valid_rows(t):
    return filters.clean_content(_damaged(t))


@query(f"""WITH {_DAMAGED} SELECT count(*) FILTER (content IS NULL) AS null_rows,
  count(*) FILTER (content = '') AS empty_rows, count(*) FILTER (content IS NULL OR content = '') AS missing_rows FROM d""")
def missing_report(t):
    return aggregates.missing_report(_damaged(t))


@query(f"WITH {_DAMAGED} SELECT doc_id FROM d WHERE content IS NULL OR content = ''")
def missing_rows(t):
    return filters.missing_content(_damaged(t)).select("doc_id")


@query("""SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
WHERE doc_id IS NULL OR lang IS NULL OR quality IS NULL OR toxic IS NULL""")
def any_null_rows(t):
    """Rows with a null in any column."""
    return filters.any_null(t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left"))


@query("""SELECT 21 AS age, c_name AS title, 'C' || c_custkey AS bill_id, c_custkey::VARCHAR AS bill_number,
  c_mktsegment AS content FROM customer
UNION ALL SELECT 22, s_name, 'S' || s_suppkey, s_suppkey::VARCHAR, NULL FROM supplier""")
def union_terms(t):
    """Per-term tables put together; a column one of them lacks is null there."""
    first = t.customer.select(
        F.col("c_name").alias("title"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("bill_id"),
        F.col("c_custkey").cast("string").alias("bill_number"), F.col("c_mktsegment").alias("content"))
    second = t.supplier.select(
        F.col("s_name").alias("title"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("bill_id"),
        F.col("s_suppkey").cast("string").alias("bill_number"))
    terms = sets.union_terms({21: first, 22: second})
    return sets.union_sources({"terms": terms})


@query("""WITH b AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN p_brand ELSE (p_size * 4)::VARCHAR END AS age FROM part)
SELECT p_partkey, try_cast(age AS DOUBLE) AS age, CASE
  WHEN try_cast(age AS DOUBLE) < 0 THEN NULL WHEN try_cast(age AS DOUBLE) < 19 THEN '10대'
  WHEN try_cast(age AS DOUBLE) < 29 THEN '20대' WHEN try_cast(age AS DOUBLE) < 39 THEN '30대'
  WHEN try_cast(age AS DOUBLE) < 49 THEN '40대' WHEN try_cast(age AS DOUBLE) < 59 THEN '50대'
  WHEN try_cast(age AS DOUBLE) < 69 THEN '60대' WHEN try_cast(age AS DOUBLE) < 150 THEN '70대 이상' END AS age_group
FROM b""")
def bucket_labels(t):
    """Numbers in text form put into labelled classes; text and outliers have none."""
    rows = t.part.select("p_partkey", F.when(F.col("p_type") == "ECONOMY", F.col("p_brand"))
                         .otherwise((F.col("p_size") * 4).cast("string")).alias("age"))
    return backfill.age_classes(project.as_number(rows, "age"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS date,
  strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders""")
def vote_date_parse(t):
    """Vote dates from text, lenient (bad text is null) and strict (bad text is an error)."""
    text = F.date_format("o_orderdate", "yyyyMMdd HHmmss")
    loose = F.when(F.col("o_orderstatus") == "P", "abcd1234").otherwise(text)
    return t.orders.select("o_orderkey", vote_date(loose).alias("date"), vote_date_text(text).alias("date_text"))


@query("""SELECT event_type || ':' || CASE WHEN props LIKE '{%' THEN 'object' ELSE 'text' END AS value, count(*) AS n
FROM events GROUP BY 1""")
def value_frequency(t):
    """Rows per distinct value of an expression."""
    kind = F.when(F.col("props").startswith("{"), "object").otherwise("text")
    return aggregates.value_frequency(t.events, F.concat_ws(":", "event_type", kind))


@query("SELECT p_name AS cluster_keyword, count(*) AS n FROM part GROUP BY p_name HAVING count(*) >= 5")
def frequent_values(t):
    """Values that occur at least five times."""
    return aggregates.value_frequency(t.part, "p_name", "cluster_keyword", at_least=5)


@query("SELECT DISTINCT p_size AS age FROM part ORDER BY age")
def sorted_terms(t):
    return dedup.distinct_values(t.part.select(F.col("p_size").alias("age")), "age").orderBy("age")


@query(f"""SELECT c_custkey, {strip("'　' || c_name || chr(10)")} AS c_name FROM customer WHERE c_mktsegment = 'BUILDING'""")
def of_term(t):
    """Rows of one term, with names stripped of every kind of white space."""
    named = t.customer.withColumn("c_name", F.concat(F.lit("　"), F.col("c_name"), F.lit("\n")))
    return filters.of_term(named, "BUILDING", "c_mktsegment").select("c_custkey", strip_text(F.col("c_name")).alias("c_name"))


@query("SELECT 3::BIGINT AS drawn, 3::BIGINT AS distinct_rows, 3::BIGINT AS in_table")
def random_rows(t):
    """Three rows at random: as many as asked for, different ones, all from the table."""
    table = t.orders.select("o_orderkey", "o_custkey")
    drawn = sets.random_rows(table, 3, seed=7)
    found = drawn.join(table.withColumn("known", F.lit(1)), ["o_orderkey", "o_custkey"], "left")
    return found.agg(F.count(F.lit(1)).alias("drawn"), F.countDistinct("o_orderkey").alias("distinct_rows"), F.count("known").alias("in_table"))


@query("""SELECT l_orderkey, l_linenumber, s_suppkey AS member_id, n_name AS party FROM lineitem
LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) ON 'Member ' || (l_suppkey % 40) = 'Member ' || (s_suppkey % 40)
WHERE l_linenumber = 1""")
def member_join_by_name(t):
    """Members joined to votes by name; a name that several members share gives a row for each."""
    name = lambda key: F.concat(F.lit("Member "), (F.col(key) % 40).cast("string"))
    votes = t.lineitem.where("l_linenumber = 1").select("l_orderkey", "l_linenumber", name("l_suppkey").alias("HG_NM"))
    members = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        name("s_suppkey").alias("HG_NM"), F.col("s_suppkey").alias("member_id"), F.col("n_name").alias("party"))
    return joins.attach_members(votes, members, "HG_NM").drop("HG_NM")


_MEMBERS = """m AS (SELECT 20 + c_custkey % 3 AS age, 'M' || c_custkey AS member_id, c_name AS name, c_mktsegment AS party,
  CASE WHEN c_custkey % 5 = 0 THEN '비례대표' WHEN c_custkey % 7 = 0 THEN '세종특별자치시갑' ELSE 'S' || c_nationkey || ' D' || c_custkey % 9 END AS sido_sgg,
  CASE WHEN c_acctbal > 0 THEN '남' ELSE '여' END AS gender FROM customer)"""


def _member_table(t: Tables) -> DataFrame:
    """Three terms' member files put together under their published names."""
    key = F.col("c_custkey")
    district = F.when(key % 5 == 0, "비례대표").when(key % 7 == 0, "세종특별자치시갑").otherwise(
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string"), F.lit(" D"), (key % 9).cast("string")))
    rows = t.customer.select(
        F.concat(F.lit("M"), key.cast("string")).alias("monaCode"), F.col("c_name").alias("이름"), F.col("c_mktsegment").alias("정당"),
        district.alias("선거구"), F.when(F.col("c_acctbal") > 0, "남").otherwise("여").alias("성별"), (key % 3).alias("term"))
    return backfill.member_table({20 + k: rows.where(F.col("term") == k).drop("term") for k in range(3)})


@query(f"""WITH {_MEMBERS} SELECT age::INT AS age, name, party, sido_sgg AS "SIDO_SGG", member_id, gender FROM m""")
def member_table(t):
    """Members of all terms under their published column names."""
    return _member_table(t)


@query(f"""WITH {_MEMBERS} SELECT age::INT AS age, sido_sgg, CASE WHEN contains(sido_sgg, '세종특별자치시') THEN '세종'
  WHEN sido_sgg <> '비례대표' THEN split_part(sido_sgg, ' ', 1) END AS sido,
  CASE WHEN contains(sido_sgg, '세종특별자치시') THEN sido_sgg WHEN sido_sgg <> '비례대표' THEN split_part(sido_sgg, ' ', 2) END AS sgg FROM m""")
def district_table(t):
    """Every member's district cut in two; none for proportional seats."""
    return backfill.district_table(_member_table(t))
