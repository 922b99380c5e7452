"""Votes = lineitem, bills = part, members = supplier, party = nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindings.registry import Tables, query
from plenary.operators.aggregates import with_ratios, crosstab
from plenary.operators.joins import attach_bill_number
from plenary.operators.sets import head
from plenary.plans.crosstabs import member_votes, result_shares, vote_counts, vote_summary

RESULTS = ("A", "N", "R")


def _votes(t: Tables) -> DataFrame:
    members = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("member_id"), F.col("n_name").alias("party"))
    votes = t.lineitem.select(
        F.col("l_partkey").alias("bill_id"), F.col("l_suppkey").alias("member_id"),
        F.col("l_returnflag").alias("result"))
    return member_votes(votes, members, "member_id", ["result", "bill_id", "party"])


_VOTES = """votes AS (
  SELECT l_partkey AS bill_id, l_suppkey AS member_id, n_name AS party, l_returnflag AS result
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE l_returnflag IS NOT NULL AND l_partkey IS NOT NULL AND n_name IS NOT NULL)"""


def _shares(keys: str) -> str:
    return f"""WITH {_VOTES}, counts AS (
  SELECT {keys}, count(*) FILTER (result = 'A') AS "A", count(*) FILTER (result = 'N') AS "N",
         count(*) FILTER (result = 'R') AS "R"
  FROM votes GROUP BY {keys})
SELECT {keys}, "A", "N", "R", round("A"::DOUBLE / ("A" + "N" + "R"), 6) AS "ratio_A",
       round("N"::DOUBLE / ("A" + "N" + "R"), 6) AS "ratio_N",
       round("R"::DOUBLE / ("A" + "N" + "R"), 6) AS "ratio_R"
FROM counts"""


@query(_shares("bill_id, party"))
def vote_result_by_party(t):
    """Per bill and party: votes for each result and their share."""
    return result_shares(_votes(t), ["bill_id", "party"], "result", RESULTS)


@query(_shares("member_id, party"))
def member_tendency(t):
    """Per member: votes for each result and their share."""
    return result_shares(_votes(t), ["member_id", "party"], "result", RESULTS)


@query(_shares("party") + ' ORDER BY "N" DESC, party')
def party_opposition_ranked(t):
    """Parties by their number of votes for one result."""
    shares = with_ratios(crosstab(_votes(t), "party", "result", RESULTS), RESULTS)
    return shares.orderBy(F.desc("N"), "party")


@query("""SELECT l_orderkey AS vote_no, l_partkey AS bill_id, p_size::VARCHAR AS bill_number
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'ECONOMY') ON l_partkey = p_partkey""")
def bill_number_join(t):
    """The bill's number on every vote, null for bills the table lacks."""
    bills = t.part.where("p_type <> 'ECONOMY'").select(F.col("p_partkey").alias("bill_id"), F.col("p_size").alias("bill_number"))
    votes = t.lineitem.select(F.col("l_orderkey").alias("vote_no"), F.col("l_partkey").alias("bill_id"))
    return attach_bill_number(votes, bills)


_SUMMARY = """v AS (
  SELECT l_partkey AS bill, l_orderkey AS vote_no, s_name AS member_name, r_name AS party,
    CASE WHEN s_acctbal >= 4500 THEN 'F' ELSE 'M' END AS gender, n_name AS district, l_returnflag AS result
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE l_returnflag IS NOT NULL),
n AS (SELECT bill, 'party' AS attribute, party AS value, count(*) AS n FROM v GROUP BY ALL
  UNION ALL SELECT bill, 'gender', gender, count(*) FROM v GROUP BY ALL
  UNION ALL SELECT bill, 'district', district, count(*) FROM v GROUP BY ALL)"""


def _member_votes(t: Tables) -> DataFrame:
    members = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("member_id"), F.col("s_name").alias(" member_name "),
                F.col("r_name").alias("party"),
                F.when(F.col("s_acctbal") >= 4500, "F").otherwise("M").alias("gender"),
                F.col("n_name").alias("district"))
    )
    votes = t.lineitem.select(F.col("l_partkey").alias("bill"), F.col("l_orderkey").alias("vote_no"),
                              F.col("l_suppkey").alias("member_id"), F.col("l_returnflag").alias("result "))
    return member_votes(votes, members, "member_id", ["result", "bill", "party", "gender", "district"])


_ATTRIBUTES = ("party", "gender", "district")


@query(f"WITH {_SUMMARY} SELECT bill, attribute, value, n FROM n")
def vote_counts_long(t):
    """A bill's votes by every party, gender and district."""
    return vote_counts(_member_votes(t), "bill", _ATTRIBUTES)


@query(f"""WITH {_SUMMARY}, c AS (SELECT bill,
  string_agg(value || '=' || n, ',' ORDER BY value) FILTER (attribute = 'party') AS party_counts,
  string_agg(value || '=' || n, ',' ORDER BY value) FILTER (attribute = 'gender') AS gender_counts,
  string_agg(value || '=' || n, ',' ORDER BY value) FILTER (attribute = 'district') AS district_counts FROM n GROUP BY bill)
SELECT v.bill, vote_no, member_name, party, gender, district, result, party_counts, gender_counts, district_counts
FROM v JOIN c ON v.bill = c.bill""")
def vote_crosstab_counts(t):
    """Every vote with its bill's counts by party, gender and district, all values."""
    written = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return vote_summary(_member_votes(t), "bill", _ATTRIBUTES, ["vote_no", "member_name", "party", "gender", "district", "result"], written)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""")
def head_rows(t):
    """The first ten rows in a stated order."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return head(rows, 10, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"])
