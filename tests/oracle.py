"""Runs registered queries beside their SQL and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else round(value, 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat().replace("T00:00:00", "")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sql_rows(con, sql: str):
    relation = con.sql(sql)
    names = list(relation.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(plain(r[i]) for i in order) for r in relation.fetchall()]


def spark_rows(df):
    names = list(df.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(plain(r[i]) for i in order) for r in df.collect()]


def difference(left, right) -> str:
    """Empty when names and row multisets agree; otherwise a short account of the difference."""
    (names, rows), (other_names, other) = left, right
    if names != other_names:
        return f"columns {names} != {other_names}"
    a, b = Counter(rows), Counter(other)
    if a == b:
        return ""
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return f"{len(rows)} vs {len(other)} rows; only left {len(only_a)}: {only_a[:2]}; only right {len(only_b)}: {only_b[:2]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from plenary.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false"})
    con, oracles, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        try:
            start = time.time()
            got = spark_rows(run(spark, folder))
            middle = time.time()
            message = difference(got, sql_rows(con, oracles[name])) if name in oracles else "no oracle"
            taken = f"{middle - start:6.2f}s sql {time.time() - middle:5.2f}s"
        except Exception as error:  # report and go on with the next query
            taken, message, got = "", f"{type(error).__name__}: {str(error)[:1500]}", ([], [])
        bad += message not in ("", "no oracle")
        print(f"{name:28s} {taken} rows {len(got[1]):7d} {message[:2500] or 'ok'}", flush=True)
    print("mismatches:", bad)
