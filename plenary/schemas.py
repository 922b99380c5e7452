"""Schemas of the landed inputs and published tables. Keys are strings: inference would drop zeros."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


VOTE_RAW = _strings("AGE", "MONA_CD", "BILL_NAME", "BILL_NO", "BILL_ID", "RESULT_VOTE_MOD", "VOTE_DATE", "BILL_URL")
MEMBER = _strings("monaCode", "이름", "정당", "선거구", "성별")
DISTRICT = _strings("SGG_Code", "SIDO_SGG", "SIDO", "SGG")
PARTY_COLOR = _strings("party", "color")
MISSING_TITLE = _strings("url", "bill_title")
BILL = T.StructType([
    T.StructField("age", T.IntegerType()),
    *_strings("title", "bill_id", "bill_number", "content").fields,
])
TOPIC = T.StructType([
    *BILL.fields,
    T.StructField("topic", T.IntegerType()),
    T.StructField("topic_label", T.StringType()),
])
RESPONSE = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])
FETCH = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("html", T.StringType()),
    T.StructField("error", T.StringType()),
])
