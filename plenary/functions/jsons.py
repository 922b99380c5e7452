"""JSON found inside free text, parsed leniently with a default on failure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from plenary.functions import lexicon
from plenary.functions.text import SPACE, digits_only, flatten_lines

_STRICT = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def json_object(c: Column) -> Column:
    """From the first `{` to the last `}`; null unless that is exactly one JSON object."""
    found = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    single = F.json_array_length(F.concat(F.lit("["), found, F.lit("]"))) == 1
    return F.when(single, found)


def json_strings(c: Column, limit: int = 4, default: Sequence[str] = lexicon.DEFAULT_KEYWORDS) -> Column:
    """The first array of plain strings in the text, cut to `limit`; a default list without one."""
    item = r'"[^"]*"'
    found = F.regexp_extract(c, rf"\[{item}(?:{SPACE}*,{SPACE}*{item})*\]", 0)
    parsed = F.from_json(F.nullif(found, F.lit("")), "array<string>", _STRICT)
    return F.coalesce(F.slice(parsed, 1, limit), F.array(*(F.lit(d) for d in default)))


def classification(c: Column) -> Column:
    """struct(category, subcategory, confidence) of a classification answer."""
    parsed = F.from_json(json_object(c), "category string, subcategory string, confidence double", _STRICT)
    default = F.struct(
        F.lit(lexicon.DEFAULT_CATEGORY).alias("category"),
        F.lit(lexicon.DEFAULT_SUBCATEGORY).alias("subcategory"),
        F.lit(lexicon.DEFAULT_CONFIDENCE).alias("confidence"),
    )
    answer = F.struct(
        parsed["category"].alias("category"),
        F.coalesce(parsed["subcategory"], F.lit(lexicon.DEFAULT_SUBCATEGORY)).alias("subcategory"),
        parsed["confidence"].alias("confidence"),
    )
    return F.when(parsed["category"].isNotNull(), answer).otherwise(default)


def subgroups(c: Column) -> Column:
    """array<struct(name, bills)> of a grouping answer; null when it cannot be parsed."""
    schema = "groups array<struct<name: string, bills: array<int>>>"
    return F.from_json(json_object(c), schema, _STRICT)["groups"]


def bill_fields(c: Column) -> Column:
    """struct(bill_no, reason, main) of an extraction answer; empty strings on failure."""
    parsed = F.from_json(json_object(c), "bill_no string, reason string, main string", _STRICT)
    empty = F.lit("")
    return F.struct(
        F.coalesce(digits_only(parsed["bill_no"]), empty).alias("bill_no"),
        F.coalesce(flatten_lines(parsed["reason"]), empty).alias("reason"),
        F.coalesce(flatten_lines(parsed["main"]), empty).alias("main"),
    )
