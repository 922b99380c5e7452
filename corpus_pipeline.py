"""Documents of the wanted languages, without near copies and live secrets, mixed by source and tokenised.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the
next one. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plenary.llm import language, mixing, neardup, pieces, secrets
from plenary.llm.queries import PIECE_MODEL, remainder, table
from plenary.operators.index import materialize

ORACLE_SQL = None  # learnt models, hashed sampling and token pieces are beyond SQL


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a text or letter, and those that no learnt language explains; rows stay as they are."""
    model = language.fit(docs, remainder(4) != 2)
    return language.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays."""
    return neardup.keep_first(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are replaced by a marker in the text; every document stays."""
    return secrets.redact(docs, "source", ["source", "lang"])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that every source has the same share of the characters."""
    return mixing.mix(docs).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its piece ids, their number, and whether they decode to the text."""
    encoded = pieces.encode(docs, PIECE_MODEL)
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("secrets", remove_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's rows are stored before the next one begins."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
