"""The numbered operators with production parameters on their whole tables, and SQL where it can say the same."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenary.llm import idstore, language, merkle, mixing, neardup, oracles, pieces, pii, recurrent, runs, secrets, spans, spotsigs, topk, toxicity

QUERIES = {}
ORACLES = {"op1_secrets": oracles.SECRETS, "op2_topk": oracles.TOP_K, "op5_mixing": oracles.MIXING, "op7_pii": oracles.PERSONAL, "op13_merkle": oracles.MERKLE}
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_BPE, END_ID = "/opt/tokenizers/byte_bpe_50k.json", 2


def query(build):
    QUERIES[build.__name__] = build
    return build


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package when the driver was started in another folder."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH", "")]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor; held-out documents are those of one remainder."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def held_out(divisor: int, kept_back: int) -> Column:
    """Whether a document is kept back from learning; one without an id is not, though nothing is learnt from it either."""
    return F.coalesce(remainder(divisor) == kept_back, F.lit(False)).alias("held_out")


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def ownership_columns() -> tuple[Column, Column]:
    """A document's owner is its source; the source's languages are its repositories."""
    return F.col("source"), F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))


@query
def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secrets(table(spark, folder, "documents"), *ownership_columns())
    base = F.filter("spans", lambda s: s["kind"] < secrets.BASE)
    return found.select(
        "doc_id", *[spans.count(F.col("spans"), k).alias(f"n_{secrets.KINDS[k]}") for k in range(secrets.BASE)],
        _digest(spans.written(base, secrets.KINDS)).alias("base_sha256"), spans.written(F.col("spans"), secrets.KINDS).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("bigint").alias("n_example"))


@query
def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@query
def op3_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "class_size", F.lower(F.hex("class_key")).alias("class_key"))


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.identify(docs, remainder(4) != 2)
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score")


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query
def op6_recurrent(spark: SparkSession, folder: str) -> DataFrame:
    scored = recurrent.score(table(spark, folder, "documents"), remainder(7) != 2)
    return scored.select("doc_id", held_out(7, 2), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(table(spark, folder, "documents"))
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")))
    return found.select(
        "doc_id", *[spans.count(F.col("spans"), k).alias(f"n_{pii.KINDS[k]}") for k in range(4)],
        _digest(spans.written(F.col("spans"), pii.KINDS)).alias("base_sha256"),
        spans.written(F.array_sort(F.concat("spans", terms)), pii.KINDS).alias("spans"),
        F.size("terms").cast("bigint").alias("n_term"))


@query
def op8_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, folder, "documents"))


@query
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), PIECE_MODEL)
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.toxicity(docs, labels, remainder(5) != 0)
    return scored.select("doc_id", held_out(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op11_idstore(spark: SparkSession, folder: str) -> DataFrame:
    store, keys = idstore.build(table(spark, folder, "documents"), byte_bpe(), END_ID)
    return idstore.fetch(store, keys).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def byte_bpe() -> str:
    """Where the tokenizer's file is: as its package tells, else at its usual place."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return BYTE_BPE
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    number = F.crc32(F.col("doc_id").cast("string"))
    found = runs.periodic_runs(table(spark, folder, "documents"), F.when(number % 10 == 0, F.floor(number / 10)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    first = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), first.alias("longest"), lines.alias("lines"), "collapsed")
    start, length, period = -F.col("longest.back"), F.col("longest.length"), -F.col("longest.short")
    return found.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("longest.length * 1000 div -longest.short").alias("exponent_milli"),
        _digest(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), "")).alias("runs_sha256"), _digest(F.col("collapsed")).alias("collapsed_sha256"))


@query
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    columns = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.when(remainder(2) == 0, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    rows = docs.select("doc_id", F.col("source").alias("group"), merkle.leaf(*map(F.col, columns), F.col("text")).alias("leaf"),
                       merkle.leaf(*map(F.col, columns), tampered).alias("other"))
    proved = merkle.prove(rows)
    return proved.select("doc_id", "leaf", "subroot", "root", _digest(F.array_join("proof", "")).alias("proof_sha256"), "folded_root", "verified")
