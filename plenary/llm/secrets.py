"""Secret scans with corpus-wide ownership frequency.

Candidates are hashed and counted by the distinct repositories and owners that hold them. A value that many owners
share is an example out of documentation or a template; one that few owners hold looks like a live credential.
Named kinds (assignments, access keys, hexadecimal strings) are always reported. Opaque tokens, which no name
gives away, are reported only where ownership says that they are live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plenary.llm import spans
from plenary.llm.columns import shield
from plenary.operators.index import materialize

KINDS = ["assign", "access", "hex", "opaque"]
BASE = 3  # the first kinds are reported whatever their ownership

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"

EXAMPLE_OWNERS = 3


def candidates(text: Column) -> Column:
    """All spans of a text, sorted by start and kind. Opaque ones hold a digit and both cases and overlap no other."""
    assign = spans.find(text, 0, ASSIGN, lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 6)
    access = spans.find(text, 1, ACCESS, screen=text.contains("AKIA"))
    plain = spans.find(text, 2, HEX)
    mixed = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}"
    opaque = spans.find(text, 3, OPAQUE, lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]"), screen=text.rlike(mixed))
    return _joined(F.concat(assign, access, plain), opaque)


def _joined(named: Column, opaque: Column) -> Column:
    both = F.struct(named.alias("named"), opaque.alias("opaque"))
    return spans.once(both, lambda b: F.array_sort(F.concat(b["named"], spans.apart(b["opaque"], b["named"]))))


def secret_value(kind: Column, value: Column) -> Column:
    """What is hashed: an assignment's value without its name, else the whole match."""
    return F.when(kind == 0, F.regexp_extract(value, ASSIGN, 2)).otherwise(value)


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """(row key, doc_id, spans) for every row, stored; each span carries the hash of its value."""
    found = candidates(F.coalesce(F.col("text"), F.lit("")))
    hashed = F.transform(F.col("_found"), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.sha2(secret_value(s["kind"], s["value"]), 256).alias("hash")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), owner.alias("owner"), repository.alias("repository"), found.alias("_found"))
    return materialize(rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("spans", hashed).drop("_found"))


def ownership(scanned: DataFrame) -> DataFrame:
    """(hash, owners, repositories, uses): one row per candidate value, from all documents.

    Equal (hash, owner, repository) rows are counted before they are shuffled. A null owner or repository is one of its own.
    """
    uses = scanned.where(F.size("spans") > 0).select("owner", "repository", F.explode("spans.hash").alias("hash"))
    owner, repository = (F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("owner", "repository"))
    per = uses.groupBy("hash", owner.alias("owner"), repository.alias("repository")).agg(F.count(F.lit(1)).alias("uses"))
    return per.groupBy("hash").agg(F.countDistinct("owner").alias("owners"), F.countDistinct("owner", "repository").alias("repositories"), F.sum("uses").alias("uses"))


def secrets(docs: DataFrame, owner: Column, repository: Column, example_owners: int = EXAMPLE_OWNERS,
            example_repositories: int | None = None) -> DataFrame:
    """Spans of secrets in every whole text, each with its ownership and class.

    Args:
        docs: `doc_id`, `text` and the columns that `owner` and `repository` name.
        example_owners: a value held by as many distinct owners is an example.
        example_repositories: so is one in as many distinct repositories; None leaves repositories out of it.

    Returns:
        One row per row of `docs`: `_row` (unique), `doc_id`, and `spans` of (start, kind, end, hash, owners,
        repositories, live), sorted. A null text has no span. Repeated rows are rows of their own.
    """
    scanned = scan(docs, owner, repository)
    owned = materialize(ownership(scanned))
    live = F.col("owners") < example_owners
    if example_repositories is not None:
        live = live & (F.col("repositories") < example_repositories)
    single = scanned.where(F.size("spans") > 0).select("_row", F.explode("spans").alias("span")).select("_row", "span.*")
    judged = single.join(owned.select("hash", "owners", "repositories", live.alias("live")), "hash")
    per_row = judged.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", "hash", "owners", "repositories", "live"))).alias("spans"))
    reported = F.filter("spans", lambda s: (s["kind"] < BASE) | s["live"])
    found = per_row.withColumn("spans", reported)
    return scanned.select("_row", "doc_id").join(found, "_row", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)))


def redact(docs: DataFrame, owner: str, repository: list[str], marker: str = "[SECRET]", **settings) -> DataFrame:
    """`docs` with its columns, live secrets replaced by a marker and `n_chars`, if there, counted anew.

    Args:
        owner, repository: the column of the owner, and the columns that together name the repository.

    Every row stays; rows without a candidate are passed on as they are.
    """
    docs, restore = shield(docs, "doc_id", "text", "n_chars", owner, *repository)
    holder, place = F.col(owner), F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repository])
    hit = F.size(candidates(F.coalesce(F.col("text"), F.lit("")))) > 0
    keyed = materialize(docs.where(hit).withColumn("_key", F.monotonically_increasing_id()))  # only these rows move
    named = keyed.withColumn("doc_id", F.col("_key"))
    found = secrets(named, holder, place, **settings).select(F.col("doc_id").alias("_key"), F.filter("spans", lambda s: s["live"]).alias("_live"))
    found = found.where(F.size("_live") > 0)
    joined = keyed.join(found, "_key", "left")
    text = F.when(F.col("_live").isNull(), F.col("text")).otherwise(spans.replaced(F.col("text"), F.col("_live"), lambda s: F.lit(marker)))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_live").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return restore(docs.where(~hit).unionByName(out.select(*docs.columns)))
