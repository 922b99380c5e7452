"""PII: information-theoretic sanitisation, in DataFrame functions alone.

Protected entities are e-mail and IP addresses, card and phone numbers. Corpus co-occurrence tells how much of an
entity's information a nearby term gives away: pointwise mutual information over the entity's own information,
    log2(joint * N / (n_entity * n_term)) / log2(N / n_entity)
with n_entity the documents that hold the entity near a word, n_term the documents that hold the term, joint those
in which the term stands near the entity, and N all documents. It is 1 if the term occurs nowhere but near the
entity, and 0 if the two are independent. Beyond one threshold a term is generalised to its kind, beyond a higher
one it is removed. Terms are only touched where they stand near the entity that they reveal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plenary.llm import spans
from plenary.llm.columns import shield
from plenary.operators.index import materialize

KINDS = ["email", "ip", "card", "phone", "term"]
TERM = 4
_PRIOR = r"(?:\G|(?<![A-Za-z0-9._%+-]))"  # an address starts where a stretch of its characters does, or right after a match
EMAIL = _PRIOR + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"\p{L}{2,}"

WINDOW = 80  # characters before and after an entity
CELL = 256  # characters of a stretch in which words and entities meet
GENERALISE, REMOVE, SUPPORT = 0.6, 0.9, 2


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """12 to 19 digits whose Luhn sum ends in 0."""
    digits = F.split(F.reverse(_digits(value)), "")
    weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    total = F.aggregate(weighed, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return F.length(_digits(value)).between(12, 19) & (total % 10 == 0)


def _is_ip(value: Column) -> Column:
    plain = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(plain, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))


def entities(text: Column) -> Column:
    """Base spans of a text, sorted by start and kind."""
    phone_digits = lambda v: F.length(_digits(v)).between(9, 15)
    return F.array_sort(F.concat(
        spans.find(text, 0, EMAIL, screen=text.contains("@")), spans.find(text, 1, IP, _is_ip),
        spans.find(text, 2, CARD, luhn), spans.find(text, 3, PHONE, phone_digits, screen=text.contains("+"))))


def scan(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, spans, words): the entities of every text, and the words of texts that hold one, stored.

    Entities carry the hash of their kind and value. Words that overlap an entity are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("_text"), entities(text).alias("found"))
    words = spans.apart(spans.find(F.col("_text"), TERM, WORD), F.col("found"))
    terms = F.transform(words, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), F.xxhash64(F.lower(w["value"])).alias("term")))
    named = F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.xxhash64(s["kind"], F.lower(s["value"])).alias("entity")))
    return materialize(found.select(F.monotonically_increasing_id().alias("_row"), "doc_id", named.alias("spans"), F.when(F.size("found") > 0, terms).alias("words")))


def nearby(scanned: DataFrame, window: int = WINDOW) -> DataFrame:
    """(_row, entity, term, start, end) of whole words within `window` characters of an entity, stored.

    Words and entities meet by stretches of CELL characters, so their number in a text does not matter.
    """
    held = scanned.where(F.size("spans") > 0)
    cell = lambda at: F.floor(at / CELL).cast("bigint")
    words = held.select("_row", F.explode("words").alias("w")).select("_row", "w.*").withColumn("cell", cell(F.col("start")))
    around = held.select("_row", F.explode("spans").alias("s")).select(
        "_row", F.col("s.entity").alias("entity"), F.greatest(F.col("s.start") - window, F.lit(0)).alias("low"), (F.col("s.end") + window).alias("high"))
    around = around.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    pairs = around.join(words, ["_row", "cell"]).where((F.col("start") >= F.col("low")) & (F.col("end") <= F.col("high")))
    return materialize(pairs.select("_row", "entity", "term", "start", "end"))


def term_documents(docs: DataFrame) -> DataFrame:
    """(term, n_term): in how many documents each word occurs, over all whole texts; words by their 64-bit hash."""
    words = F.array_distinct(F.transform(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))


def disclosure(near: DataFrame, terms: DataFrame, documents: int, support: int = SUPPORT) -> DataFrame:
    """(entity, term, ratio) for pairs found together in at least `support` documents."""
    pairs = near.select("_row", "entity", "term").distinct()
    joint = materialize(pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("joint")).where(F.col("joint") >= support))
    held = near.select("_row", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    whole = F.lit(float(max(documents, 1)))
    gain = F.log2(F.col("joint") * whole / (F.col("n_entity") * F.greatest("n_term", "joint")))
    own = F.log2(whole / F.col("n_entity"))
    rows = joint.join(terms, "term").join(held, "entity")
    return rows.select("entity", "term", F.when(own > 0, gain / own).otherwise(0.0).alias("ratio"))


def personal_data(docs: DataFrame, window: int = WINDOW, generalise: float = GENERALISE, remove: float = REMOVE,
                  support: int = SUPPORT) -> DataFrame:
    """Entities, and terms that reveal them, in every whole text.

    Args:
        docs: `doc_id` and `text`; other columns are ignored.
        generalise, remove: least ratios at which a term is generalised, or removed.
        support: a pair seen in fewer documents proves nothing.

    Returns:
        One row per row of `docs`: `_row`, `doc_id`, `spans` (base spans) and `terms` (start, kind, end, ratio),
        both sorted. A null or empty text has none. Repeated rows count as documents of their own.
    """
    scanned = scan(docs)
    documents = scanned.count()
    near = nearby(scanned, window)
    revealed = materialize(disclosure(near, term_documents(docs), documents, support).where(F.col("ratio") >= generalise))
    flagged = near.join(revealed, ["entity", "term"]).groupBy("_row", "start", "end").agg(F.max("ratio").alias("ratio"))
    per_row = flagged.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(TERM).alias("kind"), "end", "ratio"))).alias("terms"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,ratio:double>>")
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return scanned.select("_row", "doc_id", plain.alias("spans")).join(per_row, "_row", "left").withColumn("terms", F.coalesce("terms", none))


def sanitise(docs: DataFrame, remove: float = REMOVE, **settings) -> DataFrame:
    """`docs` with entities replaced by their kind, terms by `[TERM]`, and the most telling terms taken out.

    Every row and column stays; a null text stays null.
    """
    docs, restore = shield(docs, "doc_id", "text")
    keyed = materialize(docs.withColumn("_key", F.monotonically_increasing_id()))
    found = personal_data(keyed.select(F.col("_key").alias("doc_id"), "text"), remove=remove, **settings)
    both = F.concat(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(0.0).alias("ratio"))), F.col("terms"))
    changed = found.select(F.col("doc_id").alias("_key"), F.array_sort(both).alias("_spans")).where(F.size("_spans") > 0)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    marker = lambda s: F.when(s["ratio"] >= remove, "").otherwise(F.get(names, s["kind"]))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(spans.replaced(F.col("text"), F.col("_spans"), marker))
    return restore(keyed.join(changed, "_key", "left").withColumn("text", text))
