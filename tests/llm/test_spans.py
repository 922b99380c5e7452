"""Secrets and personal data beside a plain reading of the patterns with Python's own engine."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from plenary.llm import pii, queries, secrets, spans
from tests.llm.fixtures import no_documents, odd_documents, odd_rows

OWNER = ("source", "lang")
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return sorted(found + [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15])


def by_text(rows, value):
    return sorted((str(r[0]), tuple(value(r))) for r in rows)


def test_base_secrets_of_odd_texts(spark):
    got = secrets.secrets(odd_documents(spark), *map(F.col, OWNER)).collect()
    seen = by_text([(r.doc_id, r.spans) for r in got], lambda r: [(s.start, s.kind, s.end) for s in r[1] if s.kind < 3])
    assert seen == by_text([(r[0], r[1] or "") for r in odd_rows()], lambda r: base_secrets(r[1]))


def test_base_personal_data_of_odd_texts(spark):
    got = pii.personal_data(odd_documents(spark)).collect()
    seen = by_text([(r.doc_id, r.spans) for r in got], lambda r: [(s.start, s.kind, s.end) for s in r[1]])
    assert seen == by_text([(r[0], r[1] or "") for r in odd_rows()], lambda r: base_personal(r[1]))


def test_many_matches_in_one_text(spark):
    text = "AKIA" + "B" * 16 + " " + " ".join(f"u{i}@h.co" for i in range(300)) + "7" * 5000 + " 1" * 4000
    df = spark.createDataFrame([(1, text, None, "s")], "doc_id int, text string, lang string, source string")
    assert [(s.start, s.kind, s.end) for s in secrets.secrets(df, *map(F.col, OWNER)).first().spans] == base_secrets(text)
    assert [(s.start, s.kind, s.end) for s in pii.personal_data(df).first().spans] == base_personal(text)


@pytest.mark.parametrize("count", [30000])
def test_time_in_proportion_to_the_matches(spark, count):
    text = " ".join(f"u{i}@h.co wort" for i in range(count // 2)) + " " + " ".join(f"token=abcdef{i % 10}é" for i in range(count // 2))
    df = spark.createDataFrame([(1, text, None, "s")], "doc_id int, text string, lang string, source string")
    begin = time.time()
    found = secrets.secrets(df, *map(F.col, OWNER)).first().spans
    assert [(s.start, s.kind, s.end) for s in found if s.kind < 3] == base_secrets(text)
    assert [(s.start, s.kind, s.end) for s in pii.personal_data(df).first().spans] == base_personal(text)
    clean = df.select(spans.replaced(F.col("text"), pii.entities(F.col("text")), lambda s: F.lit("[X]")).alias("t")).first().t
    assert clean == re.sub(r"u[0-9]+@h\.co", "[X]", text)
    assert time.time() - begin < 150


def test_spans_beside_plain_loops(spark):
    rng = random.Random(5)
    for _ in range(4):
        cut = lambda n: sorted((a, a + rng.randint(1, 9)) for a in rng.sample(range(900), n))
        some, others = cut(150), cut(70)
        text = "".join(rng.choice("aé😀 ") for _ in range(920))
        schema = "t string, some array<struct<start:bigint,kind:int,end:bigint,value:string>>, others array<struct<start:bigint,kind:int,end:bigint,value:string>>"
        rows = [(text, [(a, 0, b, text[a:b]) for a, b in some], [(a, 1, b, "") for a, b in others])]
        got = spark.createDataFrame(rows, schema).select(
            spans.apart(F.col("some"), F.col("others")).alias("apart"), spans.replaced(F.col("t"), F.col("some"), lambda s: F.lit("<>")).alias("t")).first()
        assert [(s.start, s.end) for s in got.apart] == [(a, b) for a, b in some if not any(a < d and c < b for c, d in others)]
        out, at = "", 0
        for a, b in some:
            if a >= at:
                out, at = out + text[at:a] + "<>", b
        assert got.t == out + text[at:]


def test_ownership_tells_examples_from_live_values(spark):
    shared, single = "Zq8fT2mK9xL4vB7nR1wY", "Pw3kD8sJ5hG2cV6zX9tM"
    rows = [(i, f"use {shared} here", "en", f"s{i}") for i in range(4)] + [(9, f"use {single} here", "en", "s9"), (10, f"and {single}", "en", "s9")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    found = {r.doc_id: r.spans for r in secrets.secrets(df, *map(F.col, OWNER)).collect()}
    assert all(found[i] == [] for i in range(4))
    assert [(s.kind, s.owners, s.live) for s in found[9]] == [(3, 1, True)] and found[10][0].repositories == 1
    redacted = {r.doc_id: r.text for r in secrets.redact(df, "source", ["source", "lang"]).collect()}
    assert redacted[9] == "use [SECRET] here" and redacted[0] == rows[0][1]


def test_redaction_keeps_rows_and_columns(spark):
    docs = odd_documents(spark)
    out = secrets.redact(docs, "source", ["source", "lang"])
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text like '%AKIA%'").isEmpty() and out.where("text is null").count() == 1
    assert out.where("n_chars <> length(text)").isEmpty()


def test_terms_that_reveal_an_entity(spark):
    rows = [(i, "our agent wolframite answers at agent7@desk.org for the house", "x") for i in range(3)]
    rows += [(10 + i, "the house of our agent answers for the rest of it", "x") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, text string, terms string")
    found = {r.doc_id: r for r in pii.personal_data(df).collect()}
    words = {rows[0][1][t.start:t.end] for t in found[0].terms}
    assert "wolframite" in words and not words & {"the", "for", "our", "agent"}
    assert all(found[10 + i].terms == [] for i in range(60))
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    text = {r.doc_id: r.text for r in clean.collect()}
    assert "[EMAIL]" in text[0] and "wolframite" not in text[0] and text[10] == rows[3][1]


def test_empty_tables(spark):
    none = no_documents(spark)
    assert secrets.secrets(none, *map(F.col, OWNER)).isEmpty() and pii.personal_data(none).isEmpty()
    assert secrets.redact(none, "source", ["lang"]).isEmpty() and pii.sanitise(none).isEmpty()


@pytest.mark.parametrize("kind", ["secrets", "personal"])
def test_written_spans_and_digest(spark, kind):
    docs = odd_documents(spark)
    if kind == "secrets":
        names, found, base = secrets.KINDS, secrets.secrets(docs, *map(F.col, OWNER)), base_secrets
    else:
        names, found, base = pii.KINDS, pii.personal_data(docs), base_personal
    limit = len(names) - 1
    out = found.select("doc_id", queries._digest(spans.written(F.filter("spans", lambda s: s["kind"] < limit), names)).alias("d")).collect()
    want = sorted((str(r[0]), hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in base(r[1] or "")).encode()).hexdigest()) for r in odd_rows())
    assert sorted((str(r.doc_id), r.d) for r in out) == want
