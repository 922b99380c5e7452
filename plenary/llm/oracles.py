"""DuckDB SQL for the operators that it can express."""

from __future__ import annotations

from plenary.llm import pii, secrets


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(?:\.[0-9]+){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])+"


def _found(patterns: list[str]) -> str:
    """CTEs that end in `found(doc_id, source, kind, s, e, v)`: all matches with their places."""
    parts = " UNION ALL ".join(
        f"SELECT doc_id, source, {k} AS kind, regexp_extract_all(text, {_text(p)}) AS m, string_split_regex(text, {_text(p)}) AS g "
        f"FROM documents WHERE regexp_matches(text, {_text(p)})" for k, p in enumerate(patterns))
    return f"""cut AS ({parts}),
each AS (SELECT doc_id, source, kind, m, g, unnest(range(1, len(m) + 1)) AS i FROM cut),
placed AS (SELECT doc_id, source, kind, m[i] AS v, (list_sum(list_transform(g[1:i], lambda x: length(x)))
  + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::BIGINT AS s FROM each),
found AS (SELECT *, s + length(v) AS e FROM placed)"""


def _names(kinds: list[str]) -> str:
    return "['" + "','".join(kinds) + "']"


SECRETS = f"""WITH {_found([ASSIGN, secrets.ACCESS, secrets.HEX, secrets.OPAQUE])},
named AS (SELECT * FROM found WHERE kind IN (1, 2) OR kind = 0 AND length(regexp_extract(v, {_text(ASSIGN)}, 1)) >= 6),
opaque AS (SELECT * FROM found AS f WHERE kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
  AND NOT EXISTS (SELECT 1 FROM named AS n WHERE n.doc_id = f.doc_id AND n.s < f.e AND f.s < n.e)),
spans AS (SELECT *, CASE WHEN kind = 0 THEN regexp_extract(v, {_text(ASSIGN)}, 1) ELSE v END AS value FROM (FROM named UNION ALL FROM opaque)),
owned AS (SELECT value, count(DISTINCT coalesce('=' || source, '')) AS owners FROM spans GROUP BY value),
judged AS (SELECT s.*, owners < {secrets.EXAMPLE_OWNERS} AS live, {_names(secrets.KINDS)}[kind + 1] || ':' || s || ':' || e AS shown
  FROM spans AS s JOIN owned USING (value)),
reported AS (SELECT * FROM judged WHERE kind < {secrets.BASE} OR live),
per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(shown, ',' ORDER BY s, kind) FILTER (kind < {secrets.BASE}) AS base, string_agg(shown, ',' ORDER BY s, kind) AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM reported GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents LEFT JOIN per USING (doc_id)"""

_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse({_DIGITS})[i]::INT
  ELSE reverse({_DIGITS})[i]::INT * 2 - CASE WHEN reverse({_DIGITS})[i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""

PERSONAL = f"""WITH {_found([EMAIL, IP, CARD, pii.PHONE])},
base AS (SELECT * FROM found WHERE kind = 0
  OR kind = 1 AND len(list_filter(string_split(v, '.'), lambda p: length(ltrim(p, '0')) > 3 OR (CASE WHEN length(ltrim(p, '0')) BETWEEN 1 AND 3 THEN ltrim(p, '0')::INT ELSE 0 END) > 255)) = 0
  OR kind = 2 AND length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}
  OR kind = 3 AND length({_DIGITS}) BETWEEN 9 AND 15),
words AS (SELECT doc_id, regexp_extract_all(text, '{pii.WORD}') AS m, string_split_regex(text, '{pii.WORD}') AS g FROM documents WHERE doc_id IN (SELECT doc_id FROM base)),
word AS (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM words),
placed_word AS (SELECT doc_id, m[i] AS v, sum(length(g[i]) + length(m[i])) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS te FROM word),
near AS (SELECT b.doc_id, kind, lower(b.v) AS v, lower(w.v) AS term, te - length(w.v) AS ts, te FROM base AS b JOIN placed_word AS w
  ON b.doc_id = w.doc_id AND te - length(w.v) >= greatest(b.s - {pii.WINDOW}, 0) AND te <= b.e + {pii.WINDOW}),
apart AS (SELECT * FROM near AS n WHERE NOT EXISTS (SELECT 1 FROM base AS b WHERE b.doc_id = n.doc_id AND b.s < n.te AND n.ts < b.e)),
joint AS (SELECT kind, v, term, count(DISTINCT doc_id) AS joint FROM apart GROUP BY kind, v, term HAVING joint >= {pii.SUPPORT}),
held AS (SELECT kind, v, count(DISTINCT doc_id) AS n_entity FROM apart GROUP BY kind, v),
terms AS (SELECT term, count(*) AS n_term FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{pii.WORD}'))) AS term FROM documents) GROUP BY term),
total AS (SELECT count(*)::DOUBLE AS n FROM documents),
ratio AS (SELECT kind, v, term, CASE WHEN log2(n / n_entity) > 0 THEN log2(joint * n / (n_entity * greatest(n_term, joint))) / log2(n / n_entity) ELSE 0 END AS ratio
  FROM joint JOIN terms USING (term) JOIN held USING (kind, v), total),
flagged AS (SELECT DISTINCT doc_id, ts, te FROM apart JOIN ratio USING (kind, v, term) WHERE ratio >= {pii.GENERALISE}),
shown AS (SELECT doc_id, kind, s, {_names(pii.KINDS)}[kind + 1] || ':' || s || ':' || e AS shown FROM base
  UNION ALL SELECT doc_id, {pii.TERM}, ts, 'term:' || ts || ':' || te FROM flagged),
per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card,
  count(*) FILTER (kind = 3) AS n_phone, count(*) FILTER (kind = {pii.TERM}) AS n_term,
  string_agg(shown, ',' ORDER BY s, kind) FILTER (kind < {pii.TERM}) AS base, string_agg(shown, ',' ORDER BY s, kind) AS spans FROM shown GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_term, 0) AS n_term
FROM documents LEFT JOIN per USING (doc_id)"""

_UNIFORM = "('0x' || substr(sha256({}), 1, 13))::BIGINT / 4503599627370496.0"

MIXING = f"""WITH s AS (SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source),
t AS (SELECT source, size, CASE WHEN size > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS w FROM s),
r AS (SELECT source, CASE WHEN size > 0 THEN w / (SELECT sum(w) FROM t) * (SELECT sum(size) FROM t) / size ELSE 0.0 END AS rate FROM t),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM r),
c AS (SELECT source, rate, sum(exp(-rate + k * ln(greatest(rate, 1e-300)) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS step FROM k),
d AS (SELECT *, {_UNIFORM.format("'20|' || coalesce(doc_id::VARCHAR, '')")} AS u FROM documents),
n AS (SELECT doc_id, text, lang, d.source, n_chars, any_value(rate) AS rate, count(*) AS times FROM d JOIN c ON c.source IS NOT DISTINCT FROM d.source AND step <= u GROUP BY ALL),
x AS (SELECT * EXCLUDE (times), unnest(range(1, times + 1))::INT AS copy FROM n)
SELECT *, {_UNIFORM.format("'21|' || coalesce(doc_id::VARCHAR, '') || '|' || copy")} AS shuffle_key FROM x"""

TOP_K = """WITH usable AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, min(list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT)) AS ints FROM usable GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.ints::DOUBLE[], v.ints::DOUBLE[])::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10"""

# CRC-32 bit by bit, over the decimal digits of an id.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii(({0})[i])::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _grown(nodes: str, leaves: str) -> str:
    """A recursive CTE of all nodes over the leaves (tree, level, pos, n, d)."""
    return f"""{nodes} AS ({leaves} UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM {nodes} WHERE n > 1 GROUP BY tree, level, n, pos // 3)"""


def _folded(fold: str, nodes: str, start: str) -> str:
    """A recursive CTE that takes (k, tree, level, pos, n, f, proof) to the root of its tree."""
    return f"""{fold} AS ({start} UNION ALL
  SELECT k, c.tree, c.level + 1, c.pos // 3, (c.n + 2) // 3, sha256(string_agg(CASE WHEN o.pos = c.pos THEN f ELSE d END, '' ORDER BY o.pos)),
    any_value(proof) || coalesce(string_agg(d, '' ORDER BY o.pos) FILTER (o.pos <> c.pos), '')
  FROM {fold} AS c JOIN {nodes} AS o ON o.tree = c.tree AND o.level = c.level AND o.pos // 3 = c.pos // 3 WHERE c.n > 1 GROUP BY k, c.tree, c.level, c.pos, c.n)"""


MERKLE = f"""WITH RECURSIVE leaf AS (SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY tree) AS n FROM (SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC.format("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other FROM documents)),
{_grown("node", "SELECT tree, 0 AS level, pos, n, leaf AS d FROM leaf")},
sub AS (SELECT tree AS name, d, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
{_grown("top", "SELECT '*' AS tree, 0 AS level, pos, n, d FROM sub")},
{_folded("inner_fold", "node", "SELECT k, tree, 0 AS level, pos, n, other AS f, '' AS proof FROM leaf")},
{_folded("outer_fold", "top", "SELECT k, '*' AS tree, 0 AS level, s.pos, s.n, f, proof FROM inner_fold AS i JOIN sub AS s ON s.name = i.tree WHERE i.n = 1")}
SELECT doc_id, leaf, sub.d AS subroot, top.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = top.d AS verified
FROM leaf JOIN sub ON sub.name = leaf.tree JOIN outer_fold AS o ON o.k = leaf.k AND o.n = 1 JOIN top ON top.n = 1"""
