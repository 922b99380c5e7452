"""Topics, clusters and keywords on documents: lang and source stand for the given labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindings.registry import Tables, query
from plenary.operators import aggregates, bayes, communities, keywords, prompts, sets, topics
from plenary.plans.topic_labels import label_bills, label_unclustered
from bindings.texts import _PREPROCESSED

_GROUPING = '{"groups": [{"name": "a", "bills": [1, 3, 5, 0]}, {"name": "b", "bills": [3, 2, 4, 99999999]}, {"name": "c", "bills": []}]}'


def _docs(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("bill_id"), F.col("text").alias("content"), "lang", "source")


def _class_responses(t: Tables) -> DataFrame:
    """Labels as answers; Spanish documents have a broken one and thus the default class."""
    broken = F.concat(F.lit('{"category": "'), F.col("lang"))
    answer = F.when(F.col("lang") == "es", broken).otherwise(F.format_string(
        'Here: {"category": "%s", "subcategory": "%s", "confidence": 0.9}', "lang", "source"))
    return t.documents.select(F.col("doc_id").cast("string").alias("item_id"), F.lit(1).alias("attempt"),
                              answer.alias("text"), F.lit(None).cast("string").alias("error"))


def _group_responses(t: Tables) -> DataFrame:
    """The same grouping answer for every class, and none for German ones."""
    keys = t.documents.where("lang <> 'de'").select(
        F.when(F.col("lang") == "es", "기타_일반").otherwise(F.concat_ws("_", "lang", "source")).alias("item_id")).distinct()
    return keys.select("item_id", F.lit(1).alias("attempt"), F.lit(f"groups:\n{_GROUPING}\n").alias("text"),
                       F.lit(None).cast("string").alias("error"))


_TOPICS = """k AS (SELECT doc_id, lang, CASE WHEN lang = 'es' THEN '기타_일반' ELSE lang || '_' || source END AS topic_group FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY topic_group ORDER BY doc_id) AS pos, count(*) OVER (PARTITION BY topic_group) AS n FROM k),
g AS (SELECT doc_id, topic_group, CASE WHEN lang = 'de' THEN 9 WHEN pos IN (1, 3, 5) THEN 0 WHEN pos IN (2, 4) THEN 1 ELSE 9 END AS sub FROM p),
topics AS (SELECT doc_id, topic_group, (dense_rank() OVER (ORDER BY topic_group, sub) - 1)::BIGINT AS topic FROM g)"""


@query(f"WITH {_TOPICS} SELECT doc_id AS bill_id, topic_group, topic FROM topics")
def topic_groups(t):
    """Classes from answers, large ones split as answered, and stable cluster numbers."""
    docs = _docs(t).select("bill_id")
    return topics.cluster(docs, _class_responses(t), _group_responses(t)).select("bill_id", "topic_group", "topic")


@query("""SELECT doc_id AS bill_id, CASE WHEN lang = 'es' THEN '기타' ELSE lang END AS category,
  CASE WHEN lang = 'es' THEN '일반' ELSE source END AS subcategory,
  CASE WHEN lang = 'es' THEN 0.5 ELSE 0.9 END::DOUBLE AS confidence FROM documents""")
def topic_classes(t):
    """Category, subcategory and confidence from answers, the default class otherwise."""
    return topics.classify(_docs(t).select("bill_id"), _class_responses(t))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rn FROM documents)
SELECT lang || '_' || source AS topic, ((rn - 1) // 3)::INT AS page, string_agg(text, ' ' ORDER BY doc_id) AS sample_text,
  arg_min(n_chars, doc_id) AS sample_title FROM r GROUP BY ALL""")
def cluster_sample_text(t):
    """All texts of each cluster, three documents to a page."""
    docs = t.documents.select("doc_id", F.concat_ws("_", "lang", "source").alias("topic"),
                              F.col("text").alias("content"), F.col("n_chars").alias("title"))
    return prompts.cluster_samples(docs, "topic", "doc_id")


@query("""WITH r AS (SELECT lang || '_' || source AS topic, text, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rn FROM documents)
SELECT topic, ((rn - 1) // 15)::INT AS page, string_agg(rn || '. ' || text, chr(10) ORDER BY rn) AS titles FROM r GROUP BY ALL""")
def numbered_titles(t):
    """All titles of each class as the grouping task shows them, fifteen to a page."""
    docs = t.documents.select("doc_id", F.concat_ws("_", "lang", "source").alias("topic"), F.col("text").alias("title"))
    return prompts.numbered_titles(docs, "topic", "doc_id")


_WORDS = "regexp_extract_all(lower(text), '\\p{L}+')"
_SCORE = "round(c.n * ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + containing)), 6)"


def _cluster_terms(topic: str, source: str) -> str:
    return f"""w AS (SELECT {topic} AS topic, unnest(list_distinct({_WORDS})) AS term FROM {source}),
c AS (SELECT topic, term, count(*) AS n FROM w GROUP BY ALL),
d AS (SELECT term, sum(n) AS containing FROM c GROUP BY term),
s AS (SELECT topic, c.term, {_SCORE} AS score FROM c JOIN d ON c.term = d.term),
best AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS rn FROM s)"""


@query(f"WITH {_cluster_terms('lang', 'documents')} SELECT topic, term, score FROM best WHERE rn <= 4")
def cluster_keywords(t):
    """Four terms per cluster that many of its documents share and few others do."""
    docs = t.documents.select(F.col("lang").alias("topic"), F.col("text").alias("content"))
    return keywords.cluster_term_scores(docs, "topic")


@query(f"""WITH w AS (SELECT doc_id, unnest({_WORDS}) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS n FROM w GROUP BY ALL),
d AS (SELECT term, count(*) AS containing FROM c GROUP BY term),
s AS (SELECT doc_id, c.term, {_SCORE} AS score FROM c JOIN d ON c.term = d.term),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rn FROM s)
SELECT doc_id, term, score FROM best WHERE rn <= 4""")
def doc_keywords(t):
    """Four terms per document by count and rarity."""
    return keywords.doc_term_scores(t.documents.select("doc_id", F.col("text").alias("content")), "doc_id")


_COUNTED = f"""wd AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(list_zip(w[:-2], w[2:])) AS z FROM wd WHERE len(w) > 1),
pr AS (SELECT doc_id, z[1] AS a, z[2] AS b FROM p),
n AS (SELECT a, b, count(*)::DOUBLE AS n FROM pr GROUP BY ALL),
t AS (SELECT sum(n) AS t FROM n), fa AS (SELECT a, sum(n) AS na FROM n GROUP BY a), fb AS (SELECT b, sum(n) AS nb FROM n GROUP BY b),
x AS (SELECT a, b, n, [[n, na * nb / t], [na - n, na * (t - nb) / t], [nb - n, (t - na) * nb / t], [t - na - nb + n, (t - na) * (t - nb) / t]] AS cells
  FROM n JOIN fa USING (a) JOIN fb USING (b), t WHERE n >= 2),
phrases AS (SELECT a || ' ' || b AS phrase, n::BIGINT AS n, round(CASE WHEN n > cells[1][2] THEN 2 * list_sum(list_transform(cells,
  lambda c: CASE WHEN c[1] > 0 THEN c[1] * ln(greatest(c[1], 1.0) / greatest(c[2], 1e-9)) ELSE 0 END)) ELSE 0 END, 6) AS ratio FROM x),
kept AS (SELECT * FROM phrases WHERE ratio >= 10.83)"""


@query(f"WITH {_COUNTED} SELECT phrase, n, round(ratio, 3) AS ratio FROM kept")
def key_phrases(t):
    """Neighbouring terms that meet more often than chance, by log-likelihood ratio."""
    found = keywords.phrase_scores(t.documents.select(F.col("text").alias("content")), stop=())
    return found.withColumn("ratio", F.round("ratio", 3))


@query(f"""WITH {_COUNTED},
w AS (SELECT doc_id, unnest(w) AS term FROM wd UNION ALL SELECT doc_id, a || ' ' || b FROM pr WHERE a || ' ' || b IN (SELECT phrase FROM kept)),
c AS (SELECT doc_id, term, count(*) AS n FROM w GROUP BY ALL),
d AS (SELECT term, count(*) AS containing FROM c GROUP BY term),
s AS (SELECT doc_id, c.term, {_SCORE} AS score FROM c JOIN d ON c.term = d.term),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rn FROM s)
SELECT doc_id, term, score FROM best WHERE rn <= 4""")
def doc_key_phrases(t):
    """Four terms or phrases per document by count and rarity."""
    return keywords.doc_phrase_scores(t.documents.select("doc_id", F.col("text").alias("content")), "doc_id", stop=())


@query(f"""WITH {_TOPICS},
t AS (SELECT doc_id, topic, text FROM topics JOIN documents USING (doc_id)), {_cluster_terms('topic', 't')},
labels AS (SELECT topic, string_agg(term, ', ' ORDER BY rn) AS label FROM best WHERE rn <= 4 GROUP BY topic)
SELECT doc_id AS bill_id, lang AS title, {_PREPROCESSED} AS content, topic, coalesce(label, '법안, 개정, 정책, 시행') AS topic_label
FROM documents JOIN topics USING (doc_id) LEFT JOIN labels USING (topic)""")
def topic_labels(t):
    """The whole topic job: cleaned text, cluster number and keyword label of every bill."""
    docs = _docs(t).select("bill_id", F.col("lang").alias("title"), "content")
    return label_bills(docs, _class_responses(t), _group_responses(t))


@query("""WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
SELECT doc_id AS bill_id, CASE WHEN quality IS NULL THEN -(i + 2) ELSE quality END::BIGINT AS topic,
  CASE WHEN lang = 'en' THEN source || ', law' ELSE '법안, 개정, 정책, 시행' END AS topic_label
FROM documents JOIN n USING (doc_id) LEFT JOIN labels USING (doc_id)""")
def single_doc_topics(t):
    """Documents outside every cluster get a number and a label of their own."""
    docs = t.documents.join(t.labels, "doc_id", "left").select(
        F.col("doc_id").alias("bill_id"), F.coalesce(F.col("quality").cast("bigint"), F.lit(-1)).alias("topic"))
    answers = t.documents.select(
        F.col("doc_id").cast("string").alias("item_id"), F.lit(1).alias("attempt"),
        F.when(F.col("lang") == "en", F.format_string('["%s", "law"]', "source")).otherwise("none").alias("text"),
        F.lit(None).cast("string").alias("error"))
    return label_unclustered(docs, answers)


_SUMMARY = """SELECT lang || '_' || source AS topic, count(text) AS document_count, arg_min(n_chars, doc_id) AS topic_label
FROM documents GROUP BY 1"""


def _topic_summary(t: Tables) -> DataFrame:
    docs = t.documents.select(F.concat_ws("_", "lang", "source").alias("topic"), F.col("text").alias("title"),
                              F.col("n_chars").alias("topic_label"), F.col("doc_id").alias("bill_id"))
    return aggregates.topic_summary(docs)


@query(_SUMMARY)
def topic_summary(t):
    """Documents per topic and the label of the first, largest topic first."""
    return _topic_summary(t)


@query(f"{_SUMMARY} ORDER BY document_count DESC, topic LIMIT 10")
def topic_summary_top(t):
    """The ten largest topics."""
    return sets.head(_topic_summary(t), 10, [F.desc("document_count"), "topic"])


@query("SELECT count(DISTINCT lang || '_' || source) AS topics FROM documents")
def topic_count(t):
    return aggregates.topic_count(t.documents.withColumn("topic", F.concat_ws("_", "lang", "source")))


@query("SELECT doc_id, true AS in_range FROM documents")
def topic_kmeans(t):
    """Topics without answers, hashed tf-idf and k-means: one per document, numbered within range."""
    found = topics.kmeans_topics(t.documents.select("doc_id", F.col("text").alias("content")), "doc_id", k=8)
    return found.select("doc_id", F.coalesce(F.col("topic").between(0, 7), F.lit(False)).alias("in_range"))


_BAYES = f"""wd AS (SELECT doc_id, lang, doc_id % 5 <> 0 AS labelled, unnest({_WORDS}) AS term FROM documents),
c AS (SELECT doc_id, lang, labelled, term, count(*) AS n FROM wd GROUP BY ALL),
m AS (SELECT term, lang AS category, sum(n)::DOUBLE AS nc FROM c WHERE labelled AND lang IS NOT NULL GROUP BY ALL),
ta AS (SELECT term, sum(nc) AS na FROM m GROUP BY term),
tot AS (SELECT sum(na) AS t, count(*) AS v FROM ta),
r AS (SELECT category, any_value(t) - sum(nc) + any_value(v) AS rest FROM m, tot GROUP BY category),
l AS (SELECT doc_id, sum(n) AS words FROM c JOIN ta USING (term) GROUP BY doc_id),
f AS (SELECT doc_id, category, sum(n * ln((na - nc + 1) / (na + 1))) AS fit FROM c JOIN m USING (term) JOIN ta USING (term) GROUP BY ALL),
s AS (SELECT doc_id, category, words, words * ln(rest) - fit AS score FROM f JOIN r USING (category) JOIN l USING (doc_id))"""


@query(f"WITH {_BAYES} SELECT doc_id, category, words::BIGINT AS words, round(round(score, 6), 3) AS score FROM s")
def bayes_scores(t):
    """How well each document fits each language's class, learnt from four in five documents by complement naive Bayes."""
    docs = t.documents.select("doc_id", F.col("text").alias("content"))
    labels = t.documents.where("doc_id % 5 <> 0").select("doc_id", F.col("lang").alias("category"))
    scores = bayes.complement_scores(bayes.term_counts(docs, "doc_id", stop=()), labels, "doc_id")
    return scores.withColumn("score", F.round("score", 3))


@query(f"""WITH {_BAYES}, b AS (SELECT doc_id, arg_max(category, (round(score, 6), category)) AS category FROM s GROUP BY doc_id)
SELECT documents.doc_id AS bill_id, CASE WHEN doc_id % 5 <> 0 AND lang IS NOT NULL THEN lang ELSE coalesce(b.category, '기타') END AS category
FROM documents LEFT JOIN b USING (doc_id)""")
def learnt_topic_classes(t):
    """Classes from answers, and learnt ones for the fifth of the documents that has no answer."""
    docs = _docs(t).select("bill_id", "content")
    answered = _class_responses(t).where(F.col("item_id").cast("bigint") % 5 != 0)
    named = t.documents.select(F.col("doc_id").cast("string").alias("item_id"), "lang", "source")
    answer = F.format_string('{"category": "%s", "subcategory": "%s", "confidence": 0.9}', "lang", "source")
    answered = answered.join(named, "item_id").withColumn("text", answer).where(F.col("lang").isNotNull()).drop("lang", "source")
    classified = topics.classify(docs.select("bill_id"), answered)
    return bayes.fill_classes(docs, classified).select("bill_id", "category")


@query()
def title_communities(t):
    """Classes split into communities of titles that share rare terms; the first words of a text are its title."""
    title = F.regexp_extract("text", r"^\s*(?:\S+\s+){0,11}\S+", 0)
    docs = t.documents.select(F.col("doc_id").alias("bill_id"), F.concat_ws("_", "lang", "source").alias("topic_group"), title.alias("title"))
    return communities.title_subgroups(docs)
