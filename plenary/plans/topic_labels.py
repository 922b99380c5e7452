"""Topics and keyword labels for a bill table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plenary.functions import lexicon
from plenary.operators.keywords import as_keyword_list, cluster_term_scores, keyword_label, \
    keywords_from_responses, single_topics
from plenary.operators.index import materialize
from plenary.operators.project import select_present
from plenary.operators.topics import cluster
from plenary.plans.bills import preprocess_bills
from plenary.session import spread

LABEL_COLUMNS = ("age", "title", "bill_id", "bill_number", "content", "topic", "topic_label")


def label_bills(bills: DataFrame, class_responses: DataFrame, group_responses: DataFrame,
                keyword_responses: DataFrame | None = None, key: str = "bill_id") -> DataFrame:
    """Cleaned bills with a topic number and its four keywords.

    Classes and keywords come from the original text. Without keyword responses the keywords are the
    cluster's own best terms.
    """
    topics = cluster(bills, class_responses, group_responses, key).select(key, "topic")
    if keyword_responses is None:
        texts = bills.select(key, "content").join(topics, key)
        keywords = as_keyword_list(cluster_term_scores(texts, "topic"), "topic")
    else:
        keywords = keywords_from_responses(topics.select("topic").distinct(), keyword_responses, "topic")
    # One row per cluster, stored: its counted size decides how it is joined.
    labels = materialize(keywords.select("topic", keyword_label(F.col("keywords")).alias("topic_label")))
    labelled = topics.join(labels, "topic", "left")
    labelled = preprocess_bills(spread(bills, key)).join(labelled, key, "left")
    default = ", ".join(lexicon.DEFAULT_KEYWORDS)
    labelled = labelled.withColumn("topic_label", F.coalesce("topic_label", F.lit(default)))
    return select_present(labelled, LABEL_COLUMNS)


def label_unclustered(bills: DataFrame, keyword_responses: DataFrame, key: str = "bill_id") -> DataFrame:
    """Bills outside every cluster get a topic number and label of their own."""
    numbered = single_topics(bills, key)
    answered = keywords_from_responses(numbered.drop("topic_label"), keyword_responses, key)
    return answered.withColumn("topic_label", keyword_label(F.col("keywords"))).drop("keywords")
