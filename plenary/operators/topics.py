"""Topic classes, their subgroups and stable cluster numbers."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, IDF, Normalizer
from pyspark.sql import DataFrame, functions as F

from plenary.functions.jsons import classification, subgroups
from plenary.operators.dedup import first_per_key
from plenary.operators.index import dense_index, group_position, materialize
from plenary.operators.keywords import tokens
from plenary.session import part_count, spread

_REST = 2**31 - 1  # sorts after every subgroup an answer names


def classify(docs: DataFrame, responses: DataFrame, key: str = "bill_id") -> DataFrame:
    """Category, subcategory and confidence of each document, defaults where no answer parses.

    Of the answers to the parts of a long text (with a `part`), the most confident one counts, of equal ones the earliest.
    """
    answers = responses.where(F.col("error").isNull()).withColumn(
        key, F.col("item_id").cast(docs.schema[key].dataType))
    order = ["attempt", "text"]
    if "part" in responses.columns:
        answers = first_per_key(answers, [key, "part"], order).withColumn("_sure", classification(F.coalesce("text", F.lit("")))["confidence"])
        order = [F.desc("_sure"), "part"]
    first = first_per_key(answers, [key], order).select(key, F.col("text").alias("_answer"))
    parsed = classification(F.coalesce("_answer", F.lit("")))
    return (
        docs.join(first, key, "left")
        .withColumn("_class", parsed)
        .withColumns({f: F.col(f"_class.{f}") for f in ("category", "subcategory", "confidence")})
        .drop("_class", "_answer")
    )


def group_key(docs: DataFrame, name: str = "topic_group") -> DataFrame:
    return docs.withColumn(name, F.concat_ws("_", "category", "subcategory"))


def subgroup_mentions(responses: DataFrame, sizes: DataFrame, group: str = "topic_group") -> DataFrame:
    """(group, position, subgroup) of the positions that grouping answers name.

    An answer lists 1-based positions in the group's order. Positions outside the group are ignored
    and the first mention of a document counts.
    """
    answers = first_per_key(
        responses.where(F.col("error").isNull()).withColumnRenamed("item_id", group), [group], ["attempt", "text"])
    named = (
        answers.join(sizes, group)
        .select(group, "n", F.posexplode(subgroups(F.col("text"))).alias("subgroup", "g"))
        .select(group, "n", "subgroup", F.posexplode("g.bills").alias("mention", "position"))
        .where(F.col("position").between(1, F.col("n")))
    )
    return first_per_key(named, [group, "position"], ["subgroup", "mention"]) \
        .select(group, F.col("position").cast("bigint").alias("position"), "subgroup")


def assign_subgroups(members: DataFrame, responses: DataFrame, key: str = "bill_id",
                     group: str = "topic_group") -> DataFrame:
    """(key, group, subgroup): groups split as answered, whatever their size; the others whole.

    Documents no subgroup names form the last subgroup of their group; a group without any usable
    mention therefore stays whole. `members` is a stored (key, group) table.
    """
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    mentions = materialize(subgroup_mentions(responses, sizes, group))
    asked = materialize(mentions.select(group).distinct())
    named = group_position(
        members.join(asked, group), [group], [key],
    ).join(mentions, [group, "position"]).select(key, "subgroup")
    return members.join(named, key, "left").withColumn("subgroup", F.coalesce("subgroup", F.lit(_REST)))


def number_clusters(subgrouped: DataFrame, key: str = "bill_id", group: str = "topic_group",
                    name: str = "topic") -> DataFrame:
    """(key, group, cluster id): ids 0, 1, 2, … in the order of (group, subgroup)."""
    ids = dense_index(subgrouped.select(group, "subgroup").distinct(), [group, "subgroup"], name)
    return subgrouped.join(ids, [group, "subgroup"]).drop("subgroup")


def cluster(docs: DataFrame, class_responses: DataFrame, group_responses: DataFrame, key: str = "bill_id") -> DataFrame:
    """(key, topic_group, topic) of each document, as a stored table."""
    members = materialize(group_key(classify(docs.select(key), class_responses, key)).select(key, "topic_group"))
    subgrouped = materialize(assign_subgroups(members, group_responses, key))
    return materialize(number_clusters(subgrouped, key))


def kmeans_topics(docs: DataFrame, key: str, text: str = "content", k: int = 16, features: int = 1 << 12,
                  iterations: int = 10, seed: int = 42, name: str = "topic") -> DataFrame:
    """Topics without any answers: hashed tf-idf vectors and k-means.

    Term hashing keeps the model at k x features numbers however many terms the texts hold.
    """
    words = spread(docs, key).select(key, tokens(F.col(text)).alias("words"))
    counts = HashingTF(inputCol="words", outputCol="tf", numFeatures=features).transform(words).select(key, "tf")
    # Texts are taken apart once; fits and the transform read the vectors. Stored, these are a tenth of what they are in
    # memory, so they are dealt by the size of the texts, not by that of their files.
    counts = materialize(counts).repartition(part_count(docs), key)
    pipeline = Pipeline(stages=[
        IDF(inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol="features"),
        KMeans(k=k, seed=seed, maxIter=iterations, predictionCol=name),
    ])
    return pipeline.fit(counts).transform(counts).select(key, name)
