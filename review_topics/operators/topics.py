"""Topic numbering, labels, outliers, merging and the labelled result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.operators.components import components
from review_topics.session import broadcast_checked, hot_lookup, stage_counted

# Topics whose names or numbers are broadcast, about 100 MB.
MAX_NAMED = 500_000


def unite_assignments(zero_shot: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(doc_id, kind, source, probability)``: every document once.

    ``zero_shot`` is ``(doc_id, idx, similarity)`` for all documents; ``clusters`` is ``(doc_id, cluster,
    probability)`` for those it left open. A document in neither is an outlier with probability 0.
    """
    assigned = zero_shot.where(F.col("idx").isNotNull()).select(
        "doc_id", F.lit("predefined").alias("kind"), F.col("idx").cast("string").alias("source"), F.col("similarity").alias("probability")
    )
    open_docs = zero_shot.where(F.col("idx").isNull()).select("doc_id").join(clusters, "doc_id", "left")
    found = F.col("cluster").isNotNull()
    discovered = open_docs.select(
        "doc_id",
        F.when(found, "cluster").otherwise("outlier").alias("kind"),
        F.col("cluster").cast("string").alias("source"),
        F.when(found, F.col("probability")).otherwise(F.lit(0.0)).alias("probability"),
    )
    return assigned.unionByName(discovered)


def number_topics(united: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``(topic_id, kind, source, label, size)``: used predefined topics in list order, then clusters by size, -1 last.

    Ordered without a partition, which is fine for a table of topics; the documents never take part.
    """
    sizes = united.groupBy("kind", "source").agg(F.count("*").alias("size"))
    listed = F.col("kind") == "predefined"
    # Length before text puts numbers in numeric order and works for ids of any type.
    rank = [~listed, F.when(listed, F.col("source").try_cast("long")).otherwise(-F.col("size")), F.length("source"), F.col("source")]
    topics = sizes.where(F.col("kind") != "outlier").withColumn("topic_id", (F.row_number().over(Window.orderBy(*rank)) - 1).cast("int"))
    outliers = sizes.where(F.col("kind") == "outlier").withColumn("topic_id", F.lit(-1))
    table = topics.unionByName(outliers)
    if labels is None:
        return table.withColumn("label", F.lit(None).cast("string")).select("topic_id", "kind", "source", "label", "size")
    names = labels.select(F.lit("predefined").alias("kind"), F.col("idx").cast("string").alias("source"), "label")
    return table.join(broadcast_checked(names), ["kind", "source"], "left").select("topic_id", "kind", "source", "label", "size")


def combine_topics(zero_shot: DataFrame, clusters: DataFrame, labels: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(assignments, topics)`` with final topic ids; outliers and other large topics are hot keys of the lookup."""
    united = unite_assignments(zero_shot, clusters)
    topics, known = stage_counted(number_topics(united, labels), "size")
    ids = topics.select("kind", F.coalesce("source", F.lit("")).alias("key"), "topic_id", "size")
    keyed = united.select("doc_id", "probability", "kind", F.coalesce("source", F.lit("")).alias("key"))
    return hot_lookup(keyed, ids, ["kind", "key"], "size", known).select("doc_id", "topic_id", "probability"), topics


def topic_labels(generated: DataFrame, topics: DataFrame) -> DataFrame:
    """``(topic_id, label)``: predefined label where there is one, generated otherwise."""
    fixed = topics.select("topic_id", F.col("label").alias("fixed"))
    return generated.join(fixed, "topic_id", "left").select("topic_id", F.coalesce("fixed", "label").alias("label"))


def aspect_labels(terms: DataFrame, aspect: str = "AI_Generated") -> DataFrame:
    """``(topic_id, label)``: the first term of one aspect, such as the generated label."""
    return terms.where((F.col("aspect") == aspect) & (F.col("rank") == 1)).select("topic_id", F.col("term").alias("label"))


def set_topic_labels(labels: DataFrame, custom: DataFrame) -> DataFrame:
    """Custom ``(topic_id, label)`` over the given ones; topic -1 always gets the fixed outlier label."""
    own = custom.select("topic_id", F.col("label").alias("own"))
    label = F.when(F.col("topic_id") == -1, V.OUTLIER_LABEL).otherwise(F.coalesce("own", "label"))
    return labels.join(own, "topic_id", "left").select("topic_id", label.alias("label"))


def get_topic(terms: DataFrame, topic_id: int, aspect: str = "Main") -> DataFrame:
    """``(rank, term, weight)`` of one topic."""
    return terms.where((F.col("topic_id") == topic_id) & (F.col("aspect") == aspect)).select("rank", "term", "weight").orderBy("rank")


def topic_info(assignments: DataFrame, labels: DataFrame, terms: DataFrame, representative: DataFrame) -> DataFrame:
    """One row per topic: size, name, a map from aspect to its terms, and the representative documents."""
    sizes = assignments.groupBy("topic_id").agg(F.count("*").alias("n_docs"))
    aspects = terms.groupBy("topic_id", "aspect").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("w"))
    by_topic = aspects.groupBy("topic_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("aspect", F.transform("w", lambda x: x["term"]).alias("words"))))).alias("aspects")
    )
    docs = representative.groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("d"))
    return (
        sizes.join(labels.withColumnRenamed("label", "name"), "topic_id", "left")
        .join(by_topic, "topic_id", "left")
        .join(docs, "topic_id", "left")
        .select("topic_id", "n_docs", "name", "aspects", F.transform("d", lambda x: x["doc_id"]).alias("representative_docs"))
    )


def label_documents(assignments: DataFrame, labels: DataFrame) -> DataFrame:
    """Topic columns beside every document; names of up to MAX_NAMED topics are broadcast."""
    return assignments.join(broadcast_checked(labels, MAX_NAMED), "topic_id", "left")


def labelled_result(assignments: DataFrame, docs: DataFrame, names: DataFrame, ai_names: DataFrame) -> DataFrame:
    """``topic_id, probability, topic_name, llm_topic_name, document`` for every document."""
    both = names.select("topic_id", F.col("label").alias("topic_name")).join(
        ai_names.select("topic_id", F.col("label").alias("llm_topic_name")), "topic_id", "left"
    )
    return label_documents(docs.select("doc_id", "document").join(assignments, "doc_id"), both).select(
        "topic_id", "probability", "topic_name", "llm_topic_name", "document"
    )


def reduce_outliers(assignments: DataFrame, distribution: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Outliers move to their strongest topic of ``(doc_id, topic_id, p)``; all other documents stay.

    A moved document gets the probability of its new topic.
    """
    strongest = F.max_by(F.struct("topic_id", "p"), F.struct(F.round("p", 9), -F.col("topic_id")))
    best = distribution.where(F.round("p", 9) >= threshold).groupBy("doc_id").agg(strongest.alias("best"))
    moved = (F.col("topic_id") == -1) & F.col("best").isNotNull()
    return assignments.join(best, "doc_id", "left").select(
        "doc_id",
        F.when(moved, F.col("best.topic_id")).otherwise(F.col("topic_id")).alias("topic_id"),
        F.when(moved, F.col("best.p")).otherwise(F.col("probability")).alias("probability"),
    )


def merge_map(merges: DataFrame, topics: DataFrame, n: int) -> DataFrame:
    """``(topic_id, merged_id)``: the single-linkage cut of ``(step, left, right, distance)`` that leaves ``n`` topics.

    The earliest merges are carried out; what they connect becomes one topic named by its smallest id.
    """
    total = topics.where(F.col("topic_id") >= 0).count()
    done = merges.where(F.col("step") <= max(total - n, 0))
    joined = components(done.select(F.col("left").alias("u"), F.col("right").alias("v")))
    merged = topics.select("topic_id").join(joined.withColumnRenamed("node", "topic_id"), "topic_id", "left")
    return merged.select("topic_id", F.coalesce("component", "topic_id").alias("merged_id"))


def reduce_topics(assignments: DataFrame, merged: DataFrame) -> DataFrame:
    """Assignments under the merged topic ids."""
    return label_documents(assignments, merged).select("doc_id", F.col("merged_id").alias("topic_id"), "probability")
