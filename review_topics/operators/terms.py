"""Term counts and class-based TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_topics.session import broadcast_checked, stage

# Scores are compared at this many places, then by name, so that equal scores rank the same everywhere.
PLACES = 9
# Documents whose topics are broadcast, about 20 MB.
MAX_BROADCAST = 1_000_000


def topic_terms(lists: DataFrame, assignments: DataFrame) -> DataFrame:
    """``(topic_id, term, tf, doc_freq)`` from the documents' term lists and ``(doc_id, topic_id)``.

    Topics of up to MAX_BROADCAST documents go to where the lists are read; those of more meet them in a shuffle. Each task
    adds up its own documents before the shuffle. Written once: topic totals, hot keys and weights all
    read it, and it is far smaller than the text.
    """
    counts = (
        lists.join(broadcast_checked(assignments.select("doc_id", "topic_id"), MAX_BROADCAST), "doc_id")
        .select("topic_id", F.inline("terms"))
        .groupBy("topic_id", "term")
        .agg(F.sum("tf").alias("tf"), F.count("*").alias("doc_freq"))
    )
    return stage(counts, "topic-terms")


def moved_terms(counts: DataFrame, lists: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """``counts`` of the assignments ``before`` as they are with those of ``after``, from the documents that moved alone.

    A moved document takes its counts off its old topic and adds them to the new one; a document that is only in one of the
    two assignments comes or goes. Changes are added up before they meet the counts. Terms that no document of a topic has any
    more are left out, so the result is that of topic_terms.
    """
    moves = before.select("doc_id", F.col("topic_id").alias("old")).join(after.select("doc_id", F.col("topic_id").alias("new")), "doc_id", "full")
    moves = moves.where(~F.col("old").eqNullSafe(F.col("new")))
    sides = F.array(F.struct(F.col("old").alias("topic_id"), F.lit(-1).alias("sign")), F.struct(F.col("new").alias("topic_id"), F.lit(1).alias("sign")))
    signed = lists.join(broadcast_checked(stage(moves, "moves"), MAX_BROADCAST), "doc_id").select(F.explode(sides).alias("side"), "terms").where("side.topic_id is not null")
    changes = signed.select("side.topic_id", "side.sign", F.inline("terms")).groupBy("topic_id", "term")
    changes = changes.agg(F.sum(F.col("sign") * F.col("tf")).alias("tf"), F.sum("sign").cast("long").alias("doc_freq"))
    whole = counts.select("topic_id", "term", "tf", "doc_freq").unionByName(changes).groupBy("topic_id", "term")
    return stage(whole.agg(F.sum("tf").alias("tf"), F.sum("doc_freq").alias("doc_freq")).where("doc_freq > 0"), "topic-terms")


def ctfidf(counts: DataFrame) -> DataFrame:
    """``counts`` with ``weight``: share of the topic's words times ln(1 + mean topic length / term total)."""
    totals = counts.groupBy("topic_id").agg(F.sum("tf").alias("topic_tf"))
    mean_length = totals.agg(F.avg("topic_tf")).scalar()
    term_tf = F.sum("tf").over(Window.partitionBy("term"))
    return (
        counts.withColumn("term_tf", term_tf)
        .join(broadcast_checked(totals), "topic_id")
        .withColumn("weight", F.col("tf") / F.col("topic_tf") * F.log(1 + mean_length / F.col("term_tf")))
        .select("topic_id", "term", "tf", "doc_freq", "weight")
    )


def ranked(rows: DataFrame, by: str, top_n: int, tie: str) -> DataFrame:
    """Best ``top_n`` rows per topic with ``rank`` 1.. .

    Filtering on the rank lets Spark keep only ``top_n`` rows per topic and task before the shuffle, so a topic
    holding a third of all rows does not meet in one task.
    """
    order = Window.partitionBy("topic_id").orderBy(F.round(by, PLACES).desc(), F.col(tie))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def top_terms(weights: DataFrame, top_n: int = 10, aspect: str = "Main") -> DataFrame:
    """``(topic_id, aspect, rank, term, weight)``."""
    best = ranked(weights, "weight", top_n, "term")
    return best.select("topic_id", F.lit(aspect).alias("aspect"), "rank", "term", "weight")
