"""Topic representations: representative documents, keyword aspects, labels."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.functions import text as T
from review_topics.functions import vectors as X
from review_topics.operators import inference, terms, zeroshot
from review_topics.operators.embedding import embed
from review_topics.session import broadcast_checked, hot_lookup, stage

CANDIDATES = 30


def representative_docs(
    lists: DataFrame, assignments: DataFrame, weights: DataFrame, n: int = V.LABEL_DOCUMENTS
) -> DataFrame:
    """``(topic_id, rank, doc_id, score)``: documents whose terms are closest to their topic's c-TF-IDF.

    ``lists`` holds the documents' term counts; a word that a large topic uses everywhere is a hot key of the join.
    """
    topics = broadcast_checked(assignments.select("doc_id", "topic_id"), terms.MAX_BROADCAST)
    placed = lists.join(topics, "doc_id").select("doc_id", "topic_id", F.inline("terms"))
    known = weights.agg(F.max("doc_freq").alias("most"), F.sum("doc_freq").alias("total")).first().asDict()
    pairs = hot_lookup(placed, weights.select("topic_id", "term", "weight", "doc_freq"), ["topic_id", "term"], "doc_freq", known)
    sums = pairs.groupBy("doc_id", "topic_id").agg(
        F.sum(F.col("tf") * F.col("weight")).alias("dot"), F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("doc_norm")
    )
    scored = sums.join(broadcast_checked(topic_norms(weights)), "topic_id").withColumn(
        "score", F.col("dot") / (F.col("doc_norm") * F.col("topic_norm"))
    )
    return terms.ranked(scored, "score", n, "doc_id").select("topic_id", "rank", "doc_id", "score")


def topic_norms(weights: DataFrame) -> DataFrame:
    return weights.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("topic_norm"))


def with_documents(representative: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts of the chosen documents; a handful of ids per topic, so the texts are filtered, not shuffled."""
    ids = broadcast_checked(representative, 10 * V.LABEL_DOCUMENTS * 1_000)
    return docs.select("doc_id", "document").join(ids, "doc_id").select("topic_id", "rank", "doc_id", "document", "score")


def trigram_text(term: Column) -> Column:
    """Letter trigrams of a term as a text, so that related word forms get related hashed vectors."""
    padded = F.concat(F.lit("_"), term, F.lit("_"))
    last = F.greatest(F.length(padded) - 2, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(padded, i, 3)), " ")


def embed_terms(candidates: DataFrame, encoder, text: Callable[[Column], Column] = lambda term: term) -> DataFrame:
    """``candidates`` with the vector of each distinct term."""
    distinct = candidates.select("term").distinct()
    docs = distinct.select(F.col("term").alias("doc_id"), text(F.col("term")).alias("document"))
    vecs = embed(docs, encoder).withColumnRenamed("doc_id", "term")
    return candidates.join(vecs, "term", "left")


def mmr(
    candidates: DataFrame, encoder, diversity: float = V.MMR_DIVERSITY, top_n: int = 10, aspect: str = "MMR"
) -> DataFrame:
    """Diversified keywords: each next term weighs its relevance against its likeness to those already chosen.

    All ranked ``candidates`` of a topic are weighed, so the caller's ``top_terms`` bounds a group.
    Relevance is the weight relative to the topic's best.
    """
    with_vectors = embed_terms(candidates, encoder, trigram_text)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank").reset_index(drop=True)
        relevance = (group["weight"] / group["weight"].max()).to_numpy()
        width = max((len(v) for v in group["vec"] if v is not None), default=1)
        matrix = np.array([v if v is not None else np.zeros(width) for v in group["vec"]])
        likeness = np.round(matrix @ matrix.T, 9)
        chosen = [0]
        while len(chosen) < min(top_n, len(group)):
            score = (1 - diversity) * relevance - diversity * likeness[:, chosen].max(axis=1)
            score[chosen] = -np.inf
            chosen.append(int(np.argmax(np.round(score, 9))))
        out = group.loc[chosen, ["topic_id", "term", "weight"]]
        return out.assign(aspect=aspect, rank=range(1, len(chosen) + 1))[["topic_id", "aspect", "rank", "term", "weight"]]

    return with_vectors.select("topic_id", "rank", "term", "weight", "vec").groupBy("topic_id").applyInPandas(
        choose, "topic_id int, aspect string, rank int, term string, weight double"
    )


def keybert_terms(
    candidates: DataFrame, representative_vecs: DataFrame, encoder, top_n: int = 10, aspect: str = "KeyBERT"
) -> DataFrame:
    """Candidates ranked by the cosine between the term's vector and the mean vector of the topic's chosen documents.

    ``representative_vecs`` is ``(topic_id, vec)``, a few rows per topic.
    """
    means = X.group_means(representative_vecs, "topic_id").withColumnRenamed("vec", "topic_vec")
    terms_in = embed_terms(candidates.drop("weight", "rank", "aspect"), encoder)
    scored = terms_in.join(means, "topic_id").withColumn("weight", X.cosine(F.col("vec"), F.col("topic_vec")))
    scored = scored.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    best = terms.ranked(scored, "weight", top_n, "term")
    return best.select("topic_id", F.lit(aspect).alias("aspect"), "rank", "term", "weight")


def classify_topics(topic_vecs: DataFrame, prototypes: DataFrame, min_prob: float = 0.8) -> DataFrame:
    """``(topic_id, label, similarity)``: the candidate label closest to each topic's mean vector, if close enough."""
    docs = topic_vecs.withColumnRenamed("topic_id", "doc_id")
    found = zeroshot.assign_zero_shot(docs, prototypes, min_prob).withColumnRenamed("doc_id", "topic_id")
    return found.join(broadcast_checked(prototypes.select("idx", "label")), "idx", "left").select(
        "topic_id", "label", "similarity"
    )


def default_labels(top: DataFrame) -> DataFrame:
    """``(topic_id, label)``: the id and its first four words joined by underscores."""
    first = top.where(F.col("rank") <= 4).groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("w"))
    return first.select(
        "topic_id", F.concat_ws("_", F.col("topic_id").cast("string"), F.transform("w", lambda x: x["term"])).alias("label")
    )


def topic_words(top: DataFrame) -> DataFrame:
    """``(topic_id, words)``: terms of one aspect in rank order, joined by commas."""
    listed = top.groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("w"))
    return listed.select("topic_id", F.array_join(F.transform("w", lambda x: x["term"]), ", ").alias("words"))


def label_prompts(top: DataFrame, documents: DataFrame, template: str = V.LABEL_PROMPT) -> DataFrame:
    """``(topic_id, prompt)``: the label question with the topic's documents and keywords filled in."""
    texts = documents.groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("rank", "document"))).alias("d"))
    lines = F.array_join(F.transform("d", lambda x: F.concat(F.lit("- "), x["document"])), "\n")
    filled = T.fill_template(template, {"[DOCUMENTS]": F.coalesce(lines, F.lit("")), "[KEYWORDS]": F.col("words")})
    return topic_words(top).join(texts, "topic_id", "left").select("topic_id", filled.alias("prompt"))


def llm_labels(
    prompts: DataFrame, provider, aspect: str = "AI_Generated", ledger: str | None = None, backoff=V.BACKOFF_SECONDS
) -> DataFrame:
    """One generated label per topic as an aspect row; a topic without a reply has none."""
    requests = prompts.select(F.col("topic_id").cast("long").alias("id"), F.col("prompt").alias("request"))
    replies = inference.infer_with_retries(requests, provider, ledger, backoff=backoff)
    done = inference.latest_replies(replies).where((F.col("status") == "ok") & F.col("content").isNotNull())
    return done.select(
        F.col("id").cast("int").alias("topic_id"),
        F.lit(aspect).alias("aspect"),
        F.lit(1).alias("rank"),
        T.clean_label(F.col("content")).alias("term"),
        F.lit(1.0).alias("weight"),
    )


def run_aspects(start: DataFrame, aspects: dict[str, list[Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Every aspect is a chain of steps from one terms table to the next; the last table carries the aspect's name."""
    out = start
    for name, steps in aspects.items():
        table = start
        for step in steps:
            table = step(table)
        out = out.unionByName(table.withColumn("aspect", F.lit(name)).select(start.columns))
    return stage(out, "aspects")
