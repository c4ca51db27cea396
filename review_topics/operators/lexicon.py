"""Intent extraction without a model: aspect words and polarity words per sentence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_topics.functions import text as T

SENTENCE_END = r"[.!?\n]+"
ENTITY_PATTERN = r"(\p{Lu}[\p{L}\p{N}]+)"

# Word lists for airline reviews; callers pass their own for other domains.
ASPECTS = {
    "Check-in and Boarding": ["check", "boarding", "gate", "queue"],
    "Seating Comfort": ["seat", "seats", "seating", "legroom"],
    "Food and Beverage": ["food", "meal", "drink", "drinks"],
    "Flight Attendants and Crew Services": ["crew", "attendant", "attendants", "staff"],
    "Baggage Handling": ["baggage", "luggage", "bag", "bags"],
    "Flight Disruptions and Delays": ["delay", "delayed", "cancelled", "missed"],
}
POLARITY = {
    "smooth": 1, "polite": 1, "helpful": 1, "friendly": 1, "good": 1, "great": 1, "comfortable": 1,
    "cramped": -1, "below": -1, "rude": -1, "dirty": -1, "bad": -1, "delayed": -1, "lost": -1, "ignored": -1,
}


def _count_in(words: Column, wanted: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(wanted)))


def sentence_rows(df: DataFrame, column: str = "Review") -> DataFrame:
    """One row per non-empty sentence, numbered in order."""
    sentences = F.filter(F.transform(F.split(F.col(column), SENTENCE_END), lambda s: F.trim(s)), lambda s: s != "")
    return df.select("id", F.posexplode(sentences).alias("sentence", "text_summary"))


def extract_intents_lexicon(
    df: DataFrame,
    aspects: dict[str, list[str]] | None = None,
    polarity: dict[str, int] | None = None,
    column: str = "Review",
) -> DataFrame:
    """``(id, intent, text_summary, sentiment, named_entities)``: one row per sentence and aspect it mentions.

    Both word lists are small parameters of the plan, so the whole extraction is one narrow pass over the reviews.
    """
    aspects = ASPECTS if aspects is None else aspects
    polarity = POLARITY if polarity is None else polarity
    words = F.col("_words")
    rows = sentence_rows(df, column).withColumn("_words", T.tokens(F.col("text_summary")))
    named = F.array(*[F.when(F.arrays_overlap(words, F.array(*[F.lit(t) for t in terms])), F.lit(name)) for name, terms in aspects.items()])
    values = sorted(set(polarity.values()))
    weights = [_count_in(words, [w for w, p in polarity.items() if p == value]) * value for value in values]
    score = reduce(lambda a, b: a + b, weights, F.lit(0))
    sentiment = F.when(score > 0, "Positive").when(score < 0, "Negative").otherwise("Neutral")
    entities = F.regexp_extract_all("text_summary", F.lit(ENTITY_PATTERN), F.lit(1))
    return rows.select(
        "id",
        "sentence",
        F.explode(F.array_compact(named)).alias("intent"),
        "text_summary",
        sentiment.alias("sentiment"),
        entities.alias("named_entities"),
    )


def intents_as_replies(intents: DataFrame) -> DataFrame:
    """Extracted intents of one review as the reply a model would give: ``(id, payload)``."""
    item = F.struct("sentence", F.struct("intent", "text_summary", "sentiment", "named_entities").alias("item"))
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"])
    return intents.groupBy("id").agg(F.to_json(F.struct(ordered.alias("intents"))).alias("payload"))
