"""Sampling, row ids, pre-filters and chunking of reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_topics.functions import text as T

# Copies of one row numbered by one task; more copies are numbered by several tasks.
COPIES_PER_TASK = 10_000


def sample_n(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly ``n`` rows in a repeatable random order.

    Ordering by a hash and limiting is a top-k: each task keeps its own best ``n`` and only those move.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(order, F.col(key)).limit(n)


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """``row_id`` from the source key, or from the row's content when it has none.

    Without a key, equal rows are counted first and then numbered 1..count, which is the same as numbering the
    copies themselves. A row copied very often is therefore one counted row in the shuffle, and its copies are
    written out by several tasks.
    """
    if key is not None:
        return df.withColumn("row_id", F.col(key).cast("string"))
    columns = df.columns
    content = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}))
    counted = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("_copies"))
    blocks = counted.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES_PER_TASK).cast("int")))
    ).withColumn("_content", content)
    numbered = blocks.repartition("_content", "_block").withColumn(
        "_copy",
        F.explode(
            F.sequence(
                F.col("_block").cast("long") * COPIES_PER_TASK + 1,
                F.least(F.col("_copies"), (F.col("_block").cast("long") + 1) * COPIES_PER_TASK),
            )
        ),
    )
    return numbered.select(
        *[F.col(f"`{c}`") for c in columns], F.concat_ws("-", "_content", F.col("_copy").cast("string")).alias("row_id")
    )


def review_reason(review: Column, min_chars: int, max_chars: int | None) -> Column:
    """Why a review is not worth a model call; null when it is."""
    length = F.length(F.trim(review))
    reason = F.when(review.isNull(), "missing").when(length == 0, "empty").when(length < min_chars, "too_short")
    return reason.when(length > max_chars, "too_long") if max_chars is not None else reason


def prefilter_reviews(
    df: DataFrame, min_chars: int = 1, max_chars: int | None = None, column: str = "Review"
) -> DataFrame:
    """Every review with ``reject_reason``; split on null to get the accepted and the rejected ones."""
    return df.withColumn("reject_reason", review_reason(F.col(column), min_chars, max_chars))


def chunk_reviews(df: DataFrame, max_tokens: int, overlap: int = 0, column: str = "Review") -> DataFrame:
    """Long reviews as overlapping chunks of at most ``max_tokens`` words, one row per chunk."""
    if not 0 <= overlap < max_tokens:
        raise ValueError("overlap must be at least 0 and below max_tokens")
    step = max_tokens - overlap
    split = df.withColumn("_words", T.words(F.col(column)))
    last_start = F.greatest(F.size("_words") - F.lit(overlap) - 1, F.lit(0))
    starts = F.sequence(F.lit(0), last_start, F.lit(step))
    chunks = F.transform(starts, lambda s: F.array_join(F.slice(F.col("_words"), s + 1, max_tokens), " "))
    return split.select(*df.columns, F.posexplode(chunks).alias("chunk", "chunk_text"))


def truncate_tokens(df: DataFrame, n: int, column: str = "document") -> DataFrame:
    """First ``n`` words of each document, for model calls with a token budget."""
    return df.withColumn(column, F.array_join(F.slice(T.words(F.col(column)), 1, n), " "))
