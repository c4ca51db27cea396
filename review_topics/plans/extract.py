"""Reviews to intents: sample, filter, ask, parse, validate, attach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.operators import inference, prompts, responses, reviews
from review_topics.session import stage


def extract_intents(
    table: DataFrame,
    provider,
    model: str,
    sample: int | None = None,
    seed: int = 42,
    min_chars: int = 1,
    max_chars: int | None = None,
    mode: str = "strict",
    ledger: str | None = None,
    max_in_flight: int = V.MAX_IN_FLIGHT,
    backoff: tuple[float, float] | None = V.BACKOFF_SECONDS,
    slice_rows: int = inference.SLICE_ROWS,
    calls_per_task: int = 1,
    chunk_words: int | None = None,
    chunk_overlap: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """``(intents, rejects)`` of a review table with ``id`` and ``Review``; ids keep their type.

    With ``chunk_words`` longer reviews are asked about in overlapping chunks; what comes back carries the review's id.
    All reviews are read unless ``sample`` asks for some. Every review id ends in one of the two: rejects say why a review, a reply or an intent was left out.
    """
    picked = reviews.sample_n(table, sample, "id", seed) if sample else table
    checked = stage(reviews.prefilter_reviews(picked, min_chars, max_chars), "reviews")
    accepted = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    refused = checked.where(F.col("reject_reason").isNotNull()).select("id", F.lit("review").alias("stage"), F.col("reject_reason").alias("reason"))

    asked = accepted
    if chunk_words is not None:
        chunks = reviews.chunk_reviews(accepted.select("id", "Review"), chunk_words, chunk_overlap)
        asked = chunks.select(F.concat_ws(":", "id", "chunk").alias("id"), F.col("chunk_text").alias("Review"))
    requests = prompts.chat_request(prompts.render_prompt(asked), model, tools=V.TOOLS).select("id", "request")
    replies = inference.infer_with_retries(requests, provider, ledger, V.MAX_ATTEMPTS, max_in_flight, backoff, slice_rows, calls_per_task)
    last = inference.latest_replies(replies)
    if chunk_words is not None:
        whole_id = F.regexp_replace("id", ":[0-9]+$", "").cast(accepted.schema["id"].dataType)
        last = last.withColumn("id", whole_id)
    failed = last.where(F.col("status") != "ok").select("id", F.lit("call").alias("stage"), F.col("status").alias("reason"))

    payloads = responses.response_payload(last.where(F.col("status") == "ok").select("id", "tool_args", "content"))
    valid = stage(responses.validate_intents(responses.parse_responses(payloads)), "intents")
    wrong = valid.where(F.col("reject_reason").isNotNull()).select("id", F.lit("reply").alias("stage"), F.col("reject_reason").alias("reason"))
    whole = responses.to_intents_schema(responses.attach_reviews(valid.where(F.col("reject_reason").isNull()), accepted))
    intents = responses.na_drop(whole, mode)
    return intents, refused.unionByName(failed).unionByName(wrong).unionByName(_incomplete(whole, mode))


def _incomplete(whole: DataFrame, mode: str) -> DataFrame:
    """Rows ``na_drop`` leaves out, with their reason."""
    columns = whole.columns if mode == "strict" else responses.REQUIRED
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in columns])
    return whole.where(missing.isNotNull()).select("id", F.lit("intent").alias("stage"), missing.alias("reason"))
