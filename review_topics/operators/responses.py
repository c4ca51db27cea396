"""Model replies to typed intent rows; everything refused is kept with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics import schemas
from review_topics.functions import variants as J

REQUIRED = ["intent", "text_summary", "sentiment"]


def response_payload(df: DataFrame) -> DataFrame:
    """One ``payload`` row per tool call, or the plain content when there was no tool call."""
    calls = F.when(F.size("tool_args") > 0, F.col("tool_args")).otherwise(F.array("content"))
    others = [c for c in df.columns if c not in ("tool_args", "content")]
    return df.select(*others, F.posexplode(calls).alias("call", "payload"))


def parse_responses(df: DataFrame) -> DataFrame:
    """One row per element of ``intents``, and one row with ``parse_status`` other than ``ok`` for a reply without any.

    Input ``(id, payload)``. Elements that are not objects come out as ``not_an_object``; the good elements beside
    them are kept.
    """
    parsed = df.withColumn("_reply", J.strict_object(F.col("payload")))
    parsed = parsed.withColumn("_list", F.try_variant_get("_reply", "$.intents", "variant"))
    parsed = parsed.withColumn(
        "_elements", F.when(J.is_array(F.col("_list")), F.try_variant_get("_list", "$", "array<variant>"))
    )
    reply_status = (
        F.when(F.col("payload").isNull(), "no_reply")
        .when(F.col("_reply").isNull(), "invalid_json")
        .when(F.col("_list").isNull(), "no_intents_key")
        .when(F.col("_elements").isNull(), "intents_not_a_list")
        .when(F.size("_elements") == 0, "no_intents")
    )
    kept = [c for c in df.columns if c != "payload"]
    rows = parsed.select(
        *kept, "payload", reply_status.alias("_status"), F.posexplode_outer("_elements").alias("intent_pos", "_element")
    )
    element = F.col("_element")
    good = F.col("_status").isNull() & J.is_object(element)
    status = F.coalesce("_status", F.when(J.is_object(element), "ok").otherwise("not_an_object"))
    text = F.coalesce(F.when(element.isNotNull(), F.to_json(element)), F.col("payload"))

    def field(name: str, kind: str) -> Column:
        return F.when(good, F.try_variant_get(element, f"$.{name}", kind))

    def typed(name: str, check) -> Column:
        value = F.try_variant_get(element, f"$.{name}", "variant")
        return F.when(good, F.coalesce(check(value), F.lit(False)))

    return rows.select(
        *kept,
        F.coalesce("intent_pos", F.lit(0)).alias("intent_pos"),
        status.alias("parse_status"),
        text.alias("llm_response"),
        *[field(name, "string").alias(name) for name in REQUIRED],
        field("named_entities", "array<string>").alias("named_entities"),
        F.when(good, F.array(*[typed(name, J.is_string) for name in REQUIRED])).alias("required_are_strings"),
    )


def validate_intents(parsed: DataFrame) -> DataFrame:
    """Add ``reject_reason`` by the tool schema: required strings present, sentiment one of the three values."""
    reason = F.when(F.col("parse_status") != "ok", F.col("parse_status"))
    for i, name in enumerate(REQUIRED):
        reason = reason.when(F.col(name).isNull(), f"missing_{name}")
        reason = reason.when(~F.col("required_are_strings")[i], f"{name}_not_a_string")
    reason = reason.when(~F.col("sentiment").isin(V.SENTIMENTS), "unknown_sentiment")
    return parsed.withColumn("reject_reason", reason)


def response_report(rows: DataFrame) -> DataFrame:
    """How many rows ended in each status."""
    return rows.groupBy("parse_status", "reject_reason").agg(F.count("*").alias("n_rows"))


def attach_reviews(intents: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review columns beside each intent; every intent is kept."""
    return reviews.join(intents, "id", "right")


def zip_responses(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """Requests beside their replies by key; position plays no part."""
    return requests.join(replies, "id", "left")


def na_drop(df: DataFrame, mode: str = "strict") -> DataFrame:
    """``strict`` drops rows with any null, ``required`` only those without a required field."""
    if mode == "strict":
        return df.na.drop("any")
    if mode == "required":
        return df.na.drop("any", subset=REQUIRED)
    raise ValueError("mode is 'strict' or 'required'")


def to_intents_schema(df: DataFrame) -> DataFrame:
    """Project, rename and cast by name to the intents table."""
    return df.select(*schemas.intents_columns(df))
