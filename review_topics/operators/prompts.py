"""Extraction prompts and chat requests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.functions import text as T

CONSTANTS = {
    "{format_instructions}": json.dumps(V.FORMAT_INSTRUCTIONS),
    "{example_output}": json.dumps(V.EXAMPLE_OUTPUT),
}


def prompt_text(review: Column, template: str = V.EXTRACTION_PROMPT, constants: dict[str, str] | None = None) -> Column:
    filled = T.literal_template(template, CONSTANTS if constants is None else constants)
    return T.fill_template(filled, {"{review}": review})


def render_prompt(
    df: DataFrame,
    template: str = V.EXTRACTION_PROMPT,
    constants: dict[str, str] | None = None,
    column: str = "Review",
) -> DataFrame:
    """Add ``prompt``: instructions, output format, worked example and the review."""
    return df.withColumn("prompt", prompt_text(F.col(column), template, constants))


def chat_request(
    df: DataFrame,
    model: str,
    system: str = V.SYSTEM_MESSAGE,
    max_tokens: int = V.MAX_TOKENS,
    temperature: float = V.TEMPERATURE,
    tools: list | None = None,
    column: str = "prompt",
) -> DataFrame:
    """Add ``request``: the JSON body of one chat call."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    body = F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.array(message("system", F.lit(system)), message("user", F.col(column))).alias("messages"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
        )
    )
    if tools is not None:
        without_brace = F.left(body, F.length(body) - 1)
        body = F.concat(without_brace, F.lit(f',"tools":{json.dumps(tools)}}}'))
    return df.withColumn("request", body)
