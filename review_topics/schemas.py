"""Explicit schemas at every stage boundary."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTENT = T.StructType(
    [
        T.StructField("intent", T.StringType()),
        T.StructField("text_summary", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("named_entities", T.ArrayType(T.StringType())),
    ]
)


INTENTS_TABLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("Airline_Name", T.StringType()),
        T.StructField("Overall_Rating", T.StringType()),
        T.StructField("Review_Title", T.StringType()),
        T.StructField("Review", T.StringType()),
        T.StructField("llm_response", T.StringType()),
        *INTENT.fields,
    ]
)

REPLY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("tool_args", T.ArrayType(T.StringType())),
        T.StructField("content", T.StringType()),
    ]
)

LABELLED = T.StructType(
    [
        T.StructField("topic_id", T.IntegerType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("topic_name", T.StringType()),
        T.StructField("llm_topic_name", T.StringType()),
        T.StructField("document", T.StringType()),
    ]
)


def intents_columns(rows: DataFrame) -> list[Column]:
    """Columns of ``rows`` cast to the intents table; ids that are text stay text."""
    text_id = isinstance(rows.schema["id"].dataType, T.StringType)
    return [
        F.col(f.name) if f.name == "id" and text_id else F.col(f.name).cast(f.dataType).alias(f.name) for f in INTENTS_TABLE.fields
    ]


def reply_schema(id_type: T.DataType) -> T.StructType:
    """The ledger's columns for requests whose ids have this type."""
    return T.StructType([T.StructField("id", id_type), *REPLY.fields[1:]])
