"""Strict JSON on VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_object(text: Column) -> Column:
    """VARIANT of ``text`` if it is one complete JSON object, else null.

    ``try_parse_json`` alone accepts text after the value. Wrapping the text in an array and in an object leaves
    no place for such a tail: only a single complete value parses in both. Duplicate keys and ``NaN`` are refused.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"w":'), text, F.lit("}")))
    value = F.try_variant_get(in_object, "$.w", "variant")
    return F.when(in_array.isNotNull() & is_object(value), value)


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def is_array(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("ARRAY")


def is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"
