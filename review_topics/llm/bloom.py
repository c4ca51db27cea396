"""A Bloom filter sized by its values up to a bound, made by an aggregate and tested in tasks.

The filter has at least BITS_A_VALUE bits for each value, but never more than MOST_BITS, so it can be sent to every task. It
never loses a value; with more values than it is made for it lets others pass, which costs time and changes no result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_A_VALUE = 16
LEAST_BITS = 1 << 20
MOST_BITS = 1 << 27


def _probes(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (values & mask).astype(np.int64), ((values >> np.uint64(32)) & mask).astype(np.int64)


def size_for(values: int) -> int:
    """Bits of a filter for so many values: a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_VALUE * max(1, values) - 1).bit_length()))


def build(values: DataFrame) -> np.ndarray:
    """Filter of the well-mixed 64-bit numbers in the only column of ``values``; at most MOST_BITS / 32 rows are collected."""
    name = values.columns[0]
    bits = size_for(values.count())
    mask = F.lit(bits - 1)
    bit = values.select(F.explode(F.array(F.col(name).bitwiseAND(mask), F.shiftrightunsigned(name, 32).bitwiseAND(mask))).alias("bit"))
    rows = bit.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits"))
    rows = rows.toArrow()
    out = np.zeros(bits >> 5, np.uint32)
    out[np.asarray(rows["word"]).astype(np.int64)] = np.asarray(rows["bits"]).astype(np.int64).astype(np.uint32)
    return out


def passing(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the values (uint64) that the filter lets pass, ascending."""
    one, two = _probes(values, len(table) << 5)
    hit = np.flatnonzero((table[one >> 5] >> (one & 31).astype(np.uint32)) & 1)
    other = two[hit]
    return hit[((table[other >> 5] >> (other & 31).astype(np.uint32)) & 1) > 0]
