"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions alone.

Every shard has ``virtual`` points on a ring of 60-bit positions; a row's key has one. The points cut the ring into arcs, and all
keys of an arc ask the same shards in the same order: the owners of the points clockwise from there. A row goes to the
first of them that has room, and rows that find it full continue clockwise. In round ``r`` the rows still without a place
ask the ``r``-th shard of their arc's order; arcs ask in ring order, and the rows of an arc in the order of their keys. So
the outcome follows from one count for each arc, whatever the number of rows: a few thousand numbers, settled by one
expression. Rows then find their place by their rank in the arc, counted over small parts of it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from review_topics.session import stage

VIRTUAL = 100
OVERHEAD = 16
# Rows that share an arc are ranked in parts of about this many rows, were all rows in one arc.
PART_ROWS = 10_000_000
LEAST_PARTS = 16
_BITS = 60


def position(key: Column) -> Column:
    """Place of a key on the ring: the first 60 bits of its MD5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def points(spark: SparkSession, shards: int, virtual: int = VIRTUAL) -> DataFrame:
    """``(arc, shard, position)`` of every virtual node, numbered around the ring. Arc ``a`` ends at point ``a``."""
    nodes = spark.range(shards * virtual).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("copy"))
    placed = nodes.select("shard", position(F.concat_ws(":", "shard", "copy")).alias("position"))
    return placed.select((F.row_number().over(Window.orderBy("position", "shard")) - 1).cast("int").alias("arc"), "shard", "position")


def _cells(ring: DataFrame, arcs: int) -> tuple[DataFrame, int]:
    """``(cell, before, inside)`` over equal cells of the ring: points before the cell and those in it; and a cell's bits."""
    bits = _BITS - (8 * arcs - 1).bit_length()
    held = ring.groupBy(F.shiftright("position", bits).cast("int").alias("cell")).agg(F.collect_list("position").alias("inside"))
    every = ring.sparkSession.range(1 << (_BITS - bits)).select(F.col("id").cast("int").alias("cell"))
    whole = every.join(F.broadcast(held), "cell", "left").withColumn("inside", F.coalesce("inside", F.array().cast("array<long>")))
    before = F.sum(F.size("inside")).over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    return whole.select("cell", F.coalesce(before, F.lit(0)).cast("int").alias("before"), "inside"), bits


def _settled(loads: DataFrame, ring: DataFrame, shards: int, room: Column) -> DataFrame:
    """``(arc, parts)``: parts ``(first, shard, base)`` of each arc; rows of it from rank ``first`` on have slots from ``base`` on.

    ``loads(arc, n)`` has one row for each arc with rows, ``room`` the rows that each shard may hold. Its size is
    bounded by the ring, not by the rows.
    """
    owners = ring.agg(F.transform(F.sort_array(F.collect_list(F.struct("arc", "shard"))), lambda x: x["shard"]).alias("owners")).scalar()
    kind = "array<struct<arc:int,n:long,first:long,order:array<int>>>"
    parts = "array<struct<arc:int,first:long,shard:int,base:long>>"
    line = loads.agg(F.sort_array(F.collect_list(F.struct("arc", "n"))).alias("loads")).select("loads", owners.alias("owners"), room.alias("room"))
    clockwise = lambda x: F.array_distinct(F.slice(F.concat("owners", "owners"), x["arc"] + 1, F.size("owners")))
    asks = lambda x: F.struct(x["arc"].alias("arc"), x["n"].alias("n"), F.lit(0).cast("long").alias("first"), clockwise(x).alias("order"))
    line = line.withColumn("asking", F.transform("loads", asks))

    def ask(turn: Column):
        def step(state: Column, x: Column) -> Column:
            shard = F.element_at(x["order"], turn)
            free = F.element_at(state["room"], shard + 1)
            taken = F.least(x["n"], free)
            over = F.struct(x["arc"].alias("arc"), (x["n"] - taken).alias("n"), (x["first"] + taken).alias("first"), x["order"].alias("order"))
            part = F.struct(x["arc"].alias("arc"), x["first"].alias("first"), shard.alias("shard"), (F.element_at(F.col("room"), shard + 1) - free).alias("base"))
            return F.struct(
                F.transform(state["room"], lambda left, i: F.when(i == shard, left - taken).otherwise(left)).alias("room"),
                F.when(x["n"] > taken, F.concat(state["left"], F.array(over))).otherwise(state["left"]).cast(kind).alias("left"),
                F.when(taken > 0, F.concat(state["parts"], F.array(part))).otherwise(state["parts"]).cast(parts).alias("parts"),
            )

        return step

    def round_of(state: Column, turn: Column) -> Column:
        start = F.struct(state["room"].alias("room"), F.array().cast(kind).alias("left"), state["parts"].alias("parts"))
        return F.aggregate(state["left"], start, ask(turn))

    start = F.struct(F.col("room"), F.col("asking").cast(kind).alias("left"), F.array().cast(parts).alias("parts"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, round_of)
    settled = line.select(F.explode(done["parts"]).alias("part")).select("part.*")
    return settled.groupBy("arc").agg(F.sort_array(F.collect_list(F.struct("first", "shard", "base"))).alias("parts"))


def ring_shards(documents: DataFrame, shards: int, slack: float = 0.0, virtual: int = VIRTUAL) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``: every row's shard on the ring, and its place there, gapless from 0.

    No shard holds more than ``(1 + slack) * rows / shards``, rounded up; without slack counts are at most one apart, the
    larger ones first. A row's key is its doc_id, without one what its text says. ``size`` counts the text's UTF-8 bytes and
    16 more; a null text is empty. Rows that share a key ask the same shards; rows that are alike in all that is
    returned are interchangeable. Other columns are ignored, an empty table gives an empty result. Only columns of a few
    bytes are shuffled, and a key that many rows share is ranked in parts.
    """
    spark = documents.sparkSession
    content = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(content) + F.lit(OVERHEAD).cast("long")).alias("size"), F.crc32(content).alias("text_crc32"))
    alike = slim.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(" ", F.lit("text"), "text_crc32", "size"))
    ring = points(spark, shards, virtual)
    cells, bits = _cells(ring, shards * virtual)
    placed = alike.withColumn("position", position(key)).withColumn("cell", F.shiftright("position", bits).cast("int")).join(F.broadcast(cells), "cell")
    before = F.col("before") + F.size(F.filter("inside", lambda p: p < F.col("position")))
    rows = stage(placed.withColumn("arc", (before % (shards * virtual)).cast("int")).drop("cell", "before", "inside"), "ring-rows")

    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    parts = max(LEAST_PARTS, total // PART_ROWS)
    rows = rows.withColumn("part", F.pmod(F.col("position") + F.col("text_crc32"), F.lit(parts)))
    counts = rows.groupBy("arc", "part").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("arc", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    if slack:
        room = F.array_repeat(F.lit(math.ceil(total * (1 + slack) / shards)).cast("long"), shards)
    else:
        least, larger = divmod(total, shards)
        room = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.lit(least).cast("long") + F.when(s < larger, 1).otherwise(0))
    settled = _settled(counts.groupBy("arc").agg(F.sum("n").alias("n")), ring, shards, room)

    order = Window.partitionBy("arc", "part").orderBy("position", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("within", F.coalesce(F.sum("copies").over(order), F.lit(0))).join(bases, ["arc", "part"])
    each = ranked.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn("rank", F.col("ahead") + F.col("within") + F.col("copy"))
    own = F.element_at(F.filter("parts", lambda p: p["first"] <= F.col("rank")), -1)
    found = each.join(F.broadcast(settled), "arc").withColumn("own", own)
    return found.select("doc_id", "size", "text_crc32", F.col("own.shard").alias("shard"), (F.col("own.base") + F.col("rank") - F.col("own.first")).alias("slot"))
