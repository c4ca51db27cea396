"""Exact top-k by inner product: tiles of candidates times blocks of queries, partial selection, merged lists.

Vectors are packed into tiles as they are read. Tiles are dealt over shards once; each block of queries visits every shard.
A task multiplies the pairs it gets, keeps the best of each tile, merges them into one list a query and hands that on to
the last merge by query. Nothing but lists of ``k`` leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE_ROWS = 4096
BLOCK_ROWS = 1024
SCALE = 256
_EXACT = 2.0**50  # below it scores and tie keys are exact in 64 bits
_HELD_ROWS = 1_000_000


def _packed(rows: int):
    """Rows of one dimension as ``(dim, ids, data)``; vectors that are null or hold null or non-finite values are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column("vec_id"), batch.column("embedding")
            out: list[tuple[int, bytes, bytes]] = []
            sizes = np.asarray(vectors.value_lengths().fill_null(-1))
            starts = np.asarray(vectors.offsets)[:-1] if len(vectors) else sizes
            flat = vectors.values
            values = np.floor(SCALE * np.asarray(flat.cast(pa.float64()).fill_null(np.nan)))
            numbers = np.asarray(ids.fill_null(0))
            usable = (sizes >= 0) & np.asarray(ids.is_valid())
            for dim in np.unique(sizes[usable]):
                at = np.flatnonzero(usable & (sizes == dim))
                matrix = values[starts[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))
                fine = np.isfinite(matrix).all(1)
                at, matrix = at[fine], matrix[fine]
                for lo in range(0, len(at), rows):
                    out.append((int(dim), numbers[at[lo : lo + rows]].tobytes(), matrix[lo : lo + rows].tobytes()))
            columns = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], names=["dim", "ids", "data"])

    return run


def best_of_tile(queries: np.ndarray, query_ids: np.ndarray, tile: np.ndarray, tile_ids: np.ndarray, k: int):
    """``(query position, vec_id, score)`` of the ``k`` best of a tile for each query, ties to smaller ids, own id left out."""
    order = np.argsort(tile_ids, kind="stable")
    tile, tile_ids = tile[order], tile_ids[order]
    n = len(tile_ids)
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(tile).max(initial=0)) * max(1, queries.shape[1])
    if reach * n < _EXACT:
        kind = np.float32 if reach < 2**24 else np.float64
        key = (queries.astype(kind) @ tile.astype(kind).T).astype(np.int64) * n - np.arange(n)
        own = query_ids[:, None] == tile_ids[None, :]
        key[own] = -(1 << 62)
        take = min(k, n)
        best = np.argpartition(-key, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(queries), 1))
        row, best = np.repeat(np.arange(len(queries)), best.shape[1]), best.reshape(-1)
        good = ~own[row, best]
        row, best = row[good], best[good]
        return row, tile_ids[best], -(-(key[row, best] + best) // n)
    rows = []
    whole = [[int(x) for x in v] for v in tile]
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    for r, q in enumerate(queries):
        line = [int(x) for x in q]
        scored = [(-max(low, min(high, sum(a * b for a, b in zip(line, v)))), int(i)) for v, i in zip(whole, tile_ids) if i != query_ids[r]]
        rows += [(r, i, -s) for s, i in sorted(scored)[:k]]
    found = np.array(rows, dtype=np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def _merge(lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    query, vec, score = (np.concatenate(x) for x in zip(*lists))
    order = np.lexsort((vec, -score.astype(object)) if score.size and score.min() == np.iinfo(np.int64).min else (vec, -score))
    order = order[np.argsort(query[order], kind="stable")]
    query, vec, score = query[order], vec[order], score[order]
    first = np.concatenate(([0], np.flatnonzero(np.diff(query)) + 1)) if len(query) else np.zeros(0, int)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return query[rank < k], vec[rank < k], score[rank < k]


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def leave() -> pa.RecordBatch:
            query, vec, score = held[0]
            return pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for dim, ids, data, query_ids, queries in zip(*(batch.column(c) for c in ("dim", "ids", "data", "query_ids", "queries"))):
                dim = dim.as_py()
                tile_ids, own_ids = (np.frombuffer(x.as_buffer(), np.int64) for x in (ids, query_ids))
                tile, block = (np.frombuffer(x.as_buffer(), np.float64).reshape(-1, dim) if dim else np.zeros((len(i), 0)) for x, i in ((data, tile_ids), (queries, own_ids)))
                row, vec, score = best_of_tile(block, own_ids, tile, tile_ids, k)
                held.append((own_ids[row], vec, score))
                size += len(vec)
                if size > _HELD_ROWS:
                    held = [_merge(held, k)]
                    size = len(held[0][0])
                    if size > _HELD_ROWS // 2:
                        yield leave()
                        held, size = [], 0
        if held:
            held = [_merge(held, k)]
            yield leave()

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shards: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest integer inner products of each row for which ``is_query`` holds.

    ``vectors(vec_id, embedding)``; each component x counts as floor(256 x). Candidates are all rows with another vec_id and
    the same number of components; ties go to the smaller vec_id; with fewer candidates there are fewer ranks. Rows whose
    vec_id or vector is null, or whose vector holds null or non-finite values, take no part. Vectors without components
    score 0 with each other. Repeated rows are a
    candidate each, and one query, with the smallest of their usable vectors. Scores beyond 64 bits are cut to the range of
    a long. Other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    schema = "dim int, ids binary, data binary"
    tiles = rows.mapInArrow(_packed(TILE_ROWS), schema).withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf")))
    asked = vectors.where(is_query).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = asked.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    blocks = usable.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).mapInArrow(_packed(BLOCK_ROWS), schema)
    visits = blocks.select("dim", F.col("ids").alias("query_ids"), F.col("data").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    # A block is there once a shard, many times the size that Spark takes the visits for: they are merged, never broadcast. The tiles of a
    # shard are what a task holds while its blocks pass by.
    lists = visits.hint("merge").join(tiles, ["shard", "dim"]).mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
