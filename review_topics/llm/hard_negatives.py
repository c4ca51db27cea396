"""Hard negatives by exact inner products: Strassen multiplication of integer tiles, then mergeable heaps.

Vectors are packed into tiles as they are read and dealt over shards; blocks of anchors visit every shard. A task multiplies a
block with a tile by Strassen's recursion, padding with zeros where a side is odd. Sums and differences of 64-bit
integers are exact modulo 2**64, so the product is exact wherever the score itself fits, whatever the sums in between
did. Of each tile only the best of every list are kept; lists of a task are merged, and what tasks leave is ranked once
more. A first round finds each anchor's positives, a second one the negatives in the score window of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_topics.session import stage

TILE_ROWS = 2048
BLOCK_ROWS = 512
SCALE = 256
LEAF = 16
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_HELD_ROWS = 1_000_000
TILE = "dim int, ids binary, labels binary, data binary"
VISIT = "dim int, anchor_ids binary, anchor_labels binary, anchor_data binary, positive_ids binary, positive_scores binary"


def by_doubles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of whole numbers whose products and sums stay below 2**53, where doubles are exact."""
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF, multiply=np.matmul) -> np.ndarray:
    """``a @ b`` by seven products of halves instead of eight; with a side of up to ``leaf``, ``multiply`` does it."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return multiply(a, b)
    if m % 2 or k % 2 or n % 2:
        wide_a, wide_b = np.zeros((m + m % 2, k + k % 2), a.dtype), np.zeros((n + n % 2, k + k % 2), b.dtype).T
        wide_a[:m, :k], wide_b[:k, :n] = a, b
        return strassen(wide_a, wide_b, leaf, multiply)[:m, :n]
    i, j, h = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    out = np.empty((m, n), a.dtype)
    c11, c12, c21, c22 = out[:i, :h], out[:i, h:], out[i:, :h], out[i:, h:]
    c11[:] = c22[:] = strassen(a11 + a22, b11 + b22, leaf, multiply)
    c21[:] = step = strassen(a21 + a22, b11, leaf, multiply)
    c22 -= step
    c12[:] = step = strassen(a11, b12 - b22, leaf, multiply)
    c22 += step
    step = strassen(a22, b21 - b11, leaf, multiply)
    c11 += step
    c21 += step
    step = strassen(a11 + a12, b22, leaf, multiply)
    c11 -= step
    c12 += step
    c22 += strassen(a21 - a11, b11 + b12, leaf, multiply)
    c11 += strassen(a12 - a22, b21 + b22, leaf, multiply)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` (whole numbers as doubles) as longs, cut to the range of a long."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if reach < 2.0**62:
        halvings = max(0, min(*a.shape, len(b)) // LEAF).bit_length()  # each at most doubles the entries of both sides
        multiply = by_doubles if reach * 4.0**halvings < 2.0**53 else np.matmul
        return strassen(a.astype(np.int64), b.astype(np.int64).T, LEAF, multiply)
    whole = [np.array([[int(x) for x in row] for row in side], object).reshape(side.shape) for side in (a, b)]
    return np.clip(strassen(whole[0], whole[1].T), int(_LOW), int(_HIGH)).astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of the ``k`` highest allowed scores of each row, of equal ones those of the first columns."""
    n = scores.shape[1]
    if not scores.size or max(-int(scores.min()), int(scores.max())) < (1 << 61) // n:
        key = np.where(allowed, scores * n - np.arange(n), _LOW)
        if k < n:
            column = np.argpartition(key, n - k, axis=1)[:, n - k :]
        else:
            column = np.broadcast_to(np.arange(n), key.shape)
        row = np.repeat(np.arange(len(key)), column.shape[1])
        column = column.reshape(-1)
        good = allowed[row, column]
        return row[good], column[good]
    found = [(r, c) for r in range(len(scores)) for c in sorted(np.flatnonzero(allowed[r]).tolist(), key=lambda c: (-int(scores[r, c]), c))[:k]]
    row, column = np.array(found, np.int64).reshape(-1, 2).T
    return row, column


class Heaps:
    """Lists of the ``k`` best of every group, merged whenever more than _HELD_ROWS entries are held.

    An entry is the group's columns, then the id and the score, which decide: higher scores first, then smaller ids.
    """

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0

    def add(self, *entry: np.ndarray) -> list[np.ndarray] | None:
        """Take entries in; what is held is given back, and forgotten, when merging alone no longer makes room."""
        self.held.append(entry)
        self.size += len(entry[0])
        if self.size > _HELD_ROWS:
            merged = self.merged()
            self.held, self.size = [merged], len(merged[0])
            if self.size > _HELD_ROWS // 2:
                self.held, self.size = [], 0
                return merged
        return None

    def merged(self) -> list[np.ndarray]:
        *group, ids, scores = (np.concatenate(column) for column in zip(*self.held))
        order = np.lexsort((ids, ~scores, *group))  # ~x falls as x grows and has no overflow
        *group, ids, scores = (x[order] for x in (*group, ids, scores))
        new = np.ones(len(ids), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in group])
        first = np.flatnonzero(new)
        rank = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
        return [x[rank < self.k] for x in (*group, ids, scores)]


def _numbers(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(0)).astype(np.int64)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(components, rows, scaled vectors)`` of the usable rows, by number of components."""
    vectors = batch.column("embedding")
    sizes = np.asarray(vectors.value_lengths().fill_null(-1))
    starts = np.asarray(vectors.offsets)[:-1]
    with np.errstate(over="ignore"):
        values = np.floor(SCALE * np.asarray(vectors.values.cast(pa.float64()).fill_null(np.nan)))
    usable = (sizes >= 0) & np.asarray(batch.column("vec_id").is_valid()) & np.asarray(batch.column("label").is_valid())
    for dim in np.unique(sizes[usable]):
        at = np.flatnonzero(usable & (sizes == dim))
        matrix = values[starts[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))
        fine = np.isfinite(matrix).all(1)
        yield int(dim), at[fine], matrix[fine]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(names), kinds)], names=names)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels, out = _numbers(batch.column("vec_id")), _numbers(batch.column("label")), []
        for dim, at, matrix in _vectors(batch) if batch.num_rows else ():
            order = np.argsort(ids[at], kind="stable")
            for low in range(0, len(at), TILE_ROWS):
                some = order[low : low + TILE_ROWS]
                out.append((dim, ids[at[some]].tobytes(), labels[at[some]].tobytes(), matrix[some].tobytes()))
        yield _batch(out, TILE)


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with their positives, as many places for each as the most that any anchor of the block has."""
    for batch in batches:
        ids, labels, out = _numbers(batch.column("vec_id")), _numbers(batch.column("label")), []
        positives = batch.column("positives").to_pylist()
        for dim, at, matrix in _vectors(batch) if batch.num_rows else ():
            for low in range(0, len(at), BLOCK_ROWS):
                some = at[low : low + BLOCK_ROWS]
                width = max((len(positives[i] or ()) for i in some), default=0)
                pairs = np.zeros((2, len(some), width), np.int64)
                pairs[1] = -1  # no window: none below nought
                for r, i in enumerate(some):
                    for c, found in enumerate(positives[i] or ()):
                        pairs[:, r, c] = found["positive_id"], found["positive_score"]
                out.append((dim, ids[some].tobytes(), labels[some].tobytes(), matrix[low : low + BLOCK_ROWS].tobytes(), pairs[0].tobytes(), pairs[1].tobytes()))
        yield _batch(out, VISIT)


def window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole number between ``low`` and ``high`` hundredths of ``score``, without leaving 64 bits."""
    hundreds, rest = score // 100, score % 100
    return hundreds * low - (-(rest * low) // 100), hundreds * high + rest * high // 100


def _mined(k: int, negatives: bool, low: int, high: int):
    names = ["anchor_id", "positive_id", "positive_score", "vec_id", "score"] if negatives else ["anchor_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(k)
        leave = lambda found: pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=names)
        for batch in batches:
            for line in zip(*(batch.column(c) for c in batch.schema.names)):
                raw = dict(zip(batch.schema.names, line))
                dim = raw["dim"].as_py()
                read = lambda name, kind=np.int64: np.frombuffer(raw[name].as_buffer(), kind)  # noqa: B023, E731
                ids, labels, anchors, own = read("ids"), read("labels"), read("anchor_ids"), read("anchor_labels")
                tile, block = (read(name, np.float64).reshape(n, dim) for name, n in (("data", len(ids)), ("anchor_data", len(anchors))))
                scores = products(block, tile)
                same = own[:, None] == labels[None, :]
                if not negatives:
                    row, column = best(scores, same & (anchors[:, None] != ids[None, :]), k)
                    full = heaps.add(anchors[row], ids[column], scores[row, column])
                    if full:
                        yield leave(full)
                    continue
                positive_ids, positive_scores = (read(name).reshape(len(anchors), -1) for name in ("positive_ids", "positive_scores"))
                for c in range(positive_ids.shape[1]):
                    least, greatest = window(positive_scores[:, c], low, high)
                    inside = ~same & (scores >= least[:, None]) & (scores <= greatest[:, None])
                    row, column = best(scores, inside, k)
                    full = heaps.add(anchors[row], positive_ids[row, c], positive_scores[row, c], ids[column], scores[row, column])
                    if full:
                        yield leave(full)
        if heaps.held:
            yield leave(heaps.merged())

    return run, ", ".join(f"{name} long" for name in names)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, shards: int | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for rows for which ``is_anchor`` holds.

    ``vectors(vec_id, embedding, label)``. A score is the inner product of two vectors whose components x became
    floor(256 x). An anchor's positives are the ``positives`` best rows of its label with another vec_id; for each of them the
    ``negatives`` best rows of other labels score between ``low`` and ``high`` hundredths of the positive's score.
    Higher scores come first, then smaller vec_ids; with fewer rows there are fewer ranks. A positive below nought has an
    empty window. Rows whose vec_id, label or vector is null, or whose vector has components that are null or not finite
    (scaled ones included), take no part; only vectors with as many components are compared, those without any score 0.
    Repeated rows are a candidate each; of anchors with one vec_id that with the smallest label and vector counts, and a
    positive that repeats with its score has one list. Scores beyond 64 bits are cut to the range of a long. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")]
    tiles = vectors.select(*columns).mapInArrow(_tiles, TILE).withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(is_anchor).select(*columns).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    anchors = usable.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("own")).select("vec_id", "own.*")

    def met(asked: DataFrame, k: int, second: bool) -> DataFrame:
        visits = asked.mapInArrow(_visits, VISIT).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        run, schema = _mined(k, second, low, high)
        # A block is there once a shard, many times the size that Spark takes the visits for: they are merged, never broadcast. The tiles
        # of a shard are what a task holds while its blocks pass by.
        return visits.hint("merge").join(tiles, ["shard", "dim"]).drop("shard").mapInArrow(run, schema)

    def ranked(lists: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    nothing = F.lit(None).cast("array<struct<positive_id:long,positive_score:long>>").alias("positives")
    first = ranked(met(anchors.select("*", nothing), positives, False), ["anchor_id"], positives)
    found = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set(F.struct(F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))).alias("positives"))
    asked = stage(anchors.join(found, "vec_id"), "anchors")
    second = ranked(met(asked, negatives, True), ["anchor_id", "positive_id", "positive_score"], negatives)
    return second.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
