"""Hard negatives against plain integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_topics.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors, positives=5, negatives=3):
    fine = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    first = {}
    for i, v, y in sorted(fine, key=lambda r: (r[2], r[1])):
        first.setdefault(i, (v, y))
    for a in sorted(anchors & set(first)):
        v, y = first[a]
        cut = lambda s: max(-(2**63), min(2**63 - 1, s))
        scored = sorted((-cut(sum(p * q for p, q in zip(v, w))), i, z) for i, w, z in fine if len(w) == len(v))
        same = [(i, -s) for s, i, z in scored if z == y and i != a][:positives]
        for p, score in sorted(set(same)):
            inside = [(i, -s) for s, i, z in scored if z != y and 50 * score <= -100 * s <= 95 * score][:negatives]
            out += [(a, p, r + 1, i, score, s) for r, (i, s) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("tile", [2048, 5])
def test_lists_match_plain_sums(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 2 * tile)
    rng = random.Random(tile)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, 0.0, 0.9]) for _ in range(6)], rng.randint(0, 2)) for i in range(150)]
    rows += [(200, None, 1), (201, [None] * 6, 1), (202, [float("nan")] * 6, 0), (203, [float("inf")] * 6, 0), (204, [], 1), (205, [], 1), (206, [], 2)]
    rows += [(207, [1.0, 2.0], 1), (None, [0.1] * 6, 1), (208, [0.3] * 6, None), (300, [1.0] * 4, 7), (301, [1.0] * 4, 7), (302, [0.6] * 4, 8)]
    rows += [(400 + i, [rng.uniform(0, 9e8) for _ in range(3)], rng.randint(0, 1)) for i in range(24)] + [(330 + i, [rng.uniform(-9e4, 9e6) for _ in range(4)], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("rank", F.lit(0))
    out = hard_negatives.hard_negatives(df, F.col("vec_id") % 3 == 0, shards=3).collect()
    assert sorted(map(tuple, out)) == brute(rows, {i for i, *_ in rows if i is not None and i % 3 == 0})


def test_repeats_ties_and_nothing(spark):
    rows = [(0, [1.0], 1), (0, [0.5], 1), (0, [0.5], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [1.0], 1), (3, [0.7], 2), (3, [0.7], 2), (4, [0.7], 3), (5, [-1.0], 1)]
    out = hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, out)) == brute(rows, {0}) and out
    assert hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 99).count() == 0


@pytest.mark.parametrize("shape", [(1, 1, 1), (40, 33, 57), (64, 64, 64), (17, 100, 35), (3, 64, 90), (0, 5, 4), (70, 0, 50)])
def test_strassen_is_the_plain_product(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-(2**62), 2**62, shape[:2]), rng.integers(-(2**62), 2**62, shape[1:])
    assert np.array_equal(hard_negatives.strassen(a, b, 4), a @ b)  # modulo 2**64
    near, far = (rng.integers(-(2**bits), 2**bits, shape[:2]).astype(float) for bits in (16, 29))
    for left in (near, far):  # leaves in doubles, leaves in longs
        right = rng.integers(-(2**16), 2**16, shape[1:][::-1]).astype(float)
        assert np.array_equal(hard_negatives.products(left, right), left.astype(np.int64) @ right.astype(np.int64).T)
    small = rng.integers(-(2**20), 2**20, shape[:2]).astype(object)
    assert np.array_equal(hard_negatives.strassen(small, b.astype(object), 4), small @ b.astype(object))


def test_heaps_merge_in_parts(monkeypatch):
    monkeypatch.setattr(hard_negatives, "_HELD_ROWS", 60)
    rng = np.random.default_rng(5)
    heaps, every, left = hard_negatives.Heaps(2), [], []
    for _ in range(20):
        entry = rng.integers(0, 4, 15), rng.integers(0, 3, 15), rng.integers(0, 99, 15), rng.integers(-5, 5, 15)
        every += list(zip(*(x.tolist() for x in entry)))
        left += [full] if (full := heaps.add(*entry)) else []
    left.append(heaps.merged())
    final = hard_negatives.Heaps(2)
    final.held = left
    want = []
    for g in sorted({e[:2] for e in every}):
        want += sorted((e for e in every if e[:2] == g), key=lambda e: (-e[3], e[2]))[:2]
    assert sorted(zip(*(x.tolist() for x in final.merged()))) == sorted(want)


def test_windows_are_exact():
    for score in (0, 1, 3, 99, 100, 101, 2**62, 2**63 - 1, -1, -7, -(2**63)):
        low, high = hard_negatives.window(np.array([score]), 50, 95)
        assert (int(low[0]), int(high[0])) == (-((-50 * score) // 100), 95 * score // 100)


def test_visits_are_not_broadcast(spark):
    label = (F.col("id") % 2).cast("int").alias("label")
    vectors = spark.range(20).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding"), label)
    out = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 10 == 0)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    rows = [(i, [float(i), 1.0], i % 2) for i in range(20)]
    found = sorted(map(tuple, out.collect()))
    assert found == brute(rows, {0, 10}) and found
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()  # also of the sizes seen meanwhile
