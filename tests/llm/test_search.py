"""Exact search against plain integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_topics.llm import exact_search


def brute(rows, queries, k):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, v in fine:
        if q in queries:
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in fine if i != q and len(w) == len(v))[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return {q: found for q, found in out.items() if found}


@pytest.mark.parametrize("tile", [4096, 7])
def test_lists_match_plain_sums(spark, monkeypatch, tile):
    monkeypatch.setattr(exact_search, "TILE_ROWS", tile)
    rng = random.Random(tile)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, 0.0]) for _ in range(6)]) for i in range(150)]
    rows += [(200, None), (201, [None] * 6), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (204, []), (205, []), (206, [1.0, 2.0]), (None, [0.1] * 6)]
    rows += [(300 + i, [rng.uniform(-1e18, 1e18) for _ in range(3)]) for i in range(12)] + [(330 + i, [rng.uniform(-9e6, 9e6) for _ in range(4)]) for i in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    out = exact_search.top_k(vectors, F.col("vec_id") % 3 == 0, 5, shards=3).collect()
    found = {}
    for r in out:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in found.items()} == brute(rows, {i for i, _ in rows if i is not None and i % 3 == 0}, 5)


def test_lists_are_merged_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    lists = [(rng.integers(0, 9, 40), rng.integers(0, 99, 40), rng.integers(-5, 5, 40)) for _ in range(4)]
    query, vec, score = exact_search._merge(lists, 3)
    for q in range(9):
        every = sorted((-s, v) for a in lists for x, v, s in zip(*a) if x == q)[:3]
        assert [(-s, v) for x, v, s in zip(query, vec, score) if x == q] == every
    low = np.iinfo(np.int64).min
    assert exact_search._merge([(np.array([1, 1]), np.array([2, 3]), np.array([low, 5]))], 2)[1].tolist() == [3, 2]


def test_repeated_rows_and_nothing(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [0.5]), (1, [0.5]), (2, [0.25])]
    out = exact_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, 5).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in out) == [(1, 1), (2, 1), (3, 2)]
    assert exact_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("turn", [1, -1])
def test_the_smallest_usable_vector_of_a_query_counts_in_any_order(spark, turn):
    rows = [(0, None), (0, [1.0]), (0, [0.5]), (0, [float("nan")]), (1, [0.5]), (2, None), (2, [-1.0])][::turn]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    out = sorted(tuple(r) for r in exact_search.top_k(vectors, F.col("vec_id") == 0, 5).collect())
    assert out == [(0, 1, 1, 128 * 128), (0, 2, 2, -128 * 256)]


def test_visits_are_not_broadcast(spark):
    vectors = spark.range(20).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    out = exact_search.top_k(vectors, F.col("vec_id") % 10 == 0, 2)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    found = sorted(tuple(r) for r in out.collect())
    assert found == [(0, 1, 1, 65536), (0, 2, 2, 65536), (10, 1, 19, 191 * 65536), (10, 2, 18, 181 * 65536)]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()  # also of the sizes seen meanwhile
