"""Suffix arrays against sorting, repeated passages against a set of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_topics.llm import queries, suffix_dedup
from review_topics.llm.suffix_groups import suffix_arrays


@pytest.mark.parametrize("seed", range(5))
def test_suffix_arrays_match_sorting(seed):
    rng = random.Random(seed)
    for _ in range(80):
        strings = []
        for _ in range(rng.randrange(1, 6)):
            k, n = rng.choice([1, 2, 3, 20]), rng.randrange(60)
            s = [rng.randrange(1, k + 1) for _ in range(n)]
            strings.append(((s[:4] * 30)[:n] if rng.random() < 0.3 else s) + [0])
        starts = np.cumsum([0, *map(len, strings[:-1])])
        want = [b + i for b, s in zip(starts.tolist(), strings) for i in sorted(range(len(s)), key=lambda i: s[i:])]
        assert suffix_arrays(np.array(sum(strings, [])), starts).tolist() == want
    assert suffix_arrays(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def plain(rows, length=100):
    """Removed bytes by a dictionary of all windows."""
    seen, out = {}, {}
    texts = dict(rows)
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if seen.setdefault(data[i : i + length], (doc, i)) != (doc, i):
                gone[i : i + length] = True
        spans = int(np.sum(gone & ~np.concatenate(([False], gone[:-1])))) if len(gone) else 0
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if len(data) else b""
        out[doc] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(frame):
    return {r["doc_id"]: (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in frame.collect()}


def passages(seed, docs=70):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(30) for _ in range(4)] + ["ab" * 90, "a" * 240, "x" * 99]
    rows = []
    for doc in range(docs):
        parts = [text(rng.randrange(0, 50))]
        for _ in range(rng.randrange(0, 4)):
            piece = rng.choice(shared)
            cut = rng.randrange(0, max(1, len(piece) // 2))
            piece = piece[cut : len(piece) - rng.randrange(0, len(piece) // 3)]
            if rng.random() < 0.3:
                at = rng.randrange(len(piece))
                piece = piece[:at] + "#" + piece[at + 1 :]
            parts += [piece, text(rng.randrange(0, 6))]
        rows.append((doc * 3, " ".join(parts)))
    rows += [(500, rows[5][1]), (501, rows[5][1]), (502, None), (503, ""), (504, "short"), (505, "y" * 100), (506, "y" * 101), (-4, rows[7][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small, hot", [(16, 20_000), (2, 20_000), (2, 12)])
def test_removal_matches_a_set_of_windows(spark, monkeypatch, small, hot):
    monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", small)
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    rows = passages(hot + small)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).repartition(3)
    assert result(suffix_dedup.without_repeats(docs)) == plain(rows)


def test_groups_of_any_size_find_the_same(monkeypatch):
    rng = random.Random(9)
    base = bytes(rng.choices(b"ab", k=152))
    segments = []
    for _ in range(60):
        own = bytearray(base)
        for _ in range(rng.randrange(0, 3)):
            own[rng.choice([rng.randrange(52), rng.randrange(100, 152)])] = rng.choice(b"cd")
        segments.append(bytes(own))
    befores = [52] * 60

    def links(size):
        monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", size)
        out = set()
        for members, low, high in suffix_dedup._comparable(list(range(60)), segments, befores, 0, 52):
            for x in range(low, high + 1):
                alike = {}
                for i in members:
                    alike.setdefault(segments[i][52 - x : 152 - x], []).append(i)
                out |= {(x, tuple(own)) for own in alike.values() if len(own) > 1}
        return out

    assert links(1) == links(1000)


def test_whole_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.QUERIES["op3_suffix_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == plain(rows) and len(out) == len(rows)


def test_odd_rows(spark):
    line = "the same line again and again, " * 5
    docs = spark.createDataFrame([(1, line), (1, line), (None, line), (2, line)], "doc_id long, text string")
    kept = sorted((r["doc_id"] or -1, len(r["kept"])) for r in suffix_dedup.without_repeats(docs).collect())
    assert kept[0] == (-1, len(line)) and kept[1] == kept[2] == (1, 31) and kept[3] == (2, 0)
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


def test_filter_grows_with_its_values(spark):
    from review_topics.llm import bloom

    assert bloom.size_for(0) == bloom.LEAST_BITS and bloom.size_for(10**6) >= 16 * 10**6 and bloom.size_for(10**12) == bloom.MOST_BITS
    values = spark.range(200_000).selectExpr("xxhash64(id) as h")
    table = bloom.build(values)
    inside = np.array([r["h"] for r in values.collect()], np.int64).view(np.uint64)
    assert len(bloom.passing(table, inside)) == 200_000
    others = np.random.default_rng(3).integers(0, 2**63, 200_000, dtype=np.uint64)
    assert len(bloom.passing(table, others)) < 6_000
