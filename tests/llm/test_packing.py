"""Packing against the tokenizer itself and the rules of the plan."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from review_topics.llm import packing, queries


def bins_of(histogram, capacity):
    slots, bins = packing.plan_slots(histogram, capacity)
    found = {}
    by_length = {}
    for length, rank, first, each, offset in slots.tolist():
        by_length.setdefault(length, []).append((rank, first, each, offset))
    for length, n in histogram.items():
        own = sorted(by_length.get(length, []))
        for r in range(n):
            rank, first, each, offset = [s for s in own if s[0] <= r][-1]
            found.setdefault(first + (r - rank) // each, []).append((offset + (r - rank) % each * length, length))
    return found, bins, len(slots)


@pytest.mark.parametrize("seed", range(12))
def test_plan_packs_every_piece_once_and_without_gaps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 97, 256])
    histogram = dict(Counter(rng.choice([rng.randint(1, capacity), rng.randint(1, max(1, capacity // 4))]) for _ in range(rng.randint(1, 900))))
    found, bins, slots = bins_of(histogram, capacity)
    assert sorted(found) == list(range(bins)) and slots <= capacity * 12
    for pieces in found.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in pieces) <= 2
    assert Counter(length for pieces in found.values() for _, length in pieces) == Counter(histogram)


def descending_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        at = min((i for i, g in enumerate(gaps) if g >= n), key=lambda i: gaps[i], default=None)
        if at is None:
            gaps.append(capacity - n)
        else:
            gaps[at] -= n
    return len(gaps)


def test_plan_needs_about_as_few_bins_as_best_fit_of_single_pieces():
    rng = random.Random(4)
    for shape in (lambda: rng.randint(1, 200), lambda: int(min(200, rng.lognormvariate(3.5, 1) + 1)), lambda: rng.randint(60, 140)):
        lengths = [shape() for _ in range(1500)]
        _, bins, _ = bins_of(dict(Counter(lengths)), 200)
        assert bins <= 1.01 * descending_best_fit(lengths, 200) + 1


def test_plan_of_nothing():
    assert packing.plan_slots({}, 8)[1] == 0


def test_ids_are_those_of_the_exact_tokenizer():
    tokenizer = packing.byte_bpe_50k()
    exact = Tokenizer.from_file(tokenizer.json_path)
    texts = ["", " ", "a  b\n\n c\t", "naïve Äpfel — “quoted”…", "日本語 текст", "<|endoftext|>x", "x" * 500, "it's we'll 123456", " é​", "🙂" * 3, "a\r\n b", "ÀÉîõü ñandú ǅ ɏ"]
    for text in texts:
        assert tokenizer.encode(text) == exact.encode(text, add_special_tokens=False).ids


def test_whole_query(spark, sf):
    exact = Tokenizer.from_file(packing.byte_bpe_50k().json_path)
    want = {}
    for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = [*exact.encode(row["text"] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[row["doc_id"], k] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    out = queries.QUERIES["op7_best_fit_packing"](spark, sf).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == want and len(out) == len(want)
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.02 * sum(r["length"] for r in out) / 2048 + 2


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "x " * 9000)], "doc_id long, text string").selectExpr("*", "1 as task", "2 as rank")
    out = packing.best_fit(packing.token_pieces(docs, packing.byte_bpe_50k())).collect()
    assert sum(r["length"] == 1 for r in out) == 3
    longest = sorted((r["piece"], r["length"]) for r in out if r["doc_id"] == 2)
    assert all(n == 2048 for _, n in longest[1:]) and longest[0][1] <= 2048
    assert packing.best_fit(packing.token_pieces(docs.limit(0), packing.byte_bpe_50k())).count() == 0
