"""Benchmark decontamination by spaced seeds.

A fixed mask looks at five of up to nine consecutive words and ignores the others, so a seed survives substituted words.
Every placement of two substitutions among 13 words, of three among 15 and of four among 20 leaves one of the four masks
a hit. Training positions whose seed passes a Bloom filter of fixed size are joined with the seeds of the benchmark;
around each hit the words of both sides are compared on the hit's diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.llm import bloom, words
from review_topics.session import hot_lookup, stage

MASKS = ((0, 2, 5, 6, 7), (0, 5, 6, 7, 8), (0, 1, 2, 4, 7), (0, 1, 5, 6, 8))
SHORTEST = min(m[-1] for m in MASKS) + 1
MIN_WORDS = 13
SHARE = 0.8
CONTEXT = 64


def _salt(mask: tuple[int, ...]) -> np.uint64:
    value = sum(1 << k for k in mask)
    return words.mix(np.array([value + 77], np.uint64))[0]


def seed_hashes(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Seed at each position of a word sequence at which the mask fits."""
    n = len(hashes) - mask[-1]
    out = np.full(max(0, n), _salt(mask), np.uint64)
    for k in mask:
        if n > 0:
            out = words.mix(out + hashes[k : k + n])
    return out


def masks_for(lengths: list[int]) -> list[tuple[int, ...]]:
    """The fixed masks and, for benchmark texts too short for any of them, the masks that look at all their words."""
    return [*MASKS, *(tuple(range(n)) for n in sorted(set(lengths)) if 0 < n < SHORTEST)]


def _benchmark_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, offsets = words.word_hashes(batch.column("text"))
        lists = [hashes[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(np.diff(offsets), pa.int32()), pa.array(lists, pa.binary())], names=["item_id", "n", "words"])


def _benchmark_seeds(masks: list[tuple[int, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, key, text in zip(batch.column("item_id").to_pylist(), batch.column("item_key").to_pylist(), batch.column("words").to_pylist()):
                own = np.frombuffer(text, np.uint64)
                for mask in masks:
                    if len(mask) == mask[-1] + 1 and len(own) != len(mask):
                        continue
                    seeds = seed_hashes(own, mask).view(np.int64)
                    items, keys = (pa.array([x] * len(seeds), pa.int64()) for x in (item, key))
                    at = pa.array(np.arange(len(seeds), dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(seeds), items, keys, at], names=["seed", "item_id", "item_key", "at"])

    return run


def _training_runs(masks: list[tuple[int, ...]], sent):
    """Runs of positions that pass the filter, with the words around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        names = ["doc_id", "doc_key", "run", "first", "words", "seeds", "places"]
        for batch in batches:
            for part in words.sub_batches(batch, "text", 1 << 20):
                hashes, offsets = words.word_hashes(part.column("text"))
                found, places = [], []
                for mask in masks:
                    seeds = seed_hashes(hashes, mask)
                    hit = bloom.passing(table, seeds)
                    doc = np.searchsorted(offsets, hit, "right") - 1
                    hit = hit[hit + mask[-1] < offsets[doc + 1]]
                    found.append(seeds[hit])
                    places.append(hit)
                place = np.concatenate(places)
                if not len(place):
                    continue
                order = np.argsort(place, kind="stable")
                place, seed = place[order], np.concatenate(found)[order]
                doc = np.searchsorted(offsets, place, "right") - 1
                new = np.concatenate(([True], (np.diff(doc) > 0) | (np.diff(place) > CONTEXT)))
                edges = [*np.flatnonzero(new), len(place)]
                ids, keys = part.column("doc_id").to_pylist(), part.column("doc_key").to_pylist()
                rows: list[list] = [[] for _ in names]
                for a, b in zip(edges, edges[1:]):
                    lo, hi = offsets[doc[a]], offsets[doc[a] + 1]
                    begin, end = max(lo, place[a] - CONTEXT), min(hi, place[b - 1] + CONTEXT + 16)
                    values = (ids[doc[a]], keys[doc[a]], int(place[a] - lo), int(begin - lo), hashes[begin:end].tobytes(), seed[a:b].view(np.int64), (place[a:b] - lo).astype(np.int32))
                    for column, value in zip(rows, values):
                        column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)

    return run


def best_overlap(same: np.ndarray, share: Fraction) -> tuple[int, int, int]:
    """``(start, length, matches)`` of the longest stretch with at least ``share`` matches that begins and ends in one."""
    gain = np.where(same, share.denominator, 0) - share.numerator
    sums = np.concatenate(([0], np.cumsum(gain)))
    low = np.minimum.accumulate(sums)
    best = (0, 0, 0)
    for end in range(len(same), 0, -1):
        if end < best[1] or not same[end - 1]:
            continue
        start = int(np.searchsorted(-low[:end], -sums[end]))  # the first start from which the sum is not below zero
        while start < end and not (same[start] and sums[start] <= sums[end]):
            start += 1
        if end - start >= max(1, best[1]):
            best = (start, end - start, int(same[start:end].sum()))
    return best


def _verify(min_words: int, share: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item, shift, first, text, passage in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "shift", "first", "words", "passage"))):
                own, other = np.frombuffer(text, np.uint64), np.frombuffer(passage, np.uint64)
                a, b = max(0, first - shift), min(len(other), first + len(own) - shift)
                if b <= a:
                    continue
                start, length, same = best_overlap(own[a + shift - first : b + shift - first] == other[a:b], share)
                if length >= min(min_words, len(other)):
                    rows.append((doc, item, length, same, a + start + shift, a + start))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "n_words", "n_same", "doc_start", "item_start"]
            )

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, share: float = SHARE) -> DataFrame:
    """``(doc_id, item_id, n_words, n_same, doc_start, item_start)``: the longest overlap of each document and passage.

    An overlap is a stretch of aligned words, at least ``share`` of them equal, that begins and ends with equal words and
    has ``min_words`` words or all words of a shorter passage. Counted from hits, it reaches CONTEXT words to either side,
    and on over a run of hits. Starts are word numbers from 0; the first start wins a tie.

    Passages of fewer than MIN_WORDS words are sure to be found only where all their words are equal.
    Null and empty texts and passages match nothing; rows without doc_id or item_id are left out; repeated rows give one
    row, and an id with several texts the longest overlap of these; other columns are ignored; with an empty table the result is empty.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("doc_key"), "text").where("doc_id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    items = items.mapInArrow(_benchmark_words, "item_id long, n int, words binary").where("n > 0").dropDuplicates()
    items = stage(items.withColumn("item_key", F.xxhash64("words")), "passages")
    masks = masks_for([r["n"] for r in items.where(F.col("n") < SHORTEST).select("n").distinct().collect()])
    seeds = stage(items.mapInArrow(_benchmark_seeds(masks), "seed long, item_id long, item_key long, at int"), "passage-seeds")
    sent = documents.sparkSession.sparkContext.broadcast(bloom.build(seeds.select("seed")))
    runs = stage(
        docs.mapInArrow(_training_runs(masks, sent), "doc_id long, doc_key long, run int, first int, words binary, seeds array<long>, places array<int>"),
        "runs",
    )
    hits = runs.select("doc_id", "doc_key", "run", F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select(
        "doc_id", "doc_key", "run", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("place")
    )
    entries = seeds.groupBy("seed").agg(F.collect_list(F.struct("item_id", "item_key", "at")).alias("entries"))
    counted = entries.join(hits.groupBy("seed").agg(F.count("*").alias("matches")), "seed")
    met = hot_lookup(hits, counted, ["seed"], "matches").select("doc_id", "doc_key", "run", "place", F.explode("entries").alias("entry"))
    diagonals = met.select("doc_id", "doc_key", "run", "entry.item_id", "entry.item_key", (F.col("place") - F.col("entry.at")).alias("shift")).distinct()
    diagonals = stage(diagonals, "diagonals")
    passages = items.select("item_id", "item_key", F.col("words").alias("passage"))
    passages = passages.join(diagonals.groupBy("item_id", "item_key").agg(F.count("*").alias("matches")), ["item_id", "item_key"])
    pairs = hot_lookup(diagonals, passages, ["item_id", "item_key"], "matches")
    around = runs.select("doc_id", "doc_key", "run", "first", "words").dropDuplicates(["doc_id", "doc_key", "run"])
    checked = pairs.join(around, ["doc_id", "doc_key", "run"]).mapInArrow(
        _verify(min_words, Fraction(str(share))), "doc_id long, item_id long, n_words int, n_same int, doc_start int, item_start int"
    )
    best = F.max(F.struct("n_words", "n_same", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"))).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.n_words", "best.n_same", (-F.col("best.d")).alias("doc_start"), (-F.col("best.i")).alias("item_start")
    )
