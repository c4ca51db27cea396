"""Best-fit packing of token pieces into sequences of fixed capacity, planned on lengths instead of documents.

Pieces of one length are interchangeable, so the plan is made on the histogram of lengths: at most ``capacity`` counts,
whatever the corpus. Pieces over a third of the capacity come first: in descending order each is matched with the largest
partner that fits, at most two to a sequence. Smaller pieces then go, in descending order, to the tightest gap that takes
them. Equal bins are handled as one run, so the plan has some thousands of slots, and every piece finds its place by its
rank among the pieces of its length.
"""

from __future__ import annotations

import base64
import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_topics.llm import words
from review_topics.session import broadcast_checked, stage

CAPACITY = 2048
END_ID = 0
# Bases that are broadcast, one for each task and length; about 120 bytes each.
MAX_BASES = 500_000
# Beyond these characters, and where a special token is spelled out, the slower reference tokenizer is asked.
_UNUSUAL = re.compile("[^\x00-ɏ‐-‧]|<\\|endoftext\\|>")


@dataclass
class Tokenizer:
    """Ids of a byte-level BPE given as a tokenizers file and, for speed, the same vocabulary as ranks."""

    json_path: str
    ranks_path: str
    pattern: str
    _exact: object = None
    _fast: object = None

    def encode(self, text: str) -> list[int]:
        if _UNUSUAL.search(text):
            if self._exact is None:
                from tokenizers import Tokenizer as Exact

                self._exact = Exact.from_file(self.json_path)
            return self._exact.encode(text, add_special_tokens=False).ids
        if self._fast is None:
            import tiktoken

            with open(self.ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return self._fast.encode_ordinary(text)


def byte_bpe_50k() -> Tokenizer:
    import public_tokenizers

    return Tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _pieces(tokenizer: Tokenizer, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), Counter()
        names = ["doc_id", "piece", "start", "length", "task", "nth"]
        for batch in batches:
            for part in words.sub_batches(batch, "text", 1 << 20):
                rows, lists = [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array([*tokenizer.encode(text or ""), END_ID], np.int32)
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((doc, piece, a, b - a, task, seen[b - a]))
                        lists.append(ids[a:b])
                        seen[b - a] += 1
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))]
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists))))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids"])

    return run


def plan_slots(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Slots ``(length, first rank, first bin, pieces a bin, offset)`` by length and rank, and the number of bins.

    The piece of rank ``r`` in a slot goes to bin ``first bin + (r - first rank) // pieces a bin``. A run of equal bins
    takes a small length at most once before its gap falls below that length, and each time the gap at least halves, so
    there are at most about ``capacity * log2(capacity)`` slots.
    """
    left = dict(histogram)
    used: Counter = Counter()
    slots: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []  # gaps that bins have, ascending
    bins = 0

    def fill(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        slots.append((length, used[length], first, each, offset))
        used[length] += pieces
        left[length] -= pieces

    def leave(gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if not gaps.get(gap):
                bisect.insort(order, gap)
                gaps[gap] = []
            gaps[gap].append((first, count))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        while left[length]:
            fits = (p for p in large if p <= min(length, capacity - length) and left[p] > (p == length))
            partner = next(fits, None)
            if partner is None:
                count, rest = left[length], capacity - length
                fill(length, count, bins, 1, 0)
            elif partner == length:
                count, rest = left[length] // 2, capacity - 2 * length
                fill(length, 2 * count, bins, 2, 0)
            else:
                count, rest = min(left[length], left[partner]), capacity - length - partner
                fill(length, count, bins, 1, 0)
                fill(partner, count, bins, 1, length)
            leave(rest, bins, count)
            bins += count
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                each = capacity // length
                count = -(-left[length] // each)
                leave(capacity, bins, count)
                bins += count
                continue
            gap = order[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                order.pop(at)
            each = gap // length
            full = min(count, left[length] // each)
            taken = max(full, 1)
            pieces = full * each if full else left[length]
            fill(length, pieces, first, each, capacity - gap)
            leave(gap - (each if full else pieces) * length, first, taken)
            leave(gap, first + taken, count - taken)
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    return table, bins


def token_pieces(documents: DataFrame, tokenizer: Tokenizer, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, task, nth, ids)``, written once: ids of each document, an end id behind them.

    Documents of more than ``capacity`` ids are cut; the first piece takes what does not fill a whole one. ``task`` and
    ``nth`` number the pieces of one length. A null text is empty: one piece with the end id. Repeated rows are packed
    again, a null doc_id is kept, other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, piece int, start long, length int, task int, nth long, ids array<int>"
    return stage(rows.mapInArrow(_pieces(tokenizer, capacity), schema), "pieces")


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; whatever other columns they have, such as ids, stay.

    Only lengths pass the driver: one count for each of at most ``capacity`` lengths. A piece's rank is its number in its
    task behind the pieces of that length of earlier tasks. These bases are one number for a task and length; up to
    MAX_BASES of them go to every task, so that no piece moves, and more meet the pieces in a shuffled join.
    """
    counts = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = plan_slots(histogram, capacity)
    rows = pieces.sparkSession.createDataFrame(slots.tolist(), "length long, first long, bin long, each long, offset long")
    by_length = rows.groupBy(F.col("length").cast("int").alias("length")).agg(F.sort_array(F.collect_list(F.struct("first", "bin", "each", "offset"))).alias("_slots"))
    ranked = pieces.join(broadcast_checked(bases, MAX_BASES), ["length", "task"]).withColumn("_rank", F.col("_base") + F.col("nth"))
    slot = F.element_at(F.filter("_slots", lambda s: s["first"] <= F.col("_rank")), -1)
    placed = ranked.join(F.broadcast(by_length), "length").withColumn("_slot", slot).withColumn("_within", F.col("_rank") - F.col("_slot.first"))
    sequence = F.col("_slot.bin") + F.floor(F.col("_within") / F.col("_slot.each"))
    offset = F.col("_slot.offset") + F.col("_within") % F.col("_slot.each") * F.col("length")
    return placed.select(*pieces.columns, sequence.alias("sequence_id"), offset.alias("offset"))
