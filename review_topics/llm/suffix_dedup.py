"""Exact removal of repeated passages: every byte covered by a string of LENGTH bytes that starts earlier somewhere else.

Suffix sorting needs the strings that may be equal in one place. Each window of LENGTH bytes holds an anchor, the GRAM bytes
whose hash is least in it; equal windows have equal anchors in the same place. So the surroundings of equal anchors, at most
LENGTH - GRAM bytes to either side, hold all equal windows. Surroundings that are alike as a whole are settled by their hash
and place alone. Only for anchors with different surroundings are the bytes fetched; the suffixes of these segments are
sorted by the grouping construction, and each run of suffixes that share LENGTH bytes keeps its earliest window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_topics.llm import bloom, words
from review_topics.llm.suffix_groups import suffix_arrays
from review_topics.session import hot_lookup, stage, unstage

LENGTH = 100
GRAM = 48
REACH = LENGTH - GRAM
SORT_SYMBOLS = 1_000_000
BUNDLE_BYTES = 3_000_000
HOT_SEGMENTS = 20_000
SMALL_GROUP = 16
_U = np.uint64
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)


def _slide(values: np.ndarray, width: int, combine) -> np.ndarray:
    """``combine`` over each ``width`` neighbours, for an idempotent ``combine``."""
    done = 1
    while done * 2 <= width:
        values = combine(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return combine(values[:-rest], values[rest:]) if rest else values


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * _U(0x9E3779B97F4A7C15) + (b ^ (b >> _U(29)))

    out, done = _BYTE[data], 1
    while done * 2 <= GRAM:
        out = join(out[:-done], out[done:])
        done *= 2
    return words.mix(join(out[: -(GRAM - done)], out[GRAM - done :]) if done < GRAM else out)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, hashes of all grams)`` of a text of at least LENGTH bytes; of equal least grams all are anchors."""
    grams = gram_hashes(data)
    least = _slide(grams, REACH + 1, np.minimum)
    edge = np.zeros(REACH, _U)
    most = _slide(np.concatenate((edge, least, edge)), REACH + 1, np.maximum)
    return np.flatnonzero(most == grams), grams


def merge_ranges(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Touching or overlapping ranges of one owner as one, in order."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    _, code = np.unique(owner, return_inverse=True)
    lift = code.astype(np.int64) << 32  # so that no range reaches into the next owner's
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate(([True], (start + lift)[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return owner[first], start[first], (reach - lift)[np.append(first[1:], len(owner)) - 1]


def _batch(columns: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_PLACES = ["key", "surroundings", "doc_id", "start", "before", "size"]
_PLACE_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with the hash of their surroundings, and, without such a hash, ranges that repeat inside the part."""
    for batch in batches:
        for part in words.sub_batches(batch, "text", 8 << 20):
            data, offsets = words.text_buffer(part.column("text"))
            found: list[tuple[np.ndarray, ...]] = []
            for doc, lo, hi in zip(np.asarray(part.column("doc_id")), offsets, offsets[1:]):
                if hi - lo < LENGTH:
                    continue
                place, grams = anchors(data[lo:hi])
                left, right = np.minimum(REACH, place), np.minimum(REACH, hi - lo - place - GRAM)
                whole = left.astype(np.uint64) << _U(32) | right.astype(np.uint64)
                for at in (place - left, place - left // 2, place + right // 2, place + right):
                    whole = words.mix(whole + grams[at])
                found.append((grams[place], whole, np.full(len(place), doc), place - left, left, left + GRAM + right))
            if not found:
                continue
            key, whole, doc, start, left, size = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((start + left, doc, whole, key))
            key, whole, doc, start, left, size = (c[order] for c in (key, whole, doc, start, left, size))
            again = np.concatenate(([False], (key[1:] == key[:-1]) & (whole[1:] == whole[:-1])))
            lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(key))))
            own = again & ((doc != doc[lead]) | (start + left != (start + left)[lead]))
            first = ~again
            yield _batch([key[first].view(np.int64), whole[first].view(np.int64), doc[first], start[first], left[first], size[first]], _PLACE_KINDS, _PLACES)
            owner, begin, end = merge_ranges(doc[own], start[own], start[own] + size[own])
            spread = words.mix(owner.astype(np.uint64) + (begin.astype(np.uint64) << _U(40))).view(np.int64)
            yield _batch([spread, pa.nulls(len(owner), pa.int64()), owner, begin, np.zeros(len(owner), np.int32), end - begin], _PLACE_KINDS, _PLACES)


def _only(sent):
    """Documents that a filter of their numbers' hashes lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.asarray(batch.column("hash")).view(np.uint64)
            yield batch.take(pa.array(bloom.passing(sent.value, hashes))).select(["doc_id", "text"])

    return run


_SEGMENTS = ["key", "doc_id", "start", "before", "low", "high", "segment"]
_SEGMENT_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_SEGMENT_SCHEMA = "key long, doc_id long, start int, before int, low int, high int, segment binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.sub_batches(batch, "text", 4 << 20):
            rows = []
            for doc, text, keys, starts, befores, sizes in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "key", "start", "before", "size"))):
                data = (text or "").encode()
                rows += [(k, doc, s, b, 0, REACH, data[s : s + n]) for k, s, b, n in zip(keys, starts, befores, sizes) if s + n <= len(data)]
            if rows:
                yield _batch(list(zip(*rows)), _SEGMENT_KINDS, _SEGMENTS)


def window_range(segment: bytes, before: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest distance, within ``low`` and ``high``, of a window's start from the anchor."""
    return max(low, LENGTH - (len(segment) - before)), min(high, before)


def _halves(low: int, high: int) -> list[tuple[int, int]]:
    middle = (low + high) // 2
    return [(low, middle), (middle + 1, high)]


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment for the nearer and for the farther half of its windows, keyed by the bytes all of these hold."""
    for batch in batches:
        rows = []
        for key, doc, start, before, low, high, segment in zip(*(batch.column(c).to_pylist() for c in _SEGMENTS)):
            for lo, hi in _halves(low, high):
                a, b = window_range(segment, before, lo, hi)
                if a <= b:
                    held = np.frombuffer(segment[before - lo : before - hi + LENGTH], np.uint8).astype(np.uint64)
                    folded = words.mix(held + words.mix(np.arange(len(held), dtype=np.uint64))).sum(dtype=_U)
                    mixed = words.mix(np.array([key], np.int64).view(np.uint64) + folded * _U(0x9E3779B97F4A7C15) + _U(lo * 64 + hi))
                    rows.append((int(mixed.view(np.int64)[0]), doc, start + before - b, b, lo, hi, segment[before - b : before - a + LENGTH]))
        if rows:
            yield _batch(list(zip(*rows)), _SEGMENT_KINDS, _SEGMENTS)


def _comparable(members: list[int], segments, befores, low: int, high: int) -> Iterator[tuple[list[int], int, int]]:
    """Small groups of segments that may share a window, with the range of windows to compare."""
    members = [i for i in members if np.less_equal(*window_range(segments[i], befores[i], low, high))]
    if len(members) < 2:
        return
    if len(members) <= SMALL_GROUP or low == high:
        yield members, low, high
        return
    for lo, hi in _halves(low, high):
        alike: dict[bytes, list[int]] = {}
        for i in members:
            a, b = window_range(segments[i], befores[i], lo, hi)
            if a <= b:
                alike.setdefault(segments[i][befores[i] - lo : befores[i] - hi + LENGTH], []).append(i)
        for group in alike.values():
            yield from _comparable(group, segments, befores, lo, hi)


def repeated_windows(strings: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(string, piece number over all strings, offset)`` of windows and a run number: equal windows of a string share one.

    Suffix arrays of all strings are made together; a window is a suffix with LENGTH bytes left in its piece.
    """
    pieces = [p for s in strings for p in s]
    sizes = np.array([len(p) for p in pieces])
    counts = np.array([len(s) for s in strings])
    data = np.frombuffer(b"".join(p + b"\0" for p in pieces), np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = data.astype(np.int64) + 2
    text[begin + sizes] = 1
    last = np.cumsum(counts) - 1
    text[(begin + sizes)[last]] = 0
    order = suffix_arrays(text, begin[last - counts + 1])
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    offset = np.arange(len(text)) - begin[piece]
    order = order[(offset + LENGTH <= sizes[piece])[order]]
    eights = np.zeros(len(data), _U)
    for k in range(8):
        eights[: len(data) - 7] |= data[k : len(data) - 7 + k].astype(np.uint64) << _U(8 * k)
    string = np.repeat(np.arange(len(strings)), counts)[piece]
    a, b = order[:-1], order[1:]
    same = np.flatnonzero(string[a] == string[b])
    for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        same = same[eights[a[same] + k] == eights[b[same] + k]]
    equal = np.zeros(len(order), bool)
    equal[same + 1] = True
    return piece[order], offset[order], np.cumsum(~equal) - 1


def _sorted_repeats(table: pa.Table) -> pa.Table:
    keys, doc, start, before, low, high = (np.asarray(table.column(c).combine_chunks()) for c in _SEGMENTS[:-1])
    segments = table.column("segment").to_pylist()
    groups: dict[tuple[int, int, int], list[int]] = {}
    for i in np.lexsort((start, doc)).tolist():
        groups.setdefault((keys[i], low[i], high[i]), []).append(i)
    found: list[tuple[np.ndarray, np.ndarray]] = []  # document, start of a window that also starts earlier
    strings: list[list[bytes]] = []
    heads: list[list[tuple[int, int]]] = []
    symbols = 0
    befores = before.tolist()

    def sort() -> None:
        piece, offset, run = repeated_windows(strings)
        head = np.array([h for own in heads for h in own], np.int64)
        own_doc, own_start = head[piece, 0], head[piece, 1] + offset
        first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        _, rank = np.unique(own_doc, return_inverse=True)
        place = rank.astype(np.int64) << 32 | own_start
        again = place > np.repeat(np.minimum.reduceat(place, first), np.diff(np.append(first, len(run))))
        found.append((own_doc[again], own_start[again]))

    for (_, lo, hi), members in groups.items():
        for some, a, b in _comparable(members, segments, befores, int(lo), int(hi)):
            used = []
            for i in some:
                x, y = window_range(segments[i], befores[i], a, b)
                used.append((int(doc[i]), int(start[i]) + befores[i] - y, segments[i][befores[i] - y : befores[i] - x + LENGTH]))
            distinct: dict[bytes, tuple[int, int]] = {}
            for own, begin, piece in sorted(used):
                if distinct.setdefault(piece, (own, begin)) != (own, begin):
                    n = len(piece) - LENGTH + 1
                    found.append((np.full(n, own), np.arange(begin, begin + n)))
            if len(distinct) > 1:
                strings.append(list(distinct))
                heads.append(list(distinct.values()))
                symbols += sum(len(s) + 1 for s in distinct)
            if symbols >= SORT_SYMBOLS:
                sort()
                strings, heads, symbols = [], [], 0
    if strings:
        sort()
    owner, begin = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    owner, begin, end = merge_ranges(owner, begin, begin + LENGTH)
    return pa.table({"doc_id": pa.array(owner, pa.int64()), "start": pa.array(begin, pa.int32()), "end": pa.array(end, pa.int32())})


def _ranges_by_sorting(segments: DataFrame, bundles: int) -> list[DataFrame]:
    """Repeated ranges of segments with one key. Keys with very many segments are split by more of their bytes first."""
    out = []
    while True:
        sizes = segments.groupBy("key").agg(F.count("*").alias("matches"))
        hot = sizes.where(F.col("matches") > HOT_SEGMENTS)
        cold = segments.join(hot.select("key"), "key", "left_anti")
        bundled = cold.withColumn("bundle", F.pmod(F.col("key"), F.lit(bundles)))
        out.append(bundled.groupBy("bundle").applyInArrow(_sorted_repeats, "doc_id long, start int, end int"))
        if hot.isEmpty():
            return out
        split = stage(hot_lookup(segments, hot, ["key"], "matches").select(*_SEGMENTS).mapInArrow(_halved, _SEGMENT_SCHEMA), "halves")
        # Halves that are alike as a whole are settled by their places.
        alike = split.groupBy("key", "segment").agg(F.min(F.struct("doc_id", "start")).alias("lead"), F.count("*").alias("matches"))
        placed = stage(hot_lookup(split, alike, ["key", "segment"], "matches"), "led")
        leads = F.struct("doc_id", "start") == F.col("lead")
        out.append(placed.where(~leads).select("doc_id", "start", (F.col("start") + F.length("segment")).cast("int").alias("end")))
        segments = placed.where(leads).select(*_SEGMENTS)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.sub_batches(batch, "text", 8 << 20):
            kept, spans = [], []
            for text, starts, ends in zip(*(part.column(c).to_pylist() for c in ("text", "starts", "ends"))):
                data, at, pieces, own = (text or "").encode(), 0, [], []
                if starts:
                    _, first, last = merge_ranges(np.zeros(len(starts), np.int64), np.array(starts, np.int64), np.array(ends, np.int64))
                    own = [{"start": a, "end": b} for a, b in zip(first.tolist(), last.tolist())]
                for s in own:
                    pieces.append(data[at : s["start"]])
                    at = s["end"]
                kept.append(b"".join([*pieces, data[at:]]) if own else data)
                spans.append(own)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, pa.array(kept, pa.binary()), pa.array(spans, kind)], names=["doc_id", "n_bytes", "kept", "spans"])


def _untouched(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.asarray(pc.fill_null(batch.column("hash"), 0)).view(np.uint64)
            out = np.ones(batch.num_rows, bool)
            out[bloom.passing(sent.value, hashes)] = False
            out |= np.asarray(batch.column("doc_id").is_null())
            rest = batch.filter(pa.array(out))
            none = pa.nulls(rest.num_rows, pa.list_(pa.int32()))
            yield from _kept([pa.RecordBatch.from_arrays([rest.column("doc_id"), rest.column("text"), none, none], names=["doc_id", "text", "starts", "ends"])])

    return run


def without_repeats(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, kept, spans)``: each text as UTF-8 without the bytes that a repeated string covers.

    A byte goes when a string of LENGTH bytes covers it that also starts earlier: in a document with a smaller doc_id, or
    further ahead in the same one. Strings are judged on the input; they never run from one document into another.
    ``spans`` are the removed runs, as byte ranges. Equal surroundings of an anchor are known by two 64-bit hashes.

    Null texts are empty, and texts of fewer than LENGTH bytes stay as they are. A row without doc_id has no place in the
    order: it stays whole and makes nothing a repeat. Repeated rows are one place and get the same result. A doc_id must
    not stand for different texts; if it does, ranges found in either are cut from both. Other columns are ignored.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = rows.where("doc_id is not null and text is not null")
    places = numbered.mapInArrow(_places, "key long, surroundings long, doc_id long, start int, before int, size int")
    places = places.withColumn("whole", F.col("surroundings").isNull())
    same_key = Window.partitionBy("whole", "key")
    order = Window.partitionBy("whole", "key", "surroundings").orderBy("doc_id", F.expr("start + before"))
    judged = places.select(
        "*",
        F.rank().over(order).alias("rank"),
        F.count("*").over(same_key).alias("n"),
        (F.min("surroundings").over(same_key) != F.max("surroundings").over(same_key)).alias("mixed"),
    ).where(F.col("whole") | (F.col("n") > 1))
    repeats = F.col("whole") | (F.col("rank") > 1)
    judged = judged.where(repeats | F.col("mixed")).select("key", "doc_id", "start", "before", "size", repeats.alias("repeats"))
    judged = stage(judged, "places")

    hashed = F.xxhash64("doc_id").alias("hash")
    touched = spark.sparkContext.broadcast(bloom.build(judged.select(hashed).distinct()))
    wanted = judged.where(~F.col("repeats"))
    bundles = max(1, wanted.count() * (2 * LENGTH - GRAM) // BUNDLE_BYTES)
    listed = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("key", "start", "before", "size")).alias("a")).select("doc_id", "a.key", "a.start", "a.before", "a.size")
    affected = rows.select("doc_id", "text", hashed).where("doc_id is not null").mapInArrow(_only(touched), "doc_id long, text string")
    segments = stage(affected.join(listed, "doc_id").mapInArrow(_segments, _SEGMENT_SCHEMA), "segments")

    ranges = judged.where("repeats").select("doc_id", "start", (F.col("start") + F.col("size")).alias("end"))
    for part in _ranges_by_sorting(segments, bundles):
        ranges = ranges.unionByName(part)
    per_document = stage(ranges.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("r")).select("doc_id", F.col("r.start").alias("starts"), F.col("r.end").alias("ends")), "ranges")
    unstage(judged, segments)
    schema = "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"
    cut = affected.join(per_document, "doc_id", "left").select("doc_id", "text", "starts", "ends").mapInArrow(_kept, schema)
    return cut.unionByName(rows.select("doc_id", "text", hashed).mapInArrow(_untouched(touched), schema))
