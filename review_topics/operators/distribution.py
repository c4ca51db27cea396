"""Soft topic distribution of documents and tokens over sliding windows of words.

Documents are turned into numbers where they are read: blocks of a quarter of a million words, each with a list of its different
words. Only these lists meet the weights, a word at most once a block, and what comes back to a block are the postings of its
words: which topics they weigh in, and how much. A window adds up the postings of its words in an accumulator over a bounded
tile of windows and topics. Topics are dealt over tiles, so memory depends neither on how many there are nor on the vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_topics.functions import text as T
from review_topics.operators.represent import topic_norms
from review_topics.session import broadcast_checked, hot_lookup, stage, stage_counted

# Words of a block, topics of a tile, and cells (windows times topics) of an accumulator.
BLOCK_WORDS = 1 << 18
TILE_TOPICS = 512
CELLS = 1 << 18
# Entries of a table of words by topics that windows add up row by row; larger ones, and those with fewer postings than one in
# SPARSE entries, are left as postings.
TABLE = 1 << 22
SPARSE = 8


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document with its words as numbers, and before those of a block a row with the block's words."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(batch.column("tokens").value_lengths().fill_null(0)).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // BLOCK_WORDS
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            rows = batch.slice(low, high - low)
            encoded = rows.column("tokens").flatten().dictionary_encode()
            ends = pa.array(np.concatenate(([0, 0], np.cumsum(sizes[low:high]))).astype(np.int32))
            codes = pa.ListArray.from_arrays(ends, encoded.indices.cast(pa.int32()))
            listed = np.full(high - low + 2, len(encoded.dictionary), np.int32)
            listed[0] = 0
            words = pa.ListArray.from_arrays(pa.array(listed), encoded.dictionary, mask=pa.array(np.arange(high - low + 1) > 0))
            ids = pa.concat_arrays([pa.nulls(1, rows.column("doc_id").type), rows.column("doc_id")])
            nth = pa.array(np.arange(-1, high - low), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(high - low + 1, block)), nth, ids, codes, words], names=["block", "nth", "doc_id", "codes", "words"])
            block += 1


def blocks_of(docs: DataFrame) -> DataFrame:
    """``(block, nth, doc_id, codes, words)``, written once. Rows with ``nth`` -1 hold a block's different words by number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = docs.select("doc_id", T.tokens(F.col("document")).alias("tokens"))
    return stage(tokens.mapInArrow(_blocked, f"block long, nth int, doc_id {kind}, codes array<int>, words array<string>"), "blocks")


def _postings(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """``(block, tile, code, topics, weights)``: what the words of each block weigh, by tiles of topics.

    Weights are divided by the topic's length. How many blocks hold a word is counted on the blocks at hand, whatever the
    word's use in the model; no word meets the weights more often than that.
    """
    words = blocks.where("nth = -1").select("block", F.posexplode("words").alias("code", "term"))
    lengths = broadcast_checked(topic_norms(weights).where("topic_norm > 0"))
    scaled = weights.where(F.col("topic_id") >= 0).join(lengths, "topic_id")
    tile = F.floor(F.col("topic_id") / TILE_TOPICS).cast("int").alias("tile")
    in_tile = scaled.groupBy("term", tile).agg(
        F.collect_list(F.struct((F.col("topic_id") % TILE_TOPICS).cast("int").alias("topic"), (F.col("weight") / F.col("topic_norm")).alias("w"))).alias("list")
    )
    by_term = in_tile.groupBy("term").agg(F.collect_list(F.struct("tile", "list")).alias("tiles"))
    used, seen = stage_counted(by_term.join(words.groupBy("term").agg(F.count("*").alias("matches")), "term"), "matches")
    met = hot_lookup(words, used, ["term"], "matches", seen).select("block", "code", F.inline("tiles"))
    return met.select("block", "tile", "code", F.col("list.topic").alias("topics"), F.col("list.w").alias("weights"))


def _table(starts: np.ndarray, topics: np.ndarray, weights: np.ndarray, width: int) -> np.ndarray | None:
    """Weights by word and topic, where most words weigh in many topics and the table is small."""
    entries = (len(starts) - 1) * width
    if entries > TABLE or len(topics) * SPARSE < entries:
        return None
    words = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return np.bincount(words * width + topics, weights, entries).reshape(-1, width)


def _window_scores(tokens: np.ndarray, edges: np.ndarray, starts: np.ndarray, topics: np.ndarray, weights: np.ndarray, window: int, stride: int, minimum: float):
    """``(document, first word, words, topic, score)`` of the windows and topics whose cosine reaches ``minimum``, piece by piece.

    ``tokens`` of all documents with their ``edges``; word ``c`` has the postings ``starts[c]`` to ``starts[c + 1]`` of ``topics`` and
    ``weights``. The length of a window is the root of its squared word counts: its size plus two for each equal pair in it.
    """
    lengths = np.diff(edges)
    size = np.minimum(lengths, window)
    count = np.where(lengths > 0, (lengths - size) // stride + 1, 0)
    doc = np.repeat(np.arange(len(lengths)), count)
    first = edges[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * stride
    size = size[doc]
    width = int(topics.max(initial=0)) + 1
    at_once = max(1, CELLS // width)
    table = _table(starts, topics, weights, width)
    for low in range(0, len(doc), at_once):
        own, begin, words = (x[low : low + at_once] for x in (doc, first, size))
        inside = [np.flatnonzero(words > k) for k in range(window)]
        pairs = np.zeros(len(own))
        for a, b in combinations(range(window), 2):
            pairs[inside[b]] += tokens[begin[inside[b]] + a] == tokens[begin[inside[b]] + b]
        norms = np.sqrt(words + 2 * pairs)
        cells, values = [], []
        dots = np.zeros((len(own), width))
        for k in range(window):  # the words that enter k places behind the first
            word = tokens[begin[inside[k]] + k]
            if table is not None:
                dots[slice(None) if len(word) == len(own) else inside[k]] += table[word]
                continue
            n = starts[word + 1] - starts[word]
            at = np.arange(int(n.sum())) + np.repeat(starts[word] - (np.cumsum(n) - n), n)
            cells.append(np.repeat(inside[k], n) * width + topics[at])
            values.append(weights[at])
        if table is None:
            dots = np.bincount(np.concatenate(cells), np.concatenate(values), len(own) * width).reshape(-1, width)
        row, topic = np.nonzero((dots != 0) & (dots >= ((minimum - 1e-8) * norms)[:, None]))  # all that may reach it after rounding
        score = dots[row, topic] / norms[row]
        high = np.round(score, 9) >= minimum
        row = row[high]
        yield own[row], begin[row], words[row], topic[high], score[high]


def _added(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different cells of all parts and the sum of their values."""
    held = [(np.zeros(0, np.int64), np.zeros(0))]
    for cells, values in parts:
        cell, place = np.unique(cells, return_inverse=True)
        held.append((cell, np.bincount(place, values, len(cell))))
    cells, values = (np.concatenate(x) for x in zip(*held))
    cell, place = np.unique(cells, return_inverse=True)
    return cell, np.bincount(place, values, len(cell)).astype(float)


def _scored(blocks: DataFrame, weights: DataFrame, rows_of: Callable, schema: str, with_words: bool, window: int, stride: int, minimum: float) -> DataFrame:
    """Blocks meet their postings, tile by tile; ``rows_of(pieces, rows, words, first topic)`` makes the result's columns."""
    postings = stage(_postings(blocks, weights), "postings")
    pairs = postings.select(F.col("block").alias("own_block"), F.col("tile").alias("own_tile")).distinct()
    wanted = blocks if with_words else blocks.where("nth >= 0").withColumn("words", F.lit(None).cast("array<string>"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.combine_chunks().sort_by("nth")
        words = None
        if with_words:
            words = rows.column("words").chunk(0)[0].values
            rows = rows.slice(1).combine_chunks()
        codes = rows.column("codes").chunk(0) if rows.num_rows else pa.array([], pa.list_(pa.int32()))
        tokens = np.asarray(codes.flatten()).astype(np.int64)
        edges = np.concatenate(([0], np.cumsum(np.asarray(codes.value_lengths()).astype(np.int64))))
        order = np.argsort(np.asarray(right.column("code")), kind="stable")
        right = right.take(pa.array(order)).combine_chunks()
        code = np.asarray(right.column("code"))
        lists = right.column("topics").chunk(0), right.column("weights").chunk(0)
        n = np.zeros(int(max(tokens.max(initial=-1), code.max(initial=-1))) + 2, np.int64)
        n[code + 1] = np.asarray(lists[0].value_lengths())
        topics, values = (np.asarray(x.flatten()) for x in lists)
        pieces = _window_scores(tokens, edges, np.cumsum(n), topics.astype(np.int64), values, window, stride, minimum)
        tile = right.column("tile")[0].as_py()
        return pa.table(rows_of(pieces, rows, tokens, edges, words, tile * TILE_TOPICS))

    left = wanted.join(pairs, F.col("block") == F.col("own_block")).select("nth", "doc_id", "codes", "words", F.col("own_block").alias("block"), F.col("own_tile").alias("tile"))
    return left.groupBy("block", "tile").cogroup(postings.groupBy("block", "tile")).applyInArrow(run, schema)


def approximate_distribution(
    docs: DataFrame, weights: DataFrame, window: int = 4, stride: int = 1, min_similarity: float = 0.1
) -> DataFrame:
    """``(doc_id, topic_id, p)``: window scores summed per topic, as shares of the document's total.

    A document none of whose windows reaches the minimum has no row. Rows that share a doc_id are documents each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def masses(pieces: Iterator[tuple], rows: pa.Table, tokens: np.ndarray, edges: np.ndarray, words, base: int) -> dict:
        cell, mass = _added((doc * TILE_TOPICS + topic, score) for doc, _, _, topic, score in pieces)
        at = pa.array(cell // TILE_TOPICS)
        return {
            "block": rows.column("block").take(at), "nth": rows.column("nth").take(at), "doc_id": rows.column("doc_id").take(at),
            "topic_id": pa.array((base + cell % TILE_TOPICS).astype(np.int32)), "mass": pa.array(mass),
        }

    found = _scored(blocks_of(docs), weights, masses, f"block long, nth int, doc_id {kind}, topic_id int, mass double", False, window, stride, min_similarity)
    total = F.sum("mass").over(Window.partitionBy("block", "nth"))
    return found.select("doc_id", "topic_id", (F.col("mass") / total).alias("p"))


def token_distribution(
    docs: DataFrame, weights: DataFrame, window: int = 4, stride: int = 1, min_similarity: float = 0.1
) -> DataFrame:
    """``(doc_id, topic_id, p, pos, term)``: each window's score credited to every token in it."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def credits(pieces: Iterator[tuple], rows: pa.Table, tokens: np.ndarray, edges: np.ndarray, words, base: int) -> dict:
        def credited() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for _, begin, size, topic, score in pieces:
                inside = [size > k for k in range(int(size.max(initial=0)))]
                cells = [(begin[own] + k) * TILE_TOPICS + topic[own] for k, own in enumerate(inside)]
                yield np.concatenate([np.zeros(0, np.int64), *cells]), np.concatenate([np.zeros(0), *(score[own] for own in inside)])

        cell, p = _added(credited())
        at = cell // TILE_TOPICS
        doc = np.searchsorted(edges, at, "right") - 1
        return {
            "doc_id": rows.column("doc_id").take(pa.array(doc)), "topic_id": pa.array((base + cell % TILE_TOPICS).astype(np.int32)),
            "p": pa.array(p),
            "pos": pa.array((at - edges[doc]).astype(np.int32)), "term": words.take(pa.array(tokens[at])),
        }

    schema = f"doc_id {kind}, topic_id int, p double, pos int, term string"
    return _scored(blocks_of(docs), weights, credits, schema, True, window, stride, min_similarity)


def shown_distribution(distribution: DataFrame, labels: DataFrame, doc_id, min_p: float = 0.0) -> DataFrame:
    """``(topic_id, label, p)`` of one document, for display."""
    rows = distribution.where((F.col("doc_id") == doc_id) & (F.round("p", 9) >= min_p))
    return rows.join(broadcast_checked(labels), "topic_id", "left").select("topic_id", "label", "p")


def token_table(token_rows: DataFrame, doc_id, topic_ids: list[int]) -> DataFrame:
    """Tokens of one document by position, one column per topic."""
    rows = token_rows.where(F.col("doc_id") == doc_id).groupBy("pos", "term")
    return rows.agg(*[F.coalesce(F.sum(F.when(F.col("topic_id") == t, F.col("p"))), F.lit(0.0)).alias(f"topic_{t}") for t in topic_ids])
