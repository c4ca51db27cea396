"""Document embedding: a built-in hashed encoder, and a seam for a real model. Both work where a document is read."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.functions import text as T
from review_topics.functions import vectors as X


# Words that a row takes to Python: Arrow batches are cut by rows, so this bounds them whatever the documents are long.
ROW_WORDS = 32
# Words and documents that are counted at a time, whatever the size of an Arrow batch; a longer document is a slice alone.
SLICE_WORDS = 1 << 16
SLICE_ROWS = 512
# Words whose terms are numbered at a time, and terms that are Python objects at a time.
NUMBERED_WORDS = 1 << 20
SLICE_TERMS = 1 << 16


def _cuts(sizes: np.ndarray, words: int, rows: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of ``sizes`` words: about ``words`` words and at most ``rows`` documents."""
    part = (np.cumsum(sizes) - sizes) // words
    cuts = np.union1d(np.flatnonzero(np.diff(part)) + 1, np.arange(0, len(sizes), rows)).tolist()
    return zip(cuts, [*cuts[1:], len(sizes)])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """``(doc_id, distinct terms, row, term number, tf)`` of slices of batches of token lists; by row, then by first use of the term.

    Terms are numbered for many slices at once, so that each is hashed seldom; the arrays of the words' places are those of a slice.
    """
    for batch in batches:
        sizes = np.asarray(batch.column("tokens").value_lengths().fill_null(0)).astype(np.int64)
        for first, last in _cuts(sizes, NUMBERED_WORDS, len(sizes) or 1):
            encoded = batch.column("tokens").slice(first, last - first).flatten().dictionary_encode()
            codes = np.asarray(encoded.indices)
            width = max(1, len(encoded.dictionary))
            own = sizes[first:last]
            edges = np.concatenate(([0], np.cumsum(own)))
            for low, high in _cuts(own, SLICE_WORDS, SLICE_ROWS):
                row = np.repeat(np.arange(high - low), own[low:high])
                key, tf = np.unique(row * width + codes[edges[low] : edges[high]], return_counts=True)
                yield batch.column("doc_id").slice(first + low, high - low), encoded.dictionary, key // width, key % width, tf


def _documents(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """``(doc_id, tokens)`` of the documents that ``rows`` of ``_tokens`` hold, which begin with one and hold the last whole."""
    table = pa.Table.from_batches(rows).combine_chunks()
    ids, nth, tokens = (table.column(name).chunk(0) for name in ("doc_id", "nth", "tokens"))
    starts = np.flatnonzero(np.asarray(nth) == 0)
    sizes = np.add.reduceat(np.asarray(tokens.value_lengths().fill_null(0)), starts)
    ends = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(starts)), pa.ListArray.from_arrays(ends, tokens.flatten())], names=["doc_id", "tokens"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``_tokens`` with a document a row. The last document of a batch waits for its rows in the next; rows without ``nth``
    are documents already."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if "nth" not in batch.schema.names:
            yield batch
            continue
        starts = np.flatnonzero(np.asarray(batch.column("nth")) == 0)
        if not len(starts):
            held.append(batch)
            continue
        last = int(starts[-1])
        if held or last:
            yield _documents([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield _documents(held)


def _term_column(names: pa.Array, row: np.ndarray, term: np.ndarray, tf: np.ndarray, rows: int) -> pa.ListArray:
    entries = pa.StructArray.from_arrays([names.take(pa.array(term)), pa.array(tf.astype(np.int64))], ["term", "tf"])
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), entries)


def _tokens(docs: DataFrame) -> DataFrame:
    """``(doc_id, nth, tokens)``: the words of a document in rows of ROW_WORDS, one after the other; one row where it has none."""
    listed = docs.select("doc_id", T.tokens(F.col("document")).alias("words"))
    firsts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(ROW_WORDS))
    rows = F.transform(firsts, lambda first: F.slice("words", first + 1, F.lit(ROW_WORDS)))
    return listed.select("doc_id", F.posexplode(rows).alias("nth", "tokens"))


_TERMS = "array<struct<term:string,tf:long>>"


def term_lists(docs: DataFrame) -> DataFrame:
    """``(doc_id, terms)``: the terms of each document that has any, with their counts, in one row.

    A document is counted where it is read; nothing moves. Later joins on ``doc_id`` move one row per document, and terms
    are spread out only behind them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, *counted in _counted(_whole(batches)):
            yield pa.RecordBatch.from_arrays([ids, _term_column(*counted, len(ids))], names=["doc_id", "terms"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _tokens(docs).mapInArrow(run, f"doc_id {kind}, terms {_TERMS}").where(F.size("terms") > 0)


class HashedEncoder:
    """Hashed, log-scaled term frequencies of unit length. Needs no model and no vocabulary."""

    def __init__(self, dims: int = 256):
        self.dims = dims
        self.encoder_id = f"hashed-tf-{dims}"

    def terms_and_vectors(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, terms, vec)`` of every document, where it is read; ``vec`` is null for one without a term."""
        dims = self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = buckets = None
            for ids, names, row, term, tf in _counted(_whole(batches)):
                if names is not known:
                    listed = (t for low in range(0, len(names), SLICE_TERMS) for t in names.slice(low, SLICE_TERMS).to_pylist())
                    hashed = (int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dims for t in listed)
                    known, buckets = names, np.fromiter(hashed, np.int64, len(names))
                n = len(ids)
                place = row * dims + buckets[term] if len(row) else row
                matrix = np.bincount(place, 1 + np.log(tf), n * dims).reshape(n, dims)
                length = np.sqrt((matrix * matrix).sum(1))
                empty = length == 0
                matrix = matrix / np.where(empty, 1.0, length)[:, None]
                ends = pa.array(np.arange(0, n * dims + 1, dims, dtype=np.int32))
                vecs = pa.ListArray.from_arrays(ends, pa.array(matrix.reshape(-1)), mask=pa.array(empty))
                yield pa.RecordBatch.from_arrays(
                    [ids, _term_column(names, row, term, tf, n), vecs], names=["doc_id", "terms", "vec"]
                )

        kind = docs.schema["doc_id"].dataType.simpleString()
        return _tokens(docs).mapInArrow(run, f"doc_id {kind}, terms {_TERMS}, vec array<double>")

    def vectors(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, vec)`` of every document."""
        return self.terms_and_vectors(docs).select("doc_id", "vec")


class BatchEncoder:
    """A model that turns a list of texts into a matrix, called once per Arrow batch in each task."""

    def __init__(self, encoder_id: str, dims: int, encode: Callable[[list[str]], np.ndarray]):
        self.encoder_id = encoder_id
        self.dims = dims
        self.encode = encode

    def vectors(self, docs: DataFrame) -> DataFrame:
        encode = self.encode

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                vecs = pd.Series([None] * len(batch), dtype=object)
                present = np.flatnonzero(batch["document"].notna())
                if len(present):
                    matrix = np.asarray(encode(batch["document"].iloc[present].tolist()), dtype=float)
                    vecs.iloc[present] = pd.Series(list(matrix), index=present)
                yield pd.DataFrame({"doc_id": batch["doc_id"], "vec": vecs})

        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.select("doc_id", "document").mapInPandas(run, f"doc_id {kind}, vec array<double>")


def embed(docs: DataFrame, encoder) -> DataFrame:
    """``(doc_id, vec)`` for every document; ``vec`` is null where the text gives none."""
    return encoder.vectors(docs)


def centre(vecs: DataFrame, mean: np.ndarray) -> DataFrame:
    """Vectors relative to the corpus mean, rescaled to unit length."""
    return vecs.withColumn("vec", X.centred(F.col("vec"), mean))


def topic_prototypes(labels: DataFrame, encoder, mean: np.ndarray | None = None) -> DataFrame:
    """``(idx, label, vec)`` of the predefined topics."""
    docs = labels.select(F.col("idx").alias("doc_id"), F.col("label").alias("document"))
    vecs = embed(docs, encoder)
    vecs = vecs if mean is None else centre(vecs, mean)
    return labels.join(vecs.withColumnRenamed("doc_id", "idx"), "idx", "left").select("idx", "label", "vec")


def label_table(spark, labels: list[str]) -> DataFrame:
    """Ordered topic list as a dimension table."""
    return spark.createDataFrame(list(enumerate(labels)), "idx int, label string")
