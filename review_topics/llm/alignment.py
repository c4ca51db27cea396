"""Alignment of two tokenizations of one text: lockstep merging of the places where their tokens end.

The end offsets of a batch's tokens are two ascending arrays over all its bytes. Documents are cut into lanes of
LANE_BYTES, so that a long one takes no more steps than a short one, and one state vector holds the pointers of all lanes.
A step compares the two tokens under each lane's pointers: where both end together it emits a link, which is a cut of both
streams into groups, and moves both pointers; elsewhere it moves the pointer of the token that ends first. Lanes that have
no token left on either side are taken out of the state before the next step.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.llm import words
from review_topics.session import stage

LANE_BYTES = 512
SLICE_BYTES = 1 << 19
SLICE_LINKS = 1 << 20
# Beyond these characters the rank file's pattern and the exact tokenizer may see other classes.
_UNUSUAL = re.compile("[^\x00-ɏ‐-‧]")
COUNTED = "doc_id long, n_a long, n_b long, n_groups long"


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


@dataclass
class ByteLevel:
    """A byte-level BPE of a tokenizers file, with the same vocabulary as ranks for usual characters. Encodes a blank and the text."""

    json_path: str
    ranks_path: str
    pattern: str
    _tools: object = field(default=None, repr=False, compare=False)
    _exact: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_tools": None, "_exact": None}

    def token_bytes(self) -> list[bytes]:
        with open(self.json_path, encoding="utf-8") as file:
            content = json.load(file)
        to_byte = byte_characters()
        found = {i: bytes(to_byte[c] for c in token) for token, i in content["model"]["vocab"].items() if all(c in to_byte for c in token)}
        found |= {t["id"]: t["content"].encode() for t in content["added_tokens"]}
        return [found.get(i, b"") for i in range(max(found) + 1)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._tools is None:
            import tiktoken

            with open(self.ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._tools = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return [self._encode_exactly(f" {t}") if _UNUSUAL.search(t) else self._tools.encode_ordinary(f" {t}") for t in texts]

    def _encode_exactly(self, text: str) -> list[int]:
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.json_path)
            self._exact.encode_special_tokens = True
        return self._exact.encode(text, add_special_tokens=False).ids


@dataclass
class Pieces:
    """A sentencepiece model, which puts the blank before a text itself."""

    model_path: str
    _model: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_model": None}

    def _loaded(self):
        if self._model is None:
            import sentencepiece

            self._model = sentencepiece.SentencePieceProcessor(model_file=self.model_path)
        return self._model

    def token_bytes(self) -> list[bytes]:
        model = self._loaded()
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        return [bytes([int(name[3:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._loaded().encode(texts, num_threads=1) if texts else []


def byte_bpe_50k() -> ByteLevel:
    import public_tokenizers as public

    return ByteLevel(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def piece_bpe_32k() -> Pieces:
    import public_tokenizers as public

    return Pieces(public.path("piece_bpe_32k.model"))


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, edges: np.ndarray, lane_bytes: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Positions, ascending, of the tokens of both streams that end together; ``edges`` are the documents' byte borders.

    Ends count from the first document's first byte. Only tokens whose ends lie in the same lane can end together, so lanes
    are merged on their own and all at once.
    """
    lanes = -(-np.diff(edges) // lane_bytes)
    first = np.repeat(np.cumsum(lanes) - lanes, lanes)
    low = np.repeat(edges[:-1], lanes) + (np.arange(lanes.sum()) - first) * lane_bytes
    high = np.minimum(low + lane_bytes, np.repeat(edges[1:], lanes))
    state = np.stack([np.searchsorted(ends, bound, "right") for ends in (ends_a, ends_b) for bound in (low, high)])
    links: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        live = (state[0] < state[1]) & (state[2] < state[3])
        if not live.all():
            state = state[:, live]
        if not state.shape[1]:
            break
        end_a, end_b = ends_a[state[0]], ends_b[state[2]]
        met = end_a == end_b
        links.append((state[0, met], state[2, met]))
        state[0] += end_a <= end_b
        state[2] += end_b <= end_a
    found_a, found_b = (np.sort(np.concatenate(side)) for side in zip(*links)) if links else (np.zeros(0, np.int64),) * 2
    return found_a, found_b


@dataclass
class Groups:
    """Tokens of some documents: ids and document borders of A and B, tokens a group of both, and the documents' group borders."""

    ids: tuple[np.ndarray, np.ndarray]
    borders: tuple[np.ndarray, np.ndarray]
    sizes: tuple[np.ndarray, np.ndarray]
    groups: np.ndarray

    def links(self, width: int) -> np.ndarray:
        """The linked ids, the last ones of each group, as ``a * width + b``."""
        a, b = (ids[np.cumsum(sizes) - 1].astype(np.uint64) for ids, sizes in zip(self.ids, self.sizes))
        return a * np.uint64(width) + b


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    borders = np.cumsum([0, *map(len, lists)])
    return np.fromiter((i for own in lists for i in own), np.int32, int(borders[-1])), borders


def group_texts(part: Groups) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` for each document: decimal ids, groups behind each other; empty without tokens."""
    (ids_a, ids_b), (size_a, size_b) = part.ids, part.sizes
    before_a, before_b = (np.concatenate(([0], np.cumsum(s))) for s in (size_a, size_b))
    of_a, of_b = (np.repeat(np.arange(len(s)), s) for s in (size_a, size_b))
    place_a = np.arange(len(ids_a)) + before_b[of_a]
    place_b = np.arange(len(ids_b)) + before_a[of_b + 1]
    numbers, behind = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    numbers[place_a], numbers[place_b] = ids_a, ids_b
    behind[place_a[before_a[1:] - 1]], behind[place_b[before_b[1:] - 1]] = ord("|"), ord(";")
    digits = np.ones(len(numbers), np.int64)
    while (wider := numbers >= 10**digits).any():
        digits += wider
    ends = np.cumsum(digits + 1)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[ends - 1] = behind
    for k in range(int(digits.max(initial=0))):
        own = np.flatnonzero(digits > k)
        data[ends[own] - 2 - k] = 48 + numbers[own] // 10**k % 10
    borders = np.concatenate(([0], ends))[part.borders[0] + part.borders[1]]
    some = np.diff(borders) > 0
    data = np.delete(data, borders[1:][some] - 1)
    offsets = borders - np.concatenate(([0], np.cumsum(some)))
    return pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


def _aligned(a: ByteLevel, b: Pieces, lane_bytes: int, digest: bool):
    kind = _link_type(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_a, bytes_b = a.token_bytes(), b.token_bytes()
        size_a, size_b = (np.array([len(x) for x in own], np.int64) for own in (bytes_a, bytes_b))
        for batch in batches:
            for part in words.sub_batches(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                at = [i for i, t in enumerate(texts) if t]
                lists: tuple[list, list] = [[] for _ in texts], [[] for _ in texts]
                for i, ids_a, ids_b in zip(at, a.encode([texts[i] for i in at]), b.encode([texts[i] for i in at])):
                    whole = f" {texts[i]}".encode()
                    if b"".join(map(bytes_a.__getitem__, ids_a)) == whole and b"".join(map(bytes_b.__getitem__, ids_b)) == whole:
                        lists[0][i], lists[1][i] = ids_a, ids_b
                (flat_a, borders_a), (flat_b, borders_b) = map(_flat, lists)
                ends_a, ends_b = np.cumsum(size_a[flat_a]), np.cumsum(size_b[flat_b])
                edges = np.concatenate(([0], ends_a))[borders_a]
                last_a, last_b = lockstep(ends_a, ends_b, edges, lane_bytes)
                sizes = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
                found = Groups((flat_a, flat_b), (borders_a, borders_b), sizes, np.searchsorted(last_a, borders_a))
                spelled = group_texts(found)
                if digest:
                    spelled = pa.array([hashlib.sha256(t.as_buffer()).hexdigest() if n else "" for t, n in zip(spelled, np.diff(found.groups))], pa.string())
                links = found.links(len(bytes_b)).astype(kind)
                listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer((found.groups * links.itemsize).astype(np.int64).tobytes()), pa.py_buffer(links.tobytes())])
                numbers = [pa.array(np.diff(borders).astype(np.int64)) for borders in (borders_a, borders_b, found.groups)]
                columns = [part.column("doc_id"), *numbers, spelled.cast(pa.string()), listed.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    return run


def _link_type(a: ByteLevel, b: Pieces) -> str:
    return "<u4" if len(a.token_bytes()) * len(b.token_bytes()) < 2**32 else "<u8"


def align(documents: DataFrame, a: ByteLevel, b: Pieces, digest: bool = False, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, groups, links)`` for each row, written once.

    Tokens of both sides up to a byte where tokens of both end are a group, and the last two of a group are linked; nowhere
    inside a group do two tokens end together. ``groups`` spells them out, ``a1,a2|b1;a3|b2,b3``, or with ``digest`` is the
    SHA-256 of that text in hexadecimal; without tokens it is empty. ``links`` holds ``a * size of B's vocabulary + b``
    of every link in order, see pair_counts. A null or empty text, and one that the tokens of A or B do not spell byte by
    byte (a blank before it included), has no tokens. Repeated rows are aligned again, a null doc_id stays, other columns are
    ignored, an empty table gives an empty result. A text is held whole by one task; lanes, not texts, bound the steps.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(rows.mapInArrow(_aligned(a, b, lane_bytes, digest), f"{COUNTED}, groups string, links binary"), "aligned")


def possible_pairs(a: ByteLevel, b: Pieces) -> int:
    """How many pairs of ids can be linked: of two tokens that end together one ends the other, whatever the texts."""
    spelled: tuple[dict, dict] = defaultdict(int), defaultdict(int)
    for own, tokens in zip(spelled, (a.token_bytes(), b.token_bytes())):
        for token in tokens:
            own[token] += 1
    shorter_b = sum(n * spelled[1].get(token[k:], 0) for token, n in spelled[0].items() for k in range(len(token)))
    shorter_a = sum(n * spelled[0].get(token[k:], 0) for token, n in spelled[1].items() for k in range(1, len(token)))
    return shorter_b + shorter_a


def _read_links(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, links, borders)`` over rows of a batch, about SLICE_LINKS links at a time."""
    column = batch.column("links").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // np.dtype(kind).itemsize
    links = np.frombuffer(data, kind) if data else np.zeros(0, kind)
    part = (offsets[1:] - 1 - offsets[0]) // SLICE_LINKS
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(column)]
    for low, high in zip(edges, edges[1:]):
        yield int(low), int(high), links[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def pair_counts(aligned: DataFrame, a: ByteLevel, b: Pieces) -> DataFrame:
    """``(a_id, b_id, n, best)``: how many links of all documents hold a pair, and whether no other pair of that B id has more."""
    kind, width = _link_type(a, b), len(b.token_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, links, _ in _read_links(batch, kind):
                keys, n = np.unique(links, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["link", "n"])

    counts = aligned.select("links").mapInArrow(run, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))
    counts = counts.select(F.expr(f"link div {width}").alias("a_id"), (F.col("link") % width).alias("b_id"), "n")
    top = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return counts.join(top, "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, a: ByteLevel, b: Pieces) -> DataFrame:
    """``aligned`` without links, but with ``n_links``, ``n_best`` and ``count_sum``.

    ``n_best`` counts a document's links whose pair is among the most frequent of its B id, ``count_sum`` adds the counts of
    its linked pairs, over all documents. The counts go to every task: the vocabularies alone bound their number,
    see possible_pairs, and more is refused.
    """
    spark = aligned.sparkSession
    counts = stage(pair_counts(aligned, a, b), "pair-counts")
    if counts.count() > (most := possible_pairs(a, b)):
        raise ValueError(f"more than {most} linked pairs: not the links of these vocabularies")
    found = counts.toArrow()
    kind, width = _link_type(a, b), len(b.token_bytes())
    key = np.asarray(found["a_id"]).astype(np.int64) * width + np.asarray(found["b_id"]).astype(np.int64)
    order = np.argsort(key)
    sent = spark.sparkContext.broadcast((key[order].astype(kind), np.asarray(found["best"]).astype(np.int64)[order], np.asarray(found["n"]).astype(np.int64)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, *values = sent.value
        kept = ["doc_id", "n_a", "n_b", "n_groups", "groups"]
        for batch in batches:
            for low, high, links, borders in _read_links(batch, kind):
                at = np.searchsorted(keys, links)
                sums = [np.diff(np.concatenate(([0], np.cumsum(own[at])))[borders]) for own in values]
                rows = batch.slice(low, high - low)
                columns = [*(rows.column(c) for c in kept), *(pa.array(x.astype(np.int64)) for x in (np.diff(borders), *sums))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_links", "n_best", "count_sum"])

    return aligned.mapInArrow(run, f"{COUNTED}, groups string, n_links long, n_best long, count_sum long")
