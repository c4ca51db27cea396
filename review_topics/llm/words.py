"""Words and word n-grams of Arrow texts as 64-bit hashes, a megabyte at a time and without a Python loop per word.

A word is a maximal run of ASCII letters, ASCII digits, underscores and characters beyond ASCII, in lower case. No-break
spaces, Latin-1 signs, general punctuation and ideographic spaces end a word like ASCII punctuation does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_U = np.uint64


def _classes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[0x80:] = True
    for c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_":
        table[c] = True
    return table


_IS_WORD = _classes()
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base and of its inverse modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; a bijection."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; null is the empty text."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets.astype(np.int64)


def _cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SLICE_BYTES that end between texts or after a blank, so that no word is cut."""
    at, end_of_all = int(offsets[0]), int(offsets[-1])
    while at < end_of_all:
        end = min(at + SLICE_BYTES, end_of_all)
        if end < end_of_all:
            text_end = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            blanks = np.flatnonzero(data[max(at, end - 65536) : end] <= 32)
            if len(blanks):
                end = max(at, end - 65536) + int(blanks[-1]) + 1
            elif text_end > at:
                end = text_end
            else:
                nxt = int(offsets[np.searchsorted(offsets, end)])
                later = np.flatnonzero(data[end:nxt] <= 32)
                end = end + int(later[0]) + 1 if len(later) else nxt
        yield at, end
        at = end


def _slice_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of one slice; no word runs over a position in ``breaks``."""
    is_word = _IS_WORD[data]
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE2) | (data == 0xE3))
    if len(lead):
        lead = lead[lead + 2 < len(data)]
        first, second = data[lead], data[lead + 1]
        latin = lead[(first == 0xC2) & ~np.isin(second, (0xAA, 0xB5, 0xBA))]
        general = lead[((first == 0xE2) & ((second == 0x80) | (second == 0x81))) | ((first == 0xE3) & (second == 0x80))]
        for step in (0, 1):
            is_word[latin + step] = False
        for step in (0, 1, 2):
            is_word[general + step] = False
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    starts[inner] |= is_word[inner]
    ends[inner - 1] |= is_word[inner - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return first, mix((sums[last] - sums[first]) * down[first])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)``: text ``i`` has the words ``hashes[offsets[i]:offsets[i + 1]]``, in order."""
    data, offsets = text_buffer(pc.utf8_lower(texts))
    starts, hashes = [], []
    for lo, hi in _cuts(data, offsets):
        inside = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi)]
        first, values = _slice_words(data[lo:hi], inside - lo)
        starts.append(first + lo)
        hashes.append(values)
    if not starts:
        return np.zeros(0, _U), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def ngram_hashes(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word grams of each text, in order and with repeats, and their offsets.

    A text of fewer than ``n`` words, but at least one, has one gram: all its words.
    """
    words = np.diff(offsets)
    counts = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    out_offsets = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(int(out_offsets[-1]), _U)
    multipliers = mix(np.arange(1, n + 1, dtype=_U)) | _U(1)
    if len(hashes) >= n:
        grams = np.zeros(len(hashes) - n + 1, _U)
        for k in range(n):
            grams += hashes[k : len(hashes) - n + 1 + k] * multipliers[k]
        full = np.ones(len(grams), bool)
        for k in range(1, n):  # a gram must not run into the next text
            at = offsets[1:-1] - k
            full[at[(at >= 0) & (at < len(grams))]] = False
        at_full = np.flatnonzero(full)
        owner = np.searchsorted(offsets, at_full, "right") - 1
        out[out_offsets[owner] + (at_full - offsets[owner])] = grams[at_full]
    for i in np.flatnonzero((words > 0) & (words < n)):
        own = hashes[offsets[i] : offsets[i + 1]]
        out[out_offsets[i]] = (own * multipliers[: len(own)]).sum(dtype=_U) + _U(len(own))
    return mix(out), out_offsets


def sub_batches(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``max_bytes`` of text each; a longer text is a part of its own."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // max_bytes
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        yield batch.slice(int(lo), int(hi - lo))
