"""Language by cross-parsing: suffix automata of labelled text say how few phrases of a language make up a text.

The automaton of a language accepts every substring of its training text. A text is cut greedily into the longest pieces
that the automaton accepts; with ``c`` phrases for ``n`` characters against ``m`` training characters, ``c log2(m) / n``
estimates the bits a character costs in that language. The language with the fewest bits wins.

Texts are lower-cased and everything but letters becomes one blank. Long texts are parsed in segments of ``SEGMENT`` characters,
so that many segments step through the automaton together, and their borders are mended to what one parse gives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_topics.llm import words
from review_topics.session import broadcast_checked, stage, unstage

TRAIN_CHARS = 16_384
TRAIN_TEXTS = 48
SEGMENT = 256
SLICE_BYTES = 1 << 19
# Languages whose automata are in memory together.
BLOCK_LANGUAGES = 32
# Chosen texts, 48 a language, whose hashes go to every task; more are joined.
MAX_CHOSEN = 500_000
_PLACE_TRIES = 64
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Which code points are letters, by Unicode's categories."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the suffix automaton of a sequence; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in follow[p]:
            follow[p][c] = state
            p = link[p]
        if p != -1:
            q = follow[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return follow


@dataclass
class Automaton:
    """Transitions in one row: the edge of ``state`` by ``symbol`` is at ``base[state] + symbol`` if ``owner`` there is the state.

    The row is about as long as there are edges, whatever the alphabet. The start has no edge in it: leaving the start and having
    no edge are the same, a phrase begins, and ``first`` says where its first symbol leads.
    """

    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    first: np.ndarray
    trained: int

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states that follow, and where a phrase begins."""
        at = self.base[state] + symbol
        begins = self.owner[at] != state
        return np.where(begins, self.first[symbol], self.target[at]), begins


def build_automaton(line: list[int], size: int) -> Automaton:
    """The automaton of a line of symbols below ``size``; edges of a state go to the first places that take them all."""
    follow = suffix_automaton(line)
    owner: dict[int, int] = {}
    target: dict[int, int] = {}
    base, free, end = np.zeros(len(follow), np.int64), size, size
    for state, edges in enumerate(follow[1:], 1):
        if not edges:
            continue
        low = min(edges)
        while free in owner:
            free += 1
        at = free
        for _ in range(_PLACE_TRIES):
            if not any(at - low + c in owner for c in edges):
                break
            at += 1
        else:
            at = end  # nothing is placed from here on
        for c, goal in edges.items():
            owner[at - low + c], target[at - low + c] = state, goal
        end = max(end, at - low + max(edges) + 1)
        base[state] = at - low
    table = np.zeros((2, end + size), np.int64)
    table[0] = -1
    table[0, list(owner)], table[1, list(target)] = list(owner.values()), list(target.values())
    first = np.zeros(size, np.int64)
    first[list(follow[0])] = list(follow[0].values())
    return Automaton(base, table[0], table[1], first, len(line))


@dataclass
class LanguageModel:
    """All letters of the sample, and the languages' automata in blocks of BLOCK_LANGUAGES."""

    languages: list[str]
    alphabet: np.ndarray
    blocks: list[list[Automaton]]

    def symbols(self, code_points: np.ndarray) -> np.ndarray:
        """0 for what is no letter, the letter's symbol, or one behind all letters for a letter that the sample lacks."""
        place = np.searchsorted(self.alphabet, code_points)
        known = np.append(self.alphabet, 0)[place] == code_points
        return (np.where(known, place + 1, len(self.alphabet) + 1) * _is_letter()[code_points]).astype(np.int32)


def fit_model(samples: dict[str, list[str]]) -> LanguageModel:
    """Automata of a bounded sample: at most TRAIN_CHARS characters a language are used."""
    letters = np.unique(_code_points([t.lower() for texts in samples.values() for t in texts]))
    model = LanguageModel(sorted(samples), letters[_is_letter()[letters]], [])
    automata = []
    for language in model.languages:
        line = model.symbols(_code_points([" " + t.lower() for t in samples[language]]))[:TRAIN_CHARS]
        line = line[(line > 0) | (np.concatenate(([1], line[:-1])) > 0)] if len(line) else line
        automata.append(build_automaton(line.tolist(), len(model.alphabet) + 2))
    model.blocks = [automata[i : i + BLOCK_LANGUAGES] for i in range(0, len(automata), BLOCK_LANGUAGES)]
    return model


@dataclass
class Segments:
    """Symbols of texts cut into segments, the longest first: row ``t`` holds the ``t``-th symbols of the first ``live[t]`` of them."""

    matrix: np.ndarray
    live: np.ndarray
    owner: np.ndarray
    before: np.ndarray
    length: np.ndarray


def cut_segments(symbols: np.ndarray, length: np.ndarray) -> Segments:
    """``symbols`` of all texts, ``length`` of each; ``owner`` is a segment's text and ``before`` the one it goes on from, or -1."""
    parts = -(-length // SEGMENT)
    owner = np.repeat(np.arange(len(length)), parts)
    first = np.cumsum(parts) - parts
    nth = np.arange(len(owner)) - np.repeat(first, parts)
    size = np.minimum(length[owner] - nth * SEGMENT, SEGMENT)
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.where(nth > 0, np.append(place, 0)[np.arange(len(owner)) - 1], -1)[order]
    text = np.repeat(np.arange(len(length)), length)
    at = np.arange(len(symbols)) - np.repeat(np.cumsum(length) - length, length)
    matrix = np.zeros((SEGMENT, len(owner)), np.int32)
    matrix[at % SEGMENT, place[first[text] + at // SEGMENT]] = symbols
    live = np.searchsorted(-size[order], -np.arange(SEGMENT), "left")
    return Segments(matrix, live, owner[order], before, length)


def count_phrases(automaton: Automaton, segments: Segments) -> np.ndarray:
    """Phrases of each text as one greedy parse from its start gives them.

    All segments are parsed together as if a phrase began with each. Then every segment is parsed once more from the state that
    the one before it ended in, until both parses begin a phrase at one place, from where on they are the same. A segment
    without such a place ends in another state, and the next one is parsed again from that.
    """
    n = len(segments.owner)
    began = np.zeros(segments.matrix.shape, bool)
    ends = np.zeros(n, np.int64)
    for t, live in enumerate(segments.live):
        if not live:
            break
        ends[:live], began[t, :live] = automaton.step(ends[:live], segments.matrix[t, :live])
    phrases, alone = began.sum(0), ends.copy()
    rest = np.zeros(n, np.int64)  # what the parse from the state before adds to the segment's phrases
    size = np.searchsorted(-segments.live, -np.arange(n), "left")
    again = np.flatnonzero(segments.before >= 0)
    while len(again):
        lane, state = again, ends[segments.before[again]]
        rest[lane] = 0
        moved = []
        for t in range(SEGMENT):
            over = size[lane] <= t
            if over.any():
                moved.append((lane[over], state[over]))
                lane, state = lane[~over], state[~over]
            if not len(lane):
                break
            state, begins = automaton.step(state, segments.matrix[t, lane])
            rest[lane] += begins.astype(np.int64) - began[t, lane]
            apart = ~(begins & began[t, lane])
            moved.append((lane[~apart], alone[lane[~apart]]))
            lane, state = lane[apart], state[apart]
        moved.append((lane, state))
        lane, state = (np.concatenate(x) for x in zip(*moved))
        other = ends[lane] != state
        ends[lane[other]] = state[other]
        again = np.flatnonzero(np.isin(segments.before, lane[other])) if other.any() else lane[:0]
    return np.bincount(segments.owner, phrases + rest, len(segments.length)).astype(np.int64)


def _lines(model: LanguageModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, every run of what is no letter as one, and how many each text has."""
    lowered = [t or "" for t in pc.utf8_lower(texts).to_pylist()]
    sizes = np.array([len(t) for t in lowered], np.int64)
    symbols = model.symbols(_code_points(lowered))
    text = np.repeat(np.arange(len(lowered)), sizes)
    before = np.concatenate((np.zeros(1, np.int32), symbols[:-1])) if len(symbols) else symbols
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    keep = (symbols > 0) | (before > 0)
    return symbols[keep], np.bincount(text[keep], minlength=len(lowered))


def entropies(model: LanguageModel, texts: pa.Array, blocks=None) -> tuple[np.ndarray, np.ndarray]:
    """Bits a character in each language, one row a text, and whether the text has a letter."""
    symbols, length = _lines(model, texts)
    segments = cut_segments(symbols, length)
    columns = [count_phrases(own, segments) * np.log2(own.trained + 2) for block in (model.blocks if blocks is None else blocks) for own in block]
    bits = np.stack(columns, 1) if columns else np.zeros((len(texts), 0))
    return bits / np.maximum(length, 1)[:, None], length > 0


def train(documents: DataFrame) -> LanguageModel:
    """Model of ``documents(text, lang)``: for each language a piece of each of TRAIN_TEXTS different texts.

    Texts are taken by the order of their hash; a piece of TRAIN_CHARS // TRAIN_TEXTS - 1 characters comes from the middle of
    its text. Hashes are ranked first and only the chosen texts are cut. Every language is learnt. Rows without language or
    text do not count.
    """
    rows = documents.select("lang", "text", F.xxhash64("text").alias("h")).where("lang is not null and text is not null and length(text) > 0")
    ranked = rows.select("lang", "h").distinct().withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    chosen = stage(ranked.where(F.col("r") <= TRAIN_TEXTS), "chosen-texts")
    width = TRAIN_CHARS // TRAIN_TEXTS - 1
    start = F.greatest(F.lit(1), (F.length("text") / 2).cast("int") - width // 2)
    pieces = rows.join(broadcast_checked(chosen, MAX_CHOSEN), ["lang", "h"]).select("lang", "r", F.substr("text", start, F.lit(width)).alias("piece"))
    samples: dict[str, list[tuple[int, str]]] = {}
    for row in pieces.groupBy("lang", "r").agg(F.min("piece").alias("piece")).toLocalIterator():
        samples.setdefault(row["lang"], []).append((row["r"], row["piece"]))
    unstage(chosen)
    return fit_model({lang: [piece for _, piece in sorted(rows)] for lang, rows in samples.items()})


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``documents`` with ``lang_pred``, ``score`` and ``bits``; they replace columns of the same names.

    ``lang_pred`` is a learnt language, the first by name in a tie, or ``und`` for a text that is null or has no letter
    and where no language was learnt. ``score`` runs from 0 to 1: the runner-up's bits over the sum of both, 0 for
    ``und``, 1 with a single language. ``bits`` is the winner's entropy estimate. Repeated rows are scored alike.
    """
    context = documents.sparkSession.sparkContext
    sent, alphabet = [context.broadcast(block) for block in model.blocks], replace(model, blocks=[])
    kept = [c for c in documents.columns if c not in ("lang_pred", "score", "bits")]
    source = documents.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = alphabet
        names = np.array([*own.languages, "und"], dtype=object)

        def blocks() -> Iterator[list[Automaton]]:
            for block in sent:
                yield block.value
                if len(sent) > 1:
                    block.__dict__.pop("_value", None)  # one block in memory; it is read again from the worker's file

        for batch in batches:
            for part in words.sub_batches(batch, "text", SLICE_BYTES):
                bits, spoken = entropies(own, part.column("text"), blocks())
                if own.languages:
                    best = bits.argmin(1)
                    order = np.sort(bits, axis=1)
                    lowest = order[:, 0]
                    score = order[:, 1] / (order[:, 0] + order[:, 1]) if bits.shape[1] > 1 else np.ones(len(bits))
                else:
                    best, lowest, score, spoken = (np.zeros(part.num_rows, int), np.zeros(part.num_rows), np.zeros(part.num_rows), spoken & False)
                found = names[np.where(spoken, best, len(own.languages))]
                new = [
                    pa.array(found, pa.string()),
                    pa.array(np.where(spoken, score, 0.0)),
                    pa.array(np.where(spoken, lowest, np.nan), mask=~spoken),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *new], names=[*kept, "lang_pred", "score", "bits"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    return source.mapInArrow(run, f"{fields}, lang_pred string, score double, bits double")
