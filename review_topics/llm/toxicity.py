"""Toxicity of texts whose writers hide words: restore first, then score.

Suspicious stretches (letters mixed with digits or signs, single letters set apart, letters repeated) are seen as a noisy
copy of a word. A lattice holds what each character may have stood for; a Viterbi pass picks the reading that a character
model of the corpus finds likeliest. The restored words join the plain ones, and a logistic model over the words that
labels speak about scores the text.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_topics.llm import words
from review_topics.session import stage

TRAIN_DOCUMENTS = 20_000
MIN_DOCUMENTS = 10
MIN_Z = 5.0
ORDER = 4
_SYMBOLS = 32  # 0: outside a word, 1-26: letters, 27: any other letter

# What signs and digits stand for in disguised words.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
_SIGNS = re.escape("".join(LOOKALIKES))
_FILLERS = r" .\-_*~,'"
_SPACED = re.compile(rf"[^\W\d_](?:[{_FILLERS}](?:[^\W_]|[{_SIGNS}](?=[{_FILLERS}][^\W_]))(?![^\W_])){{2,}}")
_DISGUISED = re.compile(
    rf"(?<![0-9@$!€£])[0-9@$!€£]++[^\W\d_][\w{_SIGNS}*]*|(?<![^\W\d_])[^\W\d_]++(?:[{_SIGNS}*_.\-]+[^\W_][\w{_SIGNS}*]*|[{_SIGNS}](?![\w{_SIGNS}]))"
    r"|(?<![^\W\d_])(?=[^\W\d_]*?([^\W\d_])\1\1)[^\W\d_]++"
)
_COST_LOOKALIKE, _COST_FILLER, _COST_COLLAPSE = 0.5, 0.1, 0.3


def _bytes_of(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars if ord(c) < 128]] = True
    return table


# A byte beyond ASCII may belong to a letter or to a sign: it counts where a letter is asked for, and never where one is ruled out.
_ALPHA = _bytes_of("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_ALPHA[128:] = True
_DIGIT, _SIGN, _LEAD, _JOIN, _FILL = _bytes_of("0123456789"), _bytes_of("".join(LOOKALIKES)), _bytes_of("0123456789@$!"), _bytes_of("*_.-"), _bytes_of(" .-_*~,'")
_ALNUM = _ALPHA | _DIGIT
_PLAIN = _ALNUM & (np.arange(256) < 128)
_WIDTH = np.select([np.arange(256) < 0x80, np.arange(256) < 0xC0, np.arange(256) < 0xE0, np.arange(256) < 0xF0], [1, 0, 2, 3], 4)  # of the character a byte begins


def _set_apart(data: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """First bytes of characters behind which two more stand, each behind one filler; the one before is no ASCII letter or digit."""
    fill = np.flatnonzero(_FILL[data])
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    one, two = fill[:-1], fill[1:]
    near = two - one < 6
    one, two = one[near], two[near]
    middle, third = padded[one + 1], padded[two + 1]
    behind = two + 1 + _WIDTH[third]
    near = (two - one - 1 == _WIDTH[middle]) & (_ALNUM | _SIGN)[middle] & (_ALNUM | _SIGN)[third] & (~_PLAIN[padded[behind]] | edge[behind]) & ~edge[one]
    at = one[near] - 1
    for _ in range(3):
        at = at - ((data[at] & 0xC0) == 0x80)
    return at[_ALPHA[data[at]] & (edge[at] | ~_PLAIN[data[at - 1]])]


def _triggers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at which disguised words, and single characters set apart, may be: all of them, and few others."""
    padded = np.zeros(len(data) + 3, np.uint8)
    padded[1:-2] = data
    alpha, sign = _ALPHA[padded], _SIGN[padded]
    alnum = _ALNUM[padded]
    now, ahead, beyond = slice(1, -2), slice(2, -1), slice(3, None)
    edge = np.zeros(len(data) + 8, bool)
    edge[offsets] = True
    spread = sign | _JOIN[padded]
    hit = spread[now] & alnum[ahead] & (padded[:-3] > 32)
    hit |= _LEAD[padded][now] & alpha[ahead]
    hit |= alpha[now] & sign[ahead] & (~(_PLAIN[padded] | sign)[beyond] | edge[2 : len(data) + 2])
    hit |= alpha[now] & (padded[now] == padded[ahead]) & (padded[now] == padded[beyond])
    hit |= ((padded[now] == 0xC2) & (padded[ahead] == 0xA3)) | ((padded[now] == 0xE2) & (padded[ahead] == 0x82) & (padded[beyond] == 0xAC))
    wide = np.flatnonzero(data >= 0xC0)  # letters of several bytes, three times the same
    for width in (2, 3, 4):
        at = wide[_WIDTH[data[wide]] == width]
        at = at[at + 3 * width <= len(data)]
        for k in range(width):
            at = at[(data[at + k] == data[at + width + k]) & (data[at + k] == data[at + 2 * width + k])]
        hit[at] = True
    return np.flatnonzero(hit), _set_apart(data, edge)


def stretches(texts: pa.Array) -> tuple[list[str], list[int]]:
    """Suspicious stretches of texts, and the text of each: parts of one blank-free token, or letters set apart."""
    data, offsets = words.text_buffer(texts)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]  # a slice shares its batch's buffer
    hits, alone = _triggers(data, offsets)
    limit = np.zeros(len(data) + 1, bool)
    limit[:-1] = data <= 32
    limit[1:] |= limit[:-1].copy()
    limit[offsets] = True
    limits = np.flatnonzero(limit)
    begin = limits[np.searchsorted(limits, hits, "right") - 1]
    token, first = np.unique(begin, return_index=True)
    end = limits[np.searchsorted(limits, hits[first], "right")] if len(hits) else hits
    found: list[str] = []
    of: list[int] = []
    raw = data.tobytes()
    owner = np.searchsorted(offsets, token, "right") - 1
    for doc, lo, hi in zip(owner.tolist(), token.tolist(), end.tolist()):
        for m in _DISGUISED.finditer(raw[lo:hi].decode("utf-8", "ignore")):
            found.append(m[0])
            of.append(doc)
    floor = 0
    for doc, at in zip((np.searchsorted(offsets, alone, "right") - 1).tolist(), alone.tolist()):
        start, last, width = int(offsets[doc]), int(offsets[doc + 1]), 256
        if at < floor or raw[max(start, at - 4) : at].decode("utf-8", "ignore")[-1:].isalnum():
            continue
        while True:
            m = _SPACED.match(raw[at : min(last, at + width)].decode("utf-8", "ignore"))
            size = len(m[0].encode()) if m else 0
            if not m or at + width >= last or size < width - 16:
                break
            width *= 4
        if m:
            found.append(m[0])
            of.append(doc)
            floor = at + size
    return found, of


def fold(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x3000, np.uint8)
    for c in range(len(table)):
        if chr(c).isalpha():
            first = fold(chr(c))[:1]
            table[c] = ord(first) - 96 if "a" <= first <= "z" else 27
    return table


_table: list[np.ndarray] = []


def symbols(texts: list[str]) -> np.ndarray:
    """Symbols of all texts, a 0 before and behind each."""
    if not _table:
        _table.append(_symbol_table())
    points = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < len(_table[0]), _table[0][np.minimum(points, len(_table[0]) - 1)], 27)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of ORDER symbols in a row, one row a task for each that occurs; there are 2**20 at most."""
    total = np.zeros(_SYMBOLS**ORDER, np.int64)
    for batch in batches:
        for part in words.sub_batches(batch, "text", 1 << 20):
            line = symbols([t or "" for t in part.column("text").to_pylist()]).astype(np.int64)
            line = line[(line > 0) | (np.concatenate(([1], line[:-1])) > 0)]
            line = np.concatenate((np.zeros(ORDER - 1, np.int64), line))
            key = np.zeros(len(line) - ORDER + 1, np.int64)
            for k in range(ORDER):
                key = key * _SYMBOLS + line[k : k + len(key)]
            total += np.bincount(key, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])


def language_model(documents: DataFrame) -> np.ndarray:
    """Log-probability of a symbol behind the three before it, from the counts of all documents, smoothed by shorter ones."""
    rows = documents.select("text").mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(_SYMBOLS**ORDER)
    counts[rows["gram"].to_numpy(np.int64)] = rows["n"]
    counts = counts.reshape((_SYMBOLS,) * ORDER)
    chance = np.full(_SYMBOLS, 1 / 28)
    for n in range(1, ORDER + 1):
        own = counts.sum(axis=tuple(range(ORDER - n)))
        chance = (own + 4 * chance) / (own.sum(-1, keepdims=True) + 4)
    return np.log(np.maximum(chance, 1e-12)).astype(np.float32)


def _folded(text: str) -> Iterator[tuple[str, str]]:
    """Characters in lower case without accents, each with the one it comes from. Syllables that fold to several letters stay."""
    for c in unicodedata.normalize("NFC", text.lower()):
        plain = fold(c)
        if len(plain) > 1:
            yield from ((x, x) for x in (plain if plain.isascii() else c))
        elif plain:
            yield plain, c


def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """What each run of characters equal but for accents may stand for, with its cost. An empty reading drops the run."""
    out = []
    for c, run in itertools.groupby(_folded(stretch), lambda pair: pair[0]):
        own = [letter for _, letter in run]
        n = len(own)
        if c.isalpha():
            readings = [("".join(own), 0.0)] if n < 3 else []
            readings += [("".join(own[:k]), _COST_COLLAPSE) for k in (1, 2) if k < n]
        elif c in LOOKALIKES:
            readings = [(letter * min(n, 2), _COST_LOOKALIKE) for letter in LOOKALIKES[c]] + [("", 4 * _COST_LOOKALIKE)]
        else:
            readings = [("", _COST_FILLER)]
        out.append(readings)
    return out


def restore(stretch: str, model: np.ndarray) -> str:
    """Likeliest reading of a stretch, accents kept; the state is the last three letters, so the search is exact. The first of equals wins."""
    code = lambda c: ord(c[0]) - 96 if "a" <= (c := fold(c))[:1] <= "z" else 27
    states: dict[tuple[int, ...], tuple[float, str]] = {(0,) * (ORDER - 1): (0.0, "")}
    for readings in lattice(stretch):
        following: dict[tuple[int, ...], tuple[float, str]] = {}
        for context, (score, text) in states.items():
            for reading, cost in readings:
                own, total = context, score - cost
                for c in reading:
                    total += float(model[own][code(c)])
                    own = (*own[1:], code(c))
                if own not in following or total > following[own][0]:
                    following[own] = (total, text + reading)
        states = following
    return max(((score + float(model[context][0]), text) for context, (score, text) in states.items()), key=lambda x: x[0])[1]


@dataclass
class Scorer:
    """Words that count (their hashes, sorted), their weights and the bias."""

    language: np.ndarray
    hashes: np.ndarray
    weights: np.ndarray
    bias: float


class _Reader:
    """Word hashes of texts with the words that disguised stretches stand for."""

    def __init__(self, language: np.ndarray):
        self.language, self.known = language, {}

    def restored(self, stretch: str) -> str:
        if stretch not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[stretch] = restore(stretch, self.language)
        return self.known[stretch]

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(hash, text)``, plain words first."""
        hashes, offsets = words.word_hashes(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        found, of = stretches(texts)
        found = [self.restored(s) for s in found]
        accents = [(k, plain) for k, text in enumerate(found) if not text.isascii() and (plain := fold(text)) != text]
        of += [of[k] for k, _ in accents]
        found += [plain for _, plain in accents]
        more, ends = words.word_hashes(pa.array(found, pa.string()))
        return np.concatenate((hashes, more)), np.concatenate((owner, np.repeat(np.array(of, np.int64), np.diff(ends))))


def _word_counts(language):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(language.value)
        for batch in batches:
            for part in words.sub_batches(batch, "text", 2 << 20):
                hashes, owner = reader.words(part.column("text"))
                pairs = np.unique(np.stack((owner.astype(np.uint64), hashes)), axis=1)
                toxic = np.asarray(part.column("toxic"))[pairs[0].astype(np.int64)] == 1
                value, at = np.unique(pairs[1], return_inverse=True)
                ones = np.bincount(at, toxic, len(value)).astype(np.int64)
                zeros = np.bincount(at, ~toxic, len(value)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(ones), pa.array(zeros)], names=["word", "ones", "zeros"])

    return run


def _features(language, hashes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(language.value)
        for batch in batches:
            for part in words.sub_batches(batch, "text", 2 << 20):
                owner, at = _seen(reader, part.column("text"), hashes.value)
                ends = np.searchsorted(owner, np.arange(len(part.column("text")) + 1)).astype(np.int32)
                features = pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), features], names=["toxic", "features"])

    return run


def _seen(reader: _Reader, texts: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, place)``, sorted: the places in the sorted ``hashes`` of the words that each text has."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, owner = reader.words(texts)
    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    hit = hashes[at] == found
    return np.divmod(np.unique(owner[hit].astype(np.int64) * len(hashes) + at[hit]), len(hashes))


def _solve(times, diagonal: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a positive definite system by conjugate gradients, the diagonal as preconditioner."""
    x, rest = np.zeros(len(right)), right.copy()
    along = aim = rest / diagonal
    size = rest @ aim
    least = 1e-20 * size
    for _ in range(10 * len(right)):
        if size <= least:
            break
        image = times(along)
        pace = size / (along @ image)
        x += pace * along
        rest -= pace * image
        aim = rest / diagonal
        size, before = rest @ aim, size
        along = aim + size / before * along
    return x


def logistic(row: np.ndarray, column: np.ndarray, width: int, y: np.ndarray, decay: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with quadratic decay of the weights, by Newton steps.

    The table of features has ``width`` columns and holds 1 at each ``(row, column)``, 0 elsewhere; it is never filled in.
    """
    forward = lambda v: np.bincount(row, v[column], len(y)) + v[-1]
    back = lambda u: np.append(np.bincount(column, u[row], width), u.sum())
    w = np.zeros(width + 1)
    keep = np.full(len(w), decay)
    keep[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(forward(w), -30, 30)))
        spread = p * (1 - p)
        step = _solve(lambda v: back(spread * forward(v)) + keep * v, back(spread) + keep, back(y - p) - keep * w)
        w += step * min(1.0, 4 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS) -> Scorer:
    """Scorer from ``documents(doc_id, text)`` and ``labels(doc_id, toxic)``.

    The character model counts all documents. Words are chosen and weighed on at most ``limit`` labelled documents, the
    first by the hash of their number: all words of MIN_DOCUMENTS documents or more whose share of toxic ones is MIN_Z
    standard errors off. Rows without label or doc_id do not count; of several labels the highest does.
    """
    spark: SparkSession = documents.sparkSession
    language = language_model(documents)
    sent = spark.sparkContext.broadcast(language)
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = stage(documents.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic"), "labelled")
    size = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    nothing = Scorer(language, np.zeros(0, np.uint64), np.zeros(0), math.log((size["toxic"] + 0.5) / (size["n"] - size["toxic"] + 0.5)))
    if not 0 < size["toxic"] < size["n"]:
        return nothing
    share = size["toxic"] / size["n"]
    counted = sample.mapInArrow(_word_counts(sent), "word long, ones long, zeros long").groupBy("word").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    n = F.col("ones") + F.col("zeros")
    z = F.abs(F.col("ones") - n * share) / F.sqrt(n * share * (1 - share))
    chosen = counted.where((n >= MIN_DOCUMENTS) & (z >= MIN_Z)).select("word").collect()
    hashes = np.sort(np.array([r["word"] for r in chosen], np.int64).view(np.uint64))
    rows = sample.mapInArrow(_features(sent, spark.sparkContext.broadcast(hashes)), "toxic int, features array<int>").toPandas()
    row = np.repeat(np.arange(len(rows)), rows["features"].str.len().to_numpy(np.int64))
    weights, bias = logistic(row, np.concatenate(rows["features"].to_list()).astype(np.int64), len(hashes), rows["toxic"].to_numpy(float))
    return Scorer(language, hashes, weights, bias)


def scored(documents: DataFrame, scorer: Scorer) -> DataFrame:
    """``(doc_id, score)`` for each row: the probability of label 1, by the whole text; null and empty texts get the bias's.

    Repeated rows score alike, a null doc_id stays, other columns are ignored, an empty table gives an empty result.
    """
    sent = documents.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        reader = _Reader(own.language)
        for batch in batches:
            for part in words.sub_batches(batch, "text", 2 << 20):
                owner, at = _seen(reader, pc.fill_null(part.column("text"), ""), own.hashes)
                value = np.bincount(owner, own.weights[at], part.num_rows) + own.bias
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(value, -500, 500))))], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
