"""Personal data: fixed patterns, and a semi-Markov conditional random field that finds what they miss.

The field scores whole candidate spans: how many digits in which groups, which separators, check sums, what stands before
and behind. A dynamic program over the atoms of an island (the surroundings of digits and at-signs) picks boundaries and
kinds together, no entity longer than MAX_ATOMS. Spans without digit and at-sign are no entities by construction, so what
lies between islands need not be searched. Weights are learnt from what the fixed patterns mark.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.llm import words
from review_topics.session import stage, unstage

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 24
TRAIN_ISLANDS = 600
EPOCHS = 6

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.S)
# An island: digits and at-signs with what joins them; at most two joining characters or a name lie between.
_BEFORE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+@()-"
_BEHIND = re.compile(r"(?:[A-Za-z0-9._%+@()/:,-]|[ \t](?=[0-9+(.-]))*+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost emails, from one at-sign to the next, so that long runs without one cost nothing."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind."""
    spans = []
    if not _ANY.search(text):
        return spans
    spans += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def span_features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole span and of the characters next to it."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    marks = "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", span))))
    before, behind = text[start - 1 : start], text[end : end + 1]
    out = [
        "bias",
        f"digits={min(len(digits), 20)}",
        f"groups={min(len(groups), 6)}",
        f"marks={marks[:8]}",
        f"shape={'-'.join(str(min(len(g), 9)) for g in groups[:6])}",
        f"ends={span[0] if not span[0].isalnum() else 'x'}{span[-1] if not span[-1].isalnum() else 'x'}",
        f"letters={bool(re.search('[A-Za-z]', span))}",
        f"joined={before.isalnum() or before in set('.-+@')}{behind.isalnum() or behind == '@'}",
    ]
    if 12 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if len(groups) == 4:
        out.append(f"octets={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if "@" in span:
        name, _, host = span.partition("@")
        out.append(f"mail={bool(name) and '.' in host.strip('.') and '@' not in host}")
    return out


def islands(text: str) -> Iterator[tuple[int, int]]:
    """From one digit or at-sign to the next outside the island before, outwards; every character is looked at once or twice."""
    floor = 0
    while found := _ANY.search(text, floor):
        start = floor + len(text[floor : found.start()].rstrip(_BEFORE))
        floor = _BEHIND.match(text, found.end()).end()
        yield start, floor


@dataclass
class Island:
    """Atoms of an island and its candidate spans ``(first atom, behind the last, start, end)``."""

    text: str
    start: int
    end: int
    atoms: list[tuple[int, int]] = field(default_factory=list)
    spans: list[tuple[int, int, int, int]] = field(default_factory=list)


def candidates(text: str, start: int, end: int, taken: list[tuple[int, int]] = ()) -> Island:
    """All spans of at most MAX_ATOMS atoms that hold a digit or at-sign, touch no blank end and no taken range."""
    atoms = [(m.start() + start, m.end() + start) for m in _ATOM.finditer(text[start:end])]
    blank = [text[a].isspace() for a, _ in atoms]
    key = np.cumsum([0, *("0" <= text[a] <= "9" or text[a] == "@" for a, _ in atoms)]).tolist()
    # Atoms that taken ranges touch: of the ranges that begin before an atom's end, one reaches behind its start.
    ranges = sorted(taken)
    begins, reach = [s for s, _ in ranges], list(accumulate((e for _, e in ranges), max))
    touched = [0]
    for a, b in atoms:
        before = bisect_left(begins, b)
        touched.append(touched[-1] + (before > 0 and reach[before - 1] > a))
    spans = []
    for i, (a, _) in enumerate(atoms):
        if blank[i]:
            continue
        for j in range(i + 1, min(len(atoms), i + MAX_ATOMS) + 1):
            b = atoms[j - 1][1]
            if not blank[j - 1] and key[j] > key[i] and touched[j] == touched[i]:
                spans.append((i, j, a, b))
    return Island(text, start, end, atoms, spans)


class SemiMarkovField:
    """Linear weights of (kind, feature) and (kind, next kind); outside an entity every atom scores 0."""

    def __init__(self) -> None:
        self.weights: dict[tuple[str, str], float] = {}

    def scores(self, island: Island) -> np.ndarray:
        get = self.weights.get
        out = np.empty((len(island.spans), len(KINDS)))
        for k, (_, _, a, b) in enumerate(island.spans):
            features = span_features(island.text, a, b)
            out[k] = [sum(get((kind, f), 0.0) for f in features) for kind in KINDS]
        return out

    def _steps(self) -> np.ndarray:
        return np.array([[self.weights.get((a, f"next={b}"), 0.0) for b in KINDS] for a in KINDS])

    def decode(self, island: Island) -> list[tuple[str, int, int]]:
        """Best segmentation; a tie keeps atoms outside, then prefers the earlier candidate and kind."""
        n, scores, steps = len(island.atoms), self.scores(island), self._steps()
        starting: dict[int, list[int]] = {}
        for k, span in enumerate(island.spans):
            starting.setdefault(span[1], []).append(k)
        kinds = len(KINDS)
        best = np.full((n + 1, kinds + 1), -np.inf)  # by the last kind; the last column: none so far
        best[0, kinds] = 0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for last in range(kinds + 1):
                back[j, last] = (j - 1, last, -1)
            for k in starting.get(j, ()):
                i = island.spans[k][0]
                for kind in range(kinds):
                    came = best[i] + np.append(steps[:, kind], 0.0)
                    last = int(came.argmax())
                    if came[last] + scores[k, kind] > best[j, kind] + 1e-12:
                        best[j, kind] = came[last] + scores[k, kind]
                        back[j, kind] = (i, last, k)
        last = kinds
        for kind in range(kinds):
            if best[n, kind] > best[n, last] + 1e-12:
                last = kind
        out, j = [], n
        while j > 0:
            i, before, k = back[j, last]
            if k >= 0:
                out.append((KINDS[last], *island.spans[k][2:]))
            j, last = i, before
        return out[::-1]

    def _expected(self, island: Island, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each (span, kind), and expected numbers of (kind, next kind)."""
        n, kinds, steps = len(island.atoms), len(KINDS), self._steps()
        steps = np.vstack([steps, np.zeros(kinds)])
        forward = np.full((n + 1, kinds + 1), -np.inf)
        forward[0, kinds] = 0
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for k, (i, j, _, _) in enumerate(island.spans):
            by_end.setdefault(j, []).append(k)
            by_start.setdefault(i, []).append(k)
        for j in range(1, n + 1):
            forward[j] = forward[j - 1]
            for k in by_end.get(j, ()):
                came = np.logaddexp.reduce(forward[island.spans[k][0]][:, None] + steps, axis=0) + scores[k]
                forward[j, :kinds] = np.logaddexp(forward[j, :kinds], came)
        backward = np.full((n + 1, kinds + 1), -np.inf)
        backward[n] = 0
        for i in range(n - 1, -1, -1):
            backward[i] = backward[i + 1]
            for k in by_start.get(i, ()):
                ahead = steps + scores[k] + backward[island.spans[k][1], :kinds]
                backward[i] = np.logaddexp(backward[i], np.logaddexp.reduce(ahead, axis=1))
        total = np.logaddexp.reduce(forward[n])
        chance, pairs = np.zeros_like(scores), np.zeros((kinds + 1, kinds))
        for k, (i, j, _, _) in enumerate(island.spans):
            joint = np.exp(forward[i][:, None] + steps + scores[k] + backward[j, :kinds] - total)
            chance[k] = joint.sum(0)
            pairs += joint
        return chance, pairs[:kinds]

    def fit(self, samples: list[tuple[Island, list[tuple[str, int, int]]]], epochs: int = EPOCHS, rate: float = 0.2) -> SemiMarkovField:
        """Gradient ascent on the log-likelihood, one island at a time, with decay toward 0."""
        prepared = []
        for island, gold in samples:
            places = {(a, b): k for k, (_, _, a, b) in enumerate(island.spans)}
            marked = [(places[a, b], KINDS.index(kind)) for kind, a, b in gold if (a, b) in places]
            if len(marked) == len(gold):
                prepared.append((island, marked, [span_features(island.text, a, b) for _, _, a, b in island.spans]))
        for epoch in range(epochs):
            step = rate / (1 + epoch)
            for island, marked, features in prepared:
                chance, pairs = self._expected(island, self.scores(island))
                change: dict[tuple[str, str], float] = {}
                weight = -chance
                for k, kind in marked:
                    weight[k, kind] += 1
                for k, kind in np.argwhere(np.abs(weight) > 1e-3):
                    for f in features[k]:
                        key = (KINDS[kind], f)
                        change[key] = change.get(key, 0.0) + weight[k, kind]
                for (_, a), (_, b) in zip(marked, marked[1:]):
                    pairs[a, b] -= 1
                for a, b in np.argwhere(np.abs(pairs) > 1e-3):
                    change[KINDS[a], f"next={KINDS[b]}"] = -pairs[a, b]
                for key, value in change.items():
                    self.weights[key] = (1 - 0.01 * step) * self.weights.get(key, 0.0) + step * value
        return self


def disguised(text: str, kind: str, start: int, end: int) -> tuple[str, tuple[str, int, int]] | None:
    """The text with one marked span written as the fixed patterns do not expect it: phones without country code, cards
    in groups joined by dots. So the field learns what a span looks like without what gave it away."""
    span = text[start:end]
    if kind == "phone":
        other = re.sub(r"\A\+[0-9]{1,3}[ .-]?(?=[(0-9])", "", span)
    elif kind == "card":
        other = ".".join(re.findall(r"[0-9]{1,4}", re.sub("[^0-9]", "", span)))
    else:
        return None
    return text[:start] + other + text[end:], (kind, start, start + len(other))


def train(documents: DataFrame, limit: int = TRAIN_ISLANDS) -> SemiMarkovField:
    """Field fitted on the islands of at most ``limit`` different texts, the first with a digit or at-sign by their hash."""
    shown = documents.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    around = F.expr("regexp_extract_all(text, '(?s).{0,40}[0-9@].{0,60}', 0)")
    # Hashes are ranked, not texts; only ``limit`` of them reach the driver, and the pieces of as many texts.
    first = stage(shown.select("h").distinct().orderBy("h").limit(limit), "pii-sample")
    pieces = shown.join(F.broadcast(first), "h").groupBy("h").agg(F.min(F.slice(around, 1, 4)).alias("parts"))
    rows = sorted(pieces.collect(), key=lambda row: row["h"])
    unstage(first)
    samples = []
    for row in rows:
        for part in row["parts"]:
            base = base_spans(part)
            for a, b in islands(part):
                gold, floor = [], a
                for kind, s, e in base:
                    if s >= floor and e <= b:
                        gold.append((kind, s, e))
                        floor = e
                samples.append((candidates(part, a, b), gold))
                if len(gold) == 1 and (changed := disguised(part, *gold[0])):
                    other, mark = changed
                    around_mark = [(x, y) for x, y in islands(other) if x <= mark[1] and mark[2] <= y]
                    samples += [(candidates(other, x, y), [mark]) for x, y in around_mark]
    return SemiMarkovField().fit(samples[:limit])


def find_spans(text: str, model: SemiMarkovField) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """``(base spans, all spans)``; those that the field adds touch no base span."""
    base = base_spans(text)
    added = []
    if _ANY.search(text):
        at = 0
        for a, b in islands(text):
            while at < len(base) and base[at][2] <= a and all(s[2] <= a for s in base[at : at + 4]):
                at += 1
            near, k = [], at
            while k < len(base) and base[k][1] < b:
                near.append((base[k][1], base[k][2]))
                k += 1
            island = candidates(text, a, b, near)
            if island.spans:
                added += model.decode(island)
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def personal_data(documents: DataFrame, model: SemiMarkovField) -> DataFrame:
    """``(doc_id, base, spans)`` for each row: arrays of ``(kind, start, end)`` in code points, by start, then kind.

    A null text is empty and has no spans. Repeated rows are read again; a null doc_id stays; other columns are ignored.
    """
    weights = documents.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SemiMarkovField()
        own.weights = weights.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in words.sub_batches(batch, "text", 4 << 20):
                base, spans = [], []
                for text in part.column("text").to_pylist():
                    found = find_spans(text or "", own)
                    for out, own_spans in zip((base, spans), found):
                        out.append([{"kind": k, "start": a, "end": b} for k, a, b in own_spans])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(base, kind), pa.array(spans, kind)], names=["doc_id", "base", "spans"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, base {spans}, spans {spans}")


def masked(documents: DataFrame, model: SemiMarkovField) -> DataFrame:
    """``documents`` with each span of personal data in ``text`` replaced by its kind in brackets; null stays null.

    Overlapping spans are replaced by one mark, that of the first. ``n_chars``, where there is one, is counted again.
    """
    weights = documents.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SemiMarkovField()
        own.weights = weights.value
        for batch in batches:
            for part in words.sub_batches(batch, "text", 4 << 20):
                out = []
                for text in part.column("text").to_pylist():
                    if text is not None and _ANY.search(text):
                        pieces, floor = [], 0
                        for kind, a, b in find_spans(text, own)[1]:
                            if a >= floor:
                                pieces += [text[floor:a], f"[{kind.upper()}]"]
                            floor = max(floor, b)
                        text = "".join([*pieces, text[floor:]])
                    out.append(text)
                at = part.schema.get_field_index("text")
                yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type))

    found = documents.mapInArrow(run, documents.schema)
    return found.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in documents.columns else found
