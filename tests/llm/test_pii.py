"""Personal data: fixed patterns against plain regular expressions, the field against enumeration."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_topics.llm import pii, queries


def plain_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        d[-2::-2] = [x * 2 - 9 * (x > 4) for x in d[-2::-2]]
        if 12 <= len(d) <= 19 and sum(d) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_match_plain_patterns():
    rng = random.Random(7)
    parts = ["a", "b.c", "@", "@x.de", "4111 1111 1111 1111", "1.2.3.4", "300.1.1.1", ".5", "+1 (555) 123-4567", " ", "-", "é", "0", "99", "+", "%", "x@y", ".com", "\n", "1-2", "٣", "6011000990139424"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 9)))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    for text in ("a." * 400_000, "1" * 400_000, "1 " * 200_000, "a" * 400_000 + "@", "@" * 100_000, "+1 " * 100_000):
        pii.base_spans(text)


TEXT = "mail a.b@c.de or 10.0.0.1, +1 (555) 123-4567"


def small_field(seed):
    rng = random.Random(seed)
    field = pii.SemiMarkovField()
    island = pii.candidates("1.2@3 4", 0, 7)
    for _, _, a, b in island.spans:
        for f in pii.span_features(island.text, a, b):
            for kind in pii.KINDS:
                field.weights[kind, f] = rng.uniform(-1, 1)
    for a, b in itertools.product(pii.KINDS, repeat=2):
        field.weights[a, f"next={b}"] = rng.uniform(-1, 1)
    return field, island


def segmentations(island, at=0):
    n = len(island.atoms)
    if at == n:
        yield []
        return
    for rest in segmentations(island, at + 1):
        yield rest
    for k, (i, j, _, _) in enumerate(island.spans):
        if i == at:
            for rest in segmentations(island, j):
                for kind in range(len(pii.KINDS)):
                    yield [(k, kind), *rest]


def value(field, island, scores, segments):
    steps = sum(field.weights[pii.KINDS[a], f"next={pii.KINDS[b]}"] for (_, a), (_, b) in zip(segments, segments[1:]))
    return steps + sum(scores[k, kind] for k, kind in segments)


@pytest.mark.parametrize("seed", range(4))
def test_decoding_and_expectations_match_enumeration(seed):
    field, island = small_field(seed)
    island.spans = island.spans[::2]
    scores = field.scores(island)
    every = list(segmentations(island))
    values = np.array([value(field, island, scores, s) for s in every])
    best = every[int(values.argmax())]
    assert field.decode(island) == [(pii.KINDS[kind], *island.spans[k][2:]) for k, kind in best]
    chance = np.exp(values - np.logaddexp.reduce(values))
    want = np.zeros_like(scores)
    for p, s in zip(chance, every):
        for k, kind in s:
            want[k, kind] += p
    assert np.allclose(field._expected(island, scores)[0], want)


def test_field_learns_spans_that_the_patterns_miss(spark):
    rng = random.Random(1)
    number = lambda: f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    rows = [(i, rng.choice([f"call +{rng.randrange(1, 9)} {number()} now", f"from 10.{i % 200}.3.4 today", f"mail u{i}@h.example.com, ok", f"in {1900 + i % 100} there were {i} of 12"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(docs)
    base, spans = pii.find_spans(f"call {number()} now, in 1987", model)
    assert base == [] and [s[0] for s in spans] == ["phone"]
    assert pii.find_spans("in 1987 there were 12 of 30", model)[1] == []


def test_whole_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: r for r in queries.QUERIES["op6_personal_data"](spark, sf).collect()}
    assert len(out) == len(rows)
    for doc, text in rows:
        base = plain_base(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = out[doc]
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(row["spans"].split(","))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 0), (3, "x@y.de", 6), (3, "x@y.de", 6), (None, "1.2.3.4", 7)], "doc_id long, text string, n_chars long").withColumn("spans", F.lit(1))
    model = pii.SemiMarkovField()
    found = pii.personal_data(docs, model).collect()
    assert sorted(len(r["base"]) for r in found) == [0, 0, 1, 1, 1]
    assert sorted((r["text"] or "-", r["n_chars"]) for r in pii.masked(docs, model).collect() if r["doc_id"] != 1) == [("-", 0), ("[EMAIL]", 7), ("[EMAIL]", 7), ("[IP]", 4)]
    assert pii.personal_data(docs.limit(0), pii.train(docs.limit(0))).count() == 0


def test_islands_are_those_of_one_pattern():
    pattern = re.compile(r"[A-Za-z0-9._%+@()-]*[0-9@](?:[A-Za-z0-9._%+@()/:,-]|[ \t](?=[0-9+(.-]))*")
    rng = random.Random(12)
    for _ in range(3000):
        text = "".join(rng.choices("ab1@ .,/(+-\té", k=rng.randint(0, 25)))
        assert list(pii.islands(text)) == [m.span() for m in pattern.finditer(text)], text


def test_candidates_leave_taken_ranges_alone():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices("ab1@ .-", k=rng.randint(1, 25)))
        taken = sorted((a, a + rng.randint(1, 6)) for a in rng.choices(range(25), k=rng.randint(0, 4)))
        free = {s for s in pii.candidates(text, 0, len(text)).spans if not any(x < s[3] and s[2] < y for x, y in taken)}
        assert set(pii.candidates(text, 0, len(text), taken).spans) == free


def test_very_long_texts_take_linear_time():
    model = pii.SemiMarkovField()
    for text in ("x" * 1_000_000 + "1", "a" * 400_000 + " " + "1" * 400_000, ",".join(f"user{i}@host{i}.example.org" for i in range(4_000)), "@" * 1_000):
        begun = time.perf_counter()
        pii.find_spans(text, model)
        assert time.perf_counter() - begun < 20
