"""N-gram join, decontamination and language identification against brute force."""

import itertools
import random
import re
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from review_topics.llm import cross_parsing, decontaminate, ngram_jaccard, queries, words

PLAIN = re.compile(r"[a-z0-9_\u0080-\U0010ffff]+")


def plain_words(text):
    return [w for part in re.split("[\u0080-©«-´¶-¹»-¿ -ⁿ　-〿]", (text or "").lower()) for w in PLAIN.findall(part)]


def grams(text, n=5):
    w = plain_words(text)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


ODD = [None, "", " . ", "one", "One  two", "a b—c、d étÉ ǅ", "word", "x" * 3000, "ab " * 5000, "é" * 40]


def test_words_are_those_of_a_plain_tokenizer(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 4096)
    hashes, offsets = words.word_hashes(pa.array(ODD))
    seen = {}
    for text, a, b in zip(ODD, offsets, offsets[1:]):
        own = plain_words(text)
        assert b - a == len(own)
        for w, h in zip(own, hashes[a:b]):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams_stay_inside_their_text():
    texts = ["a b c d e f", "b c", None, "a b c d e", "f", "b c d e f"]
    values, offsets = words.ngram_hashes(*words.word_hashes(pa.array(texts)), 5)
    sets = [set(values[a:b]) for a, b in zip(offsets, offsets[1:])]
    assert [len(s) for s in sets] == [2, 1, 0, 1, 1, 1]
    assert sets[0] == sets[3] | sets[5] and not sets[1] & sets[0]


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.9995):
        bands, rows = ngram_jaccard.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= 128


def brute_links(rows, share=Fraction(4, 5)):
    sets = [grams(t) for _, t in rows]
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and Fraction(common, len(sets[a] | sets[b])) >= share:
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        lowest[find(i)] = min(doc, lowest.get(find(i), doc))
    return {doc: (lowest[find(i)], links[i]) for i, (doc, _) in enumerate(rows)}


def near_copies(seed, groups=6, size=9, length=60):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(length)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(length)] = f"x{rng.randrange(9)}"
            texts.append(" ".join(own))
    return texts + ODD + ["One  two", "one TWO"]


@pytest.mark.parametrize("block", [256, 3])
def test_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_jaccard, "BLOCK_ROWS", block)
    rows = list(enumerate(near_copies(block)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("clash"))
    out = ngram_jaccard.jaccard_links(docs, recall=0.99999).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in out} == brute_links(rows)
    assert len(out) == len(rows)


def test_links_of_the_whole_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = queries.QUERIES["op8_ngram_jaccard_join"](spark, sf).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in out} == brute_links([tuple(r) for r in rows])


@pytest.mark.parametrize("turn", [False, True])
def test_links_of_each_text_of_a_doc_id_are_verified(spark, turn):
    rng = random.Random(21)
    texts = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(2)]
    near = [t + " end" for t in texts]
    mixed = " ".join([*texts[0].split()[:58], *texts[0].split()[58:], "more", "at", "end"])
    rows = [(1, texts[0]), (1, texts[1]), (7, near[0]), (8, near[1]), (9, near[1]), (1, mixed)]
    docs = spark.createDataFrame(rows[::-1] if turn else rows, "doc_id long, text string").coalesce(1)
    out = sorted(tuple(r) for r in ngram_jaccard.jaccard_links(docs).collect())
    assert {(r[0], r[1]) for r in out} == {(1, 1), (7, 1), (8, 1), (9, 1)}
    assert out == [(1, 1, 1, 2, 1), (1, 1, 1, 2, 2), (1, 1, 1, 2, 2), (7, 1, 7, 2, 2), (8, 1, 8, 2, 1), (9, 1, 8, 2, 1)]


def test_links_of_nothing(spark):
    assert ngram_jaccard.jaccard_links(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_placement_of_substitutions_leaves_a_seed():
    for n, k in ((13, 2), (15, 3), (20, 4)):
        seeds = [sum(1 << (i + x) for x in m) for m in decontaminate.MASKS for i in range(n - m[-1])]
        for gone in itertools.combinations(range(n), k):
            bad = sum(1 << x for x in gone)
            assert any(not seed & bad for seed in seeds)


def brute_overlap(same, share):
    best = (0, 0, 0)
    for a in range(len(same)):
        for b in range(a + 1, len(same) + 1):
            if same[a] and same[b - 1] and sum(same[a:b]) * share.denominator >= share.numerator * (b - a) and b - a > best[1]:
                best = (a, b - a, sum(same[a:b]))
    return best[1:]


def test_longest_overlap_matches_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        same = [rng.random() < 0.7 for _ in range(rng.randrange(1, 25))]
        assert decontaminate.best_overlap(np.array(same), Fraction(4, 5))[1:] == brute_overlap(same, Fraction(4, 5))


def brute_contamination(docs, items, min_words=13, share=Fraction(4, 5)):
    found = {}
    for doc, text in docs:
        own = plain_words(text)
        for item, passage in items:
            other = plain_words(passage)
            for shift in range(-len(other) + 1, len(own)) if other else ():
                a, b = max(0, -shift), min(len(other), len(own) - shift)
                same = [own[i + shift] == other[i] for i in range(a, b)]
                if sum(same) < min(min_words, len(other)) * 0.8:
                    continue
                length, matches = brute_overlap(same, share)
                if length >= min(min_words, len(other)):
                    found[doc, item] = max(found.get((doc, item), (0, 0)), (length, matches))
    return found


def test_contamination_matches_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([15, 18, 30, 40, 13, 8, 3, 1, 0])] + [(9, None), (None, "a b c")]
    items[7] = (7, "solitary")
    docs = []
    for d in range(60):
        body = rng.choices(vocabulary, k=rng.randrange(0, 60))
        if d % 2:
            own = (rng.choice(items[:7])[1] or "").split()
            for _ in range(len(own) // 6 if len(own) >= 13 else 0):
                own[rng.randrange(len(own))] = "zz"
            cut = rng.choice([0, 0, len(own) // 2])
            at = rng.randrange(len(body) + 1)
            body[at:at] = own[cut:]
        docs.append((d, " ".join(body)))
    docs += [(100, None), (101, ""), (102, items[0][1].upper()), (102, items[0][1].upper()), (103, "SOLITARY, indeed"), (None, items[0][1])]
    out = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    want = brute_contamination([d for d in docs if d[0] is not None], [i for i in items if i[0] is not None])
    assert {(r["doc_id"], r["item_id"]): (r["n_words"], r["n_same"]) for r in out} == want
    assert len(out) == len(want) > 20


def test_contamination_of_the_whole_query(spark, sf):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    squeezed = {i: " ".join(plain_words(t)) for i, t in items}
    whole = {(d, i) for d, t in docs for i, s in squeezed.items() if f" {s} " in f" {' '.join(plain_words(t))} "}
    out = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op4_decontamination"](spark, sf).collect()}
    assert whole and whole <= out


def test_each_text_of_an_id_is_compared(spark):
    rng = random.Random(31)
    words_of = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    one, two, third, fourth = (words_of(20) for _ in range(4))
    items = spark.createDataFrame([(0, one), (0, two), (1, third), (2, fourth)], "item_id long, text string")
    rows = [(1, f"{words_of(5)} {one}"), (2, f"{words_of(5)} {two}"), (3, third), (3, fourth), (3, fourth)]
    out = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted(tuple(r) for r in out) == [(1, 0, 20, 20, 5, 0), (2, 0, 20, 20, 5, 0), (3, 1, 20, 20, 0, 0), (3, 2, 20, 20, 0, 0)]


def test_contamination_of_nothing(spark):
    none, one = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert decontaminate.contaminated(none, one.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert decontaminate.contaminated(one, none.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def brute_phrases(train, text):
    count = at = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in train:
            n += 1
        count, at = count + 1, at + n
    return count


def test_automaton_accepts_the_substrings():
    rng = random.Random(8)
    for _ in range(60):
        size = rng.choice([3, 5, 900])
        line = [rng.randrange(size) for _ in range(rng.randint(0, 90))]
        own = cross_parsing.build_automaton(line, size)
        inside = {tuple(line[i:j]) for i in range(len(line)) for j in range(i + 1, len(line) + 1)}
        tries = [tuple(line[i : i + n]) for i in range(0, len(line), 3) for n in (1, 2, 4, 7)] + [tuple(rng.choices(line or [0], k=rng.randint(1, 6))) for _ in range(80)]
        for word in filter(None, tries):
            state, phrases = np.zeros(1, np.int64), 0
            for c in word:
                state, begins = own.step(state, np.array([c]))
                phrases += int(begins[0])
            assert (phrases == 1 and state[0] > 0) == (word in inside)


def greedy_phrases(train, line):
    count, at = 0, 0
    while at < len(line):
        end = at + 1
        while end < len(line) and line[at : end + 1] in train:
            end += 1
        count, at = count + 1, end
    return count


@pytest.mark.parametrize("segment", [3, 16, 256])
def test_borders_of_segments_change_nothing(monkeypatch, segment):
    monkeypatch.setattr(cross_parsing, "SEGMENT", segment)
    rng = random.Random(segment)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 6)))
    train = " ".join(word() for _ in range(300))
    model = cross_parsing.fit_model({"x": [train], "y": [" ".join(word() for _ in range(40))]})
    texts = [train[9:1100], " ".join(word() for _ in range(700)), "", None, train[:5] * 300, "q" * 700, train[3:500] + "zz" + train[40:900], "a"]
    texts += ["".join(rng.choices("ab ", k=rng.randint(0, 90))).strip() for _ in range(60)]
    bits, _ = cross_parsing.entropies(model, pa.array(texts))
    for text, row in zip(texts, bits):
        line = re.sub(" +", " ", text or "").lstrip()
        assert row[0] * max(1, len(line)) == pytest.approx(greedy_phrases(" " + train, line) * np.log2(len(" " + train) + 2))


def test_as_many_languages_and_letters_as_there_are(spark):
    rng = random.Random(1)
    letters = [chr(c) for c in (*range(0x4E00, 0x5A00), *range(0x32000 - 4, 0x32010), *range(0x400, 0x4FF)) if chr(c).isalpha()]
    assert len(letters) > 3_000 and max(letters) >= chr(0x31FFF)
    rows = []
    for k in range(300):
        own = rng.sample(letters, 60)
        rows += [(1000 * k + i, "".join(rng.choices(own, k=40)), f"l{k:03}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = cross_parsing.train(docs)
    assert len(model.languages) == 300 and len(model.blocks) == 10
    assert sum(own.base.nbytes + own.owner.nbytes + own.target.nbytes + own.first.nbytes for block in model.blocks for own in block) < 300 * 200_000
    asked = spark.createDataFrame([(1000 * k, rows[4 * k + 2][1][5:30]) for k in range(0, 300, 7)] + [(-1, "𲀀"), (-2, "12")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in cross_parsing.identify(asked, model).collect()}
    assert all(found[1000 * k] == f"l{k:03}" for k in range(0, 300, 7))
    assert found[-2] == "und" and (found[-1] == "und") == (not "𲀀".isalpha())


def test_every_chosen_text_is_learnt_from(spark):
    letters = [chr(0x4E00 + i) for i in range(60)]
    docs = spark.createDataFrame([(i, letters[i] * 5000, "x") for i in range(48)] * 3, "doc_id long, text string, lang string")
    model = cross_parsing.train(docs)
    assert len(model.alphabet) == 48 and model.blocks[0][0].trained == 48 * (cross_parsing.TRAIN_CHARS // cross_parsing.TRAIN_TEXTS)


def test_phrases_match_brute_force():
    samples = {"a": ["the cat sat on the mat and then the hat"], "b": ["der hund lief in den wald hinein"]}
    model = cross_parsing.fit_model(samples)
    texts = ["the cat ran", "der wald, der HUND!", "zzz", "the", None, "12 34", "mat hund " * 20]
    bits, spoken = cross_parsing.entropies(model, pa.array(texts))
    assert spoken.tolist() == [True, True, True, True, False, False, True]
    for text, row in zip(texts[:4], bits):
        line = re.sub(r"[^a-z]+", " ", text.lower())
        for k, language in enumerate(model.languages):
            train = " " + samples[language][0]
            assert row[k] == pytest.approx(brute_phrases(train, line) * np.log2(len(train) + 2) / len(line))


def test_languages_of_held_out_documents(spark, sf):
    out = queries.QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    truth = dict(duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    held = out[out.held_out]
    assert len(out) == 1000 and 200 < len(held) < 450
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.97


def test_languages_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    out = cross_parsing.identify(docs, cross_parsing.train(docs)).collect()
    assert [(r["lang_pred"], r["score"]) for r in out] == [("und", 0.0)] * 2
    one = docs.select("doc_id", F.lit("wort und satz").alias("text"), F.lit("de").alias("lang"))
    assert {r["lang_pred"] for r in cross_parsing.identify(docs, cross_parsing.train(one)).collect()} == {"de", "und"}
