"""Token counts against the tokenizers themselves; toxicity against plain counts, enumeration and held-out labels."""

import itertools
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from review_topics.llm import queries, token_counts, toxicity

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def exact():
    """Number of tokens by the tokenizer itself, run on the same pieces and scores."""
    file = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = [(file.id_to_piece(i), file.get_score(i)) for i in range(file.get_piece_size())]
    reference = Tokenizer(models.Unigram(pieces, file.unk_id(), True))
    return lambda text: len(reference.encode("▁" + text.replace(" ", "▁")).ids) if text else 0


def test_counts_are_those_of_the_tokenizer(exact):
    counter = token_counts.Counter(token_counts.read_sentencepiece(PATH))
    rng = random.Random(3)
    texts = ["", " ", "  a", "the  cat sat", "日本語 text 🙂🙂", "a\nb\tc", "▁x▁▁y", "naïve  Äpfel — “q”…", "zzzzqqqq" * 20, " lead and trail "]
    texts += ["".join(rng.choices("aethino  rsd.Äé\n1", k=rng.randrange(1, 200))) for _ in range(300)]
    for text in texts:
        assert counter.count(text) == exact(text), text


@pytest.mark.parametrize("seed", range(6))
def test_ties_follow_the_tokenizer(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choices("ab▁", k=n)) for n in (1, 2, 2, 3, 3, 3, 4, 5) for _ in range(2)}
    vocabulary = [("<unk>", 0.0), *((p, float(-rng.randrange(1, 4))) for p in sorted(pieces))]
    reference = Tokenizer(models.Unigram(vocabulary, 0, False))
    counter = token_counts.Counter(token_counts.Vocabulary(dict(vocabulary[1:]), byte_fallback=False))
    counter.unknown = min(s for _, s in vocabulary) - 10.0
    for _ in range(300):
        text = "".join(rng.choices("abxyz ", (9, 9, 2, 1, 1, 5), k=rng.randrange(1, 14)))
        assert counter.count(text) == len(reference.encode("▁" + text.replace(" ", "▁")).ids), (text, vocabulary)


def test_counts_of_the_whole_query(spark, sf, exact):
    out = {r["doc_id"]: r["n_tokens"] for r in queries.QUERIES["op1_token_counts"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(out) == len(rows)
    for doc, text in rows:
        assert out[doc] == exact(text)


def test_odd_rows_are_counted(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a"), (2, "x" * 200_000)], "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    vocabulary = token_counts.read_sentencepiece(PATH)
    assert sorted(r["n_tokens"] for r in token_counts.count_tokens(docs, vocabulary).collect())[:2] == [0, 0]
    assert token_counts.count_tokens(docs.limit(0), vocabulary).count() == 0
    assert token_counts.Counter(token_counts.Vocabulary({})).count("é a") == 8 + 1


def test_language_model_counts_everything(spark):
    docs = spark.createDataFrame([("abc abd",), (None,), ("",), ("Äb",)], "text string")
    model = toxicity.language_model(docs)
    assert model.shape == (32,) * 4
    assert np.allclose(np.exp(model[:, :, :, :28]).sum(-1), 1, atol=1e-3)
    assert model[0, 1, 2, 3] == pytest.approx(model[0, 1, 2, 4])
    assert model[0, 1, 2, 3] > model[0, 1, 2, 5]


def every_reading(stretch):
    for parts in itertools.product(*toxicity.lattice(stretch)):
        yield "".join(p for p, _ in parts), -sum(cost for _, cost in parts)


def test_restoring_matches_enumeration():
    rng = np.random.default_rng(0)
    model = np.log(rng.dirichlet(np.ones(32), (32,) * 3)).astype(np.float32)
    for stretch in ("1d10t", "s t u p 1 d", "l000ser", "$cuuum", "m.o.r.o.n", "!!|ab", "ab", "tr4$h"):
        best = None
        for text, score in every_reading(stretch):
            line = [0, 0, 0, *(ord(c) - 96 for c in text), 0]
            score += sum(float(model[tuple(line[k - 3 : k])][line[k]]) for k in range(3, len(line)))
            if best is None or score > best[0] + 1e-9:
                best = (score, text)
        assert toxicity.restore(stretch, model) == best[1]


@pytest.mark.parametrize(
    "text, stretch",
    [("an 1d10t here", "1d10t"), ("you st*pid one", "st*pid"), ("so stuuuupid.", "stuuuupid"), ("m0r0n", "m0r0n"), ("i d i o t !", "i d i o t "), ("w.o.r.t.h", "w.o.r.t.h"), ("$cum", "$cum"), ("tra$h", "tra$h")],
)
def test_stretches_are_seen(text, stretch):
    found, of = toxicity.stretches(pa.array(["m0r0n 1d10t", "", None, text, "b"]).slice(1))
    assert stretch.strip() in [s.strip() for s in found] and set(of) == {2}, found


@pytest.mark.parametrize(
    "text, stretch",
    [("an i d i ö t here", "i d i ö t"), ("m é r d e !", "m é r d e"), ("т у п о й", "т у п о й"), ("Ö d e r", "Ö d e r"), ("an idiööööt.", "idiööööt"), ("идиооот", "идиооот"), ("𐐨𐐨𐐨", "𐐨𐐨𐐨"),
     ("“f u c k”", "f u c k"), ("a—f u c k", "f u c k"), ("x\u00a0f u c k", "f u c k"), ("“shi+”", "shi+"), ("ö-" * 200 + "x yes", "ö-" * 200 + "x"), ("f u c k " + "т у п " * 60 + "а", "f u c k " + "т у п " * 60 + "а")],
)
def test_stretches_of_any_script_are_seen_whole(text, stretch):
    found, of = toxicity.stretches(pa.array(["b", text, "é"]))
    assert stretch in [s.strip() for s in found] and set(of) == {1}, found


def test_a_sign_at_the_end_of_a_text_is_seen_before_another_text():
    assert toxicity.stretches(pa.array(["shi+", "next"])) == (["shi+"], [0])


@pytest.mark.parametrize("text", ["étés à la b", "naïve “A”, B", "слово и в доме", "———", "日本語。。。", "é"])
def test_plain_text_of_any_script_is_left_alone(text):
    assert toxicity.stretches(pa.array([text]))[0] == []


def test_triggers_miss_nothing_that_the_patterns_find():
    """Against the patterns run over whole texts."""
    rng = random.Random(2)
    spaced = re.compile(r"(?<![^\W_])" + toxicity._SPACED.pattern)
    texts = ["".join(rng.choices("abé ö и й语𐐨 ..-_'1$@!€£“—\u00a0", k=rng.randrange(0, 40))) for _ in range(20_000)]
    found, of = toxicity.stretches(pa.array(texts))
    own = [[] for _ in texts]
    for k, stretch in zip(of, found):
        own[k].append(stretch)
    for k, text in enumerate(texts):
        want = [m[0] for token in re.split(r"[\x00-\x20]+", text) for m in toxicity._DISGUISED.finditer(token)] + [m[0] for m in spaced.finditer(text)]
        assert own[k] == want, text


@pytest.mark.parametrize("text", ["plain words, and more.", "said 12 of 30 (in 1987)", "A. B", "well-known", "the&&& and%%%"])
def test_plain_text_is_left_alone(text):
    found, _ = toxicity.stretches(pa.array([text]))
    assert found in ([], ["well-known"])


def area(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    for value in np.unique(score):
        at = score == value
        ranks[at] = (np.searchsorted(np.sort(score), value) + np.searchsorted(np.sort(score), value, "right") + 1) / 2
    ones = label == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum()), order


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    out = queries.QUERIES["op5_toxicity"](spark, folder).toPandas()
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{folder}/labels.parquet'").fetchall())
    held = out[out.held_out & out.doc_id.isin(list(labels))]
    label = held.doc_id.map(labels).to_numpy()
    assert len(out) == 10_000 and out.score.between(0, 1).all()
    assert area(held.score.to_numpy(), label)[0] > 0.75
    assert (held.predicted == label).mean() > 0.93
    assert (label[held.predicted == 1] == 1).mean() > 0.97


def test_disguised_words_score_like_plain_ones(spark):
    rng = random.Random(8)
    common = ["house", "river", "mountain", "paper", "letter", "stone", "water", "winter", "silver", "orange"]
    rows, labels = [], []
    for i in range(600):
        body = rng.choices(common, k=12)
        if i % 4 == 0:
            body[rng.randrange(12)] = rng.choice(["idiot", "moron", "stupid", "trash"])
        rows.append((i, " ".join(body)))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic long")
    scorer = toxicity.train(docs, marks)
    probes = ["river 1d10t stone", "water m0r0n paper", "letter stuuuupid", "tr4$h winter", "i d i o t winter", "river stone paper", "", None]
    out = toxicity.scored(spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string").withColumn("score", F.lit(1)), scorer).collect()
    assert [r["score"] >= 0.5 for r in sorted(out, key=lambda r: r["doc_id"])] == [True] * 5 + [False] * 3


def test_disguised_words_of_any_script_score_like_plain_ones(spark):
    rng = random.Random(9)
    common = ["maison", "rivière", "дом", "река", "бумага", "письмо", "вода", "зима", "hiver", "eau"]
    rows, labels = [], []
    for i in range(600):
        body = rng.choices(common, k=12)
        if i % 4 == 0:
            body[rng.randrange(12)] = rng.choice(["débile", "тупой", "идиот", "merde"])
        rows.append((i, " ".join(body)))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic long")
    scorer = toxicity.train(docs, marks)
    probes = ["вода т у п о й дом", "eau d é b i l e hiver", "m é r d e hiver", "“м”, идиооот", "“m e r d e”", "вода зима", "“eau”", "rivière"]
    out = toxicity.scored(spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string"), scorer).collect()
    assert [r["score"] >= 0.5 for r in sorted(out, key=lambda r: r["doc_id"])] == [True] * 5 + [False] * 3


def test_nothing_to_learn_from(spark):
    docs, none = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic long")
    assert {r["score"] for r in toxicity.scored(docs, toxicity.train(docs, none)).collect()} == {0.5}
    assert toxicity.scored(docs.limit(0), toxicity.train(docs.limit(0), none)).count() == 0


def test_all_telling_words_count(spark):
    telling = [f"tell{chr(97 + k // 26)}{chr(97 + k % 26)}x" for k in range(620)]
    rows = [(i, "plain words " + " ".join(telling[(20 * i + k) % 620] for k in range(20)), 1) for i in range(310)]
    rows += [(i, "plain words of no kind", 0) for i in range(310, 1240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic long")
    scorer = toxicity.train(docs.drop("toxic"), docs.drop("text"))
    out = toxicity.scored(spark.createDataFrame([(-1, "plain"), *enumerate(telling)], "doc_id long, text string"), scorer).collect()
    score = {r["doc_id"]: r["score"] for r in out}
    clean = score.pop(-1)
    assert len(score) == 620 and min(score.values()) > clean + 1e-3


def test_sparse_fit_matches_the_dense_one():
    rng = np.random.default_rng(4)
    x = rng.random((300, 40)) < 0.2
    y = (x[:, :5].sum(1) + rng.random(300) > 1.5).astype(float)
    weights, bias = toxicity.logistic(*np.nonzero(x), 40, y)
    p = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert np.abs(x.T @ (y - p) - weights).max() < 1e-5 and abs((y - p).sum() - 1e-3 * bias) < 1e-5
    assert toxicity.logistic(np.zeros(0, int), np.zeros(0, int), 0, y)[1] == pytest.approx(np.log(y.mean() / (1 - y.mean())), abs=1e-3)
