import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.functions import text as T
from review_topics.operators import distribution, embedding, reduction, represent, terms, topics, zeroshot

ENCODER = embedding.HashedEncoder(64)


def weights_table(spark, seed=1, topics_n=4, vocabulary=30):
    rng = random.Random(seed)
    rows = [(t, f"w{i}", 3, 2, rng.random()) for t in range(-1, topics_n) for i in range(vocabulary) if rng.random() < 0.6]
    return spark.createDataFrame(rows, "topic_id int, term string, tf long, doc_freq long, weight double"), rows


def brute_scores(tokens, rows, window, minimum):
    """(start, topic) -> cosine, by the definition: term counts of a window against a topic's whole row."""
    by_topic = defaultdict(dict)
    for topic, term, _, _, weight in rows:
        if topic >= 0:
            by_topic[topic][term] = weight
    scores = {}
    for start in range(max(len(tokens) - window, 0) + 1):
        counts = Counter(tokens[start : start + window])
        length = math.sqrt(sum(c * c for c in counts.values()))
        for topic, row in by_topic.items():
            dot = sum(c * row.get(term, 0.0) for term, c in counts.items())
            cosine = dot / (length * math.sqrt(sum(w * w for w in row.values())))
            if round(cosine, 9) >= minimum:
                scores[start, topic] = cosine
    return scores


TEXTS = {1: "w1 w2 w3 w4 w5 w1 w1 w1 w9", 2: "w3 w3", 3: "zz yy xx", 4: "", 5: "w7", 6: "w1 zz w2 zz w3 zz w4 w29 w28 w27 w5"}


@pytest.mark.parametrize("minimum", [0.0001, 0.2])
def test_distribution_matches_definition(spark, minimum):
    weights, rows = weights_table(spark)
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, document string")
    got = {(r["doc_id"], r["topic_id"]): r["p"] for r in distribution.approximate_distribution(docs, weights, min_similarity=minimum).collect()}
    tokens_got = {
        (r["doc_id"], r["pos"], r["term"], r["topic_id"]): r["p"]
        for r in distribution.token_distribution(docs, weights, min_similarity=minimum).collect()
    }
    want, tokens_want = {}, {}
    for doc, text in TEXTS.items():
        tokens = text.split()
        scores = brute_scores(tokens, rows, 4, minimum) if tokens else {}
        total = sum(scores.values())
        for (start, topic), score in scores.items():
            want[doc, topic] = want.get((doc, topic), 0) + score / total
            for pos in range(start, min(start + 4, len(tokens))):
                key = (doc, pos, tokens[pos], topic)
                tokens_want[key] = tokens_want.get(key, 0) + score
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert tokens_got.keys() == tokens_want.keys() and all(abs(tokens_got[k] - tokens_want[k]) < 1e-9 for k in tokens_want)
    sums = Counter()
    for (doc, _), p in got.items():
        sums[doc] += p
    assert all(abs(s - 1) < 1e-9 for s in sums.values())


def test_topics_beyond_a_tile_and_words_of_no_topic(spark, monkeypatch):
    monkeypatch.setattr(distribution, "BLOCK_WORDS", 40)
    monkeypatch.setattr(distribution, "CELLS", 64)
    rng = random.Random(9)
    rows = [(t, f"w{i}", 3, 2, rng.random()) for i in range(30) for t in rng.sample(range(1400), 25 if i else 600)] + [(-1, "only", 3, 2, 0.5), (1399, "w3", 1, 1, 0.0)]
    rows = list({r[:2]: r for r in rows}.values())
    weights = spark.createDataFrame(rows, "topic_id int, term string, tf long, doc_freq long, weight double")
    docs = {i: " ".join(rng.choice(["w0", "only", "none", *(f"w{j}" for j in range(30))]) for _ in range(rng.randint(0, 60))) for i in range(12)}
    docs |= {50: "only only only", 51: None, 52: "w0 " * 100}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, document string")
    for window, stride in ((4, 1), (3, 2), (1, 1)):
        got = {(r["doc_id"], r["topic_id"]): r["p"] for r in distribution.approximate_distribution(frame, weights, window, stride, 0.02).collect()}
        pieces = {(r["doc_id"], r["pos"], r["topic_id"]): (r["p"], r["term"]) for r in distribution.token_distribution(frame, weights, window, stride, 0.02).collect()}
        want, credited = {}, {}
        for doc, text in docs.items():
            tokens = (text or "").split()
            scores = {k: v for k, v in brute_scores(tokens, rows, window, 0.02).items() if k[0] % stride == 0} if tokens else {}
            total = sum(scores.values())
            for (start, topic), score in scores.items():
                want[doc, topic] = want.get((doc, topic), 0) + score / total
                for pos in range(start, min(start + window, len(tokens))):
                    credited[doc, pos, topic] = (credited.get((doc, pos, topic), (0,))[0] + score, tokens[pos])
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert pieces.keys() == credited.keys() and all(abs(pieces[k][0] - credited[k][0]) < 1e-9 and pieces[k][1] == credited[k][1] for k in credited)


def test_texts_do_not_move_for_a_distribution(spark, sf):
    from review_topics.queries import topic_queries

    plan = topic_queries.h1_distribution(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "document" not in plan and "regexp_extract" not in plan


def test_outliers_move_and_others_stay(spark):
    before = spark.createDataFrame([(1, -1, 0.0), (2, -1, 0.0), (3, 2, 0.7), (4, -1, 0.0)], "doc_id long, topic_id int, probability double")
    soft = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.5), (3, 0, 0.9), (4, 3, 0.3)], "doc_id long, topic_id int, p double")
    after = {r["doc_id"]: (r["topic_id"], r["probability"]) for r in topics.reduce_outliers(before, soft).collect()}
    assert after == {1: (0, 0.5), 2: (-1, 0.0), 3: (2, 0.7), 4: (3, 0.3)}
    strict = {r["doc_id"]: r["topic_id"] for r in topics.reduce_outliers(before, soft, 0.4).collect()}
    assert strict == {1: 0, 2: -1, 3: 2, 4: -1}


def test_ties_go_to_the_first_topic_and_missing_vectors_to_none(spark):
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, -1.0])], "doc_id long, vec array<double>")
    prototypes = spark.createDataFrame([(2, [0.0, 3.0]), (0, [2.0, 0.0]), (1, [2.0, 0.0])], "idx int, vec array<double>")
    rows = {r["doc_id"]: (r["idx"], round(r["similarity"], 6)) for r in zeroshot.assign_zero_shot(vecs, prototypes, 0.6).collect()}
    assert rows == {1: (0, 1.0), 2: (0, 0.707107), 3: (None, 0.0), 4: (None, 0.0)}


def test_twelve_thousand_topics_predict_like_one_product(spark):
    from review_topics.plans import predict

    rng = np.random.default_rng(12)
    topics, docs = rng.integers(-3, 4, (12_000, 6)).astype(float), rng.normal(size=(300, 6))
    docs[0], docs[1] = topics[11_999] * 2, 0
    table = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(12_000), topics)], "topic_id int, vec array<double>")
    vecs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(docs)] + [(300, None)], "doc_id long, vec array<double>")
    none = table.limit(0)
    got = {r["doc_id"]: (r["topic_id"], r["probability"]) for r in predict.predict_vectors(vecs, none, table, 0.5).collect()}
    listed = sorted((r["topic_id"], r["vec"]) for r in table.collect())
    matrix = np.array([v for _, v in listed])
    unit = np.divide(matrix, np.linalg.norm(matrix, axis=1, keepdims=True), out=np.zeros_like(matrix), where=matrix.any(1, keepdims=True))
    lengths = np.linalg.norm(docs, axis=1, keepdims=True)
    scores = np.round(np.divide(docs, lengths, out=np.zeros_like(docs), where=lengths > 0) @ unit.T, 12)
    best = scores.argmax(1)
    want = {i: (listed[b][0], scores[i, b]) if round(scores[i, b], 6) >= 0.5 else (-1, 0.0) for i, b in enumerate(best)} | {300: (-1, 0.0)}
    assert got.keys() == want.keys() and all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-9 for i in want)
    assigned = zeroshot.assign_zero_shot(vecs, none, 0.5, "topic_id").collect()
    assert len(assigned) == 301 and {(r["topic_id"], r["similarity"]) for r in assigned} == {(None, 0.0)}


def test_threshold_is_inclusive(spark):
    vecs = spark.createDataFrame([(1, [0.6, 0.8])], "doc_id long, vec array<double>")
    prototypes = spark.createDataFrame([(0, [1.0, 0.0])], "idx int, vec array<double>")
    assert zeroshot.assign_zero_shot(vecs, prototypes, 0.6).first()["idx"] == 0


def test_hashed_vectors_follow_the_rule(spark):
    import hashlib

    docs = spark.createDataFrame([(1, "Seat seat, legroom."), (2, "!"), (3, None)], "doc_id long, document string")
    rows = {r["doc_id"]: r["vec"] for r in embedding.embed(docs, ENCODER).collect()}
    want = np.zeros(64)
    for term, tf in (("seat", 2), ("legroom", 1)):
        want[int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % 64] += 1 + math.log(tf)
    assert np.allclose(rows[1], want / np.linalg.norm(want)) and rows[2] is None and rows[3] is None


def test_injected_encoder_is_called_in_batches(spark):
    encoder = embedding.BatchEncoder("lengths", 2, lambda texts: np.array([[len(t), 1.0] for t in texts]))
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, document string")
    assert {r["doc_id"]: r["vec"] for r in embedding.embed(docs, encoder).collect()} == {1: [3.0, 1.0], 2: None}


def test_projection_and_pca_keep_documents(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(30)] + [(99, None)]
    vecs = spark.createDataFrame(rows, "doc_id long, vec array<double>")
    low = {r["doc_id"]: r["low"] for r in reduction.reduce_dims(vecs, 3, "projection", 8).collect()}
    signs = reduction.sign_matrix(8, 3, 42)
    assert set(low) == set(range(30)) and all(np.allclose(low[i], np.array(v) @ signs) for i, v in rows[:30])
    pca = {r["doc_id"]: r["low"] for r in reduction.reduce_dims(vecs, 3, "pca").collect()}
    x = np.array([v for _, v in rows[:30]])
    _, _, axes = np.linalg.svd(x - x.mean(axis=0))
    assert np.allclose(np.abs([pca[i] for i in range(30)]), np.abs(x @ axes[:3].T))


def test_mmr_matches_brute_force(spark):
    words = ["seat", "seats", "seating", "food", "foods", "crew", "bags", "baggage"]
    rows = [(t, "Main", i + 1, w, 1.0 / (i + 1 + t)) for t in (0, 1) for i, w in enumerate(words)]
    candidates = spark.createDataFrame(rows, "topic_id int, aspect string, rank int, term string, weight double")
    got = defaultdict(list)
    for r in represent.mmr(candidates, ENCODER, 0.3, 4).orderBy("topic_id", "rank").collect():
        got[r["topic_id"]].append(r["term"])
    vec = {r["term"]: np.array(r["vec"]) for r in represent.embed_terms(candidates, ENCODER, represent.trigram_text).collect()}
    for topic in (0, 1):
        weight = {r[3]: r[4] for r in rows if r[0] == topic}
        chosen = [words[0]]
        while len(chosen) < 4:
            score = {w: 0.7 * weight[w] / max(weight.values()) - 0.3 * max(vec[w] @ vec[c] for c in chosen) for w in words if w not in chosen}
            chosen.append(max(score, key=score.get))
        assert got[topic] == chosen
    assert represent.mmr(candidates, ENCODER, 0.0, 4).where("topic_id = 0").orderBy("rank").first()["term"] == "seat"


def test_ctfidf_ranks_by_weight_and_counts_every_document(spark):
    docs = spark.createDataFrame([(1, "food food crew"), (2, "seat crew"), (3, "seat seat row")], "doc_id long, document string")
    assigned = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, topic_id int")
    weights = terms.ctfidf(terms.topic_terms(embedding.term_lists(docs), assigned))
    rows = {(r["topic_id"], r["term"]): r["weight"] for r in weights.collect()}
    mean = (3 + 5) / 2
    assert rows[0, "food"] == pytest.approx(2 / 3 * math.log(1 + mean / 2))
    assert rows[1, "crew"] == pytest.approx(1 / 5 * math.log(1 + mean / 2))
    assert terms.top_terms(weights, 1).where("topic_id = 1").first()["term"] == "seat"


def test_labels(spark):
    replies = ["'''\ntopic: Seat Comfort\n'''", "Seat Comfort", "'Seat Comfort\n'", "\ntopic:Seat Comfort\n"]
    df = spark.createDataFrame([(r,) for r in replies], "reply string")
    assert {r[0] for r in df.select(T.clean_label(F.col("reply"))).collect()} == {"Seat Comfort"}
    generated = spark.createDataFrame([(-1, "-1_a_b"), (0, "0_a"), (1, "1_b")], "topic_id int, label string")
    fixed = spark.createDataFrame([(0, V.PREDEFINED_TOPICS[1]), (1, None)], "topic_id int, label string")
    names = topics.topic_labels(generated, fixed)
    assert {r["topic_id"]: r["label"] for r in names.collect()} == {-1: "-1_a_b", 0: "Seating Comfort", 1: "1_b"}
    custom = spark.createDataFrame([(-1, "x"), (1, "Mine")], "topic_id int, label string")
    final = {r["topic_id"]: r["label"] for r in topics.set_topic_labels(names, custom).collect()}
    assert final == {-1: V.OUTLIER_LABEL, 0: "Seating Comfort", 1: "Mine"}


def test_topics_are_numbered_in_order(spark):
    zero = spark.createDataFrame([(i, [3, 1, None, None, None, None, None, None][i], 0.9) for i in range(8)], "doc_id long, idx int, similarity double")
    found = spark.createDataFrame([(2, 2, 0.5), (3, 3, 0.5), (4, 3, 0.5), (5, 5, 0.5), (6, None, 0.0)], "doc_id long, cluster long, probability double")
    assigned, table = topics.combine_topics(zero, found)
    ids = {r["doc_id"]: (r["topic_id"], r["probability"]) for r in assigned.collect()}
    assert ids == {1: (0, 0.9), 0: (1, 0.9), 3: (2, 0.5), 4: (2, 0.5), 2: (3, 0.5), 5: (4, 0.5), 6: (-1, 0.0), 7: (-1, 0.0)}
    assert sum(r["size"] for r in table.collect()) == 8


def sparse_topics(spark, n, seed=3, shared=0.6):
    rng = random.Random(seed)
    rows = [(t, f"w{rng.randrange(400)}" if rng.random() < shared else f"own{t}", rng.random() + 0.1) for t in range(-1, n) for _ in range(12)]
    rows = list({r[:2]: r for r in rows}.values()) + [(n, "nobody else", 0.4), (n + 1, "nothing", 0.0)]
    return spark.createDataFrame([(t, w, 1, 1, x) for t, w, x in rows], "topic_id int, term string, tf long, doc_freq long, weight double"), rows


def cosines_of(rows):
    by_topic = defaultdict(dict)
    for topic, term, weight in rows:
        if weight:
            by_topic[topic][term] = weight
    length = {t: math.sqrt(sum(x * x for x in row.values())) for t, row in by_topic.items()}
    ids = sorted(by_topic)
    return {(a, b): sum(x * by_topic[b].get(w, 0) for w, x in by_topic[a].items()) / (length[a] * length[b]) for i, a in enumerate(ids) for b in ids[i + 1 :]}


def test_pairs_of_blocks_give_every_pair_and_its_tree(spark, monkeypatch):
    from review_topics.operators import relations

    monkeypatch.setattr(relations, "BLOCK_TOPICS", 16)
    monkeypatch.setattr(relations, "PART_TERMS", 150)
    monkeypatch.setattr(relations, "CHUNK_TERMS", 64)
    weights, rows = sparse_topics(spark, 50)
    want = cosines_of(rows)
    for minimum in (0.0, 0.2):
        got = {(r["topic_a"], r["topic_b"]): r["similarity"] for r in relations.topic_similarity(weights, minimum).collect()}
        expected = {k for k, v in want.items() if v > 0 and round(v, 9) >= minimum}
        assert got.keys() == expected and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    tree = [tuple(r) for r in relations.topic_tree(weights).orderBy("step").collect()]
    parent = list(range(60))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    merges = []
    for d, a, b in sorted((round(1 - v, 9), a, b) for (a, b), v in want.items() if a >= 0):
        if root(a) != root(b):
            parent[root(a)] = root(b)
            merges.append((a, b, d))
    assert [t[1:3] for t in tree] == [m[:2] for m in merges] and all(abs(t[3] - m[2]) < 2e-9 for t, m in zip(tree, merges))
    leaves = spark.createDataFrame([(t, t + 1, f"name{t}") for t in range(51)], "topic_id int, size long, label string")
    nodes = relations.dendrogram(relations.topic_tree(weights), leaves).collect()
    inside = {t: {t} for t in range(51)}
    for r, (_, a, b, _) in zip(sorted(nodes, key=lambda r: r["node"]), tree):
        assert a in inside[r["left"]] | inside[r["right"]] and b in inside[r["left"]] | inside[r["right"]] and r["left"] < r["right"]
        inside[r["node"]] = inside.pop(r["left"]) | inside.pop(r["right"])
        assert r["size"] == sum(t + 1 for t in inside[r["node"]]) and r["topic_id"] == min(inside[r["node"]]) and r["label"] == f"name{r['topic_id']}"
    assert len(nodes) == 50 and [r["node"] for r in sorted(nodes, key=lambda r: r["node"])] == list(range(51, 101))


def test_twelve_thousand_topics_have_a_tree(spark):
    from review_topics.operators import relations

    rng = np.random.default_rng(1)
    rows = [(t, f"w{w}", 1, 1, float(x)) for t in range(12_000) for w, x in zip(rng.integers(0, 3000, 4), rng.random(4))]
    weights = spark.createDataFrame(list({r[:2]: r for r in rows}.values()), "topic_id int, term string, tf long, doc_freq long, weight double")
    tree = relations.topic_tree(weights).collect()
    assert len(tree) == 11_999 and all(0 <= r["distance"] <= 1 for r in tree)
    merged = topics.merge_map(spark.createDataFrame(tree, "step int, left int, right int, distance double"), spark.range(12_000).select(F.col("id").cast("int").alias("topic_id")), 40)
    assert merged.select("merged_id").distinct().count() == 40


def test_changes_give_the_counts_of_a_recount(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(12)}x" for _ in range(rng.randint(1, 9)))) for i in range(60)], "doc_id long, document string")
    lists = embedding.term_lists(docs)
    before = spark.createDataFrame([(i, rng.randrange(-1, 4)) for i in range(55)], "doc_id long, topic_id int")
    after = spark.createDataFrame([(i, r[1] if i % 3 else rng.randrange(-1, 5)) for i, r in enumerate(before.collect())][3:] + [(58, 7)], "doc_id long, topic_id int")
    got = terms.moved_terms(terms.topic_terms(lists, before), lists, before, after)
    columns = ["topic_id", "term", "tf", "doc_freq"]
    assert sorted(got.select(columns).collect()) == sorted(terms.topic_terms(lists, after).select(columns).collect())


def test_wide_vectors_are_reduced_to_their_axes(spark):
    rng = np.random.default_rng(4)
    axes = np.linalg.qr(rng.normal(size=(8192, 3)))[0]
    x = rng.normal(size=(200, 3)) * [9, 4, 2] @ axes.T + 0.002 * rng.normal(size=(200, 8192)) + 0.3
    vecs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, vec array<double>").repartition(6)
    low = {r["doc_id"]: r["low"] for r in reduction.reduce_dims(vecs, 3).collect()}
    got = np.array([low[i] for i in range(200)])
    _, sizes, exact = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = x @ exact[:3].T
    assert np.allclose(got.var(0), want.var(0), rtol=1e-3)
    apart = lambda m: np.linalg.norm(m[:, None] - m[None], axis=2)
    assert np.allclose(apart(got), apart(want), atol=0.05)


def test_axes_of_a_flat_spectrum_capture_nearly_as_much(spark):
    x = np.random.default_rng(6).normal(size=(500, 60)) * np.linspace(2, 1, 60)
    vecs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, vec array<double>")
    axes = reduction.principal_axes(vecs, 5)
    assert np.allclose(axes.T @ axes, np.eye(5))
    centred = x - x.mean(0)
    sizes = np.linalg.svd(centred, compute_uv=False)
    assert ((centred @ axes) ** 2).sum() > 0.97 * (sizes[:5] ** 2).sum()


def test_words_are_counted_in_small_slices_of_a_batch(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, document string")
    caught = {}

    class Caught:
        def mapInArrow(self, run, schema):
            caught["run"] = run
            return self

        def where(self, condition):
            return self

        def select(self, *columns):
            return self

    monkeypatch.setattr(embedding, "_tokens", lambda _: Caught())
    rng = random.Random(3)
    lists = [None, [], ["long"] * (3 << 17)] + [[f"w{rng.randrange(999)}" for _ in range(rng.randrange(90))] for _ in range(6_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(lists)), pa.int64()), "tokens": pa.array(lists, pa.list_(pa.string()))})
    for start in (embedding.term_lists, ENCODER.terms_and_vectors):
        start(docs)
        out = list(caught["run"](iter([batch])))
        words = [sum(len(lists[i] or []) for i in part.column("doc_id").to_pylist()) for part in out]
        assert all(part.num_rows == 1 or (part.num_rows <= 512 and n <= 2 << 16) or 3 << 17 <= n for part, n in zip(out, words)) and len(out) > 5
        rows = [row for part in out for row in part.to_pylist()]
        assert [row["doc_id"] for row in rows] == list(range(len(lists)))
        assert all({x["term"]: x["tf"] for x in row["terms"] or []} == Counter(words or []) for row, words in zip(rows, lists))


def test_long_documents_reach_python_in_rows_of_few_words(spark):
    rng = random.Random(4)
    lengths = [0, 1, 63, 64, 65, 128, 5_000, 3, 20_000, 0, *(rng.randrange(900) for _ in range(60)), 9_000]
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(n)) for n in lengths]
    rows = [(i // 2 if i % 3 else None, text) for i, text in enumerate(texts)] + [(7, None), (None, None)]  # ids repeat or are null
    docs = spark.createDataFrame(rows, "doc_id long, document string").coalesce(1)
    seen = [len(row["tokens"] or []) for row in embedding._tokens(docs).select("tokens").collect()]
    assert max(seen) == embedding.ROW_WORDS
    want = [(i, Counter((text or "").split())) for i, text in rows]
    for size in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            both = ENCODER.terms_and_vectors(docs).collect()
            lists = embedding.term_lists(docs).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert [(r["doc_id"], {x["term"]: x["tf"] for x in r["terms"]}) for r in both] == want
        assert [r["vec"] is None for r in both] == [not words for _, words in want]
        assert [(r["doc_id"], {x["term"]: x["tf"] for x in r["terms"]}) for r in lists] == [x for x in want if x[1]]


def test_windows_score_the_same_by_table_and_by_postings(monkeypatch):
    rng = np.random.default_rng(5)
    edges = np.cumsum([0, 0, 1, 2, 3, 4, 5, 400, 2_000])
    tokens = rng.integers(0, 60, edges[-1])
    held = rng.random((60, 7)) < 0.4
    starts = np.concatenate(([0], np.cumsum(held.sum(1))))
    weights = rng.random(starts[-1])
    arguments = (tokens, edges, starts, np.nonzero(held)[1], weights, 4, 1, 0.4)

    def scores():
        return [np.concatenate(column).tolist() for column in zip(*distribution._window_scores(*arguments))]

    assert distribution._table(starts, np.nonzero(held)[1], weights, 7) is not None
    by_table = scores()
    monkeypatch.setattr(distribution, "TABLE", 0)
    assert by_table == scores() and len(by_table[0]) > 100
