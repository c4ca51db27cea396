"""The pipeline against the stages' own rules."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from review_topics.llm import decontaminate, words
from review_topics.session import scratch_path, stage


def stage_named(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(6)
    english = "the of and to in is that it was for on are with as his they be at one have this from".split()
    german = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split()
    prose = lambda v, n: " ".join(rng.choice(v) + rng.choice(["", "en", "ing", "er", "ung"]) for _ in range(n))
    rows = [(i, prose(english if i % 3 else german, 60), "en" if i % 3 else "de", "s", 0) for i in range(60)]
    passage = prose(english, 25)
    rows += [
        (100, rows[1][1], "en", "s", 0), (101, rows[1][1].replace(rows[1][1].split()[30], "zzz", 1), "en", "s", 0),
        (102, f"{prose(english, 30)} {passage} {prose(english, 9)}", "en", "s", 0),
        (103, f"{prose(english, 30)} mail me@here.example.org {prose(english, 9)}", "en", "s", 0),
        (104, "12 34 !!", "en", "s", 0), (105, "", "en", "s", 0), (106, None, "en", "s", 0), (None, prose(english, 40), None, "s", None),
    ]
    path = scratch_path(spark, "documents")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, passage), (1, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_decides_on_its_own_input(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    seen = ids(docs)
    for name, gone in (("language_id", {104, 105, 106}), ("ngram_jaccard_join", {100, 101}), ("benchmark_decontamination", {102}), ("personal_data", set())):
        docs = stage(stage_named(name)(spark, docs, folder), name)
        assert docs.columns == columns and seen - ids(docs) == gone, name
        seen = ids(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "[EMAIL]" in texts[103] and "me@here" not in texts[103]
    pieces = stage_named("best_fit_packing")(spark, docs, folder).collect()
    assert {r["doc_id"] for r in pieces} == seen and all(len(r["ids"]) == r["length"] for r in pieces)
    whole = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in whole.collect()} == seen


def test_columns_of_the_operators_names_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("score", F.lit("own")).withColumn("hash", F.lit(3)).withColumn("set_key", F.lit("k"))
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, folder), name)
    assert {(r["score"], r["hash"], r["set_key"]) for r in docs.collect()} == {("own", 3, "k")}


def test_nothing_goes_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, folder), name)
    assert docs.count() == 0


def test_planted_passages_and_copies_leave_the_test_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = stage(stage_named("benchmark_decontamination")(spark, stage_named("ngram_jaccard_join")(spark, docs, sf), sf), "left")
    assert decontaminate.contaminated(left, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    assert left.groupBy(F.md5("text")).count().where("count > 1").count() == 0
    assert words.SLICE_BYTES > 0 and left.count() > 100


def test_repeated_rows_and_rows_without_doc_id_are_examined(spark, tmp_path):
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    same, passage, other, clean = prose(40), prose(25), prose(40), prose(40)
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, same), (1, same), (2, same), (None, same), (None, other), (None, other), (1, clean), (None, None), (None, "")], "doc_id long, text string")
    left = stage_named("ngram_jaccard_join")(spark, docs, str(tmp_path)).collect()
    assert sorted(left, key=str) == sorted([(1, same), (None, other), (1, clean), (None, None), (None, "")], key=str)
    docs = spark.createDataFrame([(None, f"{other} {passage}"), (5, f"{passage} {same}"), (5, clean), (None, clean), (None, None)], "doc_id long, text string")
    left = stage_named("benchmark_decontamination")(spark, docs, str(tmp_path)).collect()
    assert sorted(left, key=str) == sorted([(5, clean), (None, clean), (None, None)], key=str)
