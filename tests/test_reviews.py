import json
from collections import Counter

from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.operators import prompts, reviews
from review_topics.operators import reviews as R


def test_row_ids_are_unique_among_copies(spark, monkeypatch):
    monkeypatch.setattr(R, "COPIES_PER_TASK", 7)
    rows = [("same", 1)] * 50 + [("other", 2), ("other", 3)] + [(None, 4)] * 3
    df = spark.createDataFrame(rows, "text string, n int")
    out = R.with_row_id(df).collect()
    assert len({r["row_id"] for r in out}) == len(rows) == len(out)
    assert Counter((r["text"], r["n"]) for r in out) == Counter(rows)


def test_row_id_keeps_the_source_key(spark):
    df = spark.createDataFrame([(7, "a")], "k long, text string")
    assert R.with_row_id(df, "k").first()["row_id"] == "7"


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = {r["k"] for r in reviews.sample_n(df, 100, "k", 1).collect()}
    again = {r["k"] for r in reviews.sample_n(df.repartition(13), 100, "k", 1).collect()}
    other = {r["k"] for r in reviews.sample_n(df, 100, "k", 2).collect()}
    assert len(one) == 100 and one == again and one != other


def test_chunks_cover_the_whole_review(spark):
    words = [f"w{i}" for i in range(95)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "short one"), (3, "")], "id long, Review string")
    rows = reviews.chunk_reviews(df, 20, 5).orderBy("id", "chunk").collect()
    long = [r["chunk_text"].split() for r in rows if r["id"] == 1]
    assert long[0] == words[:20] and long[1] == words[15:35]
    assert long[-1][-1] == "w94" and {w for c in long for w in c} == set(words)
    assert [r["chunk_text"] for r in rows if r["id"] == 2] == ["short one"]
    assert [r["chunk_text"] for r in rows if r["id"] == 3] == [""]


def test_prefilter_reasons(spark):
    df = spark.createDataFrame([(1, None), (2, "   "), (3, "ab"), (4, "x" * 50), (5, "fine text")], "id long, Review string")
    rows = {r["id"]: r["reject_reason"] for r in reviews.prefilter_reviews(df, 5, 20).collect()}
    assert rows == {1: "missing", 2: "empty", 3: "too_short", 4: "too_long", 5: None}


def test_prompt_survives_markup_in_reviews(spark):
    nasty = ["100% $1 {review} {x} \\d %s", V.EXAMPLE_REVIEW, "line\nbreak \"quoted\""]
    df = spark.createDataFrame(list(enumerate(nasty)), "id long, Review string")
    rows = {r["id"]: r["prompt"] for r in prompts.render_prompt(df).collect()}
    filled = V.EXTRACTION_PROMPT.replace("{format_instructions}", json.dumps(V.FORMAT_INSTRUCTIONS))
    filled = filled.replace("{example_output}", json.dumps(V.EXAMPLE_OUTPUT))
    head, tail = filled.split("{review}")
    assert rows == {i: head + text + tail for i, text in enumerate(nasty)}


def test_chat_request_is_json(spark):
    df = spark.createDataFrame([(1, 'say "hi"\n')], "id long, prompt string")
    row = prompts.chat_request(df, "m", tools=V.TOOLS).first()
    body = json.loads(row["request"])
    assert body["messages"][1] == {"role": "user", "content": 'say "hi"\n'}
    assert body["tools"] == V.TOOLS and body["max_tokens"] == 500 and body["temperature"] == 0.1


def test_null_document_part_gives_null(spark):
    from review_topics.functions.text import doc_text

    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "i string, s string")
    assert [r[0] for r in df.select(doc_text(F.col("i"), F.col("s"))).collect()] == ["a: b", None, None]
