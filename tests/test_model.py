import json

import pytest
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.operators import relations, represent, topics
from review_topics.operators import embedding
from review_topics.plans import fit, label, predict
from review_topics.plans.model import FitParams
from review_topics.queries import common as C
from review_topics.queries import topic_queries as Q
from review_topics.session import scratch_path
from review_topics.sources import model_store, tables, vector_store
from review_topics.streaming.predict_stream import predict_stream


@pytest.fixture(scope="module")
def docs(spark, sf):
    return C.documents(spark, sf)


@pytest.fixture(scope="module")
def model(spark, sf):
    return Q.fitted(spark, sf)


@pytest.fixture(scope="module")
def predicted(model, docs):
    return {r["doc_id"]: (r["topic_id"], round(r["probability"], 6)) for r in predict.predict(model, docs, C.ENCODER).collect()}


def test_every_document_has_one_assignment(model, docs):
    rows = model.assignments.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == docs.count()
    assert all(0 <= r["probability"] <= 1.000001 for r in rows)
    assert sum(r["size"] for r in model.topics.collect()) == len(rows)
    assert {r["kind"] for r in model.topics.collect()} >= {"predefined"}


def test_predicting_the_training_documents_repeats_the_zero_shot_rows(model, predicted):
    fixed = {r["topic_id"] for r in model.topics.collect() if r["kind"] == "predefined"}
    rows = [r for r in model.assignments.collect() if r["topic_id"] in fixed]
    assert rows and all(predicted[r["doc_id"]] == (r["topic_id"], round(r["probability"], 6)) for r in rows)


def test_saved_model_predicts_the_same(spark, model, docs, predicted):
    path = scratch_path(spark, "model")
    model_store.save_model(model, path)
    loaded = model_store.load_model(spark, path)
    assert loaded.params == model.params and loaded.encoder_id == model.encoder_id
    again = predict.predict(loaded, docs, C.ENCODER).collect()
    assert {r["doc_id"]: (r["topic_id"], round(r["probability"], 6)) for r in again} == predicted


def test_stream_gives_the_batch_predictions(spark, model, docs, predicted):
    source, target = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    docs.select("doc_id", "document").repartition(3).write.parquet(source)
    stream = spark.readStream.schema("doc_id long, document string").option("maxFilesPerTrigger", 1).parquet(source)
    query = predict_stream(model, stream, C.ENCODER, target, scratch_path(spark, "checkpoint"))
    query.awaitTermination()
    rows = spark.read.parquet(target).collect()
    assert {r["doc_id"]: (r["topic_id"], round(r["probability"], 6)) for r in rows} == predicted
    assert len({r["batch_id"] for r in rows}) == 3


def test_two_streams_into_one_target_keep_all_rows(spark, model, docs):
    target = scratch_path(spark, "stream-out")
    for name, condition in (("a", "doc_id < 60"), ("b", "doc_id >= 60 and doc_id < 100")):
        source, checkpoint = scratch_path(spark, name), scratch_path(spark, f"checkpoint-{name}")
        docs.select("doc_id", "document").where(condition).write.parquet(source)
        stream = spark.readStream.schema("doc_id long, document string").parquet(source)
        for _ in range(2):  # started again, a stream has nothing left to do
            predict_stream(model, stream, C.ENCODER, target, checkpoint).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(target).collect()) == list(range(100))


def test_predictions_come_with_words(model, docs, predicted):
    rows = predict.predict_with_words(model, docs, C.ENCODER, 3).collect()
    words = {r["topic_id"]: r["words"] for r in represent.topic_words(model.terms.where("aspect = 'Main' and rank <= 3")).collect()}
    assert {r["doc_id"]: r["topic_id"] for r in rows} == {d: t for d, (t, _) in predicted.items()}
    assert all(r["words"] == (words[r["topic_id"]] if r["topic_id"] >= 0 else None) for r in rows)


def test_largest_topics_carry_their_labels(model):
    rows = relations.top_topics(model.assignments, model.terms, 2, 3, model.labels).collect()
    names = {r["topic_id"]: r["label"] for r in model.labels.collect()}
    assert rows and all(r["label"] == names[r["topic_id"]] for r in rows)


def test_changed_texts_are_described(model, docs):
    other = docs.withColumn("document", F.concat(F.lit("zebra stripes "), F.col("document")))
    updated = fit.update_topics(model, other, C.ENCODER, model.assignments)
    assert updated.ctfidf.where("term = 'zebra'").count() > 0 and model.ctfidf.where("term = 'zebra'").count() == 0


def test_outliers_shrink_and_representations_follow(model, docs):
    new = fit.reduce_outliers(model, docs)
    before = {r["doc_id"]: r["topic_id"] for r in model.assignments.collect()}
    after = {r["doc_id"]: r["topic_id"] for r in new.collect()}
    assert before.keys() == after.keys()
    assert all(after[d] == t for d, t in before.items() if t != -1)
    assert sum(t == -1 for t in after.values()) < sum(t == -1 for t in before.values())
    updated = fit.update_topics(model, docs, C.ENCODER, new)
    assert sum(r["size"] for r in updated.topics.collect()) == len(after)
    names = {r["topic_id"]: r["label"] for r in model.labels.collect()}
    fixed = [r["topic_id"] for r in model.topics.collect() if r["kind"] == "predefined"]
    assert all(r["label"] == names[r["topic_id"]] for r in updated.labels.collect() if r["topic_id"] in fixed)


def test_aspects_are_kept_by_an_update(spark, sf, model, docs):
    texts = model.representative.select("topic_id", "rank", "document")

    def label(table):
        return represent.llm_labels(represent.label_prompts(table, texts), C.HashProvider(), backoff=None)

    aspects = {"MMR": [lambda t: represent.mmr(t, C.ENCODER)], "AI_Generated": [lambda t: represent.mmr(t, C.ENCODER), label]}
    described = fit.update_topics(model, docs, C.ENCODER, model.assignments, aspects)
    again = fit.update_topics(described, docs, C.ENCODER, model.assignments)
    for stage in (described, again):
        assert {r["aspect"] for r in stage.terms.select("aspect").distinct().collect()} == {"Main", "MMR", "AI_Generated"}


def test_topics_are_merged_to_the_wanted_number(model, docs):
    before = {r["topic_id"] for r in model.topics.collect() if r["topic_id"] >= 0}
    merged = fit.reduce_topics(model, docs, C.ENCODER, 2)
    rows = merged.topics.collect()
    left = {r["topic_id"] for r in rows if r["topic_id"] >= 0}
    assert len(before) > 2 and len(left) == 2 and left <= before and sum(r["size"] for r in rows) == docs.count()
    assert {r["topic_id"] for r in merged.centroids.collect()} - {-1} == left
    outliers = lambda m: {r["doc_id"] for r in m.assignments.where("topic_id = -1").collect()}
    assert outliers(merged) == outliers(model)
    assert {r["topic_id"] for r in predict.predict(merged, docs, C.ENCODER).collect()} <= left | {-1}


def test_intents_become_the_labelled_table(spark):
    subjects = {"Seating comfort": "the seat was cramped row", "Food quality": "the meal was cold food", "Baggage issue": "my bag was lost baggage"}
    rows = [(i, "Air", "5", "t", "r", "{}", name, f"{text} {i % 4}{'x' * (i % 3)} case", "Negative", ["A"]) for i, (name, text) in enumerate(list(subjects.items()) * 20)]
    rows += [rows[0]] * 30 + [(99, "Air", "5", "t", "r", "{}", None, "no intent", "Neutral", [])]
    names = "id long, Airline_Name string, Overall_Rating string, Review_Title string, Review string, llm_response string, intent string, text_summary string, sentiment string, named_entities array<string>"
    labels = embedding.label_table(spark, ["seat cramped row seating comfort", "meal cold food quality"])
    params = FitParams(min_similarity=0.3, min_topic_size=5, min_pts=3, components=2, clusters="flat", width=0.3)
    labelled, model, rejects = label.label_intents(spark.createDataFrame(rows, names), C.ENCODER, C.HashProvider(plain=True), labels, params, backoff=None)
    out = labelled.collect()
    assert [(r["id"], r["reason"]) for r in rejects.collect()] == [(99, "null_intent")]
    assert len(out) == 90 and labelled.columns == ["topic_id", "probability", "topic_name", "llm_topic_name", "document"]
    by_name = {r["document"].split(":")[0]: set() for r in out}
    for r in out:
        by_name[r["document"].split(":")[0]].add((r["topic_id"], r["topic_name"]))
    assert by_name["Seating comfort"] == {(0, "seat cramped row seating comfort")}
    assert by_name["Food quality"] == {(1, "meal cold food quality")}
    assert {t for t, _ in by_name["Baggage issue"]} == {2}
    assert all(r["llm_topic_name"] for r in out)
    assert {r["aspect"] for r in model.terms.select("aspect").distinct().collect()} == {"Main", "AI_Generated", "KeyBERT"}


def test_labels_table_is_written_once(spark, model, docs):
    names = model.labels
    rows = topics.labelled_result(model.assignments, docs, names, names)
    path = scratch_path(spark, "labelled")
    tables.write_labels(rows, path)
    assert spark.read.parquet(path).columns == ["topic_id", "probability", "topic_name", "llm_topic_name", "document"]
    assert spark.read.parquet(path).count() == docs.count()
    with pytest.raises(Exception, match="(?i)already exists"):
        tables.write_labels(rows, path)


def test_catalog_tables_round_trip(spark):
    rows = spark.createDataFrame([(1, "A", "5", "t", "r", json.dumps({}), "i", "s", "Positive", ["x"])], "id long, Airline_Name string, Overall_Rating string, Review_Title string, Review string, llm_response string, intent string, text_summary string, sentiment string, named_entities array<string>")
    spark.sql("create database if not exists review_topics_tests")
    name = "spark_catalog.review_topics_tests.intents"
    tables.write_intents(rows, name)
    tables.write_intents(rows, name)
    assert tables.read_intents(spark, name).collect() == rows.collect()
    spark.sql("drop database review_topics_tests cascade")


def test_reviews_are_read_by_their_source_names(spark):
    path = scratch_path(spark, "reviews")
    spark.createDataFrame([(1, "XYZ", "text", 9)], ["id", "Airline Name", "Review", "unused"]).write.json(path)
    spark.read.json(path).write.parquet(path + "-parquet")
    assert tables.read_reviews(spark, path + "-parquet").columns == ["id", "Airline_Name", "Review"]


def test_vectors_round_trip_as_floats(spark):
    path = scratch_path(spark, "vecs")
    vecs = spark.createDataFrame([(1, [0.5, 0.25])], "doc_id long, vec array<double>")
    vector_store.save_vectors(vecs, path, "a")
    vector_store.save_vectors(vecs.withColumn("doc_id", F.lit(2)), path, "b")
    vector_store.save_vectors(vecs.unionByName(vecs.withColumn("doc_id", F.lit(3).cast("long"))), path, "a")
    assert sorted(r["doc_id"] for r in vector_store.load_vectors(spark, path, "a").collect()) == [1, 3]
    docs = spark.range(1, 4).withColumnRenamed("id", "doc_id")
    assert {r["doc_id"] for r in vector_store.missing_vectors(docs, vector_store.load_vectors(spark, path, "b")).collect()} == {1, 3}


def test_probe_sentences_are_scored(spark, model):
    probes = spark.createDataFrame([(1, V.PROBE_IN_DOMAIN), (2, V.PROBE_OUT_OF_DOMAIN)], "doc_id long, document string")
    assert predict.predict(model, probes, C.ENCODER).count() == 2
