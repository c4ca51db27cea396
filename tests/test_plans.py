"""The physical plans are the intended ones."""

import io
from contextlib import redirect_stdout

import pytest

from review_topics.operators import embedding, reviews, terms, zeroshot
from review_topics.queries import common as C
from review_topics.queries import review_queries, topic_queries
from review_topics.sources import tables


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_scan_reads_only_the_mapped_columns(spark, sf):
    text = plan(tables.read_reviews(spark, f"{sf}/documents.parquet", {"doc_id": "id", "lang": "Review_Title"}).where("id > 5"))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in text and "GreaterThan(doc_id,5)" in text


def test_sample_is_a_top_k(spark, sf):
    assert "TakeOrderedAndProject" in plan(reviews.sample_n(C.reviews(spark, sf), 10, "id", 1))


def test_zero_shot_is_narrow(spark, sf):
    text = plan(zeroshot.assign_zero_shot(C.centred_vectors(spark, sf), C.prototypes(spark, sf), 0.4))
    assert "Exchange" not in text and "Join" not in text


def test_text_work_is_narrow(spark, sf):
    for name in ("b4_chunk", "b5_render_prompt", "b8_parse_responses", "b11_validate", "b16_truncate_tokens", "d4_extract_lexicon"):
        assert "Exchange" not in plan(getattr(review_queries, name)(spark, sf)), name


def test_ranking_keeps_the_best_before_the_shuffle(spark, sf):
    text = plan(terms.top_terms(C.source_weights(spark, sf), 10))
    assert text.index("WindowGroupLimit") < text.index("Exchange") or text.count("WindowGroupLimit") >= 2


def test_terms_and_vectors_move_nothing(spark, sf):
    for rows in (C.ENCODER.terms_and_vectors(C.documents(spark, sf)), embedding.embed(C.documents(spark, sf), C.ENCODER), embedding.term_lists(C.documents(spark, sf))):
        assert "Exchange" not in plan(rows)


LAZY = [
    "c2_attach_reviews", "c3_zip_responses", "c4_label_documents", "c5_labelled_result", "c9_unite_assignments", "d6_embed", "e4_neighbour_graph",
    "e8_assignment_probability", "f1_term_counts", "f2_ctfidf", "f4_keybert_terms", "f5_representative_docs", "f8_topic_info", "g2_top_topics",
    "g3_topic_similarity", "h1_distribution", "h2_token_distribution", "e11_reduce_outliers", "e13_predict",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, sf, name):
    module = topic_queries if hasattr(topic_queries, name) else review_queries
    text = plan(getattr(module, name)(spark, sf))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_temporary_stages_go_and_kept_ones_stay(spark):
    from review_topics.session import path_exists, stage, temporary_stages

    with temporary_stages(spark) as outer:
        with temporary_stages(spark) as keep:
            gone, kept = stage(spark.range(3), "a"), keep(stage(spark.range(4), "b"))
        assert not path_exists(spark, gone._staged_at) and kept.count() == 4
        last = outer(stage(kept, "c"))
    assert not path_exists(spark, kept._staged_at) and last.count() == 4
    assert path_exists(spark, stage(spark.range(1), "d")._staged_at)
