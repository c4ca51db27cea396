import json

import pytest

from review_topics import fixed_values as V
from review_topics.operators import lexicon, responses

OBJECT = '{"intent":"a","text_summary":"b","sentiment":"Positive","named_entities":["X"]}'
REPLIES = [
    '{"intents":[%s]}' % OBJECT,
    '  {"intents":[%s]}  ' % OBJECT,
    '{"intents":[%s]} trailing' % OBJECT,
    '{"intents":[%s]}{"intents":[]}' % OBJECT,
    '{"intents":[%s]},{"intents":[]}' % OBJECT,
    "{'intents':[]}",
    '{"intents":[%s' % OBJECT,
    '```json{"intents":[%s]}```' % OBJECT,
    '{"intents":["x",%s,7,null,[1]]}' % OBJECT,
    '{"intents":{"intent":"a"}}',
    '{"intents":[]}',
    '{"intents":null}',
    '{"other":1}',
    "[1,2]",
    "5",
    "null",
    '"text"',
    "",
    "{}",
    '{"intents":[%s],}' % OBJECT,
    '{"intents":[{"intent":5,"text_summary":"b","sentiment":"Positive"}]}',
    '{"w":1}],"x":[{"intents":[]}',
    None,
]


def expected_objects(reply):
    """Intent objects of a reply as Python's own parser sees them."""
    try:
        value = json.loads(reply)
    except (json.JSONDecodeError, TypeError):
        return []
    intents = value.get("intents") if isinstance(value, dict) else None
    return [x for x in intents if isinstance(x, dict)] if isinstance(intents, list) else []


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame(list(enumerate(REPLIES)), "id long, payload string")
    return responses.validate_intents(responses.parse_responses(df)).collect()


def test_strict_parse_agrees_with_python(parsed):
    for i, reply in enumerate(REPLIES):
        ours = [json.loads(r["llm_response"]) for r in parsed if r["id"] == i and r["parse_status"] == "ok"]
        assert ours == expected_objects(reply), reply


def test_every_reply_has_a_row_and_a_reason(parsed):
    assert {r["id"] for r in parsed} == set(range(len(REPLIES)))
    assert all((r["reject_reason"] is None) <= (r["parse_status"] == "ok") for r in parsed)
    reasons = {r["id"]: r["reject_reason"] for r in parsed}
    assert reasons[20] == "intent_not_a_string" and reasons[22] == "no_reply" and reasons[9] == "intents_not_a_list"


def test_duplicate_keys_and_nan_are_refused(spark):
    df = spark.createDataFrame([(1, '{"intents":[],"intents":[]}'), (2, '{"intents":[NaN]}')], "id long, payload string")
    assert {r["parse_status"] for r in responses.parse_responses(df).collect()} == {"invalid_json"}


def test_na_drop_matrix(spark):
    rows = [(1, "a", "b", "Positive", ["x"]), (2, "a", "b", "Positive", []), (3, "a", "b", "Positive", [None]), (4, "a", "b", "Positive", None), (5, None, "b", "Positive", [])]
    df = spark.createDataFrame(rows, "id long, intent string, text_summary string, sentiment string, named_entities array<string>")
    assert {r["id"] for r in responses.na_drop(df).collect()} == {1, 2, 3}
    assert {r["id"] for r in responses.na_drop(df, "required").collect()} == {1, 2, 3, 4}


def test_payload_choice(spark):
    rows = [(1, ["a"], None), (2, ["a", "b"], "c"), (3, [], "plain"), (4, None, "plain"), (5, [], None)]
    df = spark.createDataFrame(rows, "id long, tool_args array<string>, content string")
    got = {(r["id"], r["call"], r["payload"]) for r in responses.response_payload(df).collect()}
    assert got == {(1, 0, "a"), (2, 0, "a"), (2, 1, "b"), (3, 0, "plain"), (4, 0, "plain"), (5, 0, None)}


def test_golden_example_parses_to_its_five_intents(spark):
    df = spark.createDataFrame([(1, json.dumps(V.EXAMPLE_OUTPUT))], "id long, payload string")
    rows = responses.validate_intents(responses.parse_responses(df)).orderBy("intent_pos").collect()
    got = [{k: r[k] for k in ("intent", "text_summary", "sentiment", "named_entities")} for r in rows]
    assert got == V.EXAMPLE_OUTPUT["intents"] and all(r["reject_reason"] is None for r in rows)


def test_right_and_inner_attach_agree(spark):
    reviews = spark.createDataFrame([(i, f"r{i}") for i in range(5)], "id long, Review string")
    intents = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "id long, intent string")
    assert responses.attach_reviews(intents, reviews).count() == reviews.join(intents, "id").count() == 3


def test_lexicon_on_the_golden_review(spark):
    df = spark.createDataFrame([(1, V.EXAMPLE_REVIEW)], "id long, Review string")
    rows = lexicon.extract_intents_lexicon(df)
    got = {(r["intent"], r["sentiment"]) for r in rows.collect()}
    assert ("Flight Attendants and Crew Services", "Positive") in got and ("Baggage Handling", "Neutral") in got
    replies = lexicon.intents_as_replies(rows)
    back = responses.validate_intents(responses.parse_responses(replies)).collect()
    assert len(back) == rows.count() and all(r["reject_reason"] is None for r in back)
