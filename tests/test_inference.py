import json
import os
import sys
import time

from pyspark import cloudpickle
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.operators import inference, reviews
from review_topics.plans.extract import extract_intents
from review_topics.session import scratch_path


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Flaky:
    """Fails by id: 0 always limited, 1 limited once, 2 limited twice, 3 error, else fine. Notes each call in a file."""

    def __init__(self, folder):
        self.folder = folder

    def complete(self, request_id, request, attempt):
        with open(os.path.join(self.folder, f"{request_id}-{attempt}-{os.urandom(4).hex()}"), "w"):
            pass
        kind = request_id % 5
        if kind == 0 or (kind in (1, 2) and attempt <= kind):
            raise inference.RateLimited()
        if kind == 3:
            raise ValueError("no")
        return [json.dumps({"intents": []})], None


def calls(folder):
    return sorted(tuple(int(x) for x in name.split("-")[:2]) for name in os.listdir(folder))


def requests(spark, n):
    return spark.range(n).withColumn("request", F.lit("ask"))


def expected(n):
    last = {0: 3, 1: 2, 2: 3, 3: 1, 4: 1}
    return sorted((i, a) for i in range(n) for a in range(1, last[i % 5] + 1))


def test_retries_stop_at_three_and_never_repeat_a_success(spark, tmp_path):
    ledger = inference.infer_with_retries(requests(spark, 25), Flaky(str(tmp_path)), backoff=None)
    assert sorted((r["id"], r["attempt"]) for r in ledger.collect()) == expected(25)
    assert calls(tmp_path) == expected(25)
    last = {r["id"]: r["status"] for r in inference.latest_replies(ledger).collect()}
    assert {i: last[i] for i in range(5)} == {0: "rate_limited", 1: "ok", 2: "ok", 3: "error", 4: "ok"}


def test_a_second_run_on_the_same_ledger_calls_nothing(spark, tmp_path):
    ledger = scratch_path(spark, "ledger")
    inference.infer_with_retries(requests(spark, 10), Flaky(str(tmp_path)), ledger, backoff=None, slice_rows=4)
    before = calls(tmp_path)
    inference.infer_with_retries(requests(spark, 15), Flaky(str(tmp_path)), ledger, backoff=None)
    assert before == expected(10) and calls(tmp_path) == expected(15)


class Overlapping:
    """Notes when each call began and ended."""

    def __init__(self, folder):
        self.folder = folder

    def complete(self, request_id, request, attempt):
        began = time.time()
        time.sleep(0.01)
        with open(os.path.join(self.folder, f"{os.urandom(8).hex()}"), "w") as f:
            f.write(f"{began} {time.time()} {os.getpid()}")
        return ["{}"], None


def test_calls_in_flight_stay_bounded_while_slices_grow(spark, tmp_path):
    ledger = scratch_path(spark, "ledger")
    out = inference.infer_with_retries(requests(spark, 300), Overlapping(str(tmp_path)), ledger, max_in_flight=4, backoff=None, slice_rows=50, calls_per_task=2)
    assert out.count() == 300
    spans = [tuple(map(float, open(os.path.join(tmp_path, name)).read().split()[:2])) for name in os.listdir(tmp_path)]
    assert len(spans) == 300
    most = max(sum(a <= begin < b for a, b in spans) for begin, _ in spans)
    assert 1 < most <= 4
    with_replies = [name for name in os.listdir(ledger.removeprefix("file://")) if name.startswith("round=")]
    assert len(with_replies) >= 6


def test_windows_halve_and_grow():
    assert [inference.next_window(8, 100, n, 8) for n in (0, 10, 11, 100)] == [8, 8, 4, 4]
    assert inference.next_window(1, 5, 5, 8) == 1 and inference.next_window(3, 5, 0, 8, 2) == 5 and inference.next_window(7, 5, 0, 8, 2) == 8
    assert inference.next_window(4, 0, 0, 8) == 5


class Falling:
    """Takes as many calls at a time as a file says, lowers that to 2 after 40 calls, and notes how many it saw at once."""

    def __init__(self, folder):
        self.folder = folder

    def complete(self, request_id, request, attempt):
        own = os.path.join(self.folder, f"open-{os.urandom(8).hex()}")
        open(own, "w").close()
        names = os.listdir(self.folder)
        at_once = sum(n.startswith("open-") for n in names)
        open(os.path.join(self.folder, f"seen-{at_once}-{os.urandom(8).hex()}"), "w").close()
        time.sleep(0.02)
        os.remove(own)
        if at_once > (8 if sum(n.startswith("seen-") for n in names) < 40 else 2):
            raise inference.RateLimited()
        return ["{}"], None


def test_calls_follow_a_falling_limit(spark, tmp_path, monkeypatch):
    windows = []
    infer = inference.infer
    monkeypatch.setattr(inference, "infer", lambda due, provider, attempt, most, *rest: windows.append(most) or infer(due, provider, attempt, most, *rest))
    out = inference.infer_with_retries(requests(spark, 200), Falling(str(tmp_path)), attempts=4, max_in_flight=8, backoff=None, slice_rows=25)
    seen = [int(n.split("-")[1]) for n in os.listdir(tmp_path) if n.startswith("seen-")]
    assert max(seen) <= 8 and max(windows) == windows[0] == 8 and min(windows) <= 2
    last = [r["status"] for r in inference.latest_replies(out).collect()]
    assert len(last) == 200 and last.count("ok") > 150


def test_later_attempts_wait_once_a_task(spark, tmp_path):
    began = time.time()
    inference.infer(requests(spark, 60), Flaky(str(tmp_path)), attempt=2, max_in_flight=3, backoff=(0.5, 0.6)).collect()
    assert time.time() - began < 10


def test_generated_row_ids_reach_the_intents(spark):
    rows = [("Air", "5", "t", f"review {i % 7}") for i in range(20)]
    table = spark.createDataFrame(rows, "Airline_Name string, Overall_Rating string, Review_Title string, Review string")
    numbered = reviews.with_row_id(table).withColumnRenamed("row_id", "id")
    intents, rejects = extract_intents(numbered, Always(), "m", backoff=None)
    found = {r["id"] for r in intents.select("id").collect()} | {r["id"] for r in rejects.collect()}
    assert found == {r["id"] for r in numbered.collect()} and len(found) == 20


class Echo:
    """One intent for each call, which names the words that were asked about."""

    def complete(self, request_id, request, attempt):
        words = [w for w in json.loads(request)["messages"][1]["content"].split() if w.startswith("word")]
        return [], json.dumps({"intents": [{"intent": "a", "text_summary": " ".join(words), "sentiment": "Positive", "named_entities": []}]})


def test_long_reviews_are_asked_about_in_chunks(spark):
    rows = [(7, "Air", "5", "t", " ".join(f"word{i}" for i in range(25))), (8, "Air", "5", "t", "word1 word2")]
    table = spark.createDataFrame(rows, "id long, Airline_Name string, Overall_Rating string, Review_Title string, Review string")
    intents, rejects = extract_intents(table, Echo(), "m", backoff=None, chunk_words=10, chunk_overlap=2)
    found = {}
    for r in intents.collect():
        found.setdefault(r["id"], []).append(r["text_summary"].split())
    assert rejects.count() == 0 and len(found[7]) == 3 and found[8] == [["word1", "word2"]]
    assert {w for part in found[7] for w in part} == {f"word{i}" for i in range(25)} and max(map(len, found[7])) == 10


class Always:
    def complete(self, request_id, request, attempt):
        assert isinstance(request_id, str)
        return [], json.dumps(V.EXAMPLE_OUTPUT)


class Extractor:
    """Replies by review text: the worked example for most, broken replies for some."""

    def complete(self, request_id, request, attempt):
        body = json.loads(request)
        assert body["tools"] == V.TOOLS
        if request_id % 4 == 1:
            return ["{broken"], None
        if request_id % 4 == 2:
            return [json.dumps({"intents": [{"intent": "a", "text_summary": "b", "sentiment": "Positive"}]})], None
        return [], json.dumps(V.EXAMPLE_OUTPUT)


def test_every_sampled_review_ends_in_intents_or_rejects(spark):
    rows = [(i, "Air", "5", "t", "" if i == 0 else f"review {i}") for i in range(20)]
    table = spark.createDataFrame(rows, "id long, Airline_Name string, Overall_Rating string, Review_Title string, Review string")
    intents, rejects = extract_intents(table, Extractor(), "m", sample=15, backoff=None)
    kept, refused = {r["id"] for r in intents.collect()}, {r["id"]: r["reason"] for r in rejects.collect()}
    assert len(kept | set(refused)) == 15 and not kept & set(refused)
    assert all(r == "invalid_json" for i, r in refused.items() if i % 4 == 1)
    assert all(r == "null_named_entities" for i, r in refused.items() if i % 4 == 2)
    assert intents.columns == ["id", "Airline_Name", "Overall_Rating", "Review_Title", "Review", "llm_response", "intent", "text_summary", "sentiment", "named_entities"]
    required, _ = extract_intents(table, Extractor(), "m", sample=15, backoff=None, mode="required")
    assert {r["id"] for r in required.collect()} == kept | {i for i in refused if i % 4 == 2}
