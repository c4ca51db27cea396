"""Shared pieces of the registered queries: table readers, SQL fragments, stages used by several queries."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from review_topics.functions import vectors as X
from review_topics.operators import embedding, terms, topics, zeroshot
from review_topics.operators.inference import RateLimited
from review_topics.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_STAGES: dict[tuple, DataFrame] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def shared(name: str, build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A stage written once per session and data folder, then read by every query that needs it."""

    def get(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf, name)
        if key not in _STAGES:
            _STAGES[key] = stage(build(spark, sf), name)
        return _STAGES[key]

    return get


def forget_stages() -> None:
    """Make the next query compute its stages again; used when each query is timed on its own."""
    _STAGES.clear()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.col("text").alias("document"), "lang", "source")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the role of reviews."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("Airline_Name"),
        F.col("n_chars").cast("string").alias("Overall_Rating"),
        F.col("lang").alias("Review_Title"),
        F.col("text").alias("Review"),
    )


class HashProvider:
    """Stand-in for a model: outcome and reply follow from a hash of the request."""

    def __init__(self, failing: bool = False, plain: bool = False):
        self.failing = failing
        self.plain = plain

    def complete(self, request_id: int, request: str, attempt: int) -> tuple[list[str], str | None]:
        digit = hashlib.md5(f"{request_id}:{attempt}".encode()).hexdigest()[0]
        if self.failing and digit in "0123":
            raise RateLimited()
        if self.failing and digit == "4":
            raise ValueError("bad request")
        reply = hashlib.md5(request.encode()).hexdigest()
        return ([], reply) if self.plain or request_id % 2 == 0 else ([reply], None)


ENCODER = embedding.HashedEncoder(256)
SCALE = 0.4

term_lists = shared("term-lists", lambda spark, sf: embedding.term_lists(documents(spark, sf)))
raw_vectors = shared("raw-vectors", lambda spark, sf: embedding.embed(documents(spark, sf), ENCODER))
centred_vectors = shared(
    "centred-vectors",
    lambda spark, sf: embedding.centre(raw_vectors(spark, sf), X.mean_vector(raw_vectors(spark, sf))),
)


def first_of_language(spark: SparkSession, sf: str) -> DataFrame:
    """``(idx, label, doc_id)``: the first document of each language stands for a predefined topic."""
    first = table(spark, sf, "documents").groupBy("lang").agg(F.min("doc_id").alias("doc_id"))
    idx = (F.row_number().over(Window.orderBy("doc_id")) - 1).cast("int")
    return first.select(idx.alias("idx"), F.col("lang").alias("label"), "doc_id")


def prototypes(spark: SparkSession, sf: str) -> DataFrame:
    return first_of_language(spark, sf).join(centred_vectors(spark, sf), "doc_id").select("idx", "label", "vec")


zero_shot = shared(
    "zero-shot",
    lambda spark, sf: zeroshot.assign_zero_shot(centred_vectors(spark, sf), prototypes(spark, sf), SCALE),
)


def _language_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Zero-shot topics only: everything below the threshold is an outlier."""
    assigned = zero_shot(spark, sf)
    topic = F.coalesce("idx", F.lit(-1))
    return assigned.select(
        "doc_id", topic.alias("topic_id"), F.when(F.col("idx").isNull(), 0.0).otherwise(F.col("similarity")).alias("probability")
    )


language_topics = shared("language-topics", _language_topics)


def source_topics(spark: SparkSession, sf: str) -> DataFrame:
    """``source`` in the role of the topic: src7 is topic 7."""
    return table(spark, sf, "documents").select("doc_id", F.substring("source", 4, 9).cast("int").alias("topic_id"))


source_counts = shared("source-counts", lambda spark, sf: terms.topic_terms(term_lists(spark, sf), source_topics(spark, sf)))
source_weights = shared("source-weights", lambda spark, sf: terms.ctfidf(source_counts(spark, sf)))
language_weights = shared(
    "language-weights",
    lambda spark, sf: terms.ctfidf(terms.topic_terms(term_lists(spark, sf), language_topics(spark, sf))),
)

# ---------------------------------------------------------------------------------------------- SQL fragments
TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"

DOC_TERMS = rf"""
toks AS (SELECT doc_id, unnest({TOKENS}) AS term FROM documents),
dt AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term)"""

SOURCE_TOPICS = "st AS (SELECT doc_id, CAST(substr(source, 4) AS INT) AS topic_id FROM documents)"


def ctfidf_sql(topics_cte: str) -> str:
    """CTEs ``tt`` (counts) and ``cw`` (weights) of the topics in ``topics_cte``."""
    return f"""
tt AS (SELECT topic_id, term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS doc_freq
       FROM dt JOIN {topics_cte} USING (doc_id) GROUP BY topic_id, term),
len AS (SELECT topic_id, sum(tf) AS topic_tf FROM tt GROUP BY topic_id),
allt AS (SELECT term, sum(tf) AS term_tf FROM tt GROUP BY term),
cw AS (SELECT tt.topic_id, tt.term, tt.tf, tt.doc_freq,
              tt.tf / topic_tf * ln(1 + (SELECT avg(topic_tf) FROM len) / term_tf) AS weight
       FROM tt JOIN len USING (topic_id) JOIN allt USING (term))"""


RANKED = """
rk AS (SELECT topic_id, term, weight,
              row_number() OVER (PARTITION BY topic_id ORDER BY round(weight, 9) DESC, term) AS rank FROM cw)"""

RAW_VECTORS = f"""{DOC_TERMS},
bk AS (SELECT doc_id, CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 256 AS b, sum(1 + ln(tf)) AS w
       FROM dt GROUP BY doc_id, b),
rv AS (SELECT doc_id, b, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM bk)"""

CENTRED = f"""{RAW_VECTORS},
mean AS (SELECT g.b, coalesce(sum(rv.w), 0) / (SELECT count(DISTINCT doc_id) FROM rv) AS m
         FROM (SELECT unnest(range(256)) AS b) g LEFT JOIN rv USING (b) GROUP BY g.b),
full_v AS (SELECT d.doc_id, mean.b, coalesce(rv.w, 0) - mean.m AS x
           FROM (SELECT DISTINCT doc_id FROM rv) d CROSS JOIN mean LEFT JOIN rv ON rv.doc_id = d.doc_id AND rv.b = mean.b),
cv AS (SELECT doc_id, b, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM full_v)"""

PROTOTYPES = """
fl AS (SELECT lang AS label, min(doc_id) AS doc_id FROM documents GROUP BY lang),
pt AS (SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INT) AS idx, label, doc_id FROM fl),
pv AS (SELECT idx, b, x FROM pt JOIN cv USING (doc_id))"""

ZERO_SHOT = f"""{CENTRED},{PROTOTYPES},
sim AS (SELECT cv.doc_id, pv.idx, round(sum(cv.x * pv.x), 9) AS s FROM cv JOIN pv USING (b) GROUP BY cv.doc_id, pv.idx),
best AS (SELECT doc_id, idx, s, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, idx) AS r FROM sim),
zs AS (SELECT d.doc_id, CASE WHEN round(s, 6) >= {SCALE} THEN idx END AS idx, coalesce(s, 0) AS similarity
       FROM documents d LEFT JOIN (SELECT * FROM best WHERE r = 1) b ON b.doc_id = d.doc_id),
lt AS (SELECT doc_id, coalesce(idx, -1) AS topic_id, CASE WHEN idx IS NULL THEN 0 ELSE similarity END AS probability FROM zs)"""
