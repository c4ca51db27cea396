"""Raw documents to packed training sequences: a list of stages, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_topics.llm import cross_parsing, decontaminate, ngram_jaccard, packing, pii
from review_topics.session import local_scratch, stage, temporary_stages, unstage

# More bits a character than this is not running text of a known language: phrases of under two characters.
MAX_BITS = 7.0


def _with_scratch(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in a session that may be local and name no shared folder."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        local_scratch(spark)
        return function(spark, docs, sf_dir)

    return run_stage


def _with_key(docs: DataFrame, *columns: str) -> tuple[DataFrame, str]:
    """The rows with a 64-bit key made of ``columns``, which needs no copy of them to stay the same; and the key's name."""
    key = "_key"
    while key in (name.lower() for name in docs.columns):
        key += "_"
    return docs.withColumn(key, F.xxhash64(*columns)), key


@_with_scratch
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that cross-parsing knows; texts without letters and far from every language go."""
    model = cross_parsing.train(docs)
    aside = {name: f"_own_{name}" for name in docs.columns if name in ("lang_pred", "score", "bits")}
    found = cross_parsing.identify(docs.withColumnsRenamed(aside), model)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("bits") <= MAX_BITS))
    return kept.select(*[F.col(aside.get(name, name)).alias(name) for name in docs.columns])


@_with_scratch
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of those with the smallest doc_id, of each group of near duplicates; rows without doc_id count as the last.

    Rows alike in doc_id and text are one document of the join; where such a document is the one that stays, one of its rows
    does. The document's key has 64 bits: among 10 billion documents about three pairs of strangers share one and go or
    stay together.
    """
    rows, key = _with_key(docs, "doc_id", "text")
    with temporary_stages(spark) as keep:
        links = ngram_jaccard.jaccard_links(rows.select(F.col(key).alias("doc_id"), "text"))
        groups = links.groupBy(F.col("doc_id").alias(key)).agg(F.min("class_id").alias("class_id"))
        own = rows.groupBy(key).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key, "n")).alias("first")
        kept = keep(stage(own.join(groups, key).groupBy("class_id").agg(first).select(f"first.{key}", "first.n"), "kept"))
    # As many keys as documents stay: a shuffled join whatever the size, so that small runs tell what large ones need.
    alone = rows.join(kept.where("n = 1").hint("merge"), key, "left_semi")
    repeated = rows.join(kept.where("n > 1"), key, "left_semi")
    return alone.unionByName(repeated.dropDuplicates([key, "doc_id", "text"])).select(docs.columns)


@_with_scratch
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, by their text alone: also those without doc_id or with another's."""
    rows, key = _with_key(docs, "text")
    with temporary_stages(spark) as keep:
        hits = decontaminate.contaminated(rows.select(F.col(key).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
        found = keep(stage(hits.select(F.col("doc_id").alias(key)).distinct(), "hits"))
    return rows.join(found, key, "left_anti").select(docs.columns)


@_with_scratch
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data in their texts replaced by its kind."""
    return pii.masked(docs, pii.train(docs))


@_with_scratch
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with the sequence each goes to and its place there."""
    pieces = packing.token_pieces(docs, packing.byte_bpe_50k())
    return packing.best_fit(pieces).select("doc_id", "piece", "start", "length", "sequence_id", "offset", "ids")


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    local_scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        with temporary_stages(spark) as keep:
            done = keep(stage(function(spark, docs, sf_dir), name))
        if hasattr(docs, "_staged_at"):
            unstage(docs)
        docs = done
    return docs
