"""Queries of the numbered operators over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from review_topics.llm import alignment, archives, cross_parsing, decontaminate, exact_search, hard_negatives, ngram_jaccard, packing, pii, ring, suffix_dedup, token_counts, toxicity
from review_topics.session import hot_lookup, scratch_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """crc32 of the document's number as text, modulo ``modulus``; it splits learning from held-out rows."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query
def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    vocabulary = token_counts.read_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf, "documents"), vocabulary)


@query
def op2_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return exact_search.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op2_exact_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.without_repeats(table(spark, sf, "documents"))
    removed = (F.col("n_bytes") - F.length("kept")).alias("n_removed")
    return found.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    scorer = toxicity.train(documents, table(spark, sf, "labels").where(remainder(5) != 0))
    score = toxicity.scored(documents, scorer)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out")
    return score.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    found = pii.personal_data(documents, pii.train(documents))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(kind).__eq__)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat, ends = np.asarray(ids.flatten()).astype("<u4"), np.concatenate(([0], np.cumsum(np.asarray(ids.value_lengths()))))
        digests = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
        kept = [c for c in batch.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(digests, pa.int64())], names=[*kept, "ids_crc32"])


@query
def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf, "documents"), packing.byte_bpe_50k())
    placed = packing.best_fit(pieces).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "sequence_id", "offset", "ids")
    return placed.mapInArrow(_id_digests, "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids_crc32 long")


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_jaccard.jaccard_links(table(spark, sf, "documents"))


@query
def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("record"), "url", F.col("html").alias("payload"))
    legacy, modern = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(pages, legacy)
    archives.convert(spark, legacy, modern)
    found = stage(archives.read_warc(spark, modern).drop("payload"), "warc-records")
    # Identifiers lead from a revisit to its response.
    responses = found.where("warc_type = 'response'").select(F.col("warc_id").alias("refers_to"), F.col("record").alias("response"))
    pointing = found.where("warc_type = 'revisit'").groupBy("refers_to").agg(F.count("*").alias("matches"))
    named = responses.join(pointing, "refers_to")
    columns = [F.col("record").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type")]
    revisits = hot_lookup(found.where("warc_type = 'revisit'"), named, ["refers_to"], "matches").select(*columns, F.col("response").alias("refers_to"))
    return found.where("warc_type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(revisits)


@query
def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    model = cross_parsing.train(documents.where(remainder(3) != 1))
    found = cross_parsing.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op11_sharding(spark: SparkSession, sf: str) -> DataFrame:
    found = ring.ring_shards(table(spark, sf, "documents"), 40)
    return found.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


ORACLES["op11_sharding"] = """
WITH RECURSIVE
crc_table AS (SELECT list(v ORDER BY b) AS t FROM (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(b))),
sized AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table),
placed AS (SELECT *, CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), 'text ' || text_crc32 || ' ' || size)), 15) AS BIGINT) AS position FROM sized),
ring AS (SELECT CAST(row_number() OVER (ORDER BY position, shard) - 1 AS INTEGER) AS arc, shard, position
  FROM (SELECT CAST(i % 40 AS INTEGER) AS shard, CAST('0x' || left(md5((i % 40) || ':' || (i // 40)), 15) AS BIGINT) AS position FROM range(4000) r(i))),
numbered AS (SELECT p.*, coalesce(r.arc, 0) AS arc, row_number() OVER (PARTITION BY coalesce(r.arc, 0)
    ORDER BY (p.position + text_crc32) % greatest(16, n // 10000000), p.position, doc_id NULLS FIRST, text_crc32, size) - 1 AS rank, n
  FROM (SELECT *, count(*) OVER () AS n FROM placed) p ASOF LEFT JOIN ring r ON p.position <= r.position),
orders AS (SELECT a.arc, r.shard, row_number() OVER (PARTITION BY a.arc ORDER BY min((r.arc - a.arc + 4000) % 4000)) AS turn
  FROM (SELECT DISTINCT arc FROM numbered) a, ring r GROUP BY a.arc, r.shard),
turns(turn, kind, arc, n, first, shard, base) AS (
  SELECT 0::BIGINT, 'arc', arc, count(*), 0::BIGINT, NULL::INTEGER, NULL::BIGINT FROM numbered GROUP BY arc
  UNION ALL SELECT 0, 'room', NULL, (SELECT count(*) FROM documents) // 40 + CAST(s < (SELECT count(*) FROM documents) % 40 AS BIGINT), 0, s, NULL FROM range(40) r(s)
  UNION ALL
  (WITH asked AS (SELECT t.turn + 1 AS turn, t.arc, t.n, t.first, o.shard, room.n AS free, room.first AS used,
         coalesce(sum(t.n) OVER (PARTITION BY o.shard ORDER BY t.arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
       FROM turns t JOIN orders o ON t.kind = 'arc' AND o.arc = t.arc AND o.turn = t.turn + 1
       JOIN turns room ON room.kind = 'room' AND room.shard = o.shard),
     given AS (SELECT *, CAST(greatest(0, least(n, free - ahead)) AS BIGINT) AS taken FROM asked)
   SELECT turn, 'arc', arc, n - taken, first + taken, NULL, NULL FROM given WHERE n > taken
   UNION ALL SELECT turn, 'part', arc, taken, first, shard, CAST(used + ahead AS BIGINT) FROM given WHERE taken > 0
   UNION ALL SELECT room.turn + 1, 'room', NULL, CAST(room.n - coalesce(g.taken, 0) AS BIGINT), CAST(room.first + coalesce(g.taken, 0) AS BIGINT), room.shard, NULL
     FROM turns room LEFT JOIN (SELECT shard, sum(taken) AS taken FROM given GROUP BY shard) g ON g.shard = room.shard
     WHERE room.kind = 'room' AND EXISTS (SELECT 1 FROM given)))
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, d.text_crc32, 'rows' AS law, t.shard, t.base + d.rank - t.first AS slot, NULL::INTEGER AS grown_shard
FROM numbered d JOIN turns t ON t.kind = 'part' AND t.arc = d.arc AND d.rank >= t.first AND d.rank < t.first + t.n
"""


@query
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


ORACLES["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
           FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


@query
def op13_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    a, b = alignment.byte_bpe_50k(), alignment.piece_bpe_32k()
    aligned = alignment.align(table(spark, sf, "documents"), a, b, digest=True)
    return alignment.link_scores(aligned, a, b).withColumnRenamed("groups", "groups_sha256")
