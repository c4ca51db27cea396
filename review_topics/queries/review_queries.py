"""Registered queries: sources, text work, replies, inference."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.functions import text as T
from review_topics.operators import inference, lexicon, prompts, responses
from review_topics.operators import reviews as R
from review_topics.queries import common as C
from review_topics.queries.common import query
from review_topics.session import scratch_path
from review_topics.sources import tables


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ------------------------------------------------------------------------------------------- sources and sinks
@query("SELECT doc_id AS id, source AS Airline_Name, CAST(n_chars AS VARCHAR) AS Overall_Rating, lang AS Review_Title, text AS Review FROM documents")
def a1_read_reviews(spark: SparkSession, sf: str) -> DataFrame:
    mapping = {"doc_id": "id", "source": "Airline_Name", "n_chars": "Overall_Rating", "lang": "Review_Title", "text": "Review"}
    rows = tables.read_reviews(spark, f"{sf}/documents.parquet", mapping)
    return rows.withColumn("Overall_Rating", F.col("Overall_Rating").cast("string"))


def _document_intents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the shape of the intents table."""
    return C.reviews(spark, sf).select(
        "*",
        F.concat(F.lit("{"), F.col("id").cast("string"), F.lit("}")).alias("llm_response"),
        F.col("Review_Title").alias("intent"),
        F.col("Review").alias("text_summary"),
        F.when(F.col("id") % 2 == 0, "Positive").otherwise("Negative").alias("sentiment"),
        F.array("Airline_Name").alias("named_entities"),
    )


INTENTS_SQL = """
SELECT doc_id AS id, source AS Airline_Name, CAST(n_chars AS VARCHAR) AS Overall_Rating, lang AS Review_Title, text AS Review,
       '{' || doc_id || '}' AS llm_response, lang AS intent, text AS text_summary,
       CASE WHEN doc_id % 2 = 0 THEN 'Positive' ELSE 'Negative' END AS sentiment, source AS entities
FROM documents"""


# The test requests' model.
MODEL = "some-model"


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("entities", F.array_join("named_entities", ",")).drop("named_entities")


@query(INTENTS_SQL)
def a2_read_intents(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "intents-in")
    _document_intents(spark, sf).write.parquet(path)
    return _flat(tables.read_intents(spark, path))


@query("SELECT doc_id AS id, text AS Review FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 137")
def a3_sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return R.sample_n(C.reviews(spark, sf), 137, "id", 42).select("id", "Review")


@query(
    """
SELECT lang, source, md5('{"lang":"' || lang || '","source":"' || source || '"}') || '-' ||
       row_number() OVER (PARTITION BY lang, source) AS row_id FROM documents"""
)
def a4_row_id(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_row_id(C.documents(spark, sf).select("lang", "source"))


@query(INTENTS_SQL)
def a5_write_intents(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "intents-out")
    rows = _document_intents(spark, sf)
    tables.write_intents(rows, path)
    tables.write_intents(rows, path)  # replaces the first copy
    return _flat(tables.read_intents(spark, path))


# -------------------------------------------------------------------------------------------------- text work
@query("SELECT text AS Review FROM documents")
def b1_project_text(spark: SparkSession, sf: str) -> DataFrame:
    return C.reviews(spark, sf).select("Review")


@query(
    """
SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN NULL ELSE d.lang || ': ' || d.text END AS document
FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def b2_doc_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.documents(spark, sf).join(C.table(spark, sf, "labels"), "doc_id", "left")
    intent = F.when(F.col("quality").isNotNull(), F.col("lang"))
    return rows.select("doc_id", T.doc_text(intent, F.col("document")).alias("document"))


@query(
    """
SELECT doc_id AS id, CASE WHEN text IS NULL THEN 'missing' WHEN length(trim(text)) = 0 THEN 'empty'
       WHEN length(trim(text)) < 200 THEN 'too_short' WHEN length(trim(text)) > 5000 THEN 'too_long' END AS reject_reason
FROM documents"""
)
def b3_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    return R.prefilter_reviews(C.reviews(spark, sf), 200, 5000).select("id", "reject_reason")


@query(
    r"""
WITH w AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT id, ws, unnest(range(0, greatest(len(ws) - 11, 0) + 1, 40)) AS start FROM w)
SELECT id, CAST(start // 40 AS INT) AS chunk, array_to_string(ws[start + 1:start + 50], ' ') AS chunk_text FROM s"""
)
def b4_chunk(spark: SparkSession, sf: str) -> DataFrame:
    return R.chunk_reviews(C.reviews(spark, sf), 50, 10).select("id", "chunk", "chunk_text")


_PROMPT = T.literal_template(V.EXTRACTION_PROMPT, prompts.CONSTANTS)
_BEFORE, _AFTER = _PROMPT.split("{review}")


@query(f"SELECT doc_id AS id, {quoted(_BEFORE)} || text || {quoted(_AFTER)} AS prompt FROM documents")
def b5_render_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.render_prompt(C.reviews(spark, sf)).select("id", "prompt")


@query(
    f"""
SELECT conv_id, turn, CAST(to_json({{'model': {quoted(MODEL)}, 'messages': [
         {{'role': 'system', 'content': {quoted(V.SYSTEM_MESSAGE)}}}, {{'role': 'user', 'content': text}}],
         'max_tokens': {V.MAX_TOKENS}, 'temperature': {V.TEMPERATURE}::DOUBLE}}) AS VARCHAR) AS request
FROM conversations"""
)
def b6_chat_request(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.chat_request(C.table(spark, sf, "conversations"), MODEL, column="text").select("conv_id", "turn", "request")


# Replies as a model might give them, from whole documents; the same text in both engines.
def _reply_sql(letters_only: str) -> str:
    good = (
        f"""'{{"intent":"' || lang || '","text_summary":"' || {letters_only} || '","sentiment":"Positive","""
        """"named_entities":["' || source || '"]}'"""
    )
    second = """'{"intent":"source","text_summary":"' || source || '","sentiment":"Negative","named_entities":[]}'"""
    whole = f"""'{{"intents":[' || {good} || ',' || {second} || ']}}'"""
    return f"""CASE CAST(doc_id % 11 AS INT)
      WHEN 1 THEN '{{"intents":[' || {good} || ',' || {second}
      WHEN 2 THEN {whole} || ' That is all.'
      WHEN 3 THEN '{{"intents":["x",' || {good} || ',7]}}'
      WHEN 4 THEN replace({whole}, '"Negative"', '"Great"')
      WHEN 5 THEN '{{"intents":[{{"intent":"' || lang || '","text_summary":"' || source || '","sentiment":"Neutral"}}]}}'
      WHEN 6 THEN ''
      WHEN 7 THEN '```json' || {whole} || '```'
      WHEN 8 THEN '{{"intents":[{{"intent":5,"text_summary":"' || source || '","sentiment":"Neutral","named_entities":[]}}]}}'
      WHEN 9 THEN '{{"intents":' || {good} || '}}'
      WHEN 10 THEN '{{"intents":[{{"text_summary":"' || source || '","sentiment":"Neutral","named_entities":[]}}]}}'
      ELSE {whole} END"""


_SPARK_REPLY = _reply_sql(r"trim(regexp_replace(text, '[^\\p{L}]+', ' '))")
_DUCK_REPLY = _reply_sql(r"trim(regexp_replace(text, '[^\p{L}]+', ' ', 'g'))")


def replies(spark: SparkSession, sf: str) -> DataFrame:
    return C.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.expr(_SPARK_REPLY).alias("payload")
    )


_TWO_CALLS = "CASE WHEN doc_id % 3 = 0 THEN [p] WHEN doc_id % 3 = 1 THEN [p, source] ELSE [NULL] END"


@query(
    f"""
WITH r AS (SELECT doc_id, source, {_DUCK_REPLY} AS p FROM documents),
c AS (SELECT doc_id AS id, 0 AS call, CASE WHEN doc_id % 3 = 2 THEN 'plain ' || source ELSE p END AS payload FROM r
      UNION ALL SELECT doc_id, 1, source FROM r WHERE doc_id % 3 = 1)
SELECT id, CAST(call AS INT) AS call, payload FROM c"""
)
def b7_response_payload(spark: SparkSession, sf: str) -> DataFrame:
    third = F.col("id") % 3
    source = C.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source")
    rows = replies(spark, sf).join(source, "id").select(
        "id",
        F.when(third == 0, F.array("payload")).when(third == 1, F.array("payload", "source")).otherwise(F.array().cast("array<string>")).alias("tool_args"),
        F.when(third == 2, F.concat(F.lit("plain "), "source")).alias("content"),
    )
    return responses.response_payload(rows)


_PARSED = f"""
r AS (SELECT doc_id AS id, {_DUCK_REPLY} AS p FROM documents),
j AS (SELECT id, p, CASE WHEN json_valid(p) AND json_type(CASE WHEN json_valid(p) THEN p END) = 'OBJECT' THEN CAST(p AS JSON) END AS o FROM r),
l AS (SELECT id, p, o, json_type(o, '$.intents') AS lt,
             CASE WHEN json_type(o, '$.intents') = 'ARRAY' THEN CAST(json_extract(o, '$.intents') AS JSON[]) END AS els FROM j),
e AS (SELECT id, p, o, lt, unnest(els) AS el, unnest(range(len(els))) AS pos FROM l WHERE len(els) > 0
      UNION ALL SELECT id, p, o, lt, NULL, 0 FROM l WHERE coalesce(len(els), 0) = 0),
ps AS (SELECT id, CAST(pos AS INT) AS intent_pos,
       CASE WHEN o IS NULL THEN 'invalid_json' WHEN lt IS NULL THEN 'no_intents_key' WHEN lt <> 'ARRAY' THEN 'intents_not_a_list'
            WHEN el IS NULL THEN 'no_intents' WHEN json_type(el) = 'OBJECT' THEN 'ok' ELSE 'not_an_object' END AS parse_status,
       p, el FROM e),
pf AS (SELECT id, intent_pos, parse_status, p, el,
       CASE WHEN parse_status = 'ok' THEN json_extract_string(el, '$.intent') END AS intent,
       CASE WHEN parse_status = 'ok' THEN json_extract_string(el, '$.text_summary') END AS text_summary,
       CASE WHEN parse_status = 'ok' THEN json_extract_string(el, '$.sentiment') END AS sentiment,
       CASE WHEN parse_status = 'ok' THEN array_to_string(CAST(CAST(json_extract(el, '$.named_entities') AS JSON) AS VARCHAR[]), ',') END AS entities,
       CASE WHEN parse_status = 'ok' THEN
         '{{' || array_to_string(list_filter([
            CASE WHEN json_exists(el, '$.intent') THEN '"intent":' || CAST(json_extract(el, '$.intent') AS VARCHAR) END,
            CASE WHEN json_exists(el, '$.named_entities') THEN '"named_entities":' || CAST(json_extract(el, '$.named_entities') AS VARCHAR) END,
            CASE WHEN json_exists(el, '$.sentiment') THEN '"sentiment":' || CAST(json_extract(el, '$.sentiment') AS VARCHAR) END,
            CASE WHEN json_exists(el, '$.text_summary') THEN '"text_summary":' || CAST(json_extract(el, '$.text_summary') AS VARCHAR) END],
            lambda x: x IS NOT NULL), ',') || '}}'
         WHEN el IS NOT NULL THEN CAST(el AS VARCHAR) ELSE p END AS llm_response FROM ps),
vi AS (SELECT *, CASE WHEN parse_status <> 'ok' THEN parse_status
       WHEN intent IS NULL THEN 'missing_intent' WHEN json_type(el, '$.intent') <> 'VARCHAR' THEN 'intent_not_a_string'
       WHEN text_summary IS NULL THEN 'missing_text_summary' WHEN sentiment IS NULL THEN 'missing_sentiment'
       WHEN sentiment NOT IN ('Positive', 'Negative', 'Neutral') THEN 'unknown_sentiment' END AS reject_reason FROM pf)"""


@query(f"WITH {_PARSED} SELECT id, intent_pos, parse_status, llm_response FROM pf")
def b8_parse_responses(spark: SparkSession, sf: str) -> DataFrame:
    return responses.parse_responses(replies(spark, sf)).select("id", "intent_pos", "parse_status", "llm_response")


@query(f"WITH {_PARSED} SELECT id, intent_pos, llm_response FROM pf WHERE parse_status = 'not_an_object'")
def b9_non_objects(spark: SparkSession, sf: str) -> DataFrame:
    rows = responses.parse_responses(replies(spark, sf))
    return rows.where(F.col("parse_status") == "not_an_object").select("id", "intent_pos", "llm_response")


@query(f"WITH {_PARSED} SELECT id, intent_pos, intent, text_summary, sentiment, entities FROM pf WHERE parse_status = 'ok'")
def b10_normalize(spark: SparkSession, sf: str) -> DataFrame:
    rows = _flat(responses.parse_responses(replies(spark, sf)))
    return rows.where(F.col("parse_status") == "ok").select("id", "intent_pos", "intent", "text_summary", "sentiment", "entities")


@query(f"WITH {_PARSED} SELECT id, intent_pos, reject_reason FROM vi")
def b11_validate(spark: SparkSession, sf: str) -> DataFrame:
    return responses.validate_intents(responses.parse_responses(replies(spark, sf))).select("id", "intent_pos", "reject_reason")


_VALID = f"""{_PARSED},
iv AS (SELECT d.doc_id AS id, d.source AS Airline_Name, CAST(d.n_chars AS VARCHAR) AS Overall_Rating, d.lang AS Review_Title,
       d.text AS Review, llm_response, intent, text_summary, sentiment, entities
       FROM vi JOIN documents d ON d.doc_id = vi.id WHERE reject_reason IS NULL)"""


def valid_intents(spark: SparkSession, sf: str) -> DataFrame:
    rows = responses.validate_intents(responses.parse_responses(replies(spark, sf)))
    kept = rows.where(F.col("reject_reason").isNull())
    return responses.to_intents_schema(responses.attach_reviews(kept, C.reviews(spark, sf)))


@query(
    f"""WITH {_VALID} SELECT 'strict' AS mode, count(*) AS n_rows, count(DISTINCT id) AS n_reviews FROM iv WHERE entities IS NOT NULL
UNION ALL SELECT 'required', count(*), count(DISTINCT id) FROM iv"""
)
def b12_na_drop(spark: SparkSession, sf: str) -> DataFrame:
    rows = valid_intents(spark, sf)
    sides = [responses.na_drop(rows, mode).select(F.lit(mode).alias("mode"), "id") for mode in ("strict", "required")]
    return sides[0].unionByName(sides[1]).groupBy("mode").agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_reviews"))


@query(f"WITH {_VALID} SELECT * FROM iv")
def b13_intents_schema(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(valid_intents(spark, sf))


@query(
    r"""
WITH m AS (SELECT doc_id, chr(39) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'topic: ' ELSE '' END || lang || ' ' || source || chr(10) || chr(39) || chr(39) || chr(39) AS reply FROM documents)
SELECT doc_id, trim(regexp_replace(trim(trim(reply, chr(39)), chr(10)), '^\s*topic:', '')) AS label FROM m"""
)
def b14_clean_label(spark: SparkSession, sf: str) -> DataFrame:
    prefix = F.when(F.col("doc_id") % 2 == 0, "topic: ").otherwise("")
    reply = F.concat(F.lit("'\n"), prefix, "lang", F.lit(" "), "source", F.lit("\n'''"))
    return C.documents(spark, sf).select("doc_id", T.clean_label(reply).alias("label"))


@query(
    r"""
SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')[1:100], ' ') AS document
FROM documents"""
)
def b16_truncate_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return R.truncate_tokens(C.documents(spark, sf), 100).select("doc_id", "document")


# ------------------------------------------------------------------------------------------------------- joins
@query(f"WITH {_PARSED} SELECT id, count(*) AS n_intents FROM pf WHERE parse_status = 'ok' GROUP BY id")
def c1_explode_intents(spark: SparkSession, sf: str) -> DataFrame:
    rows = responses.parse_responses(replies(spark, sf)).where(F.col("parse_status") == "ok")
    return rows.groupBy("id").agg(F.count("*").alias("n_intents"))


@query(f"WITH {_VALID} SELECT id, Airline_Name, Review_Title, intent, text_summary FROM iv")
def c2_attach_reviews(spark: SparkSession, sf: str) -> DataFrame:
    rows = responses.validate_intents(responses.parse_responses(replies(spark, sf)))
    kept = rows.where(F.col("reject_reason").isNull()).select("id", "intent", "text_summary")
    return responses.attach_reviews(kept, C.reviews(spark, sf)).select("id", "Airline_Name", "Review_Title", "intent", "text_summary")


@query(
    f"""
SELECT d.doc_id AS id, d.text AS Review, r.p AS reply FROM documents d
LEFT JOIN (SELECT doc_id, {_DUCK_REPLY} AS p FROM documents WHERE lang <> 'en') r USING (doc_id)"""
)
def c3_zip_responses(spark: SparkSession, sf: str) -> DataFrame:
    answered = C.table(spark, sf, "documents").where(F.col("lang") != "en")
    got = answered.select(F.col("doc_id").alias("id"), F.expr(_SPARK_REPLY).alias("reply"))
    return responses.zip_responses(C.reviews(spark, sf).select("id", "Review"), got)


# --------------------------------------------------------------------------------------------------- inference
def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return C.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("request"))


@query("SELECT doc_id AS id, 1 AS attempt, 'ok' AS status, CASE WHEN doc_id % 2 = 1 THEN md5(text) END AS tool_arg, CASE WHEN doc_id % 2 = 0 THEN md5(text) END AS content FROM documents")
def d1_infer(spark: SparkSession, sf: str) -> DataFrame:
    rows = inference.infer(_requests(spark, sf), C.HashProvider())
    return rows.select("id", "attempt", "status", F.get("tool_args", F.lit(0)).alias("tool_arg"), "content")


@query("SELECT CAST(count(*) AS BIGINT) AS n_calls, 5 AS tasks FROM documents")
def d2_bounded_concurrency(spark: SparkSession, sf: str) -> DataFrame:
    rows = inference.infer(_requests(spark, sf), C.HashProvider(), max_in_flight=5)
    return rows.select(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n_calls"), F.countDistinct("task").cast("int").alias("tasks")
    )


_LEDGER = """
a AS (SELECT doc_id AS id, a AS attempt, substr(md5(doc_id || ':' || a), 1, 1) AS digit FROM documents, (VALUES (1), (2), (3)) v(a)),
s AS (SELECT id, attempt, CASE WHEN digit IN ('0', '1', '2', '3') THEN 'rate_limited' WHEN digit = '4' THEN 'error' ELSE 'ok' END AS status FROM a),
lg AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.id = s.id AND b.attempt < s.attempt AND b.status <> 'rate_limited'))"""


@query(f"WITH {_LEDGER} SELECT id, CAST(attempt AS INT) AS attempt, status FROM lg")
def d3_retry_ledger(spark: SparkSession, sf: str) -> DataFrame:
    ledger = inference.infer_with_retries(_requests(spark, sf), C.HashProvider(failing=True), backoff=None)
    return ledger.select("id", "attempt", "status")


# Common words of the four languages stand for aspects and for polarity.
_ASPECTS = {"place": ["in", "dans", "en", "von"], "company": ["with", "avec", "mit", "con"], "link": ["and", "et", "und", "y"]}
_POLARITY = {"the": 1, "la": 1, "ist": 1, "que": 1, "of": -1, "les": -1, "nicht": -1, "de": -1}


def _count_sql(words: list[str]) -> str:
    listed = ", ".join(quoted(w) for w in words)
    return f"len(list_filter(ws, lambda w: w IN ({listed})))"


_LEXICON = rf"""
sn AS (SELECT doc_id AS id, list_filter(list_transform(regexp_split_to_array(text, '[.!?\n]+'), lambda s: trim(s)), lambda s: s <> '') AS ss FROM documents),
se AS (SELECT id, unnest(ss) AS text_summary, unnest(range(len(ss))) AS sentence FROM sn WHERE len(ss) > 0),
tw AS (SELECT *, regexp_extract_all(lower(text_summary), '[\p{{L}}\p{{N}}_]{{2,}}') AS ws FROM se),
sc AS (SELECT *, {_count_sql([w for w, p in _POLARITY.items() if p > 0])} - {_count_sql([w for w, p in _POLARITY.items() if p < 0])} AS score FROM tw),
li AS (
{" UNION ALL ".join(f"SELECT id, CAST(sentence AS INT) AS sentence, {quoted(name)} AS intent, text_summary, score FROM sc WHERE {_count_sql(terms)} > 0" for name, terms in _ASPECTS.items())}),
lx AS (SELECT id, sentence, intent, text_summary,
       CASE WHEN score > 0 THEN 'Positive' WHEN score < 0 THEN 'Negative' ELSE 'Neutral' END AS sentiment,
       array_to_string(regexp_extract_all(text_summary, '\p{{Lu}}[\p{{L}}\p{{N}}]+'), ',') AS entities FROM li)"""


@query(f"WITH {_LEXICON} SELECT * FROM lx")
def d4_extract_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(lexicon.extract_intents_lexicon(C.reviews(spark, sf), _ASPECTS, _POLARITY))


@query(f"WITH {_PARSED} SELECT parse_status, reject_reason, count(*) AS n_rows FROM vi GROUP BY ALL")
def d5_response_report(spark: SparkSession, sf: str) -> DataFrame:
    return responses.response_report(responses.validate_intents(responses.parse_responses(replies(spark, sf))))
