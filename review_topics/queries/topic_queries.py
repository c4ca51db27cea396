"""Registered queries: vectors, topics, clusters, representations, relations, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.functions import vectors as X
from review_topics.operators import density, distribution, document_neighbours, embedding, neighbours, reduction, relations, represent, spanning, terms, topics, zeroshot
from review_topics.operators.components import components
from review_topics.plans import fit, predict
from review_topics.plans.model import FitParams
from review_topics.queries import common as C
from review_topics.queries.common import query, shared
from review_topics.session import hot_lookup, scratch_path, stage
from review_topics.sources import model_store, tables, vector_store

# ---------------------------------------------------------------------------------------------- terms and weights
SOURCE_WEIGHTS = f"{C.DOC_TERMS}, {C.SOURCE_TOPICS}, {C.ctfidf_sql('st')}"
SOURCE_RANKED = f"{SOURCE_WEIGHTS}, {C.RANKED}"


@query(f"WITH {C.DOC_TERMS}, {C.SOURCE_TOPICS}, {C.ctfidf_sql('st')} SELECT topic_id, term, tf, doc_freq FROM tt")
def f1_term_counts(spark: SparkSession, sf: str) -> DataFrame:
    return terms.topic_terms(C.term_lists(spark, sf), C.source_topics(spark, sf))


source_candidates = shared("source-candidates", lambda spark, sf: terms.top_terms(C.source_weights(spark, sf), represent.CANDIDATES))


def source_terms(spark: SparkSession, sf: str) -> DataFrame:
    return source_candidates(spark, sf).where(F.col("rank") <= 10)


@query(f"WITH {SOURCE_RANKED} SELECT topic_id, 'Main' AS aspect, CAST(rank AS INT) AS rank, term, round(weight, 9) AS weight FROM rk WHERE rank <= 10")
def f2_ctfidf(spark: SparkSession, sf: str) -> DataFrame:
    return terms.top_terms(C.source_weights(spark, sf), 10).withColumn("weight", F.round("weight", 9))


# Candidates' letter trigrams as hashed vectors, their likeness, and one more chosen term a step.
_MMR = rf"""{SOURCE_RANKED},
mc AS (SELECT topic_id, CAST(rank AS INT) AS place, term, weight, weight / max(weight) OVER (PARTITION BY topic_id) AS relevance FROM rk WHERE rank <= {represent.CANDIDATES}),
mg AS (SELECT DISTINCT term, '_' || term || '_' AS padded FROM mc),
mk AS (SELECT term, unnest(regexp_extract_all(lower(array_to_string(list_transform(range(1, greatest(len(padded) - 2, 1) + 1), lambda i: substr(padded, i, 3)), ' ')), '[\p{{L}}\p{{N}}_]{{2,}}')) AS g FROM mg),
mf AS (SELECT term, g, count(*) AS tf FROM mk GROUP BY ALL),
mb AS (SELECT term, CAST(('0x' || substr(md5(g), 1, 8)) AS BIGINT) % 256 AS b, sum(1 + ln(tf)) AS w FROM mf GROUP BY ALL),
mv AS (SELECT term, b, w / sqrt(sum(w * w) OVER (PARTITION BY term)) AS w FROM mb),
mp AS (SELECT x.topic_id, x.place AS a, y.place AS b, sum(p.w * q.w) AS s FROM mc x JOIN mc y USING (topic_id) JOIN mv p ON p.term = x.term JOIN mv q ON q.term = y.term AND q.b = p.b GROUP BY ALL),
ml AS (SELECT x.topic_id, x.place AS a, y.place AS b, round(coalesce(s, 0), 9) AS s FROM mc x JOIN mc y USING (topic_id) LEFT JOIN mp ON mp.topic_id = x.topic_id AND mp.a = x.place AND mp.b = y.place),
mr AS (SELECT topic_id, 1 AS step, [place] AS chosen FROM mc WHERE place = 1
       UNION ALL SELECT topic_id, step + 1, list_append(chosen, place) FROM (
         SELECT r.topic_id, r.step, r.chosen, c.place, row_number() OVER (PARTITION BY r.topic_id
                ORDER BY round((1 - CAST({V.MMR_DIVERSITY} AS DOUBLE)) * c.relevance - CAST({V.MMR_DIVERSITY} AS DOUBLE) * max(l.s), 9) DESC, c.place) AS best
         FROM mr r JOIN mc c ON c.topic_id = r.topic_id AND NOT list_contains(r.chosen, c.place)
         JOIN ml l ON l.topic_id = c.topic_id AND l.a = c.place AND list_contains(r.chosen, l.b)
         WHERE r.step < 10 GROUP BY r.topic_id, r.step, r.chosen, c.place, c.relevance) WHERE best = 1),
mo AS (SELECT topic_id, unnest(chosen) AS place, generate_subscripts(chosen, 1) AS rank FROM mr QUALIFY step = max(step) OVER (PARTITION BY topic_id)),
dv AS (SELECT topic_id, CAST(mo.rank AS INT) AS rank, term, weight FROM mo JOIN mc USING (topic_id, place))"""


@query(f"WITH RECURSIVE {_MMR} SELECT topic_id, 'MMR' AS aspect, rank, term, round(weight, 9) AS weight FROM dv")
def f3_mmr(spark: SparkSession, sf: str) -> DataFrame:
    return represent.mmr(source_candidates(spark, sf), C.ENCODER).withColumn("weight", F.round("weight", 9))


_REPRESENTATIVE = """
tn AS (SELECT topic_id, sqrt(sum(weight * weight)) AS topic_norm FROM cw GROUP BY topic_id),
rs AS (SELECT doc_id, topic_id, sum(dt.tf * weight) / (sqrt(sum(CAST(dt.tf AS DOUBLE) * dt.tf)) * any_value(topic_norm)) AS score
       FROM dt JOIN st USING (doc_id) JOIN cw USING (topic_id, term) JOIN tn USING (topic_id) GROUP BY doc_id, topic_id),
rd AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM rs)"""


def source_representative(spark: SparkSession, sf: str) -> DataFrame:
    return represent.representative_docs(C.term_lists(spark, sf), C.source_topics(spark, sf), C.source_weights(spark, sf))


@query(f"WITH {SOURCE_WEIGHTS}, {_REPRESENTATIVE} SELECT topic_id, CAST(rank AS INT) AS rank, doc_id, round(score, 6) AS score FROM rd WHERE rank <= 5")
def f5_representative_docs(spark: SparkSession, sf: str) -> DataFrame:
    return source_representative(spark, sf).withColumn("score", F.round("score", 6))


@query(
    f"""WITH {C.RAW_VECTORS}, {C.SOURCE_TOPICS}, {C.ctfidf_sql('st')}, {C.RANKED}, {_REPRESENTATIVE},
tv AS (SELECT topic_id, b, sum(w) AS w FROM rv JOIN (SELECT topic_id, doc_id FROM rd WHERE rank <= 5) USING (doc_id) GROUP BY topic_id, b),
tl AS (SELECT topic_id, sqrt(sum(w * w)) AS l FROM tv GROUP BY topic_id),
kb AS (SELECT rk.topic_id, rk.term, coalesce(tv.w, 0) / l AS weight FROM rk JOIN tl USING (topic_id)
       LEFT JOIN tv ON tv.topic_id = rk.topic_id AND tv.b = CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 256 WHERE rk.rank <= 30),
kr AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY round(weight, 9) DESC, term) AS rank FROM kb)
SELECT topic_id, 'KeyBERT' AS aspect, CAST(rank AS INT) AS rank, term, round(weight, 6) AS weight FROM kr WHERE rank <= 10"""
)
def f4_keybert_terms(spark: SparkSession, sf: str) -> DataFrame:
    chosen = source_representative(spark, sf).join(C.raw_vectors(spark, sf), "doc_id").select("topic_id", "vec")
    return represent.keybert_terms(source_candidates(spark, sf), chosen, C.ENCODER).withColumn("weight", F.round("weight", 6))


def source_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return X.group_means(C.centred_vectors(spark, sf).join(C.source_topics(spark, sf), "doc_id"), "topic_id")


@query(
    f"""WITH {C.CENTRED}, {C.PROTOTYPES}, {C.SOURCE_TOPICS},
tm AS (SELECT topic_id, b, avg(x) AS x FROM cv JOIN st USING (doc_id) GROUP BY topic_id, b),
tu AS (SELECT topic_id, b, x / sqrt(sum(x * x) OVER (PARTITION BY topic_id)) AS x FROM tm),
s AS (SELECT topic_id, idx, round(sum(tu.x * pv.x), 9) AS s FROM tu JOIN pv USING (b) GROUP BY topic_id, idx),
r AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY s DESC, idx) AS r FROM s)
SELECT topic_id, CASE WHEN round(s, 6) >= 0.1 THEN label END AS label, round(s, 6) AS similarity FROM r JOIN pt USING (idx) WHERE r = 1"""
)
def f6_classify_topics(spark: SparkSession, sf: str) -> DataFrame:
    rows = represent.classify_topics(source_centroids(spark, sf), C.prototypes(spark, sf), 0.1)
    return rows.withColumn("similarity", F.round("similarity", 6))


_LABELS = "gl AS (SELECT topic_id, topic_id || '_' || string_agg(term, '_' ORDER BY rank) AS label FROM rk WHERE rank <= 4 GROUP BY topic_id)"


@query(f"WITH {SOURCE_RANKED}, {_LABELS} SELECT topic_id, label FROM gl")
def f7_default_labels(spark: SparkSession, sf: str) -> DataFrame:
    return represent.default_labels(source_terms(spark, sf))


@query(
    f"""WITH {SOURCE_RANKED}, {_LABELS}, {_REPRESENTATIVE}
SELECT n.topic_id, n.n_docs, label AS name, words, docs FROM (SELECT topic_id, count(*) AS n_docs FROM st GROUP BY topic_id) n
LEFT JOIN gl USING (topic_id)
LEFT JOIN (SELECT topic_id, string_agg(term, ',' ORDER BY rank) AS words FROM rk WHERE rank <= 10 GROUP BY topic_id) USING (topic_id)
LEFT JOIN (SELECT topic_id, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS docs FROM rd WHERE rank <= 5 GROUP BY topic_id) USING (topic_id)"""
)
def f8_topic_info(spark: SparkSession, sf: str) -> DataFrame:
    main = source_terms(spark, sf)
    info = topics.topic_info(C.source_topics(spark, sf), represent.default_labels(main), main, source_representative(spark, sf))
    return info.select(
        "topic_id", "n_docs", "name", F.array_join(F.col("aspects")["Main"], ",").alias("words"), F.array_join("representative_docs", ",").alias("docs")
    )


@query("SELECT count(*) AS n_docs, count(DISTINCT source) AS n_topics FROM documents")
def f9_count(spark: SparkSession, sf: str) -> DataFrame:
    return C.documents(spark, sf).agg(F.count("*").alias("n_docs"), F.countDistinct("source").alias("n_topics"))


_PROMPT_HEAD, _PROMPT_REST = V.LABEL_PROMPT.split("[DOCUMENTS]")
_PROMPT_MIDDLE, _PROMPT_TAIL = _PROMPT_REST.split("[KEYWORDS]")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    f"""WITH RECURSIVE {_MMR}, {_REPRESENTATIVE},
kw AS (SELECT topic_id, string_agg(term, ', ' ORDER BY rank) AS words FROM dv GROUP BY topic_id),
dl AS (SELECT topic_id, string_agg('- ' || text, chr(10) ORDER BY rank) AS docs FROM rd JOIN documents USING (doc_id) WHERE rank <= 5 GROUP BY topic_id)
SELECT topic_id, 'Diverse' AS aspect, rank, term, round(weight, 9) AS weight FROM dv UNION ALL
SELECT topic_id, 'AI_Generated', 1, md5({_sql_text(_PROMPT_HEAD)} || docs || {_sql_text(_PROMPT_MIDDLE)} || words || {_sql_text(_PROMPT_TAIL)}), 1.0 FROM kw JOIN dl USING (topic_id)"""
)
def f10_aspect_chain(spark: SparkSession, sf: str) -> DataFrame:
    start = source_candidates(spark, sf)
    chosen = source_representative(spark, sf)
    texts = represent.with_documents(stage(chosen, "chosen"), C.documents(spark, sf)).select("topic_id", "rank", "document")

    def label(diverse: DataFrame) -> DataFrame:
        return represent.llm_labels(represent.label_prompts(diverse, texts), C.HashProvider(plain=True), backoff=None)

    rows = represent.run_aspects(
        start,
        {"Diverse": [lambda t: represent.mmr(t, C.ENCODER)], "AI_Generated": [lambda t: represent.mmr(t, C.ENCODER), label]},
    )
    return rows.where(F.col("aspect") != "Main").withColumn("weight", F.round("weight", 9))


@query(f"WITH {SOURCE_RANKED} SELECT topic_id, string_agg(term, ', ' ORDER BY rank) AS words FROM rk WHERE rank <= 10 GROUP BY topic_id")
def b15_topic_words(spark: SparkSession, sf: str) -> DataFrame:
    return represent.topic_words(source_terms(spark, sf))


# --------------------------------------------------------------------------------------------- label lookups
# Every second source has a predefined label.
_FIXED = "fx AS (SELECT DISTINCT topic_id, CASE WHEN topic_id % 2 = 0 THEN 'Source ' || topic_id END AS label FROM st)"


def source_labels(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("topic_id") % 2 == 0, F.concat(F.lit("Source "), F.col("topic_id").cast("string")))
    return C.source_topics(spark, sf).select("topic_id").distinct().withColumn("label", label)


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return topics.topic_labels(represent.default_labels(source_terms(spark, sf)), source_labels(spark, sf))


_NAMES = f"{SOURCE_RANKED}, {_LABELS}, {_FIXED}, nm AS (SELECT gl.topic_id, coalesce(fx.label, gl.label) AS label FROM gl LEFT JOIN fx USING (topic_id))"


@query(f"WITH {_NAMES} SELECT doc_id, st.topic_id, label FROM st LEFT JOIN nm USING (topic_id)")
def c4_label_documents(spark: SparkSession, sf: str) -> DataFrame:
    return topics.label_documents(C.source_topics(spark, sf), _names(spark, sf)).select("doc_id", "topic_id", "label")


_LABELLED_SQL = f"""WITH {_NAMES}
SELECT st.topic_id, (d.doc_id % 4) / 4.0::DOUBLE AS probability, nm.label AS topic_name, gl.label AS llm_topic_name, d.text AS document
FROM documents d JOIN st USING (doc_id) LEFT JOIN nm USING (topic_id) LEFT JOIN gl USING (topic_id)"""


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    assigned = C.source_topics(spark, sf).withColumn("probability", (F.col("doc_id") % 4) / F.lit(4.0))
    generated = represent.default_labels(source_terms(spark, sf))
    return topics.labelled_result(assigned, C.documents(spark, sf), _names(spark, sf), generated)


@query(_LABELLED_SQL)
def c5_labelled_result(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf)


@query(_LABELLED_SQL)
def a6_write_labels(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels-out")
    tables.write_labels(_labelled(spark, sf), path)
    return spark.read.parquet(path)


@query(f"WITH {SOURCE_RANKED} SELECT CAST(rank AS INT) AS rank, term, round(weight, 9) AS weight FROM rk WHERE rank <= 10 AND topic_id = 3")
def c6_get_topic(spark: SparkSession, sf: str) -> DataFrame:
    return topics.get_topic(source_terms(spark, sf), 3).withColumn("weight", F.round("weight", 9))


@query(f"WITH {_NAMES} SELECT topic_id, label FROM nm")
def c7_topic_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf)


_LANGUAGE_WEIGHTS = f"{C.ZERO_SHOT}, {C.ctfidf_sql('lt')}"
_LANGUAGE_RANKED = f"{_LANGUAGE_WEIGHTS}, {C.RANKED}, {_LABELS}"


@query(
    f"""WITH {_LANGUAGE_RANKED}
SELECT topic_id, CASE WHEN topic_id = -1 THEN '{V.OUTLIER_LABEL}' ELSE coalesce(pt.label, gl.label) END AS label
FROM gl LEFT JOIN pt ON pt.idx = gl.topic_id"""
)
def c8_set_topic_labels(spark: SparkSession, sf: str) -> DataFrame:
    generated = represent.default_labels(terms.top_terms(C.language_weights(spark, sf), 10))
    custom = C.first_of_language(spark, sf).select(F.col("idx").alias("topic_id"), "label")
    return topics.set_topic_labels(generated, custom)


# ------------------------------------------------------------------------------------------------- embeddings
@query(f"WITH {C.RAW_VECTORS} SELECT doc_id, CAST(b AS INT) AS bucket, round(w, 6) AS value FROM rv")
def d6_embed(spark: SparkSession, sf: str) -> DataFrame:
    rows = embedding.embed(C.documents(spark, sf), C.ENCODER).select("doc_id", F.posexplode("vec").alias("bucket", "value"))
    return rows.where(F.col("value") != 0).withColumn("value", F.round("value", 6))


@query(f"WITH {C.RAW_VECTORS} SELECT doc_id, CAST(b AS INT) AS bucket, round(CAST(w AS FLOAT)::DOUBLE, 6) AS value FROM rv")
def a7_vector_store(spark: SparkSession, sf: str) -> DataFrame:
    """Save vectors of every document but the German ones, find what is missing, add it, reload."""
    path = scratch_path(spark, "vectors")
    docs = C.documents(spark, sf)
    vecs = C.raw_vectors(spark, sf).where(F.col("vec").isNotNull())
    part = docs.where(F.col("lang") != "de").select("doc_id")
    vector_store.save_vectors(vecs.join(part, "doc_id", "left_semi"), path, C.ENCODER.encoder_id)
    missing = vector_store.missing_vectors(docs, vector_store.load_vectors(spark, path, C.ENCODER.encoder_id))
    vector_store.save_vectors(C.ENCODER.vectors(missing).where("vec is not null"), path, C.ENCODER.encoder_id)
    rows = vector_store.load_vectors(spark, path, C.ENCODER.encoder_id)
    values = rows.select("doc_id", F.posexplode("vec").alias("bucket", "value")).where("value <> 0")
    return values.withColumn("value", F.round("value", 6))


@query(f"WITH {C.CENTRED}, {C.PROTOTYPES} SELECT idx, label, CAST(b AS INT) AS dim, round(x, 6) AS value FROM pv JOIN pt USING (idx)")
def e1_topic_prototypes(spark: SparkSession, sf: str) -> DataFrame:
    """The first document of each language as the text that describes a topic."""
    chosen = C.first_of_language(spark, sf).join(C.documents(spark, sf).select("doc_id", "document"), "doc_id")
    mean = X.mean_vector(C.raw_vectors(spark, sf))
    rows = embedding.topic_prototypes(chosen.select("idx", F.col("document").alias("label")), C.ENCODER, mean)
    named = rows.select("idx", "vec").join(chosen.select("idx", "label"), "idx")
    return named.select("idx", "label", F.posexplode("vec").alias("dim", "value")).withColumn("value", F.round("value", 6))


@query(f"WITH {C.ZERO_SHOT} SELECT doc_id, coalesce(idx, -1) AS idx, round(similarity, 6) AS similarity FROM zs")
def e2_zero_shot(spark: SparkSession, sf: str) -> DataFrame:
    rows = zeroshot.assign_zero_shot(C.centred_vectors(spark, sf), C.prototypes(spark, sf), C.SCALE)
    return rows.select("doc_id", F.coalesce("idx", F.lit(-1)).alias("idx"), F.round("similarity", 6).alias("similarity"))


@query(
    """WITH l AS (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label),
v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS b FROM embeddings),
n AS (SELECT vec_id, b, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM v),
s AS (SELECT n.vec_id, l.label, round(sum(n.x * p.x), 12) AS s FROM n JOIN n p USING (b) JOIN l ON l.vec_id = p.vec_id GROUP BY n.vec_id, l.label),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS r FROM s)
SELECT vec_id AS doc_id, CASE WHEN round(s, 6) >= 0.2 THEN label ELSE -1 END AS idx, round(s, 6) AS similarity FROM r WHERE r = 1"""
)
def e2_zero_shot_given_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors that come with the data; the first vector of each label stands for a topic."""
    vecs = C.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    first = vecs.groupBy("label").agg(F.min_by("vec", "doc_id").alias("vec")).select(F.col("label").alias("idx"), "vec")
    rows = zeroshot.assign_zero_shot(vecs, first, 0.2)
    return rows.select("doc_id", F.coalesce("idx", F.lit(-1)).alias("idx"), F.round("similarity", 6).alias("similarity"))


# --------------------------------------------------------------------------------------------------- clusters
# Settings that give seven clusters, two of them of one size, on the data that results are compared on.
K, WIDTH, REACH2, MIN_PTS, MIN_SIZE = 2, 0.05, 1, 4, 10
# The projection and the neighbour graph have three dimensions, where a cell has more neighbours than the graph keeps.
GRAPH_K, GRAPH_WIDTH, GRAPH_REACH2 = 3, 0.15, 2
# A finer grid on which clusters split at several of its distances.
FINE_WIDTH, FINE_REACH2 = 0.03, 5


def _low_sql(vectors: str, k: int = K) -> str:
    return f"""
sg AS (SELECT c, b, CASE WHEN ('0x' || substr(md5('42:' || c || ':' || b), 1, 1))::INT < 8 THEN 1 ELSE -1 END / sqrt({k}) AS s
       FROM (SELECT unnest(range({k})) AS c) CROSS JOIN (SELECT unnest(range(256)) AS b)),
lw AS (SELECT doc_id, c, sum(x * s) AS v FROM {vectors} JOIN sg USING (b) GROUP BY doc_id, c)"""


_LOW = _low_sql("cv")
_AXES = ", ".join(neighbours.cell_columns(K))


def _grid_sql(width: float, reach2: int, k: int = K) -> str:
    axes = ", ".join(neighbours.cell_columns(k))
    apart = " + ".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in neighbours.cell_columns(k))
    return f"""
gp AS (SELECT doc_id, {", ".join(f"max(CASE WHEN c = {i} THEN CAST(floor(round(v, 6) / {width}) AS INT) END) AS c{i}" for i in range(k))} FROM lw GROUP BY doc_id),
ce AS (SELECT {axes}, min(doc_id) AS cell_id, count(*) AS weight FROM gp GROUP BY {axes}),
al AS (SELECT a.cell_id AS src, b.cell_id AS dst, CAST({apart} AS INT) AS d2, b.weight FROM ce a JOIN ce b ON {apart} <= {reach2})"""


_GRID = _grid_sql(WIDTH, REACH2)

_DENSE = f"""
cu AS (SELECT src, d2, sum(sum(weight)) OVER (PARTITION BY src ORDER BY d2) AS seen FROM al GROUP BY src, d2),
co AS (SELECT src AS cell_id, min(d2) AS core_d2 FROM cu WHERE seen >= {MIN_PTS} GROUP BY src),
rc AS (SELECT cell_id AS node, cell_id AS reached FROM co
       UNION SELECT rc.node, al.dst FROM rc JOIN al ON al.src = rc.reached JOIN co ON co.cell_id = al.dst),
cc AS (SELECT node AS cell_id, min(reached) AS component FROM rc GROUP BY node),
sz AS (SELECT component, sum(weight) AS size FROM cc JOIN ce USING (cell_id) GROUP BY component),
cl AS (SELECT ce.cell_id, CAST(ce.weight AS BIGINT) AS weight, co.core_d2, CASE WHEN sz.size >= {MIN_SIZE} THEN cc.component END AS cluster
       FROM ce LEFT JOIN co USING (cell_id) LEFT JOIN cc USING (cell_id) LEFT JOIN sz USING (component)),
pl AS (SELECT doc_id, cluster, CASE WHEN cluster IS NULL THEN 0 ELSE greatest(0, 1 - sqrt(core_d2) / sqrt({REACH2})) END AS probability
       FROM gp JOIN ce USING ({_AXES}) JOIN cl USING (cell_id))"""


_CELLS = f"{C.CENTRED}, {_LOW}, {_GRID}"
_CLUSTERS = f"{_CELLS}, {_DENSE}"


@query(f"WITH {C.CENTRED}, {_low_sql('cv', GRAPH_K)} SELECT doc_id, CAST(c AS INT) AS component, round(v, 6) AS value FROM lw")
def e3_random_projection(spark: SparkSession, sf: str) -> DataFrame:
    low = reduction.reduce_dims(C.centred_vectors(spark, sf), GRAPH_K, "projection", 256)
    return low.select("doc_id", F.posexplode("low").alias("component", "value")).withColumn("value", F.round("value", 6))


@query()
def e3_pca(spark: SparkSession, sf: str) -> DataFrame:
    return reduction.reduce_dims(C.centred_vectors(spark, sf), 5, "pca")


grid_points = shared(
    "grid-points",
    lambda spark, sf: neighbours.grid_points(reduction.reduce_dims(C.centred_vectors(spark, sf), K, "projection", 256), WIDTH, K),
)
grid_cells = shared("grid-cells", lambda spark, sf: neighbours.grid_cells(grid_points(spark, sf), K))
grid_edges = shared("grid-edges", lambda spark, sf: neighbours.neighbour_edges(grid_cells(spark, sf), K, REACH2))


_GRAPH = f"{C.CENTRED}, {_low_sql('cv', GRAPH_K)}, {_grid_sql(GRAPH_WIDTH, GRAPH_REACH2, GRAPH_K)}"


@query(f"WITH {_GRAPH}, r AS (SELECT src, dst, d2, row_number() OVER (PARTITION BY src ORDER BY d2, dst) AS rank FROM al WHERE src <> dst) SELECT src, dst, d2, CAST(rank AS INT) AS rank FROM r WHERE rank <= 15")
def e4_neighbour_graph(spark: SparkSession, sf: str) -> DataFrame:
    low = reduction.reduce_dims(C.centred_vectors(spark, sf), GRAPH_K, "projection", 256)
    cells = stage(neighbours.grid_cells(neighbours.grid_points(low, GRAPH_WIDTH, GRAPH_K), GRAPH_K), "graph-cells")
    return neighbours.knn_edges(neighbours.neighbour_edges(cells, GRAPH_K, GRAPH_REACH2), 15)


@query(
    f"""WITH {C.CENTRED},
vl AS (SELECT doc_id, list(x ORDER BY b) AS v, md5(string_agg(CAST(round(x, 9) + 0.0 AS VARCHAR), ',' ORDER BY b)) AS k FROM cv GROUP BY doc_id),
vr AS (SELECT min(doc_id) AS doc_id, count(*) AS weight, arg_min(v, doc_id) AS v FROM vl GROUP BY k),
vs AS (SELECT a.doc_id AS src, b.doc_id AS dst, b.weight, round(list_inner_product(a.v, b.v), 9) AS similarity FROM vr a JOIN vr b ON a.doc_id <> b.doc_id)
SELECT src, CAST(row_number() OVER (PARTITION BY src ORDER BY similarity DESC, dst) AS INT) AS rank, dst, round(similarity, 6) AS similarity, weight
FROM vs QUALIFY rank <= 5"""
)
def e4_document_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest documents by their whole vectors; with as many documents as SQL compares pair by pair, one cell holds them."""
    return document_neighbours.document_neighbours(C.centred_vectors(spark, sf), 5).withColumn("similarity", F.round("similarity", 6))


def dense_cells(spark: SparkSession, sf: str) -> DataFrame:
    return density.cluster_density(grid_cells(spark, sf), grid_edges(spark, sf), MIN_PTS, REACH2, MIN_SIZE)


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT cell_id, weight, coalesce(core_d2, -1) AS core_d2, coalesce(cluster, -1) AS cluster FROM cl")
def e5_density_clusters(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(-1)
    return dense_cells(spark, sf).select("cell_id", "weight", F.coalesce("core_d2", none).alias("core_d2"), F.coalesce("cluster", none).alias("cluster"))


fine_points = shared(
    "fine-points",
    lambda spark, sf: neighbours.grid_points(reduction.reduce_dims(C.centred_vectors(spark, sf), K, "projection", 256), FINE_WIDTH, K),
)
fine_cells = shared("fine-cells", lambda spark, sf: neighbours.grid_cells(fine_points(spark, sf), K))
fine_edges = shared("fine-edges", lambda spark, sf: neighbours.neighbour_edges(fine_cells(spark, sf), K, FINE_REACH2))

# Links between core cells in the order of the forest; a link belongs to it unless lighter ones join its ends already.
_FINE = f"""{C.CENTRED}, {_LOW}, {_grid_sql(FINE_WIDTH, FINE_REACH2)},
cu AS (SELECT src, d2, sum(sum(weight)) OVER (PARTITION BY src ORDER BY d2) AS seen FROM al GROUP BY src, d2),
co AS (SELECT src AS cell_id, min(d2) AS core_d2 FROM cu WHERE seen >= {MIN_PTS} GROUP BY src),
mr AS (SELECT al.src, al.dst, greatest(d2, a.core_d2, b.core_d2) AS w FROM al JOIN co a ON a.cell_id = src JOIN co b ON b.cell_id = dst WHERE src <> dst)"""

_FOREST = f"""{_FINE},
fo AS (SELECT src AS u, dst AS v, w, row_number() OVER (ORDER BY w, src, dst) AS e FROM mr WHERE src < dst),
fb AS (SELECT e, u AS a, v AS b FROM fo UNION ALL SELECT e, v, u FROM fo),
fw AS (SELECT e, u AS node FROM fo UNION SELECT fw.e, fb.b FROM fw JOIN fb ON fb.a = fw.node AND fb.e < fw.e)"""


@query(f"WITH RECURSIVE {_FOREST} SELECT u, v, w FROM fo WHERE NOT EXISTS (SELECT 1 FROM fw WHERE fw.e = fo.e AND fw.node = fo.v)")
def e5h_spanning_forest(spark: SparkSession, sf: str) -> DataFrame:
    return density.reach_forest(fine_cells(spark, sf), fine_edges(spark, sf), MIN_PTS, FINE_REACH2)[2]


fine_measured = shared("fine-measured", lambda spark, sf: density.core_distances(fine_cells(spark, sf), fine_edges(spark, sf), MIN_PTS, FINE_REACH2))
fine_forest = shared("fine-forest", lambda spark, sf: spanning.spanning_forest(density.mutual_reachability(fine_measured(spark, sf), fine_edges(spark, sf))))


def fine_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return density.forest_nodes(fine_measured(spark, sf))


# Parts at every distance, and what each holds: the mass of its line, that of the clusters it splits into, and what it hangs on.
_PARTS = f"""{_FINE},
lv AS (SELECT unnest(range({FINE_REACH2 + 1})) AS level),
rc AS (SELECT level, cell_id AS node, cell_id AS reached FROM co JOIN lv ON core_d2 <= level
       UNION SELECT rc.level, rc.node, mr.dst FROM rc JOIN mr ON mr.src = rc.reached AND mr.w <= rc.level),
hk AS (SELECT level, node, min(reached) AS component FROM rc GROUP BY level, node),
hs AS (SELECT level, component, sum(weight) AS size FROM hk JOIN ce ON ce.cell_id = node GROUP BY ALL HAVING sum(weight) >= {MIN_SIZE}),
hp AS (SELECT hs.*, hk.component AS parent FROM hs LEFT JOIN hk ON hk.level = hs.level + 1 AND hk.node = hs.component),
hr AS (SELECT hp.*, count(*) OVER (PARTITION BY hp.level, parent) AS rivals FROM hp)"""
_MASSES = density.level_masses(FINE_REACH2)
for _l in range(FINE_REACH2 + 1):
    _below = f"""LEFT JOIN (SELECT parent, count(*) AS n, sum(own) AS own, sum(inside) AS inside, sum(greatest(own, inside)) AS best
          FROM v{_l - 1} JOIN hr USING (component) WHERE hr.level = {_l - 1} GROUP BY parent) k ON k.parent = hr.component"""
    _PARTS += f""",
v{_l} AS (SELECT component, size * CAST({_MASSES[_l]} AS DOUBLE) {"+ CASE WHEN n = 1 THEN own ELSE 0 END" if _l else ""} AS own,
        {"CASE WHEN n = 1 THEN inside WHEN n > 1 THEN best ELSE 0 END" if _l else "0"} AS inside FROM hr {_below if _l else ""} WHERE hr.level = {_l})"""
for _l in range(FINE_REACH2, -1, -1):
    _goes, _up = ("rivals = 1", f"LEFT JOIN t{_l + 1} t ON t.component = hr.parent") if _l < FINE_REACH2 else ("false", "")
    _from = (lambda name: f"t.{name}") if _l < FINE_REACH2 else (lambda name: "NULL")
    _PARTS += f""",
t{_l} AS (SELECT {_l} AS level, hr.component, hr.size, CASE WHEN {_goes} THEN {_from("leader")} ELSE hr.component END AS leader, CASE WHEN {_goes} THEN {_from("born")} ELSE {_l} END AS born,
        CAST(CASE WHEN {_goes} THEN {_from("parent_leader")} ELSE {_from("leader")} END AS BIGINT) AS parent_leader,
        CAST(CASE WHEN {_goes} THEN {_from("parent_born")} ELSE {_from("born")} END AS INT) AS parent_born,
        CASE WHEN {_goes} THEN {_from("stability")} ELSE own END AS stability,
        CASE WHEN {_goes} THEN {_from("kept")} ELSE round(own, 9) >= round(inside, 9) END AS kept,
        CASE WHEN {_goes} THEN {_from("free")} ELSE {"coalesce(t.free AND NOT t.kept, true)" if _l < FINE_REACH2 else "true"} END AS free
        FROM hr JOIN v{_l} USING (component) {_up} WHERE hr.level = {_l})"""
_PARTS += ",\nta AS (" + " UNION ALL ".join(f"SELECT * FROM t{_l}" for _l in range(FINE_REACH2 + 1)) + ")"


@query(
    f"""WITH RECURSIVE {_PARTS} SELECT leader, CAST(born AS INT) AS born, min(level) AS last, CAST(max(size) AS BIGINT) AS size, round(any_value(stability), 6) AS stability,
coalesce(any_value(parent_leader), -1) AS parent_leader, coalesce(any_value(parent_born), -1) AS parent_born FROM ta GROUP BY leader, born"""
)
def e5h_condensed_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Every cluster of the hierarchy with the distances it lives at and its stability."""
    members = spanning.forest_members(fine_nodes(spark, sf), fine_forest(spark, sf), FINE_REACH2)
    parts = spanning.member_parts(members, MIN_SIZE)
    tree = spanning.condense(parts, FINE_REACH2, _MASSES)
    none = F.lit(-1)
    return tree.withColumns({"stability": F.round("stability", 6), "parent_leader": F.coalesce("parent_leader", none), "parent_born": F.coalesce("parent_born", none)})


@query(
    f"""WITH RECURSIVE {_PARTS}, ch AS (SELECT DISTINCT leader, born FROM ta WHERE kept AND free)
SELECT ce.cell_id, CAST(ce.weight AS BIGINT) AS weight, coalesce(core_d2, -1) AS core_d2, coalesce(leader, -1) AS cluster FROM ce LEFT JOIN co USING (cell_id)
LEFT JOIN (SELECT node AS cell_id, leader FROM hk JOIN ch ON ch.born = hk.level AND ch.leader = hk.component) USING (cell_id)"""
)
def e5h_hierarchical_clusters(spark: SparkSession, sf: str) -> DataFrame:
    found = density.cluster_hierarchical(fine_cells(spark, sf), fine_edges(spark, sf), MIN_PTS, FINE_REACH2, MIN_SIZE)
    none = F.lit(-1)
    return found.select("cell_id", "weight", F.coalesce("core_d2", none).alias("core_d2"), F.coalesce("cluster", none).alias("cluster"))


@query(f"WITH RECURSIVE {_PARTS} SELECT node, hk.component FROM hk JOIN hs USING (level, component) WHERE level = 2")
def e5h_cut_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """The forest cut at one distance: the flat clusters there, without a look at the links that are not in it."""
    members = stage(spanning.cut_forest(fine_nodes(spark, sf), fine_forest(spark, sf), 2), "cut")
    large = members.groupBy("component").agg(F.sum("weight").alias("size"), F.count("*").alias("matches")).where(F.col("size") >= MIN_SIZE)
    return hot_lookup(members, large, ["component"], "matches").select("node", "component")


@query(
    f"""WITH RECURSIVE {_CELLS},
rc AS (SELECT cell_id AS node, cell_id AS reached FROM ce UNION SELECT rc.node, al.dst FROM rc JOIN al ON al.src = rc.reached)
SELECT node, min(reached) AS component FROM rc GROUP BY node HAVING count(*) > 1"""
)
def e6_components(spark: SparkSession, sf: str) -> DataFrame:
    return components(grid_edges(spark, sf).select(F.col("src").alias("u"), F.col("dst").alias("v")))


clusters = shared(
    "clusters",
    lambda spark, sf: density.label_points(grid_points(spark, sf), grid_cells(spark, sf), stage(dense_cells(spark, sf), "found"), K, REACH2),
)

_NUMBERED = """
un AS (SELECT zs.doc_id, CASE WHEN idx IS NOT NULL THEN 'predefined' WHEN cluster IS NOT NULL THEN 'cluster' ELSE 'outlier' END AS kind,
       CAST(coalesce(idx, cluster) AS VARCHAR) AS source,
       CASE WHEN idx IS NOT NULL THEN similarity WHEN cluster IS NOT NULL THEN pl.probability ELSE 0 END AS probability
       FROM zs LEFT JOIN pl USING (doc_id)),
us AS (SELECT kind, source, count(*) AS size FROM un GROUP BY kind, source),
tp AS (SELECT CAST(row_number() OVER (ORDER BY kind = 'cluster', CASE WHEN kind = 'predefined' THEN CAST(source AS BIGINT) ELSE -size END, CAST(source AS BIGINT)) - 1 AS INT) AS topic_id,
       kind, source, size FROM us WHERE kind <> 'outlier'
       UNION ALL SELECT -1, kind, source, size FROM us WHERE kind = 'outlier')"""


_UNITED = f"{C.ZERO_SHOT}, {_LOW}, {_GRID}, {_DENSE}, {_NUMBERED}"


@query(f"WITH RECURSIVE {_UNITED} SELECT doc_id, kind, source, round(probability, 6) AS probability FROM un")
def c9_unite_assignments(spark: SparkSession, sf: str) -> DataFrame:
    rows = topics.unite_assignments(C.zero_shot(spark, sf), clusters(spark, sf))
    return rows.withColumn("probability", F.round("probability", 6))


@query(f"WITH RECURSIVE {_UNITED} SELECT topic_id, kind, tp.source, pt.label, size FROM tp LEFT JOIN pt ON kind = 'predefined' AND CAST(pt.idx AS VARCHAR) = tp.source")
def e7_combine_topics(spark: SparkSession, sf: str) -> DataFrame:
    labels = C.first_of_language(spark, sf).select("idx", "label")
    return topics.combine_topics(C.zero_shot(spark, sf), clusters(spark, sf), labels)[1]


@query(f"WITH RECURSIVE {_UNITED} SELECT doc_id, topic_id, round(probability, 6) AS probability FROM un JOIN tp ON un.kind = tp.kind AND un.source IS NOT DISTINCT FROM tp.source")
def e8_assignment_probability(spark: SparkSession, sf: str) -> DataFrame:
    rows = topics.combine_topics(C.zero_shot(spark, sf), clusters(spark, sf))[0]
    return rows.withColumn("probability", F.round("probability", 6))


# --------------------------------------------------------------------------------------------------- relations
_SIMILARITY = f"""{SOURCE_WEIGHTS},
sn AS (SELECT topic_id, sqrt(sum(weight * weight)) AS n FROM cw GROUP BY topic_id),
sp AS (SELECT a.topic_id AS topic_a, b.topic_id AS topic_b, sum(a.weight * b.weight) AS dot
       FROM cw a JOIN cw b ON a.term = b.term AND a.topic_id < b.topic_id GROUP BY a.topic_id, b.topic_id),
sm AS (SELECT x.topic_id AS topic_a, y.topic_id AS topic_b, coalesce(dot, 0) / (x.n * y.n) AS similarity
       FROM sn x JOIN sn y ON x.topic_id < y.topic_id LEFT JOIN sp ON sp.topic_a = x.topic_id AND sp.topic_b = y.topic_id)"""

_MERGES = f"""{_SIMILARITY},
me AS (SELECT topic_a AS l, topic_b AS r, round(1 - similarity, 9) AS distance,
       row_number() OVER (ORDER BY round(1 - similarity, 9), topic_a, topic_b) AS e FROM sm),
mw AS (SELECT e, l AS node FROM me
       UNION SELECT mw.e, CASE WHEN me.l = mw.node THEN me.r ELSE me.l END FROM mw JOIN me ON me.e < mw.e AND (me.l = mw.node OR me.r = mw.node)),
ms AS (SELECT CAST(row_number() OVER (ORDER BY e) AS INT) AS step, l, r, distance FROM me
       WHERE NOT EXISTS (SELECT 1 FROM mw WHERE mw.e = me.e AND mw.node = me.r))"""


@query(f"WITH {_SIMILARITY} SELECT topic_a, topic_b, round(similarity, 6) AS similarity FROM sm WHERE similarity > 0")
def g3_topic_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return relations.topic_similarity(C.source_weights(spark, sf)).withColumn("similarity", F.round("similarity", 6))


def source_merges(spark: SparkSession, sf: str) -> DataFrame:
    return relations.topic_tree(C.source_weights(spark, sf))


@query(f"""WITH RECURSIVE {_MERGES} SELECT step, l AS "left", r AS "right", round(distance, 6) AS distance FROM ms""")
def g4_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    return source_merges(spark, sf).withColumn("distance", F.round("distance", 6))


# What a merge joins: the last merge before it that holds its left end, and its right end, or the topic itself.
_DENDROGRAM = f"""{_MERGES},
nd AS (SELECT topic_id, count(*) AS n_docs FROM st GROUP BY topic_id),
dr AS (SELECT step, 0 AS side, l AS reached FROM ms UNION ALL SELECT step, 1, r FROM ms
       UNION SELECT dr.step, dr.side, CASE WHEN ms.l = dr.reached THEN ms.r ELSE ms.l END FROM dr JOIN ms ON ms.step < dr.step AND (ms.l = dr.reached OR ms.r = dr.reached)),
dc AS (SELECT dr.step, side, coalesce((SELECT max(topic_id) FROM st) + max(ms.step), min(reached)) AS child
       FROM dr LEFT JOIN ms ON ms.step < dr.step AND ms.l = dr.reached GROUP BY dr.step, side),
ds AS (SELECT step, min(reached) AS topic_id, sum(n_docs) AS size FROM dr JOIN nd ON nd.topic_id = reached GROUP BY step)"""


@query(
    f"""WITH RECURSIVE {_DENDROGRAM}, {C.RANKED}, {_LABELS}, {_FIXED}, nm AS (SELECT gl.topic_id, coalesce(fx.label, gl.label) AS label FROM gl LEFT JOIN fx USING (topic_id))
SELECT CAST((SELECT max(topic_id) FROM st) + step AS INT) AS node, CAST(least(a.child, b.child) AS INT) AS "left", CAST(greatest(a.child, b.child) AS INT) AS "right",
       ds.topic_id, round(distance, 6) AS distance, CAST(size AS BIGINT) AS size, label
FROM ms JOIN (SELECT * FROM dc WHERE side = 0) a USING (step) JOIN (SELECT * FROM dc WHERE side = 1) b USING (step) JOIN ds USING (step) LEFT JOIN nm ON nm.topic_id = ds.topic_id"""
)
def g4_dendrogram(spark: SparkSession, sf: str) -> DataFrame:
    sizes = C.source_topics(spark, sf).groupBy("topic_id").agg(F.count("*").alias("size"))
    leaves = sizes.join(_names(spark, sf), "topic_id", "left")
    return relations.dendrogram(source_merges(spark, sf), leaves).withColumn("distance", F.round("distance", 6))


@query(
    f"""WITH RECURSIVE {_MERGES},
kp AS (SELECT l, r FROM ms WHERE step <= (SELECT count(*) FROM sn) - 12),
mr AS (SELECT topic_id, topic_id AS reached FROM sn
       UNION SELECT mr.topic_id, CASE WHEN kp.l = mr.reached THEN kp.r ELSE kp.l END FROM mr JOIN kp ON kp.l = mr.reached OR kp.r = mr.reached)
SELECT doc_id, m.merged AS topic_id FROM st JOIN (SELECT topic_id, min(reached) AS merged FROM mr GROUP BY topic_id) m USING (topic_id)"""
)
def e9_reduce_topics(spark: SparkSession, sf: str) -> DataFrame:
    merged = topics.merge_map(stage(source_merges(spark, sf), "merges"), source_labels(spark, sf), 12)
    assigned = C.source_topics(spark, sf).withColumn("probability", F.lit(1.0))
    return topics.reduce_topics(assigned, merged).select("doc_id", "topic_id")


@query()
def g1_intertopic_map(spark: SparkSession, sf: str) -> DataFrame:
    sizes = C.source_topics(spark, sf).groupBy("topic_id").agg(F.count("*").alias("n_docs"))
    return relations.intertopic_map(source_centroids(spark, sf), sizes, _names(spark, sf))


@query(
    f"""WITH {_LANGUAGE_RANKED},
n AS (SELECT topic_id, count(*) AS n_docs FROM lt WHERE topic_id >= 0 GROUP BY topic_id),
p AS (SELECT *, row_number() OVER (ORDER BY n_docs DESC, topic_id) AS place FROM n)
SELECT CAST(place AS INT) AS place, topic_id, n_docs, CAST(rank AS INT) AS rank, term, round(weight, 9) AS weight FROM p JOIN rk USING (topic_id) WHERE place <= 3 AND rank <= 5"""
)
def g2_top_topics(spark: SparkSession, sf: str) -> DataFrame:
    rows = relations.top_topics(C.language_topics(spark, sf), terms.top_terms(C.language_weights(spark, sf), 10), 3)
    return rows.withColumn("weight", F.round("weight", 9))


# ----------------------------------------------------------------------------------------------- distributions
def _distribution_sql(docs: str = "documents") -> str:
    """CTEs of the window distribution over ``docs`` with the weights in ``cw``, as a plain window join."""
    return rf"""
ht AS (SELECT doc_id, {C.TOKENS} AS t FROM {docs}),
hs AS (SELECT doc_id, t, len(t) AS n, unnest(range(greatest(len(t) - 4, 0) + 1)) AS start FROM ht WHERE len(t) > 0),
hx AS (SELECT doc_id, n, start, unnest(t[start + 1:start + 4]) AS term FROM hs),
hc AS (SELECT doc_id, n, start, term, count(*) AS c FROM hx GROUP BY ALL),
hn AS (SELECT doc_id, start, sqrt(sum(c * c)) AS norm FROM hc GROUP BY ALL),
wn AS (SELECT topic_id, sqrt(sum(weight * weight)) AS topic_norm FROM cw GROUP BY topic_id),
hd AS (SELECT doc_id, n, start, topic_id, sum(c * weight) AS dot FROM hc JOIN cw USING (term) WHERE topic_id >= 0 GROUP BY ALL),
hw AS (SELECT doc_id, n, start, topic_id, dot / (norm * topic_norm) AS score FROM hd JOIN hn USING (doc_id, start) JOIN wn USING (topic_id)
       WHERE round(dot / (norm * topic_norm), 9) >= 0.1),
hm AS (SELECT doc_id, topic_id, sum(score) AS mass FROM hw GROUP BY doc_id, topic_id),
h1 AS (SELECT doc_id, topic_id, mass / sum(mass) OVER (PARTITION BY doc_id) AS p FROM hm),
hp AS (SELECT doc_id, topic_id, score, unnest(range(start, least(start + 4, n))) AS pos FROM hw),
h2 AS (SELECT doc_id, CAST(pos AS INT) AS pos, topic_id, sum(score) AS p FROM hp GROUP BY doc_id, pos, topic_id)"""


@query(f"WITH {SOURCE_WEIGHTS}, {_distribution_sql()} SELECT doc_id, topic_id, round(p, 6) AS p FROM h1")
def h1_distribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = distribution.approximate_distribution(C.documents(spark, sf), C.source_weights(spark, sf))
    return rows.withColumn("p", F.round("p", 6))


@query(f"WITH {_LANGUAGE_WEIGHTS}, {_distribution_sql()} SELECT doc_id, pos, t[pos + 1] AS term, topic_id, round(p, 6) AS p FROM h2 JOIN ht USING (doc_id)")
def h2_token_distribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = distribution.token_distribution(C.documents(spark, sf), C.language_weights(spark, sf))
    return rows.withColumn("p", F.round("p", 6))


_LONGEST = "(SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 1)"


def longest_document(spark: SparkSession, sf: str) -> DataFrame:
    order = C.table(spark, sf, "documents").orderBy(F.desc("n_chars"), "doc_id")
    return order.select("doc_id", F.col("text").alias("document")).limit(1)


@query(
    f"""WITH {_LANGUAGE_WEIGHTS}, {_distribution_sql()}
SELECT topic_id, pt.label, round(p, 6) AS p FROM h1 LEFT JOIN pt ON pt.idx = topic_id WHERE h1.doc_id = {_LONGEST} AND round(p, 9) >= 0.01"""
)
def g5_shown_distribution(spark: SparkSession, sf: str) -> DataFrame:
    longest = stage(longest_document(spark, sf), "longest")
    labels = C.first_of_language(spark, sf).select(F.col("idx").alias("topic_id"), "label")
    soft = distribution.approximate_distribution(longest, C.language_weights(spark, sf))
    return distribution.shown_distribution(soft, labels, longest.first()["doc_id"], 0.01).withColumn("p", F.round("p", 6))


@query(
    f"""WITH {_LANGUAGE_WEIGHTS}, {_distribution_sql()}
SELECT pos, t[pos + 1] AS term, {", ".join(f"round(coalesce(sum(CASE WHEN topic_id = {t} THEN p END), 0), 6) AS topic_{t}" for t in range(4))}
FROM h2 JOIN ht USING (doc_id) WHERE doc_id = {_LONGEST} GROUP BY pos, t[pos + 1]"""
)
def g6_token_table(spark: SparkSession, sf: str) -> DataFrame:
    longest = stage(longest_document(spark, sf), "longest")
    rows = distribution.token_distribution(longest, C.language_weights(spark, sf))
    shown = distribution.token_table(rows, longest.first()["doc_id"], [0, 1, 2, 3])
    return shown.select("pos", "term", *[F.round(f"topic_{t}", 6).alias(f"topic_{t}") for t in range(4)])


_REASSIGNED = f"""{_LANGUAGE_WEIGHTS},
od AS (SELECT d.* FROM documents d JOIN lt USING (doc_id) WHERE lt.topic_id = -1), {_distribution_sql('od')},
ob AS (SELECT doc_id, topic_id, p, row_number() OVER (PARTITION BY doc_id ORDER BY round(p, 9) DESC, topic_id) AS r FROM h1),
na AS (SELECT lt.doc_id, CASE WHEN lt.topic_id = -1 THEN coalesce(ob.topic_id, -1) ELSE lt.topic_id END AS topic_id,
       CASE WHEN lt.topic_id = -1 THEN coalesce(ob.p, 0) ELSE lt.probability END AS probability
       FROM lt LEFT JOIN (SELECT * FROM ob WHERE r = 1) ob ON ob.doc_id = lt.doc_id)"""


def _reassign(spark: SparkSession, sf: str) -> DataFrame:
    assigned = C.language_topics(spark, sf)
    outliers = assigned.where(F.col("topic_id") == -1).select("doc_id")
    open_docs = C.documents(spark, sf).join(outliers, "doc_id", "left_semi")
    return topics.reduce_outliers(assigned, distribution.approximate_distribution(open_docs, C.language_weights(spark, sf)))


reassigned = shared("reassigned", _reassign)


@query(f"WITH {_REASSIGNED} SELECT doc_id, topic_id, round(probability, 6) AS probability FROM na")
def e11_reduce_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return _reassign(spark, sf).withColumn("probability", F.round("probability", 6))


_UPDATED = (
    f"""WITH {_REASSIGNED},
ut AS (SELECT topic_id, term, sum(tf) AS tf FROM dt JOIN na USING (doc_id) GROUP BY topic_id, term),
ul AS (SELECT topic_id, sum(tf) AS topic_tf FROM ut GROUP BY topic_id),
ua AS (SELECT term, sum(tf) AS term_tf FROM ut GROUP BY term),
uw AS (SELECT topic_id, term, tf / topic_tf * ln(1 + (SELECT avg(topic_tf) FROM ul) / term_tf) AS weight FROM ut JOIN ul USING (topic_id) JOIN ua USING (term)),
ur AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY round(weight, 9) DESC, term) AS rank FROM uw)
SELECT topic_id, 'Main' AS aspect, CAST(rank AS INT) AS rank, term, round(weight, 9) AS weight FROM ur WHERE rank <= 10"""
)


@query(_UPDATED)
def e12_update_topics(spark: SparkSession, sf: str) -> DataFrame:
    weights = terms.ctfidf(terms.topic_terms(C.term_lists(spark, sf), reassigned(spark, sf)))
    return terms.top_terms(weights, 10).withColumn("weight", F.round("weight", 9))


@query(_UPDATED)
def e12_update_by_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the earlier counts and the documents that moved."""
    counts = C.language_weights(spark, sf).drop("weight")
    changed = terms.moved_terms(counts, C.term_lists(spark, sf), C.language_topics(spark, sf), reassigned(spark, sf))
    return terms.top_terms(terms.ctfidf(changed), 10).withColumn("weight", F.round("weight", 9))


# ------------------------------------------------------------------------------------------------ whole models
@query(
    f"""WITH {C.CENTRED}, {C.PROTOTYPES}, {C.SOURCE_TOPICS},
nk AS (SELECT item_id, unnest({C.TOKENS}) AS term FROM benchmark),
nt AS (SELECT item_id, term, count(*) AS tf FROM nk GROUP BY ALL),
nb AS (SELECT item_id, CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 256 AS b, sum(1 + ln(tf)) AS w FROM nt GROUP BY ALL),
nv AS (SELECT item_id, b, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM nb),
nf AS (SELECT i.item_id, mean.b, coalesce(nv.w, 0) - m AS x FROM (SELECT DISTINCT item_id FROM nv) i CROSS JOIN mean LEFT JOIN nv ON nv.item_id = i.item_id AND nv.b = mean.b),
nc AS (SELECT item_id, b, x / sqrt(sum(x * x) OVER (PARTITION BY item_id)) AS x FROM nf),
tm AS (SELECT topic_id + 100 AS topic_id, b, avg(x) AS x FROM cv JOIN st USING (doc_id) GROUP BY topic_id, b),
tu AS (SELECT topic_id, b, x / sqrt(sum(x * x) OVER (PARTITION BY topic_id)) AS x FROM tm),
s AS (SELECT item_id, idx AS topic_id, round(sum(nc.x * pv.x), 12) AS s, 0 AS o, 0.4 AS least FROM nc JOIN pv USING (b) GROUP BY item_id, idx
      UNION ALL SELECT item_id, topic_id, round(sum(nc.x * tu.x), 12), 1, 0.1 FROM nc JOIN tu USING (b) GROUP BY item_id, topic_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY o, s DESC, topic_id) AS r FROM s WHERE round(s, 6) >= least)
SELECT b.item_id AS doc_id, coalesce(r.topic_id, -1) AS topic_id, round(coalesce(s, 0), 6) AS probability
FROM benchmark b LEFT JOIN (SELECT * FROM r WHERE r = 1) r ON r.item_id = b.item_id"""
)
def e13_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Unseen texts against four predefined topics, then against the source centroids."""
    docs = C.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("document"))
    vecs = embedding.centre(embedding.embed(docs, C.ENCODER), X.mean_vector(C.raw_vectors(spark, sf)))
    predefined = C.prototypes(spark, sf).select(F.col("idx").alias("topic_id"), "vec")
    others = source_centroids(spark, sf).withColumn("topic_id", F.col("topic_id") + 100)
    return predict.predict_vectors(vecs, predefined, others, C.SCALE, 0.1).withColumn("probability", F.round("probability", 6))


_PROMPTS = f"""{SOURCE_RANKED}, {_REPRESENTATIVE},
kw AS (SELECT topic_id, string_agg(term, ', ' ORDER BY rank) AS words FROM rk WHERE rank <= 10 GROUP BY topic_id),
dl AS (SELECT topic_id, string_agg('- ' || text, chr(10) ORDER BY rank) AS docs FROM rd JOIN documents USING (doc_id) WHERE rank <= 5 GROUP BY topic_id),
pm AS (SELECT topic_id, {_sql_text(_PROMPT_HEAD)} || docs || {_sql_text(_PROMPT_MIDDLE)} || words || {_sql_text(_PROMPT_TAIL)} AS prompt FROM kw JOIN dl USING (topic_id))"""


@query(f"WITH {_PROMPTS} SELECT topic_id, prompt FROM pm")
def d7_label_prompts(spark: SparkSession, sf: str) -> DataFrame:
    texts = represent.with_documents(stage(source_representative(spark, sf), "chosen"), C.documents(spark, sf))
    return represent.label_prompts(source_terms(spark, sf), texts)


@query(f"WITH {_PROMPTS} SELECT topic_id, 'AI_Generated' AS aspect, 1 AS rank, md5(prompt) AS term FROM pm")
def d7_llm_labels(spark: SparkSession, sf: str) -> DataFrame:
    return represent.llm_labels(d7_label_prompts(spark, sf), C.HashProvider(plain=True), backoff=None).select("topic_id", "aspect", "rank", "term")


def fitted(spark: SparkSession, sf: str, **settings):
    """A model fitted on all documents; the first document of each language describes a predefined topic."""
    docs = C.documents(spark, sf)
    chosen = C.first_of_language(spark, sf).join(C.raw_vectors(spark, sf), "doc_id").select("idx", "label", "vec")
    params = FitParams(min_similarity=C.SCALE, min_topic_size=MIN_SIZE, predict_similarity=0.1, **settings)
    return fit.fit_topics(docs, C.ENCODER, params=params, vecs=C.raw_vectors(spark, sf), prototypes=chosen)


def fitted_by_projection(spark: SparkSession, sf: str):
    """The reduction that SQL can follow."""
    return fitted(spark, sf, components=K, reduction="projection", clusters="flat", width=WIDTH, reach2=REACH2, min_pts=MIN_PTS)


# Clusters are sought among the documents that no predefined topic took.
_FIT = f"""{C.ZERO_SHOT}, ov AS (SELECT cv.* FROM cv JOIN zs USING (doc_id) WHERE idx IS NULL), {_low_sql("ov")}, {_GRID}, {_DENSE}, {_NUMBERED},
fa AS (SELECT doc_id, topic_id, un.kind, probability FROM un JOIN tp ON un.kind = tp.kind AND un.source IS NOT DISTINCT FROM tp.source)"""


@query(f"WITH RECURSIVE {_FIT} SELECT doc_id, topic_id, round(probability, 6) AS probability FROM fa")
def e10_fit_topics(spark: SparkSession, sf: str) -> DataFrame:
    return fitted_by_projection(spark, sf).assignments.withColumn("probability", F.round("probability", 6))


@query()
def e10_fit_topics_pca(spark: SparkSession, sf: str) -> DataFrame:
    return fitted(spark, sf).assignments


@query(
    f"""WITH RECURSIVE {_FIT},
fc AS (SELECT topic_id, b, avg(x) AS x FROM cv JOIN fa USING (doc_id) WHERE fa.kind = 'cluster' GROUP BY topic_id, b),
fu AS (SELECT topic_id, b, x / sqrt(sum(x * x) OVER (PARTITION BY topic_id)) AS x FROM fc),
fp AS (SELECT topic_id, b, x FROM tp JOIN pv ON tp.kind = 'predefined' AND tp.source = CAST(pv.idx AS VARCHAR)),
fs AS (SELECT doc_id, topic_id, round(sum(cv.x * fp.x), 12) AS s, 0 AS o, {C.SCALE} AS least FROM cv JOIN fp USING (b) GROUP BY doc_id, topic_id
       UNION ALL SELECT doc_id, topic_id, round(sum(cv.x * fu.x), 12), 1, 0.1 FROM cv JOIN fu USING (b) GROUP BY doc_id, topic_id),
fr AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY o, s DESC, topic_id) AS r FROM fs WHERE round(s, 6) >= least)
SELECT d.doc_id, coalesce(topic_id, -1) AS topic_id, round(coalesce(s, 0), 6) AS probability
FROM documents d LEFT JOIN (SELECT * FROM fr WHERE r = 1) f ON f.doc_id = d.doc_id"""
)
def a8_model_store(spark: SparkSession, sf: str) -> DataFrame:
    """Fit, save, load, predict the training documents with the loaded model."""
    path = scratch_path(spark, "model")
    model_store.save_model(fitted_by_projection(spark, sf), path)
    rows = predict.predict(model_store.load_model(spark, path), C.documents(spark, sf), C.ENCODER)
    return rows.withColumn("probability", F.round("probability", 6))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to described topics: embed, assign by similarity, weigh terms, name and size every topic."""
    weights = C.language_weights(spark, sf)
    main = stage(terms.top_terms(weights, 10), "main")
    assigned = C.language_topics(spark, sf)
    chosen = represent.representative_docs(C.term_lists(spark, sf), assigned, weights)
    fixed = C.first_of_language(spark, sf).select(F.col("idx").alias("topic_id"), "label")
    return topics.topic_info(assigned, topics.topic_labels(represent.default_labels(main), fixed), main, chosen)
