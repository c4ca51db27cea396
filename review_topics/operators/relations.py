"""Tables behind the topic views: map, bar chart, similarity, hierarchy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.operators.represent import topic_norms
from review_topics.operators.spanning import spanning_forest
from review_topics.session import broadcast_checked, stage

# Topics of a block, terms of a part of their rows, and terms that a task holds as a matrix at a time.
BLOCK_TOPICS = 512
PART_TERMS = 1_000_000
CHUNK_TERMS = 4_096
MAX_BLOCK_PAIRS = 1_000_000


def intertopic_map(topic_vecs: DataFrame, sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """``(topic_id, x, y, size, label)``: topic vectors in two dimensions."""
    features = topic_vecs.where(F.col("vec").isNotNull()).select("topic_id", array_to_vector("vec").alias("features"))
    flat = PCA(k=2, inputCol="features", outputCol="flat").fit(features).transform(features)
    xy = flat.select("topic_id", vector_to_array("flat").alias("xy"))
    return xy.join(sizes, "topic_id").join(labels, "topic_id", "left").select(
        "topic_id", F.col("xy")[0].alias("x"), F.col("xy")[1].alias("y"), F.col("n_docs").alias("size"), "label"
    )


def top_topics(
    assignments: DataFrame, terms: DataFrame, n: int = V.CHARTED_TOPICS, words: int = 5, labels: DataFrame | None = None
) -> DataFrame:
    """``(place, topic_id, n_docs, rank, term, weight)`` of the ``n`` largest topics, outliers aside.

    With ``labels(topic_id, label)`` there is also a column ``label``.
    """
    sizes = assignments.where(F.col("topic_id") >= 0).groupBy("topic_id").agg(F.count("*").alias("n_docs"))
    largest = sizes.orderBy(F.desc("n_docs"), "topic_id").limit(n)
    placed = largest.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n_docs"), "topic_id")))
    shown = terms.where((F.col("aspect") == "Main") & (F.col("rank") <= words))
    columns = ["place", "topic_id", "n_docs", "rank", "term", "weight"]
    if labels is not None:
        placed = placed.join(labels.select("topic_id", "label"), "topic_id", "left")
        columns.append("label")
    return shown.join(F.broadcast(placed), "topic_id").select(columns)


def _packed_rows(weights: DataFrame, parts: int) -> DataFrame:
    """``(block, part, topic_id, codes, values)``: each topic's unit c-TF-IDF row, cut into parts by term."""
    lengths = broadcast_checked(topic_norms(weights).where("topic_norm > 0"))
    unit = weights.join(lengths, "topic_id").select("topic_id", F.xxhash64("term").alias("code"), (F.col("weight") / F.col("topic_norm")).alias("value"))
    block = F.floor(F.col("topic_id") / BLOCK_TOPICS).cast("int").alias("block")
    rows = unit.groupBy(block, F.pmod("code", F.lit(parts)).cast("int").alias("part"), "topic_id").agg(F.collect_list("code").alias("codes"), F.collect_list("value").alias("values"))
    return stage(rows, "topic-rows")


def _gram(key: tuple, rows: pa.Table) -> pa.Table:
    """Partial inner products of two blocks over one part of the terms; a row for each topic of the first block."""
    sides = [np.asarray(rows.column("side")) <= 0, np.asarray(rows.column("side")) != 0]
    lists = rows.combine_chunks()
    codes, values = (np.asarray(lists.column(c).chunk(0).flatten()) for c in ("codes", "values"))
    lengths = np.asarray(lists.column("codes").chunk(0).value_lengths())
    topics = np.asarray(lists.column("topic_id")).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    _, place = np.unique(codes, return_inverse=True)
    order = np.argsort(place, kind="stable")
    place, row, values = place[order], row[order], values[order]
    gram = np.zeros((int(sides[0].sum()), int(sides[1].sum())))
    for low in range(0, int(place.max(initial=-1)) + 1, CHUNK_TERMS):
        a, b = np.searchsorted(place, (low, low + CHUNK_TERMS))
        dense = np.zeros((len(lengths), CHUNK_TERMS))
        dense[row[a:b], place[a:b] - low] = values[a:b]
        gram += dense[sides[0]] @ dense[sides[1]].T
    n, width = gram.shape
    ids = [pa.scalar(t) for t in topics[sides[0]]] if n else [pa.scalar(None, pa.int64())]  # without a row, the other block's topics still tell that they are there
    ends = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * width)
    others = pa.ListArray.from_arrays(ends, pa.array(np.tile(topics[sides[1]], len(ids))))
    dots = pa.ListArray.from_arrays(ends, pa.array(gram.reshape(-1) if n else np.zeros(width)))
    names = [pa.array(np.full(len(ids), k.as_py(), np.int32)) for k in key[:2]]
    return pa.table({"low": names[0], "high": names[1], "topic_id": pa.array([t.as_py() for t in ids], pa.int64()), "others": others, "dots": dots})


def _block_products(weights: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """All pairs of topics by pairs of blocks; ``finish(topics a, topics b, cosines)`` says what leaves a pair of blocks.

    A topic's row goes to as many groups as there are blocks and a group holds two blocks, over a bounded part of the
    terms; the products of a pair of blocks are added up behind that. Only blocks, never pairs of topics, are joined.
    """
    terms = weights.agg(F.approx_count_distinct("term")).first()[0]
    packed = _packed_rows(weights, 1 + terms // PART_TERMS)
    every = packed.agg(F.collect_set("block")).scalar()
    pairs = packed.select("block").distinct().withColumn("every", every).select("block", F.explode("every").alias("other"))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    side = F.when(F.col("block") == F.col("other"), -1).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side")
    dealt = packed.join(broadcast_checked(pairs, MAX_BLOCK_PAIRS), "block").select(low, high, "part", side, "topic_id", "codes", "values")
    sums = dealt.groupBy("low", "high", "part").applyInArrow(_gram, "low int, high int, topic_id long, others array<long>, dots array<double>")

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        first, other = rows.column("topic_id").to_pylist(), [np.asarray(x.values) for x in rows.column("others")]
        a, b = np.unique([t for t in first if t is not None]).astype(np.int64), np.unique(np.concatenate(other))
        cosines = np.zeros((len(a), len(b)))
        for topic, names, dots in zip(first, other, rows.column("dots")):
            if topic is not None:
                cosines[np.searchsorted(a, topic), np.searchsorted(b, names)] += np.asarray(dots.values)
        return finish(a, b, cosines)

    return sums.groupBy("low", "high").applyInArrow(add, schema)


def topic_similarity(weights: DataFrame, minimum: float = 0.0) -> DataFrame:
    """``(topic_a, topic_b, similarity)`` for ``topic_a < topic_b``: cosine of c-TF-IDF rows, where it is above 0 and at least ``minimum``."""

    def pairs(a: np.ndarray, b: np.ndarray, cosines: np.ndarray) -> pa.Table:
        row, column = np.nonzero((a[:, None] < b[None, :]) & (cosines > 0) & (np.round(cosines, 9) >= minimum))
        return pa.table({"topic_a": pa.array(a[row].astype(np.int32)), "topic_b": pa.array(b[column].astype(np.int32)), "similarity": pa.array(cosines[row, column])})

    return _block_products(weights, pairs, "topic_a int, topic_b int, similarity double")


def local_tree(a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lightest spanning forest of the distances between ``a`` and ``b``, equal ones in the order of their ends.

    No link that it leaves out is in the lightest forest of a graph that holds these links and others.
    """
    names = np.unique(np.concatenate([a, b]))
    full = np.full((len(names), len(names)), np.inf)
    full[np.ix_(np.searchsorted(names, a), np.searchsorted(names, b))] = distance
    full = np.minimum(full, full.T)
    np.fill_diagonal(full, np.inf)
    ends = np.arange(len(names))
    outside = np.ones(len(names), bool)
    nearest, link = np.full(len(names), np.inf), np.full(len(names), np.iinfo(np.int64).max)
    taken = []
    for _ in names:  # grow a tree by its lightest link outwards; where there is none, begin another
        least = np.where(outside, nearest, np.inf).min()
        open_ends = np.flatnonzero(outside & (nearest == least))
        new = open_ends[np.argmin(link[open_ends])]
        if np.isfinite(least):
            taken.append(link[new])
        outside[new] = False
        ranks = np.minimum(ends, new) * len(names) + np.maximum(ends, new)
        closer = (full[new] < nearest) | ((full[new] == nearest) & (ranks < link))
        closer &= np.isfinite(full[new])
        nearest, link = np.where(closer, full[new], nearest), np.where(closer, ranks, link)
    u, v = np.divmod(np.array(taken, np.int64), len(names))
    return names[u], names[v], full[u, v]


def topic_tree(weights: DataFrame) -> DataFrame:
    """``(step, left, right, distance)``: single linkage of the topics without their pairs, nearest first; outliers aside.

    Each pair of blocks gives up its own lightest forest, and the forest of all these is that of all pairs.
    """

    def forest(a: np.ndarray, b: np.ndarray, cosines: np.ndarray) -> pa.Table:
        u, v, w = local_tree(a, b, np.round(1 - cosines, 9))
        return pa.table({"u": pa.array(u.astype(np.int32)), "v": pa.array(v.astype(np.int32)), "w": pa.array(w)})

    tree = spanning_forest(_block_products(weights.where(F.col("topic_id") >= 0), forest, "u int, v int, w double"))
    step = F.row_number().over(Window.orderBy("w", "u", "v"))
    return tree.select(step.alias("step"), F.col("u").alias("left"), F.col("v").alias("right"), F.col("w").alias("distance"))


def dendrogram(merges: DataFrame, topics: DataFrame) -> DataFrame:
    """``(node, left, right, topic_id, distance, size, label)``: each merge with the two nodes that it joins.

    ``topics(topic_id, size, label)`` are the leaves, nodes under their own ids; merges are numbered on from the largest of
    these. A merged node has the smallest topic id below it, that topic's label, and the documents of all of them. One
    disjoint-set pass over the merges in order; it holds the topics, never their pairs or documents.
    """
    leaves = topics.where(F.col("topic_id") >= 0).select("topic_id", F.col("size").cast("long").alias("size"), "label")
    rows = leaves.select(F.lit(0).alias("step"), F.col("topic_id").alias("left"), F.lit(None).cast("int").alias("right"), F.lit(0.0).alias("distance"), "size", "label").unionByName(
        merges.select("step", "left", "right", "distance", F.lit(None).cast("long").alias("size"), F.lit(None).cast("string").alias("label"))
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        node: dict[int, tuple[int, int, str]] = {}  # by root: node, size, label
        following = 0

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["step"] == 0:
                    parent[row["left"]], node[row["left"]] = row["left"], (row["left"], row["size"], row["label"])
                    following = max(following, row["left"] + 1)
                    continue
                a, b = sorted((root(row["left"]), root(row["right"])))
                parent[b] = a
                ends = sorted((node[a][0], node[b][0]))
                node[a] = following, node[a][1] + node.pop(b)[1], node[a][2]
                out.append((following, *ends, a, row["distance"], node[a][1], node[a][2]))
                following += 1
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.string()]
            names = ["node", "left", "right", "topic_id", "distance", "size", "label"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(names), kinds)], names=names)

    ordered = rows.repartition(1).sortWithinPartitions("step", "left")
    return ordered.mapInArrow(join, "node int, left int, right int, topic_id int, distance double, size long, label string")
