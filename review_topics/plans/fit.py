"""Fit a topic model: zero-shot topics first, density clusters for the rest, then descriptions."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.functions import vectors as X
from review_topics.operators import density, distribution, embedding, neighbours, reduction, relations, represent, terms, topics, zeroshot
from review_topics.plans.model import FitParams, TopicModel
from review_topics.session import broadcast_checked, stage


def pyramid_levels(documents: int, components: int) -> int:
    """Levels until cells are sparse: five, and one more for each 2**components times 1,000 documents."""
    return 5 + max(0, math.ceil(math.log2(max(documents, 1) / 1000) / components))


def discover_clusters(vecs: DataFrame, params: FitParams, dims: int) -> DataFrame:
    """``(doc_id, cluster, probability)`` of centred vectors: reduce, round to a grid, cluster the cells."""
    low = reduction.reduce_dims(vecs, params.components, params.reduction, dims)
    if params.clusters == "pyramid":
        low = stage(low, "low")
        levels = params.levels or pyramid_levels(low.count(), params.components)
        points = stage(neighbours.grid_points(low, params.width / 2 ** (levels - 1), params.components), "points")
        cells = stage(neighbours.grid_cells(points, params.components), "cells")
        found = density.cluster_pyramid(cells, params.components, levels, params.min_pts, params.reach2, params.min_topic_size)
        return density.label_pyramid(points, stage(found, "clusters"), params.components, params.reach2)
    if params.clusters not in ("flat", "hierarchical"):
        raise ValueError("clusters is 'pyramid', 'flat' or 'hierarchical'")
    points = stage(neighbours.grid_points(low, params.width, params.components), "points")
    cells = stage(neighbours.grid_cells(points, params.components), "cells")
    edges = stage(neighbours.neighbour_edges(cells, params.components, params.reach2), "edges")
    cluster = density.cluster_hierarchical if params.clusters == "hierarchical" else density.cluster_density
    found = stage(cluster(cells, edges, params.min_pts, params.reach2, params.min_topic_size), "clusters")
    return density.label_points(points, cells, found, params.components, params.reach2)


def fit_topics(
    docs: DataFrame,
    encoder,
    labels: DataFrame | None = None,
    params: FitParams | None = None,
    vecs: DataFrame | None = None,
    prototypes: DataFrame | None = None,
    aspects: dict[str, list[Callable[[DataFrame], DataFrame]]] | None = None,
) -> TopicModel:
    """Fit on ``docs(doc_id, document)``.

    ``vecs`` passes saved raw vectors instead of encoding again. Predefined topics come from ``labels`` through the
    encoder, or ready-made as ``prototypes(idx, label, vec)`` of raw vectors.
    """
    params = params or FitParams()
    lists = None
    if vecs is not None:
        raw = stage(docs.select("doc_id").join(vecs, "doc_id", "left"), "raw")
    elif isinstance(encoder, embedding.HashedEncoder):  # the texts are read once for both
        both = stage(encoder.terms_and_vectors(docs), "raw")
        raw, lists = both.select("doc_id", "vec"), both.select("doc_id", "terms").where(F.size("terms") > 0)
    else:
        raw = stage(embedding.embed(docs, encoder), "raw")
    mean = X.mean_vector(raw)
    centred = stage(embedding.centre(raw, mean), "centred")
    if prototypes is None:
        prototypes = embedding.topic_prototypes(labels, encoder)
    prototypes = stage(embedding.centre(prototypes, mean), "prototypes")

    zero_shot = stage(zeroshot.assign_zero_shot(centred, prototypes, params.min_similarity), "zero-shot")
    rest = centred.join(zero_shot.where(F.col("idx").isNull()).select("doc_id"), "doc_id", "left_semi")
    clusters = discover_clusters(rest, params, len(mean))
    assignments, table = topics.combine_topics(zero_shot, stage(clusters, "labelled"), prototypes.select("idx", "label"))
    assignments, table = stage(assignments, "assignments"), stage(table, "topics")

    by_topic = centred.join(assignments.select("doc_id", "topic_id"), "doc_id")
    centroids = stage(X.group_means(by_topic, "topic_id"), "centroids")
    used = table.where(F.col("kind") == "predefined").select("topic_id", F.col("source").cast("int").alias("idx"))
    model = TopicModel(
        params=params,
        encoder_id=encoder.encoder_id,
        mean=mean,
        topics=table,
        prototypes=stage(prototypes.join(broadcast_checked(used), "idx").select("topic_id", "vec"), "used"),
        centroids=centroids,
        ctfidf=None,
        terms=None,
        labels=None,
        representative=None,
        assignments=assignments,
    )
    return update_topics(model, docs, encoder, assignments, aspects, lists)


def update_topics(
    model: TopicModel,
    docs: DataFrame,
    encoder,
    assignments: DataFrame,
    aspects: dict[str, list[Callable[[DataFrame], DataFrame]]] | None = None,
    term_lists: DataFrame | None = None,
) -> TopicModel:
    """Describe the topics of ``assignments`` anew: term weights, keywords, representative documents, labels.

    ``term_lists`` passes the terms of ``docs``; they are kept for the next call with the same frame, which then counts only the documents
    that moved. Predefined labels stay. Generated aspects of the earlier model are kept unless ``aspects`` makes them again.
    """
    same = term_lists is None and model.extra.get("described") is docs
    if term_lists is None:
        term_lists = model.extra["term_lists"] if same else stage(embedding.term_lists(docs), "term-lists")
    lists = term_lists
    counts = terms.moved_terms(model.ctfidf, lists, model.assignments, assignments) if same else terms.topic_terms(lists, assignments)
    weights = stage(terms.ctfidf(counts), "ctfidf")
    candidates = stage(terms.top_terms(weights, max(represent.CANDIDATES, model.params.top_n)), "candidates")
    main = candidates.where(F.col("rank") <= model.params.top_n)
    chosen = stage(represent.representative_docs(lists, assignments, weights, model.params.label_docs), "chosen")
    representative = stage(represent.with_documents(chosen, docs), "representative")
    described = represent.run_aspects(candidates, aspects) if aspects else candidates
    described = main.unionByName(described.where(F.col("aspect") != "Main"))
    if model.terms is not None:
        remade = ["Main", *(aspects or {})]
        described = described.unionByName(model.terms.where(~F.col("aspect").isin(remade)))
    sizes = assignments.groupBy("topic_id").agg(F.count("*").alias("size"))
    table = model.topics.drop("size").join(sizes, "topic_id").select(model.topics.columns)
    return model.with_tables(
        topics=stage(table, "topics"),
        ctfidf=weights,
        terms=stage(described, "terms"),
        labels=stage(topics.topic_labels(represent.default_labels(main), table), "labels"),
        representative=representative,
        assignments=assignments,
        extra={**model.extra, "term_lists": lists, "described": docs},
    )


def reduce_topics(model: TopicModel, docs: DataFrame, encoder, n: int) -> TopicModel:
    """The model with its most similar topics merged until ``n`` are left; outliers stay outliers.

    A merged topic keeps the smallest of its ids. Its centroid is the mean of the old ones weighted by their sizes.
    """
    merges = stage(relations.topic_tree(model.ctfidf), "merges")
    merged = broadcast_checked(stage(topics.merge_map(merges, model.topics, n), "merged"))
    weighted = model.centroids.join(model.topics.select("topic_id", F.col("size").cast("double").alias("size")), "topic_id")
    centroids = (
        weighted.join(merged, "topic_id")
        .groupBy(F.col("merged_id").alias("topic_id"))
        .agg(vector_to_array(Summarizer.mean(array_to_vector("vec"), F.col("size"))).alias("vec"))
    )
    prototypes = model.prototypes.join(merged, "topic_id").select(F.col("merged_id").alias("topic_id"), "vec")
    moved = model.with_tables(centroids=stage(centroids, "centroids"), prototypes=stage(prototypes, "used"))
    return update_topics(moved, docs, encoder, stage(topics.reduce_topics(model.assignments, merged), "assignments"))


def reduce_outliers(model: TopicModel, docs: DataFrame, threshold: float = 0.0) -> DataFrame:
    """New assignments in which outliers follow their own word windows; only outliers are looked at."""
    outliers = model.assignments.where(F.col("topic_id") == -1).select("doc_id")
    soft = distribution.approximate_distribution(docs.join(outliers, "doc_id", "left_semi"), model.ctfidf)
    return stage(topics.reduce_outliers(model.assignments, soft, threshold), "reassigned")
