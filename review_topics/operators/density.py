"""Density clustering on the weighted cell graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.operators import neighbours as N
from review_topics.operators.components import components
from review_topics.operators.spanning import condense, forest_members, member_parts, most_stable, spanning_forest
from review_topics.session import cut_lineage, hot_lookup


def core_distances(cells: DataFrame, edges: DataFrame, min_pts: int, reach2: int) -> DataFrame:
    """``(cell_id, weight, core_d2)``: squared distance within which a cell sees ``min_pts`` documents, itself included.

    Null where the whole reach does not hold that many.
    """
    weights = cells.select("cell_id", "weight")
    around = N.both_ways(edges).join(weights.withColumnRenamed("cell_id", "dst"), "dst")
    seen = around.select(F.col("src").alias("cell_id"), "d2", "weight", F.lit(0).alias("own")).unionByName(
        weights.select("cell_id", F.lit(0).alias("d2"), "weight", F.col("weight").alias("own"))
    )
    within = [F.sum(F.when(F.col("d2") <= d, F.col("weight")).otherwise(0)).alias(f"w{d}") for d in range(reach2 + 1)]
    totals = seen.groupBy("cell_id").agg(F.sum("own").alias("weight"), *within)
    core = F.coalesce(*[F.when(F.col(f"w{d}") >= min_pts, F.lit(d)) for d in range(reach2 + 1)])
    return totals.select("cell_id", "weight", core.alias("core_d2"))


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("component").agg(F.sum("weight").alias("size"), F.count("*").alias("matches"))


def cluster_density(
    cells: DataFrame, edges: DataFrame, min_pts: int, reach2: int, min_topic_size: int = V.MIN_TOPIC_SIZE
) -> DataFrame:
    """``(cell_id, weight, core_d2, cluster)``: flat density clusters of core cells.

    Cells with enough documents in reach are core; connected core cells form a cluster named by its smallest
    document id. Other cells, and clusters below ``min_topic_size`` documents, get a null cluster.
    """
    measured = cut_lineage(core_distances(cells, edges, min_pts, reach2))
    core = measured.where(F.col("core_d2").isNotNull()).select("cell_id")
    links = edges.join(core.withColumnRenamed("cell_id", "src"), "src", "left_semi").join(
        core.withColumnRenamed("cell_id", "dst"), "dst", "left_semi"
    )
    found = components(links.select(F.col("src").alias("u"), F.col("dst").alias("v")))
    members = measured.where(F.col("core_d2").isNotNull()).join(
        found.withColumnRenamed("node", "cell_id"), "cell_id", "left"
    )
    members = cut_lineage(members.withColumn("component", F.coalesce("component", "cell_id")))
    large = hot_lookup(members, _sizes(members), ["component"], "matches").where(F.col("size") >= min_topic_size)
    return measured.join(large.select("cell_id", F.col("component").alias("cluster")), "cell_id", "left")


def mutual_reachability(measured: DataFrame, edges: DataFrame) -> DataFrame:
    """``(u, v, w)`` between core cells: the largest of their distance and both core distances, squared."""
    ends = measured.where(F.col("core_d2").isNotNull()).select("cell_id", "core_d2")
    return (
        edges.join(ends.select(F.col("cell_id").alias("src"), F.col("core_d2").alias("core_a")), "src")
        .join(ends.select(F.col("cell_id").alias("dst"), F.col("core_d2").alias("core_b")), "dst")
        .select(F.col("src").alias("u"), F.col("dst").alias("v"), F.greatest("d2", "core_a", "core_b").alias("w"))
    )


def reach_forest(cells: DataFrame, edges: DataFrame, min_pts: int, reach2: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(measured, nodes, forest)``: core distances, core cells as forest nodes, and their lightest spanning forest."""
    measured = cut_lineage(core_distances(cells, edges, min_pts, reach2))
    return measured, forest_nodes(measured), spanning_forest(mutual_reachability(measured, edges))


def forest_nodes(measured: DataFrame) -> DataFrame:
    core = measured.where(F.col("core_d2").isNotNull())
    return core.select(F.col("cell_id").alias("node"), "weight", F.col("core_d2").alias("born"))


def level_masses(reach2: int) -> list[float]:
    """Mass of a document at each squared distance: by how much 1 / (1 + distance) falls until the next one."""
    heights = [1 / (1 + d**0.5) for d in range(reach2 + 1)] + [0.0]
    return [a - b for a, b in zip(heights, heights[1:])]


def cluster_hierarchical(
    cells: DataFrame, edges: DataFrame, min_pts: int, reach2: int, min_size: int = V.MIN_TOPIC_SIZE
) -> DataFrame:
    """``(cell_id, weight, core_d2, cluster)``: clusters of varying density, chosen by excess of mass.

    The spanning forest of mutual reachability holds the whole hierarchy: cut at any distance of the grid it gives the flat
    clusters there. Its parts condense to a tree of clusters, and a cluster is kept unless those that it splits into
    are more stable together. A cluster is named by the smallest cell of the part that it was born as.
    """
    measured, nodes, forest = reach_forest(cells, edges, min_pts, reach2)
    members = forest_members(nodes, forest, reach2)
    chosen = most_stable(condense(member_parts(members, min_size), reach2, level_masses(reach2)))
    # A cluster's cells are those of the part it was born as. No cell is in two clusters, but one may lead several parts.
    birth = chosen.select(F.col("born").alias("level"), F.col("leader").alias("component"))
    sizes = members.groupBy("level", "component").agg(F.count("*").alias("matches"))
    cells_of = hot_lookup(members, birth.join(sizes, ["level", "component"]), ["level", "component"], "matches")
    return measured.join(cells_of.select(F.col("node").alias("cell_id"), F.col("component").alias("cluster")), "cell_id", "left")


def cluster_pyramid(
    fine: DataFrame, k: int, levels: int, min_pts: int, reach2: int, min_size: int = V.MIN_TOPIC_SIZE
) -> DataFrame:
    """``(c0.., core_d2, cluster, weight)`` of the finest cells: clusters of any density, whatever the amount of data.

    ``fine`` are the finest grid cells. Each level above has cells twice as wide, counted from those below, so texts are
    counted once. A cell is core at a level when its reach there holds ``min_pts`` documents; connected core cells are a
    part. A part lies within one part of the next level, and the excess of mass over inverse squared cell widths chooses among
    them. With more data finer levels fill, so ``levels`` decides how close clusters may be, not how many there can be.
    Steps of ``reach2`` at most 3 keep parts nested. A cluster is named by its smallest cell's document.
    """
    if not 1 <= reach2 <= 3:
        raise ValueError("reach2 is from 1 to 3 in a pyramid")
    columns = N.cell_columns(k)
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    spread = fine.select(level, *columns, "cell_id", "weight")
    shifted = [F.expr(f"shiftright({c}, level)").alias(c) for c in columns]
    cells = spread.select("level", *shifted, "cell_id", "weight").groupBy("level", *columns)
    cells = cells.agg(F.min("cell_id").alias("first"), F.sum("weight").alias("weight"))
    cells = cut_lineage(cells.select("level", *columns, F.struct("level", F.col("first").alias("doc")).alias("cell_id"), "weight"))
    edges = cut_lineage(N.neighbour_edges(cells, k, reach2, ["level"]))
    measured = cut_lineage(core_distances(cells, edges, min_pts, reach2))
    core = measured.where(F.col("core_d2").isNotNull())
    ends = core.select("cell_id")
    links = edges.join(ends.withColumnRenamed("cell_id", "src"), "src", "left_semi").join(ends.withColumnRenamed("cell_id", "dst"), "dst", "left_semi")
    found = components(links.select(F.col("src").alias("u"), F.col("dst").alias("v"))).withColumnRenamed("node", "cell_id")
    members = core.join(found, "cell_id", "left").withColumn("component", F.coalesce("component", "cell_id"))
    members = cut_lineage(members.join(cells.drop("weight"), "cell_id"))

    parts = members.groupBy("level", "component").agg(F.sum("weight").alias("size")).where(F.col("size") >= min_size)
    named = parts.join(members.select(F.col("cell_id").alias("component"), *columns), "component")
    above = members.select((F.col("level") - 1).alias("level"), *[F.col(c).alias(f"up_{c}") for c in columns], F.col("component").alias("parent"))
    upper = [F.expr(f"shiftright({c}, 1)").alias(f"up_{c}") for c in columns]
    parts = named.select("level", "component", "size", *upper).join(above, ["level", *[f"up_{c}" for c in columns]], "left")
    parts = cut_lineage(parts.select("level", "component", "size", "parent"))
    lambdas = [4.0**-d for d in range(levels)] + [0.0]
    chosen = most_stable(condense(parts, levels - 1, [a - b for a, b in zip(lambdas, lambdas[1:])]), open_root=True)

    sizes = members.groupBy("component").agg(F.count("*").alias("matches"))
    birth = chosen.select(F.col("leader").alias("component")).join(sizes, "component")
    kept = hot_lookup(members, birth, ["component"], "matches").select("level", *columns, "core_d2", F.col("component.doc").alias("cluster"))
    keys = ["level", *columns]
    placed = spread.select("cell_id", "level", *shifted).join(kept.hint("merge"), keys).select("cell_id", "core_d2", "cluster")
    return fine.join(placed, "cell_id", "left").select(*columns, "core_d2", "cluster", "weight")


def label_pyramid(points: DataFrame, labelled: DataFrame, k: int, reach2: int) -> DataFrame:
    """``(doc_id, cluster, probability)`` of each document from its finest cell; see ``label_points``."""
    strength = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.sqrt(F.col("core_d2")) / F.lit(float(reach2) ** 0.5)))
    strength = F.when(F.col("cluster").isNotNull(), strength).otherwise(F.lit(0.0)).alias("probability")
    values = labelled.select(*N.cell_columns(k), "cluster", strength, "weight")
    return hot_lookup(points, values, N.cell_columns(k), "weight").select("doc_id", "cluster", "probability")


def label_points(points: DataFrame, cells: DataFrame, clustered: DataFrame, k: int, reach2: int) -> DataFrame:
    """``(doc_id, cluster, probability)`` from the cell each document lies in; outliers have null and 0.

    Probability is one minus the core distance relative to the reach, within 0 and 1.
    """
    strength = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.sqrt(F.col("core_d2")) / F.lit(float(reach2) ** 0.5)))
    labelled = cells.join(clustered.select("cell_id", "core_d2", "cluster"), "cell_id").select(
        *N.cell_columns(k),
        "cluster",
        F.when(F.col("cluster").isNotNull(), strength).otherwise(F.lit(0.0)).alias("probability"),
        "weight",
    )
    placed = hot_lookup(points, labelled, N.cell_columns(k), "weight")
    return placed.select("doc_id", "cluster", "probability")
