"""Lightest spanning forests, and the tree of clusters that a hierarchy of parts condenses to."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_topics import session
from review_topics.operators.components import components
from review_topics.session import cut_lineage, hot_lookup, stage_counted, stage_observed, unstage

# Links that one task takes in order.
LOCAL_LINKS = 200_000


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of links in order those whose ends no earlier one joins."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for batch in batches:
        kept = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            kept.append(a != b)
            parent[a] = b
        yield batch.filter(pa.array(kept, pa.bool_()))


def spanning_forest(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(u, v, w)`` with ``u < v``: the lightest spanning forest of ``links(u, v, w)``.

    Of equal weights the link with the smaller ends comes first, so there is one such forest. Every round each group takes
    its lightest link to another group, found by a partial minimum in every task; groups that took links to each other
    merge, links within a group go, and of several between two groups the lightest stays. Groups at least halve in a
    round. The group that owns most links is split off by ``hot_lookup``. The last LOCAL_LINKS links are taken in order by
    one task. Nodes are whole numbers.
    """
    ends = F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")
    lightest = links.where(F.col("u") != F.col("v")).groupBy(*ends).agg(F.min("w").alias("w"))
    first = lightest.select("a", "b", F.struct("w", F.col("a").alias("u"), F.col("b").alias("v")).alias("edge"))
    current, left = stage_observed(first, "step", links=F.count(F.lit(1)))
    taken: list[DataFrame] = []
    for _ in range(max_rounds):
        if left["links"] <= LOCAL_LINKS:
            last = current.repartition(1).sortWithinPartitions("edge").mapInArrow(_in_order, current.schema)
            taken.append(cut_lineage(last.select("edge", "a", "b")))
            unstage(current)
            break
        around = current.select(F.explode(F.array("a", "b")).alias("node"), F.struct("edge", "a", "b").alias("first"))
        nearest, seen = stage_counted(around.groupBy("node").agg(F.min("first").alias("first"), F.count("*").alias("matches")), "matches")
        picked = cut_lineage(nearest.select("first.*").distinct())
        taken.append(picked)
        merged = components(picked.select(F.col("a").alias("u"), F.col("b").alias("v")))
        to = nearest.select("node", "matches").join(merged, "node")
        to = cut_lineage(to) if seen["most"] * session.HOT_SHARE > seen["total"] else to  # read several times then
        moved = hot_lookup(current, to.select(F.col("node").alias("a"), F.col("component").alias("to_a"), "matches"), ["a"], "matches", seen)
        moved = hot_lookup(moved, to.select(F.col("node").alias("b"), F.col("component").alias("to_b"), "matches"), ["b"], "matches", seen)
        across = moved.where(F.col("to_a") != F.col("to_b"))
        following = across.groupBy(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).agg(F.min("edge").alias("edge"))
        unused, (current, left) = current, stage_observed(following, "step", links=F.count(F.lit(1)))
        unstage(unused, nearest)
    else:
        raise RuntimeError(f"the forest did not settle in {max_rounds} rounds")
    forest = cut_lineage(reduce(DataFrame.unionByName, taken).select("edge.u", "edge.v", "edge.w"))
    unstage(*taken)
    return forest


def forest_members(nodes: DataFrame, forest: DataFrame, top: int) -> DataFrame:
    """``(level, node, weight, component)``: at each level from its own ``born`` to ``top`` the part that a node belongs to.

    ``nodes(node, weight, born)``, ``forest(u, v, w)`` with whole weights. All levels are one components job over the
    forest's links, which are fewer than the nodes, instead of all links. A part is named by its smallest node.
    """

    def at(node: str) -> Column:
        return F.struct("level", F.col(node).alias("node"))

    per_level = forest.select("u", "v", F.explode(F.sequence(F.col("w"), F.lit(top))).alias("level"))
    found = components(per_level.select(at("u").alias("u"), at("v").alias("v")))
    found = found.select(F.col("node.level").alias("level"), F.col("node.node").alias("node"), F.col("component.node").alias("component"))
    spread = nodes.select("node", "weight", F.explode(F.sequence(F.col("born"), F.lit(top))).alias("level"))
    members = spread.join(found, ["level", "node"], "left")
    return cut_lineage(members.select("level", "node", "weight", F.coalesce("component", "node").alias("component")))


def cut_forest(nodes: DataFrame, forest: DataFrame, level: int) -> DataFrame:
    """``(node, weight, component)``: the parts at one level, by the forest's links up to there."""
    found = components(forest.where(F.col("w") <= level).select("u", "v"))
    here = nodes.where(F.col("born") <= level).join(found, "node", "left")
    return here.select("node", "weight", F.coalesce("component", "node").alias("component"))


def member_parts(members: DataFrame, min_size: int) -> DataFrame:
    """``(level, component, size, parent)`` of the parts with ``min_size`` documents; the parent is the part one level up."""
    parts = members.groupBy("level", "component").agg(F.sum("weight").alias("size")).where(F.col("size") >= min_size)
    above = members.select((F.col("level") - 1).alias("level"), F.col("node").alias("component"), F.col("component").alias("parent"))
    return cut_lineage(parts.join(above, ["level", "component"], "left"))


def condense(parts: DataFrame, top: int, mass_per_document: list[float]) -> DataFrame:
    """``(leader, born, last, size, stability, parent_leader, parent_born)``: the clusters of a hierarchy of parts.

    ``parts(level, component, size, parent)`` from level 0, the finest, to ``top``. Towards finer levels a cluster goes on
    while one part is left of it, splits where there are several, and ends where there is none. It is named by the part that
    it was born as and its level; ``last`` is the finest level that it reaches. Stability adds up its size times the
    mass of each of its levels. Parts that go on are joined by one components job, whatever the number of levels.
    """
    depth = (F.lit(top) - F.col("level")).alias("depth")
    rivals = parts.groupBy("level", "parent").agg(F.count("*").alias("rivals"))
    parts = parts.join(rivals.where(F.col("parent").isNotNull()), ["level", "parent"], "left")
    parts = cut_lineage(parts.select("*", F.struct(depth, "component").alias("node"), F.struct((F.lit(top) - F.col("level") - 1).alias("depth"), F.col("parent").alias("component")).alias("up")))
    lines = components(parts.where("rivals = 1").select(F.col("node").alias("u"), F.col("up").alias("v")))
    named = parts.join(lines.withColumnRenamed("component", "line"), "node", "left").withColumn("cluster", F.coalesce("line", "node"))
    named = cut_lineage(named.select("node", "up", "cluster", "level", "size", "rivals"))
    gains = F.element_at(F.array(*[F.lit(float(g)) for g in mass_per_document]), F.col("level") + 1)
    clusters = named.groupBy("cluster").agg(F.min("level").alias("last"), F.max("size").alias("size"), F.sum(F.col("size") * gains).alias("stability"))
    split = named.where("rivals > 1").select("cluster", "up", F.col("rivals").alias("matches"))
    parents = named.join(split.groupBy(F.col("up").alias("node")).agg(F.first("matches").alias("matches")), "node")
    born_of = hot_lookup(split.drop("matches"), parents.select(F.col("node").alias("up"), F.col("cluster").alias("parent"), "matches"), ["up"], "matches")
    tree = clusters.join(born_of.select("cluster", "parent"), "cluster", "left")
    return cut_lineage(
        tree.select(
            F.col("cluster.component").alias("leader"), (F.lit(top) - F.col("cluster.depth")).alias("born"), "last", "size", "stability",
            F.col("parent.component").alias("parent_leader"), (F.lit(top) - F.col("parent.depth")).alias("parent_born"),
        )
    )


def most_stable(tree: DataFrame, open_root: bool = False) -> DataFrame:
    """``(leader, born)`` of the clusters of a condensed tree that are kept: a cluster is, unless those it splits into are
    more stable together. With ``open_root`` a root that stands alone is kept only if it never splits.

    One round for each generation, from the youngest up and down again; masses are compared to nine places.
    """
    sole = open_root and tree.where(F.col("parent_leader").isNull()).limit(2).count() == 1
    key = ["leader", "born"]
    children = tree.where(F.col("parent_leader").isNotNull()).groupBy(F.col("parent_leader").alias("leader"), F.col("parent_born").alias("born"))
    counted = tree.join(children.agg(F.count("*").alias("children")), key, "left").fillna(0, ["children"])
    waiting = cut_lineage(counted.select(*key, "parent_leader", "parent_born", "stability", "children", F.lit(0.0).alias("inner")))
    settled: list[DataFrame] = []
    while True:
        rooted = F.col("parent_leader").isNull() & F.lit(sole) & (F.col("inner") > 0)
        kept = (F.round("stability", 9) >= F.round("inner", 9)) & ~rooted
        ready = waiting.where("children = 0").select(*key, "parent_leader", "parent_born", F.greatest("stability", "inner").alias("best"), kept.alias("kept"))
        ready = cut_lineage(ready)
        settled.append(ready)
        given = ready.where(F.col("parent_leader").isNotNull()).groupBy(F.col("parent_leader").alias("leader"), F.col("parent_born").alias("born"))
        given = given.agg(F.sum("best").alias("more"), F.count("*").alias("done"))
        rest = waiting.where("children > 0").join(given, key, "left")
        rest = rest.withColumn("children", F.col("children") - F.coalesce("done", F.lit(0))).withColumn("inner", F.col("inner") + F.coalesce("more", F.lit(0.0)))
        following = cut_lineage(rest.drop("done", "more"))
        unstage(waiting)
        waiting = following
        if waiting.isEmpty():
            break
    decided = cut_lineage(reduce(DataFrame.unionByName, settled))
    unstage(waiting, *settled)
    live = decided.where(F.col("parent_leader").isNull())
    chosen = [live.where("kept").select(*key)]
    for _ in range(len(settled) - 1):
        opened = live.where(~F.col("kept")).select(F.col("leader").alias("parent_leader"), F.col("born").alias("parent_born"))
        live = decided.join(opened, ["parent_leader", "parent_born"], "left_semi")
        chosen.append(live.where("kept").select(*key))
    return cut_lineage(reduce(DataFrame.unionByName, chosen))
