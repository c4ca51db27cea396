"""Neighbour graph over grid cells.

Comparing vectors pair by pair is quadratic, and one dense spot or one group of copies makes it worse. Here the
reduced vectors are rounded to a grid first. All documents of one cell become one weighted row (a plain count with
map-side combine, so a cell holding a third of the corpus costs no more than any other), and a cell looks for its
neighbours by key: it probes a fixed list of offsets with an equi join on unique keys. The work is
cells x offsets, never documents squared.
"""

from __future__ import annotations

from itertools import product
from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cell_columns(k: int) -> list[str]:
    return [f"c{i}" for i in range(k)]


def grid_points(low: DataFrame, width: float, k: int) -> DataFrame:
    """``(doc_id, c0..)``: integer grid coordinates. Rounding first keeps the cell independent of summing order."""
    return low.select(
        "doc_id", *[F.floor(F.round(F.col("low")[i], 6) / width).cast("int").alias(c) for i, c in enumerate(cell_columns(k))]
    )


def grid_cells(points: DataFrame, k: int) -> DataFrame:
    """``(c0.., cell_id, weight)``: occupied cells, named by their smallest document id."""
    return points.groupBy(*cell_columns(k)).agg(F.min("doc_id").alias("cell_id"), F.count("*").alias("weight"))


def half_offsets(k: int, reach2: int) -> list[tuple[int, ...]]:
    """Grid steps of squared length at most ``reach2``, one of each opposite pair, without the zero step."""
    reach = isqrt(reach2)
    steps = product(range(-reach, reach + 1), repeat=k)
    zero = (0,) * k
    return [s for s in steps if s > zero and sum(x * x for x in s) <= reach2]


def neighbour_edges(cells: DataFrame, k: int, reach2: int, within: list[str] | None = None) -> DataFrame:
    """``(src, dst, d2)``: each pair of occupied cells within reach once, with its squared distance in cell widths.

    Cells that differ in a column of ``within`` are no neighbours. Probes are many times the cells that they are estimated as, so
    neither side is broadcast.
    """
    columns, within = cell_columns(k), within or []
    steps = F.array(
        *[
            F.struct(F.lit(sum(x * x for x in s)).alias("d2"), *[F.lit(x).alias(f"o{i}") for i, x in enumerate(s)])
            for s in half_offsets(k, reach2)
        ]
    )
    probes = cells.select(F.col("cell_id").alias("src"), *within, *columns, F.explode(steps).alias("o"))
    probes = probes.select(
        "src", F.col("o.d2").alias("d2"), *within, *[(F.col(c) + F.col(f"o.o{i}")).alias(c) for i, c in enumerate(columns)]
    )
    found = cells.select(*within, *columns, F.col("cell_id").alias("dst")).hint("merge")
    return probes.join(found, [*within, *columns]).select("src", "dst", "d2")


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "d2"))


def knn_edges(edges: DataFrame, k: int) -> DataFrame:
    """``(src, dst, d2, rank)``: up to ``k`` nearest cells of each cell; the reach bounds how many there can be."""
    order = Window.partitionBy("src").orderBy("d2", "dst")
    return both_ways(edges).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
