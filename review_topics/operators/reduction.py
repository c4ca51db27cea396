"""Linear dimensionality reduction before clustering.

Principal axes come from a randomized range finder: vectors are multiplied by a few random directions, the products are brought to
an orthonormal basis by QR in the tasks and up a tree, and what the vectors are in that basis gives the next, better
directions. A pass reads the vectors once and leaves two small matrices of directions a task, never a covariance of all dimensions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.functions import vectors as X

# Directions beyond those asked for, passes over the vectors, and groups of tasks by step of the tree.
OVERSAMPLE = 10
PASSES = 4
TREE = (1024, 32)


def sign_matrix(dims: int, k: int, seed: int) -> np.ndarray:
    """``dims x k`` matrix of +-1/sqrt(k), each sign read from a hash of its place."""

    def sign(component: int, dim: int) -> int:
        return 1 if int(hashlib.md5(f"{seed}:{component}:{dim}".encode()).hexdigest()[0], 16) < 8 else -1

    return np.array([[sign(c, d) for c in range(k)] for d in range(dims)]) / np.sqrt(k)


def _sketch(mean: np.ndarray, directions: np.ndarray):
    """``(task, r, g)`` of a task's centred vectors A: R of the products Y = A times directions, and Y' times A."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, g = np.zeros((0, directions.shape[1])), np.zeros((directions.shape[1], len(mean)))
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                vectors = batch.column("vec").slice(low, 1024)
                rows = np.asarray(vectors.flatten()).reshape(len(vectors), -1) - mean
                products = rows @ directions
                r = np.linalg.qr(np.vstack([r, products]), "r")
                g += products.T @ rows
        yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "r": [r.tobytes()], "g": [g.tobytes()]})

    return run


def _stacked(width: int, dims: int, groups: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        r = np.linalg.qr(np.vstack([np.frombuffer(x, float).reshape(-1, width) for x in rows.column("r").to_pylist()]), "r")
        g = sum(np.frombuffer(x, float).reshape(width, dims) for x in rows.column("g").to_pylist())
        return pa.table({"task": [rows.column("task")[0].as_py() % groups], "r": [r.tobytes()], "g": [g.tobytes()]})

    return run


def principal_axes(vecs: DataFrame, k: int, passes: int = PASSES, seed: int = 42) -> np.ndarray:
    """``dims x k`` matrix of about the first principal axes of ``vec``, exact where ``k + OVERSAMPLE`` reaches the dimensions.

    More passes come closer. The largest entry of an axis is positive. The driver holds a few matrices of
    ``k + OVERSAMPLE`` rows.
    """
    known = vecs.where(F.col("vec").isNotNull()).select("vec")
    mean = X.mean_vector(known)
    width = min(len(mean), k + OVERSAMPLE)
    directions = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(mean), width)))[0]
    schema = "task long, r binary, g binary"
    for _ in range(passes):
        parts = known.mapInArrow(_sketch(mean, directions), schema)
        for groups in TREE:
            parts = parts.groupBy((F.col("task") % groups).alias("group")).applyInArrow(_stacked(width, len(mean), groups), schema)
        rows = sorted(parts.collect(), key=lambda row: row["task"])
        r = np.linalg.qr(np.vstack([np.frombuffer(row["r"], float).reshape(-1, width) for row in rows]), "r")
        g = sum(np.frombuffer(row["g"], float).reshape(width, len(mean)) for row in rows)
        inside = np.linalg.lstsq(r.T, g, rcond=1e-10)[0]  # the vectors in the basis Y / R
        _, _, axes = np.linalg.svd(inside, full_matrices=False)
        directions = axes.T
    axes = directions[:, :k]
    return axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])


def reduce_dims(vecs: DataFrame, k: int = 5, method: str = "pca", dims: int | None = None, seed: int = 42) -> DataFrame:
    """``(doc_id, low)`` with ``k`` coordinates; documents without a vector are left out.

    ``pca`` projects on the principal axes, whatever the width of the vectors; ``projection`` needs no fit and only ``dims``.
    """
    known = vecs.where(F.col("vec").isNotNull())
    if method == "projection":
        if dims is None:
            raise ValueError("projection needs the vector width")
        return known.select("doc_id", X.projected(F.col("vec"), sign_matrix(dims, k, seed)).alias("low"))
    if method == "pca":
        return known.select("doc_id", X.projected(F.col("vec"), principal_axes(known, k)).alias("low"))
    raise ValueError("method is 'pca' or 'projection'")
