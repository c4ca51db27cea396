"""A fitted topic model: parameters and DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

import numpy as np
from pyspark.sql import DataFrame

from review_topics import fixed_values as V


@dataclass
class FitParams:
    """Settings of a fit.

    ``clusters`` is ``pyramid`` (cell widths halved from ``width`` on, clusters chosen over all of them), ``flat`` or
    ``hierarchical`` (one width). Without ``levels`` a pyramid has as many as the number of documents fills.
    """

    min_similarity: float = V.MIN_SIMILARITY
    min_topic_size: int = V.MIN_TOPIC_SIZE
    components: int = 5
    reduction: str = "pca"
    clusters: str = "pyramid"
    width: float = 0.4
    levels: int | None = None
    reach2: int = 2
    min_pts: int = 10
    top_n: int = 10
    label_docs: int = V.LABEL_DOCUMENTS
    predict_similarity: float | None = None


@dataclass
class TopicModel:
    """Tables of a fitted model. ``mean`` is the corpus mean that new vectors are measured from."""

    params: FitParams
    encoder_id: str
    mean: np.ndarray
    topics: DataFrame
    prototypes: DataFrame
    centroids: DataFrame
    ctfidf: DataFrame
    terms: DataFrame
    labels: DataFrame
    representative: DataFrame
    assignments: DataFrame
    extra: dict = field(default_factory=dict)

    TABLES = ("topics", "prototypes", "centroids", "ctfidf", "terms", "labels", "representative", "assignments")

    def with_tables(self, **tables: DataFrame) -> "TopicModel":
        return replace(self, **tables)


PARAM_NAMES = [f.name for f in fields(FitParams)]
