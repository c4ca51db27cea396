"""Time the headline queries on one data folder and print one JSON line.

Each query starts from the tables: stages that queries share are forgotten before it is timed, and its result is
written to Spark's no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from review_topics.queries import QUERIES, forget_stages
from review_topics.session import build_session

HEADLINE = [
    "a3_sample_n", "b4_chunk", "b5_render_prompt", "b8_parse_responses", "b13_intents_schema", "d1_infer", "d3_retry_ledger",
    "d4_extract_lexicon", "d6_embed", "e2_zero_shot", "e3_pca", "e4_neighbour_graph", "e5_density_clusters", "e6_components",
    "e7_combine_topics", "f1_term_counts", "f2_ctfidf", "f5_representative_docs", "f8_topic_info", "g3_topic_similarity",
    "g4_hierarchy", "h1_distribution", "h2_token_distribution", "e11_reduce_outliers", "e13_predict", "e10_fit_topics",
    "e10_fit_topics_pca", "e4_document_neighbours", "e5h_hierarchical_clusters",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(cores, "bench")
    warm = spark.read.parquet(f"{folder}/documents.parquet")
    warm.mapInPandas(lambda batches: batches, warm.schema).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        forget_stages()
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
