"""Seconds per headline job at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from nearkin.plans.catalog import REGISTRY  # noqa: E402
from nearkin.session import local_session  # noqa: E402

HEADLINE = [
    "corpus_dedupe", "clean_pairs", "stratified_split", "quality_report",
    "tfidf_pair_cosine", "fuzzy_feature_table", "feature_table",
    "bm25_search", "bm25_search_turns", "knn_exact", "knn_clustered", "corpus_duplicates",
    "hybrid_search", "rerank_overlap", "classifier_metrics", "slice_metrics", "top_bigrams",
    "retrieval_by_label", "request_metrics", "query_reuse",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # start the Python workers and compile the shared paths before timing
    REGISTRY["clean_transformer"](spark, folder).write.format("noop").mode("overwrite").save()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    recall = REGISTRY["knn_clustered_recall"](spark, folder).first()["recall_at_10"]
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rsplit("/sf", 1)[-1], "recall_at_10": recall,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
