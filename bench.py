"""Time the headline queries and print one JSON line.

Each query is planned and run to completion into the ``noop`` sink, so the whole
result is computed and nothing is collected. ``BENCH_SF_DIR`` and ``BENCH_CPUS``
choose the data and the cores; ``BENCH_QUERIES`` a comma list of other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkwright.plans.registry import QUERIES, load_all  # noqa: E402
from sparkwright.session import get_spark  # noqa: E402

HEADLINE = [
    "describe_numeric",
    "column_audit",
    "corr_matrix",
    "duplicate_count",
    "text_features",
    "clean_corpus",
    "top_words",
    "vocab_rank",
    "tfidf_transform",
    "stratified_split",
    "binary_report",
    "threshold_grid",
    "impute_median",
    "standardize",
    "cv_scores",
    "ridge",
    "grid_search_ridge",
    "nb_predict",
    "grid_search",
    "knn_dense",
    "knn_text",
    "tree_classifier",
    "logistic_text",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [x for x in os.environ.get("BENCH_QUERIES", "").split(",") if x] or HEADLINE
    load_all()
    spark = get_spark("bench", cores=cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start the executor threads
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
