"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (comma separated) a selection.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loomline.plans.queries import QUERIES  # noqa: E402
from loomline.operators.groups import release  # noqa: E402
from loomline.session import local_session  # noqa: E402

HEADLINE = [
    "session_features", "session_gaps", "session_transitions", "session_label_broadcast",
    "linkage_sampled_pairs", "linkage_window_candidates", "matcher_sampled_pairs",
    "asof_features", "asof_features_ttl", "latest_features", "online_lookup", "online_materialized",
    "interactions_dedup", "interactions_kcore", "dense_ids", "leave_k_out",
    "popularity_topk_unseen", "ranking_metrics", "als_metrics",
    "knn_l2", "knn_approx", "hashing_embed_search",
    "numeric_features", "train_test_split", "dataset_fingerprint", "price_zscore",
    "roc_auc", "regression_report", "single_feature_auc", "fit_score_forest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = local_session()
    # start the JVM, the scan and the Python workers before timing
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
