"""Headline benchmark: runs the named queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion into Spark's ``noop`` sink (no driver
collect) and timed; prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.plans.queries import QUERIES  # noqa: E402
from lodestar.session import build_session  # noqa: E402

# Headline set: the reference's workload families (taxi ETL, delay labelling,
# feature engineering + selection + search, trial analytics, scoring, model fits).
HEADLINE = [
    "clean_taxi", "taxi_fare_weekday", "taxi_features", "haversine_km", "delay_label", "duration_seconds",
    "label_encode", "target_encode_oof", "pairwise_sums", "chi2_scores", "split_counts", "kfold_counts",
    "elapsed_ci", "box_stats", "throughput_ratio", "best_so_far", "median_stop", "halving_rungs",
    "auc_rank", "rmse", "linear_shap", "ridge_grid", "knn_exact", "csv_roundtrip", "rf_fit", "gbt_fit",
    "kmeans_fit", "json_score_batch", "feature_engineering", "feature_search",
    "gbt_newton", "tree_contributions", "encoder_pipeline", "taxi_model_table", "async_halving",
]


def run_one(spark, name, sf_dir):
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="lodestar-bench")
    run_one(spark, "preview_head", sf_dir)  # start the JVM/Python workers before timing
    times = {}
    for name in names:
        times[name] = round(run_one(spark, name, sf_dir), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
