"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from secflow.plans import load_all
from secflow.session import local_session

HEADLINE = [
    "flow_asymmetry_by_class", "flow_engineered", "flow_log_features", "flow_clean", "flow_one_hot",
    "syscall_ready", "argument_arrays", "text_vocabulary", "text_tfidf", "token_enrichment", "token_association",
    "standard_scaled", "robust_scaled", "stratified_halves", "column_profile", "data_quality", "class_histogram",
    "box_summary", "global_outliers", "mann_whitney", "spearman", "anova_scores", "mutual_information_scores",
    "class_report", "roc_curve", "roc_area", "best_percentile_threshold", "threshold_table", "metrics_by_model_and_target",
    "correlation_selection", "selection_consensus", "centre_scores", "nearest_neighbours", "density_clusters",
    "silhouette_samples", "mixture_scores", "kmeans_anomalies", "two_stage_outcomes", "forest_importances", "sweep_pivot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "secflow-bench")
    entries = load_all()
    names = sys.argv[1:] or HEADLINE
    entries["class_distribution"].plan(spark, sf_dir).collect()  # start the executors before timing
    timings = {}
    for name in names:
        start = time.perf_counter()
        entries[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(name, timings[name], file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
