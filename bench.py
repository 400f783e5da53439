"""Time the headline queries: one JSON line. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and
``BENCH_RUNS`` (timed runs after one warm-up, the median counts) are read from the environment."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tabwright.catalog import REGISTRY  # noqa: E402
from tabwright.session import local_session  # noqa: E402

HEADLINE = [
    "c5_sentinels_to_null",
    "d10_check_all",
    "e1_column_profile",
    "e2_describe",
    "e9_density_curve",
    "e12_quantiles_many_values",
    "f1_code_group",
    "f2_diagnosis_counts",
    "f15_derive_features",
    "g1_median_impute",
    "g3_standardize",
    "g5_prepared_vector",
    "g11_label_encode",
    "g14_anova_scores",
    "g18_oversample",
    "h1_three_way_split",
    "h3_stratified_folds",
    "i6_logistic_regression",
    "i7_decision_tree",
    "i8_random_forest",
    "i9_naive_bayes",
    "i10_cross_validation",
    "j1_label_metrics",
    "j5_roc_auc",
    "j9_roc_curve",
    "j12_classification_report",
    "l1_training_run",
    "l3_batch_scoring",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].build(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total seconds of the headline queries, warm", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
