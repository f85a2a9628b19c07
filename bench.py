"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run whole and its result consumed. The first, untimed query warms the
JVM; each timed query is then run once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from propensity.catalog import QUERIES
from propensity.session import build_session

HEADLINE = [
    # the largest table: profile, rates, interactions, evaluation
    "line_describe", "line_target_rates", "line_pair_interactions", "line_triple_interactions",
    "line_numeric_profiles", "line_numeric_cat_interactions", "line_modulo_audit", "line_roc_auc", "line_grouped_auc",
    # profile
    "describe_orders", "missing_counts", "duplicate_lines", "level_consistency", "corr_matrix", "histogram_amount_by_class",
    # target rates and interactions
    "target_rates_all_levels", "numeric_profiles_all", "pair_interactions", "triple_interactions", "combo_frequencies",
    "numeric_cat_interactions", "modulo_audit",
    # evaluation
    "roc_auc", "average_precision", "subgroup_auc", "auc_by_quantile", "conditional_auc_mixed", "decile_table",
    # folds, features, joins, blends
    "stratified_folds", "stratified_holdout", "features_v2", "apply_template_test_split", "percentile_rank_score",
    "blend_of_ranks",
    # models
    "cross_val_trees", "logistic_baseline", "job_train_v1",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["target_rate_region"](spark, folder).write.format("noop").mode("overwrite").save()

    taken: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - start, 3)
        print(f"{taken[name]:8.3f}s {name}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(taken.values()), 3), "unit": "sec",
                      "queries": taken, "sf": float(scale.group(1)) if scale else None}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
