"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall seconds.

Each query is materialised through the ``noop`` sink, so the timing covers
the whole plan but not shipping result rows to the driver.  One warm-up query runs first so JVM
start-up is not charged to the first measured query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "group_model_worst_segments", "drift_report", "ks_drift", "psi_drift", "missingness_report",
    "training_profile", "numeric_summary", "data_contract", "contract_validation", "row_validation",
    "stratified_split_counts", "time_holdout", "grouped_reports", "corr_matrix", "ranking_metrics",
    "threshold_search", "subgroup_f1", "regression_metrics", "segment_metrics", "kaplan_meier",
    "logrank", "c_index", "trailing_rate", "morans_i", "friedman_wilcoxon", "target_encode",
    "oof_target_encode", "calendar_features", "numeric_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from fathom.plans import QUERIES
    from fathom.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = [n for n in HEADLINE if n in QUERIES]
    QUERIES["cap_share"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for n in names:
        t0 = time.perf_counter()
        try:
            # the noop sink runs the whole plan without shipping rows to the driver
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep measuring the others
            print(f"{n} failed: {type(exc).__name__}: {str(exc)[:200]}", file=sys.stderr)
    total = round(sum(times.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_wall_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))


if __name__ == "__main__":
    main()
