"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Each query is built and fully executed (``noop`` sink, no collect) once to warm up,
then timed ``$BENCH_RUNS`` times (default 3); the per-query figure is the median and
``value`` is the sum of medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "v4_check_report",             # load + validate + class metrics (the reference's timed task)
    "a9_fraud_by_amount_category",  # flagship
    "a3_amount_by_class",
    "a11_abs_correlation",
    "f_enriched_features",
    "w1_daily_zscore",
    "c8_c10_scaled_features",
    "c12_stratified_split",
    "u2_dedup_rows",
    "m12_roc_auc",
    "m16_model_comparison",
    "d1_ks_baseline_vs_current",
    "d4_monitoring_periods",
    "b1_smote",
    "d12_top_malicious_ips",
    "x1_stream_ingestion_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from riskline.plans.catalog import load
    from riskline.session import local_session

    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus != "*" else "8")), "riskline-bench")
    reg = load()
    names = [q for q in HEADLINE if q in reg]
    times: dict[str, float] = {}
    for q in names:
        fn = reg[q].fn

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up
        times[q] = round(statistics.median(once() for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
