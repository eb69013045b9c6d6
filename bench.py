"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Queries run in pipeline order in one session. Stage outputs are memoised
per session (as the reference hands stages over as files), so each timing is
the incremental cost of that stage, like the reference's per-stage timings
(rule mining, factorization, feature selection). Every query is executed in
full with the ``noop`` sink (no collect to the driver).

Prints one JSON line:
{"metric": "pipeline_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for Python workers, wherever this is started

HEADLINE = [
    "clean",                 # P13 clean, both sources
    "rating_balance",        # A10 flagship
    "integrate",             # U4
    "transform",             # A12 + F3 + P18
    "encode",                # E7
    "split_report",          # W8 + A18
    "quality_report",        # A11
    "frequent_itemsets",     # M2 FP-Growth
    "association_rules",     # M3 rule expansion
    "rule_lookup_exact",     # L5
    "feature_reduction",     # E8-E11
    "user_profile_stats",    # A14
    "kmeans_sweep",          # K2 (9 k x 10 restarts)
    "svd_recommendations",   # R1 + R2
    "svd_metrics",           # R3 + R4
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from tastemine.plans.catalog import QUERIES
    from tastemine.session import local_session

    spark = local_session(cpus=cpus, shuffle_partitions=max(8, 2 * cpus), app="tastemine-bench")
    times: dict[str, float] = {}
    t_all = time.time()
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    total = round(time.time() - t_all, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "pipeline_total", "value": total, "unit": "sec", "queries": times, "sf": sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
