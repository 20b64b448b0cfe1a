"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query is
built and fully computed once; results go to the no-op sink, so every column is
produced and nothing is pulled to the driver.
"""

from __future__ import annotations

import json
import os
import re
import time

from offerloom.plans.queries import registered
from offerloom.session import local_session

HEADLINE = (
    "features_asof",
    "candidates",
    "training_set",
    "scored_base",
    "scores_batch",
    "final_offers",
    "scenario_decisions",
    "auc_exact",
    "stratified_split",
    "permutation_importance",
    "correlation_pairs",
    "promotion_ledger",
    "change_feed",
    "fifo_lots",
    "drift_profile",
    "drift_ks",
    "published_features",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = local_session(cpus)
    queries = registered()
    queries["snapshot_points"](spark, folder).write.format("noop").mode("overwrite").save()  # starts the JVM, not timed
    seconds = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
