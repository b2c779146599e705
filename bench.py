"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line with per-query seconds. Every
query is executed completely through the no-op sink (no collect to the
driver). A warm-up query at the smallest scale runs first and is not counted.
The cache is cleared before every query, so no query reuses data persisted
by an earlier one.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabml.catalog import QUERIES  # noqa: E402
from tabml.session import get_spark  # noqa: E402

HEADLINE = [
    "stratified_split", "model_metrics", "classification_report", "roc_auc", "roc_curve",
    "pr_curve", "consensus_vote", "correlation_matrix", "box_stats", "impute_median",
    "dedup_rows", "scale_power", "learning_curve_agg", "missing_cells", "train_gbt",
    "permutation_importance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in (sys.argv[1:] or HEADLINE) if q in QUERIES]
    # shuffle partitions sized to the local cores (AQE coalesces further);
    # on a cluster this is sized to the data instead
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = get_spark(f"local[{cpus}]", app="tabml-bench", shuffle_partitions=parts)
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        QUERIES["model_metrics"](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        spark.catalog.clearCache()   # each query pays for its own inputs
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": int(cpus)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
