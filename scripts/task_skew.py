"""Per-stage task balance of a registered query, from Spark's event log.

usage: python scripts/task_skew.py <query> [sf_dir] [--no-coalesce]

With --no-coalesce AQE keeps every shuffle partition, showing the plan's own
distribution (at small scale AQE merges small partitions into one task).

Writes the event log to a fresh scratch folder, runs the query through the
no-op sink, then prints for every stage: tasks, total records read (input +
shuffle), the largest task's records and the median. A stage whose largest
task reads far more than the median is skewed.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabml.catalog import QUERIES  # noqa: E402
from tabml.session import get_spark  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    name = args[0]
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tabml-events-")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
             "spark.eventLog.compress": "false"}
    if "--no-coalesce" in sys.argv:
        extra["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    spark = get_spark("local[8]", app="tabml-skew", shuffle_partitions=16, extra=extra)
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    per_stage = defaultdict(list)
    for path in [p for p in glob.glob(f"{log_dir}/**", recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                        + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                per_stage[ev["Stage ID"]].append(recs)
    worst = 0.0
    print(f"{'stage':>5} {'tasks':>5} {'records':>10} {'max task':>9} {'median':>8}")
    for sid in sorted(per_stage):
        r = per_stage[sid]
        med = statistics.median(r)
        print(f"{sid:5d} {len(r):5d} {sum(r):10d} {max(r):9d} {int(med):8d}")
        if len(r) > 1 and sum(r) > 100_000 and med > 0:
            worst = max(worst, max(r) / med)
    print(f"largest max/median over multi-task stages reading >100k records: {worst:.2f}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
