"""Write the formatted physical plan of selected queries to docs/plans/.

usage: python scripts/dump_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabml.catalog import QUERIES  # noqa: E402
from tabml.session import get_spark  # noqa: E402

DEFAULT = ["stratified_split", "roc_curve", "model_metrics", "impute_median", "join_predictions",
           "consensus_vote", "dedup_rows", "correlation_matrix"]


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or DEFAULT
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = get_spark("local[8]", shuffle_partitions=16)
    for name in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(f"-- {name} at {sf_dir} (initial adaptive plan)\n")
            fh.write(buf.getvalue())
    spark.stop()


if __name__ == "__main__":
    main()
