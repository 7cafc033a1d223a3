"""Summarise the physical plan of every registered query (before AQE):
shuffles, join strategies, pushed filters, Python nodes.

    python tools/plan_report.py [sf_dir] > plan_report.txt
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP_BUILD = ("stream_", "versioned_", "federated_sql", "nightly_etl_events", "kmeans_", "pca_", "als_", "medallion_", "formats_", "catalog_",
              "quality_")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tidepool.plans import suite
    from tidepool.plans.inspect import explain_text
    from tidepool.session import build, tune
    spark = tune(build(master="local[8]", shuffle_partitions=8))
    print("| query | shuffles | joins | partial aggs | pushed filters | python |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in suite.QUERIES.items():
        if name.startswith(SKIP_BUILD):
            continue  # these run jobs while building; covered by their docstrings
        p = explain_text(fn(spark, sf_dir), "formatted")
        shuffles = len(re.findall(r"^\(\d+\) Exchange", p, re.M))
        joins = sorted(set(re.findall(r"^\(\d+\) (BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                      r"BroadcastNestedLoopJoin|CartesianProduct)", p, re.M)))
        partial = len(re.findall(r"partial_", p)) > 0
        pushed = sorted({f for f in re.findall(r"PushedFilters: \[(.+?)\]", p)})
        py = bool(re.search(r"EvalPython|InPandas", p))
        print(f"| {name} | {shuffles} | {', '.join(joins) or '-'} | {'yes' if partial else 'no'} | "
              f"{'; '.join(pushed) or '-'} | {'yes' if py else 'no'} |")


if __name__ == "__main__":
    main()
