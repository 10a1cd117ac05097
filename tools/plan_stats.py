"""Per query: number of pitch-log (lineitem) scans, shuffles and broadcasts
in the physical plan.  usage: python tools/plan_stats.py [sf_dir] [name ...]"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from mound.plans.registry import load_all  # noqa: E402
from mound.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    skip = {"rf_accuracy", "rf_confusion", "rf_importance", "rf_multiclass", "rf_by_season"}
    for name, q in load_all().items():
        if (names and name not in names) or (not names and name in skip):
            continue
        df = q.run(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = len(re.findall(r"FileScan parquet [^\n]*lineitem", plan))
        shuffles = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition")
        bcast = plan.count("BroadcastExchange")
        single = plan.count("SinglePartition")
        print(f"{name:28s} lineitem_scans={scans:2d} shuffles={shuffles:2d} broadcasts={bcast:2d} single_partition={single}")
    spark.stop()


if __name__ == "__main__":
    main()
