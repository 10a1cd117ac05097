"""Run registered queries with Spark's event log written to a scratch
folder and print per-stage tasks, time, input and shuffle bytes.

usage: python tools/stage_times.py <sf_dir> <query> [<query> ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import SparkSession  # noqa: E402

from mound.plans.registry import load_all  # noqa: E402
from mound.session import ensure_checkpoint_dir  # noqa: E402

METRICS = {
    "internal.metrics.input.bytesRead": "input",
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write",
    "internal.metrics.shuffle.read.remoteBytesRead": "shuffle_read",
    "internal.metrics.shuffle.read.localBytesRead": "shuffle_read",
    "internal.metrics.output.bytesWritten": "output",
}


def mb(n: int) -> str:
    return f"{n / 1e6:.1f}"


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="mound-eventlog-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    reg = load_all()
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        reg[n].run(spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    stages = []
    job_group = {}
    for path in [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        job_group[sid] = g
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    acc = {}
                    for a in si.get("Accumulables", []):
                        k = METRICS.get(a.get("Name"))
                        if k:
                            acc[k] = acc.get(k, 0) + int(a.get("Value", 0))
                    dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                    stages.append((si["Stage ID"], si["Number of Tasks"], dur, acc))
    print("| query | stage | tasks | sec | input MB | shuffle write MB | shuffle read MB | output MB |")
    print("|---|---|---|---|---|---|---|---|")
    for sid, ntask, dur, acc in sorted(stages):
        print(f"| {job_group.get(sid, '')} | {sid} | {ntask} | {dur:.2f} | {mb(acc.get('input', 0))} | "
              f"{mb(acc.get('shuffle_write', 0))} | {mb(acc.get('shuffle_read', 0))} | {mb(acc.get('output', 0))} |")


if __name__ == "__main__":
    main()
