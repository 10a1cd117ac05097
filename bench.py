"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.  Each query is executed in full through the
``noop`` sink (no collect to the driver)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mound.plans.registry import load_all  # noqa: E402
from mound.session import local_session  # noqa: E402

HEADLINE = [
    "team_features_keyed",      # flagship: one scan, correct keys, W2/W3
    "game_stats",
    "game_stats_single_pass",
    "team_features_fanout",
    "team_averages",
    "game_vs_team_average",
    "prior5_averages",
    "season_to_date",
    "streaks",
    "pitch_result",
    "encode_all",
    "translate_codes",
    "pitcher_stats",
    "correlations",
    "distinct_counts",
    "season_tag",
    "park_fences",
    "game_nested",
    "feature_rows",
    "event_log_plays",
    "roster_join",
    "streaming_game_stats",
    "rf_accuracy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    # warm-up (JVM start, code generation caches) on the smallest tables at hand
    warm = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    reg["pitch_result"].run(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in (only or HEADLINE):
        t0 = time.perf_counter()
        reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
