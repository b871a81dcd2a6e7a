"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query runs to completion into Spark's ``noop`` sink (the whole plan executes,
nothing is collected).  After one warm-up of the JVM each query runs ``$BENCH_REPS``
times (default 3).  Nothing is remembered between runs (heavy users are counted anew each
time); ``queries`` has the medians and ``first`` each query's first run, which also
compiles its code.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadence.plans import queries as Q  # noqa: E402
from cadence.session import build_spark, checkpoint_root  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "3"))

HEADLINE = [
    "session_stats_window",
    "session_stats_span",
    "session_stats_window_heavy_plan",
    "discover_weekly_runs",
    "listening_runs",
    "early_session_panes",
    "punctuated_watermark",
    "late_events_punctuated",
    "json_roundtrip",
    "quarantine_bad_events",
    "messages_m1",
    "generate_events",
]
# Streams run once (each replays the whole table through a file stream).
STREAMS = ["stream_session_stats", "stream_incremental_listening_runs", "stream_early_panes_final"]


def run(spark, name: str) -> float:
    t0 = time.perf_counter()
    df = Q.registry()[name](spark, SF_DIR)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = build_spark(f"local[{CPUS}]", app="cadence-bench", shuffle_partitions=CPUS)
    checkpoint_root(spark)
    run(spark, "session_stats_window")  # warm-up: JVM, codegen caches
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        runs = [run(spark, name) for _ in range(REPS)]
        first[name], times[name] = round(runs[0], 3), round(statistics.median(runs), 3)
    for name in STREAMS:
        times[name] = round(run(spark, name), 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first": first,
        "sf": float(m.group(1)) if m else None,
        "cpus": CPUS,
        "reps": REPS,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
