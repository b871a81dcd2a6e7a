"""Skew check: one user holds a third of all rows, packed into one day, and half of
those rows fall inside a single second (a burst).

Generates N synthetic events into SCRATCH (a new folder you give), runs session stats
with fixed day buckets and with adaptive heavy-user buckets, and reports from Spark's
event log (written to SCRATCH/events) the most shuffle records any single task read.

    python tools/skew_check.py SCRATCH [N]
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def largest_task_reads(event_dir: str) -> dict[str, int]:
    import zstandard

    stage_group: dict[int, str] = {}
    largest: dict[str, int] = collections.defaultdict(int)
    for f in glob.glob(os.path.join(event_dir, "*", "*.zstd")) + glob.glob(os.path.join(event_dir, "*.zstd")):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(f, "rb").read())).read()
        for line in raw.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for sid in e["Stage IDs"]:
                    stage_group[sid] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd":
                reads = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                g = stage_group.get(e["Stage ID"])
                largest[g] = max(largest[g], reads)
    return dict(largest)


def main() -> None:
    scratch = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 12_000_000
    os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from cadence.operators.bucketing import Bucketing
    from cadence.operators.sessions import session_stats
    from cadence.sources.generator import generate_events

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", "file://" + os.path.join(scratch, "events"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # 0.5 ms apart: the whole table spans under two hours, so day buckets cannot split it.
    ev = generate_events(spark, n, num_partitions=32, max_interval_ms=1)
    hot = F.pmod("event_id", F.lit(3)) == 0
    burst = F.pmod("event_id", F.lit(6)) == 0
    ev = ev.withColumn("user_id", F.when(hot, F.lit("hot")).otherwise(F.col("user_id")))
    # Half of the hot user's rows: 1,000 distinct milliseconds of one second.
    ev = ev.withColumn("ts_ms", F.when(burst, F.lit(1_704_067_200_000) + F.pmod("event_id", F.lit(1000))).otherwise(F.col("ts_ms")))
    ev.write.mode("overwrite").parquet(os.path.join(scratch, "data"))
    data = spark.read.parquet(os.path.join(scratch, "data"))
    result = {}
    for label, b in (("fixed_day", Bucketing()), ("adaptive", Bucketing(adaptive=True, target_rows=500_000))):
        spark.sparkContext.setJobGroup(label, label)
        t = time.time()
        sessions = session_stats(data, 20_000, bucketing=b).count()
        result[label] = {"sessions": sessions, "sec": round(time.time() - t, 1)}
    spark.stop()
    for label, reads in largest_task_reads(os.path.join(scratch, "events")).items():
        if label in result:
            result[label]["largest_task_shuffle_records"] = reads
    print(json.dumps(result))


if __name__ == "__main__":
    main()
