"""Replay a batch of events through a real file stream (tests and driver queries).

The events are encoded to wire JSON once, into files of ``(event_id, value)`` under the
shared checkpoint folder; the streaming operator reads them in several micro-batches,
so sessions are merged across batches in the state store.  After the data, two sentinel
files (one synthetic user far in the future) push the watermark past every session, and
the sentinel user is removed *after* the sink (a filter on the key inside the streaming
plan would be pushed below the watermark and stop it moving).

The stream runs in a session of its own (same cluster, own settings), whose number of
state partitions follows the number of rows; the caller's settings are not touched.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions import codec
from cadence.functions.predicates import floor_div
from cadence.session import scratch_path
from cadence.streaming.sinks import start_sink
from cadence.streaming.sources import read_event_stream

SENTINEL_USER = "~sentinel"
ROWS_PER_PARTITION = 1_000_000  # rows of a written file, and of a state partition


def _sentinel(spark: SparkSession, ts_ms: int) -> DataFrame:
    """One search event of the sentinel user."""
    text = '{"type":"SearchEvent","timestamp":%d,"userId":"%s","eventType":"SearchSong","deviceType":"Desktop"}'
    return spark.range(1).select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(text % (ts_ms, SENTINEL_USER)).alias("value"))


def equal_ranges(col: str, lo: int, hi: int, n: int):
    """Number (0 to n - 1) of the range of ``col`` among ``n`` equally wide ones of lo..hi."""
    return F.least(floor_div((F.col(col) - F.lit(lo)) * F.lit(n), hi - lo + 1), F.lit(n - 1))


def feed_ranges(df: DataFrame, by: str, n: int, folder: str, run: Callable[[], None]) -> None:
    """Append the rows of ``n`` equally wide ranges of ``by`` to ``folder``, in order, and call
    ``run`` after each: one micro-batch a range for a stream that reads the folder."""
    lo, hi = df.agg(F.min(by), F.max(by)).first()
    if lo is None:
        return
    staged = scratch_path(df.sparkSession, "ranges") + "/rows"
    df.withColumn("_r", equal_ranges(by, int(lo), int(hi), n)).write.partitionBy("_r").parquet(staged)
    ranges = df.sparkSession.read.parquet(staged)
    for r in range(n):
        part = ranges.where(F.col("_r") == r).select(*df.columns)
        if not part.isEmpty():
            part.write.mode("append").parquet(folder)
            run()


def replay(
    spark: SparkSession,
    events: DataFrame,
    operator: Callable[[DataFrame, int], DataFrame],
    gap_ms: int,
    *,
    n_files: int = 5,
    label: str = "replay",
    by: str | None = None,
) -> DataFrame:
    """Run ``operator(stream, watermark_delay_ms)`` over ``events`` as a stream; return
    the sink's rows (sentinel user removed) as a batch DataFrame.

    ``by=None``: about ``n_files`` micro-batches in any order, watermark delay = the data's
    time span (nothing can be late; sessions close at the sentinels).
    ``by`` a column (``ts_ms``, ``arrival_ms``): ``n_files`` equally wide ranges of it, one
    micro-batch each and in order, watermark delay 0, so the watermark advances and
    sessions close progressively, as on a live stream.

    The events are read twice: once for their bounds, once to be written."""
    root = scratch_path(spark, label)
    staged, inp, out, ckpt = (os.path.join(root, d) for d in ("staged", "input", "output", "checkpoint"))
    order = by or "ts_ms"
    b = events.agg(F.count(F.lit(1)), F.min("ts_ms"), F.max("ts_ms"), F.min(order), F.max(order)).first()
    n, first, last, lo, hi = (int(x) if x is not None else 0 for x in b)
    files = max(n_files, -(-n // ROWS_PER_PARTITION))
    options = {} if by else {"maxFilesPerTrigger": str(-(-files // n_files))}
    delay = 0 if by else last - first + gap_ms + 1

    session = spark.newSession()
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    state = max(min(wanted, spark.sparkContext.defaultParallelism), -(-n // ROWS_PER_PARTITION))
    session.conf.set("spark.sql.shuffle.partitions", str(state))
    built: list[DataFrame] = []

    def run() -> None:
        if not built:  # the source folder must exist first: build after the first write
            built.append(operator(read_event_stream(session, "parquet", path=inp, options=options), delay))
        q = start_sink(built[0], "parquet", ckpt, path=out, available_now=True)
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    if by and n:
        wire = codec.encode(events.withColumn("_r", equal_ranges(by, lo, hi, n_files)), keep=("event_id", "_r"))
        wire.write.partitionBy("_r").parquet(staged)
        ranges = spark.read.parquet(staged)
        for r in range(n_files):
            # Reads one folder; a range without events starts no micro-batch.
            part = ranges.where(F.col("_r") == r).select("event_id", "value")
            if not part.isEmpty():
                part.write.mode("append").parquet(inp)
                run()
    else:
        codec.encode(events).repartition(files).write.mode("append").parquet(inp)
        run()
    # Two sentinel files, one micro-batch each: the first moves the watermark past every
    # session, the second guarantees a later batch that emits them.  Their order does
    # not matter (a sentinel behind the watermark is dropped and the other still moves
    # it).  With one file per batch both go into one run; otherwise one run each.
    for k in (1, 2):
        _sentinel(spark, last + k * (delay + 2 * gap_ms + 1)).coalesce(1).write.mode("append").parquet(inp)
        if by or options.get("maxFilesPerTrigger") != "1":
            run()
    if not by:
        run()
    return spark.read.parquet(out).filter(F.col("user_id") != F.lit(SENTINEL_USER))
