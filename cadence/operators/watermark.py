"""Event-time watermarks replayed over arrival order, and the late events they imply.

* punctuated: after an event whose second-of-minute is below 2, the watermark
  becomes that event's time (no slack); watermarks never go back, so it is the
  running max of marker times in arrival order.
* max: every event moves the watermark to its own time: the running max of
  event times in arrival order.

``flag_late_events`` marks an event late when the watermark before its arrival
has already passed the end of its own session window: ``ts + gap - 1 <= wm``.
These are the events a streaming job with no allowed lateness drops silently.

Arrival order is global (one ordered stream), so it is cut into contiguous arrival ranges
and evaluated with the two-level running max (``cadence.operators.cumulative``).  The ranges
are equally wide in arrival time, about ``target_rows`` rows each, so nothing is sorted or
stored to find them; only the rows of ranges that turn out to hold more than twice that (a
burst) are dealt out anew by Spark's range partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.predicates import floor_div, is_watermark_marker
from cadence.operators.bucketing import BUCKET, range_buckets, stored
from cadence.operators.cumulative import cumulative

TARGET_ROWS = 2_000_000
MODES = ("punctuated", "max")


def marker(mode: str) -> Column:
    """Which events move the watermark."""
    if mode == "punctuated":
        return is_watermark_marker()
    if mode == "max":
        return F.lit(True)
    raise ValueError(f"mode must be one of {MODES}")


def _with_arrival_bucket(
    events: DataFrame, arrival_col: str, tiebreak_col: str, width_ms: int | None, target_rows: int
) -> DataFrame:
    """Fixed arrival ranges of ``width_ms``, or (default) of a width that holds about
    ``target_rows`` rows on average, with bursts split further.  Rows without an arrival
    have no place in the order: they are spread over ranges of their own before the first."""
    at = F.col(arrival_col)
    nowhere = F.lit(-(1 << 62)) + F.pmod(F.xxhash64(tiebreak_col), F.lit(1024))
    if width_ms:
        return events.withColumn(BUCKET, F.coalesce(floor_div(at, width_ms), nowhere))
    n, lo, hi = events.agg(F.count(at), F.min(at), F.max(at)).first()
    if n <= target_rows:
        return events.withColumn(BUCKET, F.when(at.isNull(), nowhere).otherwise(F.lit(0)))
    width = max(1, -(-(int(hi) - int(lo) + 1) * target_rows // n))
    df = events.withColumn(BUCKET, F.coalesce(floor_div(at - F.lit(lo), width), nowhere))
    counts = df.filter(at.isNotNull()).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(2 * target_rows))
    burst = counts.agg(F.sum("_n")).first()[0]
    if burst is None:
        return df
    hot = stored(counts.select(BUCKET), "bursts")
    order = [F.col(BUCKET).alias("range"), F.col("_sub").cast("bigint").alias("sub")]
    calm = df.join(hot, BUCKET, "left_anti").withColumn("_sub", F.lit(0))
    dense = df.join(hot, BUCKET, "left_semi").withColumnRenamed(BUCKET, "_fixed")
    dense = range_buckets(dense, [arrival_col, tiebreak_col], int(burst), target_rows)
    dense = dense.withColumnRenamed(BUCKET, "_sub").withColumnRenamed("_fixed", BUCKET)
    return calm.unionByName(dense).withColumn(BUCKET, F.struct(*order)).drop("_sub")


def running_watermark(
    events: DataFrame,
    mode: str = "punctuated",
    *,
    inclusive: bool = True,
    arrival_col: str = "arrival_ms",
    ts_col: str = "ts_ms",
    tiebreak_col: str = "event_id",
    width_ms: int | None = None,
    target_rows: int = TARGET_ROWS,
    delay_ms: int = 0,
) -> DataFrame:
    """Adds ``watermark_ms``: the watermark after (``inclusive``) or before each event.

    An event without an arrival time has no place in the arrival order: it stays in the
    result with a NULL watermark (so it is never late) and moves no watermark.  ``delay_ms``
    keeps the watermark that far behind the times it follows."""
    arrived = F.col(arrival_col).isNotNull()
    marked = F.when(marker(mode) & arrived, F.col(ts_col) - F.lit(delay_ms))
    df = _with_arrival_bucket(events, arrival_col, tiebreak_col, width_ms, target_rows)
    out = cumulative(
        df, [], [arrival_col, tiebreak_col], BUCKET, {"watermark_ms": ("max", marked)}, inclusive=inclusive
    )
    return out.drop(BUCKET).withColumn("watermark_ms", F.when(arrived, F.col("watermark_ms")))


def punctuated_watermark(events: DataFrame, **kw) -> DataFrame:
    return running_watermark(events, "punctuated", **kw)


def max_watermark(events: DataFrame, **kw) -> DataFrame:
    return running_watermark(events, "max", **kw)


def flag_late_events(events: DataFrame, gap_ms: int, mode: str = "punctuated", **kw) -> DataFrame:
    """Adds ``watermark_ms`` (before arrival) and ``is_late``."""
    df = running_watermark(events, mode, inclusive=False, **kw)
    late = F.col("watermark_ms").isNotNull() & (F.col("ts_ms") + F.lit(gap_ms - 1) <= F.col("watermark_ms"))
    return df.withColumn("is_late", late)


def late_events(events: DataFrame, gap_ms: int, mode: str = "punctuated", **kw) -> DataFrame:
    """Only the events a watermark-driven session job would drop."""
    return flag_late_events(events, gap_ms, mode, **kw).filter(F.col("is_late")).drop("is_late")
