"""Ordered buckets: the unit of parallelism for order-dependent operators.

Order-dependent operators (session and run boundaries when some user is heavy,
watermark replay over the global arrival order) are evaluated in two levels:

1. *inside a bucket*: a Window partitioned by ``(key, bucket)``, so one hot key is
   spread over as many tasks as it has buckets;
2. *across buckets*: a per-``(key, bucket)`` summary (one row per bucket) whose
   running value is carried into the next buckets and joined back on
   ``(key, bucket)``.

A bucket is a contiguous range of the ordering columns.  Two ways to choose it:

* ``fixed``: ``floor(ts / width)`` with a fixed width, the same for every key;
* ``adaptive``: keys with more than ``target_rows`` rows are *heavy*, however many
  there are.  Their rows are range-partitioned by Spark over ``(key, time, tiebreak)``
  into ranges of about ``target_rows`` rows (so a burst is split, also inside one
  millisecond), and the ranged rows are stored once in the shared folder, because
  both levels must see the same ranges.  The heavy keys are a table that is joined
  like any other; neither keys nor range boundaries are listed by this library.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.predicates import floor_div
from cadence.session import scratch_path

BUCKET = "_bkt"
# A partition of fewer rows is not worth a task.
MIN_RANGE_ROWS = 100_000
DAY_MS = 86_400_000


@dataclass(frozen=True)
class Bucketing:
    """How to cut an ordered key into buckets.

    width_ms:     fixed bucket width (``adaptive=False``).
    target_rows:  adaptive: rows above which a key is heavy, and about the rows of a
                  heavy key's bucket.
    """

    width_ms: int = DAY_MS
    adaptive: bool = False
    # 2M rows of the narrow (user, time, tiebreak, flags) projection is roughly
    # 100 MB: one sort and window per task, well inside executor memory, with spill
    # to spare.
    target_rows: int = 2_000_000


FIXED_DAY = Bucketing()
# Batch default: count rows per key; keys above 2M rows are cut into ranges, and when
# there is none, sessions need no buckets at all (one ordered pass per user).
ADAPTIVE = Bucketing(adaptive=True)


def fixed_bucket(ts: Column, width_ms: int) -> Column:
    return floor_div(ts, width_ms)


def add_bucket(df: DataFrame, ts_col: str, bucketing: Bucketing) -> DataFrame:
    """Add ``_bkt`` as fixed-width time ranges."""
    return df.withColumn(BUCKET, fixed_bucket(F.col(ts_col), bucketing.width_ms))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, label) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def heavy_keys(df: DataFrame, keys: Sequence[str], bucketing: Bucketing) -> tuple[DataFrame, int] | None:
    """The table of keys holding more than ``target_rows`` rows and how many rows they
    hold together, or None if there are none.

    One aggregation (one row per key and map task crosses the shuffle), counted anew for
    every call.  One number reaches the driver; only if there are heavy keys, their table
    is stored in the shared folder."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(bucketing.target_rows))
    total = counts.agg(F.sum("_n")).first()[0]
    return None if total is None else (stored(counts.select(*keys), "heavy"), int(total))


def range_buckets(df: DataFrame, order: Sequence[str], n_rows: int, target_rows: int) -> DataFrame:
    """Add ``_bkt``: contiguous ranges of ``order`` with about ``target_rows`` rows each,
    numbered in that order (NULLs first).

    Spark's range partitioning deals the rows out, one partition a range, so no task sorts
    more than about one range.  Ranges of fewer than ``MIN_RANGE_ROWS`` rows share a
    partition and are cut by row number.  The result is stored, so everything read from it
    agrees on the ranges."""
    wanted = max(1, -(-n_rows // target_rows))
    if wanted == 1:
        return df.withColumn(BUCKET, F.lit(0).cast("bigint"))
    dealt = wanted if target_rows >= MIN_RANGE_ROWS else min(wanted, max(1, -(-n_rows // MIN_RANGE_ROWS)))
    ranged = df.repartitionByRange(dealt, *order).withColumn("_range", F.spark_partition_id().cast("bigint"))
    if dealt == wanted:
        out = ranged.withColumnRenamed("_range", BUCKET)
    else:
        row = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - F.lit(1)
        out = ranged.withColumn(BUCKET, F.shiftleft(F.col("_range"), 32) + floor_div(row.cast("bigint"), target_rows)).drop("_range")
    return stored(out, "ranges")
