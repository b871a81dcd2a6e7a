"""Early, cumulative session results ("panes") for batch DataFrames.

Each session is reported at every multiple of ``interval`` from its first fire
time, and once more at its end:

* first fire time ``f = start - pmod(start, interval) + interval`` (the first
  multiple strictly after the session's first event);
* periodic panes ``f, f + interval, ...`` strictly before ``end - 1``
  (end = last event + gap);
* a final pane at ``end - 1``; a periodic pane that coincides with it fires once.

Panes accumulate: pane ``b`` counts every song of the session with ``ts <= b``,
and its ``end_ms`` is the session window as known then (latest ``ts <= b`` plus
the gap).  This is the in-order reading, with the watermark advancing with every
event.

Plan: every event goes to the first fire time at or after it; one aggregation
(partial, then shuffled) gives songs and latest time per (session, fire time)
that has events.  One Window per session over those rows -- at most one per fire
time, however many events the session holds -- gives the running totals, and each
row expands into the fire times up to the next row that has events (plus the final
pane for the session's last row).  Only equi-keys and no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.predicates import floor_div
from cadence.operators.bucketing import ADAPTIVE, Bucketing
from cadence.operators.sessions import SESSION_START, SONG, sessionize, song_measure


def first_fire(start_ms, interval_ms: int):
    return start_ms - F.pmod(start_ms, F.lit(interval_ms)) + F.lit(interval_ms)


def early_session_panes(
    events: DataFrame,
    gap_ms: int,
    interval_ms: int,
    *,
    bucketing: Bucketing = ADAPTIVE,
    annotated: DataFrame | None = None,
    user_col: str = "user_id",
    ts_col: str = "ts_ms",
) -> DataFrame:
    """``(user_id, start_ms, end_ms, pane_ms, songs, is_final)``: one row per fire."""
    if interval_ms <= 0:
        raise ValueError("interval_ms must be positive")
    ann = annotated if annotated is not None else sessionize(events, gap_ms, measures=song_measure(), bucketing=bucketing)
    u, s, ts = F.col(user_col), F.col(SESSION_START), F.col(ts_col)
    f = first_fire(s, interval_ms)
    # First fire time at or after ts, never before f:  f + ceil(max(ts - f, 0) / I) * I.
    k = floor_div(F.greatest(ts - f, F.lit(0)) + F.lit(interval_ms - 1), interval_ms)
    counts = ann.groupBy(u.alias("user_id"), s.alias("start_ms"), (f + k * F.lit(interval_ms)).alias("pane_ms")).agg(
        F.sum(SONG).cast("bigint").alias("_songs"), F.max(ts_col).alias("_max_ts")
    )

    w = Window.partitionBy("user_id", "start_ms").orderBy("pane_ms")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = counts.select(
        "user_id",
        "start_ms",
        "pane_ms",
        F.sum("_songs").over(upto).alias("_cum"),
        F.max("_max_ts").over(upto).alias("_seen"),
        F.lead("pane_ms").over(w).alias("_next"),
        F.max("_max_ts").over(Window.partitionBy("user_id", "start_ms")).alias("_last"),
    )
    final = F.col("_last") + F.lit(gap_ms - 1)
    # Periodic fire times of this row: from its own pane up to (excluding) the next
    # row's pane and the final pane.
    stop = F.least(F.coalesce(F.col("_next"), final), final)
    periodic = F.when(
        F.col("pane_ms") < stop, F.sequence(F.col("pane_ms"), stop - F.lit(1), F.lit(interval_ms))
    ).otherwise(F.array().cast("array<bigint>"))
    fires = F.concat(
        F.transform(periodic, lambda b: F.struct(b.alias("b"), F.lit(False).alias("fin"))),
        F.when(F.col("_next").isNull(), F.array(F.struct(final.alias("b"), F.lit(True).alias("fin")))).otherwise(
            F.array().cast("array<struct<b:bigint,fin:boolean>>")
        ),
    )
    out = rows.select("user_id", "start_ms", "_cum", "_seen", F.explode(fires).alias("p"))
    return out.select(
        "user_id",
        "start_ms",
        (F.col("_seen") + F.lit(gap_ms)).alias("end_ms"),
        F.col("p.b").alias("pane_ms"),
        F.col("_cum").cast("bigint").alias("songs"),
        F.col("p.fin").alias("is_final"),
    )
