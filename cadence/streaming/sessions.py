"""Session stats on streams with Spark's own session windows (all JVM, append mode).

One ``session_window`` aggregation per user closes each session once the
watermark passes its end (last event + gap).  Its state per open session is three
aggregates, so it stays bounded however long a session runs.  Runs need the
events in order and come from the bounded-state operator in
``cadence.streaming.runs``.

Late events (their own window ``[ts, ts + gap)`` already behind the watermark)
are dropped, as in the reference, which has no allowed lateness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.predicates import floor_div, song_flag

EVENT_TIME = "_event_time"


def interval_literal(ms: int) -> str:
    return f"{ms // 1000} seconds" if ms % 1000 == 0 else f"{ms} milliseconds"


def with_event_time(events: DataFrame, watermark_delay_ms: int = 0, ahead_ms: int = 0) -> DataFrame:
    """The engine's event time, ``ahead_ms`` after the event's own, with a watermark."""
    return events.withColumn(EVENT_TIME, F.timestamp_millis(F.col("ts_ms") + F.lit(ahead_ms))).withWatermark(
        EVENT_TIME, interval_literal(watermark_delay_ms)
    )


def closed_sessions(
    events: DataFrame, gap_ms: int, *, watermark_delay_ms: int = 0, merge_touching: bool = True
) -> DataFrame:
    """One row per closed session: ``user_id, start_ms, last_ms, songs``.

    The state per open session is three aggregates (min, max, sum), whatever the
    session's length.  ``session_window`` merges events exactly one gap apart; the
    strict reading (``merge_touching=False``) uses a window gap 1 ms shorter, which
    splits them (times are whole milliseconds; the end is computed from the last
    event, not from the window)."""
    window_gap = gap_ms if merge_touching else gap_ms - 1
    # Merge each user's sessions inside every input partition before the shuffle
    # (map-side pre-aggregation): a hot user ships partial sessions, not its rows.
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    ev = with_event_time(events, watermark_delay_ms)
    grouped = ev.groupBy(F.col("user_id"), F.session_window(F.col(EVENT_TIME), interval_literal(window_gap)).alias("sw"))
    return grouped.agg(
        F.min("ts_ms").alias("start_ms"),
        F.max("ts_ms").alias("last_ms"),
        F.sum(song_flag()).cast("bigint").alias("songs"),
    ).drop("sw")


def stats_of_sessions(sessions: DataFrame, gap_ms: int, duration: str = "window") -> DataFrame:
    end = F.col("last_ms") + F.lit(gap_ms) if duration == "window" else F.col("last_ms")
    return sessions.select(
        "user_id",
        "start_ms",
        end.alias("end_ms"),
        floor_div(end - F.col("start_ms"), 1000).alias("duration_s"),
        "songs",
    )


def stream_session_stats(
    events: DataFrame,
    gap_ms: int,
    *,
    duration: str = "window",
    watermark_delay_ms: int = 0,
    merge_touching: bool = True,
) -> DataFrame:
    sessions = closed_sessions(events, gap_ms, watermark_delay_ms=watermark_delay_ms, merge_touching=merge_touching)
    return stats_of_sessions(sessions, gap_ms, duration)
