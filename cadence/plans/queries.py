"""Driver queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

The driver table has one event every few hours per user, so the reference's 20 s
gap would leave every session a singleton.  Driver queries therefore use a 12 h
gap and a 3 h early-fire interval (late-event queries keep the 20 s default).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions import codec
from cadence.functions import messages as M
from cadence.functions.predicates import floor_div, is_search, is_watermark_marker, song_flag
from cadence.operators import arrival as AR
from cadence.operators import sessions as S
from cadence.operators.bucketing import Bucketing
from cadence.operators import watermark as WM
from cadence.operators.panes import early_session_panes
from cadence.schema import EVENT_COLUMNS
from cadence.session import scratch_path
from cadence.sources import generator as G
from cadence.sources.driver_table import load_events, read_table
from cadence.streaming import runs as SR
from cadence.streaming import sessions as SS
from cadence.streaming.panes import stream_early_panes
from cadence.streaming.late import start_late_event_view
from cadence.streaming.quarantine import start_quarantine
from cadence.streaming.replay import feed_ranges, replay
from cadence.streaming.sources import read_wire_stream

# Forces the heavy-user plan on the driver table (every user has more than 20 rows):
# equal-count buckets of about 20 rows, cross-bucket carry and join.  Same results.
SMALL_BUCKETS = Bucketing(adaptive=True, target_rows=20)

DRIVER_GAP_MS = 43_200_000
DRIVER_INTERVAL_MS = 10_800_000
LATE_GAP_MS = 20_000
# At 90 minutes some late events still touch a live session: the two lateness rules differ.
MERGE_GAP_MS = 5_400_000

QueryFn = Callable[[SparkSession, str], DataFrame]


def q_normalize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load_events(spark, sf_dir)
    return ev.select(
        "*",
        song_flag().cast("bigint").alias("is_song"),
        is_watermark_marker().alias("is_watermark"),
    )


def q_session_stats_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_stats(load_events(spark, sf_dir), DRIVER_GAP_MS, duration="window")


def q_session_stats_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_stats(load_events(spark, sf_dir), DRIVER_GAP_MS, duration="span")


def q_session_stats_strict_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Whole-hour timestamps make events exactly one gap apart common.
    ev = load_events(spark, sf_dir).withColumn(
        "ts_ms", F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(3_600_000))
    )
    return S.session_stats(ev, DRIVER_GAP_MS, duration="window", merge_touching=False)


def q_session_stats_touching_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load_events(spark, sf_dir).withColumn(
        "ts_ms", F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(3_600_000))
    )
    return S.session_stats(ev, DRIVER_GAP_MS, duration="window", merge_touching=True)


def q_discover_weekly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.discover_weekly_runs(load_events(spark, sf_dir), DRIVER_GAP_MS)


def q_listening_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.listening_runs(load_events(spark, sf_dir), DRIVER_GAP_MS)


def q_split_runs_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_runs(load_events(spark, sf_dir), DRIVER_GAP_MS, F.col("device_type") == F.lit("Mobile"))


# What a caller may ask of each listening run: mergeable figures (batch and stream) and any aggregate (batch).
def _run_figures() -> dict:
    song_number = F.substring_index(F.col("songid"), "-", -1).cast("bigint")
    return {
        "mobile_songs": ("sum", (F.col("device_type") == F.lit("Mobile")).cast("bigint")),
        "lowest_song": ("min", song_number),
        "highest_song": ("max", song_number),
        "first_song": ("first", song_number),
        "last_daily_mix": ("last", F.when(F.col("playlist_type") == F.lit("DailyMix"), song_number)),
    }


def q_run_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_runs(load_events(spark, sf_dir), DRIVER_GAP_MS, is_search(), figures=_run_figures())


def q_run_figures_heavy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_runs(load_events(spark, sf_dir), DRIVER_GAP_MS, is_search(), figures=_run_figures(), bucketing=SMALL_BUCKETS)


def q_run_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any aggregate of a run's events: how many different songs, and how many playlists."""
    wanted = {"different_songs": F.count_distinct("songid"), "playlists": F.count_distinct("playlist_type")}
    return S.split_runs(load_events(spark, sf_dir), DRIVER_GAP_MS, is_search(), aggregates=wanted, carry=("songid", "playlist_type"))


def q_session_stats_window_heavy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.session_stats(load_events(spark, sf_dir), DRIVER_GAP_MS, duration="window", bucketing=SMALL_BUCKETS)


def q_listening_runs_heavy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.listening_runs(load_events(spark, sf_dir), DRIVER_GAP_MS, bucketing=SMALL_BUCKETS)


def q_early_session_panes_heavy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_session_panes(load_events(spark, sf_dir), DRIVER_GAP_MS, DRIVER_INTERVAL_MS, bucketing=SMALL_BUCKETS)


def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """decode(encode(e)) == e for every event; any invalid record fails the query."""
    wire = codec.encode(load_events(spark, sf_dir))
    return codec.decode(wire, on_error="fail").select(*EVENT_COLUMNS)


def q_encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wire text of every event, compared byte for byte."""
    return codec.encode(load_events(spark, sf_dir))


def _with_bytes(v, hex_bytes: str):
    """The text with raw bytes at the start of the user id."""
    mark = '"userId":"'
    head = F.concat(F.substring_index(v, mark, 1), F.lit(mark)).cast("binary")
    tail = F.substring_index(v, mark, -1).cast("binary")
    return F.concat(head, F.unhex(F.lit(hex_bytes)), tail).cast("string")


# Damage kinds applied to the wire text of every event with pmod(event_id, 97) < 15.
def damaged_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = codec.encode(load_events(spark, sf_dir))
    kind = F.pmod(F.col("event_id"), F.lit(97))
    v = F.col("value")
    bad = (
        F.when(kind == 0, F.concat(F.lit("{bad"), v))
        .when(kind == 1, F.regexp_replace(v, '"timestamp":[0-9]+', '"timestamp":"x"'))
        .when(kind == 2, F.regexp_replace(v, '"type":"[A-Za-z]+"', '"type":"X"'))
        .when(kind == 3, F.regexp_replace(v, '"deviceType":"[A-Za-z]+"', '"deviceType":"Tablet"'))
        .when(kind == 4, F.regexp_replace(v, '"userId":"[^"]*",', ""))
        # JSON types: a user id that is no string, a song id that is no string (songs only),
        # a timestamp in quotes; a fraction or an exponent is a number like any other.
        .when(kind == 5, F.regexp_replace(v, '"userId":"([^"]*)"', '"userId":5'))
        .when(kind == 6, F.regexp_replace(v, '"userId":"([^"]*)"', '"userId":true'))
        .when(kind == 7, F.regexp_replace(v, '"userId":"([^"]*)"', '"userId":{"a":1}'))
        .when(kind == 8, F.regexp_replace(v, '"songid":"([^"]*)"', '"songid":7'))
        .when(kind == 9, F.regexp_replace(v, '"songid":"([^"]*)"', '"songid":[1]'))
        .when(kind == 10, F.regexp_replace(v, '"timestamp":([0-9]+)', '"timestamp":"$1"'))
        .when(kind == 11, F.regexp_replace(v, '"timestamp":([0-9]+)', '"timestamp":$1.5'))
        .when(kind == 12, F.regexp_replace(v, '"timestamp":([0-9]+)', '"timestamp":$1e0'))
        # Bytes that are no UTF-8: a lone continuation, an encoded surrogate.
        .when(kind == 13, _with_bytes(v, "80"))
        .when(kind == 14, _with_bytes(v, "EDA080"))
        .otherwise(v)
    )
    return wire.select("event_id", bad.alias("value"))


def q_quarantine_bad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its verdict: error is NULL for good records."""
    flagged = codec.decode(damaged_wire(spark, sf_dir), on_error="flag")
    return flagged.select(
        "event_id", F.col("error").isNull().alias("is_valid"), "error", F.when(F.col("error").isNull(), F.col("ts_ms")).alias("ts_ms")
    )


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged records as a stream of four micro-batches, split into valid events and invalid
    records by one pass; every record lands in exactly one of the two."""
    root = scratch_path(spark, "stream-quarantine")
    inp, good, bad, ckpt = (os.path.join(root, d) for d in ("input", "good", "bad", "checkpoint"))
    run = lambda: start_quarantine(read_wire_stream(spark, "parquet", path=inp), good, bad, ckpt, available_now=True).awaitTermination()
    feed_ranges(damaged_wire(spark, sf_dir), "event_id", 4, inp, run)
    kept = spark.read.parquet(os.path.join(good, "batch=*")).select("event_id", F.lit(True).alias("is_valid"), F.lit(None).cast("string").alias("error"), "ts_ms")
    left = spark.read.parquet(os.path.join(bad, "batch=*")).select("event_id", F.lit(False).alias("is_valid"), "error", F.lit(None).cast("bigint").alias("ts_ms"))
    return kept.unionAll(left)


def q_early_session_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_session_panes(load_events(spark, sf_dir), DRIVER_GAP_MS, DRIVER_INTERVAL_MS)


def _watermark_cols(df: DataFrame) -> DataFrame:
    return df.select("event_id", "arrival_ms", "ts_ms", "watermark_ms")


def q_punctuated_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watermark_cols(WM.punctuated_watermark(load_events(spark, sf_dir, with_arrival=True)))


def q_max_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watermark_cols(WM.max_watermark(load_events(spark, sf_dir, with_arrival=True)))


def _late(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    ev = load_events(spark, sf_dir, with_arrival=True)
    return WM.late_events(ev, LATE_GAP_MS, mode).select("event_id", "user_id", "ts_ms", "arrival_ms", "watermark_ms")


def q_late_events_punctuated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late(spark, sf_dir, "punctuated")


def q_late_events_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late(spark, sf_dir, "max")


# What a watermark-driven job makes of the table in arrival order (up to an hour out of order).
def q_watermark_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AR.watermark_panes(load_events(spark, sf_dir, with_arrival=True), DRIVER_GAP_MS, DRIVER_INTERVAL_MS)


def q_watermark_panes_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event moves the watermark; the gap is short enough for events to be dropped."""
    return AR.watermark_panes(load_events(spark, sf_dir, with_arrival=True), MERGE_GAP_MS, MERGE_GAP_MS // 4, mode="max")


def q_arrival_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions without the events that the job drops."""
    return AR.arrival_sessions(load_events(spark, sf_dir, with_arrival=True), MERGE_GAP_MS)


def q_lateness_rules_punctuated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events late by their own window; is_dropped is false where merging first keeps them."""
    return AR.lateness_rules(load_events(spark, sf_dir, with_arrival=True), MERGE_GAP_MS)


def q_lateness_rules_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AR.lateness_rules(load_events(spark, sf_dir, with_arrival=True), MERGE_GAP_MS, "max")


def q_messages_m1(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = q_session_stats_window(spark, sf_dir)
    return st.select(
        "user_id",
        M.session_message_window(F.col("user_id"), F.col("start_ms"), F.col("end_ms"), F.col("duration_s"), F.col("songs")).alias("message"),
    )


def q_messages_m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = q_discover_weekly_runs(spark, sf_dir)
    return r.select("user_id", M.discover_weekly_message_window(F.col("user_id"), F.col("length_s"), F.col("songs")).alias("message"))


def q_messages_m3(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = q_listening_runs(spark, sf_dir)
    return r.select("user_id", M.listening_message_window(F.col("user_id"), F.col("songs")).alias("message"))


def q_messages_m4(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = q_session_stats_span(spark, sf_dir)
    return st.select("user_id", M.session_message_span(F.col("user_id"), F.col("duration_s"), F.col("songs")).alias("message"))


def q_messages_m5(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = q_discover_weekly_runs(spark, sf_dir)
    return r.select("user_id", M.discover_weekly_message_span(F.col("user_id"), F.col("length_s"), F.col("songs")).alias("message"))


def q_messages_m6(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = q_listening_runs(spark, sf_dir)
    return r.select("user_id", M.listening_message_span(F.col("user_id"), F.col("length_s"), F.col("songs")).alias("message"))


def q_generate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic wire event per driver event id (the generator's work grows with the table)."""
    seeds = read_table(spark, sf_dir, "events").select("event_id")
    return G.to_wire(G.generate_from_seeds(seeds, "event_id"))


# The three queries below replay the table in event-time order (five time ranges, one
# micro-batch each, watermark delay 0): sessions close as the watermark advances.
def q_stream_session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session stats from Spark's own session windows (all JVM)."""
    op = lambda s, delay: SS.stream_session_stats(s, DRIVER_GAP_MS, watermark_delay_ms=delay)
    return replay(spark, load_events(spark, sf_dir), op, DRIVER_GAP_MS, label="stream-sessions", by="ts_ms")


def q_stream_discover_weekly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = lambda s, delay: SR.stream_discover_weekly_runs(s, DRIVER_GAP_MS, watermark_delay_ms=delay)
    return replay(spark, load_events(spark, sf_dir), op, DRIVER_GAP_MS, label="stream-dw", by="ts_ms")


def q_stream_listening_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = lambda s, delay: SR.stream_listening_runs(s, DRIVER_GAP_MS, watermark_delay_ms=delay)
    return replay(spark, load_events(spark, sf_dir), op, DRIVER_GAP_MS, label="stream-listening", by="ts_ms")


def q_stream_early_panes_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final pane of every session from the stateful stream operator (= session stats)."""
    op = lambda s, delay: stream_early_panes(s, DRIVER_GAP_MS, DRIVER_INTERVAL_MS, watermark_delay_ms=delay)
    panes = replay(spark, load_events(spark, sf_dir), op, DRIVER_GAP_MS, label="stream-panes")
    final = panes.filter(F.col("is_final"))
    return final.select(
        "user_id", "start_ms", "end_ms", floor_div(F.col("end_ms") - F.col("start_ms"), 1000).alias("duration_s"), "songs"
    )


def q_stream_early_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pane of the stream, early ones too: five known event-time ranges, one micro-batch
    each, so a pane holds what was received up to the batch in which it fired."""
    op = lambda s, delay: stream_early_panes(s, DRIVER_GAP_MS, DRIVER_INTERVAL_MS, watermark_delay_ms=delay)
    return replay(spark, load_events(spark, sf_dir), op, DRIVER_GAP_MS, label="stream-all-panes", by="ts_ms")


# These feed the events by arrival time, up to an hour out of order, with no allowance
# for lateness: an event is late only once its own 12 h window is behind the stream.
def q_stream_jittered_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = lambda s, delay: SR.stream_sessions_and_runs(
        s, DRIVER_GAP_MS, SR.default_delimiters(), watermark_delay_ms=delay
    )
    events = load_events(spark, sf_dir, with_arrival=True)
    tagged = replay(spark, events, op, DRIVER_GAP_MS, label="stream-jittered", n_files=8, by="arrival_ms")
    return SR.sessions_of(tagged, DRIVER_GAP_MS)


def q_stream_jittered_listening_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = lambda s, delay: SR.stream_listening_runs(s, DRIVER_GAP_MS, watermark_delay_ms=delay)
    events = load_events(spark, sf_dir, with_arrival=True)
    return replay(spark, events, op, DRIVER_GAP_MS, label="stream-jittered-runs", n_files=8, by="arrival_ms")


def q_stream_sliced_listening_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with every user's pending events in slices (a buffer of no rows), as for users with many of them."""
    op = lambda s, delay: SR.stream_listening_runs(s, DRIVER_GAP_MS, watermark_delay_ms=delay, held_rows=0)
    events = load_events(spark, sf_dir, with_arrival=True)
    return replay(spark, events, op, DRIVER_GAP_MS, label="stream-sliced-runs", n_files=8, by="arrival_ms")


# These replay the table in any file order with a watermark delay of the whole span.
def _incremental(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    op = lambda s, delay: SR.stream_sessions_and_runs(
        s, DRIVER_GAP_MS, SR.default_delimiters(), watermark_delay_ms=delay
    )
    return replay(spark, load_events(spark, sf_dir), op, DRIVER_GAP_MS, label=label)


def q_stream_incremental_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session stats from the bounded-state stream operator."""
    return SR.sessions_of(_incremental(spark, sf_dir, "stream-incr-sessions"), DRIVER_GAP_MS)


def q_stream_incremental_listening_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SR.runs_of(_incremental(spark, sf_dir, "stream-incr-listen"), "listen")


def q_stream_incremental_discover_weekly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SR.runs_of(_incremental(spark, sf_dir, "stream-incr-dw"), "dw")


def q_stream_run_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = lambda s, delay: SR.stream_split_runs(s, DRIVER_GAP_MS, is_search(), watermark_delay_ms=delay, figures=_run_figures())
    return replay(spark, load_events(spark, sf_dir), op, DRIVER_GAP_MS, label="stream-figures", by="ts_ms")


# The stream's own view of late events: seven micro-batches in arrival order, exact inside each.
def _stream_late(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    root = scratch_path(spark, "stream-late")
    inp, out, ckpt = (os.path.join(root, d) for d in ("input", "output", "checkpoint"))
    events = load_events(spark, sf_dir, with_arrival=True)

    def run() -> None:
        stream = spark.readStream.schema(events.schema).parquet(inp)
        start_late_event_view(stream, LATE_GAP_MS, ckpt, out, mode=mode, available_now=True).awaitTermination()

    feed_ranges(events, "arrival_ms", 7, inp, run)
    return spark.read.parquet(os.path.join(out, "batch=*")).select("event_id", "user_id", "ts_ms", "arrival_ms", "watermark_ms")


def q_stream_late_events_punctuated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_late(spark, sf_dir, "punctuated")


def q_stream_late_events_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_late(spark, sf_dir, "max")


def registry() -> dict[str, QueryFn]:
    return {
        "normalize_events": q_normalize_events,
        "session_stats_window": q_session_stats_window,
        "session_stats_span": q_session_stats_span,
        "session_stats_strict_gap": q_session_stats_strict_gap,
        "session_stats_touching_gap": q_session_stats_touching_gap,
        "discover_weekly_runs": q_discover_weekly_runs,
        "listening_runs": q_listening_runs,
        "split_runs_custom": q_split_runs_custom,
        "run_figures": q_run_figures,
        "run_figures_heavy_plan": q_run_figures_heavy_plan,
        "run_aggregates": q_run_aggregates,
        "stream_run_figures": q_stream_run_figures,
        "session_stats_window_heavy_plan": q_session_stats_window_heavy_plan,
        "listening_runs_heavy_plan": q_listening_runs_heavy_plan,
        "early_session_panes_heavy_plan": q_early_session_panes_heavy_plan,
        "json_roundtrip": q_json_roundtrip,
        "encode_events": q_encode_events,
        "quarantine_bad_events": q_quarantine_bad_events,
        "stream_quarantine": q_stream_quarantine,
        "early_session_panes": q_early_session_panes,
        "punctuated_watermark": q_punctuated_watermark,
        "max_watermark": q_max_watermark,
        "late_events_punctuated": q_late_events_punctuated,
        "late_events_max": q_late_events_max,
        "watermark_panes": q_watermark_panes,
        "watermark_panes_max": q_watermark_panes_max,
        "arrival_sessions": q_arrival_sessions,
        "lateness_rules_punctuated": q_lateness_rules_punctuated,
        "lateness_rules_max": q_lateness_rules_max,
        "messages_m1": q_messages_m1,
        "messages_m2": q_messages_m2,
        "messages_m3": q_messages_m3,
        "messages_m4": q_messages_m4,
        "messages_m5": q_messages_m5,
        "messages_m6": q_messages_m6,
        "generate_events": q_generate_events,
        "stream_session_stats": q_stream_session_stats,
        "stream_discover_weekly_runs": q_stream_discover_weekly_runs,
        "stream_listening_runs": q_stream_listening_runs,
        "stream_sliced_listening_runs": q_stream_sliced_listening_runs,
        "stream_early_panes_final": q_stream_early_panes_final,
        "stream_early_panes": q_stream_early_panes,
        "stream_jittered_sessions": q_stream_jittered_sessions,
        "stream_jittered_listening_runs": q_stream_jittered_listening_runs,
        "stream_late_events_punctuated": q_stream_late_events_punctuated,
        "stream_late_events_max": q_stream_late_events_max,
        "stream_incremental_sessions": q_stream_incremental_sessions,
        "stream_incremental_listening_runs": q_stream_incremental_listening_runs,
        "stream_incremental_discover_weekly_runs": q_stream_incremental_discover_weekly_runs,
    }
