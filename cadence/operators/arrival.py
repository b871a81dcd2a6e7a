"""Sessions, panes and dropped events as a watermark-driven job produces them from events in arrival order.

``early_session_panes`` reads events in time order and flags lateness by an event's own
window.  A streaming job sees something else: events out of order, a watermark that jumps
when a marker arrives, panes that fire with whatever has arrived by then, and late events
that are kept if they still touch a live session.  ``replay_arrivals`` gives exactly that
job's output for a batch of events:

* an event's window ``[ts, ts + gap)`` is merged with the user's live windows that it
  touches, and only then tested: it is dropped iff the merged window has ended, so an
  event that is late by its own window survives when it extends a live session;
* a session's first fire time is the first multiple of ``interval`` after the event that
  opened it; merged sessions keep the earliest one still to come;
* whenever the watermark rises, every fire time up to it fires with the events received
  so far, and a session whose end it has passed fires once more and is gone;
* a fire time that the watermark had already passed when its session opened fires at the
  next rise.

Plan
----
Events that never touch, directly or through others, cannot meet in one session, whatever
order they arrive in.  So the batch sessions (``sessionize``, which splits heavy users over
tasks) cut the work into independent pieces: one exchange on (user, batch session), a sort
by arrival, and one ordered pass that holds a session's live windows and nothing else.  The
watermark before each event is the two-level running maximum of
``cadence.operators.watermark``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.predicates import song_flag
from cadence.operators.bucketing import ADAPTIVE, Bucketing
from cadence.operators.sessions import SESSION_START, SONG, sessionize
from cadence.operators.watermark import late_events, running_watermark
from cadence.session import ship_package

PANE, FINAL, DROPPED = "pane", "final", "dropped"
# Beyond every event time: the watermark of an ended input, and of no watermark yet.
END_OF_INPUT = 1 << 62
NONE_YET = -(1 << 62)

RESULT = "kind string, user_id string, start_ms long, end_ms long, pane_ms long, songs long, event_id long, ts_ms long, arrival_ms long, watermark_ms long"
_NAMES = [c.split()[0] for c in RESULT.split(", ")]
_OUT_ROWS = 16_384


class LiveWindows:
    """The live sessions of one user: lists [start, end, songs, next fire time], none touching another."""

    def __init__(self, gap: int, interval: int, merge_touching: bool = True):
        self.gap, self.interval, self.slack = gap, interval, 0 if merge_touching else 1
        self.live: list[list[int]] = []
        self.watermark = NONE_YET

    def rise(self, watermark: int) -> Iterator[tuple[str, int, int, int, int]]:
        """(kind, start, end, fire time, songs) of everything that fires as the watermark rises."""
        if watermark <= self.watermark:
            return
        self.watermark = watermark
        open_still = []
        for window in self.live:
            start, end, songs, fire = window
            last = end - 1
            while fire <= watermark and fire < last:
                yield PANE, start, end, fire, songs
                fire += self.interval
            window[3] = fire
            if last <= watermark:
                yield FINAL, start, end, last, songs
            else:
                open_still.append(window)
        self.live = open_still

    def add(self, ts: int, songs: int) -> bool:
        """Merge one event into the live windows; False if it is dropped."""
        low, high = ts, ts + self.gap
        near = [w for w in self.live if w[0] + self.slack <= high and w[1] >= low + self.slack]
        if not near:
            if high - 1 <= self.watermark:
                return False
            self.live.append([low, high, songs, ts - ts % self.interval + self.interval])
            return True
        first = near[0]
        if len(near) > 1:
            self.live = [w for w in self.live if w is first or all(w is not n for n in near)]
        first[:] = [min(low, *(w[0] for w in near)), max(high, *(w[1] for w in near)), songs + sum(w[2] for w in near), min(w[3] for w in near)]
        return True


def _replayer(gap_ms: int, interval_ms: int, merge_touching: bool, drain: bool, last_watermark: int | None):
    """The ordered pass over rows sorted by (user, batch session, arrival, tiebreak)."""
    stop = END_OF_INPUT if drain else last_watermark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, windows, out = None, None, []

        def fired(user: str, watermark: int | None) -> None:
            if watermark is not None:
                out.extend((kind, user, start, end, at, songs, None, None, None, None) for kind, start, end, at, songs in windows.rise(watermark))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 8]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=_NAMES)
            out.clear()
            return batch

        for batch in batches:
            for user, session, ts, event, songs, arrival, watermark in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                if (user, session) != key:
                    if key is not None:
                        fired(key[0], stop)
                    key, windows = (user, session), LiveWindows(gap_ms, interval_ms, merge_touching)
                fired(user, watermark)
                if not windows.add(ts, songs):
                    out.append((DROPPED, user, None, None, None, None, event, ts, arrival, watermark))
                if len(out) >= _OUT_ROWS:
                    yield flush()
        if key is not None:
            fired(key[0], stop)
        if out:
            yield flush()

    return run


def replay_arrivals(
    events: DataFrame,
    gap_ms: int,
    interval_ms: int,
    *,
    mode: str = "punctuated",
    merge_touching: bool = True,
    drain: bool = True,
    bucketing: Bucketing = ADAPTIVE,
    **watermark_options,
) -> DataFrame:
    """Everything the job emits or drops, one row each, told apart by ``kind``:

    * ``pane``, ``final``: user_id, start_ms, end_ms, pane_ms (the fire time), songs;
    * ``dropped``: user_id, event_id, ts_ms, arrival_ms, watermark_ms (before the event).

    ``drain=True``: the input ends, so every open session fires out.  ``drain=False``: the
    input pauses after its last event; sessions that the watermark has not passed stay open
    and only what it has passed fires.

    Events without a user, a time or an arrival time take no part.  Equal arrival times
    are ordered by ``event_id``."""
    if gap_ms <= 0 or interval_ms <= 0:
        raise ValueError("gap_ms and interval_ms must be positive")
    spark = events.sparkSession
    ship_package(spark)
    placed = events.filter(F.col("user_id").isNotNull() & F.col("ts_ms").isNotNull() & F.col("arrival_ms").isNotNull())
    last = None if drain else running_watermark(placed, mode, **watermark_options).agg(F.max("watermark_ms")).first()[0]
    marked = running_watermark(placed, mode, inclusive=False, **watermark_options)
    carried = {SONG: song_flag().cast("bigint"), "arrival_ms": F.col("arrival_ms"), "watermark_ms": F.col("watermark_ms")}
    pieces = sessionize(marked, gap_ms, measures=carried, bucketing=bucketing)
    ordered = (
        pieces.select("user_id", SESSION_START, "ts_ms", "event_id", SONG, "arrival_ms", "watermark_ms")
        .repartition("user_id", SESSION_START)
        .sortWithinPartitions("user_id", SESSION_START, "arrival_ms", "event_id")
    )
    return ordered.mapInArrow(_replayer(gap_ms, interval_ms, merge_touching, drain, last), RESULT)


def watermark_panes(events: DataFrame, gap_ms: int, interval_ms: int, **options) -> DataFrame:
    """``(user_id, start_ms, end_ms, pane_ms, songs, is_final)``: every pane as the watermark fires it."""
    fired = replay_arrivals(events, gap_ms, interval_ms, **options).filter(F.col("kind") != DROPPED)
    return fired.select("user_id", "start_ms", "end_ms", "pane_ms", "songs", (F.col("kind") == FINAL).alias("is_final"))


def arrival_sessions(events: DataFrame, gap_ms: int, **options) -> DataFrame:
    """``(user_id, start_ms, end_ms, duration_s, songs)``: the sessions as the job closes them."""
    closed = replay_arrivals(events, gap_ms, gap_ms, **options).filter(F.col("kind") == FINAL)
    return closed.select(
        "user_id", "start_ms", "end_ms", F.floor((F.col("end_ms") - F.col("start_ms")) / 1000).cast("bigint").alias("duration_s"), "songs"
    )


def dropped_events(events: DataFrame, gap_ms: int, **options) -> DataFrame:
    """``(event_id, user_id, ts_ms, arrival_ms, watermark_ms)``: the events the job drops, tested after merging."""
    gone = replay_arrivals(events, gap_ms, gap_ms, **options).filter(F.col("kind") == DROPPED)
    return gone.select("event_id", "user_id", "ts_ms", "arrival_ms", "watermark_ms")


def lateness_rules(events: DataFrame, gap_ms: int, mode: str = "punctuated", **options) -> DataFrame:
    """Every event that is late by its own window, with what becomes of it.

    ``(event_id, user_id, ts_ms, arrival_ms, watermark_ms, is_dropped)``: ``is_dropped`` is
    False where the event still touches a live session and is kept.  A dropped event is
    always late by its own window, so the two rules differ in exactly those rows."""
    own = late_events(events.filter(F.col("user_id").isNotNull()), gap_ms, mode)
    gone = dropped_events(events, gap_ms, mode=mode, **options).select("event_id", F.lit(True).alias("_gone"))
    return own.join(gone, "event_id", "left").select(
        "event_id", "user_id", "ts_ms", "arrival_ms", "watermark_ms", F.coalesce("_gone", F.lit(False)).alias("is_dropped")
    )
