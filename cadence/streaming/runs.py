"""Sessions and runs on a stream with bounded state: ``transformWithStateInPandas``.

Runs need each session's events in order.  Instead of buffering whole sessions,
this operator keeps only

* the events not yet behind the watermark (``pending``): a late-row filter drops
  anything at or below the previous watermark, so once the watermark passes an
  event no earlier event can still arrive, and the event is folded in order.  Where
  there are many of them they lie in slices by time that no batch rewrites
  (``cadence.streaming.pending``);
* per user one open session: ``(start, last, songs)`` and, per delimiter, the open run
  ``(start, last, songs)``.

A key of the state is one of ``user_groups`` groups of users, whose events are folded
together as arrays (``cadence.streaming.groups``).

A run is emitted when a delimiter or the session end closes it; a session when a
later event is more than one gap after its last event, or when the watermark
reaches ``last + gap``.  Results equal the batch operator's.

Lateness.  The engine drops every row at or below its watermark before the operator
sees it, while an event is late only when its whole window ``[ts, ts + gap)`` is
behind the stream's progress: ``ts + gap - 1 <= max event time - delay``.  The
operator therefore asks the engine for a delay of ``delay + gap - 1`` ms, which makes
the two tests the same; results come out that much later.

Output: ``kind`` ('session' or the delimiter's name), ``user_id``,
``session_start_ms``, ``start_ms``, ``end_ms`` (last event), ``songs`` and the caller's
figures of each run (``cadence.functions.aggregates``), which the open run carries as one
number each.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cadence.functions.aggregates import Figures, check_figures, filled, shown
from cadence.session import ship_package
from cadence.functions.predicates import floor_div, is_search, not_discover_weekly, song_flag
from cadence.streaming.panes import ROCKSDB_PROVIDER
from cadence.streaming.fold import Open, fold_users, no_open
from cadence.streaming.groups import GROUP, USER_GROUPS, user_group
from cadence.streaming.pending import PACKED, Events, Pending, no_events, numbered, packed, packed_ids, unpacked, unpacked_ids
from cadence.streaming.sessions import EVENT_TIME, with_event_time

OUT_SCHEMA = "kind STRING, user_id STRING, session_start_ms BIGINT, start_ms BIGINT, end_ms BIGINT, songs BIGINT"
SESSION = "session"
HELD_ROWS = 16384  # pending events of a group kept in its head row; more are put into slices
SLICES_PER_GAP = 8  # width of a slice of pending events: the gap over this


class IncrementalRunsProcessor(StatefulProcessor):
    """Arrow-batched (``transformWithStateInPandas``) processor over ``fold_users``.

    State per group of users is one head row (the users' open sessions with their open
    runs, the armed timer, and a buffer of at most ``held_rows`` pending events, all as raw
    numpy bytes) and, for groups with more pending events, slices of them by time
    (``Pending``).  A micro-batch costs one head read and one write per group however many
    users and events it brings, rewrites no later slice, and runs no per-event Python."""

    def __init__(self, gap_ms: int, delimiter_names: list[str], merge_touching: bool = True, figure_kinds: tuple[str, ...] = (), slice_ms: int | None = None, held_rows: int = HELD_ROWS):
        self.gap = gap_ms
        self.names = list(delimiter_names)
        self.n = len(self.names)
        self.touching = merge_touching
        self.kinds = tuple(figure_kinds)
        self.m = len(self.kinds)
        self.slice_ms = slice_ms or max(1, gap_ms // SLICES_PER_GAP)
        self.held_rows = held_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("st", f"ids BINARY, open BINARY, timer BIGINT, number BIGINT, first BIGINT, {PACKED}")
        self.slices = handle.getMapState("slices", "first BIGINT, number BIGINT", PACKED)

    def _load(self):
        """Users with an open session, these sessions, the armed timer, pending events."""
        v = self.state.get()
        ids, values = np.empty(0, dtype=object), no_open(self.n, self.m).values
        timer, number, first, buffer = None, 0, None, no_events(self.n, self.m)
        if v is not None:
            ids = unpacked_ids(v[0])
            values = np.frombuffer(v[1], dtype=np.int64).reshape(len(ids), values.shape[1])
            timer, number, first = v[2:5]
            buffer = unpacked(v[5:], self.n, self.m)
        return ids, values, timer, Pending(self.slices, buffer, number, first, slice_ms=self.slice_ms, held_rows=self.held_rows)

    def _save(self, ids, values, armed, pending: Pending) -> None:
        """Set the timer to the next thing that can happen and write the head row."""
        times = [t for t in (pending.next_ms(), int(values[:, 1].min()) + self.gap if len(ids) else None) if t is not None]
        want = min(times, default=None)
        if want != armed:
            if armed is not None:
                self.handle.deleteTimer(armed)
            if want is not None:
                self.handle.registerTimer(want)
        if want is None:  # no open session, nothing pending
            self.state.clear()
            return
        self.state.update((packed_ids(ids), values.tobytes(), want, pending.number, pending.first, *packed(pending.buffer)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ids, values, armed, pending = self._load()
        parts = []
        for part in rows:  # Arrow chunk by Arrow chunk; only narrow arrays are kept
            flags = [part[f"delim_{k}"].to_numpy(dtype=bool) for k in range(self.n)]
            parts.append(
                Events(
                    part["ts_ms"].to_numpy(dtype=np.int64),
                    part["event_id"].fillna(0).to_numpy(dtype=np.int64),
                    part["song"].to_numpy(dtype=np.int64),
                    np.vstack(flags) if flags else np.empty((0, len(part)), bool),
                    np.vstack([part[f"figure_{j}"].to_numpy(dtype=np.int64) for j in range(self.m)]) if self.m else np.empty((0, len(part)), np.int64),
                    part["user_id"].to_numpy(dtype=object),
                )
            )
        if parts:
            pending.add(parts)
            self._save(ids, values, armed, pending)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        ids, values, armed, pending = self._load()
        if armed == expiredTimerInfo.getExpiryTimeInMs():
            armed = None  # this timer has fired and is gone
        due = pending.due(wm)
        numbers, ids = numbered(np.concatenate([ids, due.user]))
        open_ = Open(numbers[: len(values)], values)
        open_, out = fold_users(
            open_, numbers[len(values) :], due.ts, due.song, list(due.delim), self.names, self.gap, self.touching,
            figures=list(zip(self.kinds, due.figures, strict=True)), closed_ms=wm,
        )
        self._save(ids[open_.user], open_.values, armed, pending)
        cols = out.columns()
        if len(cols["kind"]) == 0:
            return iter([])
        frame = pd.DataFrame({"kind": cols["kind"], "user_id": ids[out.user()], **{c: cols[c] for c in out.names[1:]}})
        return iter([frame])

    def close(self) -> None:
        pass


def stream_sessions_and_runs(
    events: DataFrame,
    gap_ms: int,
    delimiters: Mapping[str, Column],
    *,
    watermark_delay_ms: int = 0,
    merge_touching: bool = True,
    figures: Figures | None = None,
    slice_ms: int | None = None,
    held_rows: int = HELD_ROWS,
    user_groups: int = USER_GROUPS,
) -> DataFrame:
    """Closed sessions and runs of every delimiter, as rows tagged by ``kind``, with one
    column ``figure_<j>`` for each of the caller's ``figures``.

    ``watermark_delay_ms`` is the lateness allowed beyond an event's own window (see
    the module doc for the delay the engine is given).  The pending events of
    one of the ``user_groups`` beyond ``held_rows`` are kept in slices of ``slice_ms`` (by
    default an eighth of the gap)."""
    spark = events.sparkSession
    ship_package(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    names, figures = list(delimiters), dict(figures or {})
    check_figures(figures)
    kinds = tuple(kind for kind, _ in figures.values())
    ev = with_event_time(events, watermark_delay_ms + gap_ms - 1).select(
        user_group(user_groups),
        "user_id",
        "ts_ms",
        "event_id",
        song_flag().alias("song"),
        *[F.coalesce(pred, F.lit(False)).alias(f"delim_{k}") for k, pred in enumerate(delimiters.values())],
        *[filled(kind, value).alias(f"figure_{j}") for j, (kind, value) in enumerate(figures.values())],
        EVENT_TIME,
    )
    schema = OUT_SCHEMA + "".join(f", figure_{j} BIGINT" for j in range(len(kinds)))
    return ev.groupBy(GROUP).transformWithStateInPandas(
        IncrementalRunsProcessor(gap_ms, names, merge_touching, kinds, slice_ms, held_rows), schema, "Append", "EventTime"
    )


def sessions_of(tagged: DataFrame, gap_ms: int, duration: str = "window") -> DataFrame:
    s = tagged.filter(F.col("kind") == F.lit(SESSION))
    end = F.col("end_ms") + F.lit(gap_ms) if duration == "window" else F.col("end_ms")
    return s.select(
        "user_id",
        F.col("start_ms"),
        end.alias("end_ms"),
        floor_div(end - F.col("start_ms"), 1000).alias("duration_s"),
        "songs",
    )


def runs_of(tagged: DataFrame, name: str, figures: Figures | None = None) -> DataFrame:
    r = tagged.filter(F.col("kind") == F.lit(name))
    return r.select(
        "user_id",
        "session_start_ms",
        "start_ms",
        "end_ms",
        floor_div(F.col("end_ms") - F.col("start_ms"), 1000).alias("length_s"),
        "songs",
        *[shown(kind, F.col(f"figure_{j}")).alias(name) for j, (name, (kind, _)) in enumerate((figures or {}).items())],
    )


def default_delimiters() -> dict[str, Column]:
    return {"dw": not_discover_weekly(), "listen": is_search()}


def stream_split_runs(
    events: DataFrame,
    gap_ms: int,
    delimiter: Column,
    *,
    watermark_delay_ms: int = 0,
    merge_touching: bool = True,
    figures: Figures | None = None,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """Runs split at ``delimiter``: ``(user_id, session_start_ms, start_ms, end_ms, length_s, songs)`` and the figures."""
    tagged = stream_sessions_and_runs(
        events, gap_ms, {"split": delimiter}, watermark_delay_ms=watermark_delay_ms, merge_touching=merge_touching, figures=figures, held_rows=held_rows
    )
    return runs_of(tagged, "split", figures)


def stream_discover_weekly_runs(events: DataFrame, gap_ms: int, **kw) -> DataFrame:
    return stream_split_runs(events, gap_ms, not_discover_weekly(), **kw)


def stream_listening_runs(events: DataFrame, gap_ms: int, **kw) -> DataFrame:
    return stream_split_runs(events, gap_ms, is_search(), **kw)
