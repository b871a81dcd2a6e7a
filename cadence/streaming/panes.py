"""Early, cumulative session panes on a stream: ``transformWithStateInPandas`` + event-time timers.

Per user the state has the live sessions ``(start, last, songs, next_fire)``;
out-of-order input can keep several open at once.  A key of the state is a group of users
by hash (as in ``cadence.streaming.runs``), whose sessions are one table of numbers, so the
engine's calls of a micro-batch are bounded by the groups.  On input, each event opens
``[ts, ts + gap]`` and is merged with every live session it touches; a merged
session keeps the earliest pending fire time (so an event that moves a session's
start back may bring its first fire forward, but never moves one back).  A new
session's first fire time is the first multiple of ``interval`` after its first event.

An event is late when its whole window is behind the stream's progress (the largest
event time less the delay): ``ts + gap - 1 <= progress``.  The engine drops rows at or
below its watermark, so it is given each window's last millisecond as event time and a delay
of ``delay + gap - 1`` ms; its watermark then is the progress, by which panes fire.

When progress passes a fire time, the session's *cumulative* result so far is
emitted and the next fire time is one interval later; a timer that fires inside
the handler is only re-armed for the next micro-batch, so the handler emits every
boundary already due in one call.  When progress reaches ``end - 1``
(end = last + gap) the final pane is emitted once and the session is dropped.

Only the final pane of each session is comparable with the batch operator: what
an early pane holds depends on how far progress jumped between batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cadence.session import ship_package
from cadence.functions.predicates import song_flag
from cadence.streaming.groups import GROUP, USER_GROUPS, user_group
from cadence.streaming.pending import numbered, packed_ids, unpacked_ids
from cadence.streaming.sessions import EVENT_TIME, with_event_time

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SCHEMA = "ids BINARY, sessions BINARY, timer BIGINT"
PANE_SESSIONS = 10_000  # sessions whose panes are sent at once
PANE_SCHEMA = "user_id STRING, start_ms BIGINT, end_ms BIGINT, pane_ms BIGINT, songs BIGINT, is_final BOOLEAN"


def _first_fire(ts: int, interval: int) -> int:
    return ts - ts % interval + interval  # Python % is a floor modulo (pmod)


def merge_event(
    sessions: list[list[int]], ts: int, song: int, gap: int, interval: int, merge_touching: bool = True
) -> list[list[int]]:
    """Insert one event (the reference model of ``merge_batch``): it joins every live
    session it touches, and sessions it connects become one."""
    merged, rest = [ts, ts, song, _first_fire(ts, interval)], []
    reach = gap if merge_touching else gap - 1
    for s in sessions:
        if s[0] <= ts + reach and ts <= s[1] + reach:
            merged = [min(merged[0], s[0]), max(merged[1], s[1]), merged[2] + s[2], min(merged[3], s[3])]
        else:
            rest.append(s)
    return sorted([*rest, merged])


def merge_users(live: np.ndarray, events: np.ndarray, gap: int, merge_touching: bool = True) -> np.ndarray:
    """Insert a batch of events into the live sessions of many users.  Rows of both: user
    number, start, last, songs, next fire.  Live sessions and events are intervals in one
    order by (user, start), and a new session starts where an interval begins more than
    one gap (at least one gap in the strict reading) after everything before it.  One sort
    and a few array passes, however many users and sessions there are."""
    rows = np.concatenate([live, events])
    n = len(rows)
    if n == 0:
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    user = rows[:, 0]
    other = np.append(True, user[1:] != user[:-1])
    # Running maximum of the last times within each user: over their ranks, users apart.
    ends, rank = np.unique(rows[:, 2], return_inverse=True)
    reached = ends[np.maximum.accumulate((np.cumsum(other) - 1) * n + rank) % n]
    apart = rows[1:, 1] - reached[:-1]
    first = np.flatnonzero(other | np.append(True, apart > gap if merge_touching else apart >= gap))
    return np.column_stack(
        [
            rows[first, 0],
            rows[first, 1],
            np.maximum.reduceat(rows[:, 2], first),
            np.add.reduceat(rows[:, 3], first),
            np.minimum.reduceat(rows[:, 4], first),
        ]
    )


def as_rows(users, ts, song, interval: int) -> np.ndarray:
    """Events as sessions of one event: rows of ``merge_users``."""
    ts = np.asarray(ts, dtype=np.int64)
    users, song = np.asarray(users, dtype=np.int64), np.asarray(song, dtype=np.int64)
    return np.column_stack([users, ts, ts, song, ts - ts % interval + interval])


def of_one_user(sessions: list[list[int]]) -> np.ndarray:
    live = np.array(sessions, dtype=np.int64).reshape(-1, 4)
    return np.column_stack([np.zeros(len(live), dtype=np.int64), live])


def merge_batch(
    sessions: list[list[int]], ts: np.ndarray, song: np.ndarray, gap: int, interval: int, merge_touching: bool = True
) -> list[list[int]]:
    """``merge_users`` for one user's sessions as lists."""
    if len(ts) == 0:
        return sessions
    return merge_users(of_one_user(sessions), as_rows(np.zeros(len(ts)), ts, song, interval), gap, merge_touching)[:, 1:].tolist()


def panes_of_users(live: np.ndarray, watermark: int, gap: int, interval: int) -> tuple[np.ndarray, dict, np.ndarray]:
    """Every pane due at ``watermark``: (user numbers, columns, sessions still live); a
    session's panes follow one another, the final one last."""
    start, last, songs, nxt = live[:, 1:].T
    final = last + gap - 1
    stop = np.minimum(watermark, final - 1)  # periodic fires strictly before the final one
    fires = np.where(nxt <= stop, (stop - nxt) // interval + 1, 0)
    ended = final <= watermark
    count = fires + ended
    of = np.repeat(np.arange(len(live)), count)
    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    is_final = step == fires[of]
    pane = np.where(is_final, final[of], nxt[of] + step * interval)
    cols = {"start_ms": start[of], "end_ms": last[of] + gap, "pane_ms": pane, "songs": songs[of], "is_final": is_final}
    left = live.copy()
    left[:, 4] += fires * interval
    return live[of, 0], cols, left[~ended]


def due_panes(user: str, sessions: list[list[int]], watermark: int, gap: int, interval: int):
    """``panes_of_users`` for one user's sessions as lists: (columns, sessions still live)."""
    _, cols, live = panes_of_users(of_one_user(sessions), watermark, gap, interval)
    return {c: v.tolist() for c, v in cols.items()}, live[:, 1:].tolist()


def next_timer(live: np.ndarray, gap: int) -> int:
    return int(np.minimum(live[:, 4], live[:, 2] + gap - 1).min())


class EarlyPanesProcessor(StatefulProcessor):
    """Arrow-batched (``transformWithStateInPandas``) early-pane operator of groups of users."""

    def __init__(self, gap_ms: int, interval_ms: int, merge_touching: bool = True):
        self.gap = gap_ms
        self.interval = interval_ms
        self.touching = merge_touching

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", STATE_SCHEMA)

    def _load(self) -> tuple[np.ndarray, np.ndarray, int | None]:
        """The users' ids by number, their sessions, the armed timer."""
        v = self.state.get()
        if v is None:
            return np.empty(0, dtype=object), np.empty((0, 5), dtype=np.int64), None
        return unpacked_ids(v[0]), np.frombuffer(v[1], dtype=np.int64).reshape(-1, 5), v[2]

    def _store(self, ids: np.ndarray, live: np.ndarray, armed: int | None) -> None:
        want = max(1, next_timer(live, self.gap)) if len(live) else None
        if want != armed:
            if armed is not None:
                self.handle.deleteTimer(armed)
            if want is not None:
                self.handle.registerTimer(want)
        if want is None:
            self.state.clear()
            return
        users, numbers = np.unique(live[:, 0], return_inverse=True)  # ids of users with a session only
        live = np.column_stack([numbers, live[:, 1:]])
        self.state.update((packed_ids(ids[users]), live.tobytes(), want))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ids, live, armed = self._load()
        some = False
        for part in rows:  # Arrow chunk by Arrow chunk
            numbers, ids = numbered(np.concatenate([ids, part["user_id"].to_numpy(dtype=object)]))
            events = as_rows(numbers[len(numbers) - len(part) :], part["ts_ms"].to_numpy(), part["song"].to_numpy(), self.interval)
            live = merge_users(live, events, self.gap, self.touching)
            some = True
        if some:
            self._store(ids, live, armed)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ids, live, armed = self._load()
        if armed == expiredTimerInfo.getExpiryTimeInMs():
            armed = None  # this timer has fired and is gone
        watermark, left = timerValues.getCurrentWatermarkInMs(), []
        for lo in range(0, len(live), PANE_SESSIONS):
            users, cols, rest = panes_of_users(live[lo : lo + PANE_SESSIONS], watermark, self.gap, self.interval)
            left.append(rest)
            if len(users):
                yield pd.DataFrame({"user_id": ids[users], **cols})
        if left:
            self._store(ids, np.concatenate(left), armed)

    def close(self) -> None:
        pass


def stream_early_panes(
    events: DataFrame,
    gap_ms: int,
    interval_ms: int,
    *,
    watermark_delay_ms: int = 0,
    merge_touching: bool = True,
    user_groups: int = USER_GROUPS,
) -> DataFrame:
    """``(user_id, start_ms, end_ms, pane_ms, songs, is_final)`` per fire.

    Needs the RocksDB state store provider (set on the session before start)."""
    spark = events.sparkSession
    ship_package(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # The engine drops a row at or below its watermark; an event is late only when its whole
    # window is behind the stream.  So the engine's event time is the window's last
    # millisecond, and the same distance more of delay makes its watermark the stream's
    # progress itself (never below 0, where Spark's watermarks begin).
    ev = with_event_time(events, watermark_delay_ms + gap_ms - 1, gap_ms - 1).select(
        user_group(user_groups), "user_id", "ts_ms", "event_id", song_flag().alias("song"), EVENT_TIME
    )
    return ev.groupBy(GROUP).transformWithStateInPandas(
        EarlyPanesProcessor(gap_ms, interval_ms, merge_touching), PANE_SCHEMA, "Append", "EventTime"
    )


__all__ = ["stream_early_panes", "EarlyPanesProcessor", "merge_batch", "merge_event", "merge_users", "due_panes"]
