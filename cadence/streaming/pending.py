"""A group of users' events that the watermark has not passed yet, in state that grows without being rewritten.

The newest events lie in a buffer inside the operator's head row.  When the buffer
holds more than ``held_rows`` events it is written out as *slices*: its events sorted by
time and cut at multiples of ``slice_ms`` (at those that leave a ``SLICES_PER_BUFFER``-th of
the buffer in a slice), each stretch a map entry of its own under
``(first event time, number)``.  Entries are only added, read once the watermark has
passed their first event, and removed; so a micro-batch writes its own events, the
buffer, and what is left of the slices that hold the watermark, however many events
wait in later slices.  Groups with few events never leave the buffer and touch no map entry.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pandas as pd

SLICES_PER_BUFFER = 64  # a full buffer makes about as many slices at most


class Events(NamedTuple):
    """Events as columns: ``delim`` has a row for each delimiter, ``figures`` one for each figure;
    ``user`` are user ids (empty where all events are of one user)."""

    ts: np.ndarray
    eid: np.ndarray
    song: np.ndarray
    delim: np.ndarray
    figures: np.ndarray
    user: np.ndarray = np.empty(0, dtype=object)

    def take(self, which) -> Events:
        user = self.user[which] if len(self.user) else self.user
        return Events(self.ts[which], self.eid[which], self.song[which], self.delim[:, which], self.figures[:, which], user)


def no_events(n_delims: int, n_figures: int) -> Events:
    none = np.empty(0, dtype=np.int64)
    return Events(none, none, none, np.empty((n_delims, 0), dtype=bool), np.empty((n_figures, 0), dtype=np.int64))


def joined(parts: list[Events]) -> Events:
    return Events(*(np.concatenate([p[i] for p in parts], axis=-1) for i in range(len(parts[0]))))


def numbered(users: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of every user id, the different ids by number); no id (None) is one of them."""
    numbers, ids = pd.factorize(users, use_na_sentinel=False)
    ids = np.asarray(ids, dtype=object)
    ids[pd.isna(ids)] = None
    return numbers, ids


def packed_ids(ids: np.ndarray) -> bytes:
    return json.dumps(ids.tolist()).encode() if len(ids) else b""


def unpacked_ids(cell: bytes) -> np.ndarray:
    return np.array(json.loads(bytes(cell)) if len(cell) else [], dtype=object)


#: Columns of packed events in a state row; users are numbers and the ids of these.
PACKED = "p_ts BINARY, p_eid BINARY, p_song BINARY, p_delim BINARY, p_figures BINARY, p_user BINARY, p_ids BINARY"


def packed(events: Events) -> tuple[bytes, ...]:
    numbers, ids = numbered(events.user)
    columns = (*events[:5], numbers.astype(np.int32))
    return (*(np.ascontiguousarray(c).tobytes() for c in columns), packed_ids(ids))


def unpacked(cells, n_delims: int, n_figures: int) -> Events:
    ts, eid, song = (np.frombuffer(b, dtype=np.int64) for b in cells[:3])
    delim = np.frombuffer(cells[3], dtype=bool).reshape(n_delims, len(ts))
    figures = np.frombuffer(cells[4], dtype=np.int64).reshape(n_figures, len(ts))
    return Events(ts, eid, song, delim, figures, unpacked_ids(cells[6])[np.frombuffer(cells[5], dtype=np.int32)])


class Pending:
    """The pending events of the current key: ``buffer``, and the map state ``slices``.

    ``number`` counts entries ever written (it keeps keys apart), ``first`` is the least
    event time of all entries (None without entries); both belong to the head row."""

    def __init__(self, slices, buffer: Events, number: int, first: int | None, *, slice_ms: int, held_rows: int):
        self.slices, self.buffer, self.number, self.first = slices, buffer, number, first
        self.slice_ms, self.held_rows = slice_ms, held_rows
        self.slice_rows = held_rows // SLICES_PER_BUFFER
        self.shape = (len(buffer.delim), len(buffer.figures))

    def next_ms(self) -> int | None:
        """Time of the earliest pending event."""
        times = [int(self.buffer.ts.min())] if len(self.buffer.ts) else []
        return min(times + ([self.first] if self.first is not None else []), default=None)

    def add(self, parts: list[Events]) -> None:
        self.buffer = joined([self.buffer, *parts])
        if len(self.buffer.ts) <= self.held_rows:
            return
        rows = self.buffer.take(np.argsort(self.buffer.ts, kind="stable"))
        edges = np.flatnonzero(np.diff(rows.ts // self.slice_ms)) + 1
        lo = 0
        for hi in (*edges, len(rows.ts)):
            if hi - lo >= self.slice_rows or hi == len(rows.ts):
                self.slices.updateValue((int(rows.ts[lo]), self.number), packed(rows.take(slice(lo, hi))))
                self.number += 1
                lo = hi
        self.first = int(rows.ts[0]) if self.first is None else min(self.first, int(rows.ts[0]))
        self.buffer = no_events(*self.shape)

    def due(self, watermark_ms: int) -> Events:
        """Take out the events at or before the watermark, sorted by (time, tiebreak)."""
        parts = [self.buffer]
        if self.first is not None and self.first <= watermark_ms:
            keys = list(self.slices.keys())
            for key in keys:
                if key[0] <= watermark_ms:
                    parts.append(unpacked(self.slices.getValue(key), *self.shape))
                    self.slices.removeKey(key)
            self.first = min((key[0] for key in keys if key[0] > watermark_ms), default=None)
        rows = joined(parts)
        passed = rows.ts <= watermark_ms
        self.buffer = no_events(*self.shape)
        self.add([rows.take(~passed)])
        rows = rows.take(passed)
        return rows.take(np.lexsort((rows.eid, rows.ts)))
