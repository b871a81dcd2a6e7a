"""Vectorized in-order fold of users' events into sessions and runs (numpy).

Computed with array operations (tests hold it against a row-at-a-time model): session boundaries from users and time
differences, run boundaries from delimiter flags, segment sums with ``np.add.reduceat``.  Used by
the Arrow-batched ``transformWithStateInPandas`` operator, for many users in one call.

An open session is carried between calls as
``[start, last, songs, r0_start, r0_last, r0_songs, r0_figures..., r1_start, ...]``: a row of
``Open.values``, where a delimiter without an open run has ``songs`` 0, and in
``fold_arrays``, for a single user, a list with ``None`` in those fields.  Output rows are
``(kind, session_start, start, end, songs, figures...)``; ``kind`` is ``"session"`` (figures
0) or the delimiter's name.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from cadence.functions.aggregates import over_segments

SESSION = "session"
COLUMNS = ("kind", "session_start_ms", "start_ms", "end_ms", "songs")


class Open(NamedTuple):
    """Open sessions, one of a user at most, ascending by ``user`` (a number)."""

    user: np.ndarray
    values: np.ndarray


def no_open(n_delims: int, n_figures: int) -> Open:
    return Open(np.empty(0, dtype=np.int64), np.empty((0, 3 + (3 + n_figures) * n_delims), dtype=np.int64))


class Rows:
    """Output accumulated as numpy columns (one concatenation at the end)."""

    def __init__(self, n_figures: int = 0) -> None:
        self.parts: list[tuple] = []
        self.n_figures = n_figures
        self.names = (*COLUMNS, *(f"figure_{j}" for j in range(n_figures)))
        self.users: list[np.ndarray] = []

    def add(self, kind: str, user, session_start, start, end, songs, figures=()) -> None:
        n = len(start)
        if n:
            figures = figures or [np.zeros(n, dtype=np.int64)] * self.n_figures
            self.users.append(user)
            self.parts.append((np.full(n, kind, dtype=object), session_start, start, end, songs, *figures))

    def user(self) -> np.ndarray:
        """The user number of every row of ``columns``."""
        return np.concatenate(self.users) if self.users else np.empty(0, dtype=np.int64)

    def columns(self) -> dict[str, np.ndarray]:
        if not self.parts:
            return {c: np.array([], dtype=object if c == "kind" else np.int64) for c in self.names}
        return {c: np.concatenate([p[i] for p in self.parts]) for i, c in enumerate(self.names)}

    def tuples(self) -> list[tuple]:
        cols = self.columns()
        return list(zip(cols["kind"], *(cols[c].tolist() for c in self.names[1:])))


def fold_users(
    open_: Open,
    user: np.ndarray,
    ts: np.ndarray,
    song: np.ndarray,
    delims: list[np.ndarray],
    names: list[str],
    gap: int,
    merge_touching: bool = True,
    out: Rows | None = None,
    figures: list[tuple[str, np.ndarray]] = (),
    closed_ms: int | None = None,
) -> tuple[Open, Rows]:
    """Fold events sorted by (user number, ts, tiebreak) into the users' open sessions; return
    (open sessions, closed rows).  An open session is one row before its user's events,
    for each delimiter a row of the open run.

    ``figures``: kind and per-event values of each figure a run carries.  With ``closed_ms``
    a session that this time has reached by a gap is closed too."""
    out = out if out is not None else Rows(len(figures))
    width, m, k_open = 3 + len(figures), len(ts), len(open_.user)
    if m + k_open == 0:
        return open_, out
    old = open_.values
    order = np.argsort(np.concatenate([open_.user, np.asarray(user, dtype=np.int64)]), kind="stable")

    def rows(carried: np.ndarray, of_events) -> np.ndarray:
        """A column of the open sessions and one of the events, in the users' order."""
        return np.concatenate([carried, np.asarray(of_events, dtype=np.int64)])[order]

    users = rows(open_.user, user)
    first_ms, last_ms, songs = rows(old[:, 0], ts), rows(old[:, 1], ts), rows(old[:, 2], song)
    n = len(users)
    last_of_user = np.append(users[1:] != users[:-1], True)
    new = np.empty(n, dtype=bool)  # a session begins at this row
    apart = first_ms[1:] - last_ms[:-1]
    new[0] = True
    new[1:] = last_of_user[:-1] | (apart > gap if merge_touching else apart >= gap)

    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], n) - 1
    seg_user, seg_start, seg_last = users[firsts], first_ms[firsts], last_ms[lasts]
    seg_songs = np.add.reduceat(songs, firsts)
    stays = last_of_user[lasts]
    if closed_ms is not None:
        stays &= seg_last + gap > closed_ms
    seg_of_row = np.cumsum(new) - 1
    done = ~stays
    out.add(SESSION, seg_user[done], seg_start[done], seg_start[done], seg_last[done], seg_songs[done])
    values = np.zeros((int(stays.sum()), 3 + width * len(names)), dtype=np.int64)
    values[:, :3] = np.column_stack([seg_start, seg_last, seg_songs])[stays]
    row_of_seg = np.cumsum(stays) - 1  # row of an open session in ``values``

    for k, name in enumerate(names):
        at = 3 + width * k
        delim = rows(old[:, at + 2] == 0, delims[k]).astype(bool)
        key = np.cumsum(delim | new)[~delim]  # a run ends at a delimiter or a new session
        kept = np.flatnonzero(~delim)
        if not len(kept):
            continue
        run_firsts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        run_lasts = np.append(run_firsts[1:], len(kept)) - 1
        run = [
            rows(old[:, at], ts)[kept[run_firsts]],
            rows(old[:, at + 1], ts)[kept[run_lasts]],
            np.add.reduceat(rows(old[:, at + 2], np.ones(m))[kept], run_firsts),
        ]
        run += [over_segments(kind, rows(old[:, at + 3 + j], v)[kept], run_firsts, run_lasts) for j, (kind, v) in enumerate(figures)]
        seg = seg_of_row[kept[run_firsts]]
        is_open = stays[seg] & (kept[run_lasts] == lasts[seg])  # it holds an open session's last row
        values[row_of_seg[seg[is_open]], at : at + width] = np.column_stack(run)[is_open]
        over = ~is_open
        out.add(name, seg_user[seg[over]], seg_start[seg[over]], *(c[over] for c in run[:3]), figures=[c[over] for c in run[3:]])
    return Open(seg_user[stays], values), out


def fold_arrays(
    sess: list | None,
    ts: np.ndarray,
    song: np.ndarray,
    delims: list[np.ndarray],
    names: list[str],
    gap: int,
    merge_touching: bool = True,
    out: Rows | None = None,
    figures: list[tuple[str, np.ndarray]] = (),
) -> tuple[list | None, Rows]:
    """``fold_users`` for one user, whose open session is a list or None."""
    open_ = no_open(len(names), len(figures))
    if sess is not None:
        open_ = Open(np.zeros(1, dtype=np.int64), np.array([[0 if v is None else v for v in sess]], dtype=np.int64))
    open_, out = fold_users(open_, np.zeros(len(ts)), ts, song, delims, names, gap, merge_touching, out, figures)
    if not len(open_.user):
        return None, out
    sess, width = open_.values[0].tolist(), 3 + len(figures)
    for at in range(3, len(sess), width):
        if sess[at + 2] == 0:
            sess[at : at + width] = [None] * width
    return sess, out
