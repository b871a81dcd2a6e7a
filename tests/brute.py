"""Brute-force Python models of the operators, for randomized comparison."""

from __future__ import annotations

from collections import defaultdict


def by_user(rows):
    """rows: (event_id, user, ts, type, event_type, device, playlist, songid)."""
    out = defaultdict(list)
    for r in rows:
        out[r[1]].append(r)
    for u in out:
        out[u].sort(key=lambda r: (r[2], r[0]))
    return out


def sessions(rows, gap, merge_touching=True):
    """[(user, [events...])] in order."""
    res = []
    for u, evs in by_user(rows).items():
        cur = []
        for e in evs:
            if cur:
                d = e[2] - cur[-1][2]
                if d > gap or (not merge_touching and d >= gap):
                    res.append((u, cur))
                    cur = []
            cur.append(e)
        if cur:
            res.append((u, cur))
    return res


def session_stats(rows, gap, duration="window", merge_touching=True):
    out = []
    for u, evs in sessions(rows, gap, merge_touching):
        start, last = evs[0][2], evs[-1][2]
        end = last + gap if duration == "window" else last
        out.append((u, start, end, (end - start) // 1000, sum(e[3] == "SongEvent" for e in evs)))
    return sorted(out)


def runs(rows, gap, is_delim):
    out = []
    for u, evs in sessions(rows, gap):
        cur = []
        for e in evs + [None]:
            if e is None or is_delim(e):
                if cur:
                    out.append((u, evs[0][2], cur[0][2], cur[-1][2], (cur[-1][2] - cur[0][2]) // 1000, len(cur)))
                cur = []
            else:
                cur.append(e)
    return sorted(out)


def panes(rows, gap, interval):
    out = []
    for u, evs in sessions(rows, gap):
        start, last = evs[0][2], evs[-1][2]
        final = last + gap - 1
        f = start - start % interval + interval
        times = list(range(f, final + 1, interval)) if f <= final else []
        if final not in times:
            times.append(final)
        for b in times:
            seen = [e for e in evs if e[2] <= b]
            out.append((u, start, max(e[2] for e in seen) + gap, b, sum(e[3] == "SongEvent" for e in seen), b == final))
    return sorted(out)


def watermarks(rows_with_arrival, marker, inclusive=True):
    """rows: (event_id, ts, arrival); returns {event_id: watermark}."""
    order = sorted(rows_with_arrival, key=lambda r: (r[2], r[0]))
    wm, out = None, {}
    for eid, ts, _ in order:
        if not inclusive:
            out[eid] = wm
        if marker(ts):
            wm = ts if wm is None else max(wm, ts)
        if inclusive:
            out[eid] = wm
    return out


SESSION = "session"


class SessionFold:
    """In-order fold of one user's events into sessions and runs, one event at a time.

    The model of ``cadence.streaming.fold.fold_arrays`` (the vectorized fold the
    stream operator runs)."""

    def __init__(self, gap: int, n_delims: int, merge_touching: bool = True):
        self.gap, self.n, self.touching = gap, n_delims, merge_touching

    def splits(self, delta: int) -> bool:
        return delta > self.gap if self.touching else delta >= self.gap

    def close_runs(self, sess: list, out: list, names: list[str]) -> None:
        for k in range(self.n):
            r = 3 + 3 * k
            if sess[r] is not None:
                out.append((names[k], sess[0], sess[r], sess[r + 1], sess[r + 2]))
                sess[r] = sess[r + 1] = sess[r + 2] = None

    def close(self, sess: list, out: list, names: list[str]) -> None:
        self.close_runs(sess, out, names)
        out.append((SESSION, sess[0], sess[0], sess[1], sess[2]))

    def fold(self, sess: list | None, events: list[tuple], names: list[str]) -> tuple[list | None, list]:
        """events sorted by (ts, eid): (ts, eid, song, delim_0, ..., delim_{n-1})."""
        out: list = []
        for e in events:
            ts, song, delims = e[0], e[2], e[3:]
            if sess is not None and self.splits(ts - sess[1]):
                self.close(sess, out, names)
                sess = None
            if sess is None:
                sess = [ts, ts, 0] + [None, None, None] * self.n
            sess[1] = ts
            sess[2] += song
            for k in range(self.n):
                r = 3 + 3 * k
                if delims[k]:
                    if sess[r] is not None:
                        out.append((names[k], sess[0], sess[r], sess[r + 1], sess[r + 2]))
                        sess[r] = sess[r + 1] = sess[r + 2] = None
                elif sess[r] is None:
                    sess[r], sess[r + 1], sess[r + 2] = ts, ts, 1
                else:
                    sess[r + 1], sess[r + 2] = ts, sess[r + 2] + 1
        return sess, out
