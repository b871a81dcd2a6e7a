"""Pending events of a stream in slices: right events at the right time, and no rewriting of what waits."""

import random

import brute
import numpy as np
import pytest
from events import search, song

from cadence.streaming.pending import Events, Pending, no_events, packed, unpacked
from cadence.streaming.replay import replay
from cadence.streaming.runs import default_delimiters, runs_of, sessions_of, stream_sessions_and_runs


class Slices:
    """Map state of one key, as the engine has it, counting the bytes written."""

    def __init__(self):
        self.held, self.written = {}, 0

    def keys(self):
        return iter(self.held)

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        assert key not in self.held  # entries are only added
        self.held[key] = value
        self.written += sum(map(len, value))

    def removeKey(self, key):
        del self.held[key]


def events(ts, first_id=0):
    ts = np.asarray(ts, dtype=np.int64)
    eid = np.arange(first_id, first_id + len(ts), dtype=np.int64)
    return Events(ts, eid, eid % 2, np.vstack([eid % 3 == 0, eid % 5 == 0]), (eid * 7)[None, :])


class User:
    """The head row between batches: what the operator stores and loads again."""

    def __init__(self, slice_ms, held_rows):
        self.slices, self.settings, self.written = Slices(), {"slice_ms": slice_ms, "held_rows": held_rows}, 0
        self.head = (packed(no_events(2, 1)), 0, None)

    def step(self, run):
        cells, number, first = self.head
        before = self.slices.written
        p = Pending(self.slices, unpacked(cells, 2, 1), number, first, **self.settings)
        out = run(p)
        self.head = (packed(p.buffer), p.number, p.first)
        self.written = self.slices.written - before + sum(map(len, self.head[0]))
        return out, p


@pytest.mark.parametrize("seed", range(30))
def test_due_events_are_those_behind_the_watermark(seed):
    rnd = random.Random(seed)
    user, waiting, wm, n = User(rnd.choice([1, 50, 400, 10_000]), rnd.choice([0, 1, 7, 1000])), [], 0, 0
    for _ in range(25):
        ts = [wm + 1 + rnd.choice([rnd.randrange(2_000), rnd.randrange(0, 2_000, 400)]) for _ in range(rnd.randrange(12))]
        _, p = user.step(lambda p: p.add([events(ts[:3], n), events(ts[3:], n + min(3, len(ts)))]))  # noqa: B023
        waiting += [(t, n + i) for i, t in enumerate(ts)]
        n += len(ts)
        assert p.next_ms() == min((t for t, _ in waiting), default=None)
        wm += rnd.choice([0, 10, 300, 1_500])
        due, p = user.step(lambda p: p.due(wm))  # noqa: B023
        assert list(zip(due.ts.tolist(), due.eid.tolist())) == sorted(w for w in waiting if w[0] <= wm)
        assert due.song.tolist() == [e % 2 for e in due.eid] and due.figures[0].tolist() == [7 * e for e in due.eid]
        assert due.delim.tolist() == [[e % 3 == 0 for e in due.eid], [e % 5 == 0 for e in due.eid]]
        waiting = [w for w in waiting if w[0] > wm]
        assert p.next_ms() == min((t for t, _ in waiting), default=None)
        assert len(p.buffer.ts) <= user.settings["held_rows"]
    user.step(lambda p: p.due(10**9))
    assert not user.slices.held


def test_bytes_written_by_a_batch_do_not_grow_with_what_waits():
    """A hundred events a batch, spread over a lateness of 10 s or 1,000 s: a hundred times as many events wait, while
    the bytes a batch writes stay within what it brings, the buffer and one slice."""
    most, waited = {}, {}
    for spread in (10_000, 1_000_000):
        rnd, user, sizes = random.Random(3), User(slice_ms=1_000, held_rows=256), []
        per_batch, pace = 100, 1_000  # event time goes on by a second a batch
        for b in range(2 * spread // pace + 50):
            wm = b * pace
            user.step(lambda p: p.add([events([wm + 1 + rnd.randrange(spread) for _ in range(per_batch)])]))  # noqa: B023
            bytes_ = user.written
            user.step(lambda p: p.due(wm))  # noqa: B023
            sizes.append(bytes_ + user.written)
        most[spread] = max(sizes)
        waited[spread] = sum(len(v[0]) // 8 for v in user.slices.held.values())
    row = 4 * 8 + 2
    assert waited[1_000_000] > 40 * waited[10_000]
    assert most[1_000_000] <= (256 + 3 * 100 + 256) * row and most[1_000_000] < 2 * most[10_000]


@pytest.mark.parametrize("held_rows", [0, 5])
def test_runs_of_a_stream_with_slices(spark, make_events, held_rows):
    rnd = random.Random(held_rows)
    rows = [(song if rnd.random() < 0.8 else search)(1_000_000 + rnd.randrange(300_000), eid, user=f"u{rnd.randrange(3)}") for eid in range(150)]
    gap = 20_000
    op = lambda s, d: stream_sessions_and_runs(s, gap, default_delimiters(), watermark_delay_ms=d, slice_ms=3_000, held_rows=held_rows)
    tagged = replay(spark, make_events(rows), op, gap, n_files=5)
    assert sorted(tuple(r) for r in sessions_of(tagged, gap).collect()) == brute.session_stats(rows, gap)
    assert sorted(tuple(r) for r in runs_of(tagged, "listen").collect()) == brute.runs(rows, gap, lambda e: e[3] == "SearchEvent")
