"""Stateful stream operators keep users in groups: right rows for each user, and no more keys than groups."""

import random

import brute
import numpy as np
import pytest
from events import search, song

from cadence.streaming import panes, runs
from cadence.streaming.fold import SESSION, Open, fold_arrays, fold_users, no_open
from cadence.streaming.panes import as_rows, due_panes, merge_event, merge_users, panes_of_users, stream_early_panes
from cadence.streaming.pending import Events, packed, unpacked
from cadence.streaming.replay import replay
from cadence.streaming.runs import default_delimiters, runs_of, sessions_of, stream_sessions_and_runs

GAP, INTERVAL = 20_000, 5_000


@pytest.mark.parametrize("seed", range(20))
def test_users_folded_together_are_as_folded_alone(seed):
    rnd = random.Random(seed)
    names, kinds, users = ["a", "b"], ["sum", "first", "last", "max"], 5
    together, alone, wm = no_open(2, 4), [None] * users, 0
    for _ in range(8):
        ev = sorted((wm + 1 + rnd.randrange(60_000), i, rnd.randrange(users), rnd.random() < 0.3, rnd.random() < 0.2) for i in range(rnd.randrange(30)))
        wm += 60_000
        cols = np.array(ev, dtype=np.int64).reshape(-1, 5).T
        together, out = fold_users(
            together, cols[2], cols[0], cols[1] % 2, [cols[3] > 0, cols[4] > 0], names, GAP, figures=[(k, cols[1]) for k in kinds], closed_ms=wm
        )
        got = sorted((u, *row) for u, row in zip(out.user().tolist(), out.tuples(), strict=True))
        want = []
        for u in range(users):
            c = cols[:, cols[2] == u]
            alone[u], rows = fold_arrays(alone[u], c[0], c[1] % 2, [c[3] > 0, c[4] > 0], names, GAP, figures=[(k, c[1]) for k in kinds])
            want += [(u, *row) for row in rows.tuples()]
            if alone[u] is not None and alone[u][1] + GAP <= wm:  # the time alone closes it: as a far event does
                _, rows = fold_arrays(alone[u], np.array([10**9]), np.array([0]), [np.array([True])] * 2, names, GAP, figures=[(k, np.array([0])) for k in kinds])
                want += [(u, *row) for row in rows.tuples()]
                alone[u] = None
        assert got == sorted(want)
        assert together.user.tolist() == [u for u in range(users) if alone[u] is not None]
    assert isinstance(together, Open) and SESSION == "session"


@pytest.mark.parametrize("seed", range(20))
def test_panes_of_users_together_are_as_alone(seed):
    rnd = random.Random(seed)
    live, alone, wm = np.empty((0, 5), dtype=np.int64), [[] for _ in range(4)], 0
    for _ in range(6):
        ev = [(rnd.randrange(4), wm + rnd.randrange(120_000), rnd.randrange(2)) for _ in range(rnd.randrange(25))]
        cols = np.array(ev, dtype=np.int64).reshape(-1, 3)
        live = merge_users(live, as_rows(cols[:, 0], cols[:, 1], cols[:, 2], INTERVAL), GAP)
        for u, t, s in ev:
            alone[u] = merge_event(alone[u], t, s, GAP, INTERVAL)
        assert live.tolist() == [[u, *s] for u in range(4) for s in alone[u]]
        wm += rnd.randrange(150_000)
        users, cols, live = panes_of_users(live, wm, GAP, INTERVAL)
        want, of = {c: [] for c in cols}, []
        for u in range(4):
            due, alone[u] = due_panes(str(u), alone[u], wm, GAP, INTERVAL)
            of += [u] * len(due["pane_ms"])
            for c in want:
                want[c] += due[c]
        assert users.tolist() == of and {c: v.tolist() for c, v in cols.items()} == want


def test_user_ids_of_packed_events():
    ids = np.array(["b", None, "", "\u00e9\x00", "b", "\x00"], dtype=object)
    n = np.arange(6, dtype=np.int64)
    events = Events(n, n, n, np.zeros((1, 6), bool), np.empty((0, 6), np.int64), ids)
    assert unpacked(packed(events), 1, 0).user.tolist() == ids.tolist()


def test_streams_have_no_more_keys_than_groups(spark, make_events, monkeypatch, tmp_path):
    """The engine calls the operator for groups: 40 users in 3 groups, each with the rows of the batch."""
    rnd = random.Random(4)
    rows = [(song if rnd.random() < 0.7 else search)(1_000_000 + rnd.randrange(300_000), i, user=f"u{rnd.randrange(40)}") for i in range(300)]
    for module, name in ((runs, "IncrementalRunsProcessor"), (panes, "EarlyPanesProcessor")):
        whole, folder = getattr(module, name), tmp_path / name
        folder.mkdir()

        class Noted(whole):
            def __init__(self, *args, folder=str(folder)):
                super().__init__(*args)
                self.folder = folder

            def handleInputRows(self, key, rows, timerValues):
                open(f"{self.folder}/{key[0]}", "w").close()
                return super().handleInputRows(key, rows, timerValues)

        monkeypatch.setattr(module, name, Noted)
    tagged = replay(spark, make_events(rows), lambda s, d: stream_sessions_and_runs(s, GAP, default_delimiters(), watermark_delay_ms=d, user_groups=3), GAP, n_files=2)
    assert sorted(tuple(r) for r in sessions_of(tagged, GAP).collect()) == brute.session_stats(rows, GAP)
    assert sorted(tuple(r) for r in runs_of(tagged, "listen").collect()) == brute.runs(rows, GAP, lambda e: e[3] == "SearchEvent")
    fired = replay(spark, make_events(rows), lambda s, d: stream_early_panes(s, GAP, INTERVAL, watermark_delay_ms=d, user_groups=3), GAP, n_files=2)
    final = sorted((r.user_id, r.start_ms, r.end_ms, (r.end_ms - r.start_ms) // 1000, r.songs) for r in fired.filter("is_final").collect())
    assert final == brute.session_stats(rows, GAP)
    for name in ("IncrementalRunsProcessor", "EarlyPanesProcessor"):
        assert 1 <= len(list((tmp_path / name).iterdir())) <= 3
