"""The arrival-order replay against an event-driven model with timers."""

import random

import pytest
from events import search, song

from cadence.operators.arrival import arrival_sessions, dropped_events, lateness_rules, replay_arrivals, watermark_panes
from cadence.operators.bucketing import Bucketing
from cadence.operators.watermark import late_events
from cadence.schema import EVENT_SCHEMA

MARK = 60_000  # second 0 of a minute: a marker
END = 1 << 62


def engine(rows, gap, interval, marker, drain=True):
    """One event at a time, timers in a set: fires in timer order at every rise of the watermark.

    rows: (arrival, event_id, user, ts, songs).  Returns panes (user, start, end, fire, songs, final) and dropped ids."""
    panes, dropped, windows, wm = [], [], {}, None

    def advance(to):
        nonlocal wm
        wm = to
        while True:
            due = [(min(w["fire"], w["end"] - 1), u, k) for u in windows for k, w in enumerate(windows[u]) if min(w["fire"], w["end"] - 1) <= to]
            if not due:
                return
            at, u, k = min(due)
            w = windows[u][k]
            final = at == w["end"] - 1
            panes.append((u, w["start"], w["end"], at, w["songs"], final))
            if final:
                windows[u].pop(k)
            else:
                w["fire"] += interval

    for _, eid, u, ts, n in sorted(rows):
        live = windows.setdefault(u, [])
        new = {"start": ts, "end": ts + gap, "songs": n, "fire": None}
        touching = [w for w in live if w["start"] <= new["end"] and new["start"] <= w["end"]]
        for w in touching:
            new = {"start": min(new["start"], w["start"]), "end": max(new["end"], w["end"]), "songs": new["songs"] + w["songs"],
                   "fire": w["fire"] if new["fire"] is None else min(new["fire"], w["fire"])}
        if wm is not None and new["end"] - 1 <= wm:
            dropped.append(eid)
        else:
            if new["fire"] is None:
                new["fire"] = ts - ts % interval + interval
            windows[u] = [w for w in live if w not in touching] + [new]
        if marker(ts) and (wm is None or ts > wm):
            advance(ts)
    if drain:
        advance(END)
    return sorted(panes), sorted(dropped)


def frame(spark, rows):
    """rows: (arrival, event_id, user, ts, songs)."""
    made = [(song if n else search)(ts, eid, user=u) + (a,) for a, eid, u, ts, n in rows]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)
    return spark.createDataFrame(made, fields + ", arrival_ms long")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def jittered(seed, n=400, users=5, jitter=90_000, step=9_000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ts = rng.randrange(0, n * step // users)
        if rng.random() < 0.3:
            ts -= ts % 60_000
        rows.append((ts + rng.randrange(-jitter, jitter), i, str(rng.randrange(users)), ts, rng.random() < 0.7))
    return [(a, i, u, t, int(s)) for a, i, u, t, s in rows]


@pytest.mark.parametrize(("mode", "gap", "interval"), [("punctuated", 20_000, 5_000), ("max", 20_000, 5_000), ("punctuated", 60_000, 7_000), ("max", 3_000, 50_000), ("max", 60_000, 1_000)])
def test_random_arrivals_against_the_engine_model(spark, mode, gap, interval):
    marker = (lambda ts: ts // 1000 % 60 < 2) if mode == "punctuated" else (lambda ts: True)
    rows = jittered(gap + interval)
    panes, dropped = engine(rows, gap, interval, marker)
    ev = frame(spark, rows)
    assert dropped and got(watermark_panes(ev, gap, interval, mode=mode)) == panes
    assert [r[0] for r in got(dropped_events(ev, gap, mode=mode))] == dropped
    small = Bucketing(adaptive=True, target_rows=20)
    assert got(watermark_panes(ev, gap, interval, mode=mode, bucketing=small, width_ms=50_000)) == panes
    assert got(arrival_sessions(ev, gap, mode=mode)) == sorted((u, s, e, (e - s) // 1000, n) for u, s, e, _, n, f in panes if f)


def test_pause_leaves_sessions_open(spark):
    rows = jittered(7)
    panes, _ = engine(rows, 20_000, 5_000, lambda ts: ts // 1000 % 60 < 2, drain=False)
    ev = frame(spark, rows)
    assert got(watermark_panes(ev, 20_000, 5_000, drain=False)) == panes
    assert len(panes) < ev.transform(lambda d: watermark_panes(d, 20_000, 5_000)).count()


def test_a_late_event_that_touches_a_live_session_is_kept(spark):
    # Session [50 s, 130 s) is live at watermark 80 s when 20 s arrives with a gap of 50 s.
    rows = [(1, 1, "u", 50_000, 1), (2, 2, "u", 80_000, 1), (3, 3, "v", 80_000, 0), (4, 4, "u", 20_000, 1), (5, 5, "w", 20_000, 1)]
    ev = frame(spark, rows)
    assert got(lateness_rules(ev, 50_000, "max").select("event_id", "is_dropped")) == [(4, False), (5, True)]
    assert got(late_events(ev, 50_000, "max").select("event_id")) == [(4,), (5,)]
    assert ("u", 20_000, 130_000, 110, 3) in got(arrival_sessions(ev, 50_000, mode="max"))


def test_an_event_that_joins_two_live_sessions(spark):
    rows = [(1, 1, "u", 10_000, 1), (2, 2, "u", 40_000, 1), (3, 3, "u", 25_000, 1)]
    assert got(watermark_panes(frame(spark, rows), 20_000, 10_000)) == engine(rows, 20_000, 10_000, lambda ts: False)[0]
    assert got(arrival_sessions(frame(spark, rows), 20_000)) == [("u", 10_000, 60_000, 50, 3)]


def test_a_closed_session_is_not_reopened(spark):
    # The watermark passes the end of [0, 20 s) before 19 s arrives: its own window [19 s, 39 s) is still open.
    rows = [(1, 1, "u", 0, 1), (2, 2, "v", 30_000, 0), (3, 3, "u", 19_000, 1)]
    ev = frame(spark, rows)
    assert [r[:3] for r in got(arrival_sessions(ev, 20_000, mode="max")) if r[0] == "u"] == [("u", 0, 20_000), ("u", 19_000, 39_000)]
    assert got(dropped_events(ev, 20_000, mode="max")) == []


def test_fire_times_already_passed_fire_at_the_next_rise(spark):
    # v moves the watermark to 60 s; u opens a session at 45 s whose first fire times lie behind it.
    rows = [(1, 1, "v", MARK, 1), (2, 2, "u", 45_000, 1), (3, 3, "u", 47_000, 1), (4, 4, "v", MARK + 500, 0)]
    want = engine(rows, 30_000, 5_000, lambda ts: ts // 1000 % 60 < 2)[0]
    assert ("u", 45_000, 77_000, 50_000, 2, False) in want
    assert got(watermark_panes(frame(spark, rows), 30_000, 5_000)) == want


def test_edges(spark):
    rows = [(1, 1, "u", 5, 1), (1, 2, "u", 5, 1)]
    ev = frame(spark, rows)
    holes = spark.createDataFrame([(9, None, 5, "SongEvent", "EndSong", "Mobile", "DailyMix", "x", 1), (10, "u", None, "SongEvent", "EndSong", "Mobile", "DailyMix", "x", 1), (11, "u", 5, "SongEvent", "EndSong", "Mobile", "DailyMix", "x", None)], ev.schema)
    assert got(arrival_sessions(ev.unionAll(holes), 20_000)) == [("u", 5, 20_005, 20, 2)]
    assert got(replay_arrivals(ev.where("false"), 20_000, 5_000)) == []
    # Strict sessions: events exactly one gap apart stay apart.
    apart = frame(spark, [(1, 1, "u", 0, 1), (2, 2, "u", 20_000, 1)])
    assert len(got(arrival_sessions(apart, 20_000))) == 1 and len(got(arrival_sessions(apart, 20_000, merge_touching=False))) == 2
    with pytest.raises(ValueError):
        watermark_panes(ev, 20_000, 0)
