"""Early panes (batch) and watermark replay."""

import random

import brute
import pytest
from events import search, song
from pyspark.sql import functions as F

from cadence.operators import watermark as WM
from cadence.operators.panes import early_session_panes

GAP = 20_000
INTERVAL = 5_000


def panes(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_pane_after_opening_event_on_a_multiple(make_events):
    got = panes(early_session_panes(make_events([song(5_000, 0)]), GAP, INTERVAL))
    assert [p[3] for p in got] == [10_000, 15_000, 20_000, 24_999]
    assert got[-1] == ("1", 5_000, 25_000, 24_999, 1, True)


def test_periodic_pane_on_final_fires_once(make_events):
    # start 1 -> first fire 5000; end - 1 = 1 + 20000 - 1 + ... choose last so end-1 is a multiple.
    got = panes(early_session_panes(make_events([song(1, 0), song(1, 1)]), 19_999 + 1, INTERVAL))
    times = [p[3] for p in got]
    assert len(times) == len(set(times))
    assert got[-1][5] is True


def test_panes_accumulate(make_events):
    ev = make_events([song(1_000, 0), search(6_000, 1), song(12_000, 2)])
    got = panes(early_session_panes(ev, GAP, INTERVAL))
    assert [(p[3], p[4], p[2]) for p in got] == [
        (5_000, 1, 21_000),
        (10_000, 1, 26_000),
        (15_000, 2, 32_000),
        (20_000, 2, 32_000),
        (25_000, 2, 32_000),
        (30_000, 2, 32_000),
        (31_999, 2, 32_000),
    ]


@pytest.mark.parametrize("seed,interval", [(3, INTERVAL), (4, INTERVAL), (5, 30_000), (6, 7)])
def test_panes_random_against_brute_force(make_events, seed, interval):
    rnd = random.Random(seed)
    rows = [
        (song if rnd.random() < 0.7 else search)(rnd.randrange(200_000), eid, user=f"u{rnd.randrange(4)}")
        for eid in range(150)
    ]
    got = panes(early_session_panes(make_events(rows), GAP, interval))
    assert got == brute.panes(rows, GAP, interval)


def _arrival_rows(seed, n=300):
    rnd = random.Random(seed)
    return [(eid, rnd.randrange(3_600_000), rnd.randrange(3_600_000)) for eid in range(n)]


@pytest.mark.parametrize("width", [None, 1_000, 60_000])
def test_watermarks_against_brute_force(spark, width):
    rows = _arrival_rows(5)
    df = spark.createDataFrame(rows, "event_id long, ts_ms long, arrival_ms long")
    marker = lambda ts: (ts // 1000) % 60 < 2
    for mode, m in (("punctuated", marker), ("max", lambda ts: True)):
        for inclusive in (True, False):
            got = {
                r.event_id: r.watermark_ms
                for r in WM.running_watermark(df, mode, inclusive=inclusive, width_ms=width).collect()
            }
            assert got == brute.watermarks(rows, m, inclusive), (mode, inclusive)


@pytest.mark.parametrize("target", [None, 20])
def test_events_without_an_arrival_stay(spark, target):
    """They keep their place in the result, with a NULL watermark, and move no watermark."""
    rows = [(eid, ts, None if eid % 10 == 0 else arrival) for eid, ts, arrival in _arrival_rows(6)]
    df = spark.createDataFrame(rows, "event_id long, ts_ms long, arrival_ms long")
    want = brute.watermarks([r for r in rows if r[2] is not None], lambda ts: True, True) | {r[0]: None for r in rows if r[2] is None}
    for width in (None, 60_000):
        kw = {"width_ms": width} | ({"target_rows": target} if target else {})
        got = {r.event_id: r.watermark_ms for r in WM.max_watermark(df, **kw).collect()}
        assert got == want
        assert WM.flag_late_events(df, 1_000, "max", **kw).filter("arrival_ms IS NULL AND is_late").count() == 0


def test_late_flag(spark):
    # arrival order: ts 100 s, ts 200 s (marker-free, max mode), then ts 150 s and 170 s.
    rows = [(0, 100_000, 1), (1, 200_000, 2), (2, 150_000, 3), (3, 185_000, 4)]
    df = spark.createDataFrame(rows, "event_id long, ts_ms long, arrival_ms long").withColumn("user_id", F.lit("1"))
    late = sorted(r.event_id for r in WM.late_events(df, 20_000, "max").collect())
    # 150 s: own window ends 169.999 s <= 200 s -> late; 185 s: ends 204.999 s -> on time.
    assert late == [2]


def test_bursts_are_split_and_nothing_is_stored_without_one(spark, make_events, monkeypatch):
    """Equally wide ranges need no stored table; a burst inside one of them is dealt out anew, with the same result."""
    made = []
    monkeypatch.setattr(WM, "stored", lambda df, label: made.append(label) or df)
    rnd = random.Random(9)
    even = make_events([song(rnd.randrange(10**7), i) for i in range(400)]).withColumn("arrival_ms", F.col("event_id") * 1000)
    plain = {r.event_id: r.watermark_ms for r in WM.max_watermark(even, target_rows=10**6).collect()}
    assert {r.event_id: r.watermark_ms for r in WM.max_watermark(even, target_rows=50).collect()} == plain and not made
    burst = even.withColumn("arrival_ms", F.when(F.col("event_id") < 300, F.lit(77_000) + F.col("event_id") % 3).otherwise(F.col("arrival_ms")))
    holes = burst.withColumn("arrival_ms", F.when(F.col("event_id") % 5 != 0, F.col("arrival_ms")))
    for df in (burst, holes):
        plain = {r.event_id: r.watermark_ms for r in WM.max_watermark(df, target_rows=10**6).collect()}
        assert {r.event_id: r.watermark_ms for r in WM.max_watermark(df, target_rows=20).collect()} == plain
    assert made == ["bursts", "bursts"]
