"""Streaming: append-mode sessions/runs, late drop, stateful early panes."""

import os

import pytest
from events import search, song
from pyspark.sql import functions as F

from cadence.functions import codec
from cadence.schema import EVENT_SCHEMA
from cadence.session import scratch_path
from cadence.streaming import sessions as SS
from cadence.streaming.panes import due_panes, merge_event, stream_early_panes
from cadence.streaming.replay import replay
from cadence.streaming.sinks import start_sink
from cadence.streaming.sources import read_event_stream


def run_batches(spark, batches, build, label):
    """Feed each list of rows as its own micro-batch (delay 0); return sink rows."""
    root = scratch_path(spark, label)
    inp, out, ckpt = (os.path.join(root, d) for d in ("in", "out", "ck"))
    result = None
    for rows in batches:
        codec.encode(spark.createDataFrame(rows, EVENT_SCHEMA)).coalesce(1).write.mode("append").parquet(inp)
        if result is None:
            result = build(read_event_stream(spark, "parquet", path=inp, options={"maxFilesPerTrigger": "1"}))
        q = start_sink(result, "parquet", ckpt, path=out, available_now=True)
        q.awaitTermination()
    return spark.read.parquet(out)


def test_late_event_dropped(spark):
    gap = 50_000
    batches = [
        [song(50_000, 0), song(80_000, 1)],  # watermark -> 80 s
        [song(20_000, 2)],  # own window [20 s, 70 s) is behind the watermark: dropped
        [search(10_000_000, 3, user="~s")],
        [search(20_000_000, 4, user="~s")],
    ]
    out = run_batches(spark, batches, lambda s: SS.stream_session_stats(s, gap), "late-drop")
    got = sorted(tuple(r) for r in out.filter(F.col("user_id") != "~s").collect())
    assert got == [("1", 50_000, 130_000, 80, 2)]


def test_island_fold_through_stream(spark, make_events):
    rows = [song(1000, 1), song(2000, 2), search(3000, 3), song(4000, 4), search(5000, 5), search(6000, 6), song(7000, 7)]
    from cadence.streaming.runs import stream_listening_runs

    out = replay(spark, make_events(rows), lambda s, d: stream_listening_runs(s, 20_000, watermark_delay_ms=d), 20_000)
    assert sorted((r.songs, r.length_s) for r in out.collect()) == [(1, 0), (1, 0), (2, 1)]


def test_stream_session_stats_span_dialect(spark, make_events):
    rows = [song(1_000, 0), search(4_500, 1), song(7_999, 2), song(60_000, 3)]
    op = lambda s, d: SS.stream_session_stats(s, 20_000, duration="span", watermark_delay_ms=d)
    out = replay(spark, make_events(rows), op, 20_000)
    assert sorted(tuple(r) for r in out.collect()) == [("1", 1_000, 7_999, 6, 2), ("1", 60_000, 60_000, 0, 1)]


def test_merge_event_logic():
    s = merge_event([], 1_000, 1, 20_000, 5_000)
    assert s == [[1_000, 1_000, 1, 5_000]]
    s = merge_event(s, 40_000, 0, 20_000, 5_000)
    assert len(s) == 2
    # An out-of-order event touching both sessions merges all three.
    s = merge_event(s, 20_500, 1, 20_000, 5_000)
    assert s == [[1_000, 40_000, 2, 5_000]]


def test_due_panes_logic():
    cols, live = due_panes("u", [[1_000, 3_000, 2, 5_000]], 12_000, 20_000, 5_000)
    assert cols["pane_ms"] == [5_000, 10_000] and live == [[1_000, 3_000, 2, 15_000]]
    cols, live = due_panes("u", live, 30_000, 20_000, 5_000)
    assert list(zip(cols["pane_ms"], cols["is_final"])) == [(15_000, False), (20_000, False), (22_999, True)]
    assert live == []


def test_merge_batch_equals_one_by_one():
    import random

    import numpy as np

    from cadence.streaming.panes import merge_batch

    rnd = random.Random(7)
    for _ in range(200):
        sessions_a = sessions_b = []
        for _ in range(rnd.randrange(1, 5)):  # several batches, out of order
            ts = [rnd.randrange(300_000) for _ in range(rnd.randrange(1, 15))]
            song = [rnd.randrange(2) for _ in ts]
            for t, s_ in zip(ts, song):
                sessions_a = merge_event(sessions_a, t, s_, 20_000, 5_000)
            sessions_b = merge_batch(sessions_b, np.array(ts), np.array(song), 20_000, 5_000)
            assert sessions_a == sessions_b


def test_stateful_panes_stream(spark, make_events):
    rows = [song(1_000, 0), search(6_000, 1), song(12_000, 2), song(100_000, 3, user="2")]
    op = lambda s, d: stream_early_panes(s, 20_000, 5_000, watermark_delay_ms=d)
    out = replay(spark, make_events(rows), op, 20_000)
    finals = sorted((r.user_id, r.start_ms, r.end_ms, r.songs) for r in out.filter("is_final").collect())
    assert finals == [("1", 1_000, 32_000, 2), ("2", 100_000, 120_000, 1)]
    # Every pane of a session carries that session's fire times in order, the final one last.
    u1 = sorted(r.pane_ms for r in out.filter(F.col("user_id") == "1").collect())
    assert u1 == [5_000, 10_000, 15_000, 20_000, 25_000, 30_000, 31_999]


def test_stateful_operators_keep_what_is_late_only_to_the_engine(spark):
    """Out of order by less than a gap, equal times in a later batch included: all three
    stream operators report the batch result, with no allowance for lateness."""
    from cadence.streaming.runs import default_delimiters, sessions_of, stream_sessions_and_runs

    gap, t0 = 20_000, 1_000_000
    batches = [[song(t0, 0)], [song(t0, 1), song(t0 - 5_000, 2)], [song(t0 + 5_000, 3)],
               [search(10_000_000, 6, user="~s")], [search(20_000_000, 7, user="~s")]]
    want = [(t0 - 5_000, t0 + 25_000, 4)]
    builds = {
        "jvm": lambda s: SS.stream_session_stats(s, gap),
        "runs": lambda s: sessions_of(stream_sessions_and_runs(s, gap, default_delimiters()), gap),
        "panes": lambda s: stream_early_panes(s, gap, 5_000).filter("is_final"),
    }
    for name, build in builds.items():
        out = run_batches(spark, batches, build, f"late-{name}").filter("user_id = '1'")
        assert sorted((r.start_ms, r.end_ms, r.songs) for r in out.collect()) == want, name


def test_stateful_operators_drop_an_event_whose_window_is_behind(spark):
    gap, t0 = 20_000, 1_000_000
    late, kept = t0 - gap + 1, t0 - gap + 2  # own windows end at t0 and t0 + 1 ms
    batches = [[song(t0, 0)], [song(late, 1), song(kept, 2, user="2")],
               [search(10_000_000, 6, user="~s")], [search(20_000_000, 7, user="~s")]]
    out = run_batches(spark, batches, lambda s: stream_early_panes(s, gap, 5_000), "tws-late")
    finals = sorted((r.user_id, r.start_ms, r.songs) for r in out.filter("is_final AND user_id <> '~s'").collect())
    assert finals == [("1", t0, 1), ("2", kept, 1)]


def test_merge_batch_strict_gap():
    import numpy as np

    from cadence.streaming.panes import merge_batch

    ts, song_ = np.array([0, 20_000, 39_999]), np.array([1, 1, 1])
    assert [s[:3] for s in merge_batch([], ts, song_, 20_000, 5_000, False)] == [[0, 0, 1], [20_000, 39_999, 2]]
    assert [s[:3] for s in merge_batch([], ts, song_, 20_000, 5_000, True)] == [[0, 39_999, 3]]


def test_session_fold_logic():
    from brute import SessionFold

    fold = SessionFold(20_000, 1)
    ev = [(1_000, 1, 1, False), (2_000, 2, 1, False), (3_000, 3, 0, True), (4_000, 4, 1, False), (90_000, 5, 1, False)]
    sess, out = fold.fold(None, ev, ["l"])
    assert out == [("l", 1_000, 1_000, 2_000, 2), ("l", 1_000, 4_000, 4_000, 1), ("session", 1_000, 1_000, 4_000, 3)]
    assert sess[:3] == [90_000, 90_000, 1]


def test_incremental_runs_match_batch(spark, make_events):
    import random

    import brute
    from cadence.streaming.runs import default_delimiters, runs_of, sessions_of, stream_sessions_and_runs

    rnd = random.Random(11)
    rows = [
        (song if rnd.random() < 0.7 else search)(rnd.randrange(300_000), eid, user=f"u{rnd.randrange(3)}")
        if rnd.random() < 0.8
        else song(rnd.randrange(300_000), eid, user=f"u{rnd.randrange(3)}", playlist="DiscoverWeekly")
        for eid in range(120)
    ]
    gap = 20_000
    op = lambda s, d: stream_sessions_and_runs(s, gap, default_delimiters(), watermark_delay_ms=d)
    tagged = replay(spark, make_events(rows), op, gap, n_files=4)
    assert sorted(tuple(r) for r in sessions_of(tagged, gap).collect()) == brute.session_stats(rows, gap)
    assert sorted(tuple(r) for r in runs_of(tagged, "listen").collect()) == brute.runs(
        rows, gap, lambda e: e[3] == "SearchEvent"
    )
    assert sorted(tuple(r) for r in runs_of(tagged, "dw").collect()) == brute.runs(
        rows, gap, lambda e: e[3] == "SearchEvent" or e[6] != "DiscoverWeekly"
    )


def test_incremental_runs_in_order_batches(spark):
    from cadence.streaming.runs import default_delimiters, runs_of, stream_sessions_and_runs

    batches = [
        [song(1_000, 1), song(2_000, 2)],
        [search(3_000, 3), song(4_000, 4)],
        [song(100_000, 5)],
        [search(10_000_000, 6, user="~s")],
        [search(20_000_000, 7, user="~s")],
    ]
    out = run_batches(spark, batches, lambda s: stream_sessions_and_runs(s, 20_000, default_delimiters()), "incr")
    got = sorted((r.session_start_ms, r.start_ms, r.songs) for r in runs_of(out, "listen").filter("user_id = '1'").collect())
    assert got == [(1_000, 1_000, 2), (1_000, 4_000, 1), (100_000, 100_000, 1)]


def test_late_event_view(spark):
    from cadence.streaming.late import start_late_event_view

    root = scratch_path(spark, "late-view")
    inp, out = os.path.join(root, "in"), os.path.join(root, "out")
    batches = [
        [song(50_000, 0), song(80_000, 1)],          # max watermark -> 80 s
        [song(20_000, 2), song(79_000, 3)],          # 20 s: [20 s, 70 s) ended by 80 s -> late; 79 s is not
        [song(60_500, 4), song(121_000, 5)],         # watermark still 80 s here: 60.5 s + 20 s - 1 ms > 80 s
        [song(150_000, 6), song(60_500, 7)],         # 121 s from the batch before, 150 s from event 6: late by the latter
    ]
    for rows in batches:
        codec.encode(spark.createDataFrame(rows, EVENT_SCHEMA)).coalesce(1).write.mode("append").parquet(inp)
        ev = read_event_stream(spark, "parquet", path=inp, options={"maxFilesPerTrigger": "1"})
        start_late_event_view(ev, 20_000, os.path.join(root, "ck"), out, mode="max", available_now=True).awaitTermination()
    got = sorted((r.event_id, r.watermark_ms) for r in spark.read.parquet(os.path.join(out, "batch=*")).collect())
    assert got == [(2, 80_000), (7, 150_000)]


@pytest.mark.parametrize(("mode", "cuts"), [("punctuated", [1]), ("punctuated", [7, 60, 61, 200]), ("max", [100]), ("max", [3, 4, 150])])
def test_late_event_view_is_exact_for_any_cut_into_batches(spark, mode, cuts):
    """Every cut of one arrival order gives the rows of the batch operator, watermarks included."""
    import random

    from cadence.operators.watermark import late_events
    from cadence.streaming.late import start_late_event_view

    rng = random.Random(len(cuts))
    rows = [song(ts, i, user=str(rng.randrange(5))) for i, ts in enumerate(max(0, i * 2_000 + rng.randrange(-60_000, 60_000)) for i in range(250))]
    # Arrivals in steps of 2 ms with ties; the tie is broken by event_id.
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields) + ", arrival_ms long"
    whole = spark.createDataFrame([r + (r[0] // 2,) for r in rows], fields)
    want = sorted((r.event_id, r.watermark_ms) for r in late_events(whole, 20_000, mode).collect())
    assert want
    root = scratch_path(spark, "late-cuts")
    inp, out = os.path.join(root, "in"), os.path.join(root, "out")
    for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
        whole.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)).repartition(3).write.mode("append").parquet(inp)
        ev = spark.readStream.schema(whole.schema).parquet(inp)
        start_late_event_view(ev, 20_000, os.path.join(root, "ck"), out, mode=mode, available_now=True).awaitTermination()
    found = spark.read.parquet(os.path.join(out, "batch=*"))
    assert sorted((r.event_id, r.watermark_ms) for r in found.collect()) == want


def test_late_event_view_matches_batch_replay(spark, make_events):
    """One event per micro-batch, in arrival order: the stream view flags exactly
    the events the batch replay flags."""
    from cadence.operators import watermark as WM
    from cadence.streaming.late import start_late_event_view

    arrivals = [61_000, 5_000, 121_500, 64_000, 100_000, 125_000, 30_000, 181_000, 150_000]
    rows = [song(ts, eid) for eid, ts in enumerate(arrivals)]
    replay_df = make_events(rows).withColumn("arrival_ms", F.col("event_id"))
    expected = sorted(r.event_id for r in WM.late_events(replay_df, 20_000, "punctuated").collect())
    assert expected  # markers at 61 s, 121.5 s, 181 s make some events late

    root = scratch_path(spark, "late-view-eq")
    inp, out = os.path.join(root, "in"), os.path.join(root, "out")
    for r in rows:
        codec.encode(spark.createDataFrame([r], EVENT_SCHEMA)).coalesce(1).write.mode("append").parquet(inp)
        ev = read_event_stream(spark, "parquet", path=inp, options={"maxFilesPerTrigger": "1"})
        start_late_event_view(ev, 20_000, os.path.join(root, "ck"), out, available_now=True).awaitTermination()
    got = sorted(r.event_id for r in spark.read.parquet(os.path.join(out, "batch=*")).collect())
    assert got == expected


def test_stateful_panes_fire_as_the_watermark_passes(spark):
    # In order, delay 0.  The 5 s pane fires once the watermark reaches 6 s and holds
    # what was received by then; the 10 s pane fires at watermark 12 s and already
    # holds the 12 s song (everything received so far, as when a watermark jumps).
    batches = [
        [song(1_000, 0)],
        [search(6_000, 1)],
        [song(12_000, 2)],
        [search(10_000_000, 3, user="~s")],
        [search(20_000_000, 4, user="~s")],
    ]
    out = run_batches(spark, batches, lambda s: stream_early_panes(s, 20_000, 5_000), "panes-inorder")
    got = sorted((r.pane_ms, r.songs, r.end_ms, r.is_final) for r in out.filter("user_id = '1'").collect())
    assert got[0] == (5_000, 1, 26_000, False)
    assert got[1] == (10_000, 2, 32_000, False)
    assert got[-1] == (31_999, 2, 32_000, True)


def test_stream_strict_gap_equals_batch(spark, make_events):
    from cadence.operators.sessions import session_stats

    rows = [song(0, 0), song(20_000, 1), search(40_000, 2), song(61_000, 3), song(70_000, 4, user="2"), song(90_000, 5, user="2")]
    ev = make_events(rows)
    for touching in (True, False):
        op = lambda s, d, t=touching: SS.stream_session_stats(s, 20_000, watermark_delay_ms=d, merge_touching=t)
        got = sorted(tuple(r) for r in replay(spark, ev, op, 20_000).collect())
        assert got == sorted(tuple(r) for r in session_stats(ev, 20_000, merge_touching=touching).collect()), touching


def test_session_window_pre_merges_before_the_shuffle(spark, make_events):
    root = scratch_path(spark, "sw-plan")
    inp = os.path.join(root, "in")
    codec.encode(make_events([song(1_000, 0), song(2_000, 1)])).write.parquet(inp)
    s = SS.stream_session_stats(read_event_stream(spark, "parquet", path=inp), 20_000)
    q = s.writeStream.format("memory").queryName("sw_plan_test").outputMode("append").start()
    try:
        q.processAllAvailable()
        plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    finally:
        q.stop()
    below_exchange = plan.split("Exchange hashpartitioning(user_id")[1]
    assert "MergingSessions" in below_exchange


def test_stream_runs_strict_gap_equals_batch(spark, make_events):
    # Times start after the epoch: Spark's watermark starts at 0, and the stateful
    # operator drops rows at or below it.
    from cadence.functions.predicates import is_search
    from cadence.operators.sessions import split_runs
    from cadence.streaming.runs import stream_listening_runs

    t0 = 1_000_000
    rows = [song(t0, 0), song(t0 + 20_000, 1), search(t0 + 30_000, 2), song(t0 + 40_000, 3), song(t0 + 60_000, 4)]
    ev = make_events(rows)
    for touching in (True, False):
        op = lambda s, d, t=touching: stream_listening_runs(s, 20_000, watermark_delay_ms=d, merge_touching=t)
        got = sorted(tuple(r) for r in replay(spark, ev, op, 20_000).collect())
        want = sorted(tuple(r) for r in split_runs(ev, 20_000, is_search(), merge_touching=touching).collect())
        assert got == want, touching


def test_replay_restores_shuffle_partitions(spark, make_events):
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        out = replay(spark, make_events([song(5_000, 0), song(6_000, 1)]), lambda s, d: SS.stream_session_stats(s, 20_000, watermark_delay_ms=d), 20_000)
        assert out.count() == 1
        assert spark.conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
