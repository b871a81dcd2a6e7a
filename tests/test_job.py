"""Job layer: batch analyze() with toggles, messages, and the streaming job."""

import itertools
import os
import subprocess
import sys

import pytest
from events import search, song
from pyspark.sql import functions as F

from cadence.functions import codec
from cadence.options import JobOptions
from cadence.plans import job
from cadence.plans.queries import DRIVER_GAP_MS, q_discover_weekly_runs, q_listening_runs, q_session_stats_window
from cadence.schema import EVENT_SCHEMA
from cadence.session import scratch_path
from cadence.sources.driver_table import load_events
from cadence.streaming.sources import read_event_stream

SF = "/root/testdata/sf0.001"
SF_REPO = os.path.dirname(os.path.abspath(__file__))
OPTS = JobOptions(session_gap_s=DRIVER_GAP_MS // 1000, trigger_interval_s=10_800)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_analyze_equals_single_queries(spark):
    out = job.analyze(load_events(spark, SF), OPTS)
    assert set(out) == {"session_stats", "session_panes", "discover_weekly", "subsessions"}
    assert rows(out["session_stats"]) == rows(q_session_stats_window(spark, SF))
    assert rows(out["discover_weekly"]) == rows(q_discover_weekly_runs(spark, SF))
    assert rows(out["subsessions"]) == rows(q_listening_runs(spark, SF))


def test_analyze_materialized_and_toggles(spark):
    opts = JobOptions(session_gap_s=43_200, discover_weekly=False, early_panes=False)
    out = job.analyze(load_events(spark, SF), opts, materialize=True)
    assert set(out) == {"session_stats", "subsessions"}
    assert rows(out["session_stats"]) == rows(q_session_stats_window(spark, SF))


def test_messages_both_dialects(spark, make_events):
    ev = make_events([song(1_000, 0, playlist="DiscoverWeekly"), song(2_000, 1, playlist="DiscoverWeekly"), search(3_500, 2)])
    res = job.analyze(ev, JobOptions(early_panes=False))
    res_span = job.analyze(ev, JobOptions(dialect="span"))
    win = {k: [r.value for r in v.collect()] for k, v in job.messages(res).items()}
    span = {k: [r.value for r in v.collect()] for k, v in job.messages(res_span, JobOptions(dialect="span")).items()}
    assert win["session_stats"] == [
        "User: 1 session took 22 seconds and 2 songs\n            starting at 1970-01-01T00:00:01Z and ending at "
        "1970-01-01T00:00:23.500Z."
    ]
    assert win["discover_weekly"] == ["UserId 1 listened 2 songs for 1 seconds consecutively from Discover\nWeekly"]
    assert win["subsessions"] == ["UserId 1 listened 2 songs consecutively"]
    assert span["session_stats"] == ["User 1 session took 2 seconds and 2 songs."]
    assert span["discover_weekly"] == ["UserId 1 listened 2 songs for 1 seconds consecutively from Discover Weekly"]
    assert span["subsessions"] == ["UserId 1 listened 2 songs for 1 seconds consecutively"]


def test_streaming_job_files(spark):
    root = scratch_path(spark, "job")
    inp = os.path.join(root, "in")
    data = [song(1_000, 0), song(2_000, 1), search(3_000, 2), song(4_000, 3), song(500_000, 4, user="2")]
    sentinels = [[search(10_000_000, 10, user="~s")], [search(20_000_000, 11, user="~s")]]
    codec.encode(spark.createDataFrame(data, EVENT_SCHEMA)).coalesce(1).write.parquet(inp)
    opts = JobOptions(trigger_interval_s=5)

    def run():
        ev = read_event_stream(spark, "parquet", path=inp, options={"maxFilesPerTrigger": "1"})
        for q in job.start_streaming_job(
            spark, ev, opts, sink_fmt="parquet", output_root=os.path.join(root, "out"),
            checkpoint_dir=os.path.join(root, "ck"), available_now=True,
        ):
            q.awaitTermination()

    run()
    for s in sentinels:
        codec.encode(spark.createDataFrame(s, EVENT_SCHEMA)).coalesce(1).write.mode("append").parquet(inp)
        run()
    out = os.path.join(root, "out")
    sub = [r.value for r in spark.read.parquet(os.path.join(out, "subsessions")).collect()]
    assert sorted(sub) == sorted(["UserId 1 listened 2 songs consecutively", "UserId 1 listened 1 songs consecutively",
                                  "UserId 2 listened 1 songs consecutively"])
    panes = [r.value for r in spark.read.parquet(os.path.join(out, "session_panes")).collect()]
    user1 = [p for p in panes if p.startswith("User: 1 ")]
    # Fire times 5 s .. 20 s and the final pane at 23.999 s all report the session [1 s, 24 s).
    assert len(user1) == 5 and all("3 songs" in p and "ending at 1970-01-01T00:00:24Z." in p for p in user1)
    dw = spark.read.parquet(os.path.join(out, "discover_weekly")).filter(F.col("value").contains("~s"))
    assert dw.count() == 0


def test_generator_jobs(spark):
    root = scratch_path(spark, "gen")
    job.write_generated(spark, 500, "parquet", path=os.path.join(root, "batch"))
    wire = spark.read.parquet(os.path.join(root, "batch"))
    assert wire.count() == 500 and codec.decode(wire, on_error="flag").filter("error IS NOT NULL").count() == 0
    q = job.start_generator(spark, 20, "parquet", path=os.path.join(root, "stream"), checkpoint=os.path.join(root, "ck"))
    try:
        q.processAllAvailable()
        import time

        time.sleep(3)
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(os.path.join(root, "stream")).count() > 0


def test_text_source_stream(spark):
    root = scratch_path(spark, "text")
    inp = os.path.join(root, "in")
    data = [song(1_000, 0), search(2_000, 1), song(3_000, 2)]
    codec.encode(spark.createDataFrame(data, EVENT_SCHEMA)).select("value").coalesce(1).write.text(inp)
    ev = read_event_stream(spark, "text", path=inp)
    q = ev.writeStream.format("memory").queryName("text_src_test").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.ts_ms, r.type) for r in spark.sql("SELECT * FROM text_src_test").collect())
    assert got == [(1_000, "SongEvent"), (2_000, "SearchEvent"), (3_000, "SongEvent")]


def test_write_batch_results_rows(spark):
    root = scratch_path(spark, "batch-rows")
    written = job.write_batch_results(
        load_events(spark, SF), JobOptions(session_gap_s=43_200, early_panes=False), root, as_messages=False
    )
    assert set(written) == {"session_stats", "discover_weekly", "subsessions"}
    got = sorted(tuple(r) for r in spark.read.parquet(written["session_stats"]).select(
        "user_id", "start_ms", "end_ms", "duration_s", "songs").collect())
    assert got == rows(q_session_stats_window(spark, SF))


@pytest.mark.parametrize("dialect", ["window", "span"])
@pytest.mark.parametrize("toggles", list(itertools.product([True, False], repeat=4)))
def test_every_combination_of_toggles_and_dialect(make_events, dialect, toggles):
    stats, dw, sub, panes = toggles
    opts = JobOptions(session_stats=stats, discover_weekly=dw, subsession_stats=sub, early_panes=panes, dialect=dialect)
    out = job.messages(job.analyze(make_events([song(1_000, 0, playlist="DiscoverWeekly"), search(3_500, 2)]), opts), opts)
    want = {n for n, on in (("session_stats", stats), ("discover_weekly", dw), ("subsessions", sub)) if on}
    want |= {"session_panes"} if stats and panes and dialect == "window" else set()
    assert set(out) == want and all(df.columns == ["value"] for df in out.values())


def test_unknown_dialect_is_refused():
    with pytest.raises(ValueError):
        JobOptions(dialect="other")


@pytest.mark.parametrize("n", [30, 1000])
def test_console_prints_every_row_whole(tmp_path, n):
    """Batch and stream console output, read from the process that prints it."""
    script = tmp_path / "console.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {os.path.dirname(SF_REPO)!r})\n"
        "from cadence.session import build_spark\n"
        "from cadence.streaming.sinks import print_rows, start_sink\n"
        "from pyspark.sql import functions as F\n"
        "spark = build_spark('local[2]', shuffle_partitions=2)\n"
        f"df = spark.range({n}).select(F.concat(F.lit('row-'), 'id', F.lit('-' + 'x' * 60)).alias('value'))\n"
        "print_rows(df.select(F.concat(F.lit('batch-'), 'value').alias('value')))\n"
        f"df.write.text({str(tmp_path / 'in')!r})\n"
        f"stream = spark.readStream.text({str(tmp_path / 'in')!r}).select(F.concat(F.lit('stream-'), 'value'))\n"
        f"start_sink(stream, 'console', {str(tmp_path / 'ck')!r}, available_now=True).awaitTermination()\n"
    )
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    printed = (done.stdout + done.stderr).splitlines()
    for kind in ("batch", "stream"):
        lines = [x for x in printed if x.startswith(f"{kind}-row-")]
        assert sorted(lines) == sorted(f"{kind}-row-{i}-" + "x" * 60 for i in range(n))


def test_quarantine_in_the_stream_source(spark):
    root = scratch_path(spark, "bad-text")
    spark.createDataFrame([('{"type":"SearchEvent","timestamp":5,"userId":"u","eventType":"NextSong","deviceType":"Mobile"}',), ("{bad",)], "value string").coalesce(1).write.text(os.path.join(root, "in"))
    ev = read_event_stream(spark, "text", path=os.path.join(root, "in"), on_error="drop")
    ev.writeStream.format("memory").queryName("bad_text_test").trigger(availableNow=True).start().awaitTermination()
    assert [r.ts_ms for r in spark.sql("SELECT * FROM bad_text_test").collect()] == [5]


def test_watermark_note_is_required_after_the_first_batch(spark):
    from cadence.session import read_note, write_note

    path = os.path.join(scratch_path(spark, "notes"), "a", "note.json")
    assert read_note(spark, path) is None
    write_note(spark, path, "é1")
    write_note(spark, path, "é2")
    assert read_note(spark, path) == "é2"
