"""Outputs of repeated micro-batches, and the split of a stream into valid and invalid records."""

import os

import pytest
from events import search, song
from pyspark.sql import functions as F

from cadence.__main__ import main
from cadence.functions import codec
from cadence.options import JobOptions
from cadence.plans import job
from cadence.schema import EVENT_SCHEMA
from cadence.session import scratch_path
from cadence.streaming import once, quarantine
from cadence.streaming.sources import read_event_stream, read_wire_stream

RESULTS = ("session_stats", "discover_weekly", "subsessions")


def test_files_are_written_once_and_whole(spark):
    out = scratch_path(spark, "once")
    df = spark.range(5)
    assert once.write_files_once(df, "parquet", out, 3)
    assert not once.write_files_once(spark.range(9), "parquet", out, 3)
    assert spark.read.parquet(f"{out}/batch=*").count() == 5
    assert [f for f in os.listdir(out) if not f.startswith((".", "batch="))] == []


def test_a_failed_write_leaves_nothing_readable(spark):
    out = scratch_path(spark, "once-fail")
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("string").alias("value"))
    with pytest.raises(Exception):
        once.write_files_once(broken, "parquet", out, 0)
    assert once.write_files_once(spark.range(2), "parquet", out, 0) and spark.read.parquet(f"{out}/batch=*").count() == 2


def test_topics_remember_their_last_batch(spark):
    sent, note = [], os.path.join(scratch_path(spark, "noted"), "topic.json")
    for batch in (0, 0, 1, 1, 0, 2):
        once.write_noted_once(spark, lambda b=batch: sent.append(b), note, batch)
    assert sent == [0, 1, 2]


@pytest.mark.parametrize("fails_at", [0, 1, 2])
def test_a_job_killed_between_two_results_repeats_none(spark, monkeypatch, fails_at):
    """The batch that closes user 1's session dies before one of its three writes; the restarted job completes it."""
    root = scratch_path(spark, "kill")
    inp, out = os.path.join(root, "in"), os.path.join(root, "out")
    batches = [[song(1_000, 0, playlist="DiscoverWeekly"), song(2_000, 1, playlist="DiscoverWeekly"), search(3_000, 2)], [search(10_000_000, 10, user="~s")], [search(20_000_000, 11, user="~s")]]
    real, place, died, written = job.write_once, {"n": 0, "hit": False}, [], []

    def write(df, fmt, target, batch_id, records, options=None):
        name = os.path.basename(target)
        if name == RESULTS[0]:
            place.update(n=0, hit=not df.filter("value LIKE 'User: 1 %'").isEmpty())
        if place["hit"] and place["n"] == fails_at and not died:
            died.append(name)
            raise RuntimeError("killed")
        place["n"] += 1
        if real(df, fmt, target, batch_id, records, options) and place["hit"]:
            written.append(name)

    monkeypatch.setattr(job, "write_once", write)

    def run():
        ev = read_event_stream(spark, "parquet", path=inp, options={"maxFilesPerTrigger": "1"})
        for q in job.start_streaming_job(spark, ev, JobOptions(early_panes=False), sink_fmt="parquet", output_root=out, checkpoint_dir=os.path.join(root, "ck"), available_now=True):
            q.awaitTermination()

    for rows in batches:
        codec.encode(spark.createDataFrame(rows, EVENT_SCHEMA)).coalesce(1).write.mode("append").parquet(inp)
        try:
            run()
        except Exception as e:
            assert "killed" in str(e)
            run()
    assert died == [RESULTS[fails_at]] and written == list(RESULTS)
    got = {name: [r.value for r in spark.read.parquet(os.path.join(out, name, "batch=*")).collect() if "~s" not in r.value] for name in RESULTS}
    assert got["discover_weekly"] == ["UserId 1 listened 2 songs for 1 seconds consecutively from Discover\nWeekly"]
    assert got["subsessions"] == ["UserId 1 listened 2 songs consecutively"]
    assert len(got["session_stats"]) == 1


def _wire(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, value binary").select("event_id", F.col("value").cast("string").alias("value"))


GOOD = b'{"type":"SearchEvent","timestamp":%d,"userId":"u","eventType":"NextSong","deviceType":"Mobile"}'


def test_split_keeps_every_record_and_repeats_none(spark):
    root = scratch_path(spark, "split")
    good, bad = os.path.join(root, "good"), os.path.join(root, "bad")
    batch = _wire(spark, [GOOD % 5, b"{bad", (GOOD % 6).replace(b'"u"', b'"u\xff"'), GOOD % 7, b""])
    for _ in range(2):  # the repeated batch adds nothing
        quarantine.split_batch(batch, 0, good, bad)
    # A batch that reached only its first output is completed.
    second = _wire(spark, [GOOD % 8, b"[]"])
    once.write_files_once(spark.createDataFrame([(1, bytearray(b"[]"), "malformed")], "event_id long, value binary, error string"), "parquet", bad, 1)
    quarantine.split_batch(second, 1, good, bad)
    assert sorted(r.ts_ms for r in spark.read.parquet(f"{good}/batch=*").collect()) == [5, 7, 8]
    kept = spark.read.parquet(f"{bad}/batch=*").collect()
    assert sorted(bytes(r.value) for r in kept) == sorted([b"{bad", (GOOD % 6).replace(b'"u"', b'"u\xff"'), b"", b"[]"])
    assert {r.error for r in kept} == {"malformed"}


def test_split_stream_feeds_the_analyses(spark):
    root = scratch_path(spark, "split-stream")
    inp, good, bad = (os.path.join(root, d) for d in ("in", "good", "bad"))
    seen = []
    for i, values in enumerate([[GOOD % 5, b"{bad"], [GOOD % 60_000], [b"null", GOOD % 61_000]]):
        _wire(spark, values).coalesce(1).write.mode("append").parquet(inp)
        quarantine.start_quarantine(read_wire_stream(spark, "parquet", path=inp), good, bad, os.path.join(root, "ck"), available_now=True).awaitTermination()
        q = quarantine.read_valid_events(spark, good).writeStream.foreachBatch(lambda b, _: seen.extend(r.ts_ms for r in b.collect()))
        q.option("checkpointLocation", os.path.join(root, "ck2")).trigger(availableNow=True).start().awaitTermination()
    assert seen == [5, 60_000, 61_000]
    assert spark.read.parquet(f"{bad}/batch=*").count() == 2


def test_command_line_keeps_bad_records_of_a_stream(spark):
    root = scratch_path(spark, "cli-split")
    inp, bad, out = (os.path.join(root, d) for d in ("in", "bad", "out"))
    _wire(spark, [GOOD % 5, b"{bad", GOOD % 100_000, GOOD % 200_000]).coalesce(1).write.parquet(inp)
    args = ["analyze", "--source-format", "parquet", "--source-path", inp, "--sink-format", "parquet", "--output", out, "--on-error", "drop", "--errors-output", bad, "--available-now", "--no-early-panes"]
    assert main([*args, "--checkpoint", os.path.join(root, "ck")]) == 0
    assert [bytes(r.value) for r in spark.read.parquet(f"{bad}/batch=*").collect()] == [b"{bad"]
    assert spark.read.parquet(f"{bad}-valid-events/batch=*").count() == 3
    assert spark.read.parquet(os.path.join(out, "session_stats", "batch=*")).count() >= 1


def test_equal_times_of_a_text_source_have_one_order(spark):
    root = scratch_path(spark, "text-ties")
    lines = [((GOOD % 5).decode().replace('"u"', f'"{u}"'),) for u in "abc"]
    spark.createDataFrame(lines, "value string").repartition(3).write.text(os.path.join(root, "a"))
    spark.createDataFrame(lines[::-1], "value string").coalesce(1).write.text(os.path.join(root, "b"))
    ids = []
    for d in "ab":
        q = read_event_stream(spark, "text", path=os.path.join(root, d)).writeStream.format("memory").queryName(f"ties_{d}").trigger(availableNow=True).start()
        q.awaitTermination()
        ids.append({r.user_id: r.event_id for r in spark.sql(f"SELECT * FROM ties_{d}").collect()})
    assert ids[0] == ids[1] and len(set(ids[0].values())) == 3 and None not in ids[0].values()
