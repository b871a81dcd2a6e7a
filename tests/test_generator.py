"""Synthetic event generator: distributions, determinism, wire output, rate stream."""

import time

from pyspark.sql import functions as F

from cadence.functions import codec
from cadence.sources import generator as G


def test_distributions(spark):
    ev = G.generate_events(spark, 100_000, num_partitions=8)
    n = 100_000
    frac = {r[0]: r[1] / n for r in ev.groupBy("event_type").count().collect()}
    assert abs(frac["EndSong"] - 0.7) < 0.01 and abs(frac["NextSong"] - 0.2) < 0.01 and abs(frac["SearchSong"] - 0.1) < 0.01
    dev = {r[0]: r[1] / n for r in ev.groupBy("device_type").count().collect()}
    assert abs(dev["Desktop"] - 0.4) < 0.01
    songs = ev.filter(F.col("type") == "SongEvent")
    n_songs = songs.count()
    pl = {r[0]: r[1] / n_songs for r in songs.groupBy("playlist_type").count().collect()}
    assert abs(pl["DiscoverWeekly"] - 0.7) < 0.01 and abs(pl["DailyMix"] - 0.2) < 0.01
    assert ev.select("user_id").distinct().count() == G.N_USERS
    assert songs.select("songid").distinct().count() == G.N_SONGS
    assert ev.filter(F.col("type") == "SearchEvent").filter(F.col("songid").isNotNull()).count() == 0


def test_deterministic_and_valid_wire(spark):
    a = G.to_wire(G.generate_events(spark, 1_000, num_partitions=3))
    b = G.to_wire(G.generate_events(spark, 1_000, num_partitions=5))
    assert sorted(a.collect()) == sorted(b.collect())
    decoded = codec.decode(a, on_error="flag")
    assert decoded.filter(F.col("error").isNotNull()).count() == 0


def test_jitter_within_deviation(spark):
    ev = G.generate_events(spark, 2_000, max_time_deviation_ms=300)
    row = ev.select(F.max(F.abs(F.col("ts_ms") - F.lit(G.DEFAULT_BASE_MS) - F.col("event_id") * 500)).alias("m")).first()
    assert 0 < row.m <= 300


def test_rate_stream(spark):
    stream = G.generate_event_stream(spark, rows_per_second=50)
    q = stream.writeStream.format("memory").queryName("gen_stream_test").outputMode("append").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            if spark.sql("SELECT count(*) c FROM gen_stream_test").first().c >= 20:
                break
            time.sleep(1)
    finally:
        q.stop()
    got = spark.sql("SELECT * FROM gen_stream_test")
    assert got.count() >= 20
    assert set(got.columns) == {"event_id", "user_id", "ts_ms", "type", "event_type", "device_type", "playlist_type", "songid"}
