"""Adapter from the driver's ``events`` table to the normalized event rows.

Driver table: ``events(event_id bigint, ts timestamp_ntz, user_id bigint,
event_type string, value double, props string)`` with ``props = {"k": 0..99}``.

Mapping (deterministic, so a SQL oracle can reproduce it):

* ``user_id``       CAST(user_id AS STRING)
* ``ts_ms``         floor(microseconds since epoch / 1000), zone-free
* ``type``          signup, error -> SearchEvent; click, view, purchase -> SongEvent
* ``event_type``    songs -> EndSong; signup -> NextSong; error -> SearchSong
* ``device_type``   event_id % 5 < 2 -> Desktop, else Mobile          (40 / 60)
* ``playlist_type`` songs: k < 70 DiscoverWeekly, k < 90 DailyMix, else ChillHits
* ``songid``        songs: 'song-' || (event_id % 20)
* ``arrival_ms``    ts_ms + ((event_id * 7919) % 7200001) - 3600000  (+-1 h out of order)
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the adapter (documented mapping above).
SEARCH_SOURCE_TYPES = ("signup", "error")
SONG_SOURCE_TYPES = ("click", "view", "purchase")
ARRIVAL_MULTIPLIER = 7919
ARRIVAL_MODULUS = 7200001
ARRIVAL_SHIFT_MS = 3600000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def epoch_ms(ts_ntz: Column) -> Column:
    """Epoch milliseconds (floored) of a TIMESTAMP_NTZ, read as UTC wall-clock.

    Built from date and time-of-day fields, so it never depends on the session
    time zone (a cast to TIMESTAMP would, including its DST jumps)."""
    days = F.unix_date(ts_ntz.cast("date")).cast("bigint")
    sec_us = F.date_part(F.lit("SECOND"), ts_ntz)  # decimal(8,6): seconds with microseconds
    millis_in_minute = F.floor(sec_us * F.lit(1000)).cast("bigint")
    return (
        days * F.lit(86_400_000)
        + F.hour(ts_ntz).cast("bigint") * F.lit(3_600_000)
        + F.minute(ts_ntz).cast("bigint") * F.lit(60_000)
        + millis_in_minute
    )


def arrival_ms(ts_ms: Column, event_id: Column) -> Column:
    """Deterministic arrival time: event time shifted by up to one hour either way."""
    return (
        ts_ms
        + F.pmod(event_id * F.lit(ARRIVAL_MULTIPLIER), F.lit(ARRIVAL_MODULUS))
        - F.lit(ARRIVAL_SHIFT_MS)
    )


def normalize_driver_events(raw: DataFrame, with_arrival: bool = False) -> DataFrame:
    """Map the driver table onto the normalized event columns (pure projection)."""
    et = F.col("event_type")
    song = et.isin(*SONG_SOURCE_TYPES)
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    ts_ms = epoch_ms(F.col("ts"))
    cols = [
        F.col("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        ts_ms.alias("ts_ms"),
        F.when(song, F.lit("SongEvent")).otherwise(F.lit("SearchEvent")).alias("type"),
        F.when(song, F.lit("EndSong"))
        .when(et == F.lit("signup"), F.lit("NextSong"))
        .otherwise(F.lit("SearchSong"))
        .alias("event_type"),
        F.when(F.pmod(F.col("event_id"), F.lit(5)) < F.lit(2), F.lit("Desktop"))
        .otherwise(F.lit("Mobile"))
        .alias("device_type"),
        F.when(song & (k < F.lit(70)), F.lit("DiscoverWeekly"))
        .when(song & (k < F.lit(90)), F.lit("DailyMix"))
        .when(song, F.lit("ChillHits"))
        .alias("playlist_type"),
        F.when(song, F.concat(F.lit("song-"), F.pmod(F.col("event_id"), F.lit(20)).cast("string"))).alias(
            "songid"
        ),
    ]
    if with_arrival:
        cols.append(arrival_ms(ts_ms, F.col("event_id")).alias("arrival_ms"))
    return raw.select(*cols)


def load_events(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    return normalize_driver_events(read_table(spark, sf_dir, "events"), with_arrival=with_arrival)
