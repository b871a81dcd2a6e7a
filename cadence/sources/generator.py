"""Distributed generator of synthetic play/search events.

Every seed row (any ``bigint`` id column: ``spark.range``, a table's row ids, the
``value`` of a ``rate`` stream) becomes one event.  The random draws are uniform
numbers taken from the md5 of the seed, so the output is deterministic, needs no
driver-side state, partitions like its input and can be reproduced in SQL.

Distributions (fixed values of the reference's generator):

* event:    EndSong 70 % (a song), NextSong 20 %, SearchSong 10 % (both searches)
* device:   Desktop 40 %, Mobile 60 %
* playlist: DiscoverWeekly 70 %, DailyMix 20 %, ChillHits 10 % (songs only)
* users:    30, songs: 20, each chosen uniformly; ids are UUID-shaped strings
* time:     base + seed * mean pacing (max_interval / 2) + uniform[-dev, +dev)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.codec import wire_struct
from cadence.functions.predicates import floor_div

# --- Fixed values of the generator (as the reference draws them). ---
N_USERS = 30
N_SONGS = 20
P_END_SONG_ABOVE = 0.3  # draw > 0.3 -> EndSong
P_NEXT_SONG_ABOVE = 0.1  # 0.1 < draw <= 0.3 -> NextSong, else SearchSong
P_DESKTOP_ABOVE = 0.6  # draw > 0.6 -> Desktop, else Mobile
P_DISCOVER_WEEKLY_ABOVE = 0.3  # draw > 0.3 -> DiscoverWeekly
P_DAILY_MIX_ABOVE = 0.1  # 0.1 < draw <= 0.3 -> DailyMix, else ChillHits
# --- end of fixed values ---

DEFAULT_BASE_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
_TWO_32 = float(2**32)


def _draw(seed: Column, slot: int) -> Column:
    """Uniform [0, 1) from 32 bits of md5(seed || '#' || slot//4), slice slot%4."""
    digest = F.md5(F.concat(seed.cast("string"), F.lit(f"#{slot // 4}")))
    bits = F.conv(F.substring(digest, 1 + 8 * (slot % 4), 8), 16, 10).cast("bigint")
    return bits / F.lit(_TWO_32)


def _uuid_shaped(kind: str, idx: Column) -> Column:
    """Deterministic UUID-shaped id: md5('kind-idx') cut 8-4-4-4-12."""
    h = F.md5(F.concat(F.lit(f"{kind}-"), idx.cast("string")))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)
    )


def event_columns(
    seed: Column,
    base_ms: Column,
    *,
    max_interval_ms: int = 1000,
    max_time_deviation_ms: int = 0,
    pace: bool = True,
) -> list[Column]:
    """Normalized event columns for one seed (``pace=False``: time = base + jitter)."""
    c, d, u, p, s, j = (_draw(seed, k) for k in range(6))
    song = c > F.lit(P_END_SONG_ABOVE)
    ts = base_ms.cast("bigint")
    if pace:
        ts = ts + floor_div(seed.cast("bigint") * F.lit(max_interval_ms), 2)
    if max_time_deviation_ms:
        # uniform[-dev, +dev), truncated toward zero like a long conversion
        ts = ts + (j * F.lit(2 * max_time_deviation_ms) - F.lit(max_time_deviation_ms)).cast("bigint")
    return [
        seed.cast("bigint").alias("event_id"),
        _uuid_shaped("user", F.floor(u * F.lit(N_USERS))).alias("user_id"),
        ts.alias("ts_ms"),
        F.when(song, F.lit("SongEvent")).otherwise(F.lit("SearchEvent")).alias("type"),
        F.when(song, F.lit("EndSong"))
        .when(c > F.lit(P_NEXT_SONG_ABOVE), F.lit("NextSong"))
        .otherwise(F.lit("SearchSong"))
        .alias("event_type"),
        F.when(d > F.lit(P_DESKTOP_ABOVE), F.lit("Desktop")).otherwise(F.lit("Mobile")).alias("device_type"),
        F.when(song & (p > F.lit(P_DISCOVER_WEEKLY_ABOVE)), F.lit("DiscoverWeekly"))
        .when(song & (p > F.lit(P_DAILY_MIX_ABOVE)), F.lit("DailyMix"))
        .when(song, F.lit("ChillHits"))
        .alias("playlist_type"),
        F.when(song, _uuid_shaped("song", F.floor(s * F.lit(N_SONGS)))).alias("songid"),
    ]


def generate_from_seeds(
    seeds: DataFrame,
    seed_col: str = "id",
    *,
    base_ms: int = DEFAULT_BASE_MS,
    max_interval_ms: int = 1000,
    max_time_deviation_ms: int = 0,
) -> DataFrame:
    """One synthetic event per seed row (normalized columns)."""
    return seeds.select(
        *event_columns(
            F.col(seed_col),
            F.lit(base_ms),
            max_interval_ms=max_interval_ms,
            max_time_deviation_ms=max_time_deviation_ms,
        )
    )


def generate_events(spark: SparkSession, n: int, *, num_partitions: int | None = None, **kw) -> DataFrame:
    """``n`` synthetic events over ``spark.range`` (no data passes through the driver)."""
    return generate_from_seeds(spark.range(0, n, 1, num_partitions), "id", **kw)


def generate_event_stream(
    spark: SparkSession, rows_per_second: int, *, max_time_deviation_ms: int = 0, num_partitions: int | None = None
) -> DataFrame:
    """Unbounded stream: the ``rate`` source supplies seed and wall-clock time."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if num_partitions:
        reader = reader.option("numPartitions", num_partitions)
    rate = reader.load()
    return rate.select(
        *event_columns(
            F.col("value"),
            F.unix_millis(F.col("timestamp")),
            max_time_deviation_ms=max_time_deviation_ms,
            pace=False,
        )
    )


def to_wire(events: DataFrame) -> DataFrame:
    """Generator output as the topic carries it: ``(event_id, value JSON)``."""
    return events.select("event_id", F.to_json(wire_struct()).alias("value"))
