"""Event data model.

Both event classes (song and search) live in ONE wide, nullable row type with a
``type`` discriminator.  Nothing is ever inferred: the wire schema below is the
only schema JSON is parsed with.

Internal (normalized) columns, used by every operator in this package:

    event_id       BIGINT   tiebreak for equal timestamps (Kafka offset, row id, ...)
    user_id        STRING
    ts_ms          BIGINT   event time, epoch milliseconds
    type           STRING   'SongEvent' | 'SearchEvent'
    event_type     STRING   'EndSong' | 'NextSong' | 'SearchSong'
    device_type    STRING   'Mobile' | 'Desktop'
    playlist_type  STRING   songs only: 'DiscoverWeekly' | 'DailyMix' | 'ChillHits'
    songid         STRING   songs only
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the reference's for results to match. ---
SONG_EVENT = "SongEvent"
SEARCH_EVENT = "SearchEvent"
EVENT_CLASSES = ("SongEvent", "SearchEvent")
EVENT_TYPES = ("EndSong", "NextSong", "SearchSong")
DEVICE_TYPES = ("Mobile", "Desktop")
PLAYLIST_TYPES = ("DiscoverWeekly", "DailyMix", "ChillHits")
DISCOVER_WEEKLY = "DiscoverWeekly"
# Wire field names (JSON keys on the topic), in case-class order.
WIRE_FIELDS = ("timestamp", "userId", "eventType", "deviceType", "playlistType", "songid")
# --- end of fixed values ---

CORRUPT_COLUMN = "_corrupt_record"

# JSON on the wire: the case-class fields plus "type" = class name.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("timestamp", T.DecimalType(38, 18)),  # any JSON number; whole milliseconds are taken
        T.StructField("userId", T.StringType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("deviceType", T.StringType()),
        T.StructField("playlistType", T.StringType()),
        T.StructField("songid", T.StringType()),
    ]
)

# Same, plus the column from_json fills with the raw text of a malformed record.
WIRE_SCHEMA_WITH_CORRUPT = T.StructType(
    WIRE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

EVENT_COLUMNS = (
    "event_id",
    "user_id",
    "ts_ms",
    "type",
    "event_type",
    "device_type",
    "playlist_type",
    "songid",
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("playlist_type", T.StringType()),
        T.StructField("songid", T.StringType()),
    ]
)

# Internal name -> wire name.
WIRE_NAMES = {
    "ts_ms": "timestamp",
    "user_id": "userId",
    "event_type": "eventType",
    "device_type": "deviceType",
    "playlist_type": "playlistType",
    "songid": "songid",
}
