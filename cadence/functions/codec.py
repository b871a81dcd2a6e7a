"""JSON wire format of events: decode, encode, validity and the bad-record policy.

On the wire an event is a JSON object of its fields plus ``"type"`` = class name.
Decoding uses one explicit schema (never inferred).  A record is valid iff its bytes are
UTF-8, it is a JSON object, ``type`` is a known class, ``timestamp`` is a JSON number (a fraction of
a millisecond is cut off; it must fit 64 bits), ``userId`` is a JSON string,
``eventType`` and ``deviceType`` are present with enum values in their domains,
and, for a song, ``playlistType`` is in its domain and ``songid`` is a JSON string.
Extra fields are ignored; a search event never carries song fields.  JSON types are
read from the record as a VARIANT, because a typed reader turns numbers and objects
into text and digits in quotes into numbers.

Bad-record policy (``on_error``):
* ``"fail"``        (default, as the reference): the query fails on the first bad record;
* ``"quarantine"``: returns ``(good, bad)``; ``bad`` keeps the raw text and a reason;
* ``"flag"``:       one DataFrame with an ``error`` column (NULL when valid).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.schema import (
    CORRUPT_COLUMN,
    DEVICE_TYPES,
    EVENT_CLASSES,
    EVENT_COLUMNS,
    EVENT_TYPES,
    PLAYLIST_TYPES,
    SEARCH_EVENT,
    SONG_EVENT,
    WIRE_SCHEMA_WITH_CORRUPT,
)

# Reason codes of invalid records.
MALFORMED = "malformed"  # not UTF-8, not JSON, not an object, or a field of the wrong JSON type
UNKNOWN_TYPE = "unknown_type"  # "type" missing or not a known class
MISSING_FIELD = "missing_field"  # a required field is absent
BAD_ENUM = "bad_enum"  # an enum field outside its domain

_PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def wire_struct(prefix: str = "") -> Column:
    """Struct of the wire fields, in wire naming, from normalized columns."""
    c = lambda name: F.col(f"{prefix}{name}")
    return F.struct(
        c("type").alias("type"),
        c("ts_ms").alias("timestamp"),
        c("user_id").alias("userId"),
        c("event_type").alias("eventType"),
        c("device_type").alias("deviceType"),
        c("playlist_type").alias("playlistType"),
        c("songid").alias("songid"),
    )


def encode(df: DataFrame, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Normalized events -> ``value`` JSON strings.  NULL fields are omitted, so a
    search event prints exactly its four fields plus its type."""
    return df.select(*[F.col(k) for k in keep if k in df.columns], F.to_json(wire_struct()).alias("value"))


def parse(value: Column) -> Column:
    return F.from_json(value, WIRE_SCHEMA_WITH_CORRUPT, _PARSE_OPTIONS)


def json_types(value: Column) -> Column:
    """JSON types of the fields whose type a typed reader would not check (NULL: absent)."""
    record = F.try_parse_json(value)
    return F.struct(
        *[F.schema_of_variant(F.try_variant_get(record, f"$.{name}", "variant")).alias(name) for name in ("timestamp", "userId", "songid")]
    )


def _wrong_type(p: str, k: str) -> Column:
    kind = lambda name: F.coalesce(F.col(f"{k}.{name}"), F.lit("VOID"))
    number = kind("timestamp").rlike("^(VOID|BIGINT|DECIMAL|DOUBLE)")
    text = {name: kind(name).isin("VOID", "STRING") for name in ("userId", "songid")}
    song = F.coalesce(F.col(f"{p}.type") == F.lit(SONG_EVENT), F.lit(False))
    return ~number | ~text["userId"] | (song & ~text["songid"])


def error_reason(p: str = "_p", k: str = "_k", raw: str = "_raw") -> Column:
    """NULL for a valid parsed record, else one of the reason codes."""
    f = lambda name: F.col(f"{p}.{name}")
    unplaced = f("timestamp").isNotNull() & f("timestamp").try_cast("bigint").isNull()
    song = f("type") == F.lit(SONG_EVENT)
    missing = (
        f("timestamp").isNull()
        | f("userId").isNull()
        | f("eventType").isNull()
        | f("deviceType").isNull()
        | (song & (f("playlistType").isNull() | f("songid").isNull()))
    )
    bad_enum = (
        ~f("eventType").isin(*EVENT_TYPES)
        | ~f("deviceType").isin(*DEVICE_TYPES)
        | (song & ~f("playlistType").isin(*PLAYLIST_TYPES))
    )
    return (
        F.when(~F.is_valid_utf8(raw) | F.col(p).isNull() | f(CORRUPT_COLUMN).isNotNull() | unplaced | _wrong_type(p, k), F.lit(MALFORMED))
        .when(f("type").isNull() | ~f("type").isin(*EVENT_CLASSES), F.lit(UNKNOWN_TYPE))
        .when(missing, F.lit(MISSING_FIELD))
        .when(bad_enum, F.lit(BAD_ENUM))
    )


def _normalized(p: str, tiebreak: Column) -> list[Column]:
    f = lambda name: F.col(f"{p}.{name}")
    search = f("type") == F.lit(SEARCH_EVENT)
    return [
        tiebreak.cast("bigint").alias("event_id"),
        f("userId").alias("user_id"),
        f("timestamp").try_cast("bigint").alias("ts_ms"),
        f("type").alias("type"),
        f("eventType").alias("event_type"),
        f("deviceType").alias("device_type"),
        F.when(~search, f("playlistType")).alias("playlist_type"),
        F.when(~search, f("songid")).alias("songid"),
    ]


def decode(
    df: DataFrame,
    value_col: str = "value",
    tiebreak_col: str | None = "event_id",
    on_error: str = "fail",
    keep: tuple[str, ...] = (),
):
    """``value`` JSON strings -> normalized events (see module doc for ``on_error``).

    ``tiebreak_col`` orders events with equal timestamps (a row id, or Kafka
    partition/offset); when absent, ``monotonically_increasing_id`` is used, which
    is stable for file sources."""
    tiebreak = F.col(tiebreak_col) if tiebreak_col and tiebreak_col in df.columns else F.monotonically_increasing_id()
    parsed = df.select(
        *[F.col(k) for k in keep], tiebreak.alias("_tb"), F.col(value_col).alias("_raw"), parse(F.col(value_col)).alias("_p"),
        json_types(F.col(value_col)).alias("_k"),
    ).withColumn("_err", error_reason("_p", "_k"))
    rows = [*[F.col(k) for k in keep], *_normalized("_p", F.col("_tb"))]
    if on_error == "fail":
        check = F.when(F.col("_err").isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("invalid event ("), F.col("_err"), F.lit("): "), F.col("_raw")))
        )
        return parsed.filter(check).select(*rows)
    if on_error == "flag":
        return parsed.select(*rows, F.col("_err").alias("error"))
    if on_error == "quarantine":
        good = parsed.filter(F.col("_err").isNull()).select(*rows)
        bad = parsed.filter(F.col("_err").isNotNull()).select(
            *[F.col(k) for k in keep], F.col("_tb").alias("event_id"), F.col("_raw").alias("value"), F.col("_err").alias("error")
        )
        return good, bad
    raise ValueError("on_error must be 'fail', 'quarantine' or 'flag'")


__all__ = ["encode", "decode", "parse", "json_types", "error_reason", "wire_struct", "EVENT_COLUMNS"]
