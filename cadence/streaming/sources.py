"""Streaming sources of wire events: ``(event_id, value)`` rows.

* ``kafka``: topic ``songs`` by default; ``value`` bytes read as UTF-8 (bytes that are none
  make the record invalid, see ``cadence.functions.codec``), the key is ignored;
  ``event_id`` = partition * 2^48 + offset orders equal timestamps (partitions below 2^15,
  offsets below 2^48).
* ``parquet``: files of ``(event_id bigint, value string)`` (the replay format).
* ``text``: one JSON document per line; ``event_id`` = a hash of the line, so equal
  timestamps have one order however the files are read (equal lines are interchangeable).

Event time is the ``timestamp`` field of each record, never arrival time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions import codec

WIRE_FILE_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.StringType())])


def _wire(raw: DataFrame, fmt: str) -> DataFrame:
    """``(event_id, value)`` of what a source delivers."""
    if fmt == "kafka":
        return raw.select(
            (F.col("partition").cast("bigint") * F.lit(1 << 48) + F.col("offset")).alias("event_id"),
            F.col("value").cast("string").alias("value"),
        )
    if fmt == "text":
        return raw.select(F.xxhash64("value").alias("event_id"), F.col("value"))
    return raw


def _load(reader, fmt: str, path: str | None, topic: str) -> DataFrame:
    if fmt == "kafka":
        return _wire(reader.format("kafka").option("subscribe", topic).load(), fmt)
    if fmt == "parquet":
        return _wire(reader.schema(WIRE_FILE_SCHEMA).parquet(path), fmt)
    if fmt == "text":
        return _wire(reader.text(path), fmt)
    raise ValueError("fmt must be 'kafka', 'parquet' or 'text'")


def read_wire_stream(
    spark: SparkSession, fmt: str, *, path: str | None = None, topic: str = "songs", options: dict[str, str] | None = None
) -> DataFrame:
    return _load(spark.readStream.options(**(options or {})), fmt, path, topic)


def read_wire_batch(
    spark: SparkSession, fmt: str, *, path: str | None = None, topic: str = "songs", options: dict[str, str] | None = None
) -> DataFrame:
    """What is stored now (for Kafka: from the earliest to the latest offset)."""
    return _load(spark.read.options(**(options or {})), fmt, path, topic)


def read_event_stream(spark: SparkSession, fmt: str, *, on_error: str = "fail", **kw) -> DataFrame:
    """Decoded, validated event stream (normalized columns).

    ``on_error``: ``fail`` stops the query at an invalid record; ``drop`` leaves invalid
    records out.  To keep them with their reasons, split the wire stream with
    ``cadence.streaming.quarantine`` and read its valid events."""
    wire = read_wire_stream(spark, fmt, **kw)
    if on_error == "drop":
        return codec.decode(wire, on_error="quarantine")[0]
    return codec.decode(wire, on_error=on_error)
