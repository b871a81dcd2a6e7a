"""Invalid records of a stream kept apart: one decoding pass, two outputs under one batch id.

The reference stops at the first bad record, and leaving bad records out of a stream loses
them.  ``start_quarantine`` decodes every record once and writes valid events to one folder
and invalid records, with their raw text and reason, to another.  Both are written once per
batch id (``cadence.streaming.once``), so a repeated batch adds nothing to either.  The
analyses read the folder of valid events as their source (``read_valid_events``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.functions import codec
from cadence.schema import EVENT_SCHEMA
from cadence.session import make_folder
from cadence.streaming.once import write_files_once


def split_batch(batch: DataFrame, batch_id: int, good: str, bad: str, fmt: str = "parquet") -> None:
    """Decode one batch of ``(event_id, value)`` and write both of its outputs."""
    flagged = codec.decode(batch, on_error="flag", keep=("value",)).persist()
    try:
        invalid = flagged.filter(F.col("error").isNotNull()).select("event_id", F.col("value").cast("binary").alias("value"), "error")
        write_files_once(invalid, "parquet", bad, batch_id)
        # The events come last: once readers can see a batch, its invalid records are kept.
        write_files_once(flagged.filter(F.col("error").isNull()).select(*EVENT_SCHEMA.names), fmt, good, batch_id)
    finally:
        flagged.unpersist()


def start_quarantine(
    wire: DataFrame, good: str, bad: str, checkpoint: str, *, available_now: bool = False
) -> StreamingQuery:
    """Split a wire stream into ``good`` (events) and ``bad`` (event_id, value as bytes, error)."""
    w = wire.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: split_batch(b, i, good, bad))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_valid_events(spark: SparkSession, good: str, options: dict[str, str] | None = None) -> DataFrame:
    """The events that ``start_quarantine`` writes (or will write), as a stream."""
    make_folder(spark, os.path.join(good, "batch=start"))  # a source folder must exist before its first file
    return spark.readStream.schema(EVENT_SCHEMA).options(**(options or {})).parquet(os.path.join(good, "batch=*"))
