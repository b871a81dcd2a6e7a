"""A streaming view of late events: what a watermark-driven session job drops.

Spark drops late rows before any operator sees them, so this view runs as its own
query.  It is exact per event, however the stream is cut into micro-batches: an event is
compared with the watermark just before its own arrival, which is the greater of

* the watermark that earlier batches left, one number carried from batch to batch, and
* the running maximum inside its batch (``cadence.operators.watermark``: two levels, so a
  batch is never ordered in one task).

* ``punctuated``: the watermark is the latest time of a marker event (second-of-minute below 2);
* ``max``:        the latest event time minus ``delay_ms``.

An event is late when its own session window has already ended by then:
``ts + gap - 1 <= watermark``, the rule of the batch ``late_events``.  The number carried is
kept in a small record per batch id under the checkpoint folder, so a restarted or
replayed batch sees exactly the watermark it saw first.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.operators.watermark import marker, running_watermark
from cadence.session import read_note, write_note


def _record(folder: str, batch_id: int) -> str:
    return os.path.join(folder, f"batch-{batch_id}.json")


def start_late_event_view(
    events: DataFrame,
    gap_ms: int,
    checkpoint: str,
    output: str,
    *,
    mode: str = "punctuated",
    delay_ms: int = 0,
    fmt: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Write every late event, with the watermark it missed, to ``output``.

    Events of one batch arrive in the order of ``arrival_ms`` if they have such a column, and
    of ``event_id`` (the source's own order)."""
    if mode not in ("punctuated", "max"):
        raise ValueError("mode must be 'punctuated' or 'max'")
    wm_folder = os.path.join(checkpoint, "late-watermarks")
    spark = events.sparkSession
    arrival = "arrival_ms" if "arrival_ms" in events.columns else "event_id"
    delay = delay_ms if mode == "max" else 0

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        note = read_note(spark, _record(wm_folder, batch_id - 1)) if batch_id > 0 else None
        if batch_id > 0 and note is None:
            raise RuntimeError(f"the watermark record of batch {batch_id - 1} is missing under {wm_folder}")
        before = json.loads(note)["watermark_ms"] if note else None
        batch = batch.persist()  # read several times: its extent, its order, the new watermark
        try:
            marked = running_watermark(batch, mode, inclusive=False, arrival_col=arrival, delay_ms=delay)
            carried = F.lit(before).cast("bigint")
            late = marked.withColumn("watermark_ms", F.when(F.col(arrival).isNotNull(), F.greatest("watermark_ms", carried)))
            late = late.filter(F.col("ts_ms") + F.lit(gap_ms - 1) <= F.col("watermark_ms"))
            late.write.mode("overwrite").format(fmt).save(os.path.join(output, f"batch={batch_id}"))
            marks = F.col(arrival).isNotNull() & marker(mode)
            top = batch.agg(F.max(F.when(marks, F.col("ts_ms") - F.lit(delay))).alias("m")).first()["m"]
        finally:
            batch.unpersist()
        after = before if top is None else (int(top) if before is None else max(before, int(top)))
        # Every batch leaves its record (even when unchanged), so the next reads one.
        write_note(spark, _record(wm_folder, batch_id), json.dumps({"watermark_ms": after}))

    w = events.writeStream.option("checkpointLocation", os.path.join(checkpoint, "query")).foreachBatch(per_batch)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
