"""Streaming sinks: one query per result, each with its own checkpoint.

* ``kafka``: a ``value`` column to a topic (result messages, or generated events);
* ``console``: every row, whole, printed where it is computed (the executors' output);
* ``parquet`` / ``text``: files, for replay and tests;
* ``memory``: in-process table (tests only).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery


def _print_partition(rows: Iterator[Row]) -> None:
    for row in rows:
        sys.stdout.write("\t".join("" if v is None else str(v) for v in row) + "\n")
    sys.stdout.flush()


def print_rows(df: DataFrame) -> None:
    """Print every row of ``df`` in full, one line each (more if a value holds line ends),
    from the tasks that compute them; nothing passes through the driver."""
    df.foreachPartition(_print_partition)


def start_sink(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    *,
    path: str | None = None,
    topic: str | None = None,
    options: dict[str, str] | None = None,
    output_mode: str = "append",
    available_now: bool = False,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.foreachBatch(lambda batch, _: print_rows(batch)) if fmt == "console" else w.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w = w.option("topic", topic)
    if path and fmt in ("parquet", "text", "json", "csv", "orc"):
        w = w.option("path", path)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
