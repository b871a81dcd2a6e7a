"""Batch outputs of ``foreachBatch`` that a repeated micro-batch does not repeat.

After a failure Spark runs the last micro-batch again, with the same rows and the same
batch id.  A batch that writes to several places may have reached some of them.  Each
place therefore keeps its own record of what it already has:

* files: the batch is written beside its place and renamed to ``batch=<id>`` when it is
  whole; a folder of that name is the record, so readers see all of a batch or nothing
  (a rename is one step on HDFS and local disks);
* Kafka topics and the console: the last batch id written, in a small note under the
  query's checkpoint.  Only a failure between the write and its note can repeat rows
  there, and then only those of one place.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from cadence.session import move_folder, read_note, write_note
from cadence.streaming.sinks import print_rows

FILES = ("parquet", "text", "json", "csv", "orc")


def batch_folder(target: str, batch_id: int) -> str:
    return os.path.join(target, f"batch={batch_id}")


def write_files_once(df: DataFrame, fmt: str, target: str, batch_id: int, options: dict[str, str] | None = None) -> bool:
    """Write ``df`` to ``target/batch=<id>`` unless it is there; whether it was written now."""
    spark = df.sparkSession
    aside = os.path.join(target, f"_writing-{batch_id}-{uuid.uuid4().hex[:8]}")
    if move_folder(spark, None, batch_folder(target, batch_id)):
        return False
    df.write.format(fmt).options(**(options or {})).save(aside)
    move_folder(spark, aside, batch_folder(target, batch_id))
    return True


def write_noted_once(spark, write: Callable[[], None], note: str, batch_id: int) -> bool:
    """Run ``write`` unless the note says that this batch or a later one was written."""
    text = read_note(spark, note)
    if text is not None and json.loads(text)["batch"] >= batch_id:
        return False
    write()
    write_note(spark, note, json.dumps({"batch": batch_id}))
    return True


def write_once(
    df: DataFrame, fmt: str, target: str, batch_id: int, records: str, options: dict[str, str] | None = None
) -> bool:
    """Write one result of a micro-batch to its place (folder or topic), once."""
    if fmt in FILES:
        return write_files_once(df, fmt, target, batch_id, options)
    note = os.path.join(records, f"{fmt}-{target.replace('/', '_') or 'all'}.json")
    if fmt == "kafka":
        send = lambda: df.write.format("kafka").options(**(options or {})).option("topic", target).save()
    elif fmt == "console":
        send = lambda: print_rows(df)
    else:
        send = lambda: df.write.format(fmt).options(**(options or {})).mode("append").save(target)
    return write_noted_once(df.sparkSession, send, note, batch_id)
