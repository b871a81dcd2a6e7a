"""Intermediate tables in the shared folder, hashing keys and bounded label samples used by several operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import scratch_path, ship_package


def begin(df: DataFrame) -> SparkSession:
    """The session, with this package shipped to the Python workers.

    Arrow batches of the session are kept to 16 MB (Spark's default is 64): a task holds a batch in the JVM and in
    Python, and results are computed after the operator has returned, so the setting stays."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the folder in spark.checkpoint.dir and read back: work is done once, lineage is cut, and a
    lost executor costs only the tasks that were running."""
    spark = df.sparkSession
    path = scratch_path(spark, label) + "/t"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def small(table: DataFrame, limit: int = 100_000) -> DataFrame:
    """A stored table, marked for broadcast if it has at most ``limit`` rows; a longer one is joined as Spark sees fit."""
    return F.broadcast(table) if table.count() <= limit else table


def drop(*frames: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def collect_garbage(spark: SparkSession) -> None:
    """Let the driver collect its garbage: Spark deletes the shuffle files of ended queries only after that, and what
    the last query still held only after a second time."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id as a long and the named columns; a missing column is null. Rows without a doc_id stay."""
    have = set(docs.columns)
    picked = [F.col("doc_id").cast("long").alias("doc_id")]
    for c in columns:
        picked.append(docs[c].cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c))
    return docs.select(*picked)


def fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text modulo 5; 0 marks the held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def training_labels(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, label) of at most about ``limit`` labelled rows outside the held-out fold.

    A documented bound: the rows with the smallest hashes of doc_id, at a rate that gives ``limit`` rows; all rows if
    there are fewer. Null labels and ids are not used; of a repeated id the largest label counts."""
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold() != 0))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    n = rows.count()
    if n > limit:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < int((1 << 20) * limit / n))
    return rows
