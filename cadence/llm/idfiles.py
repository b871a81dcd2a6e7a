"""Token ids on disk: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

A table of token files is a folder with two Parquet tables, so it can lie in any store that Spark writes to:

* ``ranks``: (id, rank), one row for each id that occurs; rank 0 is the most frequent id (ties: the smaller id);
* ``blocks``: rows of whole documents in ascending order of doc_id. ``part`` and ``at`` place a block (files of one
  part follow one another; ``at`` is the number of ids before the block in its part), ``docs`` and ``lengths`` name
  its documents, ``control`` and ``data`` hold its ids.

The coding of a block: each id's rank is written in as few whole bytes as it needs (1 to 4, little endian) to
``data``; ``control`` holds two bits an id (bytes less one, the first of four ids in the lowest bits). Frequent ids so
take one byte, and a reader finds every value's place from the control bytes alone: a table of 256 rows gives the
four lengths of a control byte, their running sum the places, and numpy gathers all values at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.encoders import encoder
from cadence.llm.tables import begin, drop, narrow, stored
from cadence.session import scratch_path

BLOCK_IDS = 1 << 16  # a block ends with the document that reaches this many ids
PART_IDS = 1 << 24  # about the ids of one part, the unit that one task writes

# The lengths of the four values that a control byte describes.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, dtype="<u4")
    size = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, dtype=np.uint8)
    codes[: len(v)] = size - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of a block, by table lookup."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    raw = np.frombuffer(data, np.uint8)
    at = np.cumsum(size) - size
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, version (a hash of the text), n and ids (little endian, two bytes an id while all ids fit) of each row."""
    begin(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, "byte")
        wide = "<u2" if max(enc.library.get_vocab_size(True), end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            raw, offsets = tk.utf8(batch.column(1))
            for lo, hi in tk.blocks(offsets):
                rows = [np.concatenate([r, end]) for r in enc.ids(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array([len(r) for r in rows], pa.int64()), pa.array([r.astype(wide).tobytes() for r in rows], pa.binary())],
                    names=["doc_id", "version", "n", "ids"],
                )

    return narrow(docs, "text").withColumn("version", F.xxhash64(F.coalesce("text", F.lit("")))).mapInArrow(run, "doc_id long, version long, n long, ids binary")


def _id_array(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def frequencies(rows: DataFrame) -> DataFrame:
    """id and count over all rows of ``encoded``; each task adds up its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            _, offsets, data = batch.column(1).buffers()
            if data is None or not batch.num_rows:
                continue
            ends = np.frombuffer(offsets, np.int32)[batch.column(1).offset :][[0, batch.num_rows]]
            whole = np.frombuffer(data, np.uint8)[ends[0] : ends[1]]
            found = np.bincount(_id_array(whole.tobytes(), int(batch.column(0).to_numpy().sum())))
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["id", "count"])

    return rows.select("n", "ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = 2) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, to the token files at ``path``.

    ``vocabulary`` is a byte-level BPE file, present at that path on every executor; no special tokens are added.
    Three steps: texts are encoded and their ids stored once; the ids are counted (the table of ranks has at most a row
    for each id of the vocabulary, so it goes to every task); the stored ids are dealt out by ranges of (doc_id,
    version, row), so that rows of one id can be split, and each range is sorted and written as blocks.

    Edges: a null text is empty and has the end id alone; rows with a null doc_id come first; an id with several
    texts has them in the order of a hash, and repeated rows stand one after another; no rows give empty tables; other
    columns are ignored; a document longer than a block is a block of its own."""
    spark = begin(docs)
    rows = stored(encoded(docs, vocabulary, end_id).withColumn("row", F.monotonically_increasing_id()), "token-ids")
    counts = frequencies(rows).orderBy(F.desc("count"), "id").collect()  # bounded by the vocabulary
    by_rank = np.array([r["id"] for r in counts], dtype=np.uint32)
    rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, dtype=np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    n_ids = sum(r["count"] for r in counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, names, held, size = None, 0, [], [], 0

        def block() -> pa.RecordBatch:
            control, data = pack_values(rank[np.concatenate(held)])
            one = [[part], [at], [size], [names], [[len(h) for h in held]], [control], [data]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one, kinds, strict=True)], names=["part", "at", "n", "docs", "lengths", "control", "data"])

        for batch in batches:
            for p, d, n, ids in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3), strict=True):
                part = p
                names.append(d)
                held.append(_id_array(ids.as_buffer(), n))
                size += n
                if size >= BLOCK_IDS:
                    yield block()
                    at, names, held, size = at + size, [], [], 0
        if held:
            yield block()

    n_parts = max(spark.sparkContext.defaultParallelism, -(-n_ids // PART_IDS))
    order = [F.col("doc_id").asc_nulls_first(), F.col("version"), F.col("row")]
    ranged = rows.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "n", "ids")
    ranged.mapInArrow(run, "part int, at long, n long, docs array<bigint>, lengths array<bigint>, control binary, data binary").write.parquet(f"{path}/blocks")
    spark.createDataFrame([(int(i), r) for r, i in enumerate(by_rank)], "id long, rank long").coalesce(1).write.parquet(f"{path}/ranks")
    drop(rows)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and ids, if asked for) of token files.

    Blocks are decoded independently of one another, so any file split will do; the places of the parts are the
    running sum of one row a part."""
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").collect()  # bounded by the vocabulary
    by_rank = np.array([r["id"] for r in ranks], dtype="<u4")
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = ["part", "doc_id", "place", "n_tokens", "ids_crc32", "ids"][: 5 + with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[batch.column(i) for i in range(7)], strict=True):
                part, at, n = (c.as_py() for c in row[:3])
                docs, lengths = row[3].as_py(), np.array(row[4].as_py(), dtype=np.int64)
                ids = by_rank[unpack_values(row[5].as_buffer(), row[6].as_buffer(), n)]
                ends = np.cumsum(lengths)
                cut = [ids[e - k : e] for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [[part] * len(docs), docs, (at + ends - lengths).tolist(), lengths.tolist(), [zlib.crc32(c.view(np.uint8)) for c in cut], cut]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds[: len(names)], strict=False)], names=names)

    shape = "part int, doc_id long, place long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids
    found = blocks.select("part", "at", "n", "docs", "lengths", "control", "data").mapInArrow(run, shape)
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n")).select("part", before.alias("before"))
    return found.join(parts, "part").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Token files of ``docs`` in a new folder of spark.checkpoint.dir, read back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, vocabulary, path, end_id)
    return read_tokens(docs.sparkSession, path)
