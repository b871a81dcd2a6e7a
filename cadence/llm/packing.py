"""Packing documents into training sequences: bin completion with branch and bound over best-fit incumbents."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import textkit as tk
from cadence.llm.encoders import encoder
from cadence.llm.pretokens import REMEMBERED
from cadence.llm.tables import begin, narrow, stored

PIECES_PER_BATCH = 16_384  # pieces that one task packs together
NODES = 10_000  # fillings that the branch and bound of one batch tries before it keeps its best packing
WIDTH = 8  # undominated fillings kept for a document at each node


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if asked for) of every document's pieces: its ids, then
    ``end_id``, cut only where longer than ``capacity``. A worker remembers the ids of ``remembered`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary, "word", remembered), np.array([end_id], dtype=np.uint32)
        for batch in batches:
            raw, offsets = tk.utf8(batch.column(1))
            names = batch.column(0).to_pylist()
            for lo, hi in tk.blocks(offsets):
                rows: list[tuple] = []
                for name, ids in zip(names[lo:hi], enc.ids(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]), strict=True):
                    ids = np.concatenate([ids, end])
                    for n, at in enumerate(range(0, len(ids), capacity)):
                        part = np.ascontiguousarray(ids[at : at + capacity], dtype="<u4")
                        rows.append((name, n, at, len(part), zlib.crc32(part.view(np.uint8)), *([part] if with_ids else [])))
                columns = list(zip(*rows, strict=True)) or [[]] * (5 + with_ids)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=False)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return narrow(docs, "text").mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each length goes to the fullest bin that still takes it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    mask = 0  # bit r: some bin has room r
    for x in sorted(lengths, reverse=True):
        fits = mask >> x
        if fits:
            r = x + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            b, r = len(bins), capacity
            bins.append([])
        bins[b].append(x)
        room[r - x].append(b)
        mask |= 1 << (r - x)
    return bins


def _fits_into(small: tuple[int, ...], large: tuple[int, ...]) -> bool:
    """Whether the lengths of ``small`` can be dealt out over those of ``large`` as if these were bins."""
    if not small:
        return True
    for i, room in enumerate(large):
        if room >= small[0] and room not in large[:i] and _fits_into(small[1:], tuple(sorted((*large[:i], room - small[0], *large[i + 1 :]), reverse=True))):
            return True
    return False


def lengths_of(mask: int, most: int) -> list[int]:
    """The lengths up to ``most`` whose bits are set, ascending."""
    bits = np.frombuffer((mask & ((1 << (most + 1)) - 1)).to_bytes(most // 8 + 1, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()


def fillings(count: list[int], mask: int, room: int, width: int) -> list[tuple[int, ...]]:
    """Undominated sets of up to four available lengths for ``room``, the least waste first.

    Sets are grown from the larger lengths and kept where nothing more fits, up to 80 ``width`` steps; the ``width``
    fullest that no other one dominates are returned. (Both bounds limit the search, never what is packed.)"""
    found: list[tuple[int, ...]] = []
    steps, most = 0, 80 * width
    below = lengths_of(mask, room)

    def grow(chosen: tuple[int, ...], left: int, i: int) -> None:
        """Adds to ``chosen`` each length from below[i], which fits, down."""
        nonlocal steps
        fourth = len(chosen) == 3
        while i >= 0 and steps < most:
            steps += 1
            x = below[i]
            if count[x] > (chosen.count(x) if x in chosen else 0):
                if fourth:
                    found.append((*chosen, x))
                    return  # a smaller last length is dominated
                more, rest = (*chosen, x), left - x
                j = k = i if rest >= x else bisect_right(below, rest, 0, i) - 1
                while k >= 0 and below[k] in more and count[below[k]] <= more.count(below[k]):
                    k -= 1
                if k >= 0:
                    grow(more, rest, j)
                else:
                    found.append(more)
                    if rest == 0 and not chosen:
                        return  # any set beside one that fills the room alone is dominated
            i -= 1

    grow((), room, len(below) - 1)
    out: list[tuple[int, ...]] = []
    kept: list[tuple[int, int, tuple[int, ...]]] = []  # with its sum and its number of lengths
    for least, n, f in sorted([(-sum(f), len(f), f) for f in found], key=itemgetter(0, 1)):
        if len(out) == width:
            break
        # Of equal sums, only one of more lengths can be dealt out over another; the largest needs a place first.
        if not any((least != full or n > size) and f[0] <= g[0] and _fits_into(f, g) for full, size, g in kept):
            out.append(f)
            kept.append((least, n, f))
    return out or [()]


def bin_completion(lengths: list[int], capacity: int, nodes: int = NODES, width: int = WIDTH) -> list[list[int]]:
    """Bins of at most ``capacity`` holding all ``lengths`` (each from 1 to capacity), as few as it finds.

    Best-fit decreasing is the first incumbent. Branch and bound then fills one bin at a time around the largest
    remaining length, trying its undominated fillings, the fullest first; a branch ends when the waste of its bins
    exceeds what a packing with one bin fewer than the incumbent may waste. Every 512 fillings the rest of the branch
    is also closed by best fit. It stops at the volume bound or after ``nodes`` fillings, so the result is
    never worse than best-fit decreasing."""
    best = best_fit(lengths, capacity)
    total = sum(lengths)
    bound = -(-total // capacity)
    if len(best) <= bound:
        return best
    count = [0] * (capacity + 1)
    for x in lengths:
        count[x] += 1
    mask = sum(1 << x for x in range(1, capacity + 1) if count[x])
    bins: list[list[int]] = []
    stack: list[tuple[int, list[tuple[int, ...]], int]] = []  # largest length, its fillings, the next one to try
    wasted, tried, left = 0, 0, len(lengths)

    def take(x: int, n: int) -> None:
        nonlocal mask
        count[x] -= n
        if count[x] == 0:
            mask &= ~(1 << x)
        else:
            mask |= 1 << x

    def close() -> None:
        nonlocal best
        rest = [x for x in range(1, capacity + 1) for _ in range(count[x])]
        whole = [*map(list, bins), *best_fit(rest, capacity)]
        if len(whole) < len(best):
            best = whole

    def descend() -> None:
        x = mask.bit_length() - 1
        take(x, 1)
        base: list[int] = []  # where four further lengths cannot fill the room, the largest go in before them
        room = capacity - x
        while 0 < 4 * (y := mask.bit_length() - 1) < room:
            take(y, 1)
            base.append(y)
            room -= y
        options = [(*base, *f) for f in fillings(count, mask, room, width)]
        for y in base:
            take(y, -1)
        stack.append((x, options, 0))

    descend()
    while stack and tried < nodes and len(best) > bound:
        x, options, at = stack.pop()
        if at:  # undo the filling tried last
            gone = bins.pop()
            wasted -= capacity - sum(gone)
            left += len(gone)
            for y in gone[1:]:
                take(y, -1)
        if at == len(options):
            take(x, -1)
            continue
        tried += 1
        bins.append([x, *options[at]])
        wasted += capacity - sum(bins[-1])
        left -= len(bins[-1])
        for y in options[at]:
            take(y, 1)
        stack.append((x, options, at + 1))
        if wasted > capacity * (len(best) - 1) - total:
            continue
        if not left:
            best = [list(b) for b in bins]
        else:
            if tried % 512 == 0:
                close()
            descend()
    if stack and not stack[-1][2]:
        take(stack[-1][0], -1)  # its document is in no bin yet
    if len(best) > bound and left:
        close()
    return best


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        length = table.column("length").to_numpy()
        by: dict[int, list[int]] = {}
        for i in np.argsort(length, kind="stable").tolist():
            by.setdefault(int(length[i]), []).append(i)
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        first = table.column("batch")[0].as_py() << 32
        for n, b in enumerate(bin_completion(length.tolist(), capacity)):
            at = 0
            for x in b:
                i = by[x].pop()
                sequence[i], offset[i] = first + n, at
                at += x
        return table.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every document's pieces.

    Pieces of full length are sequences of their own. The others are dealt evenly, whatever their id, into batches
    of about 16,384, and each batch is packed by ``bin_completion`` in one task; a batch wastes at most about one
    sequence against packing all pieces together. Tokenized pieces are stored once, so a lost executor repeats only
    its own tasks and each piece keeps its place.

    Edges: null and empty texts are documents of one id (``end_id``); a null id and repeated rows are packed like any other row;
    a text of any length is cut into pieces; other columns are ignored; no rows give no rows."""
    begin(docs)
    whole = stored(pieces(docs, vocabulary, capacity, end_id, remembered=remembered), "pieces").withColumn("row", F.monotonically_increasing_id())
    parts = whole.where(F.col("length") < capacity)
    batches = max(1, -(-parts.count() // PIECES_PER_BATCH))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = parts.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches)).cast("long"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = dealt.groupBy("batch").applyInArrow(_pack(capacity), schema)
    full = whole.where(F.col("length") == capacity).select(*columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionAll(full)
