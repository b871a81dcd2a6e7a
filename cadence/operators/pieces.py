"""Sessions and runs stitched from mergeable pieces: one shuffle of events, whoever is heavy.

Rows are dealt out by ranges of (user, time, tiebreak), so a heavy user simply fills many
ranges.  Each stretch of sorted rows is reduced on its own, with array operations, to pieces:

* its sessions, of which only the first and the last can go on beyond the stretch;
* per delimiter its runs, of which only one that reaches the first or the last row can.

Pieces form a monoid: two neighbours that are both open at their common border, of one
user and at most a gap apart, become one.  So all inner pieces are results already, and
only the few open ones (at most a handful a stretch) meet again, per user and in order.
A border row that is a delimiter leaves a piece that is open on neither side, which keeps
the runs around it apart.  The pieces are stored once, because all results must be read
from the same cut into stretches.

A run also reports its session's start.  Runs in a stretch's first session learn it from
that session's stitched piece, by a join on the stretch.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.aggregates import Figures, filled, over_segments, shown
from cadence.operators.bucketing import stored
from cadence.session import ship_package

SESSION = "session"
_BASE = "kind string, stretch long, user_id string, session_start_ms long, in_first boolean, start_ms long, start_id long, last_ms long, songs long, left_open boolean, right_open boolean"


def _cut(user: np.ndarray, ts: np.ndarray, event: np.ndarray, song: np.ndarray, delims: list[np.ndarray], names: list[str], figures: list[tuple[str, np.ndarray]], gap: int) -> Iterator[tuple]:
    """The pieces of one stretch as columns; rows are sorted by (user, time, tiebreak), ``gap`` is the largest
    difference inside a session and ``user`` a number per user."""
    n = len(ts)
    new = np.ones(n, dtype=bool)
    new[1:] = (user[1:] != user[:-1]) | (ts[1:] - ts[:-1] > gap)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], n) - 1
    opens = ts[firsts]
    k = len(firsts)
    none = [np.zeros(k, dtype=np.int64)] * len(figures)
    yield (SESSION, firsts, opens, firsts == 0, firsts, lasts, np.add.reduceat(song, firsts), firsts == 0, lasts == n - 1, none)
    session = np.cumsum(new) - 1
    for name, d in zip(names, delims, strict=True):
        kept = np.flatnonzero(~d)
        if len(kept):
            run = np.cumsum(d | new)[kept]
            at = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            to = np.append(at[1:], len(kept)) - 1
            a, b = kept[at], kept[to]
            values = [over_segments(kind, v[kept], at, to) for kind, v in figures]
            yield (name, a, opens[session[a]], session[a] == 0, a, b, to - at + 1, a == 0, b == n - 1, values)
        wall = np.array(sorted({i for i in (0, n - 1) if d[i]}), dtype=np.int64)
        if len(wall):
            shut = np.zeros(len(wall), dtype=bool)
            yield (name, wall, ts[wall], shut, wall, wall, np.zeros(len(wall), np.int64), shut, shut, [np.zeros(len(wall), np.int64)] * len(figures))


def _piece_batches(names: list[str], kinds: list[str], gap: int, rows_a_piece: int):
    columns = [c.split()[0] for c in _BASE.split(", ")] + [f"figure_{j}" for j in range(len(kinds))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stretch = TaskContext.get().partitionId() << 40
        for whole in batches:
            for lo in range(0, whole.num_rows, rows_a_piece):
                batch = whole.slice(lo, rows_a_piece)
                users = batch.column(0).dictionary_encode()
                code = users.indices.to_numpy(zero_copy_only=False)
                number = lambda i: batch.column(i).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                ts, event = number(1), batch.column(2)
                delims = [number(4 + k).astype(bool) for k in range(len(names))]
                figures = [(kind, number(4 + len(names) + j)) for j, kind in enumerate(kinds)]
                for kind, at, opened, in_first, a, b, songs, left, right, values in _cut(code, ts, event, number(3), delims, names, figures, gap):
                    k = len(at)
                    arrays = [
                        pa.array([kind] * k, pa.string()), pa.array(np.full(k, stretch)), batch.column(0).take(pa.array(at)), pa.array(opened), pa.array(in_first), pa.array(ts[a]),
                        event.take(pa.array(a)), pa.array(ts[b]), pa.array(songs.astype(np.int64)), pa.array(left), pa.array(right), *[pa.array(v) for v in values],
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=columns)
                stretch += 1

    return run


def cut_pieces(
    events: DataFrame, gap_ms: int, delimiters: Mapping[str, Column], song: Column, *, figures: Figures | None = None, merge_touching: bool = True, rows_a_piece: int = 1 << 20
) -> DataFrame:
    """The stored table of pieces (see the module doc); ``events`` need user_id, ts_ms and event_id."""
    ship_package(events.sparkSession)
    figures = dict(figures or {})
    narrow = events.filter(F.col("user_id").isNotNull() & F.col("ts_ms").isNotNull()).select(
        F.col("user_id").cast("string").alias("user_id"),
        "ts_ms",
        "event_id",
        song.cast("bigint").alias("_song"),
        *[F.coalesce(p, F.lit(False)).alias(f"_d{k}") for k, p in enumerate(delimiters.values())],
        *[filled(kind, value).alias(f"_f{j}") for j, (kind, value) in enumerate(figures.values())],
    )
    order = ["user_id", "ts_ms", "event_id"]
    kinds = [kind for kind, _ in figures.values()]
    schema = _BASE + "".join(f", figure_{j} long" for j in range(len(kinds)))
    run = _piece_batches(list(delimiters), kinds, gap_ms if merge_touching else gap_ms - 1, rows_a_piece)
    return stored(narrow.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "pieces")


def _stitched(pieces: DataFrame, kind: str, gap_ms: int, merge_touching: bool, kinds: list[str]) -> DataFrame:
    """The open pieces of one kind with ``chain``: the number of the result each belongs to, per user."""
    own = pieces.filter(F.col("kind") == F.lit(kind))
    # Only borders matter, so a stretch's wall counts although it is open on neither side.
    edge = own.filter(F.col("left_open") | F.col("right_open") | (F.col("songs") == 0) & F.lit(kind != SESSION))
    w = Window.partitionBy("user_id").orderBy("start_ms", "start_id", "stretch", "last_ms")
    apart = F.col("start_ms") - F.lag("last_ms").over(w) > F.lit(gap_ms if merge_touching else gap_ms - 1)
    joins = F.coalesce(F.lag("right_open").over(w), F.lit(False)) & F.col("left_open") & ~apart
    return edge.withColumn("_new", F.when(joins, 0).otherwise(1)).withColumn("chain", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")


def _merge(kind: str, j: int) -> Column:
    c, order = F.col(f"figure_{j}"), F.struct("start_ms", "start_id", "stretch")
    if kind in ("first", "last"):
        return (F.min_by if kind == "first" else F.max_by)(c, order)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](c).cast("bigint")


def sessions_from_pieces(pieces: DataFrame, gap_ms: int, *, merge_touching: bool = True) -> DataFrame:
    """``(user_id, start_ms, last_ms, songs)`` of every session."""
    inner = pieces.filter((F.col("kind") == F.lit(SESSION)) & ~F.col("left_open") & ~F.col("right_open")).select("user_id", "start_ms", "last_ms", "songs")
    joined = _stitched(pieces, SESSION, gap_ms, merge_touching, []).groupBy("user_id", "chain").agg(F.min("start_ms").alias("start_ms"), F.max("last_ms").alias("last_ms"), F.sum("songs").alias("songs"))
    return inner.unionAll(joined.select("user_id", "start_ms", "last_ms", "songs"))


def runs_from_pieces(pieces: DataFrame, name: str, gap_ms: int, *, figures: Figures | None = None, merge_touching: bool = True) -> DataFrame:
    """``(user_id, session_start_ms, start_ms, last_ms, songs)`` and the figures of every run of ``name``."""
    kinds = [kind for kind, _ in (figures or {}).values()]
    values = [f"figure_{j}" for j in range(len(kinds))]
    # The true start of each stretch's first session.
    sessions = _stitched(pieces, SESSION, gap_ms, merge_touching, [])
    starts = sessions.withColumn("_start", F.min("start_ms").over(Window.partitionBy("user_id", "chain"))).filter("in_first").select("stretch", "_start")
    mine = pieces.filter((F.col("kind") == F.lit(name)) & (F.col("songs") > 0))
    inner = mine.filter(~F.col("left_open") & ~F.col("right_open")).select("user_id", "stretch", "session_start_ms", "in_first", "start_ms", "last_ms", "songs", *values)
    merged = (
        _stitched(pieces, name, gap_ms, merge_touching, kinds)
        .filter("songs > 0")
        .groupBy("user_id", "chain")
        .agg(
            F.min(F.struct("start_ms", "start_id", "stretch", "session_start_ms", "in_first")).alias("f"),
            F.max("last_ms").alias("last_ms"),
            F.sum("songs").alias("songs"),
            *[_merge(kind, j).alias(f"figure_{j}") for j, kind in enumerate(kinds)],
        )
        .select("user_id", "f.stretch", "f.session_start_ms", "f.in_first", "f.start_ms", "last_ms", "songs", *values)
    )
    every = inner.unionAll(merged)
    known = every.filter(~F.col("in_first"))
    first = every.filter("in_first").join(starts, "stretch").withColumn("session_start_ms", F.col("_start")).select(*every.columns)
    return known.unionAll(first).select(
        "user_id", "session_start_ms", "start_ms", "last_ms", "songs", *[shown(kind, F.col(f"figure_{j}")).alias(n) for j, (n, (kind, _)) in enumerate((figures or {}).items())]
    )
