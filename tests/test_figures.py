"""Caller-given figures of runs: batch plans, the fold and the stream agree with plain Python."""

import random

import numpy as np
import pytest
from events import search, song
from pyspark.sql import functions as F

from cadence.functions.aggregates import KINDS, _EMPTY
from cadence.operators import sessions as S
from cadence.operators.bucketing import Bucketing
from cadence.functions.predicates import is_search
from cadence.streaming.fold import fold_arrays

GAP = 20_000


def plain(kind, values):
    known = [v for v in values if v is not None]
    if kind == "sum":
        return sum(known)
    if kind in ("min", "max"):
        return (min if kind == "min" else max)(known) if known else None
    return values[0 if kind == "first" else -1]


def brute(rows):
    """(user, start, count, figures...) of runs between searches; rows as EVENT_SCHEMA, songid a number or none."""
    out = []
    for user in {r[1] for r in rows}:
        run, last = [], None
        for r in [*sorted((r for r in rows if r[1] == user), key=lambda r: (r[2], r[0])), None]:
            if run and (r is None or r[3] == "SearchEvent" or r[2] - last > GAP):
                values = [int(x[7]) if x[7] else None for x in run]
                out.append((user, run[0][2], len(run), *(plain(k, values) for k in KINDS)))
                run = []
            if r is not None:
                last = r[2]
                if r[3] == "SongEvent":
                    run.append(r)
    return sorted(out, key=str)


def rows_of(seed, n=200):
    rng = random.Random(seed)
    return [
        song(rng.randrange(400_000), i, user=f"u{rng.randrange(3)}", songid=rng.choice(["", "7", "-3", "12", "90"])) if rng.random() < 0.8
        else search(rng.randrange(400_000), i, user=f"u{rng.randrange(3)}")
        for i in range(n)
    ]



def figures():
    return {k: (k, F.expr("try_cast(songid as bigint)")) for k in KINDS}


@pytest.mark.parametrize("rows_per_bucket", [10**6, 15])
def test_batch_figures(make_events, rows_per_bucket):
    rows = rows_of(rows_per_bucket)
    got = S.split_runs(make_events(rows), GAP, is_search(), figures=figures(), bucketing=Bucketing(adaptive=True, target_rows=rows_per_bucket))
    assert sorted((tuple(r) for r in got.select("user_id", "start_ms", "songs", *KINDS).collect()), key=str) == brute(rows)


def test_any_aggregate_of_carried_columns(make_events):
    rows = [song(1_000, 0, songid="5"), song(2_000, 1, songid="5"), song(3_000, 2, songid="6"), search(4_000, 3), song(5_000, 4)]
    got = S.split_runs(make_events(rows), GAP, is_search(), aggregates={"different": F.count_distinct("songid"), "all": F.sort_array(F.collect_list("songid"))}, carry=("songid",))
    assert sorted((r.songs, r.different, r["all"]) for r in got.collect()) == [(1, 1, ["x"]), (3, 2, ["5", "5", "6"])]


def test_unknown_kind_is_refused(make_events):
    with pytest.raises(ValueError):
        S.split_runs(make_events([song(1, 0)]), GAP, is_search(), figures={"x": ("median", F.lit(1))})


@pytest.mark.parametrize("seed", range(20))
def test_fold_carries_figures_over_any_cut(seed):
    rng = random.Random(seed)
    rows = sorted((r for r in rows_of(seed, 120)), key=lambda r: (r[2], r[0]))
    rows = [(r[0], "u0", *r[2:]) for r in rows]
    out, sess, i = [], None, 0
    while i < len(rows):
        part = rows[i : i + rng.randrange(1, 15)]
        i += len(part)
        values = [int(r[7]) if r[7] else None for r in part]
        sess, closed = fold_arrays(
            sess, np.array([r[2] for r in part]), np.array([int(r[3] == "SongEvent") for r in part]), [np.array([r[3] == "SearchEvent" for r in part])],
            ["split"], GAP, figures=[(k, np.array([_EMPTY[k] if v is None else v for v in values])) for k in KINDS],
        )
        out += [t for t in closed.tuples() if t[0] == "split"]
    if sess[3] is not None:
        out.append(("split", sess[0], *sess[3:]))
    show = lambda k, v: None if k != "sum" and v == _EMPTY[k] else v
    got = sorted((("u0", t[2], t[4], *(show(k, v) for k, v in zip(KINDS, t[5:]))) for t in out), key=str)
    assert got == brute(rows)
