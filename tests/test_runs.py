"""Run splitting: the reference's four cases, on the batch and the stream path."""

import numpy as np
import pytest
from events import search, song
from pyspark.sql import functions as F

from cadence.functions.predicates import is_search, not_discover_weekly
from cadence.operators.sessions import discover_weekly_runs, listening_runs, split_runs
from cadence.streaming.fold import fold_arrays

GAP = 20_000

# All events at timestamp 1: order comes from event_id (the tiebreak).
CASES = {
    "only_search": ([search(1, 0)], []),
    "trailing_delimiter": ([song(1, 0, songid="2"), song(1, 1, songid="3"), song(1, 2, songid="4"), search(1, 3)], [3]),
    "leading_delimiter": ([search(1, 0), song(1, 1, songid="2"), song(1, 2, songid="3"), song(1, 3, songid="4")], [3]),
    "several_runs": (
        [
            song(1, 0, songid="2"),
            song(1, 1, songid="3"),
            song(1, 2, songid="3"),
            search(1, 3),
            song(1, 4, songid="3"),
            song(1, 5, songid="4"),
        ],
        [3, 2],
    ),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_reference_cases_batch(make_events, case):
    rows, expected = CASES[case]
    got = listening_runs(make_events(rows), GAP).orderBy("start_ms", "songs").collect()
    assert sorted(r.songs for r in got) == sorted(expected)
    assert all(r.user_id == "1" and r.length_s == 0 for r in got)


def stream_fold_runs(rows):
    """Runs from the streaming operator's fold (rows already in (ts, event_id) order)."""
    rows = sorted(rows, key=lambda r: (r[2], r[0]))
    ts = np.array([r[2] for r in rows])
    song = np.array([int(r[3] == "SongEvent") for r in rows])
    delim = np.array([r[3] == "SearchEvent" for r in rows])
    sess, out = fold_arrays(None, ts, song, [delim], ["split"], GAP)
    closed = out.tuples()
    if sess is not None and sess[3] is not None:  # the run still open at the end
        closed.append(("split", sess[0], sess[3], sess[4], sess[5]))
    return [r for r in closed if r[0] == "split"]


@pytest.mark.parametrize("case", sorted(CASES))
def test_reference_cases_stream_fold(case):
    rows, expected = CASES[case]
    assert sorted(r[4] for r in stream_fold_runs(rows)) == sorted(expected)


def test_run_members_in_order(make_events):
    rows, _ = CASES["several_runs"]
    ev = make_events(rows)
    runs = split_runs(ev, GAP, is_search()).collect()
    # Runs are keyed by their first member: event 0 opens [2,3,3], event 3 (the search) opens [3,4].
    assert sorted((r.songs, r.start_ms, r.end_ms) for r in runs) == [(2, 1, 1), (3, 1, 1)]


def test_discover_weekly_broken_by_other_playlist(make_events):
    rows = [
        song(1000, 0, playlist="DiscoverWeekly"),
        song(2000, 1, playlist="DiscoverWeekly"),
        song(3000, 2, playlist="DailyMix"),
        song(4000, 3, playlist="DiscoverWeekly"),
        search(5000, 4),
        song(9000, 5, playlist="DiscoverWeekly"),
        song(12500, 6, playlist="DiscoverWeekly"),
    ]
    got = sorted((r.songs, r.length_s) for r in discover_weekly_runs(make_events(rows), GAP).collect())
    assert got == [(1, 0), (2, 1), (2, 3)]


def test_island_fold_seconds(make_events):
    # S1 S2 Q3 S4 Q5 Q6 S7 (seconds): runs of 2 (1 s), 1 (0 s), 1 (0 s).
    rows = [song(1000, 1), song(2000, 2), search(3000, 3), song(4000, 4), search(5000, 5), search(6000, 6), song(7000, 7)]
    ev = make_events(rows)
    batch = sorted((r.songs, r.length_s) for r in listening_runs(ev, GAP).collect())
    fold = sorted((r[4], (r[3] - r[2]) // 1000) for r in stream_fold_runs(rows))
    assert batch == fold == [(1, 0), (1, 0), (2, 1)]


def test_delimiter_is_any_column(make_events):
    rows = [song(0, 0, device="Mobile"), song(1, 1), song(2, 2), song(3, 3, device="Mobile"), song(4, 4)]
    got = split_runs(make_events(rows), GAP, F.col("device_type") == "Mobile").collect()
    assert sorted(r.songs for r in got) == [1, 2]


def test_not_discover_weekly_predicate(make_events):
    rows = [song(0, 0, playlist="DiscoverWeekly"), song(1, 1, playlist="ChillHits"), search(2, 2)]
    flags = [r.d for r in make_events(rows).orderBy("event_id").select(not_discover_weekly().alias("d")).collect()]
    assert flags == [False, True, True]
