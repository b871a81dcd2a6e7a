"""Sessions: gap edges, dialects, and randomized checks of the two-level plan."""

import random

import brute
import pytest
from events import search, song

from cadence.functions.predicates import is_search, not_discover_weekly
from cadence.operators.bucketing import Bucketing
from cadence.operators.sessions import runs_from, session_stats, sessionize

GAP = 20_000


def stats(df):
    return sorted(tuple(r) for r in df.collect())


def test_touching_events_share_a_session(make_events):
    got = stats(session_stats(make_events([song(0, 0), song(20_000, 1)]), GAP))
    assert got == [("1", 0, 40_000, 40, 2)]


def test_just_apart_events_split(make_events):
    got = stats(session_stats(make_events([song(0, 0), song(20_001, 1)]), GAP))
    assert got == [("1", 0, 20_000, 20, 1), ("1", 20_001, 40_001, 20, 1)]


def test_chain(make_events):
    got = stats(session_stats(make_events([song(0, 0), song(20_000, 1), search(39_999, 2)]), GAP))
    assert got == [("1", 0, 59_999, 59, 2)]


def test_strict_gap_splits_touching(make_events):
    got = stats(session_stats(make_events([song(0, 0), song(20_000, 1)]), GAP, merge_touching=False))
    assert got == [("1", 0, 20_000, 20, 1), ("1", 20_000, 40_000, 20, 1)]


def test_search_only_session_has_zero_songs(make_events):
    assert stats(session_stats(make_events([search(5, 0)]), GAP)) == [("1", 5, 20_005, 20, 0)]


def test_two_dialects(make_events):
    ev = make_events([song(1_000, 0), search(4_500, 1), song(7_999, 2)])
    assert stats(session_stats(ev, GAP, duration="window")) == [("1", 1_000, 27_999, 26, 2)]
    assert stats(session_stats(ev, GAP, duration="span")) == [("1", 1_000, 7_999, 6, 2)]


def test_rejects_bad_arguments(make_events):
    with pytest.raises(ValueError):
        sessionize(make_events([song(0, 0)]), 0)
    with pytest.raises(ValueError):
        session_stats(make_events([song(0, 0)]), GAP, duration="other")


def random_rows(seed, n=400, users=6, span=600_000, hot_user=True):
    rnd = random.Random(seed)
    rows = []
    for eid in range(n):
        # One hot user holds about a third of all rows.
        u = "hot" if hot_user and rnd.random() < 0.34 else f"u{rnd.randrange(users)}"
        ts = rnd.randrange(span) // rnd.choice([1, 1000, 20_000]) * rnd.choice([1, 1000, 20_000])
        ts = min(ts, span)
        if rnd.random() < 0.3:
            rows.append(search(ts, eid, user=u))
        else:
            rows.append(song(ts, eid, user=u, playlist=rnd.choice(["DiscoverWeekly", "DailyMix", "ChillHits"])))
    return rows


BUCKETINGS = [
    Bucketing(width_ms=86_400_000),
    Bucketing(width_ms=7_000),
    Bucketing(width_ms=1),
    Bucketing(width_ms=86_400_000, adaptive=True, target_rows=10),
    Bucketing(adaptive=True),
    Bucketing(adaptive=True, target_rows=60),
]
IDS = ["day", "7s", "1ms", "adaptive-heavy", "adaptive-single-pass", "adaptive-mixed"]


@pytest.mark.parametrize("bucketing", BUCKETINGS, ids=IDS)
@pytest.mark.parametrize("seed", [1, 2])
def test_random_against_brute_force(make_events, bucketing, seed):
    rows = random_rows(seed)
    if bucketing.target_rows == 60:  # the hot user is heavy, the others light
        counts = {}
        for r in rows:
            counts[r[1]] = counts.get(r[1], 0) + 1
        assert counts["hot"] > 60 and max(c for k, c in counts.items() if k != "hot") <= 60
    ev = make_events(rows)
    for touching in (True, False):
        got = stats(session_stats(ev, GAP, merge_touching=touching, bucketing=bucketing))
        assert got == brute.session_stats(rows, GAP, merge_touching=touching)
    ann = sessionize(ev, GAP, delimiters={"dw": not_discover_weekly(), "l": is_search()}, bucketing=bucketing)
    assert stats(runs_from(ann, "l")) == brute.runs(rows, GAP, lambda e: e[3] == "SearchEvent")
    assert stats(runs_from(ann, "dw")) == brute.runs(
        rows, GAP, lambda e: e[3] == "SearchEvent" or e[6] != "DiscoverWeekly"
    )


@pytest.mark.parametrize("bucketing", BUCKETINGS[1:], ids=IDS[1:])
def test_negative_times_and_ties(make_events, bucketing):
    from cadence.operators.panes import early_session_panes

    rnd = random.Random(99)
    rows = []
    for eid in range(250):
        ts = rnd.choice([-90_000, -60_000, -20_000, -1, 0, 1, 20_000]) + rnd.choice([0, 0, 0, rnd.randrange(-5_000, 5_000)])
        u = f"u{rnd.randrange(3)}"
        rows.append(search(ts, eid, user=u) if rnd.random() < 0.3 else song(ts, eid, user=u, playlist=rnd.choice(["DiscoverWeekly", "ChillHits"])))
    ev = make_events(rows)
    assert stats(session_stats(ev, GAP, bucketing=bucketing)) == brute.session_stats(rows, GAP)
    ann = sessionize(ev, GAP, delimiters={"l": is_search()}, bucketing=bucketing)
    assert stats(runs_from(ann, "l")) == brute.runs(rows, GAP, lambda e: e[3] == "SearchEvent")
    got = sorted(tuple(r) for r in early_session_panes(ev, GAP, 7_000, bucketing=bucketing).collect())
    assert got == brute.panes(rows, GAP, 7_000)


def test_many_heavy_users_stay_split(spark, make_events):
    """However many users are heavy, their rows are cut into buckets."""
    from cadence.operators.bucketing import BUCKET, heavy_keys, range_buckets

    rows = [song(ts * 1000, u * 100 + ts, user=f"u{u}") for u in range(40) for ts in range(30)]
    ev = make_events(rows)
    bucketing = Bucketing(adaptive=True, target_rows=10)
    heavy, total = heavy_keys(ev, ["user_id"], bucketing)
    assert heavy.count() == 40 and total == 1200
    plan = sessionize(ev, GAP, bucketing=bucketing)._jdf.queryExecution().optimizedPlan().toString()
    assert BUCKET in plan
    assert "stretch" in session_stats(ev, GAP, bucketing=bucketing)._jdf.queryExecution().optimizedPlan().toString()
    assert stats(session_stats(ev, GAP, bucketing=bucketing)) == brute.session_stats(rows, GAP)
    assert heavy_keys(ev, ["user_id"], Bucketing(adaptive=True, target_rows=30)) is None
    assert heavy_keys(ev.limit(0), ["user_id"], bucketing) is None
    cut = range_buckets(ev, ["user_id", "ts_ms", "event_id"], total, 10)
    assert cut.groupBy(BUCKET).count().agg({"count": "max"}).first()[0] <= 10


def test_one_millisecond_is_cut_by_the_tiebreak(spark, make_events):
    from cadence.operators.bucketing import BUCKET, range_buckets

    rows = [song(5_000, eid, user="hot") for eid in range(1000)]
    ev = make_events(rows)
    cut = range_buckets(ev, ["user_id", "ts_ms", "event_id"], 1000, 20)
    sizes = [r["count"] for r in cut.groupBy(BUCKET).count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 20
    got = stats(session_stats(ev, GAP, bucketing=Bucketing(adaptive=True, target_rows=20)))
    assert got == brute.session_stats(rows, GAP)


def test_counts_follow_a_rewritten_input(spark, tmp_path, make_events):
    """Nothing is remembered by path: a rewritten input is counted again."""
    from cadence.operators.bucketing import heavy_keys

    path, bucketing = str(tmp_path / "events"), Bucketing(adaptive=True, target_rows=10)
    for n, heavy in ((5, False), (50, True)):
        make_events([song(ts, ts) for ts in range(n)]).write.mode("overwrite").parquet(path)
        assert (heavy_keys(spark.read.parquet(path), ["user_id"], bucketing) is not None) is heavy
