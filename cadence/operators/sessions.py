"""Inactivity-gap sessions and runs inside them, for batch DataFrames.

``sessionize`` annotates every event with the start of its session and, for each
named delimiter predicate, the key of the run it belongs to.  All results
(session stats in both duration dialects, Discover-Weekly runs, listening runs,
runs with any caller-supplied delimiter) are plain aggregations of that one
annotated DataFrame, so several results can share its single shuffle.

Semantics
---------
* Order inside a user: ``(ts_ms, event_id)``; ``event_id`` breaks timestamp ties.
* A new session starts at an event iff it is the user's first event or
  ``ts - previous ts > gap`` (``merge_touching=True``: events exactly ``gap`` apart
  share a session) or ``>= gap`` (``merge_touching=False``).
* A run is a maximal sequence of non-delimiter events inside one session;
  delimiters are dropped and never form runs.  Every run is keyed by the
  position ``(ts, event_id)`` of the event that opened it: the preceding
  delimiter, or the session's first event.

Execution (see ``cadence.operators.bucketing``)
-----------------------------------------------
The default (adaptive) bucketing first counts rows per user.  When no user
exceeds the per-task bound, the plan is one hash exchange on the user, one sort
and one ordered pass.  Otherwise session stats and runs are stitched from mergeable
pieces (``cadence.operators.pieces``): one range exchange of all events and one small
exchange of pieces.  Where every event must be annotated (panes, several results at
once, any aggregate), light users take the ordered pass and heavy users' rows, stored
once in ranges, the two-level plan (which fixed-width bucketing uses for all
users): one hash exchange on ``(user, bucket)`` and one sort feed a local Window; a small
per-bucket summary (partial aggregation, reusing that exchange) is carried across
the user's buckets and joined back on ``(user, bucket)``.  No Window ever holds
more than one bucket of a heavy user, and nothing unbounded is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.aggregates import Figures, check_figures, over_run
from cadence.functions.predicates import floor_div, is_search, not_discover_weekly, song_flag
from cadence.operators.bucketing import ADAPTIVE, BUCKET, Bucketing, add_bucket, heavy_keys, range_buckets
from cadence.operators.pieces import cut_pieces, runs_from_pieces, sessions_from_pieces

SESSION_START = "session_start_ms"
IS_SESSION_START = "is_session_start"
SONG = "song"


def song_measure() -> dict[str, Column]:
    """The per-event measure session stats and panes sum: 1 for a song, else 0."""
    return {SONG: song_flag()}


def _splits(delta: Column, gap_ms: int, merge_touching: bool) -> Column:
    return delta > F.lit(gap_ms) if merge_touching else delta >= F.lit(gap_ms)


def sessionize(
    events: DataFrame,
    gap_ms: int,
    *,
    delimiters: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
    merge_touching: bool = True,
    bucketing: Bucketing | None = ADAPTIVE,
    user_col: str = "user_id",
    ts_col: str = "ts_ms",
    tiebreak_col: str = "event_id",
) -> DataFrame:
    """Annotate events with their session and runs.

    Output columns: ``user_col, ts_col, tiebreak_col``, one column per ``measures``
    entry (per-event values the caller aggregates later, e.g. a song flag),
    ``session_start_ms``, ``is_session_start`` and, per delimiter ``d``, ``d_delim``
    (bool) and ``d_run`` (struct: position of the event opening the run).

    Only these columns cross the shuffle.  The per-event pass and the per-bucket
    summary read exactly the same columns (the summary's first-event position
    carries the measures), so Spark computes the (user, bucket) exchange once and
    the summary reuses it instead of shuffling the events a second time.
    """
    if gap_ms <= 0:
        raise ValueError("gap_ms must be positive")
    delimiters = dict(delimiters or {})
    measures = dict(measures or {})
    u, t, i = user_col, ts_col, tiebreak_col
    ts = F.col(t)

    # Rows without a user or a time cannot be placed in a session.  Filtering them
    # explicitly (instead of letting the join infer it on one side only) also keeps
    # both inputs of the join below identical.
    narrow = events.filter(F.col(u).isNotNull() & ts.isNotNull()).select(
        u,
        t,
        i,
        *[m.alias(name) for name, m in measures.items()],
        *[F.coalesce(pred, F.lit(False)).alias(f"{name}_delim") for name, pred in delimiters.items()],
    )
    if bucketing is None:  # the caller knows that no user is heavy
        return _single_pass(narrow, gap_ms, delimiters, measures, merge_touching, u, t, i)
    if not bucketing.adaptive:
        return _two_level(add_bucket(narrow, t, bucketing), gap_ms, delimiters, measures, merge_touching, u, t, i)
    # Count users only: cheaper than the projection, one column read.
    found = heavy_keys(events.filter(F.col(u).isNotNull() & ts.isNotNull()).select(u), [u], bucketing)
    if found is None:
        # No user exceeds the per-task bound: one ordered pass per user suffices.
        return _single_pass(narrow, gap_ms, delimiters, measures, merge_touching, u, t, i)
    # Light users take the single ordered pass, heavy users the two-level plan over
    # stored ranges.  Nothing is hinted: a short list of heavy users is broadcast by
    # its measured size, a long one is joined on the user, whose partitioning the
    # ordered pass then reuses.
    heavy, total = found
    light = narrow.join(heavy, on=u, how="left_anti")
    hot = range_buckets(narrow.join(heavy, on=u, how="left_semi"), [u, t, i], total, bucketing.target_rows)
    return _single_pass(light, gap_ms, delimiters, measures, merge_touching, u, t, i).unionByName(
        _two_level(hot, gap_ms, delimiters, measures, merge_touching, u, t, i)
    )


def _two_level(
    df: DataFrame,
    gap_ms: int,
    delimiters: Mapping[str, Column],
    measures: Mapping[str, Column],
    merge_touching: bool,
    u: str,
    t: str,
    i: str,
) -> DataFrame:
    """Window per (user, bucket), per-bucket summary carried across a user's buckets,
    joined back on (user, bucket); see the module doc."""
    ts = F.col(t)
    df = df.filter(F.col(BUCKET).isNotNull())

    pos = F.struct(ts.alias("t"), F.col(i).alias("i"))
    first = F.struct(ts.alias("t"), F.col(i).alias("i"), *[F.col(m) for m in measures])
    w = Window.partitionBy(u, BUCKET).orderBy(t, i)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # Level 1: inside each (user, bucket).  The bucket's first row cannot know yet
    # whether it opens a session; that is settled by the carry below.
    df = df.withColumn("_lprev", F.lag(t).over(w))
    lstart = F.col("_lprev").isNotNull() & _splits(ts - F.col("_lprev"), gap_ms, merge_touching)
    df = df.withColumn("_lstart", lstart)
    local = [F.max(F.when(F.col("_lstart"), ts)).over(upto).alias("_lsess")]
    for name in delimiters:
        mark = F.col("_lstart") | F.col(f"{name}_delim")
        local.append(F.max(F.when(mark, pos)).over(upto).alias(f"_l_{name}"))
    df = df.select("*", *local)

    # Level 2: one summary row per (user, bucket); same partitioning, so no exchange.
    summary = df.groupBy(u, BUCKET).agg(
        F.min(first).alias("_first"),
        F.max(t).alias("_bmax"),
        F.max(F.when(F.col("_lstart"), ts)).alias("_blsess"),
        *[
            F.max(F.when(F.col("_lstart") | F.col(f"{n}_delim"), pos)).alias(f"_bl_{n}")
            for n in delimiters
        ],
    )
    before = Window.partitionBy(u).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_cmax", F.max("_bmax").over(before))
    first_ts = F.col("_first.t")
    first_pos = F.struct(first_ts.alias("t"), F.col("_first.i").alias("i"))
    summary = summary.withColumn(
        "_fstart", F.col("_cmax").isNull() | _splits(first_ts - F.col("_cmax"), gap_ms, merge_touching)
    )
    summary = summary.select(
        u,
        BUCKET,
        F.col("_first").alias("_first"),
        "_cmax",
        "_fstart",
        F.max(F.coalesce(F.col("_blsess"), F.when(F.col("_fstart"), first_ts))).over(before).alias("_csess"),
        *[
            F.max(F.greatest(F.col(f"_bl_{n}"), F.when(F.col("_fstart"), first_pos))).over(before).alias(f"_c_{n}")
            for n in delimiters
        ],
    )

    out = df.join(summary, on=[u, BUCKET], how="inner")
    prev = F.coalesce(F.col("_lprev"), F.col("_cmax"))
    first_pos = F.struct(F.col("_first.t").alias("t"), F.col("_first.i").alias("i"))
    first_if_start = F.when(F.col("_fstart"), first_pos)
    result = [F.col(u), ts, F.col(i), *[F.col(m) for m in measures]] + [
        F.coalesce(F.col("_lsess"), F.when(F.col("_fstart"), F.col("_first.t")), F.col("_csess")).alias(SESSION_START),
        (prev.isNull() | _splits(ts - prev, gap_ms, merge_touching)).alias(IS_SESSION_START),
    ]
    for name in delimiters:
        result.append(F.col(f"{name}_delim"))
        result.append(F.greatest(F.col(f"_l_{name}"), first_if_start, F.col(f"_c_{name}")).alias(f"{name}_run"))
    return out.select(*result)


def _single_pass(
    narrow: DataFrame,
    gap_ms: int,
    delimiters: Mapping[str, Column],
    measures: Mapping[str, Column],
    merge_touching: bool,
    u: str,
    t: str,
    i: str,
) -> DataFrame:
    """The plan when every user fits one task: one exchange on the user, one sort,
    one ordered pass (the same columns as the two-level plan)."""
    ts = F.col(t)
    pos = F.struct(ts.alias("t"), F.col(i).alias("i"))
    w = Window.partitionBy(u).orderBy(t, i)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = narrow.withColumn("_prev", F.lag(t).over(w))
    start = F.col("_prev").isNull() | _splits(ts - F.col("_prev"), gap_ms, merge_touching)
    df = df.withColumn(IS_SESSION_START, start)
    result = [F.col(u), ts, F.col(i), *[F.col(m) for m in measures]] + [
        F.max(F.when(F.col(IS_SESSION_START), ts)).over(upto).alias(SESSION_START),
        F.col(IS_SESSION_START),
    ]
    for name in delimiters:
        mark = F.col(IS_SESSION_START) | F.col(f"{name}_delim")
        result.append(F.col(f"{name}_delim"))
        result.append(F.max(F.when(mark, pos)).over(upto).alias(f"{name}_run"))
    return df.select(*result)


def _check_duration(duration: str) -> None:
    if duration not in ("window", "span"):
        raise ValueError("duration must be 'window' or 'span'")


def session_stats_from(
    annotated: DataFrame,
    gap_ms: int,
    *,
    duration: str = "window",
    user_col: str = "user_id",
    ts_col: str = "ts_ms",
) -> DataFrame:
    """``(user_id, start_ms, end_ms, duration_s, songs)`` per session.

    ``annotated`` comes from ``sessionize(..., measures=song_measure())``.

    duration="window": end = last event + gap, duration includes the gap.
    duration="span":   end = last event,       duration = last - first.
    Search-only sessions are kept with 0 songs.
    """
    _check_duration(duration)
    agg = annotated.groupBy(user_col, SESSION_START).agg(
        F.max(ts_col).alias("_last"), F.sum(SONG).cast("bigint").alias("songs")
    )
    end = F.col("_last") + F.lit(gap_ms) if duration == "window" else F.col("_last")
    return agg.select(
        F.col(user_col).alias("user_id"),
        F.col(SESSION_START).alias("start_ms"),
        end.alias("end_ms"),
        floor_div(end - F.col(SESSION_START), 1000).alias("duration_s"),
        F.col("songs"),
    )


def _too_heavy(events: DataFrame, bucketing: Bucketing) -> bool:
    """Whether some user has more rows than one task should sort."""
    if not bucketing.adaptive:
        return False
    placed = events.filter(F.col("user_id").isNotNull() & F.col("ts_ms").isNotNull())
    counts = placed.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return not counts.filter(F.col("n") > F.lit(bucketing.target_rows)).isEmpty()


def _light(bucketing: Bucketing) -> Bucketing | None:
    """No user is heavy: one ordered pass, without counting again."""
    return None if bucketing.adaptive else bucketing


def session_stats(
    events: DataFrame,
    gap_ms: int,
    *,
    duration: str = "window",
    merge_touching: bool = True,
    bucketing: Bucketing = ADAPTIVE,
) -> DataFrame:
    if gap_ms <= 0:
        raise ValueError("gap_ms must be positive")
    _check_duration(duration)
    if _too_heavy(events, bucketing):
        pieces = cut_pieces(events, gap_ms, {}, song_flag(), merge_touching=merge_touching, rows_a_piece=bucketing.target_rows)
        found = sessions_from_pieces(pieces, gap_ms, merge_touching=merge_touching)
        end = F.col("last_ms") + F.lit(gap_ms) if duration == "window" else F.col("last_ms")
        return found.select("user_id", "start_ms", end.alias("end_ms"), floor_div(end - F.col("start_ms"), 1000).alias("duration_s"), F.col("songs").cast("bigint").alias("songs"))
    annotated = sessionize(
        events, gap_ms, measures=song_measure(), merge_touching=merge_touching, bucketing=_light(bucketing)
    )
    return session_stats_from(annotated, gap_ms, duration=duration)


def runs_from(
    annotated: DataFrame,
    name: str,
    *,
    user_col: str = "user_id",
    ts_col: str = "ts_ms",
    aggregates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(user_id, session_start_ms, start_ms, end_ms, length_s, songs)`` per run of ``name``,
    and one column per ``aggregates`` entry (any Spark aggregate over ``annotated``)."""
    extra = dict(aggregates or {})
    agg = (
        annotated.filter(~F.col(f"{name}_delim"))
        .groupBy(user_col, f"{name}_run")
        .agg(
            F.min(SESSION_START).alias("session_start_ms"),
            F.min(ts_col).alias("start_ms"),
            F.max(ts_col).alias("end_ms"),
            F.count(F.lit(1)).alias("songs"),
            *[a.alias(f"_x_{n}") for n, a in extra.items()],
        )
    )
    return agg.select(
        F.col(user_col).alias("user_id"),
        "session_start_ms",
        "start_ms",
        "end_ms",
        floor_div(F.col("end_ms") - F.col("start_ms"), 1000).alias("length_s"),
        "songs",
        *[F.col(f"_x_{n}").alias(n) for n in extra],
    )


def split_runs(
    events: DataFrame,
    gap_ms: int,
    delimiter: Column,
    *,
    merge_touching: bool = True,
    bucketing: Bucketing = ADAPTIVE,
    figures: Figures | None = None,
    aggregates: Mapping[str, Column] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Split every session at events matching ``delimiter``; one row per non-empty run.

    What the caller wants to know of each run, beside its count and length:

    * ``figures``: name -> (kind, whole-number expression of one event), see
      ``cadence.functions.aggregates``; the stream operator takes the same;
    * ``aggregates``: name -> any Spark aggregate over ``ts_ms``, ``event_id`` and the
      ``carry`` columns of the run's events (only those columns cross the shuffle)."""
    figures = dict(figures or {})
    check_figures(figures)
    if gap_ms <= 0:
        raise ValueError("gap_ms must be positive")
    light = bucketing
    if not aggregates:
        if _too_heavy(events, bucketing):
            pieces = cut_pieces(events, gap_ms, {"split": delimiter}, F.lit(0), figures=figures, merge_touching=merge_touching, rows_a_piece=bucketing.target_rows)
            found = runs_from_pieces(pieces, "split", gap_ms, figures=figures, merge_touching=merge_touching)
            length = floor_div(F.col("last_ms") - F.col("start_ms"), 1000).alias("length_s")
            return found.select("user_id", "session_start_ms", "start_ms", F.col("last_ms").alias("end_ms"), length, "songs", *figures)
        light = _light(bucketing)
    order = F.struct("ts_ms", "event_id")
    measures = {f"_f{j}": value.cast("bigint") for j, (_, value) in enumerate(figures.values())} | {c: F.col(c) for c in carry}
    annotated = sessionize(
        events, gap_ms, delimiters={"split": delimiter}, measures=measures, merge_touching=merge_touching, bucketing=light
    )
    own = {name: over_run(kind, F.col(f"_f{j}"), order) for j, (name, (kind, _)) in enumerate(figures.items())}
    return runs_from(annotated, "split", aggregates=own | dict(aggregates or {}))


def discover_weekly_runs(events: DataFrame, gap_ms: int, *, bucketing: Bucketing = ADAPTIVE) -> DataFrame:
    """Unbroken runs of Discover-Weekly songs (broken by a search or another playlist)."""
    return split_runs(events, gap_ms, not_discover_weekly(), bucketing=bucketing)


def listening_runs(events: DataFrame, gap_ms: int, *, bucketing: Bucketing = ADAPTIVE) -> DataFrame:
    """Unbroken runs of songs until the listener searches or skips (a search event)."""
    return split_runs(events, gap_ms, is_search(), bucketing=bucketing)
