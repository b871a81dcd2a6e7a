"""DuckDB SQL equivalents of the driver queries (the correctness oracle).

Written independently of the Spark plans: the classic single-window formulation
(``lag`` + running sums over all of a user's rows), which is simple to read and
needs no bucketing.  Tables are the driver's parquet views.
"""

from __future__ import annotations

from cadence.plans.queries import DRIVER_GAP_MS, DRIVER_INTERVAL_MS, LATE_GAP_MS, MERGE_GAP_MS

# The driver-table adapter in SQL (see cadence.sources.driver_table).
EV = """
ev AS (
  SELECT
    event_id,
    CAST(user_id AS VARCHAR) AS user_id,
    epoch_us(ts) // 1000 AS ts_ms,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'SongEvent' ELSE 'SearchEvent' END AS type,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'EndSong'
         WHEN event_type = 'signup' THEN 'NextSong' ELSE 'SearchSong' END AS event_type,
    CASE WHEN event_id % 5 < 2 THEN 'Desktop' ELSE 'Mobile' END AS device_type,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN
      CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 70 THEN 'DiscoverWeekly'
           WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 90 THEN 'DailyMix'
           ELSE 'ChillHits' END
    END AS playlist_type,
    CASE WHEN event_type IN ('click', 'view', 'purchase')
         THEN 'song-' || CAST(event_id % 20 AS VARCHAR) END AS songid,
    epoch_us(ts) // 1000 + (event_id * 7919) % 7200001 - 3600000 AS arrival_ms
  FROM events
)"""

EV_COLS = "event_id, user_id, ts_ms, type, event_type, device_type, playlist_type, songid"


def _sessions_cte(src: str, gap_ms: int, op: str = ">") -> str:
    """Adds d (gap to previous event) and sid (session number) per user."""
    return f"""
l AS (
  SELECT *, ts_ms - lag(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS d FROM {src}
),
s AS (
  SELECT *, sum(CASE WHEN d IS NULL OR d {op} {gap_ms} THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM l
)"""


def _session_stats_sql(src_cte: str, gap_ms: int, op: str, duration: str) -> str:
    end = f"max(ts_ms) + {gap_ms}" if duration == "window" else "max(ts_ms)"
    return f"""
WITH {src_cte}, {_sessions_cte('src', gap_ms, op)}
SELECT user_id,
       CAST(min(ts_ms) AS BIGINT) AS start_ms,
       CAST({end} AS BIGINT) AS end_ms,
       CAST(({end} - min(ts_ms)) // 1000 AS BIGINT) AS duration_s,
       CAST(sum(CASE WHEN type = 'SongEvent' THEN 1 ELSE 0 END) AS BIGINT) AS songs
FROM s GROUP BY user_id, sid
"""


def _runs_sql(delim: str, gap_ms: int, extra: str = "") -> str:
    return f"""
WITH {EV}, src AS (SELECT *, ({delim}) AS is_delim FROM ev), {_sessions_cte('src', gap_ms)},
r AS (
  SELECT *,
    min(ts_ms) OVER (PARTITION BY user_id, sid) AS session_start_ms,
    sum(CASE WHEN is_delim THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id, sid ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS iid
  FROM s
)
SELECT user_id,
       CAST(min(session_start_ms) AS BIGINT) AS session_start_ms,
       CAST(min(ts_ms) AS BIGINT) AS start_ms,
       CAST(max(ts_ms) AS BIGINT) AS end_ms,
       CAST((max(ts_ms) - min(ts_ms)) // 1000 AS BIGINT) AS length_s,
       CAST(count(*) AS BIGINT) AS songs{extra}
FROM r WHERE NOT is_delim
GROUP BY user_id, sid, iid
"""


_SONG_NUMBER = "CAST(split_part(songid, '-', 2) AS BIGINT)"
RUN_FIGURES = f""",
       CAST(count(*) FILTER (WHERE device_type = 'Mobile') AS BIGINT) AS mobile_songs,
       min({_SONG_NUMBER}) AS lowest_song, max({_SONG_NUMBER}) AS highest_song,
       (list({_SONG_NUMBER} ORDER BY ts_ms, event_id))[1] AS first_song,
       (list(CASE WHEN playlist_type = 'DailyMix' THEN {_SONG_NUMBER} END ORDER BY ts_ms, event_id))[-1] AS last_daily_mix"""
RUN_AGGREGATES = ", count(DISTINCT songid) AS different_songs, count(DISTINCT playlist_type) AS playlists"

HOUR_FLOORED = f"""{EV}, src AS (
  SELECT * REPLACE (ts_ms - ts_ms % 3600000 AS ts_ms) FROM ev
)"""

NOT_DW = "type = 'SearchEvent' OR (type = 'SongEvent' AND coalesce(playlist_type <> 'DiscoverWeekly', true))"


def _panes_sql(gap_ms: int, interval_ms: int) -> str:
    # Theta join: every pane counts the session's songs with ts <= pane.
    return f"""
WITH {EV}, src AS (SELECT * FROM ev), {_sessions_cte('src', gap_ms)},
sess AS (
  SELECT user_id, sid, min(ts_ms) AS start_ms, max(ts_ms) AS last_ms,
         min(ts_ms) - min(ts_ms) % {interval_ms} + {interval_ms} AS f
  FROM s GROUP BY user_id, sid
),
spine AS (
  SELECT user_id, sid, start_ms, last_ms,
         unnest(list_distinct(list_concat(
           CASE WHEN f <= last_ms + {gap_ms} - 1 THEN range(f, last_ms + {gap_ms}, {interval_ms}) ELSE [] END,
           [last_ms + {gap_ms} - 1]))) AS pane_ms
  FROM sess
)
SELECT sp.user_id,
       CAST(sp.start_ms AS BIGINT) AS start_ms,
       CAST(max(e.ts_ms) + {gap_ms} AS BIGINT) AS end_ms,
       CAST(sp.pane_ms AS BIGINT) AS pane_ms,
       CAST(sum(CASE WHEN e.type = 'SongEvent' THEN 1 ELSE 0 END) AS BIGINT) AS songs,
       sp.pane_ms = sp.last_ms + {gap_ms} - 1 AS is_final
FROM spine sp JOIN s e ON e.user_id = sp.user_id AND e.sid = sp.sid AND e.ts_ms <= sp.pane_ms
GROUP BY sp.user_id, sp.sid, sp.start_ms, sp.last_ms, sp.pane_ms
"""


def _stream_panes_sql(gap_ms: int, interval_ms: int, n: int = 5) -> str:
    """Panes of a stream fed ``n`` equal ranges of event time, one batch each: after a batch
    whose latest event is at ``hi``, every fire time up to ``hi`` that was not yet reached
    fires with everything received so far; the rest fire at the end."""
    return f"""
WITH {EV}, src AS (SELECT * FROM ev), {_sessions_cte('src', gap_ms)},
lim AS (SELECT min(ts_ms) AS lo, max(ts_ms) AS top FROM ev),
e AS (
  SELECT user_id, sid, ts_ms, type, least((ts_ms - lo) * {n} // (top - lo + 1), {n} - 1) AS r FROM s, lim
),
m AS (SELECT r, max(ts_ms) AS hi FROM e GROUP BY r),
step AS (
  SELECT r, coalesce(lag(hi) OVER (ORDER BY r), -1) AS lo, hi FROM m
  UNION ALL SELECT {n}, max(hi), 9000000000000000000 FROM m
),
k AS (
  SELECT e.user_id, e.sid, step.r, step.lo, step.hi, min(e.ts_ms) AS start_ms, max(e.ts_ms) AS last_ms,
         sum(CASE WHEN e.type = 'SongEvent' THEN 1 ELSE 0 END) AS songs
  FROM e JOIN step ON e.r <= step.r
  GROUP BY e.user_id, e.sid, step.r, step.lo, step.hi
),
p AS (
  SELECT *, unnest(list_concat(
    list_transform(list_filter(range(start_ms - start_ms % {interval_ms} + {interval_ms}, last_ms + {gap_ms} - 1, {interval_ms}),
                               lambda b: b > lo AND b <= hi), lambda b: {{'b': b, 'f': false}}),
    CASE WHEN last_ms + {gap_ms} - 1 > lo AND last_ms + {gap_ms} - 1 <= hi
         THEN [{{'b': last_ms + {gap_ms} - 1, 'f': true}}] ELSE [] END)) AS fire
  FROM k
)
SELECT user_id, CAST(start_ms AS BIGINT) AS start_ms, CAST(last_ms + {gap_ms} AS BIGINT) AS end_ms,
       CAST(fire.b AS BIGINT) AS pane_ms, CAST(songs AS BIGINT) AS songs, fire.f AS is_final
FROM p
"""


MARKER = "((ts_ms // 1000) % 60) < 2"


def _watermark_sql(marker: str) -> str:
    return f"""
WITH {EV}
SELECT event_id, arrival_ms, ts_ms,
       CASE WHEN arrival_ms IS NOT NULL THEN max(CASE WHEN ({marker}) AND arrival_ms IS NOT NULL THEN ts_ms END)
         OVER (ORDER BY arrival_ms NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) END AS watermark_ms
FROM ev
"""


def _late_sql(marker: str, gap_ms: int) -> str:
    return f"""
WITH {EV},
w AS (
  SELECT *, max(CASE WHEN {marker} THEN ts_ms END)
    OVER (ORDER BY arrival_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark_ms
  FROM ev
)
SELECT event_id, user_id, ts_ms, arrival_ms, watermark_ms
FROM w WHERE watermark_ms IS NOT NULL AND ts_ms + {gap_ms} - 1 <= watermark_ms
"""


def _replay_ctes(gap_ms: int, interval_ms: int, marker: str) -> str:
    """The job's own reading of the arrival order, one event a step (recursive): each user's live
    windows, what fires as the watermark rises (``fired``) and whether an event is dropped.  A last
    step with an endless watermark closes everything."""
    top = 4_000_000_000_000_000_000
    touch = f"x.s <= n.ts_ms + {gap_ms} AND x.e >= n.ts_ms"
    return f"""
{EV},
w AS (
  SELECT *, coalesce(max(CASE WHEN {marker} THEN ts_ms END)
    OVER (ORDER BY arrival_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS wm
  FROM ev
),
step AS (
  SELECT user_id, event_id, ts_ms, arrival_ms, wm, CASE WHEN type = 'SongEvent' THEN 1 ELSE 0 END AS song,
         row_number() OVER (PARTITION BY user_id ORDER BY arrival_ms, event_id) AS k
  FROM w
  UNION ALL SELECT user_id, NULL, NULL, NULL, {top}, 0, count(*) + 1 FROM w GROUP BY user_id
),
go AS (
  SELECT DISTINCT user_id, 0::BIGINT AS k, -1::BIGINT AS wm,
         CAST([] AS STRUCT(s BIGINT, e BIGINT, n BIGINT, f BIGINT)[]) AS live,
         CAST([] AS STRUCT(s BIGINT, e BIGINT, n BIGINT, b BIGINT, fin BOOLEAN)[]) AS fired, false AS dropped
  FROM ev
),
r AS (
  SELECT * FROM go
  UNION ALL
  SELECT user_id, k, wm,
         CASE WHEN ts_ms IS NULL OR dropped THEN held
              ELSE list_append(list_filter(held, lambda x: NOT (x.s <= ts_ms + {gap_ms} AND x.e >= ts_ms)), {{
                's': coalesce(least(ts_ms, list_min(list_transform(near, lambda x: x.s))), ts_ms),
                'e': coalesce(greatest(ts_ms + {gap_ms}, list_max(list_transform(near, lambda x: x.e))), ts_ms + {gap_ms}),
                'n': song + coalesce(list_sum(list_transform(near, lambda x: x.n)), 0)::BIGINT,
                'f': coalesce(list_min(list_transform(near, lambda x: x.f)), ts_ms - ts_ms % {interval_ms} + {interval_ms})}}) END,
         fired, dropped
  FROM (
    SELECT *, ts_ms IS NOT NULL AND len(near) = 0 AND ts_ms + {gap_ms} - 1 <= wm AS dropped
    FROM (
      SELECT n.user_id, n.k, n.wm, n.ts_ms, n.song, o.held, o.fired,
             CASE WHEN n.ts_ms IS NULL THEN o.held ELSE list_filter(o.held, lambda x: {touch}) END AS near
      FROM step n JOIN (
        SELECT p.user_id, p.k,
               CASE WHEN m.wm > p.wm THEN list_transform(list_filter(p.live, lambda x: x.e - 1 > m.wm),
                 lambda x: {{'s': x.s, 'e': x.e, 'n': x.n,
                   'f': CASE WHEN x.f <= m.wm THEN x.f + ((m.wm - x.f) // {interval_ms} + 1) * {interval_ms} ELSE x.f END}})
               ELSE p.live END AS held,
               CASE WHEN m.wm > p.wm THEN flatten(list_transform(p.live, lambda x: list_concat(
                 list_transform(range(x.f, least(m.wm + 1, x.e - 1), {interval_ms}),
                   lambda b: {{'s': x.s, 'e': x.e, 'n': x.n, 'b': b, 'fin': false}}),
                 CASE WHEN x.e - 1 <= m.wm THEN [{{'s': x.s, 'e': x.e, 'n': x.n, 'b': x.e - 1, 'fin': true}}] ELSE [] END)))
               ELSE [] END AS fired
        FROM r p JOIN step m ON m.user_id = p.user_id AND m.k = p.k + 1
      ) o ON o.user_id = n.user_id AND n.k = o.k + 1
    )
  )
)"""


def _watermark_panes_sql(gap_ms: int, interval_ms: int, marker: str) -> str:
    return f"""
WITH RECURSIVE {_replay_ctes(gap_ms, interval_ms, marker)},
p AS (SELECT user_id, unnest(fired) AS x FROM r)
SELECT user_id, CAST(x.s AS BIGINT) AS start_ms, CAST(x.e AS BIGINT) AS end_ms, CAST(x.b AS BIGINT) AS pane_ms,
       CAST(x.n AS BIGINT) AS songs, x.fin AS is_final
FROM p
"""


def _arrival_sessions_sql(gap_ms: int, marker: str) -> str:
    return f"""
SELECT user_id, start_ms, end_ms, CAST((end_ms - start_ms) // 1000 AS BIGINT) AS duration_s, songs
FROM ({_watermark_panes_sql(gap_ms, gap_ms, marker)}) WHERE is_final
"""


def _lateness_rules_sql(gap_ms: int, marker: str) -> str:
    return f"""
WITH RECURSIVE {_replay_ctes(gap_ms, gap_ms, marker)}
SELECT step.event_id, step.user_id, step.ts_ms, step.arrival_ms, step.wm AS watermark_ms, r.dropped AS is_dropped
FROM step JOIN r USING (user_id, k)
WHERE step.ts_ms IS NOT NULL AND step.wm >= 0 AND step.ts_ms + {gap_ms} - 1 <= step.wm
"""


def _iso(ms: str) -> str:
    return (
        f"(strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {ms} % 1000 = 0 THEN '' "
        f"ELSE '.' || lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0') END || 'Z')"
    )


def _message_sql(inner: str, expr: str) -> str:
    return f"SELECT user_id, {expr} AS message FROM ({inner})"


def _draw(slot: int) -> str:
    digest = f"md5(CAST(event_id AS VARCHAR) || '#{slot // 4}')"
    return f"(CAST(CAST(('0x' || substr({digest}, {1 + 8 * (slot % 4)}, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0)"


def _uuid(kind: str, idx: str) -> str:
    h = f"md5('{kind}-' || CAST(CAST(floor({idx}) AS BIGINT) AS VARCHAR))"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' "
        f"|| substr({h}, 17, 4) || '-' || substr({h}, 21, 12))"
    )


GENERATE_SQL = f"""
WITH d AS (
  SELECT event_id, {_draw(0)} AS c, {_draw(1)} AS dv, {_draw(2)} AS u, {_draw(3)} AS p, {_draw(4)} AS sg
  FROM events
),
g AS (
  SELECT event_id, c > 0.3 AS song,
         CASE WHEN c > 0.3 THEN 'SongEvent' ELSE 'SearchEvent' END AS type,
         1704067200000 + (event_id * 1000) // 2 AS ts_ms,
         {_uuid('user', 'u * 30')} AS user_id,
         CASE WHEN c > 0.3 THEN 'EndSong' WHEN c > 0.1 THEN 'NextSong' ELSE 'SearchSong' END AS event_type,
         CASE WHEN dv > 0.6 THEN 'Desktop' ELSE 'Mobile' END AS device_type,
         CASE WHEN p > 0.3 THEN 'DiscoverWeekly' WHEN p > 0.1 THEN 'DailyMix' ELSE 'ChillHits' END AS playlist_type,
         {_uuid('song', 'sg * 20')} AS songid
  FROM d
)
SELECT event_id,
       '{{"type":"' || type || '","timestamp":' || CAST(ts_ms AS VARCHAR) || ',"userId":"' || user_id
       || '","eventType":"' || event_type || '","deviceType":"' || device_type || '"'
       || CASE WHEN song THEN ',"playlistType":"' || playlist_type || '","songid":"' || songid || '"' ELSE '' END
       || '}}' AS value
FROM g
"""


QUARANTINE_SQL = f"""
WITH {EV},
d AS (
  SELECT event_id, ts_ms,
         CASE WHEN event_id % 97 IN (0, 1, 5, 6, 7, 10, 13, 14) THEN 'malformed' WHEN event_id % 97 = 2 THEN 'unknown_type'
              WHEN event_id % 97 = 3 THEN 'bad_enum' WHEN event_id % 97 = 4 THEN 'missing_field'
              WHEN event_id % 97 IN (8, 9) AND type = 'SongEvent' THEN 'malformed' END AS error
  FROM ev
)
SELECT event_id, error IS NULL AS is_valid, error, CASE WHEN error IS NULL THEN ts_ms END AS ts_ms FROM d
"""


def oracles_base() -> dict[str, str]:
    return {
        "session_stats_window": _session_stats_sql(f"{EV}, src AS (SELECT * FROM ev)", DRIVER_GAP_MS, ">", "window"),
        "session_stats_span": _session_stats_sql(f"{EV}, src AS (SELECT * FROM ev)", DRIVER_GAP_MS, ">", "span"),
        "discover_weekly_runs": _runs_sql(NOT_DW, DRIVER_GAP_MS),
        "listening_runs": _runs_sql("type = 'SearchEvent'", DRIVER_GAP_MS),
    }


def oracles() -> dict[str, str]:
    return {
        "normalize_events": f"""
WITH {EV}
SELECT {EV_COLS},
       CAST(CASE WHEN type = 'SongEvent' THEN 1 ELSE 0 END AS BIGINT) AS is_song,
       ((ts_ms // 1000) % 60) < 2 AS is_watermark
FROM ev
""",
        "session_stats_window": _session_stats_sql(f"{EV}, src AS (SELECT * FROM ev)", DRIVER_GAP_MS, ">", "window"),
        "session_stats_span": _session_stats_sql(f"{EV}, src AS (SELECT * FROM ev)", DRIVER_GAP_MS, ">", "span"),
        "session_stats_strict_gap": _session_stats_sql(HOUR_FLOORED, DRIVER_GAP_MS, ">=", "window"),
        "session_stats_touching_gap": _session_stats_sql(HOUR_FLOORED, DRIVER_GAP_MS, ">", "window"),
        "discover_weekly_runs": _runs_sql(NOT_DW, DRIVER_GAP_MS),
        "listening_runs": _runs_sql("type = 'SearchEvent'", DRIVER_GAP_MS),
        "split_runs_custom": _runs_sql("device_type = 'Mobile'", DRIVER_GAP_MS),
        "run_figures": _runs_sql("type = 'SearchEvent'", DRIVER_GAP_MS, RUN_FIGURES),
        "run_figures_heavy_plan": _runs_sql("type = 'SearchEvent'", DRIVER_GAP_MS, RUN_FIGURES),
        "run_aggregates": _runs_sql("type = 'SearchEvent'", DRIVER_GAP_MS, RUN_AGGREGATES),
        "stream_run_figures": _runs_sql("type = 'SearchEvent'", DRIVER_GAP_MS, RUN_FIGURES),
        "json_roundtrip": f"WITH {EV} SELECT {EV_COLS} FROM ev",
        "encode_events": f"""
WITH {EV}
SELECT event_id,
       '{{"type":"' || type || '","timestamp":' || CAST(ts_ms AS VARCHAR) || ',"userId":"' || user_id
       || '","eventType":"' || event_type || '","deviceType":"' || device_type || '"'
       || CASE WHEN type = 'SongEvent' THEN ',"playlistType":"' || playlist_type || '","songid":"' || songid || '"' ELSE '' END
       || '}}' AS value
FROM ev
""",
        "quarantine_bad_events": QUARANTINE_SQL,
        "stream_quarantine": QUARANTINE_SQL,
        "early_session_panes": _panes_sql(DRIVER_GAP_MS, DRIVER_INTERVAL_MS),
        "punctuated_watermark": _watermark_sql(MARKER),
        "max_watermark": _watermark_sql("true"),
        "late_events_punctuated": _late_sql(MARKER, LATE_GAP_MS),
        "late_events_max": _late_sql("true", LATE_GAP_MS),
        "watermark_panes": _watermark_panes_sql(DRIVER_GAP_MS, DRIVER_INTERVAL_MS, MARKER),
        "watermark_panes_max": _watermark_panes_sql(MERGE_GAP_MS, MERGE_GAP_MS // 4, "true"),
        "arrival_sessions": _arrival_sessions_sql(MERGE_GAP_MS, MARKER),
        "lateness_rules_punctuated": _lateness_rules_sql(MERGE_GAP_MS, MARKER),
        "lateness_rules_max": _lateness_rules_sql(MERGE_GAP_MS, "true"),
        "messages_m1": _message_sql(
            oracles_base()["session_stats_window"],
            "'User: ' || user_id || ' session took ' || duration_s || ' seconds and ' || songs || ' songs' || chr(10) "
            f"|| '            starting at ' || {_iso('start_ms')} || ' and ending at ' || {_iso('end_ms')} || '.'",
        ),
        "messages_m2": _message_sql(
            oracles_base()["discover_weekly_runs"],
            "'UserId ' || user_id || ' listened ' || songs || ' songs for ' || length_s "
            "|| ' seconds consecutively from Discover' || chr(10) || 'Weekly'",
        ),
        "messages_m3": _message_sql(
            oracles_base()["listening_runs"], "'UserId ' || user_id || ' listened ' || songs || ' songs consecutively'"
        ),
        "messages_m4": _message_sql(
            oracles_base()["session_stats_span"],
            "'User ' || user_id || ' session took ' || duration_s || ' seconds and ' || songs || ' songs.'",
        ),
        "messages_m5": _message_sql(
            oracles_base()["discover_weekly_runs"],
            "'UserId ' || user_id || ' listened ' || songs || ' songs for ' || length_s "
            "|| ' seconds consecutively from Discover Weekly'",
        ),
        "messages_m6": _message_sql(
            oracles_base()["listening_runs"],
            "'UserId ' || user_id || ' listened ' || songs || ' songs for ' || length_s || ' seconds consecutively'",
        ),
        "generate_events": GENERATE_SQL,
        # The heavy-user plan computes the same results: same SQL.
        "session_stats_window_heavy_plan": oracles_base()["session_stats_window"],
        "listening_runs_heavy_plan": oracles_base()["listening_runs"],
        "early_session_panes_heavy_plan": _panes_sql(DRIVER_GAP_MS, DRIVER_INTERVAL_MS),
        # Streams replay the same events: the batch SQL is their oracle.
        "stream_session_stats": oracles_base()["session_stats_window"],
        "stream_discover_weekly_runs": oracles_base()["discover_weekly_runs"],
        "stream_listening_runs": oracles_base()["listening_runs"],
        "stream_early_panes_final": oracles_base()["session_stats_window"],
        "stream_early_panes": _stream_panes_sql(DRIVER_GAP_MS, DRIVER_INTERVAL_MS),
        "stream_jittered_sessions": oracles_base()["session_stats_window"],
        "stream_jittered_listening_runs": oracles_base()["listening_runs"],
        "stream_sliced_listening_runs": oracles_base()["listening_runs"],
        "stream_late_events_punctuated": _late_sql(MARKER, LATE_GAP_MS),
        "stream_late_events_max": _late_sql("true", LATE_GAP_MS),
        "stream_incremental_sessions": oracles_base()["session_stats_window"],
        "stream_incremental_listening_runs": oracles_base()["listening_runs"],
        "stream_incremental_discover_weekly_runs": oracles_base()["discover_weekly_runs"],
    }


__all__ = ["oracles", "EV", "EV_COLS", "DRIVER_GAP_MS", "DRIVER_INTERVAL_MS", "LATE_GAP_MS"]
