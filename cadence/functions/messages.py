"""Text messages of the three analyses, byte-for-byte as the reference prints them.

Two families: the window dialect (session end includes the gap; instants printed)
and the span dialect (durations without the gap).  ``iso_instant`` prints an epoch
millisecond as ISO-8601 UTC with the fraction omitted when it is zero, without
depending on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: message texts (must equal the reference's output). ---
# M1 window-dialect session (a newline, then 12 spaces, inside the text):
M1 = "User: {u} session took {sec} seconds and {n} songs\n            starting at {start} and ending at {end}."
# M2 window-dialect Discover-Weekly run:
M2 = "UserId {u} listened {n} songs for {sec} seconds consecutively from Discover\nWeekly"
# M3 window-dialect listening run:
M3 = "UserId {u} listened {n} songs consecutively"
# M4 span-dialect session:
M4 = "User {u} session took {sec} seconds and {n} songs."
# M5 span-dialect Discover-Weekly run:
M5 = "UserId {u} listened {n} songs for {sec} seconds consecutively from Discover Weekly"
# M6 span-dialect listening run:
M6 = "UserId {u} listened {n} songs for {sec} seconds consecutively"
# --- end of fixed values ---

_EPOCH_NTZ = "1970-01-01 00:00:00"


def iso_instant(ms: Column) -> Column:
    """Epoch ms -> e.g. ``2024-01-01T00:00:07.179Z`` or ``2024-01-01T00:00:07Z``."""
    ntz = F.timestamp_add("MILLISECOND", ms, F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
    return F.when(
        F.pmod(ms, F.lit(1000)) == F.lit(0), F.date_format(ntz, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise(F.date_format(ntz, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def _fill(template: str, **cols: Column) -> Column:
    """Build ``template`` with ``{name}`` placeholders from string-cast columns."""
    parts: list[Column] = []
    rest = template
    while rest:
        start = rest.find("{")
        if start < 0:
            parts.append(F.lit(rest))
            break
        end = rest.index("}", start)
        if start:
            parts.append(F.lit(rest[:start]))
        parts.append(cols[rest[start + 1 : end]].cast("string"))
        rest = rest[end + 1 :]
    return F.concat(*parts)


def session_message_window(user: Column, start_ms: Column, end_ms: Column, duration_s: Column, songs: Column) -> Column:
    return _fill(M1, u=user, sec=duration_s, n=songs, start=iso_instant(start_ms), end=iso_instant(end_ms))


def discover_weekly_message_window(user: Column, length_s: Column, songs: Column) -> Column:
    return _fill(M2, u=user, n=songs, sec=length_s)


def listening_message_window(user: Column, songs: Column) -> Column:
    return _fill(M3, u=user, n=songs)


def session_message_span(user: Column, duration_s: Column, songs: Column) -> Column:
    return _fill(M4, u=user, sec=duration_s, n=songs)


def discover_weekly_message_span(user: Column, length_s: Column, songs: Column) -> Column:
    return _fill(M5, u=user, n=songs, sec=length_s)


def listening_message_span(user: Column, length_s: Column, songs: Column) -> Column:
    return _fill(M6, u=user, n=songs, sec=length_s)
