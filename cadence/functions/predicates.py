"""Column predicates and projections over normalized events.

Every predicate tests the record class (``type``), never ``event_type``: a song is
``type = 'SongEvent'``, a search is ``type = 'SearchEvent'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadence.schema import DISCOVER_WEEKLY, SEARCH_EVENT, SONG_EVENT


def is_song(type_col: str = "type") -> Column:
    return F.col(type_col) == F.lit(SONG_EVENT)


def is_search(type_col: str = "type") -> Column:
    """Delimiter of listening runs: any search event."""
    return F.col(type_col) == F.lit(SEARCH_EVENT)


def song_flag(type_col: str = "type") -> Column:
    """1 for a song, 0 for a search (the session-stats projection)."""
    return F.when(is_song(type_col), F.lit(1)).otherwise(F.lit(0))


def not_discover_weekly(type_col: str = "type", playlist_col: str = "playlist_type") -> Column:
    """Delimiter of Discover-Weekly runs: a search, or a song from another playlist."""
    return is_search(type_col) | (
        is_song(type_col) & ~F.coalesce(F.col(playlist_col) == F.lit(DISCOVER_WEEKLY), F.lit(False))
    )


def floor_div(x: Column, n: int) -> Column:
    """Integer floor division (exact for negatives too, no floating point)."""
    return F.call_function("div", x - F.pmod(x, F.lit(n)), F.lit(n))


def second_of_minute(ts_ms_col: str = "ts_ms") -> Column:
    """Second-of-minute of an epoch-ms instant; zone-free for whole-minute zone offsets."""
    return F.pmod(floor_div(F.col(ts_ms_col), 1000), F.lit(60))


def is_watermark_marker(ts_ms_col: str = "ts_ms") -> Column:
    """An event whose second-of-minute is below 2 carries a watermark."""
    return second_of_minute(ts_ms_col) < F.lit(2)


def seconds_floor(ms: Column) -> Column:
    """Whole seconds of a millisecond duration, floored."""
    return floor_div(ms, 1000)
