"""Event model: watermark marker, JSON round trip, bad-record matrix."""

import pytest
from events import search, song
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cadence.functions import codec
from cadence.functions.predicates import is_watermark_marker
from cadence.schema import EVENT_COLUMNS

H010101 = 3_661_000  # 1970-01-01T01:01:01Z
H010102 = 3_662_000


def test_watermark_marker(make_events):
    ev = make_events([search(H010101, 0, event_type="NextSong"), search(H010102, 1, event_type="NextSong")])
    flags = [r.m for r in ev.orderBy("event_id").select(is_watermark_marker().alias("m")).collect()]
    assert flags == [True, False]


def test_json_round_trip(make_events):
    rows = [
        song(H010102, 0, user="", playlist="DiscoverWeekly", songid=""),
        search(H010102, 1, user="", event_type="NextSong"),
    ]
    ev = make_events(rows)
    back = codec.decode(codec.encode(ev), on_error="fail").select(*EVENT_COLUMNS)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_encode_omits_song_fields_for_search(make_events):
    js = codec.encode(make_events([search(1, 0, event_type="NextSong")])).first().value
    assert js == '{"type":"SearchEvent","timestamp":1,"userId":"1","eventType":"NextSong","deviceType":"Desktop"}'


def test_reference_wire_samples_decode(spark):
    df = spark.createDataFrame(
        [
            (0, '{"type":"SongEvent","timestamp":1,"userId":"1","eventType":"EndSong","deviceType":"Desktop",'
             '"playlistType":"ChillHits","songid":"2"}'),
            (1, '{"type":"SearchEvent","timestamp":1,"userId":"1","eventType":"NextSong","deviceType":"Desktop"}'),
            (2, '{"type":"SearchEvent","timestamp":1,"userId":"1","eventType":"NextSong","deviceType":"Desktop",'
             '"playlistType":"ChillHits","songid":"9","extra":1}'),
        ],
        "event_id long, value string",
    )
    got = sorted(tuple(r) for r in codec.decode(df, on_error="fail").collect())
    assert got == [
        (0, "1", 1, "SongEvent", "EndSong", "Desktop", "ChillHits", "2"),
        (1, "1", 1, "SearchEvent", "NextSong", "Desktop", None, None),
        (2, "1", 1, "SearchEvent", "NextSong", "Desktop", None, None),
    ]


BAD = [
    ("{bad", "malformed"),
    ('{"type":"SearchEvent","timestamp":"x","userId":"u","eventType":"NextSong","deviceType":"Mobile"}', "malformed"),
    ("[1,2]", "malformed"),
    ("", "malformed"),
    ('{"type":"X"}', "unknown_type"),
    ('{"timestamp":1}', "unknown_type"),
    ('{"type":"SearchEvent","timestamp":1,"eventType":"NextSong","deviceType":"Mobile"}', "missing_field"),
    ('{"type":"SongEvent","timestamp":1,"userId":"u","eventType":"EndSong","deviceType":"Mobile","songid":"s"}', "missing_field"),
    ('{"type":"SearchEvent","timestamp":1,"userId":"u","eventType":"NextSong","deviceType":"Tablet"}', "bad_enum"),
    ('{"type":"SongEvent","timestamp":1,"userId":"u","eventType":"EndSong","deviceType":"Mobile",'
     '"playlistType":"Jazz","songid":"s"}', "bad_enum"),
]


def test_bad_record_matrix(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(BAD)], "event_id long, value string")
    flagged = codec.decode(df, on_error="flag").orderBy("event_id").select("error").collect()
    assert [r.error for r in flagged] == [reason for _, reason in BAD]
    good, bad = codec.decode(df, on_error="quarantine")
    assert good.count() == 0 and bad.count() == len(BAD)
    assert set(bad.columns) == {"event_id", "value", "error"}


def test_fail_mode_raises(spark):
    df = spark.createDataFrame([(0, "{bad")], "event_id long, value string")
    with pytest.raises(PySparkException):
        codec.decode(df, on_error="fail").collect()


def test_fail_mode_check_survives_projection(spark):
    # The validity check must not be pruned when no decoded column is used.
    df = spark.createDataFrame([(0, '{"type":"X"}')], "event_id long, value string")
    with pytest.raises(PySparkException):
        codec.decode(df, on_error="fail").select(F.lit(1)).collect()


@pytest.mark.parametrize(
    "ms",
    [0, 1, 999, 1_000, 1_704_067_207_179, 1_709_164_800_000, 1_735_689_599_999, -1, -1_000, 951_782_400_123],
)
def test_iso_instant_matches_python(spark, ms):
    import datetime as dt

    from cadence.functions.messages import iso_instant

    got = spark.createDataFrame([(ms,)], "ms long").select(iso_instant(F.col("ms")).alias("s")).first().s
    t = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(milliseconds=ms)
    frac = "" if ms % 1000 == 0 else f".{ms % 1000:03d}"
    assert got == t.strftime("%Y-%m-%dT%H:%M:%S") + frac + "Z"


SONG = '{"type":"SongEvent","timestamp":%s,"userId":%s,"eventType":"EndSong","deviceType":"Mobile","playlistType":"DailyMix","songid":%s}'


def test_json_types_are_checked(spark):
    cases = [
        (SONG % ("7", '"u"', '"s"'), None, 7), (SONG % ("7", "5", '"s"'), "malformed", None), (SONG % ("7", "true", '"s"'), "malformed", None),
        (SONG % ("7", '{"a":1}', '"s"'), "malformed", None), (SONG % ("7", "[]", '"s"'), "malformed", None), (SONG % ("7", "null", '"s"'), "missing_field", None),
        (SONG % ("7", '"u"', "5"), "malformed", None), (SONG % ("7", '"u"', "false"), "malformed", None), (SONG % ("7", '"u"', '{"a":1}'), "malformed", None),
        (SONG % ("1.5", '"u"', '"s"'), None, 1), (SONG % ("-1.5", '"u"', '"s"'), None, -1), (SONG % ("1e3", '"u"', '"s"'), None, 1000),
        (SONG % ('"7"', '"u"', '"s"'), "malformed", None), (SONG % ("true", '"u"', '"s"'), "malformed", None), (SONG % ("1e19", '"u"', '"s"'), "malformed", None),
        ((SONG % ("7", '"u"', "5")).replace("SongEvent", "SearchEvent"), None, 7),  # a search has no song fields
    ]
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(cases)], "event_id long, value string")
    got = codec.decode(df, on_error="flag").orderBy("event_id").collect()
    assert [(r.error, r.ts_ms if r.error is None else None) for r in got] == [(e, t) for _, e, t in cases]
