"""The driver contract at sf0.001: every registered query equals its DuckDB oracle."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cadence.plans.oracle import oracles
from cadence.plans.queries import registry

SF = "/root/testdata/sf0.001"
TABLES = ["events"]


def _hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    lines = sorted("|".join(repr(r[k]) for k in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("driver test data not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark, con):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "start_ms", "end_ms", "duration_s", "songs"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracles())
    assert set(registry()) <= set(entry.queries()) and set(oracles()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _hash(rows, df.columns) == _hash(orows, ocols)


@pytest.mark.parametrize("name", ["normalize_events", "messages_m1", "punctuated_watermark", "generate_events"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = entry.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _hash(rows, df.columns) == _hash(res.fetchall(), ocols)


def test_epoch_ms_is_zone_free_across_dst(spark):
    from pyspark.sql import functions as F

    from cadence.sources.driver_table import epoch_ms

    df = spark.createDataFrame([("2024-07-01 12:34:56.789123",), ("1969-12-31 23:59:59.999999",)], "s string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = [r.ms for r in df.select(epoch_ms(F.col("s").cast("timestamp_ntz")).alias("ms")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1719837296789, -1]
