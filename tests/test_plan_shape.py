"""Physical-plan guards: the event table is scanned and shuffled once per query,
filters and column pruning reach the parquet scan."""

import pytest
from pyspark.sql import functions as F

from cadence.functions.predicates import is_search
from cadence.operators.bucketing import Bucketing
from cadence.operators.panes import early_session_panes
from cadence.operators.sessions import listening_runs, session_stats, split_runs
from cadence.sources.driver_table import load_events

SF = "/root/testdata/sf0.001"
GAP = 43_200_000


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


BUILDERS = {
    "session_stats": lambda ev, b: session_stats(ev, GAP, bucketing=b),
    "listening_runs": lambda ev, b: listening_runs(ev, GAP, bucketing=b),
    "custom_runs": lambda ev, b: split_runs(ev, GAP, F.col("device_type") == "Mobile", bucketing=b),
    "panes": lambda ev, b: early_session_panes(ev, GAP, 10_800_000, bucketing=b),
}


@pytest.mark.parametrize("name", sorted(BUILDERS))
@pytest.mark.parametrize("bucketing", [Bucketing(), Bucketing(adaptive=True, target_rows=20)], ids=["fixed", "heavy"])
def test_single_scan_and_shuffle_of_events(no_aqe, name, bucketing):
    ev = load_events(no_aqe, SF)
    plan = executed_plan(BUILDERS[name](ev, bucketing))
    if bucketing.adaptive and name != "panes":
        # Everything comes from the stored pieces; test_pieces looks at the plan that makes them.
        assert "events.parquet" not in plan and plan.count("pieces") >= 1 and "_bkt" not in plan, plan
        return
    if bucketing.adaptive:
        # Light users (single pass) come from the table; heavy users' rows (two-level)
        # from their stored ranges; the heavy keys are a joined table.
        assert plan.count("events.parquet") == 1 and "Union" in plan and "LeftAnti" in plan, plan
        assert "_bkt" in plan and "ranges" in plan
    else:
        assert plan.count("FileScan parquet") == 1, plan
    assert "ReusedExchange" in plan


def test_pushdown_and_pruning(no_aqe):
    plan = executed_plan(listening_runs(load_events(no_aqe, SF), GAP))
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(ts)]" in plan
    # value and props are never read by a listening-run query.
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_delimiter_column_is_computed_before_the_shuffle(no_aqe):
    plan = executed_plan(split_runs(load_events(no_aqe, SF), GAP, is_search()))
    # Only the boolean flag crosses the shuffle, not the columns it was computed from.
    assert "split_delim" in plan and "event_type" not in plan.split("Exchange hashpartitioning(user_id")[1].split("\n")[0]


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_single_pass_when_no_heavy_user(no_aqe, name):
    ev = load_events(no_aqe, SF)
    plan = executed_plan(BUILDERS[name](ev, Bucketing(adaptive=True)))
    assert plan.count("FileScan parquet") == 1, plan
    # One exchange of the events (on the user alone) and no carry join.
    assert plan.count("Exchange hashpartitioning(user_id#") >= 1
    assert "_bkt" not in plan and "ReusedExchange" not in plan


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def test_batch_queries_stay_in_the_jvm(no_aqe):
    from cadence.plans.queries import registry

    for name, fn in sorted(registry().items()):
        if name.startswith("stream_"):
            continue
        plan = executed_plan(fn(no_aqe, SF))
        assert not any(node in plan for node in PYTHON_NODES), name


@pytest.mark.parametrize("name", ["session_stats_window", "early_session_panes", "listening_runs"])
def test_one_shuffle_in_the_final_adaptive_plan(spark, name):
    import __spark_entry__ as entry

    spark.conf.set("spark.sql.adaptive.enabled", "true")
    df = entry.queries()[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    # Everything after the exchange on the user (windows, per-session or per-run
    # aggregates, the pane window) is already clustered by the user.
    assert final.count("Exchange hashpartitioning") == 1, final
    assert final.count("FileScan parquet") == 1
