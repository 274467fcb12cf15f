"""Every query against its SQL, on the smallest tables; the flagship query and the plans."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import rows_of

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, db, name):
    df = QUERIES[name](spark, small)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(ORACLES[name])
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want and (got[1] or name == "complete_rows")


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 5 and all(r.rmse > 0 for r in rows)


def final_plan(df):
    """Names of the nodes of the plan that ran, each with the names below it."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        below = [walk(node.children().apply(i)) for i in range(node.children().size())]
        return name, node.simpleString(1000), below

    return walk(df._jdf.queryExecution().executedPlan())


def nodes(tree):
    yield tree
    for child in tree[2]:
        yield from nodes(child)


def window_inputs(tree):
    """What deals out the rows of each window: the nearest exchange or scan below it."""
    for node in nodes(tree):
        if node[0].startswith("Window"):
            below = node
            while below[2] and "Exchange" not in below[0]:
                below = below[2][0]
            yield below[1]


# a table without series has one row per calendar day; its forward fill looks back without bound, in one task
CALENDAR_IN_ONE_TASK = {"temperature_lags", "day_ahead_features", "bridge_days"}


@pytest.mark.parametrize("name", ["origin_lags_by_user", "day_ahead_features", "multi_horizon_forecast", "backtest_forecast",
                                  "positional_zip", "halfhour_to_hour", "temperature_lags", "bridge_days", "load_lags_by_user",
                                  "backtest_gaps", "savgol_smooth"])
def test_plans_have_no_cross_join_python_or_single_partition_window(spark, small, name):
    tree = final_plan(QUERIES[name](spark, small))
    for node in nodes(tree):
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "InPandas"):
            assert bad not in node[0]
    inputs = list(window_inputs(tree))
    assert inputs
    if name not in CALENDAR_IN_ONE_TASK:
        assert not [x for x in inputs if "SinglePartition" in x]


def test_hourly_lags_run_over_days(spark, small):
    tree = final_plan(QUERIES["load_lags_by_user"](spark, small))
    windows = [n for n in nodes(tree) if n[0].startswith("Window")]
    assert windows and not [n for n in windows if "hour" in n[1].split("windowspecdefinition")[-1]]


@pytest.mark.parametrize("name, most", [("hourly_grid_fill", 1), ("origin_lags_by_user", 1), ("day_ahead_features", 2),
                                        ("load_lags_by_user", 1), ("multi_horizon_forecast", 2)])
def test_readings_are_scanned_once_per_use(spark, small, name, most):
    """Scans of events that ran in the main plan: loads, and temperatures where they are used, not once per window."""
    tree = final_plan(QUERIES[name](spark, small))
    scans = [n for n in nodes(tree) if n[0].startswith("Scan parquet")]
    assert 1 <= len(scans) <= most, [n[1][:80] for n in scans]


@pytest.mark.parametrize("name", ["day_ahead_kpi", "multi_horizon_forecast", "weekly_backtest", "backtest_kpi", "climate_part"])
def test_forecasts_read_the_readings_once(spark, small, name):
    tree = final_plan(QUERIES[name](spark, small))
    assert [n for n in nodes(tree) if n[0].startswith("ReusedExchange")]
