import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.functions.clock import hour_number
from gridcast.operators.lags import add_lags
from gridcast.operators.origins import LOAD_LAGS, add_origin_lags, spread_horizons
from gridcast.operators.profiles import day_before, day_profiles, explode_hours, fill_days, hourly_grid, hours_before, lag_days
from gridcast.operators.smooth import savgol_weights, smooth_savgol
from gridcast.plans.features import hourly_features


def ramp(spark, days=30, series=("a",), start="2024-01-01", value="n"):
    """Gap-free profiles whose load is the number of hours since the start."""
    d0 = dt.date.fromisoformat(start)
    rows = [
        (s, d0 + dt.timedelta(days=i), [float(24 * i + h) if value == "n" else None for h in range(24)])
        for s in series for i in range(days)
    ]
    return spark.createDataFrame(rows, "series_id string, date date, load array<double>")


def noisy_panel(spark, hours=2000, series=("a", "b"), seed=5):
    rng = random.Random(seed)
    d0 = dt.date(2023, 1, 1)
    rows = [(s, d0 + dt.timedelta(days=i // 24), i % 24, rng.random() * 100) for s in series for i in range(hours)]
    return spark.createDataFrame(rows, "series_id string, date date, hour int, load double")


def test_grid_fills_gaps_in_every_way(spark):
    rows = [("a", dt.date(2024, 1, 1), 5, 2.0), ("a", dt.date(2024, 1, 1), 5, 3.0), ("a", dt.date(2024, 1, 4), 1, 7.0)]
    df = spark.createDataFrame(rows, "series_id string, date date, hour int, v double")
    end = F.lit("2024-01-05").cast("date")

    def load(fill):
        out = hourly_grid(df, ["series_id"], F.col("v"), fill=fill, end=end).orderBy("date", "hour").collect()
        assert len(out) == 5 * 24
        return [r.load for r in out]

    zero, null, forward = load("zero"), load("null"), load("ffill")
    assert zero[5] == 5.0 and zero[73] == 7.0 and sum(zero) == 12.0
    assert null[4] is None and null[5] == 5.0 and null[6] is None
    assert forward[:5] == [None] * 5 and set(forward[5:73]) == {5.0} and set(forward[73:]) == {7.0}


def test_grid_keeps_given_bounds(spark):
    days = ramp(spark, 3, start="2024-01-10")
    out = fill_days(days, ["series_id"], start=F.lit("2024-01-08").cast("date"), end=F.lit("2024-01-11").cast("date"))
    assert [str(r.date) for r in out.orderBy("date").collect()] == [f"2024-01-{d:02d}" for d in range(8, 13)]


@pytest.mark.parametrize("how,want", [("sum", 9.0), ("avg", 3.0), ("max", 4.0), ("min", 2.0)])
def test_profile_aggregates(spark, how, want):
    rows = [("a", dt.date(2024, 1, 1), 5, v) for v in (2.0, 3.0, 4.0)] + [(None, dt.date(2024, 1, 1), 5, 1.0)]
    df = spark.createDataFrame(rows, "series_id string, date date, hour int, v double")
    got = day_profiles(df, ["series_id"], {"load": F.col("v")}, how=how).collect()
    assert len(got) == 1 and got[0].load[5] == want and got[0].load[6] is None


@pytest.mark.parametrize("width", [24, 100, 5000])
def test_halo_windows_equal_plain_windows(spark, width):
    panel = noisy_panel(spark)
    got = add_lags(panel, ["series_id"], ["load"], [1, 17, 23], width=width)
    w = Window.partitionBy("series_id").orderBy("date", "hour")
    want = panel.select("*", *[F.lag("load", k).over(w).alias(f"load_lag{k}") for k in (1, 17, 23)])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_halo_windows_split_a_single_series(spark):
    plan = add_lags(noisy_panel(spark), [], ["load"], [3], width=200)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_origin_lags_by_formula(spark):
    out = explode_hours(add_origin_lags(ramp(spark), ["series_id"])).filter("date = '2024-01-25'").collect()
    assert len(out) == 24
    t0 = 24.0 * 24
    for r in out:
        for i in LOAD_LAGS:
            assert r[f"lag{i}"] == t0 - 15 - i
        assert (r.min_24h, r.max_24h, r.mean_24h) == (t0 - 38, t0 - 15, t0 - 26.5)
        assert (r.min_48h, r.max_48h, r.mean_48h) == (t0 - 62, t0 - 15, t0 - 38.5)


def test_origin_lags_equal_the_literal_shift(spark):
    panel = noisy_panel(spark, hours=24 * 20)
    days = day_profiles(panel, ["series_id"], {"load": F.col("load")})
    got = explode_hours(add_origin_lags(days, ["series_id"], lags=(0, 5, 50), stats=()))
    w = Window.partitionBy("series_id").orderBy("date", "hour")
    for i in (0, 5, 50):
        shifted = F.lit(None).cast("double")
        for h in range(24):
            shifted = F.when(F.col("hour") == h, F.lag("load", 15 + i + h).over(w)).otherwise(shifted)
        panel = panel.withColumn(f"lag{i}", shifted)
    got = got.select(panel.columns)
    assert got.exceptAll(panel).count() == 0 and panel.exceptAll(got).count() == 0


def test_early_days_have_no_statistics(spark):
    rows = {str(r.date): r for r in add_origin_lags(ramp(spark, 5), ["series_id"], lags=(0,)).collect()}
    assert rows["2024-01-02"].mean_24h is None and rows["2024-01-03"].mean_24h is not None
    assert rows["2024-01-03"].mean_48h is None and rows["2024-01-04"].mean_48h is not None


def test_horizons_see_the_issue_day(spark):
    days = add_origin_lags(ramp(spark), ["series_id"], lags=(0,), stats=())
    rows = explode_hours(spread_horizons(days, ["series_id"], horizons=14)).filter("issue_date = '2024-01-10'").collect()
    assert len(rows) == 14 * 24
    for r in rows:
        assert r.lag0 == 24.0 * 9 - 15
        assert r.load == 24.0 * (9 + r.horizon - 1) + r.hour
        assert r.date == dt.date(2024, 1, 10) + dt.timedelta(days=r.horizon - 1)


def test_no_feature_sees_past_its_origin(spark):
    """Changing every load after 09:00 the day before changes no load feature of the day."""
    panel = noisy_panel(spark, hours=24 * 20)
    cut = hour_number(F.lit("2023-01-18").cast("date"), F.lit(0)) - 15
    changed = panel.withColumn(
        "load", F.when(hour_number(F.col("date"), F.col("hour")) > cut, -1e6).otherwise(F.col("load")))

    def features(df):
        days = day_profiles(df, ["series_id"], {"load": F.col("load")})
        out = hourly_features(days, ["series_id"], horizons=2, lags=(0, 1, 24))
        return out.filter("issue_date = '2023-01-18'").drop("load")

    a, b = (sorted(map(tuple, features(df).collect())) for df in (panel, changed))
    assert len(a) == 2 * 2 * 24 and a == b


def test_weather_lags_count_from_the_target_hour(spark):
    days = ramp(spark, 20)
    weather = days.select("date", F.col("load").alias("temperature"))
    out = hourly_features(days, ["series_id"], weather, lags=(0,), horizons=3, temperature_lags=(3, 48), stats=())
    own = hourly_features(days, ["series_id"], weather.withColumn("series_id", F.lit("a")), lags=(0,), horizons=3,
                          temperature_lags=(3, 48), stats=()).select(out.columns)
    rows = out.collect()
    for r in rows:
        assert r.temperature_lag3 == r.load - 3 and r.temperature_lag48 == r.load - 48
        midnight = r.load - r.hour
        assert (r.temperature_min_d1, r.temperature_max_d2, r.temperature_mean_d1) == (
            midnight - 24, midnight - 25, midnight - 12.5)
    assert "temperature" not in out.columns
    assert sorted(map(tuple, rows)) == sorted(map(tuple, own.collect()))


def test_days_cut_out_of_a_history_equal_single_hours(spark):
    """Also where the history is shorter than the lag, and where there is none."""
    pasts = spark.createDataFrame([([float(i) for i in range(24 * n)],) for n in (1, 2, 6)] + [(None,)], "past array<double>")
    lags = (0, 3, 21, 24, 25, 120)
    hours = pasts.selectExpr("past", "explode(sequence(0, 23)) AS hour", *[f"{day_before('past', k)} AS d{k}" for k in lags])
    same = [f"get(d{k}, hour) <=> {hours_before('past', f'{k} - hour')}" for k in lags]
    assert hours.selectExpr(" AND ".join(same) + " AS same").where("NOT same").count() == 0


def test_future_rows_survive_only_online(spark):
    known = ramp(spark, 10)
    future = fill_days(known, ["series_id"], fill="null", end=F.lit("2024-01-12").cast("date"))
    kept = hourly_features(future, ["series_id"], lags=(0,), horizons=4, stats=(), online=True)
    dropped = hourly_features(future, ["series_id"], lags=(0,), horizons=4, stats=())
    assert kept.filter("load IS NULL").count() > 0 and dropped.filter("load IS NULL").count() == 0
    assert kept.filter("issue_date = '2024-01-10' AND date = '2024-01-12'").count() == 24


def test_daily_lags(spark):
    days = ramp(spark, 5).withColumn("x", F.col("load")[0])
    rows = lag_days(days, ["series_id"], ["x"], [1, 2]).orderBy("date").collect()
    assert [r.x_d1 for r in rows] == [None, 0.0, 24.0, 48.0, 72.0] and rows[4].x_d2 == 48.0


def test_smoothing_weights():
    w = savgol_weights()
    assert np.allclose(w[3] * 21, [-2, 3, 6, 7, 6, 3, -2])
    assert np.allclose(w[0] * 42, [39, 8, -4, -4, 1, 4, -2])


@pytest.mark.parametrize("width", [48, 9000])
def test_smoothing_returns_cubics_unchanged(spark, width):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=i // 24), i % 24, 2.0 + 3 * x - x**2 + 0.5 * x**3)
            for i in range(240) for x in [i / 50]]
    df = spark.createDataFrame(rows, "series_id string, date date, hour int, load double")
    got = smooth_savgol(df, ["series_id"], "load", width=width).collect()
    assert len(got) == 240 and max(abs(r.smooth - r.load) for r in got) < 1e-9


def test_smoothing_matches_direct_fits(spark):
    panel = noisy_panel(spark, hours=60, series=("a",))
    got = [r.smooth for r in smooth_savgol(panel, ["series_id"], "load", width=24).orderBy("date", "hour").collect()]
    y = np.array([r.load for r in panel.orderBy("date", "hour").collect()])
    for i in range(60):
        lo = min(max(i - 3, 0), 53)
        x = np.arange(lo, lo + 7) - i
        assert abs(np.polyval(np.polyfit(x, y[lo:lo + 7], 3), 0) - got[i]) < 1e-8


def test_short_series_have_no_smooth_value(spark):
    panel = noisy_panel(spark, hours=5, series=("a",))
    assert all(r.smooth is None for r in smooth_savgol(panel, ["series_id"], "load").collect())


def test_halo_splits_a_series_that_was_dealt_by_series(spark):
    hours = spark.range(20_000).selectExpr("'a' AS s", "date_add(DATE'2020-01-01', int(id div 24)) AS date", "int(id % 24) AS hour", "id AS v")
    dealt = hours.repartition("s").persist()
    answers = set()
    for width in (200, 1000, 50_000):
        out = add_lags(dealt, ["s"], ["v"], [1, 100], width=width)
        assert "_bucket" in out._jdf.queryExecution().executedPlan().toString().split("Window")[-1]
        assert out.where("v_lag1 <> v - 1 OR v_lag100 <> v - 100").count() == 0
        answers.add((out.where("v_lag100 IS NULL").count(), out.where("v_lag1 IS NULL").count(), out.count()))
    assert answers == {(100, 1, 20_000)}
    dealt.unpersist()
