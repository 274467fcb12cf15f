import datetime as dt
import math
import random
import time

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from gridcast.operators import regression
from gridcast.operators.boosted import (
    best_rounds,
    fit_hourly_gbt,
    fit_hourly_linear,
    hour_settings,
    importances,
    learning_curves,
    learning_rate,
    score_hourly,
)
from gridcast.operators.climate import climate_part, neutral_weather, weather_columns
from gridcast.operators.kpi import importance_share, kpi_rollup, kpis, modal_value, monthly_kpis
from gridcast.operators.regression import fit_folds, fit_grouped_linear, score
from gridcast.operators.splits import (
    split_day,
    split_horizon,
    split_long_term,
    split_window,
    until_axis_end,
)
from gridcast.operators.trend import add_climatology, add_trend
from gridcast.plans.forecasts import (
    attach_actuals,
    backtest,
    fit_load,
    forecast_day,
    forecast_days,
    forecast_long_term,
    predict_load,
    split_off_weather,
)
from gridcast.session import stage
from gridcast.sources.store import load_models, save_models


def cloud(spark, groups=("a", "b"), n=200, k=3, seed=1, days=None):
    rng = random.Random(seed)
    rows = []
    for g in groups:
        for i in range(n):
            x = [rng.gauss(5, 2) for _ in range(k)]
            y = 2 + sum((j + 1) * v for j, v in enumerate(x)) + rng.gauss(0, 1)
            day = dt.date(2020, 1, 1) + dt.timedelta(days=i if days is None else i % days)
            rows.append((g, day, *x, y))
    names = ", ".join(f"x{j} double" for j in range(k))
    return spark.createDataFrame(rows, f"g string, date date, {names}, y double")


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_least_squares_matches_numpy(spark, k):
    df = cloud(spark, k=k)
    x = [f"x{j}" for j in range(k)]
    for r in fit_grouped_linear(df, ["g"], x, "y").collect():
        data = np.array([[1.0, *[row[c] for c in x], row.y] for row in df.filter(F.col("g") == r.g).collect()])
        want = np.linalg.lstsq(data[:, :-1], data[:, -1], rcond=None)[0]
        got = [r.intercept, *[r[f"coef_{c}"] for c in x]]
        assert np.allclose(got, want, atol=1e-8) and r.n == 200


def test_constant_and_doubled_regressors_get_zero(spark):
    df = cloud(spark, k=1).withColumns({"c": F.lit(3.0), "twice": F.col("x0") * 2})
    r = fit_grouped_linear(df, ["g"], ["x0", "c", "twice"], "y").orderBy("g").first()
    plain = fit_grouped_linear(df, ["g"], ["x0"], "y").orderBy("g").first()
    assert r.coef_c == 0 and r.coef_twice == 0
    assert math.isclose(r.coef_x0, plain.coef_x0) and math.isclose(r.intercept, plain.intercept)


@pytest.mark.parametrize("k", [20, 80])
def test_wide_tables_match_numpy_and_plan_fast(spark, k):
    df = cloud(spark, k=k, n=300).withColumn("x1", F.when(F.col("date") > "2020-02-01", F.col("x1")))
    x = [f"x{j}" for j in range(k)]
    start = time.perf_counter()
    model = fit_grouped_linear(df, ["g"], x, "y")
    model._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < (2 if k == 20 else 10)
    for r in model.collect():
        rows = df.filter((F.col("g") == r.g) & F.col("x1").isNotNull()).collect()
        data = np.array([[1.0, *[row[c] for c in x], row.y] for row in rows])
        want = np.linalg.lstsq(data[:, :-1], data[:, -1], rcond=None)[0]
        assert r.n == len(rows) and np.allclose([r.intercept, *[r[f"coef_{c}"] for c in x]], want, atol=1e-6)


def test_both_ways_agree(spark, monkeypatch):
    df = cloud(spark, k=3).withColumns({"c": F.lit(3.0), "twice": F.col("x0") * 2})
    x = ["x0", "c", "twice", "x1"]

    def tables():
        folds = spark.createDataFrame([("a", dt.date(2021, 1, 1))], "g string, fold date")
        return [sorted(map(tuple, m.collect())) for m in (
            fit_grouped_linear(df, ["g"], x, "y"), fit_folds(df, ["g"], x, "y", folds=folds))]

    narrow = tables()
    monkeypatch.setattr(regression, "NARROW", 0)
    monkeypatch.setattr(regression, "HELD", 40)
    for a, b in zip(narrow, tables(), strict=True):
        assert len(a) == len(b) > 0
        for p, q in zip(a, b, strict=True):
            keys = len([v for v in p if not isinstance(v, float)])
            assert p[:keys] == q[:keys] and np.allclose(p[keys:], q[keys:], atol=1e-8)


def test_log_models_leave_out_unknown_and_non_positive_loads(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, math.e), ("a", 3.0, math.e**2), ("a", 9.0, 0.0), ("a", 9.0, -4.0), ("a", 9.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    model = fit_grouped_linear(df, ["g"], ["x"], "y", log=True)
    r = model.first()
    assert r.n == 3 and math.isclose(r.coef_x, 1.0) and math.isclose(r.intercept, -1.0)
    more = spark.createDataFrame([("a", 4.0), ("z", 4.0)], "g string, x double")
    out = {r.g: r.prediction for r in score(more, model, ["g"], ["x"], log=True).collect()}
    assert math.isclose(out["a"], math.e**3) and out["z"] is None


@pytest.mark.parametrize("k", [1, 2])
def test_folds_equal_separate_fits(spark, k):
    df = cloud(spark, k=k, n=300)
    x = [f"x{j}" for j in range(k)]
    folds = {(r.g, r.fold): r for r in fit_folds(df, ["g"], x, "y").collect()}
    assert len(folds) == 2 * 9  # ten months, the first has nothing before it
    for fold in (dt.date(2020, 2, 1), dt.date(2020, 6, 1), dt.date(2020, 10, 1)):
        for r in fit_grouped_linear(df.filter(F.col("date") < fold), ["g"], x, "y").collect():
            got = folds[(r.g, fold)]
            assert got.n == r.n
            assert np.allclose([got.intercept, *[got[f"coef_{c}"] for c in x]],
                               [r.intercept, *[r[f"coef_{c}"] for c in x]], atol=1e-8)


def test_backtest_uses_earlier_months_only(spark):
    df = cloud(spark, k=1, n=300).withColumn("y", F.exp(F.col("y") / 20))
    out = backtest(df, ["g"], ["x0"], y="y").filter("date = '2020-06-15' AND g = 'a'").first()
    train = df.filter("date < '2020-06-01' AND g = 'a'")
    m = fit_grouped_linear(train, ["g"], ["x0"], "y", log=True).first()
    assert math.isclose(out.prediction, math.exp(m.intercept + m.coef_x0 * out.x0), rel_tol=1e-9)
    early = backtest(df, ["g"], ["x0"], y="y").filter("date < '2020-02-01'")
    assert early.count() == 62 and early.filter("prediction IS NOT NULL").count() == 0


def test_trend_is_exact_on_a_quadratic(spark):
    days = spark.sql("SELECT 1 AS s, explode(sequence(DATE'2001-01-01', DATE'2012-12-31', INTERVAL 30 DAYS)) AS date")
    y = F.year("date")
    df = days.withColumn("load", 1000.0 + 3.5 * (y - 2001) - 0.25 * (y - 2001) * (y - 2001))
    out = add_trend(df, ["s"], "load", "2008-01-01", base_year=2005).collect()
    assert max(abs(r.trend - r.load) for r in out) < 1e-7
    assert all(r.year_squared == r.date.year**2 for r in out)


def test_trend_residuals_are_orthogonal_to_the_regressors(spark):
    df = cloud(spark, n=2500, k=1).withColumn("load", F.col("y"))
    out = add_trend(df, ["g"], "load", "2099-01-01", base_year=2023).filter("g = 'a'").collect()
    res = np.array([r.load - r.trend for r in out])
    u = np.array([r.date.year - 2023 for r in out])
    assert abs(res.sum()) < 1e-6 and abs((res * u).sum()) < 1e-6 and abs((res * u * u).sum()) < 1e-6


def test_climatology(spark):
    rows = [("a", dt.date(y, 2, 1), float(y - 2000) ** 2) for y in range(2001, 2009)]
    df = spark.createDataFrame(rows, "s string, date date, load double")
    r = add_climatology(df, ["s"], "load", "2007-01-01", years=3).filter("date = '2005-02-01'").first()
    assert (r.clim_mean, r.clim_min, r.clim_max) == (np.mean([16, 25, 36]), 4.0, 6.0)


def dates(spark):
    return spark.sql("SELECT explode(sequence(DATE'2010-01-01', DATE'2016-12-31')) AS date")


def span(df):
    r = df.agg(F.min("date"), F.max("date")).first()
    return str(r[0]), str(r[1])


def test_splits(spark):
    df = dates(spark)
    train, test = split_day(df, "2015-01-01")
    assert span(train)[1] == "2014-12-31" and span(test) == ("2015-01-01", "2015-01-01")
    train, test = split_long_term(df, "2013-01-01")
    assert span(train) == ("2010-01-01", "2012-12-31") and span(test) == ("2013-01-01", "2015-12-31")
    train, test = split_window(df, "2015-01-01", "2015-01-16")
    assert span(train)[1] == "2015-01-15" and span(test) == ("2015-01-01", "2015-01-15")
    assert span(split_window(df, "2015-01-01", "2015-01-16", "2015-01-01")[0])[1] == "2014-12-31"
    horizons = df.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(14))))
    train, test = split_horizon(horizons, "2015-01-01")
    assert test.count() == 14 and span(test) == ("2015-01-01", "2015-01-14") and span(train)[1] == "2014-12-31"
    hours = df.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    axis = until_axis_end(hours, "2012-01-01", 3)
    assert axis.count() == 24 * 1096 + 1


def test_split_filters_reach_the_scan(spark, tmp_path):
    dates(spark).write.parquet(str(tmp_path / "d"))
    for part in split_long_term(spark.read.parquet(str(tmp_path / "d")), "2013-01-01"):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(date,20" in plan and "LessThan(date,20" in plan


def scored(spark):
    rows = [
        ("a", dt.date(2015, 1, 1), 0, 100.0, 90.0), ("a", dt.date(2015, 1, 1), 1, 200.0, 200.0),
        ("a", dt.date(2015, 1, 2), 0, 0.0, 30.0), ("a", dt.date(2015, 1, 2), 1, None, 5.0),
    ]
    return spark.createDataFrame(rows, "s string, date date, hour int, load double, prediction double")


def test_errors(spark):
    r = kpis(scored(spark)).first()
    assert r.n == 3 and math.isclose(r.rmse, math.sqrt((100 + 0 + 900) / 3)) and math.isclose(r.mape, 0.05)
    m = monthly_kpis(scored(spark)).first()
    assert m.days == 2 and math.isclose(m.rmse, (math.sqrt(50) + 30) / 2) and math.isclose(m.mape, 0.05)
    levels = {(x.s, x.hour): x for x in kpi_rollup(scored(spark), ["s", "hour"]).collect()}
    assert levels[(None, None)].n == 3 and levels[("a", 1)].rmse == 0 and levels[(None, None)].level == 3


def test_mode_prefers_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("a", 1), ("b", 9)], "g string, v int")
    assert {(r.g, r.v, r.n) for r in modal_value(df, "v", ["g"]).collect()} == {("a", 1, 2), ("b", 9, 1)}
    assert modal_value(df.filter("g = 'a'"), "v").first().v == 1


def test_shares(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("b", 6.0)], "g string, w double")
    assert sorted(r.share for r in importance_share(df, "w", ["g"]).collect()) == [0.25, 0.75, 1.0]
    assert sorted(r.share for r in importance_share(df, "w").collect()) == [0.1, 0.3, 0.6]


def test_climate_part_is_never_negative(spark):
    df = spark.createDataFrame([(100.0, 90.0), (90.0, 100.0), (None, 5.0)], "y double, n double")
    assert [r[0] for r in df.select(climate_part(F.col("y"), F.col("n"))).collect()] == [10.0, 0.0, None]


def test_neutral_weather_changes_weather_columns_only(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "temperature double, temperature_lag3 double, lag0 double")
    assert weather_columns(df) == ["temperature", "temperature_lag3"]
    assert tuple(neutral_weather(df).first()) == (16.0, 16.0, 3.0)


def warm_load(spark, days=120, series=("a", "b")):
    rng = random.Random(3)
    rows = []
    for s in series:
        for d in range(days):
            for h in range(24):
                t = 10 + 8 * math.sin(d / 9) + rng.gauss(0, 1)
                load = math.exp(5 + 0.01 * h + 0.02 * t + (0.5 if s == "b" else 0))
                rows.append((s, dt.date(2015, 1, 1) + dt.timedelta(days=d), h, t, load))
    return spark.createDataFrame(rows, "series_id string, date date, hour int, temperature double, load double")


def test_weather_part_of_a_known_law(spark):
    out = split_off_weather(warm_load(spark), ["series_id"], "2015-03-01", "2015-03-16", ["temperature"])
    rows = out.collect()
    assert len(rows) == 2 * 15 * 24
    for r in rows:
        neutral = math.exp(5 + 0.01 * r.hour + 0.02 * 16 + (0.5 if r.series_id == "b" else 0))
        assert math.isclose(r.neutral_load, neutral, rel_tol=1e-9)
        assert r.climate_part >= 0 and math.isclose(r.climate_part, max(r.load - neutral, 0), abs_tol=1e-6)


def test_next_day_forecast_of_a_known_law(spark):
    out = forecast_day(warm_load(spark), ["series_id"], "2015-03-01", ["temperature"])
    rows = out.collect()
    assert len(rows) == 48 and all(math.isclose(r.load, r.prediction, rel_tol=1e-9) for r in rows)


def test_multi_day_forecast_has_a_model_per_horizon(spark):
    df = warm_load(spark, days=60, series=("a",)).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(3))))
    df = df.withColumn("load", F.col("load") * F.col("horizon"))
    rows = forecast_days(df, ["series_id"], "2015-02-10", ["temperature"]).collect()
    assert len(rows) == 72 and all(math.isclose(r.load, r.prediction, rel_tol=1e-9) for r in rows)


@pytest.mark.parametrize("target", ["log", "residual"])
def test_long_term_forecast(spark, target):
    days = spark.sql("SELECT 1 AS s, explode(sequence(DATE'2001-01-01', DATE'2014-12-31')) AS date")
    u = F.year("date") - 2001
    df = days.withColumn("season", F.cos(F.dayofyear("date") / 58.1))
    df = df.withColumn("load", 1000.0 + 20 * u + 0.5 * u * u + 30 * F.col("season"))
    out = forecast_long_term(df, ["s"], "2011-01-01", ["season"], target=target)
    err = out.select((F.abs(F.col("load") - F.col("prediction")) / F.col("load")).alias("e")).agg(F.max("e"), F.count("e"))
    worst, n = err.first()
    assert n == 1096 and worst < 0.02


def test_unknown_actuals_keep_their_forecast(spark):
    forecast = scored(spark).drop("load")
    actual = scored(spark).select("s", "date", "hour", "load").filter("hour = 0")
    out = attach_actuals(forecast, actual, ["s", "date", "hour"])
    assert out.count() == 4 and out.filter("load IS NULL").count() == 2


def test_model_tables_survive_storage(spark):
    train = warm_load(spark)
    model = fit_load(train, ["series_id", "hour"], ["temperature"])
    stored = stage(model, by=("hour",))
    a = predict_load(train, model, ["series_id", "hour"], ["temperature"]).agg(F.sum("prediction")).first()[0]
    b = predict_load(train, stored, ["series_id", "hour"], ["temperature"]).agg(F.sum("prediction")).first()[0]
    assert math.isclose(a, b, rel_tol=1e-12)


def test_settings_per_hour():
    assert [learning_rate("day_ahead", h) for h in (0, 4, 5, 15, 17, 20)] == [0.016, 0.017, 0.02, 0.03, 0.025, 0.028]
    assert [learning_rate("long_term", h) for h in (0, 1, 3, 8, 9)] == [0.005, 0.006, 0.007, 0.008, 0.006]
    s = hour_settings("climate", 3, maxIter=7)
    assert (s["stepSize"], s["maxDepth"], s["maxIter"], s["seed"]) == (0.05, 5, 7, 1301)
    assert hour_settings("day_ahead", 0)["maxIter"] == 1200


def test_boosted_models_per_hour(spark, tmp_path):
    df = warm_load(spark, days=90).withColumn("noise", F.rand(3))
    features = ["temperature", "noise"]
    held_out = F.col("date") >= F.lit("2015-03-15").cast("date")
    models = fit_hourly_gbt(df, features, "load", hours=[3, 18], validation=held_out, maxIter=4, maxDepth=3, stepSize=0.5)
    assert sorted(models) == [3, 18]
    shares = {(r.hour, r.feature): r.importance for r in importances(df, models, features).collect()}
    assert math.isclose(shares[(3, "temperature")] + shares[(3, "noise")], 1.0) and shares[(3, "temperature")] > 0.5
    save_models(models, str(tmp_path))
    back = load_models(GBTRegressionModel, str(tmp_path), models)
    a = sorted(map(tuple, score_hourly(df.filter("hour IN (3, 18)"), models, features).collect()))
    b = sorted(map(tuple, score_hourly(df.filter("hour IN (3, 18)"), back, features).collect()))
    assert a == b and len(a) == 2 * 90 * 2
    plain = fit_hourly_gbt(df, features, "load", hours=[3], maxIter=4, maxDepth=3, stepSize=0.5)
    curves = learning_curves(df, plain, features, "load").orderBy("round").collect()
    assert curves[-1].loss < curves[0].loss and [r["round"] for r in curves] == [1, 2, 3, 4]
    last = kpis(score_hourly(df.filter("hour = 3"), plain, features)).first()
    assert math.isclose(curves[-1].loss, last.rmse, rel_tol=1e-9)  # in units of the load


def test_training_stops_after_waiting_in_vain(spark):
    losses = {1: [9, 5, 6, 7, 4, 4, 8], 2: [5, 4, 3, 2, 1], 3: [2, 3, 3, 3, 1]}
    rows = [(h, i + 1, float(v)) for h, ls in losses.items() for i, v in enumerate(ls)]
    curves = spark.createDataFrame(rows, "hour int, round int, loss double")
    got = {r.hour: (r["round"], r.loss) for r in best_rounds(curves, patience=3).collect()}
    assert got == {1: (5, 4.0), 2: (5, 1.0), 3: (1, 2.0)}


def test_boosted_models_per_horizon_and_hour(spark, tmp_path):
    df = warm_load(spark, days=60, series=("a",)).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(2))))
    models = fit_hourly_gbt(df, ["temperature"], "load", "multi_day", hours=[6], horizons=[1, 2], maxIter=2, maxDepth=2)
    assert sorted(models) == [(1, 6), (2, 6)]
    save_models(models, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["horizon=1", "horizon=2"]
    assert score_hourly(df.filter("hour = 6"), models, ["temperature"]).count() == 120
    assert importances(df, models, ["temperature"]).count() == 2


def test_linear_models_per_hour(spark):
    df = warm_load(spark, days=60).filter("series_id = 'a'")
    models = fit_hourly_linear(df, ["temperature"], "load", hours=[5])
    assert math.isclose(models[5].coefficients[0], 0.02, rel_tol=1e-6)
