"""Grouped linear forecasts, counterfactuals, backtests and error tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.operators.kpi import importance_share, kpi_rollup, kpis, modal_value, monthly_kpis
from gridcast.operators.profiles import hour_lags
from gridcast.operators.regression import fit_grouped_linear
from gridcast.operators.splits import split_day, split_horizon, split_long_term, split_window
from gridcast.plans.features import hourly_features
from gridcast.plans.forecasts import (
    attach_actuals,
    backtest,
    fit_load,
    forecast_day,
    forecast_days,
    predict_load,
    split_off_weather,
)
from gridcast.queries.registry import (
    ORDER_DAYS_SQL,
    TEMPERATURE_SQL,
    grid_sql,
    iso,
    least_squares_sql,
    load_panel,
    load_profiles,
    order_days,
    query,
    readings,
    rounded,
    table,
    temperature_profiles,
)
from gridcast.session import stage

CUT = "2024-01-20"
LAST_ISSUE = "2024-01-17"


def _level(df):
    """``level``: log of the mean load over the 24 hours up to the origin."""
    return df.withColumn("level", F.ln(F.col("mean_24h") + 1))


def _features(spark, folder, horizons=1, **options):
    load = load_profiles(spark, folder)
    plain = dict(lags=(0,), stats=(24,), dummies=False)
    return _level(hourly_features(load, ["series_id"], horizons=horizons, **{**plain, **options}))


_LEVEL_SQL = f"""{grid_sql()},
m AS (SELECT series_id, t, d, h, CASE WHEN count(load) OVER w = 24 THEN avg(load) OVER w END AS m24
      FROM grid WINDOW w AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 38 PRECEDING AND 15 PRECEDING)),
anchor AS (SELECT series_id, d, ln(m24 + 1) AS x FROM m WHERE h = 0 AND m24 IS NOT NULL),
feats AS (SELECT g.series_id, g.d, g.h, load, ln(load + 1) AS y, x
          FROM grid g JOIN anchor a ON a.series_id = g.series_id AND a.d = g.d)"""

_FORECAST_SQL = f"""{_LEVEL_SQL},
model AS (SELECT series_id, h, coalesce(regr_slope(y, x), 0) AS b,
                 coalesce(regr_intercept(y, x), avg(y)) AS a FROM feats WHERE d < DATE '{CUT}' GROUP BY 1, 2),
pred AS (SELECT f.series_id, f.d, f.h, load, exp(a + b * x) - 1 AS p
         FROM feats f JOIN model m ON m.series_id = f.series_id AND m.h = f.h WHERE f.d = DATE '{CUT}')"""


#: Regressors of the flagship: load history, weather and calendar of the prepared table.
PREPARED = ("level", "lag0", "lag24", "temperature_lag24", "temperature_mean_d1", "temperature_max_d1", "weekend")

PREPARED_SQL = f"""{grid_sql()}, {TEMPERATURE_SQL},
tdays AS (SELECT d, avg(temperature) AS mean, max(temperature) AS top FROM temps GROUP BY d),
m AS (SELECT series_id, t, d, h, lag(load, 15) OVER s AS lag0, lag(load, 39) OVER s AS lag24,
             CASE WHEN count(load) OVER w = 24 THEN avg(load) OVER w END AS m24
      FROM grid WINDOW s AS (PARTITION BY series_id ORDER BY t),
                       w AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 38 PRECEDING AND 15 PRECEDING)),
tl AS (SELECT t, lag(temperature, 24) OVER (ORDER BY t) AS t24 FROM temps),
wide AS (SELECT g.series_id, g.d, g.h, load, ln(load + 1) AS y, ln(m24 + 1) AS x0, lag0 AS x1, lag24 AS x2, t24 AS x3,
                mean AS x4, top AS x5, CAST(isodow(g.d) >= 6 AS INTEGER) AS x6
         FROM grid g JOIN m ON m.series_id = g.series_id AND m.d = g.d AND m.h = 0
         JOIN tl ON tl.t = g.t JOIN tdays ON tdays.d = g.d - 1
         WHERE m24 IS NOT NULL AND lag24 IS NOT NULL AND t24 IS NOT NULL),
fit AS (SELECT * FROM wide WHERE d < DATE '{CUT}'),
{least_squares_sql("fit", "h", len(PREPARED))}"""


def prepared(spark, folder):
    """The next-day feature table with load history, weather and calendar."""
    wide = hourly_features(load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder),
                           lags=(0, 24), stats=(24,), temperature_lags=(24,), temperature_days=(1,), dummies=False)
    return _level(wide).withColumn("weekend", (F.col("weekday") >= 5).cast("double"))


@query(
    "day_ahead_kpi",
    f"""WITH {PREPARED_SQL},
pred AS (SELECT series_id, load, exp(c{"".join(f" + c{i} * x{i}" for i in range(len(PREPARED)))}) - 1 AS p
         FROM wide JOIN solved USING (h) WHERE d = DATE '{CUT}')
SELECT series_id, count(*) AS n, round(sqrt(avg((load - p) ** 2)), 4) AS rmse,
       round(avg(abs(load - p) / nullif(load, 0)), 6) AS mape FROM pred GROUP BY 1""",
)
def day_ahead_kpi(spark, folder):
    """Next-day job on the seven columns of ``PREPARED``: grid, load history, weather and weekend, one model per hour for
    all series, forecast, errors."""
    train, test = split_day(prepared(spark, folder), CUT)
    model = fit_load(train, ["hour"], PREPARED, shift=1.0)
    forecast = predict_load(test, model, ["hour"], PREPARED, shift=1.0)
    return rounded(rounded(kpis(forecast, ["series_id"]), 4, "rmse"), 6, "mape")


@query(
    "hourly_linear_forecast",
    f"""WITH {_FORECAST_SQL}
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load, round(p, 3) AS prediction FROM pred""",
)
def hourly_linear_forecast(spark, folder):
    """Forecast rows with actuals."""
    forecast = forecast_day(_features(spark, folder), ["series_id"], CUT, ["level"], shift=1.0)
    return rounded(rounded(forecast, 4, "load"), 3, "prediction").withColumn("date", iso("date"))


@query(
    "hourly_linear_models",
    f"""WITH {_LEVEL_SQL}
SELECT series_id, h AS hour, count(*) AS n, round(coalesce(regr_slope(y, x), 0), 6) AS coef_level,
       round(coalesce(regr_intercept(y, x), avg(y)), 6) AS intercept
FROM feats WHERE d < DATE '{CUT}' GROUP BY 1, 2""",
)
def hourly_linear_models(spark, folder):
    """The model table, one row per series and hour."""
    train, _ = split_day(_features(spark, folder), CUT)
    return rounded(fit_load(train, ["series_id", "hour"], ["level"], shift=1.0), 6, "coef_level", "intercept")


_TWO_SQL = """
mom AS (SELECT series_id, h, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,
               covar_pop(x1, x1) AS a11, covar_pop(x1, x2) AS a12, covar_pop(x2, x2) AS a22,
               covar_pop(x1, y) AS b1, covar_pop(x2, y) AS b2 FROM {train} GROUP BY 1, 2),
model AS (SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS c1,
                 (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS c2 FROM mom)"""


@query(
    "two_regressor_models",
    f"""WITH {grid_sql()}, {TEMPERATURE_SQL},
rows_ AS (SELECT g.series_id, g.h, ln(load + 1) AS y, temperature AS x1, temperature * temperature AS x2
          FROM grid g JOIN temps t ON t.t = g.t), {_TWO_SQL.format(train="rows_")}
SELECT series_id, h AS hour, n, round(c1, 5) AS coef_warm, round(c2, 5) AS coef_warm2,
       round(my - c1 * m1 - c2 * m2, 4) AS intercept FROM model""",
)
def two_regressor_models(spark, folder):
    """Two regressors (temperature and its square) per series and hour."""
    panel = hourly_features(load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder),
                            lags=(), stats=(), temperature_lags=(), temperature_days=(),
                            same_hour_temperature=True, dummies=False)
    panel = panel.select("series_id", "hour", F.ln(F.col("load") + 1).alias("y"), F.col("temperature").alias("warm"),
                         (F.col("temperature") * F.col("temperature")).alias("warm2"))
    out = fit_grouped_linear(panel, ["series_id", "hour"], ["warm", "warm2"], "y")
    return rounded(rounded(out, 5, "coef_warm", "coef_warm2"), 4, "intercept")


_MULTI_SQL = f"""{_LEVEL_SQL},
js AS (SELECT CAST(unnest(generate_series(1, 14)) AS INTEGER) AS j),
multi AS (SELECT a.series_id, a.d AS issue, j, g.d, g.h, load, ln(load + 1) AS y, x
          FROM anchor a CROSS JOIN js JOIN grid g ON g.series_id = a.series_id AND g.d = a.d + (j - 1)),
model AS (SELECT j, h, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
          FROM multi WHERE d < DATE '{LAST_ISSUE}' GROUP BY 1, 2),
pred AS (SELECT f.series_id, f.j, f.d, f.h, load, exp(a + b * x) - 1 AS p
         FROM multi f JOIN model m ON m.j = f.j AND m.h = f.h
         WHERE f.issue = DATE '{LAST_ISSUE}' AND f.d = DATE '{LAST_ISSUE}' + (f.j - 1))"""


def _multi_forecast(spark, folder):
    features = _features(spark, folder, horizons=14)
    return forecast_days(features, ["series_id"], LAST_ISSUE, ["level"], shift=1.0, models=())


@query(
    "multi_horizon_forecast",
    f"""WITH {_MULTI_SQL}
SELECT series_id, j AS horizon, CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load,
       round(p, 3) AS prediction FROM pred""",
)
def multi_horizon_forecast(spark, folder):
    """14 days ahead, one model per horizon and hour for all series, in one job."""
    out = _multi_forecast(spark, folder)
    return rounded(rounded(out, 4, "load"), 3, "prediction").withColumn("date", iso("date"))


@query(
    "kpi_by_horizon",
    f"""WITH {_MULTI_SQL}
SELECT j AS horizon, CAST(d AS VARCHAR) AS date, CAST(isodow(d) - 1 AS INTEGER) AS weekday, count(*) AS n,
       round(sqrt(avg((load - p) ** 2)), 4) AS rmse, round(avg(abs(load - p) / nullif(load, 0)), 6) AS mape
FROM pred GROUP BY 1, 2, 3""",
)
def kpi_by_horizon(spark, folder):
    """Errors per horizon with the target date and its weekday."""
    scored = _multi_forecast(spark, folder).withColumn("weekday", F.weekday("date"))
    out = rounded(rounded(kpis(scored, ["horizon", "date", "weekday"]), 4, "rmse"), 6, "mape")
    return out.withColumn("date", iso("date"))


@query(
    "online_forecast",
    f"""WITH {_MULTI_SQL}
SELECT series_id, j AS horizon, CAST(d AS VARCHAR) AS date, h AS hour, round(p, 3) AS prediction,
       round(CASE WHEN d < DATE '2024-01-25' THEN load END, 4) AS actual
FROM pred""",
)
def online_forecast(spark, folder):
    """Forecast against the actuals known by 25 January; later hours have none."""
    forecast = _multi_forecast(spark, folder).drop("load")
    known = load_panel(spark, folder).filter(F.col("date") < F.lit("2024-01-25").cast("date"))
    known = known.withColumnRenamed("load", "actual")
    out = attach_actuals(forecast, known, ["series_id", "date", "hour"])
    out = rounded(rounded(out, 4, "actual"), 3, "prediction").withColumn("date", iso("date"))
    return out.select("series_id", "horizon", "date", "hour", "prediction", "actual")


@query(
    "online_kpi",
    f"""WITH {_MULTI_SQL}, known AS (SELECT *, CASE WHEN d < DATE '2024-01-25' THEN load END AS actual FROM pred)
SELECT series_id, count(actual) AS n, round(sqrt(avg((actual - p) ** 2)), 4) AS rmse,
       round(avg(abs(actual - p) / nullif(actual, 0)), 6) AS mape FROM known GROUP BY 1""",
)
def online_kpi(spark, folder):
    """Errors leave out the hours without an actual."""
    forecast = _multi_forecast(spark, folder).drop("load")
    known = load_panel(spark, folder).filter(F.col("date") < F.lit("2024-01-25").cast("date"))
    scored = attach_actuals(forecast, known, ["series_id", "date", "hour"])
    return rounded(rounded(kpis(scored, ["series_id"]), 4, "rmse"), 6, "mape")


# -- naive forecast (same hour a week earlier) for the error tables -----------

_NAIVE_SQL = f"""{grid_sql()},
naive AS (SELECT series_id, d, h, load, lag(load, 168) OVER (PARTITION BY series_id ORDER BY t) AS p FROM grid),
known AS (SELECT * FROM naive WHERE p IS NOT NULL)"""


def _naive(spark, folder):
    lagged = hour_lags(load_profiles(spark, folder), ["series_id"], "load", [168])
    return lagged.withColumnRenamed("load_lag168", "prediction").filter("prediction IS NOT NULL")


@query(
    "kpi_by_hour",
    f"""WITH {_NAIVE_SQL}
SELECT h AS hour, count(*) AS n, round(sqrt(avg((load - p) ** 2)), 4) AS rmse,
       round(avg(abs(load - p) / nullif(load, 0)), 6) AS mape FROM known GROUP BY 1""",
)
def kpi_by_hour(spark, folder):
    """Errors per hour of day."""
    return rounded(rounded(kpis(_naive(spark, folder), ["hour"]), 4, "rmse"), 6, "mape")


@query(
    "kpi_rollup",
    f"""WITH {_NAIVE_SQL}
SELECT series_id, h AS hour, CAST(grouping(series_id, h) AS BIGINT) AS level, count(*) AS n,
       round(sqrt(avg((load - p) ** 2)), 4) AS rmse, round(avg(abs(load - p) / nullif(load, 0)), 6) AS mape
FROM known GROUP BY ROLLUP (series_id, h)""",
)
def kpi_levels(spark, folder):
    """Errors per series and hour, per series and in total, in one pass."""
    out = kpi_rollup(_naive(spark, folder), ["series_id", "hour"])
    return rounded(rounded(out, 4, "rmse"), 6, "mape")


@query(
    "monthly_kpis",
    f"""WITH {_NAIVE_SQL},
daily AS (SELECT series_id, d, sqrt(avg((load - p) ** 2)) AS r, avg(abs(load - p) / nullif(load, 0)) AS m
          FROM known GROUP BY 1, 2)
SELECT series_id, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month, count(r) AS days,
       round(avg(r), 4) AS rmse, round(avg(m), 6) AS mape FROM daily GROUP BY 1, 2""",
)
def kpi_months(spark, folder):
    """A10: monthly mean of the daily errors."""
    out = rounded(rounded(monthly_kpis(_naive(spark, folder), ["series_id"]), 4, "rmse"), 6, "mape")
    return out.withColumn("month", iso("month"))


@query(
    "modal_date",
    """WITH n AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY n DESC, d) AS rn FROM n)
SELECT series_id, CAST(d AS VARCHAR) AS date, n FROM r WHERE rn = 1""",
)
def modal_date(spark, folder):
    """Most frequent date per series, the earliest on ties."""
    return modal_value(readings(spark, folder), "date", ["series_id"]).withColumn("date", iso("date"))


@query(
    "weight_share",
    """WITH w AS (SELECT event_type AS series_id, user_id, sum(abs(value)) AS weight FROM events GROUP BY 1, 2)
SELECT series_id, user_id, round(weight, 4) AS weight,
       round(weight / sum(weight) OVER (PARTITION BY series_id), 8) AS share FROM w""",
)
def weight_share(spark, folder):
    """Weights as a share of their group's total."""
    weights = readings(spark, folder).groupBy("series_id", "user_id").agg(F.sum(F.abs("value")).alias("weight"))
    return rounded(rounded(importance_share(weights, "weight", ["series_id"]), 4, "weight"), 8, "share")


@query(
    "split_sets",
    f"""WITH {_MULTI_SQL},
sets AS (
  SELECT 'day' AS split, 'train' AS part, d FROM feats WHERE d < DATE '{CUT}'
  UNION ALL SELECT 'day', 'test', d FROM feats WHERE d = DATE '{CUT}'
  UNION ALL SELECT 'horizon', 'train', d FROM multi WHERE d < DATE '{CUT}'
  UNION ALL SELECT 'horizon', 'test', d FROM multi WHERE d = DATE '{CUT}' + (j - 1)
  UNION ALL SELECT 'window', 'train', d FROM feats WHERE d < DATE '2024-01-27'
  UNION ALL SELECT 'window', 'test', d FROM feats WHERE d >= DATE '{CUT}' AND d < DATE '2024-01-27'
  UNION ALL SELECT 'long', 'train', CAST(o_orderdate AS DATE) FROM orders
            WHERE o_orderdate >= DATE '1995-06-01' AND o_orderdate < DATE '1998-06-01'
  UNION ALL SELECT 'long', 'test', CAST(o_orderdate AS DATE) FROM orders
            WHERE o_orderdate >= DATE '1998-06-01' AND o_orderdate < DATE '2001-06-01')
SELECT split, part, count(*) AS n, CAST(min(d) AS VARCHAR) AS first, CAST(max(d) AS VARCHAR) AS last
FROM sets GROUP BY 1, 2""",
)
def split_sets(spark, folder):
    """Row counts and date ranges of every kind of split."""
    single = _features(spark, folder)
    multi = _features(spark, folder, horizons=14)
    orders = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    splits = {
        "day": split_day(single, CUT),
        "horizon": split_horizon(multi, CUT),
        "window": split_window(single, CUT, "2024-01-27"),
        "long": split_long_term(orders, "1998-06-01", 3),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), iso(F.min("date")).alias("first"), iso(F.max("date")).alias("last"))
        .select(F.lit(split).alias("split"), F.lit(part).alias("part"), "n", "first", "last")
        for split, pair in splits.items()
        for part, df in zip(("train", "test"), pair, strict=True)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_CLIMATE_SQL = f"""{grid_sql()}, {TEMPERATURE_SQL},
feats AS (SELECT g.series_id, g.d, g.h, load, ln(load + 1) AS y, temperature AS x1,
                 lag(temperature, 24) OVER (PARTITION BY g.series_id ORDER BY g.t) AS x2
          FROM grid g JOIN temps t ON t.t = g.t),
train AS (SELECT * FROM feats WHERE d < DATE '2024-01-31' AND x2 IS NOT NULL), {_TWO_SQL.format(train="train")},
cf AS (SELECT f.series_id, f.d, f.h, load,
              exp(my - c1 * m1 - c2 * m2 + c1 * 16.0 + c2 * 16.0) - 1 AS neutral
       FROM feats f JOIN model m ON m.series_id = f.series_id AND m.h = f.h
       WHERE f.d >= DATE '2024-01-16' AND f.d < DATE '2024-01-31')"""


def _climate(spark, folder):
    features = hourly_features(load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder),
                               lags=(), stats=(), temperature_lags=(24,), temperature_days=(), same_hour_temperature=True,
                               dummies=False)
    columns = ["temperature", "temperature_lag24"]
    return split_off_weather(features, ["series_id"], "2024-01-16", "2024-01-31", columns, shift=1.0)


@query(
    "climate_part",
    f"""WITH {_CLIMATE_SQL}
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load, round(neutral, 3) AS neutral_load,
       round(greatest(load - neutral, 0), 3) AS climate_part FROM cf""",
)
def climate(spark, folder):
    """Load due to weather over 15 days, against 16 degrees."""
    out = _climate(spark, folder)
    return rounded(rounded(out, 4, "load"), 3, "neutral_load", "climate_part").withColumn("date", iso("date"))


@query(
    "climate_share",
    f"""WITH {_CLIMATE_SQL}
SELECT series_id, CAST(d AS VARCHAR) AS date, round(sum(load), 4) AS load,
       round(sum(greatest(load - neutral, 0)), 3) AS climate_part FROM cf GROUP BY 1, 2""",
)
def climate_share(spark, folder):
    """M9: daily weather part next to the daily load."""
    out = _climate(spark, folder).groupBy("series_id", "date").agg(
        F.sum("load").alias("load"), F.sum("climate_part").alias("climate_part"))
    return rounded(rounded(out, 4, "load"), 3, "climate_part").withColumn("date", iso("date"))


_BACKTEST_SQL = f"""{ORDER_DAYS_SQL},
x AS (SELECT series_id, d, load, ln(load) AS y, CAST(dayofyear(d) AS DOUBLE) AS doy FROM days),
folds AS (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS fold FROM x),
model AS (SELECT series_id, fold, CASE WHEN min(doy) < max(doy) THEN regr_slope(y, doy) ELSE 0 END AS b,
                 CASE WHEN min(doy) < max(doy) THEN regr_intercept(y, doy) ELSE avg(y) END AS a
          FROM x JOIN folds ON x.d < folds.fold GROUP BY 1, 2),
pred AS (SELECT x.series_id, d, load, CAST(date_trunc('month', d) AS DATE) AS fold, exp(a + b * doy) AS p
         FROM x LEFT JOIN model m ON m.series_id = x.series_id AND m.fold = CAST(date_trunc('month', d) AS DATE))"""


def _backtest(spark, folder):
    days = order_days(spark, folder).withColumn("doy", F.dayofyear("date").cast("double"))
    return backtest(days, ["series_id"], ["doy"])


@query(
    "backtest_forecast",
    f"""WITH {_BACKTEST_SQL}
SELECT series_id, CAST(d AS VARCHAR) AS date, CAST(fold AS VARCHAR) AS fold, round(load, 4) AS load,
       round(p, 2) AS prediction FROM pred""",
)
def backtest_forecast(spark, folder):
    """Models renewed every month from all earlier days, every day scored with the latest."""
    out = rounded(rounded(_backtest(spark, folder), 4, "load"), 2, "prediction")
    return out.select("series_id", iso("date").alias("date"), iso("fold").alias("fold"), "load", "prediction")


_GAPS_SQL = """days AS (SELECT user_id AS series_id, CAST(ts AS DATE) AS d, sum(value) AS v FROM events GROUP BY 1, 2),
x AS (SELECT series_id, d, CAST(date_trunc('week', d) AS DATE) AS fold,
             CASE WHEN (series_id + week(d)) % 3 <> 0 THEN v END AS load FROM days),
folds AS (SELECT DISTINCT series_id, fold FROM x),
model AS (SELECT f.series_id, f.fold, avg(ln(load + 1)) AS a FROM folds f
          JOIN x ON x.series_id = f.series_id AND x.d < f.fold AND load > -1 GROUP BY 1, 2)"""


@query(
    "backtest_gaps",
    f"""WITH {_GAPS_SQL}
SELECT x.series_id, CAST(d AS VARCHAR) AS date, CAST(x.fold AS VARCHAR) AS fold, round(load, 4) AS load,
       round(exp(a) - 1, 4) AS prediction
FROM x LEFT JOIN model m ON m.series_id = x.series_id AND m.fold = x.fold""",
)
def backtest_gaps(spark, folder):
    """Daily sums per user with a load unknown in every third week: every row is scored, by week."""
    days = readings(spark, folder, "user_id").groupBy("series_id", "date").agg(F.sum("value").alias("load"))
    unknown = (F.col("series_id") + F.weekofyear("date")) % 3 == 0
    days = days.withColumn("load", F.when(~unknown, F.col("load")))
    out = backtest(days, ["series_id"], [], shift=1.0, unit="week")
    out = rounded(out, 4, "load", "prediction")
    return out.select("series_id", iso("date").alias("date"), iso("fold").alias("fold"), "load", "prediction")


@query(
    "backtest_kpi",
    f"""WITH {_BACKTEST_SQL},
daily AS (SELECT series_id, d, sqrt(avg((load - p) ** 2)) AS r, avg(abs(load - p) / load) AS m FROM pred GROUP BY 1, 2)
SELECT series_id, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month, count(r) AS days,
       round(avg(r), 2) AS rmse, round(avg(m), 6) AS mape FROM daily GROUP BY 1, 2""",
)
def backtest_kpi(spark, folder):
    """Monthly errors of the walk-forward test."""
    out = monthly_kpis(_backtest(spark, folder), ["series_id"])
    return rounded(rounded(out, 2, "rmse"), 6, "mape").withColumn("month", iso("month"))


@query(
    "weekly_backtest",
    f"""WITH {_LEVEL_SQL},
js AS (SELECT CAST(unnest(generate_series(1, 7)) AS INTEGER) AS j),
multi AS (SELECT a.series_id, a.d AS issue, j, g.d, g.h, load, ln(load + 1) AS y, x
          FROM anchor a CROSS JOIN js JOIN grid g ON g.series_id = a.series_id AND g.d = a.d + (j - 1)),
folds AS (SELECT DISTINCT CAST(date_trunc('week', d) AS DATE) AS fold FROM multi),
model AS (SELECT j, h, fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
          FROM multi JOIN folds ON multi.d < folds.fold GROUP BY 1, 2, 3),
pred AS (SELECT f.series_id, f.j, f.issue, f.d, f.h, load, CAST(date_trunc('week', f.issue) AS DATE) AS fold, exp(a + b * x) - 1 AS p
         FROM multi f LEFT JOIN model m ON m.j = f.j AND m.h = f.h
              AND m.fold = CAST(date_trunc('week', f.issue) AS DATE))
SELECT series_id, j AS horizon, CAST(fold AS VARCHAR) AS fold, count(p) AS n,
       round(sqrt(avg((load - p) ** 2)), 3) AS rmse FROM pred GROUP BY 1, 2, 3""",
)
def weekly_backtest(spark, folder):
    """Seven horizons, models renewed every week, judged per horizon and week of issue."""
    features = _features(spark, folder, horizons=7)
    out = backtest(features, ["series_id"], ["level"], by=["horizon", "hour"], shift=1.0, unit="week",
                   issued="issue_date", models=())
    errors = kpis(out, ["series_id", "horizon", "fold"]).drop("mape")
    return rounded(errors, 3, "rmse").withColumn("fold", iso("fold"))


@query(
    "stored_models",
    f"""WITH {_FORECAST_SQL},
later AS (SELECT f.series_id, f.d, f.h, load, exp(a + b * x) - 1 AS p
          FROM feats f JOIN model m ON m.series_id = f.series_id AND m.h = f.h WHERE f.d >= DATE '{CUT}')
SELECT series_id, CAST(d AS VARCHAR) AS date, count(*) AS n, round(sqrt(avg((load - p) ** 2)), 4) AS rmse
FROM later GROUP BY 1, 2""",
)
def stored_models(spark, folder):
    """Models written once and read back, later days scored without training."""
    features = _features(spark, folder)
    train, _ = split_day(features, CUT)
    model = stage(fit_load(train, ["series_id", "hour"], ["level"], shift=1.0), by=("hour",))
    later = features.filter(F.col("date") >= F.lit(CUT).cast("date"))
    scored = predict_load(later, model, ["series_id", "hour"], ["level"], shift=1.0)
    out = kpis(scored, ["series_id", "date"]).select("series_id", iso("date").alias("date"), "n", "rmse")
    return rounded(out, 4, "rmse")
