"""Trend, climatology and the three-year forecast on daily orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.operators.kpi import kpis
from gridcast.operators.trend import add_climatology, add_trend, climatology
from gridcast.plans.forecasts import forecast_long_term
from gridcast.queries.registry import ORDER_DAYS_SQL, iso, order_days, query, rounded

_TREND_SQL = f"""{ORDER_DAYS_SQL},
u AS (SELECT series_id, d, load, CAST(year(d) - {{base}} AS DOUBLE) AS u FROM days),
mom AS (SELECT series_id, avg(u) AS m1, avg(u * u) AS m2, avg(load) AS my, covar_pop(u, u) AS a11,
               covar_pop(u, u * u) AS a12, covar_pop(u * u, u * u) AS a22, covar_pop(u, load) AS b1,
               covar_pop(u * u, load) AS b2 FROM u WHERE d < DATE '{{before}}' GROUP BY 1),
coefs AS (SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS c1,
                 (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS c2 FROM mom),
trend AS (SELECT u.series_id, d, load, my + c1 * (u - m1) + c2 * (u * u - m2) AS trend
          FROM u JOIN coefs ON coefs.series_id = u.series_id)"""


@query(
    "trend_quadratic",
    f"""WITH {_TREND_SQL.format(base=1998, before="2000-01-01")}
SELECT series_id, CAST(d AS VARCHAR) AS date, CAST(year(d) * year(d) AS INTEGER) AS year_squared,
       round(load, 4) AS load, round(trend, 2) AS trend FROM trend""",
)
def trend_quadratic(spark, folder):
    """Quadratic trend over the years, fitted before 2000 and drawn to the end."""
    out = add_trend(order_days(spark, folder), ["series_id"], "load", "2000-01-01", base_year=1998)
    out = rounded(rounded(out, 4, "load"), 2, "trend").withColumn("date", iso("date"))
    return out.select("series_id", "date", "year_squared", "load", "trend")


_CLIM_SQL = f"""{ORDER_DAYS_SQL},
clim AS (SELECT series_id, CAST(dayofyear(d) AS INTEGER) AS doy, avg(load) AS m, sqrt(min(load)) AS lo,
                sqrt(max(load)) AS hi
         FROM days WHERE d >= DATE '1997-01-01' AND d < DATE '2000-01-01' GROUP BY 1, 2)"""


@query(
    "climatology_doy",
    f"""WITH {_CLIM_SQL}
SELECT series_id, doy AS day_of_year, round(m, 4) AS clim_mean, round(lo, 6) AS clim_min, round(hi, 6) AS clim_max
FROM clim""",
)
def climatology_doy(spark, folder):
    """Mean and root extremes per day of year over three years."""
    out = climatology(order_days(spark, folder), ["series_id"], "load", "2000-01-01", years=3)
    return rounded(rounded(out, 4, "clim_mean"), 6, "clim_min", "clim_max")


@query(
    "climatology_feature",
    f"""WITH {_CLIM_SQL}
SELECT days.series_id, CAST(days.d AS VARCHAR) AS date, round(load, 4) AS load, round(m, 4) AS clim_mean
FROM days LEFT JOIN clim ON clim.series_id = days.series_id AND doy = dayofyear(days.d)""",
)
def climatology_feature(spark, folder):
    """The climatology as a feature of every day."""
    out = add_climatology(order_days(spark, folder), ["series_id"], "load", "2000-01-01", years=3)
    return rounded(out, 4, "load", "clim_mean").select("series_id", iso("date").alias("date"), "load", "clim_mean")


_LONG_SQL = f"""{_TREND_SQL.format(base=1998, before="1998-01-01")},
train AS (SELECT series_id, d, load, load - trend AS y, CAST(dayofyear(d) AS DOUBLE) AS x FROM trend
          WHERE d >= DATE '1998-01-01' AND d < DATE '2000-01-01'),
model AS (SELECT series_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM train GROUP BY 1),
pred AS (SELECT t.series_id, t.d, load, trend, trend + a + b * dayofyear(t.d) AS p
         FROM trend t JOIN model m ON m.series_id = t.series_id
         WHERE t.d >= DATE '2000-01-01' AND t.d < DATE '2002-01-01')"""


def _residual(spark, folder):
    days = order_days(spark, folder).withColumn("doy", F.dayofyear("date").cast("double"))
    return forecast_long_term(days, ["series_id"], "2000-01-01", ["doy"], years=2, target="residual")


@query(
    "long_term_residual",
    f"""WITH {_LONG_SQL}
SELECT series_id, CAST(d AS VARCHAR) AS date, round(load, 4) AS load, round(trend, 2) AS trend,
       round(p, 2) AS prediction FROM pred""",
)
def long_term_residual(spark, folder):
    """Trend plus a fit of what the trend leaves, two years ahead."""
    out = rounded(rounded(_residual(spark, folder), 4, "load"), 2, "trend", "prediction")
    return out.withColumn("date", iso("date"))


@query(
    "long_term_forecast",
    f"""WITH {_TREND_SQL.format(base=1998, before="1998-01-01")},
train AS (SELECT series_id, ln(load) AS y, CAST(dayofyear(d) AS DOUBLE) AS x1, trend AS x2 FROM trend
          WHERE d >= DATE '1998-01-01' AND d < DATE '2000-01-01'),
m2 AS (SELECT series_id, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) AS a11,
              covar_pop(x1, x2) AS a12, covar_pop(x2, x2) AS a22, covar_pop(x1, y) AS b1, covar_pop(x2, y) AS b2
       FROM train GROUP BY 1),
lin AS (SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS c1,
               (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS c2 FROM m2)
SELECT t.series_id, CAST(d AS VARCHAR) AS date, round(load, 4) AS load, round(trend, 2) AS trend,
       round(exp(my + c1 * (dayofyear(d) - m1) + c2 * (trend - m2)), 2) AS prediction
FROM trend t JOIN lin ON lin.series_id = t.series_id WHERE d >= DATE '2000-01-01' AND d < DATE '2002-01-01'""",
)
def long_term_forecast(spark, folder):
    """Log load from the calendar and the trend, two years ahead."""
    days = order_days(spark, folder).withColumn("doy", F.dayofyear("date").cast("double"))
    out = forecast_long_term(days, ["series_id"], "2000-01-01", ["doy"], years=2)
    out = rounded(rounded(out, 4, "load"), 2, "trend", "prediction")
    return out.withColumn("date", iso("date"))


@query(
    "long_term_kpi",
    f"""WITH {_LONG_SQL}
SELECT count(*) AS n, round(sqrt(avg((load - p) ** 2)), 2) AS rmse, round(avg(abs(load - p) / load) * 100, 6) AS mape_percent
FROM pred""",
)
def long_term_kpi(spark, folder):
    """Total errors over the whole test period, MAPE in percent."""
    out = kpis(_residual(spark, folder)).withColumn("mape_percent", F.col("mape") * 100).drop("mape")
    return rounded(rounded(out, 2, "rmse"), 6, "mape_percent")
