"""Hourly lags, day statistics, origin features, smoothing, feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.functions.noise import horizon_noise
from gridcast.operators.lags import add_lags
from gridcast.operators.origins import LOAD_LAGS, OFFSET, add_origin_lags, spread_horizons
from gridcast.operators.profiles import array_stats, explode_hours, hour_lags, lag_days
from gridcast.operators.readings import drop_incomplete
from gridcast.operators.smooth import smooth_savgol
from gridcast.plans.features import (
    DAY_AHEAD_TEMPERATURE_LAGS,
    MULTI_DAY_TEMPERATURE_LAGS,
    feature_columns,
    hourly_features,
)
from gridcast.plans.forecasts import fit_load, predict_load
from gridcast.queries.registry import (
    TEMPERATURE_SQL,
    grid_sql,
    iso,
    load_panel,
    load_profiles,
    projection_sql,
    query,
    rounded,
    temperature_profiles,
)

_T_LAGS_SQL = ", ".join(
    f"lag(temperature, {k}) OVER (ORDER BY t) AS temperature_lag{k}" for k in DAY_AHEAD_TEMPERATURE_LAGS
)
_T_NAMES = [f"temperature_lag{k}" for k in DAY_AHEAD_TEMPERATURE_LAGS]


@query(
    "temperature_lags",
    f"""WITH {TEMPERATURE_SQL}, lagged AS (SELECT d, h, temperature, {_T_LAGS_SQL} FROM temps)
SELECT CAST(d AS VARCHAR) AS date, h AS hour, round(temperature, 6) AS temperature,
       {", ".join(f"round({n}, 6) AS {n}" for n in _T_NAMES)}
FROM lagged WHERE temperature_lag120 IS NOT NULL""",
)
def temperature_lags(spark, folder):
    """Hourly temperature lags; incomplete rows dropped."""
    panel = explode_hours(temperature_profiles(spark, folder), ("temperature",))
    lagged = drop_incomplete(add_lags(panel, [], ["temperature"], DAY_AHEAD_TEMPERATURE_LAGS))
    return rounded(lagged, 6, "temperature", *_T_NAMES).withColumn("date", iso("date"))


@query(
    "load_lags_by_user",
    f"""WITH {grid_sql("user_id")},
lagged AS (SELECT series_id, d, h, load, lag(load, 1) OVER w AS l1, lag(load, 24) OVER w AS l24,
                  lag(load, 168) OVER w AS l168 FROM grid WINDOW w AS (PARTITION BY series_id ORDER BY t))
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load, round(l1, 4) AS load_lag1,
       round(l24, 4) AS load_lag24, round(l168, 4) AS load_lag168 FROM lagged""",
)
def load_lags_by_user(spark, folder):
    """Hourly lags on a large panel, from the day history."""
    out = hour_lags(load_profiles(spark, folder, "user_id"), ["series_id"], "load", [1, 24, 168])
    return rounded(out, 4, "load", "load_lag1", "load_lag24", "load_lag168").withColumn("date", iso("date"))


_STATS = [f"temperature_{s}_d{k}" for k in (1, 2) for s in ("mean", "max", "min")]


@query(
    "daily_lags",
    f"""WITH {TEMPERATURE_SQL},
daily AS (SELECT d, avg(temperature) AS mean, max(temperature) AS max, min(temperature) AS min FROM temps GROUP BY d),
lagged AS (SELECT d, {", ".join(f"lag({s}, {k}) OVER (ORDER BY d) AS temperature_{s}_d{k}"
                               for k in (1, 2) for s in ("mean", "max", "min"))} FROM daily)
SELECT CAST(t.d AS VARCHAR) AS date, t.h AS hour, {", ".join(f"round({n}, 6) AS {n}" for n in _STATS)}
FROM temps t JOIN lagged l ON l.d = t.d""",
)
def daily_lags(spark, folder):
    """Day statistics of the one and two days before; same-day values dropped."""
    days = temperature_profiles(spark, folder).withColumn("site", F.lit(0))
    days = days.withColumns(array_stats("temperature", "temperature"))
    names = ["temperature_mean", "temperature_max", "temperature_min"]
    lagged = lag_days(days, ["site"], names, [1, 2]).drop(*names, "site")
    hours = explode_hours(lagged, ("temperature",)).drop("temperature")
    return rounded(hours, 6, *_STATS).withColumn("date", iso("date"))


def _origin_sql(key: str) -> str:
    picks = ", ".join(f"max(CASE WHEN age = {i} THEN load END) AS lag{i}" for i in LOAD_LAGS)
    values = ", ".join(f"({i})" for i in LOAD_LAGS)
    return f"""WITH {grid_sql(key)},
ages AS (SELECT * FROM (VALUES {values}) v(age)),
anchors AS (SELECT series_id, t AS midnight, age, t - INTERVAL {OFFSET} HOUR - age * INTERVAL 1 HOUR AS src
            FROM grid CROSS JOIN ages WHERE h = 0),
wide AS (SELECT a.series_id, midnight, {picks}
         FROM anchors a LEFT JOIN grid g ON g.series_id = a.series_id AND g.t = a.src GROUP BY 1, 2)
SELECT g.series_id, CAST(g.d AS VARCHAR) AS date, g.h AS hour, round(g.load, 4) AS load,
       {", ".join(f"round(lag{i}, 4) AS lag{i}" for i in LOAD_LAGS)}
FROM grid g JOIN wide w ON w.series_id = g.series_id AND w.midnight = CAST(g.d AS TIMESTAMP)"""


def _origin_lags(spark, folder, key):
    days = add_origin_lags(load_profiles(spark, folder, key), ["series_id"], stats=())
    days = rounded(days, 4, *[f"lag{i}" for i in LOAD_LAGS]).withColumn("date", iso("date"))
    return rounded(explode_hours(days), 4, "load")


@query("origin_lags", _origin_sql("event_type"))
def origin_lags(spark, folder):
    """31 load lags counted back from the forecast origin."""
    return _origin_lags(spark, folder, "event_type")


@query("origin_lags_by_user", _origin_sql("user_id"))
def origin_lags_by_user(spark, folder):
    """J7, W6 on the large panel."""
    return _origin_lags(spark, folder, "user_id")


def _stats_sql(n: int) -> str:
    frame = f"(PARTITION BY series_id ORDER BY t ROWS BETWEEN {OFFSET + n - 1} PRECEDING AND {OFFSET} PRECEDING)"
    picks = ", ".join(
        f"CASE WHEN count(load) OVER {frame} = {n} THEN {f}(load) OVER {frame} END AS {out}_{n}h"
        for f, out in (("min", "min"), ("max", "max"), ("avg", "mean"))
    )
    return picks


_STAT_NAMES = [f"{s}_{n}h" for n in (24, 48) for s in ("min", "max", "mean")]


@query(
    "origin_stats_24_48",
    f"""WITH {grid_sql()},
stats AS (SELECT series_id, t, d, h, {_stats_sql(24)}, {_stats_sql(48)} FROM grid)
SELECT series_id, CAST(d AS VARCHAR) AS date, {", ".join(f"round({n}, 6) AS {n}" for n in _STAT_NAMES)}
FROM stats WHERE h = 0""",
)
def origin_stats(spark, folder):
    """Min, max and mean load over the 24 and 48 hours up to the origin."""
    days = add_origin_lags(load_profiles(spark, folder), ["series_id"], lags=(0,))
    out = rounded(days.drop("load", "lag0"), 6, *_STAT_NAMES)
    return out.withColumn("date", iso("date"))


_SG_TERMS = " + ".join(
    f"{w} * lag(load, {k}) OVER w" if k > 0 else f"{w} * lead(load, {-k}) OVER w" if k < 0 else f"{w} * load"
    for w, k in zip((-2, 3, 6, 7, 6, 3, -2), (3, 2, 1, 0, -1, -2, -3), strict=True)
)
_SG_EDGE = ((39, 8, -4, -4, 1, 4, -2), (8, 19, 16, 6, -4, -7, 4), (-4, 16, 19, 12, 2, -4, 1))


def _sg_edges(function: str, order: str) -> str:
    whens = []
    for r, weights in enumerate(_SG_EDGE):
        terms = []
        for j, w in enumerate(weights):
            step = j - r
            call = "load" if step == 0 else f"{'lead' if (step > 0) == (function == 'head') else 'lag'}(load, {abs(step)}) OVER w"
            terms.append(f"{w} * {call}")
        whens.append(f"WHEN {order} = {r + 1} THEN ({' + '.join(terms)}) / 42.0")
    return " ".join(whens)


@query(
    "savgol_smooth",
    f"""WITH {grid_sql()},
numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY t) AS rn,
                    row_number() OVER (PARTITION BY series_id ORDER BY t DESC) AS back FROM grid)
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour,
       round(CASE {_sg_edges("head", "rn")} {_sg_edges("tail", "back")} ELSE ({_SG_TERMS}) / 21.0 END, 6) AS smooth
FROM numbered WINDOW w AS (PARTITION BY series_id ORDER BY t)""",
)
def savgol(spark, folder):
    """Cubic smoothing over seven hours, edges included."""
    out = smooth_savgol(load_panel(spark, folder), ["series_id"], "load", width=24 * 7)
    return rounded(out.drop("load"), 6, "smooth").withColumn("date", iso("date"))


_FEATURES = [
    *_STATS, *_T_NAMES, *[f"lag{i}" for i in LOAD_LAGS], *_STAT_NAMES,
]

_WIDE_SQL = f"""
ages AS (SELECT * FROM (VALUES {", ".join(f"({i})" for i in LOAD_LAGS)}) v(age)),
anchors AS (SELECT series_id, t AS midnight, age, t - INTERVAL {OFFSET} HOUR - age * INTERVAL 1 HOUR AS src
            FROM grid CROSS JOIN ages WHERE h = 0),
lags AS (SELECT a.series_id, CAST(midnight AS DATE) AS d,
                {", ".join(f"max(CASE WHEN age = {i} THEN load END) AS lag{i}" for i in LOAD_LAGS)}
         FROM anchors a LEFT JOIN grid g ON g.series_id = a.series_id AND g.t = a.src GROUP BY 1, 2),
windows AS (SELECT series_id, t, d, h, {_stats_sql(24)}, {_stats_sql(48)} FROM grid),
stats AS (SELECT * FROM windows WHERE h = 0)"""


@query(
    "day_ahead_features",
    f"""WITH {grid_sql()}, {TEMPERATURE_SQL}, {_WIDE_SQL},
tdaily AS (SELECT d, avg(temperature) AS mean, max(temperature) AS max, min(temperature) AS min FROM temps GROUP BY d),
tstats AS (SELECT d, {", ".join(f"lag({s}, {k}) OVER (ORDER BY d) AS temperature_{s}_d{k}"
                               for k in (1, 2) for s in ("mean", "max", "min"))} FROM tdaily),
tlags AS (SELECT d, h, {_T_LAGS_SQL} FROM temps)
SELECT g.series_id, CAST(g.d AS VARCHAR) AS date, g.h AS hour, round(g.load, 4) AS load,
       CAST(dayofyear(g.d) AS INTEGER) AS day_of_year, CAST(isodow(g.d) - 1 AS INTEGER) AS weekday,
       {", ".join(f"CAST(isodow(g.d) = {w + 1} AS INTEGER) AS weekday_{w}" for w in range(7))},
       {", ".join(f"round({n}, 6) AS {n}" for n in _FEATURES)}
FROM grid g JOIN lags l ON l.series_id = g.series_id AND l.d = g.d
JOIN stats s ON s.series_id = g.series_id AND s.d = g.d
JOIN tstats t ON t.d = g.d JOIN tlags u ON u.d = g.d AND u.h = g.h
WHERE lag337 IS NOT NULL AND temperature_lag120 IS NOT NULL AND temperature_mean_d2 IS NOT NULL
  AND mean_48h IS NOT NULL""",
)
def day_ahead_features(spark, folder):
    """The next-day feature table: W1-W3, W6, W7, J5-J7, A3-A5, C4, C5, C13, F12-F14."""
    out = hourly_features(load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder))
    kept = ["series_id", "date", "hour", "load", "day_of_year", "weekday", *[f"weekday_{w}" for w in range(7)]]
    out = rounded(rounded(out, 6, *_FEATURES), 4, "load").withColumn("date", iso("date"))
    return out.select(*kept, *_FEATURES)


#: The regressors of the whole table in SQL: calendar, dummies, weather, load history.
_WHOLE = {
    **{f"month_{m}": f"CAST(month(g.d) = {m} AS INTEGER)" for m in range(1, 13)},
    **{f"weekday_{w}": f"CAST(isodow(g.d) = {w + 1} AS INTEGER)" for w in range(7)},
    "weekday": "isodow(g.d) - 1", "month": "month(g.d)", "day_of_month": "day(g.d)", "day_of_year": "dayofyear(g.d)",
    **{c: c for c in _FEATURES},
}


@query(
    "whole_table_fit",
    f"""WITH RECURSIVE {grid_sql("user_id")}, {TEMPERATURE_SQL}, {_WIDE_SQL},
tdaily AS (SELECT d, avg(temperature) AS mean, max(temperature) AS max, min(temperature) AS min FROM temps GROUP BY d),
tstats AS (SELECT d, {", ".join(f"lag({s}, {k}) OVER (ORDER BY d) AS temperature_{s}_d{k}"
                               for k in (1, 2) for s in ("mean", "max", "min"))} FROM tdaily),
tlags AS (SELECT d, h, {_T_LAGS_SQL} FROM temps),
wide AS (SELECT g.series_id, g.d, g.h, ln(g.load + 1) AS y, {", ".join(f"CAST({x} AS DOUBLE) AS x{i}" for i, x in enumerate(_WHOLE.values()))}
  FROM grid g JOIN lags l ON l.series_id = g.series_id AND l.d = g.d
  JOIN stats s ON s.series_id = g.series_id AND s.d = g.d
  JOIN tstats t ON t.d = g.d JOIN tlags u ON u.d = g.d AND u.h = g.h
  WHERE lag337 IS NOT NULL AND temperature_lag120 IS NOT NULL AND temperature_mean_d2 IS NOT NULL AND mean_48h IS NOT NULL),
{projection_sql("wide", "h", "{'series_id': series_id, 'd': d}", len(_WHOLE))}
SELECT r.series_id AS series_id, CAST(r.d AS VARCHAR) AS date, CAST(g AS INTEGER) AS hour, round(exp(fitted) - 1, 4) AS fitted FROM projected""",
)
def whole_table_fit(spark, folder):
    """One model per hour on every column of the feature table, pooled over the users, and its fitted values.
    The dummies add up to one, the weather is the same for all users and some columns are constant: the fit finds the rank."""
    rows = hourly_features(load_profiles(spark, folder, "user_id"), ["series_id"], temperature_profiles(spark, folder))
    features = feature_columns(rows)
    if set(features) != set(_WHOLE):
        raise ValueError(f"other columns: {set(features) ^ set(_WHOLE)}")
    fitted = predict_load(rows, fit_load(rows, ["hour"], features, shift=1.0), ["hour"], features, shift=1.0)
    return rounded(fitted.select("series_id", iso("date").alias("date"), "hour", F.col("prediction").alias("fitted")), 4, "fitted")


_M_T = [f"temperature_lag{k}" for k in MULTI_DAY_TEMPERATURE_LAGS]


@query(
    "multi_day_features",
    f"""WITH {grid_sql()}, {TEMPERATURE_SQL}, {_WIDE_SQL},
js AS (SELECT CAST(unnest(generate_series(1, 14)) AS INTEGER) AS horizon),
tlags AS (SELECT d, h, {", ".join(f"lag(temperature, {k}) OVER (ORDER BY t) AS temperature_lag{k}"
                                 for k in MULTI_DAY_TEMPERATURE_LAGS)} FROM temps)
SELECT l.series_id, CAST(l.d AS VARCHAR) AS issue_date, horizon, CAST(g.d AS VARCHAR) AS date, g.h AS hour,
       round(g.load, 4) AS load, round(lag0, 4) AS lag0, round(lag24, 4) AS lag24, round(lag337, 4) AS lag337,
       round(mean_24h, 6) AS mean_24h, {", ".join(f"round({n}, 6) AS {n}" for n in _M_T)}
FROM lags l CROSS JOIN js JOIN grid g ON g.series_id = l.series_id AND g.d = l.d + (horizon - 1)
JOIN stats s ON s.series_id = l.series_id AND s.d = l.d
JOIN tlags u ON u.d = g.d AND u.h = g.h
WHERE lag337 IS NOT NULL AND temperature_lag99 IS NOT NULL AND mean_48h IS NOT NULL""",
)
def multi_day_features(spark, folder):
    """M3, J7, W1 for 14 horizons at once: load seen from the issue day, weather of the target hour."""
    out = hourly_features(load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder),
                          horizons=14, temperature_lags=MULTI_DAY_TEMPERATURE_LAGS, dummies=False)
    out = rounded(rounded(out, 6, "mean_24h", *_M_T), 4, "load", "lag0", "lag24", "lag337")
    out = out.withColumns({"issue_date": iso("issue_date"), "date": iso("date")})
    return out.select("series_id", "issue_date", "horizon", "date", "hour", "load", "lag0", "lag24", "lag337",
                      "mean_24h", *_M_T)


# Noise is random, but some facts of it are not: none before horizon 7; from there on mean and variance within five
# standard errors of 0 and of horizon - 6.
@query(
    "noise_horizon",
    f"""WITH {TEMPERATURE_SQL},
js AS (SELECT CAST(unnest(generate_series(1, 14)) AS INTEGER) AS horizon),
ends AS (SELECT max(d) AS last FROM temps)
SELECT horizon, (SELECT count(DISTINCT d) FROM temps) * 24 - (horizon - 1) * 24 AS n, 1 AS mean_fits, 1 AS variance_fits,
       round(avg(temperature), 8) AS temperature
FROM js JOIN temps ON temps.d >= (SELECT min(d) FROM temps) + (horizon - 1) GROUP BY 1""",
)
def noise_horizon(spark, folder):
    """C17: moments of the temperature noise per horizon (variance grows from horizon 7 on)."""
    days = temperature_profiles(spark, folder).withColumn("site", F.lit(0))
    spread = spread_horizons(days, ["site"], ["temperature"], 14)
    hours = explode_hours(spread, ("temperature",))
    noisy = hours.withColumn("noise", horizon_noise(F.col("horizon"), 1304, F.col("date"), F.col("hour")))
    out = noisy.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n"), F.avg("noise").alias("mean"), F.var_pop("noise").alias("variance"),
        F.avg("temperature").alias("temperature"))
    steps = F.greatest(F.col("horizon") - 6, F.lit(0))
    return rounded(out.select(
        "horizon", "n", (F.abs("mean") <= 5 * F.sqrt(steps / F.col("n"))).cast("int").alias("mean_fits"),
        (F.abs(F.col("variance") - steps) <= 5 * steps * F.sqrt(2 / F.col("n"))).cast("int").alias("variance_fits"),
        "temperature"), 8, "temperature")


@query(
    "multi_day_noised_features",
    f"""WITH {grid_sql()}, {TEMPERATURE_SQL}, {_WIDE_SQL},
js AS (SELECT CAST(unnest(generate_series(1, 14)) AS INTEGER) AS horizon),
tlags AS (SELECT d, h, {", ".join(f"lag(temperature, {k}) OVER (ORDER BY t) AS temperature_lag{k}"
                                 for k in MULTI_DAY_TEMPERATURE_LAGS)} FROM temps)
SELECT horizon, count(*) AS n, round(avg(mean_24h), 8) AS mean_24h,
       CASE WHEN horizon < 7 THEN round(avg(temperature_lag3), 8) END AS temperature_lag3, 1 AS noise_fits
FROM lags l CROSS JOIN js JOIN grid g ON g.series_id = l.series_id AND g.d = l.d + (horizon - 1)
JOIN stats s ON s.series_id = l.series_id AND s.d = l.d
JOIN tlags u ON u.d = g.d AND u.h = g.h
WHERE lag337 IS NOT NULL AND temperature_lag99 IS NOT NULL AND mean_48h IS NOT NULL GROUP BY 1""",
)
def multi_day_noised(spark, folder):
    """C17, M3: the 14-horizon feature table with weather noise from horizon 7 on, next to the one without."""

    def table_of(seed):
        return hourly_features(load_profiles(spark, folder), ["series_id"], temperature_profiles(spark, folder),
                               horizons=14, temperature_lags=MULTI_DAY_TEMPERATURE_LAGS, noise_seed=seed, dummies=False)

    key = ["series_id", "issue_date", "horizon", "date", "hour"]
    clean = table_of(None).select(*key, F.col("temperature_lag3").alias("clean"))
    both = table_of(1304).select(*key, "temperature_lag3", "mean_24h").join(clean, key)
    out = both.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n"), F.avg("mean_24h").alias("mean_24h"), F.avg("temperature_lag3").alias("t"),
        F.avg(F.col("temperature_lag3") - F.col("clean")).alias("mean"),
        F.var_pop(F.col("temperature_lag3") - F.col("clean")).alias("variance"))
    steps = F.greatest(F.col("horizon") - 6, F.lit(0))
    # all series share the weather, and with it the noise of an hour only by chance: the rows count as hours
    fits = (F.abs("mean") <= 5 * F.sqrt(5 * steps / F.col("n"))) & (
        F.abs(F.col("variance") - steps) <= 5 * steps * F.sqrt(10 / F.col("n")))
    facts = out.select("horizon", "n", "mean_24h", F.when(F.col("horizon") < 7, F.col("t")).alias("temperature_lag3"),
                       fits.cast("int").alias("noise_fits"))
    return rounded(facts, 8, "mean_24h", "temperature_lag3")
