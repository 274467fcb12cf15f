"""The feature table of the short-term forecasts.

Load and temperature profiles go in, one row per issue day, horizon and target
hour comes out.  Everything between is one window specification over day rows:
two shuffles in all (readings to days, days to series order), whatever the
number of lags and horizons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.clock import day_number, hour_number
from gridcast.functions.noise import horizon_noise
from gridcast.operators.align import join_daily
from gridcast.operators.daytypes import FOUR_YEARS, add_bridge_days, add_calendar, add_dummies, off_work_probability
from gridcast.operators.lags import HaloWindow
from gridcast.operators.origins import LOAD_LAGS, OFFSET, STAT_HOURS, add_origin_lags, spread_horizons
from gridcast.operators.profiles import array_stats, day_before, days_needed, explode_hours, history
from gridcast.operators.readings import drop_incomplete

# Temperature lags in hours before the target hour.
DAY_AHEAD_TEMPERATURE_LAGS = (3, 6, 9, 12, 15, 18, 21, 24, 48, 96, 120)
MULTI_DAY_TEMPERATURE_LAGS = (3, 6, 9, 12, 15, 18, 21, 48, 51, 96, 99)


def _day_stats(past: str, days: Sequence[int]) -> dict[str, Column]:
    """Mean, max and min of the temperature of whole earlier days."""
    out = {}
    for k in days:
        out |= array_stats(f"slice({past}, -{24 * (k + 1)}, 24)", "temperature", f"_d{k}")
    return out


def _noised(past: Column, keys: Sequence[str], seed: int) -> Column:
    """Temperature history as a forecast would have it: noise grows from horizon 7 on."""
    last = hour_number(F.col("date"), F.lit(23))
    size = F.size(past)
    id_ = [F.col(k) for k in keys]
    noisy = F.transform(past, lambda x, i: x + horizon_noise(F.col("horizon"), seed, *id_, last - size + 1 + i))
    return F.when(F.col("horizon") < 7, past).otherwise(noisy)


def weather_by_date(temperature: DataFrame, reach: int) -> DataFrame:
    """``_weather``: the temperatures of the ``reach`` days before each date and of the date itself."""
    halo = HaloWindow([], day_number(F.col("date")), FOUR_YEARS, before=reach)
    past = {"_weather": lambda w: F.flatten(F.collect_list("temperature").over(w.rowsBetween(-reach, 0)))}
    return halo.select(temperature, past).drop("temperature")


def hourly_features(
    load: DataFrame,
    keys: Sequence[str],
    temperature: DataFrame | None = None,
    daily: DataFrame | None = None,
    horizons: int = 1,
    offset: int = OFFSET,
    lags: Sequence[int] = LOAD_LAGS,
    stats: Sequence[int] = STAT_HOURS,
    temperature_lags: Sequence[int] = DAY_AHEAD_TEMPERATURE_LAGS,
    temperature_days: Sequence[int] = (1, 2),
    noise_seed: int | None = None,
    same_hour_temperature: bool = False,
    dummies: bool = True,
    online: bool = False,
) -> DataFrame:
    """Feature panel: one row per ``keys, issue_date, horizon, date, hour``.

    ``load`` and ``temperature`` are gap-free profiles; temperature is keyed by
    ``date``, or by series as well.  ``daily`` has one row per date with sun times
    and day types; with ``off`` (off-work probability) in it, bridge days are
    derived before.  Rows with a null feature are dropped; ``online`` keeps rows
    whose load is not known yet.

    Weather lags count from the target hour: they take the weather forecast as
    given.  Load features only use hours up to the origin.
    """
    keys = list(keys)
    days = load
    target = ["load"]
    shared = temperature is not None and not set(keys) <= set(temperature.columns)
    reach = max([days_needed(k) for k in temperature_lags] + list(temperature_days) + [0])
    if temperature is not None and not shared:
        # weather of each series: its history rides along with the load
        days = days.join(temperature, [*keys, "date"], "left")
        days = days.withColumn("temperature", F.expr("coalesce(temperature, array_repeat(CAST(NULL AS DOUBLE), 24))"))
        days = days.withColumn("_weather", history("temperature", keys, reach)).drop("temperature")
        target.append("_weather")
    if lags or stats:
        days = add_origin_lags(days, keys, "load", lags, offset, stats)
    days = spread_horizons(days, keys, target, horizons)
    if shared:
        # one weather for all series: a small table by date, attached to the target day
        days = join_daily(days, weather_by_date(temperature, reach), ["date"], "left")
    if temperature is not None:
        if noise_seed is not None:
            days = days.withColumn("_weather", _noised(F.col("_weather"), keys, noise_seed))
        days = days.withColumns(_day_stats("_weather", temperature_days))
    if daily is not None:
        days = join_daily(days, daily, ["date"], "left")
    days, weather = add_calendar(days), {}
    if temperature is not None:
        # cut out once for a day, so that an hour only picks its place
        weather = {f"temperature_lag{k}": day_before("_weather", k) for k in temperature_lags}
        if same_hour_temperature:
            weather["temperature"] = day_before("_weather", 0)
        days = days.selectExpr("*", *[f"{v} AS {n}" for n, v in weather.items()]).drop("_weather")
    rows = explode_hours(days, ("load", *weather))
    if dummies:
        rows = add_dummies(rows)
    return drop_incomplete(rows, [c for c in rows.columns if not (online and c == "load")])


def feature_columns(df: DataFrame, keys: Sequence[str] = ("series_id",), y: str = "load") -> list[str]:
    """The regressors of a feature table: everything but keys, time, target and the year."""
    aside = {*keys, "issue_date", "horizon", "date", "hour", "year", y}
    return [c for c in df.columns if c not in aside]


def day_types(daily: DataFrame, mode: str = "as_coded") -> DataFrame:
    """Off-work probability and bridge flag of a gap-free day-type table (one row per date)."""
    c = F.col
    wide = daily.withColumn(
        "off_work",
        off_work_probability(F.weekday("date"), c("christmas"), c("august"), c("bank_holiday"), c("school")),
    )
    return add_bridge_days(wide, c("off_work") > 0, mode=mode, probability="off_work")
