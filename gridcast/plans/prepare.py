"""From a folder of text feeds to the prepared feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.functions.clock import day_number
from gridcast.operators.align import fill_dates, join_daily, one_per_date
from gridcast.operators.daytypes import FOUR_YEARS, add_bridge_days, add_calendar, add_dummies, flag_holidays
from gridcast.operators.lags import HaloWindow
from gridcast.operators.profiles import day_profiles, explode_hours, fill_days, fill_profiles
from gridcast.operators.readings import (
    dedup_first,
    drop_incomplete,
    drop_outliers,
    harmonise,
    mean_of_slots,
    on_the_hour,
)
from gridcast.plans.features import (
    DAY_AHEAD_TEMPERATURE_LAGS,
    MULTI_DAY_TEMPERATURE_LAGS,
    day_types,
    hourly_features,
)
from gridcast.sources.feeds import LONG_TERM_SEPARATORS, read_sources

KEYS = ["series_id"]
SLOTS = tuple(f"slot{i}" for i in range(6))

# Published names of the prepared columns.
PUBLISHED_NAMES = {
    "date": "Date", "hour": "Heure", "load": "Consommation",
    "year": "annee", "month": "mois", "day_of_month": "jour_mois", "day_of_year": "jour_annee", "weekday": "jour_semaine",
    "sun_rise": "Rise", "sun_down": "Down", "sun_last": "Last",
    "august": "Aout", "christmas": "Noel", "bank_holiday": "Feriers", "school": "Vacances", "variable": "Var",
    "off_work": "Proba_out_of_work", "bridge": "Pont", "holiday": "jf_dates",
    "min_24h": "Consommation_Min_J-1", "max_24h": "Consommation_Max_J-1", "mean_24h": "Consommation_Mean_J-1",
    "min_48h": "Consommation_Min_J-2", "max_48h": "Consommation_Max_J-2", "mean_48h": "Consommation_Mean_J-2",
    "year_squared": "annee_carre", "trend": "Consommation_linear_reg", "prediction": "Predictions",
    "neutral_load": "Consommation 16 degre", "climate_part": "Part climatique",
}


def published_names(df: DataFrame) -> DataFrame:
    """Columns renamed to their published names (lags, day statistics and dummies by pattern)."""

    def name(column):
        if column in PUBLISHED_NAMES:
            return PUBLISHED_NAMES[column]
        stem, _, last = column.rpartition("_")
        if column.startswith("lag") and column[3:].isdigit():
            return f"Lag{column[3:]}"
        if column.startswith("temperature_lag"):
            return column.replace("_lag", "_Lag")
        if column.startswith("temperature_") and last in ("d1", "d2"):
            return f"temperature_{stem.split('_')[1].capitalize()}J-{last[1]}"
        if stem in ("month", "weekday"):
            return f"{PUBLISHED_NAMES[stem]}_{last}"
        return column

    return df.toDF(*[name(c) for c in df.columns])


def _of_series(df: DataFrame, series: str) -> DataFrame:
    """``series_id`` of the folder the rows come from, else ``series``."""
    return df if "series_id" in df.columns else df.withColumn("series_id", F.lit(series))


def _ten_minutes(feed: DataFrame) -> DataFrame:
    means = on_the_hour(mean_of_slots(feed, SLOTS))
    return means.select(*KEYS, "date", F.col("hour").cast("int").alias("hour"), "load", "_line")


def hourly_loads(feed: DataFrame, series: str = "all") -> DataFrame:
    """Ten-minute rows to one load per series, date and hour; the first of repeated hours with a load wins."""
    return _first_known(_ten_minutes(_of_series(feed, series)), ["_line"]).drop("_line")


def _first_known(loads: DataFrame, order: list[str]) -> DataFrame:
    """The first row per hour by ``order``, rows without a load last."""
    return dedup_first(loads, [*KEYS, "date", "hour"], [F.col("load").isNull(), *order])


def mixed_loads(feed: DataFrame, series: str = "all") -> DataFrame:
    """Half-hour rows of the older years and ten-minute rows of the later ones as hourly loads.

    A row is of the half-hour feed where the last slot is empty.  Where both feeds have an hour, the half-hour feed,
    which comes first, wins; an unknown load never does.  Lines without a date or hour are left out.  One pass.
    """
    rows = _of_series(feed, series).withColumns({"_half": F.col(SLOTS[-1]).isNull(), "_single": F.col(SLOTS[0])})
    rows = mean_of_slots(rows, SLOTS)
    rows = rows.withColumn("load", F.when(F.col("_half"), F.col("_single")).otherwise(F.col("load")))
    rows = rows.filter(F.col("_half") | (F.col("hour") == F.floor("hour")))
    rows = rows.select(*KEYS, "date", "hour", "_half", "load", "_line")
    first = dedup_first(rows, [*KEYS, "date", "hour", "_half"], [F.col("load").isNull(), "_line"])
    return harmonise(first, KEYS, "_half").withColumn("hour", F.col("hour").cast("int"))


def _daily(types: DataFrame, sun: DataFrame) -> DataFrame:
    """One row per date with day types, off-work probability, bridge flag and sun times.

    Neighbours are looked up on a gap-free axis: a day next to an unknown one has no bridge flag of its own making.
    """
    per_day = fill_dates(one_per_date(types.drop("hour")))
    return day_types(per_day).join(one_per_date(sun), "date")


def prepare_short_term(
    spark: SparkSession, root: str, kind: str = "day_ahead", series: str = "all", horizons: int = 14,
    noise_seed: int | None = 1304, until: str | None = None, **options,
) -> DataFrame:
    """Feature table of the next-day, multi-day or climate job from the feeds under ``root``.

    Feeds are aligned by date and hour; of repeated rows the first in the files stays, and what follows a missing day
    is unknown, not shifted.  Days without sun times or day types drop out with the incomplete rows.  ``until`` adds
    the days after the last load, up to that date, with a null load: the rows to forecast before actuals exist.
    ``sites=True`` takes one series per folder of load files.
    """
    src = read_sources(spark, root, **options)
    load = hourly_loads(src["load"], series)
    end = None if until is None else F.lit(until).cast("date")
    days = fill_days(day_profiles(load, KEYS, {"load": F.col("load")}, how="max"), KEYS, fill="null", end=end)
    hourly = dedup_first(src["temperature"], ["date", "hour"], ["_line"])
    weather = fill_profiles(day_profiles(hourly, [], {"temperature": F.col("temperature")}, how="max"), "temperature")
    daily = _daily(src["daytype"], src["sun"])
    if kind == "day_ahead":
        plan = dict(temperature_lags=DAY_AHEAD_TEMPERATURE_LAGS)
    elif kind == "multi_day":
        plan = dict(temperature_lags=MULTI_DAY_TEMPERATURE_LAGS, horizons=horizons, noise_seed=noise_seed)
    elif kind == "climate":
        plan = dict(temperature_lags=MULTI_DAY_TEMPERATURE_LAGS, temperature_days=(), lags=(), stats=(),
                    same_hour_temperature=True)
    else:
        raise ValueError(f"kind must be 'day_ahead', 'multi_day' or 'climate', not {kind!r}")
    return hourly_features(days, KEYS, weather, daily, online=until is not None, **plan)


def prepare_long_term(
    spark: SparkSession, root: str, until: str, series: str = "all", low: float = 25000.0,
    low_before: str = "2016-01-01", **options,
) -> DataFrame:
    """Feature table of the three-year job: history and future hours up to ``until``.

    The future begins after a series' last reading and has load 0; it needs sun times and temperatures, which may
    reach beyond the last load file.  Loads under ``low`` dated before ``low_before`` are taken for outages and
    dropped.
    """
    options = {"separators": LONG_TERM_SEPARATORS, **options}
    src = read_sources(spark, root, kinds=("load", "sun", "temperature"), hourly_temperature=False, ahead=True, **options)
    load = mixed_loads(src["load"], series)
    profiles = day_profiles(load, KEYS, {"load": F.col("load")}, how="max")
    # the days that the fill adds after a series' last reading are the future
    marked = profiles.withColumn("_last", F.max("date").over(Window.partitionBy(*KEYS)))
    hours = explode_hours(fill_days(marked, KEYS, fill="null", end=F.lit(until).cast("date")))
    future = F.when(F.col("date") > F.col("_last"), F.lit(0.0)).otherwise(F.col("load"))
    hours = hours.withColumn("load", future).drop("_last")

    days = fill_dates(one_per_date(src["temperature"]))
    lags = {f"temperature_lag{k}": (lambda w, k=k: F.lag("temperature", k).over(w)) for k in range(1, 5)}
    daily = HaloWindow([], day_number(F.col("date")), FOUR_YEARS, before=4).select(days, lags)
    daily = add_bridge_days(daily, F.weekday("date").isin(5, 6)).join(one_per_date(src["sun"]), "date")
    daily = flag_holidays(add_dummies(add_calendar(daily)))
    rows = drop_incomplete(join_daily(hours, daily))
    return drop_outliers(rows, "load", low, low_before)
