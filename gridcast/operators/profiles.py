"""Day profiles: 24 hourly values per key and date in one array.

Raw readings go to profiles in one aggregate with map-side combine.  All
operators that look back or ahead in time run on profiles with one window
specification (``keys`` / ``date``), so a whole feature table needs a single
sort.  A window group holds one row per calendar day of one series: its size is
bounded by the calendar (366 rows per year), never by the number of readings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOURS = range(24)


def day_profiles(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    date: Column | str = "date",
    hour: Column | str = "hour",
    how: str = "sum",
) -> DataFrame:
    """One row per key and date with, for each value, its 24 hourly totals (or means).

    Hours without readings are null; readings without a key or date belong to no series.
    """
    date = F.col(date) if isinstance(date, str) else date
    hour = F.col(hour) if isinstance(hour, str) else hour
    if how not in ("sum", "avg", "min", "max"):
        raise ValueError(f"how must be 'sum', 'avg', 'min' or 'max', not {how!r}")
    base = df.select(*keys, date.alias("date"), hour.cast("int").alias("_h"),
                     *[v.cast("double").alias(f"_{n}") for n, v in values.items()])
    # stated here, so that every later join finds the same scan and reuses its shuffle
    for c in (*keys, "date"):
        base = base.filter(F.col(c).isNotNull())
    slots = {n: ", ".join(f"{how}(CASE WHEN _h = {h} THEN `_{n}` END)" for h in HOURS) for n in values}
    return base.groupBy(*keys, "date").agg(*[F.expr(f"array({s})").alias(n) for n, s in slots.items()])


def by_date(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("date")


def fill_days(
    profiles: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = ("load",),
    fill: str = "zero",
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Gap-free days from the first (or ``start``) to the last date (or ``end``).

    ``end`` beyond the last reading gives the future skeleton of a forecast.
    Missing hours become 0 (``zero``), the last known value (``ffill``) or stay
    null (``null``).  Each present day carries the missing days that follow it,
    so there is no skeleton table and no join.
    """
    if fill not in ("zero", "null", "ffill"):
        raise ValueError(f"fill must be 'zero', 'null' or 'ffill', not {fill!r}")
    w = by_date(keys)
    edges = {"_first": F.lag("date").over(w).isNull(), "_follow": F.lead("date").over(w)}
    if fill == "ffill":
        for c in columns:
            known = F.expr(f"try_element_at(filter(`{c}`, x -> x IS NOT NULL), -1)")
            edges[f"_own_{c}"] = known
            edges[f"_carry_{c}"] = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    begin = F.col("date") if start is None else F.when(F.col("_first"), F.least(start, "date")).otherwise(F.col("date"))
    stop = F.coalesce(F.date_sub("_follow", 1), F.col("date") if end is None else F.greatest(end, "date"))
    spans = profiles.withColumns(edges).withColumns({"_begin": begin, "_stop": stop})
    days = spans.withColumn("_day", F.explode(F.sequence("_begin", "_stop")))

    empty = "array_repeat(CAST(NULL AS DOUBLE), 24)"
    if fill == "ffill":
        # the day's known slots as (hour, value), led by the value carried into the day
        for c in columns:
            before = f"CASE WHEN _day > date THEN coalesce(`_own_{c}`, `_carry_{c}`) WHEN _day = date THEN `_carry_{c}` END"
            slots = f"transform(`{c}`, (x, i) -> struct(i AS h, x AS v))"
            known = f"CASE WHEN _day = date THEN filter({slots}, s -> s.v IS NOT NULL) ELSE array() END"
            days = days.withColumn(f"_known_{c}", F.expr(f"concat(array(struct(0 AS h, {before} AS v)), {known})"))

    def filled(c):
        if fill == "null":
            return f"CASE WHEN _day = date THEN `{c}` ELSE {empty} END"
        if fill == "zero":
            return f"CASE WHEN _day = date THEN transform(`{c}`, x -> coalesce(x, 0D)) ELSE array_repeat(0D, 24) END"
        until = f"coalesce(get(`_known_{c}`, i + 1).h, 24)"
        return f"flatten(transform(`_known_{c}`, (s, i) -> array_repeat(s.v, {until} - s.h)))"

    rest = [f"`{c}`" for c in profiles.columns if c not in (*keys, "date", *columns)]
    names = [f"`{k}`" for k in keys]
    return days.selectExpr(*names, "_day AS date", *[f"{filled(c)} AS `{c}`" for c in columns], *rest)


def fill_profiles(profiles: DataFrame, column: str) -> DataFrame:
    """Every date from the first to the last of profiles keyed by ``date`` alone; an added day has 24 nulls."""
    span = profiles.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a IS NOT NULL")
    axis = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    empty = F.expr("array_repeat(CAST(NULL AS DOUBLE), 24)")
    return axis.join(profiles, "date", "left").select("date", F.coalesce(column, empty).alias(column))


def explode_hours(profiles: DataFrame, columns: Sequence[str] = ("load",)) -> DataFrame:
    """Profiles to a panel: one row per hour, array columns become scalars."""
    rest = [f"`{c}`" for c in profiles.columns if c not in columns]
    hours = profiles.selectExpr("*", "explode(sequence(0, 23)) AS hour")
    return hours.selectExpr(*rest, "hour", *[f"get(`{c}`, hour) AS `{c}`" for c in columns])


def hourly_grid(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    date: Column | str = "date",
    hour: Column | str = "hour",
    how: str = "sum",
    fill: str = "zero",
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Readings of any granularity to a gap-free hourly panel with a ``load`` column."""
    days = day_profiles(df, keys, {"load": value}, date, hour, how)
    return explode_hours(fill_days(days, keys, ("load",), fill, start, end))


def history(column: str, keys: Sequence[str], days: int) -> Column:
    """The ``days`` previous profiles and the current one, flattened, oldest first.

    Needs gap-free days.  The value ``n`` hours before the day's 00:00 is the
    ``hours_before(history, n)``.
    """
    return F.flatten(F.collect_list(column).over(by_date(keys).rowsBetween(-days, 0)))


def hours_before(past: str, n: int | str) -> str:
    """SQL text of the value ``n`` hours before 00:00 of the current day (negative: after).

    ``n`` is a number or an SQL expression; ``past`` a ``history`` column.
    """
    return f"try_element_at({past}, -({n} + 24))"


def day_before(past: str, hours: int) -> str:
    """SQL text of the 24 values ``hours`` hours before those of the current day; null where the history does not reach.

    ``past`` is a ``history`` column that ends with the current day.
    """
    return f"slice(concat(array_repeat(CAST(NULL AS DOUBLE), 24), {past}), -{hours + 24}, 24)"


def hour_lags(profiles: DataFrame, keys: Sequence[str], column: str, lags: Sequence[int]) -> DataFrame:
    """The hourly panel of gap-free profiles with ``<column>_lag<k>``, the value ``k`` hours earlier.

    The window runs over days; hours are exploded last.
    """
    past = profiles.withColumn("_past", history(column, keys, days_needed(max(lags))))
    hours = explode_hours(past, (column,))
    out = [f"{hours_before('_past', f'{k} - hour')} AS `{column}_lag{k}`" for k in lags]
    return hours.selectExpr(*[f"`{c}`" for c in hours.columns if c != "_past"], *out)


def days_needed(hours: int) -> int:
    return -(-hours // 24)


# -- daily statistics --------------------------------------------------------


def array_stats(values: str, prefix: str, suffix: str = "") -> dict[str, Column]:
    """Mean, max and min of the non-null elements of an array (an SQL expression)."""
    known = f"filter({values}, x -> x IS NOT NULL)"
    total = f"aggregate({known}, 0D, (acc, x) -> acc + x)"
    return {
        f"{prefix}_mean{suffix}": F.expr(f"try_divide({total}, size({known}))"),
        f"{prefix}_max{suffix}": F.expr(f"array_max({known})"),
        f"{prefix}_min{suffix}": F.expr(f"array_min({known})"),
    }


def lag_days(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], days: Sequence[int]
) -> DataFrame:
    """``<column>_d<k>``: the value ``k`` days earlier, on a gap-free daily table."""
    w = by_date(keys)
    return df.withColumns({f"{c}_d{k}": F.lag(c, k).over(w) for c in columns for k in days})
