"""From raw readings of mixed granularity to one value per hour."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mean_of_slots(df: DataFrame, slots: Sequence[str], out: str = "load") -> DataFrame:
    """Replace sub-hour slot columns by the mean of those that are not null."""
    present = F.filter(F.array(*[F.col(s) for s in slots]), lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)
    keep = [c for c in df.columns if c not in set(slots) - {out}]
    mean = F.when(F.size(present) > 0, total / F.size(present))
    return df.withColumn(out, mean).select(*keep, *([] if out in keep else [out]))


def split_by_slot(df: DataFrame, slot: str) -> tuple[DataFrame, DataFrame]:
    """Rows that fill ``slot`` (ten-minute feed) and rows that don't (half-hour feed)."""
    return df.filter(F.col(slot).isNotNull()), df.filter(F.col(slot).isNull())


def drop_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the columns that hold no null (one aggregate, one row to the driver)."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in df.columns]).first()
    return df.select([c for c in df.columns if c in keep or counts[c] == counts["_n"]])


def on_the_hour(df: DataFrame, hour: str = "hour") -> DataFrame:
    return df.filter(F.col(hour) == F.floor(hour))


#: Least value and number of values of the types that ``_rank`` packs.
_INTEGRAL = {"boolean": (0, 2), **{f"{name}int": (-(1 << bits - 1), 1 << bits)
                                    for name, bits in (("tiny", 8), ("small", 16), ("", 32), ("big", 64))}}
_LARGEST = 10 ** 38


def _rank(df: DataFrame, order: Sequence[Column]) -> Column | None:
    """One decimal that sorts as the whole numbers of ``order`` do, unknown ones first; None where they need over 38 digits
    or are no whole numbers."""
    rank, values = None, 1
    for column, kind in zip(order, df.select(*order).schema, strict=True):
        name = kind.dataType.simpleString()
        if isinstance(kind.dataType, T.DecimalType) and kind.dataType.scale == 0:
            least, many = 1 - 10 ** kind.dataType.precision, 2 * 10 ** kind.dataType.precision - 1
        elif name in _INTEGRAL:
            least, many = _INTEGRAL[name]
        else:
            return None
        many, values = many + 1, values * (many + 1)  # and the unknown
        if values > _LARGEST or many > _LARGEST // 10:
            return None
        number = (column.cast("int") if name == "boolean" else column).cast("decimal(38,0)")
        place = F.coalesce(number - F.lit(Decimal(least - 1)), F.lit(Decimal(0))).cast("decimal(38,0)")
        rank = place if rank is None else (rank * F.lit(Decimal(many)) + place).cast("decimal(38,0)")
    return rank


def _fixed_width(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key by ``order``; of rows that are equal in it, any one.

    A ``min_by`` aggregate and not a row number: duplicates collapse on the map side, so a key that holds a third of all
    rows costs no more than the others.  Where the other columns have a fixed width and the order is of whole numbers, as
    with feeds, it is a hash aggregate; texts make Spark sort the rows of a task first.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = _rank(df, order) if all(_fixed_width(df.schema[c].dataType) for c in rest) else None
    if rank is None:
        first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
        return first.select(*keys, "_first.*").select(df.columns)
    # all columns see the same ranks in the same order, so that their values are those of one row
    ranked = df.withColumn("_rank", rank)
    return ranked.groupBy(*keys).agg(*[F.min_by(c, "_rank").alias(c) for c in rest]).select(df.columns)


def _days_of_readings(df: DataFrame, keys: Sequence[str], half: Column, load: str) -> DataFrame:
    """One row per key and date: its half-hour readings and its ten-minute means as (hour, load) in time order."""
    reading = F.struct(F.col("hour").cast("double").alias("hour"), F.col(load).cast("double").alias("load"))
    dated = df.filter(F.col("date").isNotNull() & F.col("hour").isNotNull())
    return dated.groupBy(*keys, "date").agg(
        F.sort_array(F.collect_list(F.when(half, reading))).alias("_half"),
        F.sort_array(F.collect_list(F.when(~half, reading))).alias("_ten"),
    )


def _full(reading: Column) -> Column:
    return reading["hour"] == F.floor(reading["hour"])


def _pair_days(days: DataFrame, keys: Sequence[str], closing: Column) -> DataFrame:
    """``days`` with ``_hours``: the full-hour readings of ``_half``, each the mean of itself and the next reading.

    ``closing`` is (date, load) on the days that have it; the earliest of a series completes its last full hour.

    Pairs are made inside the day's array; only the next day with half hours is looked up, by a window over days.
    """
    by_day = Window.partitionBy(*keys).orderBy("date")
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    halves, size = F.col("_half"), F.size("_half")
    head = F.when(size > 0, F.struct(F.get(halves, F.lit(0))["load"].alias("load")))
    tail = F.when(size > 0, F.struct("date", F.get(halves, size - 1)["load"].alias("load")))
    days = days.withColumns({"_head": head, "_opening": closing})
    days = days.withColumns({
        "_closing": F.min("_opening").over(whole)["load"],
        "_follow": F.expr("lead(_head) IGNORE NULLS").over(by_day)["load"],
        "_tail": F.max(tail).over(whole)["load"],
        "_last_day": F.max(F.when(F.exists(halves, _full), F.col("date"))).over(whole),
        "_last_hour": F.array_max(F.transform(F.filter(halves, _full), lambda x: x["hour"])),
    })

    def paired(x, i):
        following = F.when(i + 1 < size, F.get(halves, i + 1)["load"]).otherwise(F.col("_follow"))
        last = (F.col("date") == F.col("_last_day")) & (x["hour"] == F.col("_last_hour"))
        closed = F.when(last, (F.col("_tail") + F.col("_closing")) / 2)
        return F.struct(x["hour"].alias("hour"), F.coalesce(closed, (x["load"] + following) / 2, x["load"]).alias("load"))

    return days.withColumn("_hours", F.filter(F.transform(halves, paired), _full))


def pair_half_hours(
    df: DataFrame, keys: Sequence[str], load: str = "load", closing: DataFrame | None = None
) -> DataFrame:
    """Half-hour readings to hourly loads: mean of a full-hour reading and the next reading.

    ``df`` has ``date``, a decimal ``hour`` and at most one row for each; the result has ``keys``, ``date``, ``hour``
    and ``load``.  "Next" is the next row in time, however far away; a reading before an unknown one stays as it is.
    ``closing`` (``keys..., closing``: first value of the feed that follows) completes the last full hour, which takes
    the mean of the last reading and that value.  Readings without a date or hour are left out.

    The readings are read once, as one array per day; windows see one row per calendar day of a series.
    """
    keys = list(keys)
    days = _days_of_readings(df, keys, F.lit(True), load)
    if closing is None:
        days = days.withColumn("closing", F.lit(None))
    else:
        days = days.join(closing.select(*keys, "closing"), keys, "left")
    days = _pair_days(days, keys, F.struct("date", F.col("closing").cast("double").alias("load")))
    return days.select(*keys, "date", F.inline("_hours")).withColumnRenamed("load", load)


def harmonise(df: DataFrame, keys: Sequence[str], half: str, load: str = "load") -> DataFrame:
    """Half-hour readings (where ``half`` holds) and hourly means of a feed that follows, as one load per hour.

    ``df`` has at most one row per key, date, hour and ``half``; hours of the second kind are full.  Half hours are
    paired as in ``pair_half_hours``, closed by the first load of the other kind.  Where both kinds have an hour the
    half-hour feed wins, but an unknown load never does.  Rows without a date or hour are left out.  ``df`` is read once.
    """
    keys = list(keys)
    days = _days_of_readings(df, keys, F.col(half), load)
    first = F.when(F.size("_ten") > 0, F.struct("date", F.get("_ten", F.lit(0))["load"].alias("load")))
    days = _pair_days(days, keys, first)
    hours, tens = F.col("_hours"), F.col("_ten")
    kept = F.filter(hours, lambda x: x["load"].isNotNull() | ~F.exists(tens, lambda y: y["hour"] == x["hour"]))
    added = F.filter(tens, lambda y: ~F.exists(hours, lambda x: (x["hour"] == y["hour"]) & x["load"].isNotNull()))
    return days.select(*keys, "date", F.inline(F.concat(kept, added))).withColumnRenamed("load", load)


def union_feeds(half_hour: DataFrame, ten_minute: DataFrame) -> DataFrame:
    """Both harmonised feeds as one; an empty feed is harmless."""
    return half_hour.unionByName(ten_minute)


def drop_outliers(df: DataFrame, load: str, low: float, before: str) -> DataFrame:
    """Drop loads under ``low`` dated before ``before``; later rows (the future) survive."""
    return df.filter(~((F.col(load) < low) & (F.col("date") < F.lit(before).cast("date"))))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column (or any of ``columns``).

    One test per column and not one over all: single tests move below the
    explode of the hours and into scans, and stay cheap to plan for wide tables.
    """
    names = list(df.columns if columns is None else columns)
    return df.filter(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in names))) if names else df
