"""Calendar features, holidays, off-work probability, bridges, daily joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.functions.clock import day_number
from gridcast.functions.dates import easter_sunday, is_leap_year, weekday_name
from gridcast.operators.align import join_daily
from gridcast.operators.daytypes import (
    add_bridge_days,
    add_calendar,
    add_dummies,
    flag_holidays,
    holiday_dimension,
    off_work_probability,
    years_of,
)
from gridcast.operators.lags import HaloWindow
from gridcast.operators.smooth import temperature_profile
from gridcast.plans.features import day_types
from gridcast.queries.registry import (
    ORDER_DAYS_SQL,
    SHIP_DAYS_SQL,
    iso,
    order_days,
    query,
    rounded,
    ship_days,
    table,
)


def order_dates(spark, folder):
    return table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()


def all_days(spark, folder):
    """Every calendar day of the order range: one row per date."""
    dates = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    ends = dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return ends.select(F.explode(F.sequence("lo", "hi")).alias("date"))


_ALL_DAYS_SQL = """
ends AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
alldays AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
            FROM ends)"""

# Easter in SQL follows another published method (the anonymous Gregorian one).
_EASTER_SQL = """
y0 AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS y FROM orders),
y1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y0),
y2 AS (SELECT *, b // 4 AS dd, b % 4 AS e, (b + 8) // 25 AS f FROM y1),
y3 AS (SELECT *, (b - f + 1) // 3 AS g FROM y2),
y4 AS (SELECT *, (19 * a + b - dd - g + 15) % 30 AS hh, c // 4 AS i, c % 4 AS k FROM y3),
y5 AS (SELECT *, (32 + 2 * e + 2 * i - hh - k) % 7 AS l FROM y4),
y6 AS (SELECT *, (a + 11 * hh + 22 * l) // 451 AS m FROM y5),
easter AS (SELECT y, make_date(y, (hh + l - 7 * m + 114) // 31, (hh + l - 7 * m + 114) % 31 + 1) AS sunday FROM y6),
fixed AS (SELECT * FROM (VALUES (1, 1), (1, 27), (5, 1), (8, 15), (11, 1), (11, 19), (12, 8), (12, 25)) v(mm, dd)),
holidays AS (SELECT make_date(y, mm, dd) AS d FROM y0 CROSS JOIN fixed
             UNION SELECT sunday FROM easter UNION SELECT sunday + 39 FROM easter UNION SELECT sunday + 50 FROM easter)"""


@query(
    "calendar_features",
    f"""WITH dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
       CAST(isodow(d) - 1 AS INTEGER) AS weekday,
       list_extract(['Lundi', 'Mardi', 'Mercredi', 'Jeudi', 'Vendredi', 'Samedi', 'Dimanche'], isodow(d)) AS weekday_name,
       CAST(isodow(d) IN (6, 7) AS INTEGER) AS weekend,
       CAST(last_day(d) AS VARCHAR) AS month_end,
       {", ".join(f"CAST(month(d) = {m} AS INTEGER) AS month_{m}" for m in range(1, 13))},
       {", ".join(f"CAST(isodow(d) = {w + 1} AS INTEGER) AS weekday_{w}" for w in range(7))}
FROM dates""",
)
def calendar_features(spark, folder):
    """Date parts, weekday names, one-hot columns, month ends."""
    wide = add_dummies(add_calendar(order_dates(spark, folder)))
    wide = wide.withColumns(
        {
            "weekday_name": weekday_name(F.col("date")),
            "weekend": F.col("weekday").isin(5, 6).cast("int"),
            "month_end": iso(F.last_day("date")),
        }
    )
    return wide.withColumn("date", iso("date"))


@query(
    "easter_dates",
    f"""WITH {_EASTER_SQL}
SELECT CAST(y AS INTEGER) AS year, CAST(sunday AS VARCHAR) AS easter, CAST(sunday + 39 AS VARCHAR) AS ascension,
       CAST(sunday + 50 AS VARCHAR) AS whit_monday,
       CAST((date_diff('day', make_date(y, 1, 1), make_date(y + 1, 1, 1))) * 24 AS INTEGER) AS hours_in_year
FROM easter""",
)
def easter_dates(spark, folder):
    """Movable holidays and year lengths."""
    years = order_dates(spark, folder).select(F.year("date").alias("year")).distinct()
    easter = easter_sunday(F.col("year"))
    return years.select(
        "year", iso(easter).alias("easter"), iso(F.date_add(easter, 39)).alias("ascension"),
        iso(F.date_add(easter, 50)).alias("whit_monday"),
        (F.when(is_leap_year(F.col("year")), 366).otherwise(365) * 24).alias("hours_in_year"),
    )


@query("holiday_dates", f"WITH {_EASTER_SQL} SELECT CAST(d AS VARCHAR) AS date FROM holidays")
def holiday_dates(spark, folder):
    """The holiday dimension of the years in the data."""
    years = order_dates(spark, folder).select(F.year("date").alias("year"))
    return holiday_dimension(years).select(iso("date").alias("date"))


@query(
    "holiday_flags",
    f"""WITH {ORDER_DAYS_SQL}, {_EASTER_SQL}
SELECT series_id, CAST(days.d AS VARCHAR) AS date, round(load, 4) AS load,
       CAST(holidays.d IS NOT NULL AS INTEGER) AS holiday
FROM days LEFT JOIN holidays ON holidays.d = days.d""",
)
def holiday_flags(spark, folder):
    """Holiday flag by join with the holiday dimension."""
    days = order_days(spark, folder)
    out = flag_holidays(days, years_of(days))
    return rounded(out, 4, "load").select("series_id", iso("date").alias("date"), "load", "holiday")


@query(
    "holiday_load",
    f"""WITH {ORDER_DAYS_SQL}, {_EASTER_SQL}
SELECT series_id, CAST(days.d IN (SELECT d FROM holidays) AS INTEGER) AS holiday, count(*) AS days,
       round(avg(load), 4) AS load
FROM days GROUP BY 1, 2""",
)
def holiday_load(spark, folder):
    """Mean load on holidays and other days, flag by calendar rule."""
    flagged = flag_holidays(order_days(spark, folder))
    out = flagged.groupBy("series_id", "holiday").agg(F.count(F.lit(1)).alias("days"), F.avg("load").alias("load"))
    return rounded(out, 4, "load")


def _day_types(spark, folder):
    """Stand-in day types for every calendar day, by rules on the date."""
    n, m, d = day_number(F.col("date")), F.month("date"), F.dayofmonth("date")
    return all_days(spark, folder).withColumns(
        {
            "christmas": F.when((m == 12) & (d >= 22), 30.0 + d).otherwise(0.0),
            "august": F.when((m == 8) & (n % 3 > 0), 40.0).otherwise(0.0),
            "bank_holiday": F.when(n % 53 == 0, 1.0).otherwise(0.0),
            "school": F.when(n % 97 < 5, 60.0).otherwise(0.0),
        }
    )


_DAY_TYPES_SQL = f"""{_ALL_DAYS_SQL},
types AS (SELECT d, date_diff('day', DATE '1970-01-01', d) AS n, month(d) AS m, day(d) AS dd FROM alldays),
flags AS (SELECT d, CASE WHEN m = 12 AND dd >= 22 THEN 30.0 + dd ELSE 0.0 END AS christmas,
                 CASE WHEN m = 8 AND n % 3 > 0 THEN 40.0 ELSE 0.0 END AS august,
                 CASE WHEN n % 53 = 0 THEN 1.0 ELSE 0.0 END AS bank_holiday,
                 CASE WHEN n % 97 < 5 THEN 60.0 ELSE 0.0 END AS school FROM types),
probs AS (SELECT d, CAST(CASE WHEN school > 0 THEN school WHEN bank_holiday > 0 THEN 100 WHEN august > 0 THEN august
                         WHEN christmas > 0 THEN christmas WHEN isodow(d) = 6 THEN 80 WHEN isodow(d) = 7 THEN 100
                         ELSE 0 END AS DOUBLE) AS p FROM flags)"""


@query(
    "off_work_probability",
    f"""WITH {_DAY_TYPES_SQL}, {ORDER_DAYS_SQL}
SELECT series_id, CAST(days.d AS VARCHAR) AS date, p AS off_work FROM days JOIN probs ON probs.d = days.d""",
)
def off_work(spark, folder):
    """Off-work probability by rule order, attached to the days of each series."""
    types = _day_types(spark, folder).withColumn(
        "off_work",
        off_work_probability(F.weekday("date"), F.col("christmas"), F.col("august"), F.col("bank_holiday"),
                             F.col("school")),
    )
    out = join_daily(order_days(spark, folder).select("series_id", "date"), types.select("date", "off_work"))
    return out.select("series_id", iso("date").alias("date"), "off_work")


@query(
    "bridge_days",
    f"""WITH {_DAY_TYPES_SQL},
offs AS (SELECT d, p, CAST(p > 0 AS INTEGER) AS me, lag(CAST(p > 0 AS INTEGER)) OVER (ORDER BY d) AS prev,
                lead(CAST(p > 0 AS INTEGER)) OVER (ORDER BY d) AS nxt FROM probs)
SELECT CAST(d AS VARCHAR) AS date, CASE WHEN prev + nxt + me = 1 THEN 50.0 ELSE p END AS off_work,
       CAST(coalesce(prev + nxt + me = 1, FALSE) AS INTEGER) AS bridge,
       CAST(coalesce(me = 0 AND prev = 1 AND nxt = 1, FALSE) AS INTEGER) AS sandwich
FROM offs""",
)
def bridge_days(spark, folder):
    """Bridge flag from neighbouring days, as coded and as intended."""
    types = _day_types(spark, folder)
    wide = types.withColumn(
        "off_work",
        off_work_probability(F.weekday("date"), F.col("christmas"), F.col("august"), F.col("bank_holiday"),
                             F.col("school")),
    )
    off = F.col("off_work") > 0
    sandwich = add_bridge_days(wide, off, mode="sandwich").withColumnRenamed("bridge", "sandwich")
    out = add_bridge_days(sandwich, off, probability="off_work")
    return out.select(iso("date").alias("date"), "off_work", "bridge", "sandwich")


@query(
    "weekend_bridges",
    f"""WITH {_ALL_DAYS_SQL},
offs AS (SELECT d, CAST(isodow(d) >= 6 AS INTEGER) AS me, lag(CAST(isodow(d) >= 6 AS INTEGER)) OVER (ORDER BY d) AS prev,
                lead(CAST(isodow(d) >= 6 AS INTEGER)) OVER (ORDER BY d) AS nxt FROM alldays)
SELECT CAST(year(d) AS INTEGER) AS year, CAST(isodow(d) - 1 AS INTEGER) AS weekday,
       CAST(sum(CAST(coalesce(prev + nxt + me = 1, FALSE) AS INTEGER)) AS BIGINT) AS bridges
FROM offs GROUP BY 1, 2""",
)
def weekend_bridges(spark, folder):
    """C8, F18 (long-term variant): only weekends count as off, the probability stays."""
    out = add_bridge_days(all_days(spark, folder), F.weekday("date").isin(5, 6))
    return out.groupBy(F.year("date").alias("year"), F.weekday("date").alias("weekday")).agg(
        F.sum("bridge").alias("bridges")
    )


@query(
    "bridge_load",
    f"""WITH {_DAY_TYPES_SQL}, {ORDER_DAYS_SQL},
offs AS (SELECT d, p, CAST(p > 0 AS INTEGER) AS me, lag(CAST(p > 0 AS INTEGER)) OVER (ORDER BY d) AS prev,
                lead(CAST(p > 0 AS INTEGER)) OVER (ORDER BY d) AS nxt FROM probs),
done AS (SELECT d, CASE WHEN prev + nxt + me = 1 THEN 50.0 ELSE p END AS p,
                CAST(coalesce(prev + nxt + me = 1, FALSE) AS INTEGER) AS bridge FROM offs)
SELECT series_id, bridge, count(*) AS days, round(avg(p), 6) AS off_work, round(avg(load), 4) AS load
FROM days JOIN done ON done.d = days.d GROUP BY 1, 2""",
)
def bridge_load(spark, folder):
    """Day types prepared once per date, then joined to every series."""
    typed = join_daily(order_days(spark, folder), day_types(_day_types(spark, folder)))
    out = typed.groupBy("series_id", "bridge").agg(
        F.count(F.lit(1)).alias("days"), F.avg("off_work").alias("off_work"), F.avg("load").alias("load")
    )
    return rounded(rounded(out, 6, "off_work"), 4, "load")


@query(
    "daily_dimension_join",
    f"""WITH {ORDER_DAYS_SQL}, {SHIP_DAYS_SQL}
SELECT series_id, CAST(days.d AS VARCHAR) AS date, round(load, 4) AS load, round(temperature, 6) AS temperature,
       sun_rise, sun_down, sun_last
FROM days JOIN ships ON ships.d = days.d""",
)
def daily_dimension_join(spark, folder):
    """Load with sun times and daily temperature of its date."""
    out = join_daily(order_days(spark, folder), ship_days(spark, folder))
    out = rounded(rounded(out, 4, "load"), 6, "temperature")
    return out.withColumn("date", iso("date"))


@query(
    "temperature_profile",
    f"""WITH {SHIP_DAYS_SQL}, hrs AS (SELECT unnest(generate_series(0, 23)) AS h)
SELECT CAST(d AS VARCHAR) AS date, CAST(h AS INTEGER) AS hour,
       round(temperature + CAST(-4.750991 AS DOUBLE) + h * CAST(0.434547 AS DOUBLE)
             + h ** 2 * CAST(-0.007320 AS DOUBLE) + h ** 3 * CAST(-0.000415 AS DOUBLE)
             + month(d) * CAST(0.354375 AS DOUBLE) + sun_down * CAST(0.500070 AS DOUBLE)
             + sun_rise * CAST(-0.511187 AS DOUBLE) + sun_last * CAST(-0.310402 AS DOUBLE)
             + dayofyear(d) * CAST(-0.010265 AS DOUBLE), 8) AS temperature
FROM ships CROSS JOIN hrs""",
)
def hourly_temperature(spark, folder):
    """Hourly temperature from the daily one."""
    days = add_calendar(ship_days(spark, folder))
    rows = days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    c = F.col
    value = temperature_profile(c("temperature"), c("hour"), c("month"), c("sun_down"), c("sun_rise"),
                                c("sun_last"), c("day_of_year"))
    return rows.select(iso("date").alias("date"), "hour", F.round(value, 8).alias("temperature"))


@query(
    "daily_temperature_lags",
    f"""WITH {SHIP_DAYS_SQL},
e AS (SELECT min(d) AS lo, max(d) AS hi FROM ships),
axis AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM e),
full_days AS (SELECT axis.d, temperature FROM axis LEFT JOIN ships USING (d))
SELECT CAST(d AS VARCHAR) AS date, round(temperature, 6) AS temperature,
       round(lag(temperature, 1) OVER (ORDER BY d), 6) AS temperature_lag1,
       round(lag(temperature, 2) OVER (ORDER BY d), 6) AS temperature_lag2,
       round(lag(temperature, 3) OVER (ORDER BY d), 6) AS temperature_lag3,
       round(lag(temperature, 4) OVER (ORDER BY d), 6) AS temperature_lag4
FROM full_days""",
)
def daily_temperature_lags(spark, folder):
    """W2 (long-term variant): daily temperature of the four days before, on the daily table."""
    ships = ship_days(spark, folder).select("date", "temperature")
    ends = ships.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    axis = ends.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    days = axis.join(ships, "date", "left")
    halo = HaloWindow([], day_number(F.col("date")), 1461, before=4)
    names = {f"temperature_lag{k}": (lambda w, k=k: F.lag("temperature", k).over(w)) for k in range(1, 5)}
    out = halo.select(days, names)
    return rounded(out, 6, "temperature", *names).withColumn("date", iso("date"))
