"""Coverage, hourly grids, slots, feeds and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcast.functions.clock import feed_stamp, parse_clock, parse_day, parse_hour
from gridcast.operators.align import row_positions, zip_by_position
from gridcast.operators.profiles import day_profiles, explode_hours, fill_days
from gridcast.operators.readings import (
    dedup_first,
    drop_incomplete,
    drop_null_columns,
    drop_outliers,
    harmonise,
    mean_of_slots,
    split_by_slot,
    union_feeds,
)
from gridcast.operators.splits import until_axis_end
from gridcast.queries.registry import (
    event_span,
    grid_sql,
    iso,
    load_panel,
    order_days,
    query,
    readings,
    rounded,
    table,
)
from gridcast.sources.feeds import coverage, within_coverage

_YEARS_SQL = """
years AS (SELECT 'orders' AS kind, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders
          UNION SELECT 'lineitem', CAST(year(l_shipdate) AS INTEGER) FROM lineitem
          UNION SELECT 'clerk', CAST(year(o_orderdate) AS INTEGER) + 1 FROM orders)"""


def _years(spark, folder):
    """Kind and year of each source; the third kind is a source that starts a year late."""
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))
    items = table(spark, folder, "lineitem").select(F.year("l_shipdate").alias("year"))
    kinds = [("orders", orders), ("lineitem", items), ("clerk", orders.select((F.col("year") + 1).alias("year")))]
    parts = [df.select(F.lit(kind).alias("kind"), "year").distinct() for kind, df in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "coverage_years",
    f"""WITH {_YEARS_SQL},
per AS (SELECT kind, min(y) AS min_year, max(y) AS max_year FROM years GROUP BY kind),
common AS (SELECT max(min_year) AS start_year, min(max_year) AS end_year FROM per)
SELECT kind, min_year, max_year, start_year, end_year,
       CAST(min_year < start_year AS INTEGER) AS truncated_before,
       CAST(max_year > end_year AS INTEGER) AS truncated_after
FROM per CROSS JOIN common""",
)
def coverage_years(spark, folder):
    """Years per source and the range they share."""
    return coverage(_years(spark, folder))


@query(
    "coverage_rows",
    f"""WITH {_YEARS_SQL},
per AS (SELECT kind, min(y) AS lo, max(y) AS hi FROM years GROUP BY kind),
common AS (SELECT max(lo) AS a, min(hi) AS b FROM per)
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
FROM orders CROSS JOIN common WHERE year(o_orderdate) BETWEEN a AND b GROUP BY 1""",
)
def coverage_rows(spark, folder):
    """S3, U4: order rows within the shared years, counted per year."""
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))
    return within_coverage(orders, _years(spark, folder)).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query(
    "hourly_grid_fill",
    f"""WITH {grid_sql()}
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load FROM grid""",
)
def hourly_grid_fill(spark, folder):
    """Gap-free hourly load, missing hours 0."""
    return rounded(load_panel(spark, folder), 4, "load").withColumn("date", iso("date"))


@query(
    "hourly_grid_ffill",
    f"""WITH {grid_sql("user_id")},
known AS (SELECT c.series_id, c.t, x.v FROM cells c LEFT JOIN hours x ON x.series_id = c.series_id AND x.t = c.t)
SELECT series_id, CAST(CAST(t AS DATE) AS VARCHAR) AS date, CAST(hour(t) AS INTEGER) AS hour,
       round(last_value(v IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY t), 4) AS load FROM known""",
)
def hourly_grid_ffill(spark, folder):
    """Gap-free hourly load per user, missing hours take the last known value."""
    return rounded(load_panel(spark, folder, "user_id", "ffill"), 4, "load").withColumn("date", iso("date"))


@query(
    "hourly_grid_null",
    f"""WITH {grid_sql("user_id")}
SELECT c.series_id, CAST(CAST(c.t AS DATE) AS VARCHAR) AS date, count(v) AS known,
       count(*) AS hours, round(sum(v), 4) AS load
FROM cells c LEFT JOIN hours x ON x.series_id = c.series_id AND x.t = c.t GROUP BY 1, 2""",
)
def hourly_grid_null(spark, folder):
    """Gap-free hours with missing values left null, summed up per day."""
    panel = load_panel(spark, folder, "user_id", "null")
    daily = panel.groupBy("series_id", "date").agg(
        F.count("load").alias("known"), F.count(F.lit(1)).alias("hours"), F.sum("load").alias("load")
    )
    return rounded(daily, 4, "load").withColumn("date", iso("date"))


@query(
    "future_skeleton",
    """WITH hist AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS v
                     FROM orders GROUP BY 1, 2),
last AS (SELECT max(CAST(o_orderdate AS DATE)) AS top FROM orders),
ends AS (SELECT series_id, min(d) AS lo,
                CAST(make_date(CAST(year(max(top)) + 1 AS BIGINT), 12, 31) AS TIMESTAMP) + INTERVAL 23 HOUR AS hi
         FROM hist CROSS JOIN last GROUP BY 1),
axis AS (SELECT series_id, unnest(generate_series(CAST(lo AS TIMESTAMP), hi, INTERVAL 1 HOUR)) AS t FROM ends),
cells AS (SELECT a.series_id, CAST(a.t AS DATE) AS d, CAST(hour(a.t) AS INTEGER) AS h,
                 CASE WHEN hour(a.t) = 0 THEN coalesce(v, 0) ELSE 0 END AS load
          FROM axis a LEFT JOIN hist x ON x.series_id = a.series_id AND x.d = CAST(a.t AS DATE))
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load
FROM cells WHERE NOT (load < 25000 AND d < DATE '2001-08-01')""",
)
def future_skeleton(spark, folder):
    """Hourly rows to the end of next year; low loads dropped in the past only."""
    orders = table(spark, folder, "orders")
    top = orders.agg(F.max(F.col("o_orderdate").cast("date"))).scalar()
    until = F.make_date(F.year(top) + 1, F.lit(12), F.lit(31))
    days = day_profiles(orders.withColumnRenamed("o_orderpriority", "series_id"), ["series_id"],
                        {"load": F.col("o_totalprice")}, F.col("o_orderdate").cast("date"), F.hour("o_orderdate"))
    panel = explode_hours(fill_days(days, ["series_id"], end=until))
    kept = drop_outliers(panel, "load", 25000, before="2001-08-01")
    return rounded(kept, 4, "load").withColumn("date", iso("date"))


def _slots(spark, folder):
    """Ten-minute slot totals as columns ``slot0..slot5``."""
    ev = readings(spark, folder).withColumn("slot", F.floor(F.minute("ts") / 10))
    slots = [F.sum(F.when(F.col("slot") == i, F.col("value"))).alias(f"slot{i}") for i in range(6)]
    return ev.groupBy("series_id", "date", "hour").agg(*slots)


_SLOT_NAMES = [f"slot{i}" for i in range(6)]

_SLOTS_SQL = """
slots AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h,
                 CAST(floor(minute(ts) / 10) AS INTEGER) AS s, sum(value) AS v FROM events GROUP BY 1, 2, 3, 4)"""


@query(
    "subhour_slot_mean",
    f"""WITH {_SLOTS_SQL}
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(avg(v), 6) AS load,
       CASE WHEN max(CASE WHEN s = 5 THEN 1 ELSE 0 END) = 1 THEN 'full' ELSE 'short' END AS feed
FROM slots GROUP BY 1, 2, 3""",
)
def subhour_slot_mean(spark, folder):
    """Mean of the ten-minute slots present; rows told apart by the last slot."""
    full, short = split_by_slot(_slots(spark, folder), "slot5")
    hourly = union_feeds(
        mean_of_slots(full, _SLOT_NAMES).withColumn("feed", F.lit("full")),
        mean_of_slots(short, _SLOT_NAMES).withColumn("feed", F.lit("short")),
    )
    return rounded(hourly, 6, "load").withColumn("date", iso("date"))


@query(
    "halfhour_to_hour",
    """WITH half AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS d,
                            hour(ts) + CASE WHEN minute(ts) >= 30 THEN 0.5 ELSE 0.0 END AS h, sum(value) AS v
                     FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1, 2, 3),
slots AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS d, CAST(hour(ts) AS DOUBLE) AS h,
                 floor(minute(ts) / 10) AS s, sum(value) AS v
          FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1, 2, 3, 4),
ten AS (SELECT series_id, d, h, avg(v) AS load FROM slots GROUP BY 1, 2, 3),
closing AS (SELECT series_id, arg_min(load, d + INTERVAL 1 MINUTE * CAST(h * 60 AS INTEGER)) AS c FROM ten GROUP BY 1),
nexts AS (SELECT *, lead(v) OVER w AS nv, last_value(v) OVER (PARTITION BY series_id ORDER BY d, h
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fin
          FROM half WINDOW w AS (PARTITION BY series_id ORDER BY d, h)),
full_rows AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY d DESC, h DESC) AS back
              FROM nexts WHERE h = floor(h)),
paired AS (SELECT f.series_id, d, CAST(h AS DOUBLE) AS h,
                  CASE WHEN back = 1 AND c IS NOT NULL THEN (fin + c) / 2 ELSE coalesce((v + nv) / 2, v) END AS load
           FROM full_rows f LEFT JOIN closing USING (series_id))
SELECT series_id, CAST(d AS VARCHAR) AS date, CAST(h AS INTEGER) AS hour, round(load, 6) AS load
FROM (SELECT * FROM paired UNION ALL SELECT * FROM ten)""",
)
def halfhour_to_hour(spark, folder):
    """Half-hour readings before 16 January, ten-minute slots after."""
    ev = readings(spark, folder)
    half = F.col("date") < F.lit("2024-01-16").cast("date")
    hour = F.col("hour") + F.when(half & (F.minute("ts") >= 30), 0.5).otherwise(0.0)
    slots = [F.sum(F.when(F.floor(F.minute("ts") / 10) == i, F.col("value"))).alias(f"slot{i}") for i in range(6)]
    rows = ev.groupBy("series_id", "date", hour.alias("hour")).agg(F.sum("value").alias("total"), *slots)
    rows = mean_of_slots(rows.withColumn("half", half), _SLOT_NAMES)
    rows = rows.withColumn("load", F.when(F.col("half"), F.col("total")).otherwise(F.col("load")))
    out = harmonise(rows, ["series_id"], "half")
    out = out.withColumn("hour", F.col("hour").cast("int")).withColumn("date", iso("date"))
    return rounded(out, 6, "load")


@query(
    "dedup_first",
    """SELECT user_id, CAST(d AS VARCHAR) AS date, h AS hour, event_id, event_type, round(value, 4) AS value
FROM (SELECT *, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), hour(ts) ORDER BY ts, event_id) AS rn
      FROM events) WHERE rn = 1""",
)
def dedup_first_rows(spark, folder):
    """First event per user and hour."""
    ev = readings(spark, folder).withColumnRenamed("series_id", "event_type")
    first = dedup_first(ev.select("user_id", "date", "hour", "ts", "event_id", "event_type", "value"),
                        ["user_id", "date", "hour"], ["ts", "event_id"])
    return rounded(first.drop("ts"), 4, "value").withColumn("date", iso("date"))


@query(
    "clock_parse",
    """WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d, hour(ts) AS hh,
                         CASE WHEN minute(ts) >= 30 THEN 30 ELSE 0 END AS mm FROM events)
SELECT event_id, strftime(d, '%d/%m/%Y') || '  ' || lpad(CAST(hh AS VARCHAR), 2, '0') || ':' ||
                 lpad(CAST(mm AS VARCHAR), 2, '0') AS stamp,
       round(hh + mm / 60.0, 4) AS hour,
       CAST(d AS VARCHAR) AS day_same,
       CAST(CASE WHEN hh = 0 AND mm = 0 THEN d + 1 ELSE d END AS VARCHAR) AS day_next,
       CASE WHEN hh = 0 AND mm = 0 THEN 24.0 ELSE round(hh + mm / 100.0, 4) END AS clock,
       CASE WHEN hh = 0 AND mm = 0 THEN 24.0 ELSE round(hh + mm / 60.0, 4) END AS clock_hours
FROM e""",
)
def clock_parse(spark, folder):
    """Feed time texts, written and read back; midnight is written 24:00."""
    ev = readings(spark, folder)
    half = F.col("hour") + F.when(F.minute("ts") >= 30, 0.5).otherwise(0.0)
    stamped = ev.select("event_id", feed_stamp(F.col("date"), half).alias("stamp"))
    day = F.to_date(F.substring("stamp", 1, 10), "dd/MM/yyyy")
    text = F.substring("stamp", 13, 5)
    text = F.when(text == "00:00", "24:00").otherwise(text)
    return stamped.select(
        "event_id", "stamp",
        F.round(parse_hour(text), 4).alias("hour"),
        iso(parse_day(day, text)).alias("day_same"),
        iso(parse_day(day, text, "next_day")).alias("day_next"),
        F.round(parse_clock(text), 4).alias("clock"),
        F.round(parse_clock(text, decimal=True), 4).alias("clock_hours"),
    )


@query(
    "complete_columns",
    """SELECT event_type AS series_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(hour(ts) AS INTEGER) AS hour,
       round(sum(value), 4) AS load
FROM events GROUP BY 1, 2, 3""",
)
def complete_columns(spark, folder):
    """only columns without a null stay; one filled on even hours and one never filled go."""
    hourly = readings(spark, folder).groupBy("series_id", "date", "hour").agg(F.sum("value").alias("load"))
    patchy = hourly.withColumns(
        {"even": F.when(F.col("hour") % 2 == 0, F.col("load")), "spare": F.lit(None).cast("double")}
    )
    return rounded(drop_null_columns(patchy), 4, "load").withColumn("date", iso("date"))


@query(
    "complete_rows",
    f"""WITH {_SLOTS_SQL},
wide AS (SELECT series_id, d, h, {", ".join(f"max(CASE WHEN s = {i} THEN v END) AS slot{i}" for i in range(6))}
         FROM slots GROUP BY 1, 2, 3)
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, {", ".join(f"round(slot{i}, 4) AS slot{i}" for i in range(6))}
FROM wide WHERE {" AND ".join(f"slot{i} IS NOT NULL" for i in range(6))}""",
)
def complete_rows(spark, folder):
    """hours with all six slots present."""
    rows = drop_incomplete(_slots(spark, folder))
    return rounded(rows, 4, *_SLOT_NAMES).withColumn("date", iso("date"))


@query(
    "positional_zip",
    """WITH a AS (SELECT o_orderstatus AS series_id, CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS load
                  FROM orders GROUP BY 1, 2),
b AS (SELECT l_linestatus AS series_id, CAST(l_shipdate AS DATE) AS d, avg(l_quantity) AS temperature,
             count(*) AS items FROM lineitem GROUP BY 1, 2),
an AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY d) - 1 AS position FROM a),
bn AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY d) - 1 AS position FROM b)
SELECT an.series_id, an.position, CAST(an.d AS VARCHAR) AS date, round(load, 4) AS load,
       round(temperature, 6) AS temperature, items
FROM an LEFT JOIN bn ON an.series_id = bn.series_id AND an.position = bn.position""",
)
def positional_zip(spark, folder):
    """Daily orders and ship days put side by side by row number, not by date."""
    left = order_days(spark, folder, "o_orderstatus")
    items = table(spark, folder, "lineitem")
    right = items.groupBy(F.col("l_linestatus").alias("series_id"), F.col("l_shipdate").cast("date").alias("date")).agg(
        F.avg("l_quantity").alias("temperature"), F.count(F.lit(1)).alias("items"))
    out = zip_by_position(left, right, ["series_id"], columns=["temperature", "items"])
    out = rounded(rounded(out, 4, "load"), 6, "temperature")
    return out.select("series_id", "position", iso("date").alias("date"), "load", "temperature", "items")


@query(
    "ordered_panel",
    f"""WITH {grid_sql()}
SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY t) - 1 AS position,
       CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load
FROM grid WHERE t <= (SELECT hi - INTERVAL 23 HOUR FROM span)""",
)
def ordered_panel(spark, folder):
    """Row positions in time order, cut at 00:00 of the last day (the axis end)."""
    start, end = event_span(spark, folder)
    panel = load_panel(spark, folder)
    axis = panel.filter((F.col("date") < end) | ((F.col("date") == end) & (F.col("hour") == 0)))
    numbered = row_positions(axis, ["series_id"], "date", ["date", "hour"])
    return rounded(numbered, 4, "load").select("series_id", "position", iso("date").alias("date"), "hour", "load")


@query(
    "long_axis",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
h AS (SELECT d, unnest(generate_series(0, 23)) AS h FROM d)
SELECT CAST(d AS VARCHAR) AS date, count(*) AS hours FROM h
WHERE d >= DATE '1998-01-01' AND (d < DATE '2001-01-01' OR (d = DATE '2001-01-01' AND h = 0)) GROUP BY 1""",
)
def long_axis(spark, folder):
    """Three years of hours from the start, up to and including 00:00 of the end day."""
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    hours = days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    out = until_axis_end(hours, "1998-01-01", years=3)
    return out.groupBy("date").agg(F.count(F.lit(1)).alias("hours")).withColumn("date", iso("date"))
