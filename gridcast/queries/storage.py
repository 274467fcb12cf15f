"""Text feeds and tables written under the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcast.functions.clock import feed_stamp
from gridcast.operators.origins import spread_horizons
from gridcast.operators.profiles import explode_hours
from gridcast.plans.features import feature_columns
from gridcast.plans.prepare import hourly_loads
from gridcast.queries.registry import grid_sql, iso, load_panel, load_profiles, query, readings, rounded, table
from gridcast.queries.scoring import prepared
from gridcast.session import staging_root
from gridcast.sources.feeds import (
    LONG_TERM_SEPARATORS,
    coverage,
    list_feeds,
    observe_lines,
    parse_load,
    parse_temperature,
    read_fields,
    read_sources,
)
from gridcast.sources.store import read_prepared_csv, read_table, replace_parts, write_feed, write_table

_SLOTS = 6


def _new_folder(spark) -> str:
    return f"{staging_root(spark)}/feeds-{uuid.uuid4().hex}"


def _feed_lines(spark, folder):
    """Events as lines of a ten-minute feed; a slot without events is an empty field."""
    ev = readings(spark, folder).withColumn("slot", F.floor(F.minute("ts") / 10))
    wide = ev.groupBy("series_id", "date", "hour").agg(
        *[F.sum(F.when(F.col("slot") == i, F.col("value"))).alias(f"s{i}") for i in range(_SLOTS)])
    fields = [F.coalesce(F.col(f"s{i}").cast("string"), F.lit("")) for i in range(_SLOTS)]
    line = F.concat_ws("  ", feed_stamp(F.col("date"), F.col("hour")), *fields)
    return wide.select("series_id", F.year("date").alias("year"), line.alias("line"))


@query(
    "feed_hours",
    """WITH slots AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h,
                      CAST(floor(minute(ts) / 10) AS INTEGER) AS s, sum(value) AS v FROM events GROUP BY 1, 2, 3, 4)
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(avg(v), 4) AS load FROM slots GROUP BY 1, 2, 3""",
)
def feed_hours(spark, folder):
    """Events written as text feeds, one folder per series, read back as hourly loads."""
    root = _new_folder(spark)
    write_feed(_feed_lines(spark, folder), root, "load")
    loads = hourly_loads(read_sources(spark, root, kinds=("load",), sites=True)["load"])
    out = loads.where("load IS NOT NULL")
    return rounded(out, 4, "load").select("series_id", iso("date").alias("date"), "hour", "load")


@query(
    "feed_coverage",
    """SELECT 'load' AS kind, min(year(ts)) AS min_year, max(year(ts)) AS max_year, min(year(ts)) AS start_year,
       max(year(ts)) AS end_year, 0 AS truncated_before, 0 AS truncated_after FROM events""",
)
def feed_coverage(spark, folder):
    """Years of the feeds from their file names."""
    root = _new_folder(spark)
    write_feed(_feed_lines(spark, folder), root, "load")
    years = [c for c in ("min_year", "max_year", "start_year", "end_year")]
    out = coverage(list_feeds(spark, root, sites=True))
    return out.select("kind", *[F.col(c).cast("long").alias(c) for c in years], "truncated_before", "truncated_after")


@query(
    "stored_horizons",
    f"""WITH {grid_sql()}
SELECT a.series_id, CAST(a.d AS VARCHAR) AS issue_date, 7 AS horizon, CAST(g.d AS VARCHAR) AS date, g.h AS hour,
       round(g.load, 4) AS load
FROM (SELECT DISTINCT series_id, d FROM grid) a JOIN grid g ON g.series_id = a.series_id AND g.d = a.d + 6""",
)
def stored_horizons(spark, folder):
    """A table written with one folder per horizon; reading one horizon prunes the others."""
    path = _new_folder(spark)
    write_table(spread_horizons(load_profiles(spark, folder), ["series_id"], ["load"], 14), path, by=("horizon",))
    out = explode_hours(read_table(spark, path).where("horizon = 7"))
    out = rounded(out, 4, "load").withColumns({"issue_date": iso("issue_date"), "date": iso("date")})
    return out.select("series_id", "issue_date", "horizon", "date", "hour", "load")


@query(
    "prepared_columns",
    """SELECT unnest(['day_of_year', 'lag0', 'lag24', 'level', 'max_24h', 'mean_24h', 'min_24h', 'month', 'day_of_month',
       'temperature_lag24', 'temperature_max_d1', 'temperature_mean_d1', 'temperature_min_d1', 'weekday', 'weekend']) AS name""",
)
def prepared_columns(spark, folder):
    """The regressors of a prepared table, written, read back and listed."""
    path = _new_folder(spark)
    write_table(prepared(spark, folder), path)
    names = feature_columns(read_table(spark, path))
    return spark.createDataFrame([(c,) for c in names], "name string")


@query(
    "separated_feeds",
    """WITH hours AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h, sum(value) AS v
                      FROM events GROUP BY 1, 2, 3),
days AS (SELECT l_linestatus AS series_id, CAST(l_shipdate AS DATE) AS d, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
SELECT 'load' AS kind, series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(v, 4) AS value FROM hours
UNION ALL SELECT 'temperature', series_id, CAST(d AS VARCHAR), CAST(NULL AS INTEGER), round(v, 4) FROM days""",
)
def separated_feeds(spark, folder):
    """A load feed with single spaces and a daily temperature feed with semicolons, written and read back."""
    root = _new_folder(spark)
    hours = readings(spark, folder).groupBy("series_id", "date", "hour").agg(F.sum("value").alias("v"))
    line = F.concat_ws(" ", F.regexp_replace(feed_stamp(F.col("date"), F.col("hour")), " +", " "), F.col("v").cast("string"))
    write_feed(hours.select("series_id", F.year("date").alias("year"), line.alias("line")), f"{root}/load", "load")
    items = table(spark, folder, "lineitem")
    days = items.groupBy(F.col("l_linestatus").alias("series_id"), F.col("l_shipdate").cast("date").alias("date")).agg(
        F.avg("l_quantity").alias("v"))
    line = F.concat_ws(";", iso("date"), F.col("v").cast("string"))
    write_feed(days.select("series_id", F.year("date").alias("year"), line.alias("line")), f"{root}/temperature", "temperature")
    load = parse_load(read_fields(spark, f"{root}/load", "load", LONG_TERM_SEPARATORS["load"], sites=True), slots=1)
    fields = read_fields(spark, f"{root}/temperature", "temperature", LONG_TERM_SEPARATORS["temperature"], sites=True)
    warm = parse_temperature(fields, hourly=False)
    load = load.select(F.lit("load").alias("kind"), "series_id", "date", F.col("hour").cast("int").alias("hour"),
                       F.col("slot0").alias("value"))
    warm = warm.select(F.lit("temperature").alias("kind"), "series_id", "date", F.lit(None).cast("int").alias("hour"),
                       F.col("temperature").alias("value"))
    return rounded(load.unionByName(warm).withColumn("date", iso("date")), 4, "value")


@query(
    "feed_rejects",
    """WITH e AS (SELECT event_type AS series_id, value, minute(ts) % 7 = 0 AS bad FROM events)
SELECT series_id, count(*) AS lines, count(*) FILTER (bad) AS rejected, round(sum(value) FILTER (NOT bad), 4) AS load
FROM e GROUP BY 1
UNION ALL SELECT NULL, count(*), count(*) FILTER (bad), NULL FROM e""",
)
def feed_rejects(spark, folder):
    """Lines without a readable date are counted while the feed is read, and belong to no day."""
    root, kept = _new_folder(spark), _new_folder(spark)
    ev = readings(spark, folder)
    bad = F.minute("ts") % 7 == 0
    stamp = F.when(bad, F.lit("99/99/2024  00:00")).otherwise(feed_stamp(F.col("date"), F.col("hour")))
    line = F.concat_ws("  ", stamp, F.col("value").cast("string"))
    write_feed(ev.select("series_id", F.year("date").alias("year"), line.alias("line")), root, "load")
    parsed, seen = observe_lines(parse_load(read_fields(spark, root, "load", sites=True), slots=1))
    write_table(parsed, kept)
    total = spark.createDataFrame([(seen.get["lines"], seen.get["rejected"])], "lines long, rejected long")
    unread = F.col("date").isNull() | F.col("hour").isNull()
    sites = read_table(spark, kept).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count(F.when(unread, 1)).alias("rejected"),
        F.sum(F.when(~unread, F.col("slot0"))).alias("load"))
    return rounded(sites.unionByName(total, allowMissingColumns=True), 4, "load")


@query(
    "prepared_csv",
    f"""WITH {grid_sql()}
SELECT series_id, CAST(d AS VARCHAR) AS date, h AS hour, round(load, 4) AS load FROM grid""",
)
def prepared_csv(spark, folder):
    """A prepared table as CSV with a header, read with a given schema."""
    path = _new_folder(spark)
    panel = load_panel(spark, folder).select("series_id", "date", "hour", "load")
    panel.write.csv(path, header=True, sep=";")
    out = read_prepared_csv(spark, path, "series_id string, date date, hour int, load double", ";")
    return rounded(out, 4, "load").withColumn("date", iso("date"))


@query(
    "replaced_horizon",
    f"""WITH {grid_sql()}
SELECT a.series_id, CAST(a.d AS VARCHAR) AS issue_date, k AS horizon, CAST(g.d AS VARCHAR) AS date, g.h AS hour,
       round(g.load * CASE WHEN k = 7 THEN 2 ELSE 1 END, 4) AS load
FROM (SELECT DISTINCT series_id, d FROM grid) a, (SELECT unnest([1, 7, 13]) AS k) JOIN grid g
  ON g.series_id = a.series_id AND g.d = a.d + (k - 1)""",
)
def replaced_horizon(spark, folder):
    """One horizon of a stored table is written anew, the others stay as they are."""
    path = _new_folder(spark)
    days = spread_horizons(load_profiles(spark, folder), ["series_id"], ["load"], 14)
    write_table(days, path, by=("horizon",))
    doubled = days.where("horizon = 7").withColumn("load", F.transform("load", lambda v: v * 2))
    replace_parts(doubled, path, by=("horizon",))
    out = explode_hours(read_table(spark, path).where("horizon IN (1, 7, 13)"))
    out = rounded(out, 4, "load").withColumns({"issue_date": iso("issue_date"), "date": iso("date")})
    return out.select("series_id", "issue_date", "horizon", "date", "hour", "load")
