"""Registration and the table views that the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.profiles import day_profiles, explode_hours, fill_days

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def iso(column: Column | str) -> Column:
    """Dates as ISO text, so both engines print the same."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.selectExpr(*[f"round(`{c}`, {digits}) AS `{c}`" if c in columns else f"`{c}`" for c in df.columns])


# -- events: hourly load per event type (or user), temperature from props.k ---


def readings(spark: SparkSession, folder: str, key: str = "event_type") -> DataFrame:
    ev = table(spark, folder, "events")
    return ev.select(
        F.col(key).alias("series_id"), F.col("ts").cast("date").alias("date"), F.hour("ts").alias("hour"),
        "ts", "value", "props", "event_id", "user_id",
    )


def event_span(spark: SparkSession, folder: str) -> tuple[Column, Column]:
    """First and last date of all events, from one aggregate."""
    days = table(spark, folder, "events").select(F.col("ts").cast("date").alias("d"))
    span = days.agg(F.struct(F.min("d").alias("first"), F.max("d").alias("last")).alias("span")).scalar()
    return span["first"], span["last"]


def load_profiles(spark: SparkSession, folder: str, key: str = "event_type", fill: str = "zero") -> DataFrame:
    start, end = event_span(spark, folder)
    days = day_profiles(readings(spark, folder, key), ["series_id"], {"load": F.col("value")})
    return fill_days(days, ["series_id"], ("load",), fill, start, end)


def load_panel(spark: SparkSession, folder: str, key: str = "event_type", fill: str = "zero") -> DataFrame:
    return explode_hours(load_profiles(spark, folder, key, fill))


def temperature_readings(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return readings(spark, folder).select("date", "hour", k.alias("temperature"))


def temperature_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """One temperature for all series: hourly mean over all events, gaps filled forward."""
    start, end = event_span(spark, folder)
    days = day_profiles(temperature_readings(spark, folder).withColumn("site", F.lit(0)), ["site"],
                        {"temperature": F.col("temperature")}, how="avg")
    return fill_days(days, ["site"], ("temperature",), "ffill", start, end).drop("site")


# The same views in SQL.  ``{key}`` is the series column.
def grid_sql(key: str = "event_type") -> str:
    return f"""
hours AS (SELECT {key} AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t, sum(value) AS v
          FROM events GROUP BY 1, 2),
span AS (SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) AS lo,
                CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) + INTERVAL 23 HOUR AS hi FROM events),
axis AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM span),
cells AS (SELECT s.series_id, a.t FROM (SELECT DISTINCT {key} AS series_id FROM events) s CROSS JOIN axis a),
grid AS (SELECT c.series_id, c.t, CAST(c.t AS DATE) AS d, CAST(hour(c.t) AS INTEGER) AS h,
                coalesce(v, 0) AS load
         FROM cells c LEFT JOIN hours x ON x.series_id = c.series_id AND x.t = c.t)"""


TEMPERATURE_SQL = """
thours AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t,
                  avg(CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE)) AS k
           FROM events GROUP BY 1),
tspan AS (SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) AS lo,
                 CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) + INTERVAL 23 HOUR AS hi FROM events),
taxis AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM tspan),
temps AS (SELECT a.t, CAST(a.t AS DATE) AS d, CAST(hour(a.t) AS INTEGER) AS h,
                 last_value(k IGNORE NULLS) OVER (ORDER BY a.t) AS temperature
          FROM taxis a LEFT JOIN thours x ON x.t = a.t)"""


# -- orders and lineitem: daily sources over seven years ---------------------


def order_days(spark: SparkSession, folder: str, key: str = "o_orderpriority") -> DataFrame:
    """Daily order value per series (days without orders are absent)."""
    orders = table(spark, folder, "orders")
    return orders.groupBy(F.col(key).alias("series_id"), F.col("o_orderdate").cast("date").alias("date")).agg(
        F.sum("o_totalprice").alias("load")
    )


def ship_days(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ship date: stand-ins for sun times and daily temperature."""
    items = table(spark, folder, "lineitem")
    return items.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        F.avg("l_quantity").alias("temperature"),
        F.min("l_quantity").alias("sun_rise"),
        F.max("l_quantity").alias("sun_down"),
        F.count(F.lit(1)).alias("sun_last"),
    )


ORDER_DAYS_SQL = """
days AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS load
         FROM orders GROUP BY 1, 2)"""

SHIP_DAYS_SQL = """
ships AS (SELECT CAST(l_shipdate AS DATE) AS d, avg(l_quantity) AS temperature, min(l_quantity) AS sun_rise,
                 max(l_quantity) AS sun_down, count(*) AS sun_last
          FROM lineitem GROUP BY 1)"""


def least_squares_sql(source: str, keys: str, k: int) -> str:
    """CTEs up to ``solved``: least squares of ``y`` on ``x0..`` per group by elimination, columns ``c0..`` and ``c``
    (the intercept)."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = ", ".join([f"avg(x{i}) AS m{i}, covar_pop(x{i}, y) AS b{i}" for i in range(k)]
                        + [f"covar_pop(x{i}, x{j}) AS a{i}_{j}" for i, j in pairs])
    out = [f"e0 AS (SELECT {keys}, count(*) AS n, avg(y) AS my, {moments} FROM {source} GROUP BY {keys})"]
    for p in range(k - 1):
        rest = [(i, j) for i, j in pairs if i > p]
        changes = [f"a{i}_{j} - a{p}_{i} * a{p}_{j} / a{p}_{p} AS a{i}_{j}" for i, j in rest]
        changes += [f"b{i} - a{p}_{i} * b{p} / a{p}_{p} AS b{i}" for i in range(p + 1, k)]
        out.append(f"e{p + 1} AS (SELECT * REPLACE ({', '.join(changes)}) FROM e{p})")
    last = f"e{k - 1}"
    for p in reversed(range(k)):
        known = "".join(f" - a{p}_{j} * c{j}" for j in range(p + 1, k))
        out.append(f"s{p} AS (SELECT *, (b{p}{known}) / a{p}_{p} AS c{p} FROM {last})")
        last = f"s{p}"
    level = "my" + "".join(f" - c{i} * m{i}" for i in range(k))
    out.append(f"solved AS (SELECT *, {level} AS c FROM {last})")
    return ",\n".join(out)


def projection_sql(source: str, key: str, row: str, k: int) -> str:
    """CTEs up to ``projected`` (key, row, fitted): least squares of ``y`` on ``x0..`` per key, fitted values of the same
    rows.  The matrix of products lies in rows (i, j) and is eliminated column by column, a column without variance of its
    own left being skipped; column ``k`` is the target."""
    names = [*[f"x{i}" for i in range(k)], "y"]
    values = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY {key})" for c in names)
    return f"""centred AS MATERIALIZED (SELECT {key} AS g, {row} AS r, avg(y) OVER (PARTITION BY {key}) AS level, [{values}] AS v FROM {source}),
places AS (SELECT unnest(range(0, {k + 1})) AS i),
products AS MATERIALIZED (SELECT g, a.i AS i, b.i AS j, sum(v[a.i + 1] * v[b.i + 1]) AS p
  FROM centred, places a, places b GROUP BY ALL),
own AS (SELECT g, i, p AS own FROM products WHERE i = j),
steps AS (SELECT -1 AS step, g, i, j, p FROM products
  UNION ALL
  SELECT s.step + 1, s.g, s.i, s.j, CASE
      WHEN q.p <= 1e-9 * o.own OR o.own <= 1e-20 THEN CASE WHEN s.i = s.step + 1 THEN 0 ELSE s.p END
      WHEN s.i = s.step + 1 THEN s.p / q.p
      ELSE s.p - c.p * w.p / q.p END
  FROM steps s
  JOIN steps q ON q.g = s.g AND q.i = s.step + 1 AND q.j = s.step + 1
  JOIN steps c ON c.g = s.g AND c.i = s.i AND c.j = s.step + 1
  JOIN steps w ON w.g = s.g AND w.i = s.step + 1 AND w.j = s.j
  JOIN own o ON o.g = s.g AND o.i = s.step + 1
  WHERE s.step < {k - 1} AND s.j > s.step + 1),
weights AS (SELECT g, list(p ORDER BY i) AS b FROM steps WHERE step = {k - 1} AND j = {k} AND i < {k} GROUP BY g),
projected AS (SELECT c.g, c.r, c.level + list_dot_product(v[:{k}], b) AS fitted FROM centred c JOIN weights w ON w.g = c.g)"""
