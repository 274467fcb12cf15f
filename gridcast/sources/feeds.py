"""Header-less text feeds: one file per kind and year, ``<kind>_<yyyy>.txt``.

Folders are read in one scan per kind; the kind and the year come from the file
name that Spark attaches to each row, so no file list goes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.clock import parse_clock, parse_day, parse_hour

# Separator of each kind of feed (a regular expression).  Two spaces part the fields of the short-term
# feeds, so an empty field keeps its place; the long-term feeds have single spaces, or semicolons.
SEPARATORS = {"load": " {2}", "sun": " {2}", "temperature": " {2}", "daytype": " {2}"}
LONG_TERM_SEPARATORS = {"load": r"\s+", "sun": ";", "temperature": ";"}

# Columns of the day-type feed after date and hour.
DAYTYPE_COLUMNS = ("august", "christmas", "bank_holiday", "school", "variable")

_NAME = r"^(.*?)_?(\d{4})\.txt$"


def _named(df: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return df.select(
        "*",
        F.regexp_extract(name, _NAME, 1).alias("kind"),
        F.regexp_extract(name, _NAME, 2).cast("int").alias("year"),
    )


def list_feeds(spark: SparkSession, root: str, sites: bool = False) -> DataFrame:
    """``kind, year`` of every feed file in ``root`` (``sites``: and in the folders under it); no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_[0-9][0-9][0-9][0-9].txt").option(
        "recursiveFileLookup", str(sites).lower()).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_extract(name, _NAME, 1).alias("kind"),
        F.regexp_extract(name, _NAME, 2).cast("int").alias("year"),
    )


def coverage(years: DataFrame) -> DataFrame:
    """Per kind the first and last year, and the range that all kinds share.

    ``truncated_before`` / ``truncated_after`` tell which kinds reach beyond the
    shared range.  ``years`` has ``kind, year``; the result has one row per kind.
    """
    per_kind = years.groupBy("kind").agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    start = per_kind.agg(F.max("min_year")).scalar()
    end = per_kind.agg(F.min("max_year")).scalar()
    out = per_kind.withColumns({"start_year": start, "end_year": end})
    return out.withColumns(
        {
            "truncated_before": (F.col("min_year") < F.col("start_year")).cast("int"),
            "truncated_after": (F.col("max_year") > F.col("end_year")).cast("int"),
        }
    )


def within_coverage(df: DataFrame, years: DataFrame, ahead: bool = False) -> DataFrame:
    """Rows whose ``year`` lies in the range that all kinds of ``years`` share; with ``ahead`` also later years."""
    per_kind = years.groupBy("kind").agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    start, end = per_kind.agg(F.max("lo")).scalar(), per_kind.agg(F.min("hi")).scalar()
    return df.filter(F.col("year") >= start if ahead else (F.col("year") >= start) & (F.col("year") <= end))


def _place(year: Column, block: Column, row: Column) -> Column:
    """Year, block start and the row's number within its task, one behind the other: a file block is read by one task."""
    start = year.cast("decimal(38,0)") * F.lit(Decimal(1 << 48)) + block
    return (start.cast("decimal(38,0)") * F.lit(Decimal(1 << 33)) + row.bitwiseAND(F.lit((1 << 33) - 1))).cast("decimal(30,0)")


def read_fields(
    spark: SparkSession, root: str, kind: str, separator: str | None = None, sites: bool = False
) -> DataFrame:
    """Rows of one kind as an array of fields, in ``_line`` order within a file.

    ``_line`` orders the rows of a kind as they stand in its files, year by year: block start within the file, then
    running number within the block, as one decimal, so that the first of repeated rows is found by a hash aggregate.
    With ``sites`` the files lie in one folder per site under ``root``, and
    ``series_id`` is the folder's name: one scan for all sites.
    """
    reader = spark.read.option("pathGlobFilter", f"{kind}_[0-9][0-9][0-9][0-9].txt")
    text = reader.option("recursiveFileLookup", str(sites).lower()).text(root)
    lines = _named(text.select("value", "_metadata")).withColumn(
        "_line", _place(F.col("year"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    )
    site = [F.element_at(F.split("_metadata.file_path", "/"), -2).alias("series_id")] if sites else []
    fields = F.transform(F.split("value", separator or SEPARATORS.get(kind, " {2}")), lambda f: F.trim(f))
    return lines.filter(F.length(F.trim("value")) > 0).select(fields.alias("fields"), "kind", "year", "_line", *site)


def _line_counts(parsed: DataFrame) -> list[Column]:
    unread = F.lit(False)
    for c in ("date", "hour"):
        if c in parsed.columns:
            unread = unread | F.col(c).isNull()
    return [F.count(F.lit(1)).alias("lines"), F.count(F.when(unread, 1)).alias("rejected")]


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """``lines`` of a parsed feed and how many have no readable date or hour; such lines belong to no day, and every
    unreadable value is null."""
    return parsed.agg(*_line_counts(parsed))


def observe_lines(parsed: DataFrame, name: str = "lines") -> tuple[DataFrame, Observation]:
    """``parsed`` and the counts of ``rejected_lines``, taken while it is read.

    ``observation.get`` gives ``lines`` and ``rejected`` once the first action on the table, which must read all of it,
    is over; the feed is not read again for them.
    """
    seen = Observation(name)
    return parsed.observe(seen, *_line_counts(parsed)), seen


def _site(fields: DataFrame) -> list[str]:
    return [c for c in fields.columns if c == "series_id"]


def _field(i: int):
    return F.nullif(F.get("fields", F.lit(i)), F.lit(""))


def _number(i: int):
    return F.nullif(_field(i).try_cast("double"), F.lit(float("nan")))


def parse_load(fields: DataFrame, slots: int = 6, hour24: str = "same_day") -> DataFrame:
    """``date, hour, slot0..`` from ``dd/MM/yyyy HH:mm v v v ...``; missing slots are null."""
    day, text = F.try_to_date(_field(0), "dd/MM/yyyy"), _field(1)
    return fields.select(
        *_site(fields),
        parse_day(day, text, hour24).alias("date"),
        parse_hour(text).alias("hour"),
        *[_number(2 + i).alias(f"slot{i}") for i in range(slots)],
        text.alias("hour_text"), "year", "_line",
    )


def parse_sun(fields: DataFrame, decimal: bool = False) -> DataFrame:
    names = {"sun_rise": 1, "sun_down": 2, "sun_last": 3}
    return fields.select(
        *_site(fields), F.try_to_date(_field(0), "yyyy-MM-dd").alias("date"),
        *[parse_clock(_field(i), decimal).alias(n) for n, i in names.items()], "_line",
    )


def parse_temperature(fields: DataFrame, hourly: bool = True) -> DataFrame:
    """Hourly: ``date hour temperature`` by position; daily: ``date temperature``."""
    date = F.coalesce(F.try_to_date(_field(0), "dd/MM/yyyy"), F.try_to_date(_field(0), "yyyy-MM-dd"))
    if not hourly:
        return fields.select(*_site(fields), date.alias("date"), _number(1).alias("temperature"), "_line")
    return fields.select(
        *_site(fields), date.alias("date"), F.floor(parse_hour(_field(1))).cast("int").alias("hour"),
        _number(2).alias("temperature"), "_line",
    )


def parse_daytype(fields: DataFrame) -> DataFrame:
    date = F.coalesce(F.try_to_date(_field(0), "dd/MM/yyyy"), F.try_to_date(_field(0), "yyyy-MM-dd"))
    return fields.select(
        *_site(fields), date.alias("date"), F.floor(parse_hour(_field(1))).cast("int").alias("hour"),
        *[_number(2 + i).alias(c) for i, c in enumerate(DAYTYPE_COLUMNS)], "_line",
    )


def read_sources(
    spark: SparkSession, root: str, kinds: Sequence[str] = ("load", "sun", "temperature", "daytype"),
    hourly_temperature: bool = True, hour24: str = "same_day",
    separators: Mapping[str, str] | None = None, prefixes: Mapping[str, str] | None = None,
    sites: bool = False, ahead: bool = False,
) -> dict[str, DataFrame]:
    """All feeds under ``root``, parsed, cut to the years that every kind covers.

    ``prefixes`` gives the file name before ``_<yyyy>.txt`` of a kind where it differs from the kind itself.  With
    ``sites`` the load files lie in one folder per site; sun, temperature and day types are shared and lie in
    ``root``.  With ``ahead`` the shared range has no end: weather may reach beyond the last load.
    """
    prefix = {kind: (prefixes or {}).get(kind, kind) for kind in kinds}
    years = list_feeds(spark, root, sites).filter(F.col("kind").isin(*prefix.values()))
    parse = {
        "load": lambda f: parse_load(f, hour24=hour24),
        "sun": parse_sun,
        "temperature": lambda f: parse_temperature(f, hourly_temperature),
        "daytype": parse_daytype,
    }
    out = {}
    for kind in kinds:
        separator = (separators or SEPARATORS).get(kind, SEPARATORS.get(kind))
        fields = read_fields(spark, root, prefix[kind], separator, sites and kind == "load")
        out[kind] = parse[kind](within_coverage(fields, years, ahead))
    return out
