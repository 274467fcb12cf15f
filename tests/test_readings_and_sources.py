import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridcast.operators.align import fill_dates, join_daily, row_positions, zip_by_position
from gridcast.operators.ranges import find_ranges
from gridcast.operators.readings import (
    dedup_first,
    drop_incomplete,
    drop_null_columns,
    drop_outliers,
    harmonise,
    mean_of_slots,
    on_the_hour,
    pair_half_hours,
    split_by_slot,
    union_feeds,
)
from gridcast.plans.prepare import hourly_loads, mixed_loads
from gridcast.sources.feeds import (
    LONG_TERM_SEPARATORS,
    coverage,
    list_feeds,
    observe_lines,
    parse_daytype,
    parse_load,
    parse_sun,
    read_fields,
    read_sources,
    rejected_lines,
)
from gridcast.sources.store import read_prepared_csv, read_table, replace_parts, write_table

SLOTS = [f"slot{i}" for i in range(6)]


def write(folder, name, text):
    (folder / name).write_text(text)


@pytest.fixture(scope="module")
def feeds(tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    load = [
        "01/01/2014  00:00  50000  50600  51200  51800  52400  53000",
        "01/01/2014  01:00  48000  48000  48000  48000  48000",
        "01/01/2014  24:00  47000  47000  47000  47000  47000  47000",
    ]
    for year in (2013, 2014, 2015):
        write(root, f"load_{year}.txt", "\n".join(s.replace("2014", str(year)) for s in load) + "\n")
    for year in (2014, 2015, 2016):
        write(root, f"sun_{year}.txt", f"{year}-01-01  07:45  16:59  09:14\n")
        write(root, f"temperature_{year}.txt", f"01/01/{year}  00:00  9.5\n01/01/{year}  01:00  9.0\n")
        write(root, f"daytype_{year}.txt", f"01/01/{year}  00:00  0  30  100  0  0\n01/01/{year}  01:00  0  30  100  0  0\n")
    write(root, "notes.txt", "not a feed\n")
    return str(root)


def test_file_names_tell_kind_and_year(spark, feeds):
    got = {(r.kind, r.year) for r in list_feeds(spark, feeds).collect()}
    assert ("load", 2013) in got and ("daytype", 2016) in got and len(got) == 12


def test_coverage_report(spark, feeds):
    rows = {r.kind: r for r in coverage(list_feeds(spark, feeds)).collect()}
    assert (rows["load"].start_year, rows["load"].end_year) == (2014, 2015)
    assert (rows["load"].truncated_before, rows["load"].truncated_after) == (1, 0)
    assert (rows["sun"].truncated_before, rows["sun"].truncated_after) == (0, 1)


def test_sources_are_cut_to_common_years(spark, feeds):
    src = read_sources(spark, feeds)
    assert {r.year for r in src["load"].select(F.year("date").alias("year")).distinct().collect()} == {2014, 2015}
    sun = src["sun"].orderBy("date").first()
    assert (sun.sun_rise, sun.sun_down, sun.sun_last) == (7.45, 16.59, 9.14)
    t = src["temperature"].orderBy("date", "hour").first()
    assert (t.hour, t.temperature) == (0, 9.5)
    d = src["daytype"].orderBy("date", "hour").first()
    assert (d.christmas, d.bank_holiday, d.school) == (30.0, 100.0, 0.0)


def test_load_feed_to_hours(spark, feeds):
    fields = read_fields(spark, feeds, "load").filter("year = 2014")
    hourly = mean_of_slots(parse_load(fields), SLOTS)
    first = dedup_first(hourly, ["date", "hour"], ["_line"])
    got = {(r.date, r.hour): r.load for r in first.collect()}
    assert got == {(dt.date(2014, 1, 1), 0.0): 51500.0, (dt.date(2014, 1, 1), 1.0): 48000.0}
    moved = mean_of_slots(parse_load(fields, hour24="next_day"), SLOTS)
    assert (dt.date(2014, 1, 2), 0.0, 47000.0) in {(r.date, r.hour, r.load) for r in moved.collect()}


def test_lines_keep_file_order(spark, tmp_path):
    text = "".join(f"01/01/2014 00:00 {i}\n" for i in range(5000))
    write(tmp_path, "load_2014.txt", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = parse_load(read_fields(spark, str(tmp_path), "load", LONG_TERM_SEPARATORS["load"]), slots=1)
        got = [r.slot0 for r in rows.orderBy("_line").collect()]
        first = dedup_first(rows, ["date", "hour"], ["_line"]).first().slot0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [float(i) for i in range(5000)] and first == 0.0


def test_semicolon_feed_with_daily_temperature(spark, tmp_path):
    write(tmp_path, "temperature_2014.txt", "2014-01-01;9.5\n2014-01-02;8.25\n")
    out = read_sources(spark, str(tmp_path), kinds=("temperature",), hourly_temperature=False,
                       separators=LONG_TERM_SEPARATORS)["temperature"]
    assert [(str(r.date), r.temperature) for r in out.orderBy("date").collect()] == [("2014-01-01", 9.5), ("2014-01-02", 8.25)]


def test_empty_fields_keep_their_place(spark, tmp_path):
    write(tmp_path, "daytype_2014.txt", "01/01/2014  00:00  0    100  0  0\n")
    write(tmp_path, "load_2014.txt", "01/01/2014  00:00  1  2    4  5  6\n01/01/2014  01:00  1  2  3\n")
    day = parse_daytype(read_fields(spark, str(tmp_path), "daytype")).first()
    assert (day.august, day.christmas, day.bank_holiday, day.school) == (0.0, None, 100.0, 0.0)
    rows = parse_load(read_fields(spark, str(tmp_path), "load")).orderBy("hour").collect()
    assert [tuple(r[c] for c in SLOTS) for r in rows] == [(1.0, 2.0, None, 4.0, 5.0, 6.0), (1.0, 2.0, 3.0, None, None, None)]
    full, short = split_by_slot(parse_load(read_fields(spark, str(tmp_path), "load")), "slot5")
    assert (full.count(), short.count()) == (1, 1)


def test_unreadable_lines_are_counted_and_end_no_job(spark, tmp_path):
    write(tmp_path, "load_2014.txt", "01/01/2014  00:00  1  x  3\nnonsense\n32/01/2014  00:00  1\n01/01/2014  ab:00  1\n")
    write(tmp_path, "sun_2014.txt", "2014-01-01  07:45  16:59  --\n2014-13-01  07:45  16:59  09:14\n")
    loads = parse_load(read_fields(spark, str(tmp_path), "load"))
    assert tuple(rejected_lines(loads).first()) == (4, 3)
    good = loads.filter("date IS NOT NULL AND hour IS NOT NULL").first()
    assert (good.slot0, good.slot1, good.slot2) == (1.0, None, 3.0)
    sun = parse_sun(read_fields(spark, str(tmp_path), "sun"))
    assert tuple(rejected_lines(sun).first()) == (2, 1)
    assert sun.filter("date IS NOT NULL").first().sun_last is None


def test_one_folder_per_site(spark, tmp_path):
    for site, value in (("north", 10), ("south", 20)):
        (tmp_path / site).mkdir()
        write(tmp_path / site, "load_2014.txt", f"01/01/2014  00:00  {value}  {value}\n")
    write(tmp_path, "sun_2014.txt", "2014-01-01  07:45  16:59  09:14\n")
    loads = read_sources(spark, str(tmp_path), kinds=("load", "sun"), sites=True)["load"]
    assert sorted((r.series_id, r.slot0) for r in loads.collect()) == [("north", 10.0), ("south", 20.0)]


def test_dates_are_filled(spark):
    rows = [(dt.date(2014, 1, d), float(d)) for d in (1, 2, 5)]
    got = fill_dates(spark.createDataFrame(rows, "date date, v double")).orderBy("date").collect()
    assert [(r.date.day, r.v) for r in got] == [(1, 1.0), (2, 2.0), (3, None), (4, None), (5, 5.0)]
    assert fill_dates(spark.createDataFrame(rows, "date date, v double").filter("false")).count() == 0


def test_mixed_feed_is_told_apart_by_the_last_slot(spark, feeds):
    rows = parse_load(read_fields(spark, feeds, "load").filter("year = 2014"))
    full, short = split_by_slot(rows, "slot5")
    assert (full.count(), short.count()) == (2, 1)
    assert mean_of_slots(short, SLOTS).first().load == 48000.0


HALF = [("2013-12-31", 22.0, 100.0), ("2013-12-31", 22.5, 110.0), ("2013-12-31", 23.0, 120.0), ("2013-12-31", 23.5, 140.0)]


def half_frame(spark, rows, series="a"):
    data = [(series, dt.date.fromisoformat(d), h, v) for d, h, v in rows]
    return spark.createDataFrame(data, "series_id string, date date, hour double, load double")


def test_half_hours_pair_up(spark):
    closing = spark.createDataFrame([("a", 160.0)], "series_id string, closing double")
    out = pair_half_hours(half_frame(spark, HALF), ["series_id"], closing=closing)
    assert {r.hour: r.load for r in out.collect()} == {22.0: 105.0, 23.0: 150.0}


def test_half_hours_without_a_following_feed(spark):
    out = pair_half_hours(half_frame(spark, HALF), ["series_id"])
    assert {r.hour: r.load for r in out.collect()} == {22.0: 105.0, 23.0: 130.0}


def test_half_hours_pair_over_gaps_and_years(spark):
    rows = [("2012-12-31", 23.0, 10.0), ("2014-01-01", 5.0, 30.0), ("2014-01-01", 5.5, 50.0)]
    out = pair_half_hours(half_frame(spark, rows), ["series_id"])
    assert {r.hour: r.load for r in out.collect()} == {23.0: 20.0, 5.0: 40.0}


def test_union_with_an_empty_feed(spark):
    some = half_frame(spark, HALF)
    assert union_feeds(some.limit(0), some).count() == 4 and union_feeds(some, some.limit(0)).count() == 4
    assert on_the_hour(some).count() == 2


def test_outliers_go_only_before_the_cut(spark):
    rows = [("2015-01-01", 0.0, 10.0), ("2015-01-01", 1.0, 30000.0), ("2017-01-01", 0.0, 0.0)]
    assert drop_outliers(half_frame(spark, rows), "load", 25000, "2016-01-01").count() == 2


def test_null_columns_and_rows(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, None)], "a int, b double, c double")
    assert drop_null_columns(df).columns == ["a"]
    assert drop_null_columns(df, keep=["b"]).columns == ["a", "b"]
    assert drop_incomplete(df.drop("c")).count() == 1


def test_first_duplicate_wins(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, "z")], "k int, o int, v string")
    assert {r.k: r.v for r in dedup_first(df, ["k"], ["o"]).collect()} == {1: "a", 2: "z"}


def test_first_of_whole_numbers_is_a_hash_aggregate(spark):
    """Order by a flag, a whole number and a decimal, all with unknown values: the row that Python's order puts first."""
    draw = random.Random(5)
    some = lambda values: draw.choice([None, *values])
    rows = [(draw.randrange(40), some([True, False]), some([-2 ** 31, -1, 0, 2 ** 31 - 1]), some([Decimal(-9), Decimal(10 ** 20)]), float(i))
            for i in range(3000)]
    rows = list({r[:4]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "k int, flag boolean, n int, d decimal(21,0), v double").repartition(5)
    out = dedup_first(df, ["k"], ["flag", "n", "d"])
    unknown_first = lambda r: [(x is not None, x if x is not None else 0) for x in r[1:4]]
    best = {k: min((r for r in rows if r[0] == k), key=unknown_first) for k in {r[0] for r in rows}}
    assert {r.k: tuple(r) for r in out.collect()} == best
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_feeds_are_brought_to_hours_by_hash_aggregates(spark, feeds):
    rows = read_sources(spark, feeds)["load"]
    plan = hourly_loads(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_positions_run_through_months(spark):
    days = spark.sql("SELECT 1 AS series_id, explode(sequence(DATE'2019-01-15', DATE'2020-06-03')) AS date")
    days = days.filter("day(date) % 3 <> 0")
    rows = row_positions(days, ["series_id"], "date", ["date"]).orderBy("date").collect()
    assert [r.position for r in rows] == list(range(len(rows)))


def test_positions_of_a_hot_month_are_spread_over_ranges(spark):
    """One month of one series holds most rows; ranges of 50 rows cut it up, positions stay those of one order."""
    hot = spark.sql("SELECT 'hot' AS series_id, DATE'2020-01-15' AS date, id AS minute FROM range(1000)")
    cold = spark.sql("SELECT 'cold' AS series_id, date_add(DATE'2020-01-01', CAST(id AS INT)) AS date, 0L AS minute FROM range(30)")
    none = spark.sql("SELECT CAST(NULL AS STRING) AS series_id, DATE'2020-01-01' AS date, id AS minute FROM range(3)")
    rows = hot.union(cold).union(none).repartition(7)
    numbered = row_positions(rows, ["series_id"], "date", ["date", "minute"], rows=50)
    assert numbered.columns == ["series_id", "date", "minute", "position"]
    found = {}
    for r in numbered.collect():
        found.setdefault(r.series_id, []).append((r.date, r.minute, r.position))
    for got in found.values():
        assert [p for *_, p in sorted(got)] == list(range(len(got)))
    assert {k: len(v) for k, v in found.items()} == {"hot": 1000, "cold": 30, None: 3}
    plain = row_positions(rows, ["series_id"], "date", ["date", "minute"])
    assert sorted(map(str, plain.collect())) == sorted(map(str, numbered.collect()))
    ranges = find_ranges(rows, ["series_id", "date", "minute"], 50)
    dealt = ranges.number(rows.withColumn("key", F.struct("series_id", "date", "minute")), "key", "range")
    sizes = [r["count"] for r in dealt.where("series_id = 'hot'").groupBy("range").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 200
    assert row_positions(rows.limit(0), ["series_id"], "date", ["date", "minute"], rows=50).count() == 0


def test_half_hours_and_ten_minutes_in_one_scan(spark, tmp_path):
    text = ["31/12/2013 22:00 100", "31/12/2013 22:30 110", "31/12/2013 23:00 120", "31/12/2013 23:30 140", "nonsense",
            "01/01/2014 00:00 160 170 180 190 200 210", "01/01/2014 01:00 1 1 1 1 1 1", "31/12/2013 23:00 7 7 7 7 7 7"]
    write(tmp_path, "load_2013.txt", "\n".join(text) + "\n")
    feed = parse_load(read_fields(spark, str(tmp_path), "load", LONG_TERM_SEPARATORS["load"]))
    out = mixed_loads(feed)
    got = {(str(r.date), r.hour): r.load for r in out.collect()}
    # the last full hour is closed by the earliest load of the other feed, the one of 23:00
    assert got == {("2013-12-31", 22): 105.0, ("2013-12-31", 23): 73.5, ("2014-01-01", 0): 185.0, ("2014-01-01", 1): 1.0}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan text") == 1


def test_an_unknown_half_hour_gives_way(spark):
    day = dt.date(2014, 1, 1)
    rows = [("a", day, 0.0, None, True), ("a", day, 0.5, 4.0, True), ("a", day, 1.0, 6.0, True), ("a", day, 1.5, None, True),
            ("a", day, 0.0, 9.0, False), ("a", day, 1.0, 3.0, False), ("a", None, 1.0, 3.0, False), ("b", day, 5.0, None, False)]
    df = spark.createDataFrame(rows, "series_id string, date date, hour double, load double, half boolean")
    got = {(r.series_id, r.hour): r.load for r in harmonise(df, ["series_id"], "half").collect()}
    assert got == {("a", 0.0): 9.0, ("a", 1.0): 6.0, ("b", 5.0): None}
    assert harmonise(df.limit(0), ["series_id"], "half").count() == 0


def test_rejected_lines_are_counted_while_reading(spark, tmp_path):
    write(tmp_path, "load_2014.txt", "01/01/2014  00:00  1  x  3\nnonsense\n32/01/2014  00:00  1\n01/01/2014  ab:00  1\n")
    parsed, seen = observe_lines(parse_load(read_fields(spark, str(tmp_path), "load")))
    assert parsed._jdf.queryExecution().sparkPlan().toString().count("FileScan text") == 1
    assert len(parsed.collect()) == 4
    assert seen.get == {"lines": 4, "rejected": 3}


def test_one_horizon_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "horizons")
    df = half_frame(spark, HALF).withColumn("horizon", F.explode(F.array(F.lit(7), F.lit(13))))
    write_table(df, path, by=("horizon",))
    kept = sorted(str(f) for f in (tmp_path / "horizons" / "horizon=13").iterdir())
    replace_parts(df.filter("horizon = 7 AND hour >= 23").withColumn("load", F.col("load") * 2), path, ("horizon",))
    back = {r.horizon: (r.n, r.load) for r in read_table(spark, path).groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n"), F.sum("load").alias("load")).collect()}
    assert back == {7: (2, 520.0), 13: (4, 470.0)}
    assert sorted(str(f) for f in (tmp_path / "horizons" / "horizon=13").iterdir()) == kept


def test_zip_by_position_ignores_dates(spark):
    left = half_frame(spark, [("2014-01-01", 0.0, 1.0), ("2014-02-01", 0.0, 2.0), ("2014-03-01", 0.0, 3.0)])
    right = half_frame(spark, [("2010-01-01", 0.0, 10.0), ("2010-01-05", 0.0, 20.0)]).withColumnRenamed("load", "t")
    out = zip_by_position(left, right, ["series_id"], columns=["t"]).orderBy("date")
    assert [(r.load, r.t) for r in out.collect()] == [(1.0, 10.0), (2.0, 20.0), (3.0, None)]


def test_daily_join_keeps_one_row_per_date(spark):
    left = half_frame(spark, [("2014-01-01", 0.0, 1.0), ("2014-01-02", 0.0, 2.0)])
    sun = spark.createDataFrame([(dt.date(2014, 1, 1), 7.0), (dt.date(2014, 1, 1), 7.0)], "date date, sun_rise double")
    assert join_daily(left, sun).count() == 1
    assert join_daily(left, sun, how="left").count() == 2


def test_prepared_tables_round_trip_with_pruning(spark, tmp_path):
    df = half_frame(spark, HALF).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(3))))
    path = str(tmp_path / "prepared")
    write_table(df, path, by=("horizon",))
    back = read_table(spark, path)
    assert back.count() == 12 and back.filter("horizon = 2").count() == 4
    plan = back.filter("horizon = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(horizon" in plan


def test_prepared_csv_import(spark, tmp_path):
    (tmp_path / "p.csv").write_text("date;hour;load\n2014-01-01;0;5.5\n")
    df = read_prepared_csv(spark, str(tmp_path / "p.csv"), "date date, hour int, load double", ";")
    assert tuple(df.first()) == (dt.date(2014, 1, 1), 0, 5.5)
