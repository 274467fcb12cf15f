"""Whole jobs, from text feeds written to a folder to forecasts and errors."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gridcast.operators.boosted import fit_hourly_gbt, score_hourly
from gridcast.operators.kpi import kpis, monthly_kpis
from gridcast.plans.forecasts import backtest, forecast_day, forecast_days, forecast_long_term, split_off_weather
from gridcast.operators.splits import split_day
from gridcast.plans.features import feature_columns
from gridcast.plans.prepare import prepare_long_term, prepare_short_term, published_names
from gridcast.sources.store import read_table, write_table


def temperature(day, hour):
    return round(12 + 8 * math.sin(day / 11) + 3 * math.cos(hour / 4) + ((day * 7 + hour * 3) % 5) / 10, 2)


def load(day, hour):
    return 50000 + 900 * hour + 400 * temperature(day, hour) + 50 * (day % 7)


@pytest.fixture(scope="module")
def short_feeds(tmp_path_factory):
    root = tmp_path_factory.mktemp("short")
    first = dt.date(2014, 1, 1)
    files = {k: [] for k in ("load", "sun", "temperature", "daytype")}
    for d in range(90):
        date = first + dt.timedelta(days=d)
        fr = date.strftime("%d/%m/%Y")
        files["sun"].append(f"{date}  07:{d % 60:02d}  17:30  10:15")
        for h in range(24):
            slots = "  ".join(f"{load(d, h) + s:.1f}" for s in (-5, -3, -1, 1, 3, 5))
            files["load"].append(f"{fr}  {h:02d}:00  {slots}")
            files["temperature"].append(f"{fr}  {h:02d}:00  {temperature(d, h)}")
            files["daytype"].append(f"{fr}  {h:02d}:00  0  0  {100 if d == 40 else 0}  0  0")
    for kind, lines in files.items():
        (root / f"{kind}_2014.txt").write_text("\n".join(lines) + "\n")
    return str(root)


def test_next_day_job(spark, short_feeds, tmp_path):
    features = prepare_short_term(spark, short_feeds)
    write_table(features.withColumn("part", F.month("date")), str(tmp_path / "prepared"), by=("part",))
    stored = read_table(spark, str(tmp_path / "prepared"))
    rows = stored.filter("date = '2014-02-10' AND hour = 6").collect()
    assert len(rows) == 1
    r, day = rows[0], 40
    assert math.isclose(r.load, load(day, 6)) and (r.bank_holiday, r.off_work) == (100.0, 100.0)
    assert r.temperature_lag3 == temperature(day, 3) and r.temperature_lag120 == temperature(day - 5, 6)
    assert math.isclose(r.lag0, load(day - 1, 9)) and math.isclose(r.lag337, load(day - 15, 8))
    assert math.isclose(r.temperature_max_d1, max(temperature(day - 1, h) for h in range(24)))
    assert (r.sun_rise, r.sun_down) == (7.40, 17.30)
    first = stored.agg(F.min("date")).first()[0]
    assert first == dt.date(2014, 1, 16)  # 352 hours of history are needed
    out = forecast_day(stored, ["series_id"], "2014-03-20", ["temperature_lag24", "lag0", "lag24"])
    e = kpis(out).first()
    assert e.n == 24 and e.mape < 0.05


def test_published_column_names(spark, short_feeds):
    names = published_names(prepare_short_term(spark, short_feeds)).columns
    for want in ("Date", "Heure", "Consommation", "annee", "mois", "jour_semaine", "Proba_out_of_work", "Pont", "Rise",
                 "temperature_Lag3", "temperature_Lag120", "temperature_MeanJ-1", "temperature_MinJ-2", "Lag0", "Lag337",
                 "Consommation_Mean_J-2", "mois_12", "jour_semaine_6"):
        assert want in names
    assert len(set(names)) == len(names) and "temperature" not in names


def test_all_columns_feed_a_boosted_model(spark, short_feeds):
    features = prepare_short_term(spark, short_feeds)
    columns = feature_columns(features)
    assert len(columns) == len(features.columns) - 7 and "year" not in columns and "lag0" in columns
    train, test = split_day(features, "2014-03-20")
    models = fit_hourly_gbt(train, columns, "load", hours=[7], maxIter=20, maxDepth=3, stepSize=0.2, subsamplingRate=1.0)
    e = kpis(score_hourly(test.filter("hour = 7"), models, columns)).first()
    assert e.n == 1 and e.mape < 0.1


def test_forecast_before_actuals_exist(spark, short_feeds, tmp_path):
    for kind in ("load", "sun", "temperature", "daytype"):
        lines = open(f"{short_feeds}/{kind}_2014.txt").read().splitlines()
        kept = lines[: 85 * 24] if kind == "load" else lines  # load ends on 26 March, weather on 31 March
        (tmp_path / f"city_{kind}_2014.txt").write_text("\n".join(kept) + "\n")
    prefixes = {k: f"city_{k}" for k in ("load", "sun", "temperature", "daytype")}
    features = prepare_short_term(spark, str(tmp_path), until="2014-03-27", prefixes=prefixes)
    out = forecast_day(features, ["series_id"], "2014-03-27", ["temperature_lag24", "lag0", "lag24"]).collect()
    assert len(out) == 24 and all(r.load is None and r.prediction is not None for r in out)
    truth = [load(85, r.hour) for r in sorted(out, key=lambda r: r.hour)]
    got = [r.prediction for r in sorted(out, key=lambda r: r.hour)]
    assert max(abs(a - b) / a for a, b in zip(truth, got, strict=True)) < 0.1


def test_bank_holiday_makes_bridges(spark, short_feeds):
    days = prepare_short_term(spark, short_feeds, kind="climate").filter("hour = 12").select("date", "bridge", "off_work")
    got = {r.date: (r.bridge, r.off_work) for r in days.collect()}
    # Monday 10 February is off next to a weekend: Friday 7 (before Saturday) is flagged as coded
    assert got[dt.date(2014, 2, 7)] == (1, 50.0) and got[dt.date(2014, 2, 10)] == (0, 100.0)
    assert got[dt.date(2014, 2, 11)] == (1, 50.0) and got[dt.date(2014, 2, 12)] == (0, 0.0)


def test_multi_day_job(spark, short_feeds):
    features = prepare_short_term(spark, short_feeds, kind="multi_day", horizons=8)
    assert features.select("horizon").distinct().count() == 8
    clean = prepare_short_term(spark, short_feeds, kind="multi_day", horizons=8, noise_seed=None)
    join = ["issue_date", "horizon", "date", "hour"]
    diff = features.select(*join, "temperature_lag3").join(clean.select(*join, F.col("temperature_lag3").alias("t")), join)
    error = F.avg(F.abs(F.col("temperature_lag3") - F.col("t"))).alias("d")
    by = {r.horizon: r.d for r in diff.groupBy("horizon").agg(error).collect()}
    assert all(by[j] == 0 for j in range(1, 7)) and by[7] > 0.5 and by[8] > by[7]
    out = forecast_days(features, ["series_id"], "2014-03-15", ["lag0", "lag24"])
    assert kpis(out, ["horizon"]).count() == 8 and out.count() == 8 * 24


def test_climate_job(spark, short_feeds):
    features = prepare_short_term(spark, short_feeds, kind="climate")
    assert {"temperature", "temperature_lag51"} <= set(features.columns) and "lag0" not in features.columns
    out = split_off_weather(features, ["series_id"], "2014-03-01", "2014-03-16", ["temperature", "temperature_lag3"])
    r = out.agg(F.count("*").alias("n"), F.min("climate_part").alias("lo"),
                F.max(F.col("climate_part") - F.col("load")).alias("over")).first()
    assert r.n == 15 * 24 and r.lo >= 0 and r.over <= 0


def test_walk_forward_job(spark, short_feeds):
    features = prepare_short_term(spark, short_feeds, kind="climate")
    out = backtest(features, ["series_id"], ["temperature", "temperature_lag3"], by=["hour"])
    rows = {str(r.month): r for r in monthly_kpis(out).collect()}
    assert [(m, rows[m].days) for m in sorted(rows)] == [("2014-01-01", 0), ("2014-02-01", 28), ("2014-03-01", 31)]
    assert rows["2014-03-01"].mape < 0.02


def changed(short_feeds, folder, **edits):
    """A copy of the feeds; each edit takes and gives the lines of one kind."""
    for kind in ("load", "sun", "temperature", "daytype"):
        lines = open(f"{short_feeds}/{kind}_2014.txt").read().splitlines()
        (folder / f"{kind}_2014.txt").write_text("\n".join(edits.get(kind, lambda x: x)(lines)) + "\n")
    return str(folder)


def test_a_missing_weather_day_shifts_no_lag(spark, short_feeds, tmp_path):
    root = changed(short_feeds, tmp_path, temperature=lambda x: [t for t in x if not t.startswith("26/01/2014")])
    whole = prepare_short_term(spark, short_feeds, kind="climate")
    gappy = prepare_short_term(spark, root, kind="climate")
    columns = ["date", "hour", *[c for c in whole.columns if c.startswith("temperature_lag")]]
    known = {(r.date, r.hour): r for r in whole.select(columns).collect()}
    rows = gappy.select(columns).collect()
    # what is left equals the whole table; rows that look at the missing day are gone
    assert rows and all(known[(r.date, r.hour)] == r for r in rows)
    gone = {str(d) for d, _ in set(known) - {(r.date, r.hour) for r in rows}}
    assert gone == {f"2014-01-{d}" for d in (26, 27, 28, 29, 30)} | {"2014-01-31"} & gone


def test_the_first_of_repeated_rows_stays(spark, short_feeds, tmp_path):
    def twice(lines, start, new):
        at = next(i for i, t in enumerate(lines) if t.startswith(start))
        return [*lines[:at + 1], new, *lines[at + 1:]]

    root = changed(
        short_feeds, tmp_path,
        sun=lambda x: twice(x, "2014-02-10", "2014-02-10  01:00  02:00  03:00"),
        temperature=lambda x: twice(x, "10/02/2014  06:00", "10/02/2014  06:00  -99"),
        load=lambda x: twice(x, "10/02/2014  06:00", "10/02/2014  06:00  1  1  1  1  1  1"),
        daytype=lambda x: twice(x, "10/02/2014  00:00", "10/02/2014  00:00  1  1  1  1  1"))
    same = ["date", "hour", "load", "sun_rise", "off_work", "temperature"]
    want, got = (prepare_short_term(spark, r, kind="climate").select(same).filter("date = '2014-02-10'").collect()
                 for r in (short_feeds, root))
    assert sorted(want) == sorted(got) and len(got) == 24


def test_an_unknown_load_gives_way_to_a_known_one(spark, short_feeds, tmp_path):
    def blank_first(lines):
        at = next(i for i, t in enumerate(lines) if t.startswith("10/02/2014  06:00"))
        return [*lines[:at], "10/02/2014  06:00", *lines[at:]]

    root = changed(short_feeds, tmp_path, load=blank_first)
    row = prepare_short_term(spark, root, kind="climate").filter("date = '2014-02-10' AND hour = 6").first()
    assert math.isclose(row.load, load(40, 6))


def test_sites_become_series(spark, short_feeds, tmp_path):
    changed(short_feeds, tmp_path)
    for site in ("north", "south"):
        (tmp_path / site).mkdir()
        (tmp_path / site / "load_2014.txt").write_text((tmp_path / "load_2014.txt").read_text())
    (tmp_path / "load_2014.txt").unlink()
    got = prepare_short_term(spark, str(tmp_path), sites=True).groupBy("series_id").count().collect()
    one = prepare_short_term(spark, short_feeds).count()
    assert {r.series_id: r["count"] for r in got} == {"north": one, "south": one}


def test_walk_forward_scores_months_without_actuals(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2015-05-31')) AS date")
    df = days.crossJoin(spark.createDataFrame([("A",), ("B",)], "s string")).withColumn("x", F.dayofmonth("date") * 1.0)
    unknown = (F.col("s") == "A") & (F.month("date") == 5)
    df = df.withColumn("load", F.when(unknown, None).when((F.col("s") == "A") & (F.month("date") == 3), 0.0).otherwise(100 + F.col("x")))
    out = backtest(df, ["s"], ["x"])
    got = {(r.s, r.m): (r.n, r.p) for r in out.groupBy("s", F.month("date").alias("m")).agg(
        F.count("*").alias("n"), F.count("prediction").alias("p")).collect()}
    days_of = {1: 31, 2: 28, 3: 31, 4: 30, 5: 31}
    assert got == {(s, m): (n, 0 if m == 1 else n) for s in "AB" for m, n in days_of.items()}


@pytest.fixture(scope="module")
def long_feeds(tmp_path_factory):
    """Half-hour readings in 2005-2008, ten-minute readings from 2009, weather to 2014."""
    root = tmp_path_factory.mktemp("long")
    for year in range(2005, 2015):
        loads, sun, temps = [], [], []
        day = dt.date(year, 1, 1)
        while day.year == year:
            fr, base = day.strftime("%d/%m/%Y"), 30000 + 500 * (year - 2005)
            sun.append(f"{day};07:45;16:59;09:14")
            temps.append(f"{day};{10 + day.month}.5")
            if year < 2012:
                for h in (0, 12):
                    v = base + 100 * h + 50 * day.month
                    if year < 2009:
                        loads += [f"{fr} {h:02d}:00 {v - 10}", f"{fr} {h:02d}:30 {v + 10}"]
                    else:
                        loads.append(f"{fr} {h:02d}:00 {v} {v} {v} {v} {v} {v}")
            day += dt.timedelta(days=1)
        (root / f"sun_{year}.txt").write_text("\n".join(sun) + "\n")
        (root / f"temperature_{year}.txt").write_text("\n".join(temps) + "\n")
        if loads:  # the future has weather and no load
            (root / f"load_{year}.txt").write_text("\n".join(loads) + "\n")
    return str(root)


def test_three_year_job(spark, long_feeds):
    features = prepare_long_term(spark, long_feeds, until="2014-12-31", low_before="2012-01-01").persist()
    known = {(str(r.date), r.hour): r for r in features.filter("date IN ('2008-03-05', '2010-05-13')").collect()}
    assert known[("2008-03-05", 12)].load == 30000 + 1500 + 1200 + 150
    r = known[("2010-05-13", 0)]
    assert (r.load, r.holiday, r.sun_rise, r.temperature) == (30000 + 2500 + 250, 1, 7.45, 15.5)
    assert r.temperature_lag1 == 15.5 and r["month_5"] == 1
    assert features.filter("date < '2012-01-01' AND load < 25000").count() == 0
    future = features.filter("date >= '2012-01-01'").groupBy(F.year("date").alias("y")).agg(
        F.count("*").alias("n"), F.max("load").alias("most"))
    assert {r.y: (r.n, r.most) for r in future.collect()} == {2012: (8784, 0.0), 2013: (8760, 0.0), 2014: (8760, 0.0)}
    history = features.filter("load > 0")
    out = forecast_long_term(history, ["series_id"], "2010-01-01", ["temperature"], by=["hour"], years=2)
    e = kpis(out).first()
    assert e.n == 2 * 730 and e.mape < 0.05
    features.unpersist()
