"""Parts of urls, rules, and shrinkage of host rates."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridcast.llm import queries, urls

RULES = queries.URL_RULES

CASES = [
    # url, host, path, rule, verdict by rule
    (None, "", "", None, None), ("", "", "", None, None), ("no scheme/x", "", "", None, None),
    ("http://A.Example.COM/en/1?q#f", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://x.www.example.com/en/x", "x.www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://www.example.com/fr/", "www.example.com", "/fr/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://com/", "com", "/", "com/", "allow"), ("http://com", "com", "", None, None),
    ("http://b.net/es/9", "b.net", "/es/9", "net/es/", "block"), ("http://b.net/es", "b.net", "/es", None, None),
    ("http://b.net/fr/9#x", "b.net", "/fr/9", "net/fr/", "block"), ("ftp://h?x/y", "h", "", None, None),
    ("http://h#x/y", "h", "", None, None), ("a://b://c/d", "b:", "//c/d", None, None), ("://h.net/de/", "h.net", "/de/", None, None),
    ("http://ÀÉ.net/es/", "ÀÉ.net", "/es/", "net/es/", "block"), ("http:///p", "", "/p", None, None),
]


@pytest.fixture
def pages(spark):
    rows = [(i, c[0], "<html>", "h") for i, c in enumerate(CASES)] + [(None, "http://b.net/es/", "", "")] * 2
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string").selectExpr(
        "*", "'v' AS verdict", "0 AS n", "1 AS good", "'r' AS rate")


def outcomes(spark, rows):
    return spark.createDataFrame(rows or [("x", None)], "host string, good int")


def test_parts_and_rules(spark, pages):
    got = urls.judge(pages, outcomes(spark, []), RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "reputation"]
    want = Counter((i, h, p, r, v or "allow") for i, (_, h, p, r, v) in enumerate(CASES))
    want[(None, "b.net", "/es/", "net/es/", "block")] = 2
    assert Counter(tuple(r)[:5] for r in got.collect()) == want


def test_empty_tables(spark, pages):
    assert urls.judge(pages.where("false"), outcomes(spark, [("a", 1)]), RULES).collect() == []


def test_suffixes_and_domains(spark):
    hosts = {"a.b.example.co.uk": ("co.uk", "example.co.uk"), "co.uk": ("co.uk", "co.uk"), "x.example.com": ("com", "example.com"),
             "localhost": ("localhost", "localhost"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r.host: (r.s, r.d) for r in df.select("host", urls.suffix_of(F.col("host")).alias("s"), urls.domain_of(F.col("host")).alias("d")).collect()}
    assert got == hosts


def test_names_and_addresses(spark):
    hosts = {"ex.com:8080": ("ex.com", "com", "ex.com"), "u@a.ex.com": ("a.ex.com", "com", "ex.com"), "u:p@x@ex.com.": ("ex.com", "com", "ex.com"),
             "1.2.3.4": ("1.2.3.4", "[address]", "1.2.3.4"), "1.2.3.4:80": ("1.2.3.4", "[address]", "1.2.3.4"),
             "[::1]:80": ("[::1]", "[address]", "[::1]"), "b:": ("b", "b", "b"), "": ("", "", ""), "u@": ("", "", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string").withColumn("name", urls.name_of(F.col("host")))
    got = {r.host: (r.name, r.suffix, r.domain) for r in urls.with_suffixes(df).collect()}
    assert got == hosts


def test_a_table_of_suffixes(spark):
    table = spark.createDataFrame([("io",), ("github.io",), ("a.b.c",), (None,), ("io",)], "suffix string")
    names = {"x.github.io": ("github.io", "x.github.io"), "y.x.github.io": ("github.io", "x.github.io"), "github.io": ("github.io", "github.io"),
             "q.io": ("io", "q.io"), "r.q.a.b.c": ("a.b.c", "q.a.b.c"), "w.unknown": ("unknown", "w.unknown"), "": ("", ""),
             "1.2.3.4": ("[address]", "1.2.3.4")}
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert {r.name: (r.suffix, r.domain) for r in urls.with_suffixes(df, table).collect()} == names


def test_ports_and_users_share_a_reputation(spark):
    labelled = [("spam.bad.org:81", 0)] * 20 + [("u@spam.bad.org", 0)] * 20 + [(f"g{i}.good.net", 1) for i in range(40) for _ in range(5)]
    pages = spark.createDataFrame([(1, "http://spam.bad.org/"), (2, "http://spam.bad.org:9/x"), (3, "http://g1.good.net/")],
                                  "page_id bigint, url string")
    rows = {r.page_id: (r.host, r.verdict) for r in urls.judge(pages, outcomes(spark, labelled), ()).collect()}
    assert rows == {1: ("spam.bad.org", "block"), 2: ("spam.bad.org:9", "block"), 3: ("g1.good.net", "allow")}


def test_bad_hosts_are_blocked_when_enough_is_known(spark):
    labelled = [(f"g{i}.good.org", 1) for i in range(40) for _ in range(10)] + [("spam.bad.org", 0)] * 30
    labelled += [("spam.bad.org", 1)] + [("once.other.org", 0)] + [("x", 7), ("x", None)]
    hosts = ["g1.good.org", "spam.bad.org", "once.other.org", "new.bad.org", "new.good.org", "unseen.net"]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id bigint, url string")
    rows = {r.host: r for r in urls.judge(pages, outcomes(spark, labelled), ()).collect()}
    verdicts = {h: r.verdict for h, r in rows.items()}
    assert verdicts["spam.bad.org"] == "block" and verdicts["g1.good.org"] == verdicts["new.good.org"] == "allow"
    assert verdicts["once.other.org"] == "allow"  # one bad page proves little
    # a new host takes its domain's rate: worse than a new host of a good domain
    assert rows["new.bad.org"].reputation < rows["unseen.net"].reputation < rows["new.good.org"].reputation


def test_no_python(spark, small):
    plan = queries.QUERIES["op8_url_reputation"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
