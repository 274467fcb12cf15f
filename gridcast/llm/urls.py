"""URL filters: fixed rules, and an empirical-Bayes reputation of hosts for what no rule fits.

Labelled page outcomes are counted per host.  A host's rate of good pages has a beta prior around its registered
domain's rate, a domain's around its suffix's, a suffix's around the rate of all pages, each without the outcomes of
the child itself.  How tightly the rates of one
level lie around the level above is estimated from all their counts (method of moments).  A host is blocked where even
the upper bound of its posterior rate is under the threshold; a host without outcomes has its prior.

Counts are one row per host, made with map-side combine; hosts, domains and suffixes are joined by key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import ascii_lower, checkpointed

# Common public suffixes of two labels.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
                      "com.cn", "com.mx", "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")

# Parts of a host that are no part of its name, addresses, and the suffix that stands for all addresses.
USER, PORT = r"^([^@]*@)+", r"(:[0-9]*)?\.?\z"
ADDRESS, ADDRESSES = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*)\z", "[address]"


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str  # host, then path from its slash

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return self.rule[len(self.host):]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; nothing for a null or another url."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits (of equal ones the first), else nulls."""
    chain = None
    for r in sorted(rules, key=lambda r: -len(r.rule)):
        value = F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chain = F.when(r.fits(host, path), value) if chain is None else chain.when(r.fits(host, path), value)
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return none if chain is None else chain.otherwise(none)


def name_of(host: Column) -> Column:
    """The host without a user before ``@``, a port and a closing dot: what a reputation belongs to."""
    return F.regexp_replace(F.regexp_replace(host, USER, ""), PORT, "")


def is_address(name: Column) -> Column:
    """Four numbers, or an address in brackets; such names have no labels."""
    return name.rlike(ADDRESS)


def suffix_of(name: Column) -> Column:
    """The public suffix: the last label, or two of a known pair; an empty name has an empty one, and all addresses
    have ``ADDRESSES``."""
    two = F.substring_index(name, ".", -2)
    return F.when(is_address(name), ADDRESSES).when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(
        F.substring_index(name, ".", -1))


def domain_of(name: Column) -> Column:
    """The registered domain: the suffix and one label before it; a name without one, or an address, is its own."""
    two = F.substring_index(name, ".", -2)
    return F.when(is_address(name), name).when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(name, ".", -3)).otherwise(two)


def with_suffixes(names: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``names`` (distinct ``name``) with ``domain`` and ``suffix``.

    ``suffixes``: a table of public suffixes of any number of labels in the column ``suffix``, such as a published list;
    the longest that ends a name counts, else its last label.  Without a table the fixed pairs count.
    """
    if suffixes is None:
        return names.withColumns({"domain": domain_of(F.col("name")), "suffix": suffix_of(F.col("name"))})
    labels = F.split("name", r"\.")
    ends = names.where(~is_address(F.col("name"))).select("name", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("labels"))
    ends = ends.withColumn("suffix", F.expr("substring_index(name, '.', -labels)"))
    known = suffixes.select("suffix").where("suffix IS NOT NULL").distinct()
    longest = ends.join(known, "suffix", "left_semi").groupBy("name").agg(F.max("labels").alias("labels"))
    found = names.join(longest, "name", "left").withColumn("labels", F.coalesce("labels", F.lit(1)))
    address = is_address(F.col("name"))
    return found.withColumns({
        "domain": F.when(address, F.col("name")).otherwise(F.expr("substring_index(name, '.', -labels - 1)")),
        "suffix": F.when(address, ADDRESSES).otherwise(F.expr("substring_index(name, '.', -labels)")),
    }).drop("labels")


def _level(rows: DataFrame) -> DataFrame:
    """Posterior parameters ``a`` and ``b`` and mean ``rate`` of the rows of one level.

    ``rows``: keys, n, good, and ``above_a`` and ``above_b``, the parameters of the level above.  A row's prior mean is
    the rate above without the row's own outcomes, which would count twice.  The prior's strength is 1 / rho - 1, where
    rho is the share of the children's variance that the binomial does not explain, kept between 0.0001 and 0.5.
    """
    prior = (F.col("above_a") - F.col("good")) / (F.col("above_a") + F.col("above_b") - F.col("n"))
    joined = checkpointed(rows.withColumn("prior", prior).drop("above_a", "above_b"))
    p, m, n = F.col("good") / F.col("n"), F.col("prior"), F.col("n").cast("double")
    known = joined.where("n > 0")
    spread, expected, extra = known.agg(
        F.sum(n * (p - m) * (p - m)), F.sum(m * (1 - m)), F.sum((n - 1) * m * (1 - m))).first()
    rho = (spread - expected) / extra if extra else 0.0
    strength = 1 / min(0.5, max(1e-4, rho)) - 1
    a = F.lit(strength) * m + F.col("good")
    b = F.lit(strength) * (1 - m) + F.col("n") - F.col("good")
    return joined.withColumn("a", a).withColumn("b", b).withColumn("rate", F.col("a") / (F.col("a") + F.col("b")))


def reputation(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """(name, a, b, rate) from (name, n, good): beta posterior of every name, shrunk host to domain to suffix."""
    rows = checkpointed(with_suffixes(hosts.select("name", "n", "good"), suffixes))
    counts = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    total, good = (x or 0 for x in rows.agg(*counts).first())

    def under(above: DataFrame, key: str) -> DataFrame:
        return above.select(key, F.col("a").alias("above_a"), F.col("b").alias("above_b"))

    suffixes = _level(rows.groupBy("suffix").agg(*counts).select(
        "*", F.lit(good + 1.0).alias("above_a"), F.lit(total - good + 1.0).alias("above_b")))
    domains = _level(rows.groupBy("domain", "suffix").agg(*counts).join(under(suffixes, "suffix"), "suffix"))
    return _level(rows.drop("suffix").join(under(domains, "domain"), "domain")).select("name", "a", "b", "rate")


def upper_bound(z: float) -> Column:
    """Mean of the beta posterior and ``z`` of its standard deviations."""
    a, b = F.col("a"), F.col("b")
    return a / (a + b) + F.lit(z) * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...], threshold: float = 0.5, z: float = 1.645,
          key: str = "page_id", url: str = "url", suffixes: DataFrame | None = None) -> DataFrame:
    """(key, host, path, rule, verdict, reputation) of every page.

    ``outcomes``: (host, good) of labelled pages, good 0 or 1; rows of other values are left out.  Hosts that differ in a
    user, a port or a closing dot have one reputation; addresses have a level of their own; ``suffixes`` see
    ``with_suffixes``.  The verdict is the rule's, else ``block`` where the host's bound is under ``threshold``, else ``allow``.  A null url, or one without
    ``://``, has an empty host and path, and is judged as the host "".  Without outcomes every rate is 0.5, and nothing
    is blocked by it.  Repeated rows each get a result; further columns are not read.
    """
    split = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    counted = outcomes.where(F.col("good").isin(0, 1)).groupBy(name_of(F.col("host")).alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    split = split.withColumn("name", name_of(F.col("host")))
    hosts = split.select("name").distinct().join(counted, "name", "full").select(
        "name", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("good", F.lit(0)).alias("good"))
    rated = reputation(hosts, suffixes).select("name", "rate", upper_bound(z).alias("bound"))
    own = rule_of(F.col("host"), F.col("path"), rules)
    found = split.select("key", "host", "path", "name", own.alias("own")).join(rated, "name", "left")
    method = F.when(F.col("bound") < threshold, "block").otherwise("allow")
    return found.select(F.col("key").alias(key), "host", "path", F.col("own.rule").alias("rule"),
                        F.coalesce("own.verdict", method).alias("verdict"), F.col("rate").alias("reputation"))


def judge_sql(rules: tuple[Rule, ...], outcomes: str, threshold: float = 0.5, z: float = 1.645) -> str:
    """The same rows (without the reputation) for DuckDB; ``outcomes``: a query for (host, good) over ``split``."""
    pairs = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    values = ", ".join(f"({k}, '{r.verdict}', '{r.rule}', '{r.host}', '{r.path}')"
                       for k, r in enumerate(sorted(rules, key=lambda r: -len(r.rule))))
    name = f"regexp_replace(regexp_replace(host, '{USER}', ''), '{PORT}', '')"
    prior = "(a - good) / (a + b - n) AS prior"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def level(name: str, rows: str) -> str:
        return f"""
{name}_rho AS (SELECT coalesce((sum(n * (good / n - prior) * (good / n - prior)) - sum(prior * (1 - prior)))
    / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0) AS rho FROM ({rows}) WHERE n > 0),
{name}_fit AS (SELECT *, strength * prior + good AS a, strength * (1 - prior) + n - good AS b FROM ({rows})
    CROSS JOIN (SELECT 1 / least(0.5, greatest(1e-4, rho)) - 1 AS strength FROM {name}_rho))"""

    return f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
split AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{upper}', '{lower}') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
outcomes AS ({outcomes}),
counted AS (SELECT {name} AS name, count(*)::DOUBLE AS n, sum(good)::DOUBLE AS good FROM outcomes WHERE good IN (0, 1)
  GROUP BY 1),
parts AS (SELECT name, coalesce(n, 0) AS n, coalesce(good, 0) AS good, string_split(name, '.') AS ls,
    regexp_matches(name, '{ADDRESS}') AS address
  FROM (SELECT DISTINCT {name} AS name FROM split) FULL JOIN counted USING (name)),
named AS (SELECT *, array_to_string(ls[-2:], '.') IN ({pairs}) AS two FROM parts),
hosts AS (SELECT name, n, good,
  CASE WHEN address THEN '{ADDRESSES}' ELSE array_to_string(CASE WHEN two THEN ls[-2:] ELSE ls[-1:] END, '.') END AS suffix,
  CASE WHEN address THEN name ELSE array_to_string(CASE WHEN two THEN ls[-3:] ELSE ls[-2:] END, '.') END AS domain
  FROM named),
top AS (SELECT coalesce(sum(good), 0) + 1 AS a, coalesce(sum(n) - sum(good), 0) + 1 AS b FROM hosts),
{level("s", f"SELECT h.*, {prior} FROM (SELECT suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY suffix) h CROSS JOIN top")},
{level("d", f"SELECT h.*, {prior} FROM (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL) h JOIN (SELECT suffix, a, b FROM s_fit) USING (suffix)")},
{level("h", f"SELECT h.*, {prior} FROM (SELECT name, domain, n, good FROM hosts) h JOIN (SELECT domain, a, b FROM d_fit) USING (domain)")},
rules(k, verdict, rule, rhost, rpath) AS (VALUES {values}),
fits AS (SELECT page_id, host, path, arg_min(rule, k) AS rule, arg_min(verdict, k) AS verdict
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY ALL)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, CASE WHEN a / (a + b)
    + {z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) < {threshold} THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fits f USING (page_id, host, path) LEFT JOIN h_fit h ON h.name = {name.replace('host', 's.host')}"""
