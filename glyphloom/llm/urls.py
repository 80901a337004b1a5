"""URL filters by rules and by empirical-Bayes host reputation: DataFrame functions only.

A rule names a host, with its subdomains, and the start of a path; the longest fitting rule judges a page. Pages that no rule fits are judged by their host's reputation. A page with a host that a rule fits is labelled, with the rule's verdict as its outcome (1: blocked, 0: not); the others are what is to be judged and count neither way. Block rates of labelled pages are shrunk level by level through beta-binomial priors: the suffix towards the whole table, the registered domain towards its suffix, the host towards its registered domain. The strength s of each prior, in pages, is estimated by moments from the spread of the rates of that level (empirical Bayes). Pages of one host are alike, so towards the level above n of them count as n(s + 1)/(n + s), which stays below s + 1: one large host doesn't speak for its suffix. A page is blocked if the lower posterior bound (mean minus Z standard deviations) of its host passes BOUND.

All sums are counted with partial aggregation, one row for each host leaves a task, and a hot host is one row of the table that pages are joined with. That table of hosts is written once; pages are read to make it and to be judged. Rates are compared in double precision.

Null url or one without "://": host and path are empty, no rule fits and the empty host has no labelled page: allowed, unless everything is blocked. Repeated rows are separate pages. An empty table gives no rows. Columns host, path, rule and verdict of the input are replaced, others stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, col, fresh, table

#: (verdict, host, path): the fixed rules.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Suffixes of two labels under which names are registered; any other suffix is the last label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
Z = 2.0
BOUND = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path, both empty without "://"."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _longest(what: int | None, rules=RULES) -> Column:
    """The verdict (what 0) or the name (None) of the longest rule that fits columns host and path."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = (F.concat(F.lit("."), "host").endswith("." + rule[1])) & F.col("path").startswith(rule[2])
        value = F.lit(rule[1] + rule[2] if what is None else rule[what])
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("string")


def with_site(df: DataFrame) -> DataFrame:
    """Adds suffix and domain (registered) to column host."""
    labels = F.split("host", r"\.")
    two = F.concat_ws(".", F.slice(labels, -2, 2))
    n = F.when(two.isin(*LONG_SUFFIXES), 2).otherwise(1)
    tail = lambda k: F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), k))
    return df.withColumn("suffix", tail(n)).withColumn("domain", tail(n + 1))


def reputation(judged: DataFrame, z: float = Z) -> DataFrame:
    """(host, domain, suffix, bad: 0, 1 or null) of pages to (host, n, mean, lower) for every host.

    n labelled pages; posterior mean and lower bound of the host's block rate.
    """
    sums = lambda df, *by: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    hosts = checkpoint(judged.groupBy("suffix", "domain", "host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k")))
    domains, suffixes = sums(hosts, "suffix", "domain"), sums(hosts, "suffix")
    rate = lambda df, *by: df.select(*by, (F.col("k") / F.when(F.col("n") > 0, F.col("n"))).alias("m"))
    every = hosts.agg(F.coalesce(F.sum("k") / F.when(F.sum("n") > 0, F.sum("n")), F.lit(0.5)).alias("m")).first().m
    s_suffix = _strength(suffixes.withColumn("m", F.lit(every)))
    s_domain = _strength(domains.join(rate(suffixes, "suffix"), "suffix"))
    s_host = _strength(hosts.join(rate(domains, "suffix", "domain"), ["suffix", "domain"]))
    domains = sums(_effective(hosts, s_host), "suffix", "domain")
    suffixes = sums(_effective(domains, s_domain), "suffix")
    top = _effective(suffixes, s_suffix).agg(F.round((F.coalesce(F.sum("k"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2), 9).alias("m")).first().m
    level = _posterior(suffixes.withColumn("m", F.lit(top)), s_suffix).select("suffix", F.col("mean").alias("m"))
    level = _posterior(domains.join(level, "suffix"), s_domain).select("suffix", "domain", F.col("mean").alias("m"))
    level = _posterior(hosts.join(level, ["suffix", "domain"]), s_host)
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return level.select("host", "n", "mean", F.round(F.col("mean") - F.lit(float(z)) * deviation, 9).alias("lower"))


def _strength(level: DataFrame) -> float:
    """The strength s of the prior of a level (n, k, m: the rate of the level above), from 1 to 999.

    By moments: sum of n(rate - m)^2 is expected to be sum of m(1-m)(1 + (n-1)/(s+1)). A prior weighs at most as many pages as the level has labelled units: what a single host does says little of others.
    """
    m, n = F.col("m"), F.col("n")
    off = F.col("k") / n - m
    got = level.where("n > 0").agg(
        F.round(F.sum(n * off * off), 6).alias("spread"),
        F.round(F.sum(m * (1 - m)), 6).alias("sampling"),
        F.round(F.sum(m * (1 - m) * (n - 1)), 6).alias("extra"),
        F.greatest(F.count("*"), F.lit(1)).cast("double").alias("units"),
    )
    excess = F.greatest(F.col("spread") - F.col("sampling"), F.lit(0.0))
    strength = F.when(excess * 1000 > F.col("extra"), F.col("extra") / excess - 1).otherwise(F.lit(999.0))
    return got.select(F.round(F.least(F.greatest(F.coalesce(strength, F.lit(1.0)), F.lit(1.0)), F.lit(999.0), F.col("units")), 4).alias("s")).first().s


def _effective(level: DataFrame, s: float) -> DataFrame:
    """n and k as they count towards the level above."""
    share = F.lit(s + 1) / (F.col("n") + F.lit(s))
    return level.withColumn("k", F.round(F.col("k") * share, 9)).withColumn("n", F.round(F.col("n") * share, 9))


def _posterior(level: DataFrame, s: float) -> DataFrame:
    """Adds mean and weight: the beta posterior of (n, k) under a prior with mean m and strength s."""
    weight = F.col("n") + F.lit(s)
    return level.withColumn("mean", F.round((F.col("k") + F.lit(s) * F.col("m")) / weight, 9)).withColumn("weight", weight)


def judge(pages: DataFrame, rules=RULES, z: float = Z, bound: float = BOUND) -> DataFrame:
    """Pages with columns host, path, rule and verdict, which replace those of pages if there are any; pages needs url."""
    known, bad = fresh(pages, "known_host", "known_bad")
    host, path = url_parts(F.col("url"))
    parts = pages.withColumn("host", host).withColumn("path", path)
    parts = parts.withColumn("rule", _longest(None, rules)).withColumn("verdict", _longest(0, rules))
    outcome = F.when(F.col("host") != "", F.when(F.col("verdict") == "block", 1).when(F.col("verdict") == "allow", 0))
    hosts = reputation(with_site(parts.select("host", outcome.alias("bad"))), z).where(F.col("lower") > F.lit(float(bound))).select(F.col("host").alias(known), F.lit(True).alias(bad))
    out = parts.join(hosts, (F.col("host") == F.col(known)) & F.col("verdict").isNull(), "left")
    verdict = F.coalesce("verdict", F.when(F.col(bad), F.lit("block")).otherwise(F.lit("allow")))
    return out.withColumn("verdict", verdict).select(*map(col, parts.columns))


def query(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _sql(rules=RULES, z: float = Z, bound: float = BOUND) -> str:
    cases = {"rule": "", "given": ""}
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = f"WHEN ends_with('.' || host, '.{host}') AND starts_with(path, '{path}') THEN"
        cases["rule"] += f" {fits} '{host + path}'"
        cases["given"] += f" {fits} '{verdict}'"

    def strength(name: str, source: str) -> str:
        return f"""{name}_s AS (
  SELECT round(least(units, greatest(coalesce(CASE WHEN greatest(spread - sampling, 0) * 1000 > extra THEN extra / greatest(spread - sampling, 0) - 1 ELSE 999 END, 1), 1), 999), 4) AS s FROM (
    SELECT round(sum(n * (k / n - m) * (k / n - m)), 6) AS spread, round(sum(m * (1 - m)), 6) AS sampling, round(sum(m * (1 - m) * (n - 1)), 6) AS extra, greatest(count(*), 1)::DOUBLE AS units
    FROM ({source}) WHERE n > 0)
)"""

    def effective(by: str, source: str) -> str:
        return f"SELECT {by}sum(round(n * ((s + 1) / (n + s)), 9)) AS n, sum(round(k * ((s + 1) / (n + s)), 9)) AS k FROM {source}, {source}_s"

    long = ", ".join(f"'{x}'" for x in LONG_SUFFIXES)
    posterior = "round((k + s * m) / (n + s), 9)"
    return rf"""
WITH p AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), j AS (
  SELECT page_id, host, path, CASE{cases["rule"]} END AS rule, CASE{cases["given"]} END AS given FROM p
), q AS (
  SELECT *, string_split(host, '.') AS labels, CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({long}) THEN 2 ELSE 1 END AS nl FROM j
), site AS (
  SELECT host, given, array_to_string(labels[-nl:], '.') AS suffix, array_to_string(labels[-(nl + 1):], '.') AS domain FROM q
), h AS (
  SELECT suffix, domain, host, count(*) FILTER (WHERE given IS NOT NULL AND host <> '')::DOUBLE AS n, count(*) FILTER (WHERE given = 'block' AND host <> '')::DOUBLE AS k FROM site GROUP BY ALL
), {strength("u", "SELECT *, (sum(k) OVER ()) / (sum(n) OVER ()) AS m FROM (SELECT suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY suffix)")
}, {strength("d", "SELECT *, (sum(k) OVER (PARTITION BY suffix)) / nullif(sum(n) OVER (PARTITION BY suffix), 0) AS m FROM (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL)")
}, {strength("h", "SELECT *, (sum(k) OVER (PARTITION BY suffix, domain)) / nullif(sum(n) OVER (PARTITION BY suffix, domain), 0) AS m FROM h")
}, d AS ({effective("suffix, domain, ", "h")} GROUP BY suffix, domain), u AS ({effective("suffix, ", "d")} GROUP BY suffix),
t AS (SELECT round((coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2), 9) AS m FROM ({effective("", "u")})), um AS (
  SELECT suffix, {posterior} AS mean FROM u, u_s, t
), dm AS (
  SELECT suffix, domain, {posterior} AS mean FROM (SELECT d.*, um.mean AS m FROM d JOIN um USING (suffix)), d_s
), hm AS (
  SELECT host, n + s AS weight, {posterior} AS mean FROM (SELECT h.*, dm.mean AS m FROM h JOIN dm USING (suffix, domain)), h_s
), bad AS (
  SELECT host FROM hm WHERE round(mean - {z}::DOUBLE * sqrt(mean * (1 - mean) / (weight + 1)), 9) > {bound}::DOUBLE
)
SELECT page_id, j.host, path, rule, coalesce(given, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN bad ON j.host = bad.host AND given IS NULL
"""


SQL = _sql()
