"""URL filters: rules first, then the reputation of the host.

Reputation is empirical Bayes. Pages with a known outcome are counted by host, registered
domain and suffix. Each level's bad share is shrunk towards its parent's with a beta-binomial
prior, whose strength is fitted to that level by moments; the suffixes' parent is the whole
table. A host is blocked if the lower bound of its posterior bad share, mean less ``z``
standard deviations, is above ``limit``: a host with few outcomes is judged by its domain, one
with none by its domain alone. Without a ``limit`` it is the bad share of the whole table, so a
host is blocked once it is surely worse than the table. Every page carries mean and bound.

Pages are aggregated once, by host, on the map side; all levels are computed from one row per
host. A host with a third of all pages is one row of that table, and the join back can be split.

Suffixes of more than one label are a parameter, ``second_level``. Rules are a configuration of at most ``MAX_RULES`` (action, host, path) entries. A rule fits its
host and all subdomains, if the path starts with the rule's; the longest host, then the longest
path wins, of equal rules the first.

A null url, or one without ``://``, has an empty host and path and is judged like any host.
Repeated page rows come out as often as they go in; of repeated outcomes of a page the worst
counts, once. Null outcomes, or other than 0 and 1, are unknown. Other columns do not matter. Without outcomes
nothing is blocked but by rules. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table

Z = 1.645
MAX_RULES = 10_000

#: Suffixes of two labels that are known unless others are given (fixed values); any other suffix is the last label.
SECOND_LEVEL = ["ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "ne.jp", "or.jp", "org.au", "org.uk"]

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, second_level: list[str] = SECOND_LEVEL) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(second_level), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, second_level: list[str] = SECOND_LEVEL) -> Column:
    """The registered domain: the suffix and one label more."""
    return F.when(F.substring_index(host, ".", -2).isin(second_level), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The rule that wins, as a struct of action and rule; null if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    order = sorted(rules, key=lambda r: (-len(r[1]), -len(r[2])))
    fits = lambda h, p: ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
    found = None
    for action, h, p in order:
        verdict = F.struct(F.lit(action).alias("action"), F.lit(h + p).alias("rule"))
        found = F.when(fits(h, p), verdict) if found is None else found.when(fits(h, p), verdict)
    return found if found is not None else F.lit(None).cast("struct<action: string, rule: string>")


def _strength(own: DataFrame) -> float:
    """Beta-binomial prior strength by moments: 1 / rho - 1, rho the correlation inside a group."""
    spread = F.col("prior") * (1 - F.col("prior"))
    seen = own.where("n > 0")
    over, under = seen.agg(F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) - spread), F.sum((F.col("n") - 1) * spread)).first()
    rho = over / under if under else 0.0
    return 1 / min(max(rho, 1e-3), 0.5) - 1


def reputation(pages: DataFrame, outcomes: DataFrame, second_level: list[str] = SECOND_LEVEL) -> tuple[DataFrame, float]:
    """``host, n, bad, mean, deviation`` of every host of pages(page_id, url), and the bad share of all.

    outcomes: page_id, bad (0 or 1).
    """
    known = outcomes.where("page_id is not null and bad in (0, 1)").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    each = pages.select("page_id", host_of(F.col("url")).alias("host")).join(known, "page_id", "left")
    hosts = settle(each.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "hosts")
    hosts = hosts.select("host", domain_of(F.col("host"), second_level).alias("domain"), suffix_of(F.col("host"), second_level).alias("suffix"), F.lit("").alias("all"), "n", "bad")
    total, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    mean = bad / total if total else 0.0
    parent, up = hosts.select("all").distinct().withColumn("mean", F.lit(float(mean))), "all"
    for key in ("suffix", "domain", "host"):
        own = hosts.groupBy(key, up).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(parent, up).withColumnRenamed("mean", "prior")
        m = _strength(own)
        a, size = F.col("bad") + m * F.col("prior"), F.col("n") + m
        parent = settle(own.select(key, "n", "bad", (a / size).alias("mean"), F.sqrt((a / size) * (1 - a / size) / (size + 1)).alias("deviation")), key)
        if key != "host":
            parent = parent.select(key, "mean")
        up = key
    return parent, mean


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES, limit: float | None = None, z: float = Z, second_level: list[str] = SECOND_LEVEL) -> DataFrame:
    """``page_id, host, path, rule, verdict, mean, bound`` for every row of pages."""
    hosts, share = reputation(pages, outcomes, second_level)
    scored = hosts.select("host", "mean", (F.col("mean") - z * F.col("deviation")).alias("bound"))
    each = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = each.join(scored, "host").withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("bound") > (share if limit is None else limit), "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.action", own).alias("verdict"), "mean", "bound")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its host, path, rule and verdict, and the posterior of its host.

    A page shows the document whose number ends its path's second part; its outcome is bad if
    that document is labelled toxic or of low quality.
    """
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = F.greatest(1 - F.col("quality"), F.col("toxic")).alias("bad")
    shown = pages.select("page_id", F.regexp_extract(path_of(F.col("url")), r"^/[a-z]+/([0-9]{1,18})", 1).alias("number"))
    outcomes = shown.where("number != ''").select("page_id", F.col("number").cast("long").alias("doc_id")).join(labels, "doc_id").select("page_id", bad)
    return judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict", F.round("mean", 6).alias("mean"), F.round("bound", 6).alias("bound"))


def _shrunk(key: str, up: str, prior: str) -> str:
    spread = "prior * (1 - prior)"
    return f"""
{key}_own AS (SELECT h.{key}, any_value(p.mean) AS prior, sum(h.n) AS n, sum(h.bad) AS bad FROM hosts h JOIN {prior} p USING ({up}) GROUP BY h.{key}, h.{up}),
{key}_rho AS (SELECT 1 / least(greatest(coalesce(sum(n * (bad / n - prior) ** 2 - {spread}) / nullif(sum((n - 1) * {spread}), 0), 0), 0.001), 0.5) - 1 AS m FROM {key}_own WHERE n > 0),
{key}_mean AS (SELECT {key}, n + m AS size, (bad + m * prior) / (n + m) AS mean FROM {key}_own, {key}_rho)"""


OP9_SQL = rf"""
WITH second_level(two) AS (VALUES ('ac.uk'), ('co.jp'), ('co.nz'), ('co.uk'), ('com.au'), ('com.br'), ('com.cn'), ('gov.uk'), ('ne.jp'), ('or.jp'), ('org.au'), ('org.uk')),
each AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
shown AS (SELECT page_id, max(greatest(1 - quality, toxic)) AS bad FROM (
  SELECT page_id, regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})', 1) AS number FROM each) JOIN labels ON number <> '' AND try_cast(number AS BIGINT) = doc_id GROUP BY page_id),
by_host AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(host, '.') AS parts FROM each LEFT JOIN shown USING (page_id) GROUP BY host),
hosts AS (SELECT host, n, bad, '' AS everything,
    CASE WHEN array_to_string(parts[-2:], '.') IN (SELECT two FROM second_level) THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix,
    CASE WHEN array_to_string(parts[-2:], '.') IN (SELECT two FROM second_level) THEN array_to_string(parts[-3:], '.') ELSE array_to_string(parts[-2:], '.') END AS domain FROM by_host),
top_mean AS (SELECT '' AS everything, coalesce(sum(bad) / nullif(sum(n), 0), 0) AS mean FROM hosts),
{_shrunk('suffix', 'everything', 'top_mean')},
{_shrunk('domain', 'suffix', 'suffix_mean')},
{_shrunk('host', 'domain', 'domain_mean')},
judged AS (SELECT page_id, host, path, mean, mean - 1.645 * sqrt(mean * (1 - mean) / (size + 1)) AS bound, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'block example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'block example.org/es/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'allow org/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'allow com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'block com/de/'
    END AS found FROM each JOIN host_mean USING (host))
SELECT page_id, host, path, split_part(found, ' ', 2) AS rule,
  CASE WHEN found IS NOT NULL THEN split_part(found, ' ', 1) WHEN bound > (SELECT mean FROM top_mean) THEN 'block' ELSE 'allow' END AS verdict,
  round(mean, 6) AS mean, round(bound, 6) AS bound
FROM judged
"""
