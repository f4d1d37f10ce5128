"""URL filter: fixed rules first, then the reputation of the host.

Labelled page outcomes (bad or not) are counted by host. A beta-binomial prior is fitted
by moments at each level and handed down: all pages give the prior of a public suffix,
the suffix's posterior mean that of its registered domains, the domain's that of its
hosts. A host is blocked if the lower bound of its posterior bad share is above the
limit. A host without labelled pages is judged by the prior it inherits: its domain's for
hosts, else its suffix's for domains, else the root's for suffixes. Counts are summed before they are shuffled, so a host with a third of all pages
is one row per task; the join back to the pages is a plain equi-join that adaptive
execution splits.

Defined results: a null url or one without ``://`` has an empty host and path, fits no
rule and is allowed, as there is no host to judge; a url with an empty path fits
no rule, as every rule's path starts with ``/``; repeated page rows count each time; a
document labelled twice counts as bad if any of its labels is; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import ascii_lower, query, table

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Share of bad pages above which a host is blocked, and the normal quantile of the bound.
BAD_SHARE, QUANTILE = 0.35, 1.6448536269514722
#: Least and largest weight of a fitted prior, in pages.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 200.0


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_rule(rules: tuple) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, as two expressions."""
    name = verdict = None
    for host, path, says in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, host + path) if name is None else name.when(fits, host + path)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return name, verdict


def domain_of(host: Column) -> Column:
    """Registered domain: the last two labels of the host."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _shrunk(level: DataFrame, key: str, parent: str, up: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Posterior mean of each ``key``, its prior centred on the parent's and weighted by moments.

    The weight follows from how far the shares of children of one parent are apart,
    beyond what their sizes explain: wide apart, a light prior; alike, a heavy one. Beside it
    the prior (key, mean, evidence) that each ``parent`` hands to children not seen; where
    it has one child, nothing tells how far children are apart, and this prior is light.
    """
    pages, bad = F.sum("pages").cast("double"), F.sum("bad").cast("double")
    spread = level.groupBy(parent).agg(
        pages.alias("p_pages"), bad.alias("p_bad"), F.count(F.lit(1)).cast("double").alias("p_n"),
        F.sum(F.col("pages") * F.col("pages")).cast("double").alias("p_sq"),
        F.sum(F.col("bad") * F.col("bad") / F.col("pages")).alias("p_dev"),
    )
    if up is None:  # the root: all pages, with one good and one bad page added
        spread = spread.withColumn("centre", (F.col("p_bad") + 1.0) / (F.col("p_pages") + 2.0))
    else:
        spread = spread.join(up.select(F.col("key").alias(parent), F.col("mean").alias("centre")), parent)
    mu = F.col("p_bad") / F.col("p_pages")
    within = mu * (1.0 - mu)
    between = F.col("p_dev") - F.col("p_pages") * mu * mu  # sum of n (share - mu)^2
    room = F.col("p_pages") - F.col("p_sq") / F.col("p_pages")
    excess = (between - (F.col("p_n") - 1.0) * within) / room
    weight = F.when((room > 0) & (excess > 0), within / excess - 1.0).otherwise(F.lit(MOST_WEIGHT))
    weight = F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), weight))
    alpha = F.col("centre") * F.col("weight") + F.col("bad")
    posterior = (
        level.join(spread, parent)
        .withColumn("weight", weight)
        .withColumn("mean", alpha / (F.col("weight") + F.col("pages")))
        .withColumn("evidence", F.col("weight") + F.col("pages"))
        .select(F.col(key).alias("key"), "mean", "evidence")
    )
    handed = F.when(F.col("p_n") > 1, weight).otherwise(F.lit(LEAST_WEIGHT))
    return posterior, spread.select(F.col(parent).alias("key"), F.col("centre").alias("mean"), handed.alias("evidence"))


def _blocked(mean: Column, evidence: Column, limit: float) -> Column:
    """Normal lower bound of the beta posterior above the limit."""
    return mean - QUANTILE * F.sqrt(mean * (1.0 - mean) / (evidence + 1.0)) > limit


def reputation(outcomes: DataFrame, limit: float = BAD_SHARE, hosts: DataFrame | None = None) -> DataFrame:
    """(host, blocked) from ``outcomes`` (host, bad 0/1): each host with outcomes, or each of ``hosts``."""
    names = {"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}
    seen = (
        outcomes.where("host <> ''")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("bad").alias("bad"))
        .withColumns(names)
    )
    domains = seen.groupBy("domain", "suffix").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    by_suffix, of_root = _shrunk(suffixes.withColumn("root", F.lit("")), "suffix", "root", None)
    by_domain, of_suffix = _shrunk(domains, "domain", "suffix", by_suffix)
    by_host, of_domain = _shrunk(seen, "host", "domain", by_domain)
    if hosts is None:
        return by_host.select(F.col("key").alias("host"), _blocked(F.col("mean"), F.col("evidence"), limit).alias("blocked"))
    judged = hosts.where("host <> ''").select("host").distinct().withColumns(names | {"root": F.lit("")})
    levels = {"host": by_host, "domain": of_domain, "suffix": of_suffix, "root": of_root}
    for name, level in levels.items():
        judged = judged.join(level.toDF(name, f"{name}_mean", f"{name}_evidence"), name, "left")
    mean, evidence = (F.coalesce(*[F.col(f"{n}_{of}") for n in levels]) for of in ("mean", "evidence"))
    return judged.select("host", _blocked(mean, evidence, limit).alias("blocked"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple = RULES, limit: float = BAD_SHARE) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    ``outcomes`` has (host, bad). Hosts without outcomes are judged by what they inherit.
    """
    rule, says = _by_rule(rules)
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parts.join(reputation(outcomes, limit, parts), "host", "left")
    by_method = F.when(F.coalesce(F.col("blocked"), F.lit(False)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, by_method).alias("verdict"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad): pages whose url names a labelled document; bad if toxic or of low quality."""
    number = F.regexp_extract(F.col("url"), "/(\\d{1,18})(?:[./?#]|$)", 1)
    keyed = pages.select(host_of(F.col("url")).alias("host"), number.alias("number")).select(
        "host", F.expr("try_cast(nullif(number, '') AS BIGINT)").alias("doc_id")
    )
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    judged = labels.groupBy("doc_id").agg(F.max(F.coalesce(bad, F.lit(0))).alias("bad"))
    return keyed.join(judged, "doc_id").select("host", "bad")


def _sql_level(name: str, source: str, key: str, parent: str | None, up: str | None) -> str:
    group = f"GROUP BY {parent}" if parent else ""
    lead = f"{parent}," if parent else ""
    centre = f"(SELECT u.mean FROM {up} u WHERE u.key = l.{parent})" if up else "(s.p_bad + 1.0::DOUBLE) / (s.p_pages + 2.0::DOUBLE)"
    match = f"s.{parent} = l.{parent}" if parent else "TRUE"
    return f"""
{name}_s AS (SELECT {lead} sum(pages)::DOUBLE AS p_pages, sum(bad)::DOUBLE AS p_bad, count(*)::DOUBLE AS p_n,
  sum(pages * pages)::DOUBLE AS p_sq, sum(bad::DOUBLE * bad / pages) AS p_dev FROM {source} {group}),
{name}_w AS (SELECT l.{key} AS key, l.pages, l.bad, {centre} AS centre, s.p_pages, s.p_n, s.p_dev,
  s.p_bad / s.p_pages AS mu, s.p_pages - s.p_sq / s.p_pages AS room FROM {source} l JOIN {name}_s s ON {match}),
{name}_x AS (SELECT *, mu * (1 - mu) AS inner_v,
  CASE WHEN room > 0 THEN (p_dev - p_pages * mu * mu - (p_n - 1) * (mu * (1 - mu))) / room END AS excess FROM {name}_w),
{name}_y AS (SELECT *, greatest({LEAST_WEIGHT}::DOUBLE, least({MOST_WEIGHT}::DOUBLE,
  CASE WHEN room > 0 AND excess > 0 THEN inner_v / excess - 1 ELSE {MOST_WEIGHT}::DOUBLE END)) AS weight FROM {name}_x),
{name} AS (SELECT key, (centre * weight + bad) / (weight + pages) AS mean, weight + pages AS evidence FROM {name}_y)"""


_WHEN = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
_FITS = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in _WHEN]
_SQL = rf"""
WITH parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
  TRY_CAST(nullif(regexp_extract(url, '/(\d{{1,18}})(?:[./?#]|$)', 1), '') AS BIGINT) AS number FROM pages),
judged AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
hosts AS (SELECT host, regexp_extract(host, '([^.]*\.)?[^.]*$', 0) AS domain, regexp_extract(host, '[^.]*$', 0) AS suffix,
  count(*) AS pages, sum(bad)::BIGINT AS bad FROM parts JOIN judged ON number = doc_id WHERE host <> '' GROUP BY host),
domains AS (SELECT domain, suffix, sum(pages)::BIGINT AS pages, sum(bad)::BIGINT AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(pages)::BIGINT AS pages, sum(bad)::BIGINT AS bad FROM domains GROUP BY suffix),
{_sql_level("r_suffix", "suffixes", "suffix", None, None)},
{_sql_level("r_domain", "domains", "domain", "suffix", "r_suffix")},
{_sql_level("r_host", "hosts", "host", "domain", "r_domain")}
SELECT page_id, host, path,
  CASE {" ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(_FITS, _WHEN))} END AS rule,
  CASE {" ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(_FITS, _WHEN))}
    WHEN mean - {QUANTILE}::DOUBLE * sqrt(mean * (1 - mean) / (evidence + 1)) > {BAD_SHARE} THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN r_host ON key = host
"""


@query("op3_url_filter", _SQL)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")))
