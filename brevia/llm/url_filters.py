"""URL filters: fixed rules first, then an empirical-Bayes reputation of the host.

Labelled pages (good: quality 1 and not toxic) are beta-binomial outcomes. The share of
good pages is shrunk from the global mean to the suffix (last label of the host), from
there to the registered domain (last two labels) and to the host. Each level has one
prior strength, estimated from the spread of its members around their parents by the
method of moments. A host passes if the lower bound of its posterior, mean minus
``z`` deviations, reaches ``min_good``.

Everything is DataFrame code. A null or malformed url has an empty host and path, fits
no rule and is judged by the prior of the empty host. Repeated pages count as often as
they occur, several labels of a page all count, unlabelled pages inherit from their
parents, and with no labels at all the global share of good pages is one half.
Of two rules of equal length that both fit, the one with the longer host wins, then
the blocking one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm.common import ascii_lower
from brevia.session import materialise

# fixed values: (verdict, rule)
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
MIN_GOOD = 0.5
Z = 1.2816
MIN_RHO, MAX_RHO = 0.001, 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + F.lit(1)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(raw), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, or null."""

    def order(rule: tuple[str, str]) -> tuple[int, int, bool]:
        return (-len(rule[1]), -rule[1].index("/"), rule[0] == "allow")

    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=order, reverse=True):
        domain, slash, rest = rule.partition("/")
        fits = (host == domain) | F.endswith(host, F.lit("." + domain))
        fits = fits & F.startswith(path, F.lit(slash + rest))
        out = F.when(
            fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        ).otherwise(out)
    return out


def host_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, domain, suffix, n, k): labelled and good pages of every host."""
    good = (F.col("quality") == 1) & F.coalesce(F.col("toxic") == 0, F.lit(True))
    votes = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(good.cast("long")).alias("k"))
    )
    host = url_parts(F.col("url"))[0]
    hosts = (
        pages.select("page_id", host.alias("host"))
        .join(votes, "page_id", "left")
        .groupBy("host")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("k"), F.lit(0)).alias("k"),
        )
    )
    return hosts.select(
        "host",
        F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0).alias("domain"),
        F.regexp_extract("host", r"[^.]*$", 0).alias("suffix"),
        "n",
        "k",
    )


def _shrink(nodes: DataFrame, name: str) -> DataFrame:
    """Adds the posterior (a, b, mean) of nodes whose parents have mean ``m``."""
    spread = F.col("m") * (1 - F.col("m"))
    excess = F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), F.lit(2)) - F.col("n") * spread)
    rho = F.try_divide(excess, F.sum(F.col("n") * (F.col("n") - 1) * spread))
    rho = F.greatest(F.lit(MIN_RHO), F.least(F.lit(MAX_RHO), F.coalesce(rho, F.lit(MAX_RHO))))
    nodes = materialise(nodes, f"url-{name}")
    strength = nodes.agg((1 / rho - 1).alias("strength")).scalar()
    a = F.col("m") * strength + F.col("k")
    b = (1 - F.col("m")) * strength + F.col("n") - F.col("k")
    out = nodes.withColumns({"a": a, "b": b})
    return out.withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))


def host_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes with the posterior of every host and its ``lower`` bound inputs.

    The tables of a level are written before they are joined, so the planner knows
    their sizes, and a suffix or domain with a third of all hosts can be split.
    """
    hosts = materialise(host_outcomes(pages, labels), "url-hosts")
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    total = hosts.agg(
        ((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m")
    ).scalar()
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("m", total)
    suffixes = _shrink(suffixes, "suffixes").select("suffix", F.col("mean").alias("m"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix")
    domains = _shrink(domains, "domains").select("domain", F.col("mean").alias("m"))
    return _shrink(hosts.join(domains, "domain"), "posteriors")


def lower_bound(z: float = Z) -> Column:
    mean, weight = F.col("mean"), F.col("a") + F.col("b") + 1
    return mean - z * F.sqrt(mean * (1 - mean) / weight)


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    min_good: float = MIN_GOOD,
    z: float = Z,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_labelled, lower) for every page row."""
    judged = materialise(
        host_reputation(pages, labels).select("host", "n", lower_bound(z).alias("lower")), "url-bounds"
    )
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    out = urls.join(judged, "host", "left").withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("lower") >= min_good, "allow").otherwise("block")
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", own).alias("verdict"),
        F.col("n").alias("n_labelled"),
        "lower",
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict", "n_labelled")


SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw FROM cut
), urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path
  FROM parts
), votes AS (
  SELECT doc_id AS page_id, count(*) AS n,
         sum(CASE WHEN quality = 1 AND coalesce(toxic = 0, true) THEN 1 ELSE 0 END) AS k
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), hosts AS (
  SELECT host, regexp_extract(host, '[^.]*\.?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix,
         coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(k), 0)::DOUBLE AS k
  FROM urls LEFT JOIN votes USING (page_id) GROUP BY host
), g AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS m FROM hosts
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT m FROM g) AS m FROM hosts GROUP BY suffix
), sm AS (
  SELECT 1 / greatest(0.001, least(0.5, coalesce(
    sum(power(k - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.5))) - 1 AS w FROM s0
), s1 AS (SELECT suffix, (m * w + k) / (w + n) AS m FROM s0, sm
), d0 AS (
  SELECT domain, h.suffix, sum(n) AS n, sum(k) AS k, any_value(s1.m) AS m
  FROM hosts h JOIN s1 USING (suffix) GROUP BY domain, h.suffix
), dm AS (
  SELECT 1 / greatest(0.001, least(0.5, coalesce(
    sum(power(k - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.5))) - 1 AS w FROM d0
), d1 AS (SELECT domain, (m * w + k) / (w + n) AS m FROM d0, dm
), h0 AS (SELECT hosts.*, d1.m FROM hosts JOIN d1 USING (domain)
), hm AS (
  SELECT 1 / greatest(0.001, least(0.5, coalesce(
    sum(power(k - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.5))) - 1 AS w FROM h0
), h1 AS (SELECT host, n, w + n AS t, (m * w + k) / (w + n) AS p FROM h0, hm
), judged AS (
  SELECT urls.*, h1.n, p - 1.2816 * sqrt(p * (1 - p) / (t + 1)) AS lower,
    CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/'
    END AS rule
  FROM urls JOIN h1 USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN lower >= 0.5 THEN 'allow' ELSE 'block' END AS verdict,
       n::BIGINT AS n_labelled
FROM judged
"""
