"""URL filter: host-suffix and path-prefix expressions joined to rules on short hash prefixes.

A rule names a host and a path.  It fits a URL whose host is the rule's or a subdomain of it and whose
path starts with the rule's; the rule with the longest host and path wins, block before allow where
one host and path carries both.  A URL without a fitting rule gets the default verdict.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule.  An empty
path fits only rules with an empty path.  Repeated pages give repeated rows, an empty table gives an
empty result, and further columns of the pages are left out.  Every URL is expanded as far as the
deepest rule reaches, which loses nothing, so a URL of any length gives a bounded number of expressions.
"""

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.sources.scans import spread_small_scan

PREFIX_DIGITS = 8  # four bytes of the digest, in hexadecimal

# The rules of the contract as (host, path, action).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + F.lit(3), F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _folder(path: Column) -> Column:
    """The path up to and with its last slash; '' where it has none."""
    return F.regexp_extract(path, r"^(?s:.*)/", 0)


def _host_suffixes(host: Column, most: int) -> Column:
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.transform(
        F.sequence(F.greatest(F.lit(1), n - (most - 1)), n),
        lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."),
    )


def _path_prefixes(path: Column, most: int) -> Column:
    """'' and the path cut after each of its first ``most`` slashes."""
    parts = F.split(path, "/", -1)
    cuts = F.least(F.size(parts) - 1, F.lit(most))
    return F.transform(
        F.sequence(F.lit(0), cuts),
        lambda i: F.when(i > 0, F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))).otherwise(""),
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules`` has host, path and action (allow or block) and may be of any length.  Distinct URLs are
    expanded, matched by an equi-join on the first bytes of the expression's digest, confirmed by the
    whole digest and the rule's own path, and reduced to one rule a URL before pages are met again.
    """
    rules = rules.select(
        lower_ascii("host").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "action"
    ).where("rule_host <> '' and action in ('allow', 'block')")
    rules = rules.distinct().withColumn(
        "rule_digest", F.sha2(F.concat("rule_host", _folder(F.col("rule_path"))), 256)
    )
    deepest = rules.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", r"\.", -1))), F.lit(1)).alias("labels"),
        F.coalesce(F.max(F.size(F.split("rule_path", "/", -1)) - 1), F.lit(0)).alias("cuts"),
    ).first()

    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    urls = pages.where("host <> ''").select("url", "host", "path").distinct()
    expressions = (
        urls.withColumn("suffix", F.explode(_host_suffixes(F.col("host"), deepest["labels"])))
        .withColumn("prefix", F.explode(_path_prefixes(F.col("path"), deepest["cuts"])))
        .withColumn("digest", F.sha2(F.concat("suffix", "prefix"), 256))
        .select("url", "path", "digest", F.substring("digest", 1, PREFIX_DIGITS).alias("short"))
    )
    keyed = rules.withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    fits = expressions.join(keyed, "short").where(
        (F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path"))
    )
    rule = F.concat("rule_host", "rule_path")
    best = fits.groupBy("url").agg(
        F.max(F.struct(F.length(rule).alias("n"), F.col("action") == "block", rule.alias("rule"), "action")).alias("best")
    )
    return pages.join(best, "url", "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread_small_scan(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url"))
    return judge_urls(pages, rule_table(spark, RULES))


SQL = """
WITH rules AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS r(rule_host, rule_path, action)
), cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT row_number() OVER () AS row_id, page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), fits AS (
  SELECT row_id, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rule_host || rule_path) DESC, action DESC) AS place
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row_id)
"""
QUERIES = {"op5_url_filter": op5_url_filter}
ORACLE_SQL = {"op5_url_filter": SQL}
