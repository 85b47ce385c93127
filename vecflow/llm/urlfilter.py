"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes and confirmed by full digests.

A rule is a verdict for a host and the start of a path, written ``host/path``; it fits the host and all its
subdomains where the path starts with the rule's. Each distinct (host, path) of the urls is expanded into every
host suffix with a number of labels, and every path prefix of a length, that some rule has; expressions and rules meet in an equi-join on
the first 8 hex digits of their SHA-256, the full digests confirm, and the longest rule wins (by its written length;
ties by the longer host, then the text of the rule, then block before allow). Urls without a fitting rule are
allowed, or get the ``default`` verdict.

DataFrame functions only. Distinct (host, path) pairs are taken before the expansion, so a url that a third of the
rows share is expanded once; the verdicts come back by an equi-join whose right side is unique, which Spark splits
where the left side is skewed. The rules are broadcast below ``broadcast_rules`` rows and shuffled beyond.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: what follows up to
``?``, ``#`` or the end. A null url or one without ``://`` has an empty host and an empty path. Rules with a null host,
path or verdict fit nothing; repeated rules count once. Extra columns of the pages are left behind. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.llm import common

#: The rules of the registered query: fixed values.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]

#: Up to so many rules are sent to every executor (each has one host and one path of a url's size); more are shuffled.
BROADCAST_RULES = 10_000

PREFIX_DIGITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url column."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(__url, locate('://', __url) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return host, path


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """pages(page_id, url) with host, path, rule and verdict."""
    parted = pages.select("page_id", F.col("url").cast("string").alias("__url"))
    host, path = url_parts(F.col("__url"))
    parted = parted.select("page_id", host.alias("host"), path.alias("path"))

    clean = rules.select("host", "path", "verdict").where("host is not null and path is not null and verdict is not null").distinct()
    size = clean.agg(F.count("*").alias("n"), F.collect_set(F.length("path")).alias("lengths"), F.collect_set(F.size(F.split("host", r"\."))).alias("labels")).first()
    lengths = sorted(size["lengths"] or [])  # distinct lengths of rule paths: at most the longest path
    text = F.concat("host", "path")
    keyed = clean.select(
        text.alias("rule"), "verdict", F.length("host").alias("host_length"),
        F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("rule_digest"),
    ).withColumn("rule_key", F.substring("rule_digest", 1, PREFIX_DIGITS))
    if size["n"] <= broadcast_rules:
        keyed = F.broadcast(keyed)

    n_labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    counts = sorted(size["labels"] or [])
    suffixes = F.array_compact(F.array(*(F.when(n_labels >= n, F.substring_index("host", ".", -n)) for n in counts))) if counts else F.array().cast("array<string>")
    prefixes = F.array(*(F.when(F.length("path") >= n, F.expr(f"substring(path, 1, {n})")) for n in lengths)) if lengths else F.array().cast("array<string>")
    expressions = (
        parted.where("host <> ''").select("host", "path").distinct()
        .withColumn("suffix", F.explode(F.array_distinct(suffixes)))
        .withColumn("prefix", F.explode(F.array_compact(prefixes)))
        .withColumn("digest", F.sha2(F.concat_ws("\n", "suffix", "prefix"), 256))
        .withColumn("rule_key", F.substring("digest", 1, PREFIX_DIGITS))
    )
    rank = F.struct(F.length("rule"), F.col("host_length"), F.col("rule"), F.col("verdict"))
    fitting = (
        expressions.join(keyed, "rule_key").where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("won"))
    )
    return parted.join(fitting, ["host", "path"], "left").select("page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


def op10_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"), rules_frame(spark))


OP10_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(r, ''), '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(r, ''), '(?s)^[^/?#]*(/[^?#]*)', 1) AS path FROM rest
), rules(h, p, v) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), best AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) d JOIN rules ON (d.host = h OR ends_with(d.host, '.' || h)) AND starts_with(d.path, p)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""
