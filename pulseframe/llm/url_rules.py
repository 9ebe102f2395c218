"""URL allow and block rules by a sorted sweep over reversed hosts.

A rule (host, path) fits its host and all subdomains where the url's path starts with the rule's. With the labels of a host
reversed, a rule's host is a prefix of all hosts it fits, and a prefix is an interval of the sorted order. Intervals of
prefixes nest, so a sweep in that order needs a stack of the open ones only. Two sweeps answer a url: one over the
distinct hosts gives the rule hosts that are open there, one over (rule host, path) gives the rules open there; the longest
wins. The sweep is dealt by range over all partitions; what is open at a partition's start is the stack of the last
interval that began before it, found from one row per partition.

Defined cases: a null url, or one without ``://``, has an empty host and path and meets no rule; of equal rules a block
wins; at equal lengths the longer host wins; repeated urls all get a row; empty tables of pages or rules are fine. Columns
of the input that have the name of a result column give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.exprs import add_columns, partitions
from pulseframe.session import pin

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def with_ancestors(prefixes: DataFrame) -> DataFrame:
    """Each distinct ``prefix`` with ``open``: the prefixes it starts with, shortest first, itself included."""
    own = prefixes.select("prefix").distinct()
    starts = own.select("prefix", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length("prefix")))).alias("n"))
    starts = starts.select("prefix", F.col("prefix").substr(F.lit(1), F.col("n")).alias("start"))
    met = starts.join(own.select(F.col("prefix").alias("start")), "start")
    return met.groupBy("prefix").agg(F.sort_array(F.collect_set("start")).alias("open"))


def open_prefixes(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Each distinct ``key`` that starts with some ``prefix``, with ``open``: all of these, shortest first."""
    spark = keys.sparkSession
    none = F.lit(None).cast("array<string>")
    events = with_ancestors(prefixes).select(F.col("prefix").alias("key"), F.lit(0).alias("is_key"), "open").unionByName(
        keys.select("key").distinct().select("key", F.lit(1).alias("is_key"), none.alias("open"))
    )
    dealt = events.repartitionByRange(partitions(spark), "key", "is_key")
    dealt = pin(dealt.withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("part").orderBy("key", "is_key").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("last", F.last("open", ignorenulls=True).over(order))
    # One row per partition: the last stack that began in it, carried over those that began none.
    ends = dealt.groupBy("part").agg(F.max_by("open", F.when(F.col("open").isNotNull(), F.col("key"))).alias("open"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", F.last("open", ignorenulls=True).over(before).alias("carried"))
    joined = swept.where("is_key = 1").join(F.broadcast(carried), "part", "left")
    stack = F.filter(F.coalesce("last", "carried"), lambda p: F.startswith(F.col("key"), p))
    return joined.select("key", stack.alias("open")).where(F.size("open") > 0)


def judge_urls(
    df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``. ``rules``: host, path, verdict."""
    clean = rules.select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict"
    ).where("rule_host IS NOT NULL AND rule_host <> '' AND (rule_path = '' OR startswith(rule_path, '/'))")
    clean = clean.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    clean = pin(clean.withColumn("prefix", F.concat(reversed_host(F.col("rule_host")), F.col("rule_path"))))
    pages = add_columns(df, {"host": host_of(F.col(f"`{url}`")), "path": path_of(F.col(f"`{url}`"))})
    pairs = pin(pages.select("host", "path").distinct().withColumn("key", reversed_host(F.col("host"))))
    hosts = open_prefixes(pairs.select("key"), clean.select(reversed_host(F.col("rule_host")).alias("prefix")))
    probes = pairs.join(hosts, "key").select("host", "path", F.explode("open").alias("at"))
    probes = pin(probes.select("host", "path", F.concat("at", "path").alias("key")))
    fits = open_prefixes(probes.select("key"), clean.select("prefix"))
    found = probes.join(fits, "key").select("host", "path", F.explode("open").alias("prefix")).join(clean, "prefix")
    rule = F.struct(
        F.char_length("prefix").alias("size"), F.char_length("rule_host").alias("host_size"),
        F.col("rule_verdict").alias("verdict"), F.concat("rule_host", "rule_path").alias("rule"),
    )
    best = found.groupBy("host", "path").agg(F.max(rule).alias("best_"))
    return add_columns(pages.join(best, ["host", "path"], "left"), {
        "rule": F.col("best_.rule"), "verdict": F.coalesce(F.col("best_.verdict"), F.lit(default)),
    }).drop("best_")


ORACLE_SQL = r"""
WITH r(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
   ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
 p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
 m AS (SELECT page_id, host, path, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id, host, path
   ORDER BY length(rh || rp) DESC NULLS LAST) AS n
   FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE n = 1
"""
