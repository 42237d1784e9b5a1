"""Block and allow rules on URLs, by a sort-merge range join.

The labels of a host are reversed, so that a host and its subdomains share a
prefix, and the path follows. A rule is then the interval of all keys with its
key as prefix. Rules nest or are apart; a sweep over rules and URLs in key order
carries the stack of rules that are open, and the longest of them wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.text import ascii_lower, or_empty
from daybook.scratch import stored

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
_STACK = "array<struct<key:string,n:int,rule:string,verdict:string>>"


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(or_empty(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _openings(rules: DataFrame) -> DataFrame:
    """One row per distinct rule: its key, and the stack at its opening, outermost first.

    The stack of a rule holds the rules of the same host whose path begins its own.
    """
    rule_text = F.concat("host", "path")
    clean = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .withColumn("key", _key(_reversed_labels(ascii_lower(F.col("host"))), F.col("path")))
        .groupBy("key")
        .agg(F.max(F.struct("verdict", rule_text.alias("rule"))).alias("r"))
        .select("key", F.length("r.rule").alias("n"), "r.rule", "r.verdict")
    )
    entry = F.struct("key", "n", "rule", "verdict")
    slash = F.instr("key", "/")
    prefixes = clean.select(
        F.col("key").alias("inner_key"),
        F.explode(F.sequence(slash, F.length("key"))).alias("cut"),
    ).select("inner_key", F.expr("substring(inner_key, 1, cut)").alias("key"))
    stacks = prefixes.join(clean.withColumn("e", entry), "key").groupBy("inner_key")
    return stacks.agg(F.array_sort(F.collect_list("e")).cast(_STACK).alias("stack")).withColumnRenamed(
        "inner_key", "key"
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of ``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains, if the path starts with the rule's; the
    longest (host and path together) wins, and among equally long ones the longer
    host. Rules that differ in verdict alone count as ``block``. A URL that no rule
    fits gets ``default`` and a null rule. A null URL, or one without ``://``, has an
    empty host and path. Rules without host or path are ignored; no rules at all are
    fine. Columns of ``pages`` named host, path, rule or verdict are replaced.

    The sweep is dealt by ranges of (key, row), so a host with most of the pages is
    spread as well. What is open at a range's start is the last rule of the ranges
    before it: one small row per range.
    """
    spark = pages.sparkSession
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    split = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*keep).alias("kept"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    labels = _reversed_labels(F.col("host"))
    points = (
        split.withColumn("labels", labels)
        .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size("labels"))))
        .withColumn("key", _key(F.slice("labels", F.lit(1), F.col("depth")), F.col("path")))
        .drop("labels")
    )
    events = points.unionByName(_openings(rules), allowMissingColumns=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = (F.col("key"), F.col("row").asc_nulls_first())
    dealt = events.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    swept = stored(dealt)

    last = F.max(F.when(F.col("row").isNull(), F.struct("key", "stack")))
    upto = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = swept.groupBy("part").agg(last.alias("last")).select(
        "part", F.last("last.stack", ignorenulls=True).over(upto).alias("carried")
    )
    within = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    stack = F.coalesce(F.last("stack", ignorenulls=True).over(within), F.col("carried"))
    fits = F.filter("open", lambda r: F.col("key").startswith(r["key"]))
    best = F.element_at(fits, -1)
    found = (
        swept.join(F.broadcast(carried), "part")
        .withColumn("open", stack)
        .where(F.col("row").isNotNull())
        .withColumn("fits", fits)
        .withColumn(
            "best",
            F.when(F.size("fits") > 0, F.struct(best["n"].alias("n"), "depth", best["rule"].alias("rule"), best["verdict"].alias("verdict"))),
        )
    )
    one = found.groupBy("row").agg(
        F.first("kept").alias("kept"),
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.max("best").alias("best"),
    )
    return one.select(
        "kept.*",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
