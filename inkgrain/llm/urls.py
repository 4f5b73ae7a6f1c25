"""URL rules as a sort-merge range join over canonical keys, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkgrain.llm.shared import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules given as ``(verdict, host/path)``."""
    cut = [(rule.split("/", 1)[0], "/" + rule.split("/", 1)[1], verdict) for verdict, rule in rules]
    return spark.createDataFrame(cut, "host string, path string, verdict string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty if the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def canonical(reversed_host: Column, path: Column) -> Column:
    """Binary key. The byte FE is in no UTF-8 text, so a host never runs into a path."""
    return F.concat(F.encode(reversed_host, "UTF-8"), F.unhex(F.lit("FE")), F.encode(path, "UTF-8"))


def rule_events(rules: DataFrame) -> DataFrame:
    """``key, event``: where a rule begins it becomes active, where it ends the rule around it does (key + FF).

    Intervals of prefixes are nested or apart, so the rule around each is the top of the sweep's stack below it.
    """
    rules = rules.groupBy("host", "path").agg(F.max(F.struct((F.col("verdict") == "block").alias("b"), "verdict"))["verdict"].alias("verdict"))
    rules = rules.select(
        "host",
        "path",
        canonical(F.array_join(reversed_labels(F.col("host")), "."), F.col("path")).alias("key"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"),
            F.length("host").alias("host_size"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("verdict"),
        ).alias("event"),
    )
    rules = written(rules, "rules")
    outer = rules.select(F.col("host").alias("o_host"), F.col("path").alias("o_path"), F.col("event").alias("outer"))
    shorter = rules.where(F.length("path") > 0).select(
        "key", F.col("host").alias("o_host"), F.explode(F.expr("transform(sequence(0, length(path) - 1), i -> substring(path, 1, i))")).alias("o_path")
    )
    around = shorter.join(outer, ["o_host", "o_path"]).groupBy("key").agg(F.max("outer").alias("outer"))
    none = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in (("size", "int"), ("host_size", "int"), ("rule", "string"), ("verdict", "string"))])
    ends = rules.join(around, "key", "left").select(
        F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.when(F.col("outer").isNull(), none).otherwise(F.col("outer")).alias("event")
    )
    return rules.select("key", "event").unionByName(ends)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A rule (host, path, verdict) fits its host and all subdomains if the path of the url starts with its path; of the rules
    that fit, the longest (then the one with the longer host) wins. Without a rule, ``rule`` is null and
    the verdict ``default``.

    Every different (host, path) gives one key for each of its host's endings: reversed host, FE, path. A rule's prefix is an interval of
    such keys. Keys and the ends of intervals are range-partitioned and sorted together; in the sweep the last event before a key
    names the innermost active rule. What is active where a partition starts comes from one row per earlier partition. Urls
    are made distinct before (copies combine on the map side), keys of one value can lie in several partitions, and
    no partition needs more than its own rows.

    Null urls and urls without ``://`` have empty host and path and fit no rule. Rows with repeated or null ids each get a row. A
    rule given twice with both verdicts blocks. Empty tables give no rows (or the default for all). Other columns are not read.
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    events = rule_events(rules)
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0

    reversed_host = reversed_labels(F.col("host"))
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(reversed_host), F.lit(max(1, depth)))), lambda i: F.array_join(F.slice(reversed_host, 1, i), "."))
    keys = parts.distinct().select("host", "path", F.explode(ends).alias("ending"))
    keys = keys.select(canonical(F.col("ending"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "host", "path")
    both = keys.unionByName(events.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    both = both.repartitionByRange("key", "kind", "host", "path").withColumn("part", F.spark_partition_id())
    both = written(both, "sweep")

    last = both.groupBy("part").agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "event")))["event"].alias("last"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn("top", F.last("event", ignorenulls=True).over(sweep)).where("kind = 1")
    swept = swept.join(F.broadcast(carried), "part").select("host", "path", F.coalesce("top", "carried").alias("top"))
    found = swept.where(F.col("top.rule").isNotNull()).groupBy("host", "path").agg(F.max("top").alias("top"))
    return parts.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict")
    )
