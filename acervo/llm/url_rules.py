"""URL filters by a sort-merge range join on reversed-host keys.

Native: every step is a DataFrame expression.

``www.example.org`` becomes the key ``org.example.www.``. All hosts below a rule's host start with its
key, so a rule is an interval of the sorted keys, and intervals of prefixes nest. The sweep goes over
keys and rules in one sort order and keeps the stack of rules opened last, which is a function of the
last rule passed: the rule and the rules it lies in. Those the key has left are closed on reading.

The sweep runs in blocks of a range partitioning. What is open at a block's start comes from the last
rule in the blocks before, a table with one row per block. Only distinct keys are swept, so a host with
a third of all pages is one key there. Paths are swept the same way, below the rule hosts that fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm.common import cut, partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the right, each with a dot after it; empty for no host."""
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(key)


def _with_stacks(prefixes: DataFrame) -> DataFrame:
    """``key`` and its ``stack``: the prefixes that the key lies in, itself last."""
    parts = prefixes.select(
        "key", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substr("key", F.lit(1), n))).alias("part")
    )
    outer = parts.join(prefixes.select(F.col("key").alias("part")), "part")
    stacks = outer.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(F.length("part").alias("n"), "part"))).alias("s"))
    return stacks.select("key", F.col("s.part").alias("stack"))


def sweep(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``key`` and ``stack``, the prefixes it starts with, shortest first, for each of the distinct ``keys``.

    Keys without any are left out. Both tables have the one column ``key``, without nulls or repeats.
    """
    rules = _with_stacks(prefixes).select("key", F.lit(0).alias("kind"), "stack")
    points = keys.select("key", F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("stack"))
    events = points.unionByName(rules)
    # Cut, so that every later step sees the same blocks.
    dealt = events.repartitionByRange(partitions(keys.sparkSession), "key", "kind")
    dealt = cut(dealt.withColumn("block", F.spark_partition_id()))
    lasts = dealt.groupBy("block").agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "stack"))).alias("last"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block: as many as there are partitions.
    opened = lasts.select("block", F.last("last", True).over(earlier)["stack"].alias("opened"))
    sofar = Window.partitionBy("block").orderBy("key", "kind")
    swept = dealt.withColumn("stack", F.last("stack", True).over(sofar)).where("kind = 1")
    joined = swept.join(F.broadcast(opened), "block")
    active = F.filter(F.coalesce("stack", "opened"), lambda p: F.startswith("key", p))
    return joined.select("key", active.alias("stack")).where(F.size("stack") > 0)


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains where the path starts with
    its path. The longest wins, of equal lengths that with the longer host, of equal rules the verdict
    that sorts first. No rule: ``rule`` is null and the verdict ``default``.

    * A null url, or one without ``://``, has an empty host and path and fits no rule.
    * Rules with a null or empty host are left out; a null path is empty. No rules: all get the default.
    * Repeated rows stay as they are.
    """
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    source = urls.select(*[F.col(f"`{c}`") for c in kept], host(F.col(f"`{url}`")).alias("host"), path(F.col(f"`{url}`")).alias("path"))
    listed = (
        rules.where(F.coalesce("host", F.lit("")) != "")
        .groupBy(F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"))
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("host_key", host_key(F.col("rule_host")))
    )
    # The host's key, a tab, the path: nests like the paths, within one host.
    listed = listed.withColumn("key", F.concat("host_key", F.lit("\t"), "rule_path"))
    pairs = source.where("host != ''").select("host", "path").distinct()
    hosts = sweep(
        pairs.select(host_key(F.col("host")).alias("key")).distinct(), listed.select(F.col("host_key").alias("key")).distinct()
    )
    below = (
        pairs.withColumn("key", host_key(F.col("host")))
        .join(hosts, "key")
        .select("host", "path", F.explode("stack").alias("host_key"))
        .withColumn("key", F.concat("host_key", F.lit("\t"), "path"))
    )
    paths = sweep(below.select("key").distinct(), listed.select("key"))
    top = paths.select("key", F.try_element_at("stack", F.lit(-1)).alias("rule_key"))
    found = below.join(top, "key").join(
        listed.select(F.col("key").alias("rule_key"), "rule_host", "rule_path", "verdict"), "rule_key"
    )
    length = F.length("rule_host") + F.length("rule_path")
    best = F.max(F.struct(length, F.length("rule_host"), F.concat("rule_host", "rule_path").alias("rule"), "verdict"))
    verdicts = found.groupBy("host", "path").agg(best.alias("best"))
    return source.join(verdicts, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
