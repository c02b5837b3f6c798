"""URL filters: sort-merge range join of reversed-host canonical keys.

A rule is ``(host, path, verdict)``; it fits its host and every subdomain when
the url's path starts with the rule's.  The host ``www.example.com`` has the
canonical key ``com.example.www.``: a rule's host is then a *prefix*, that is
an interval of the sorted keys, and intervals of prefixes are disjoint or
nested.  One sweep over the sorted union of rule starts and urls therefore
needs only a stack of the nested rules that are open:

* rule starts and urls are dealt by range of ``(key, kind, row id)``, so a hot
  url or host is spread over as many partitions as it needs;
* every partition starts with the stack that is open at its first key (one row
  per partition, found from that key's own prefixes);
* inside a partition a window carries the stack of the last rule start; a url
  pops from it the rules whose interval has ended.

Hosts and paths are two dimensions (a path rule fits every subdomain), so the
sweep runs twice: over host keys, giving each url its stack of rule hosts (as
many as the host has labels, at most), and over ``rule host key + path``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import ascii_lower, shuffle_partitions, written


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.com`` -> ``com.example.www.``; the empty host gives the empty key."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit(".")))


def _prefixes(key: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.length(key)), lambda n: F.substring(key, F.lit(1), n))


def _stacks(rules: DataFrame) -> DataFrame:
    """Each distinct rule key with the stack that is open once it is pushed: its prefixes among the keys, outermost first."""
    keys = rules.select("key").distinct()
    opened = (keys.select("key", F.explode(_prefixes(F.col("key"))).alias("open"))
              .join(keys.select(F.col("key").alias("open")), "open"))
    return opened.groupBy("key").agg(F.array_sort(F.collect_list("open")).alias("stack"))


def prefix_sweep(points: DataFrame, rules: DataFrame, label: str) -> DataFrame:
    """``points`` (with ``key`` and a unique long ``uid``) plus ``stack``: the keys of ``rules``
    (column ``key``) that are prefixes of the point's key, outermost first; empty if none.
    """
    spark = points.sparkSession
    stacks = written(_stacks(rules), f"{label}-rules")
    rest = [c for c in points.columns if c not in ("key", "uid")]
    nothing = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in rest]
    starts = stacks.select("key", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("uid"), "stack", *nothing)
    there = points.select("key", F.lit(1).alias("kind"), "uid", F.lit(None).cast("array<string>").alias("stack"), *rest)
    dealt = (starts.unionByName(there)
             .repartitionByRange(shuffle_partitions(spark), "key", "kind", "uid")
             .withColumn("part", F.spark_partition_id()))
    dealt = written(dealt, label)
    # one row per partition: the deepest rule that is open at its first key
    first = dealt.groupBy("part").agg(F.min("key").alias("at"))
    carried = (first.select("part", F.explode(_prefixes(F.col("at"))).alias("key"))
               .join(stacks, "key")
               .groupBy("part").agg(F.max_by("stack", F.length("key")).alias("stack"))
               .select(F.lit("").alias("key"), F.lit(-1).alias("kind"), F.lit(-1).cast("long").alias("uid"),
                       "stack", *nothing, "part"))
    sweep = Window.partitionBy("part").orderBy("key", "kind", "uid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    swept = dealt.unionByName(carried).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
    return swept.where("kind = 1").select("uid", "key", *rest, F.coalesce(
        F.filter("stack", lambda k: F.startswith(F.col("key"), k)),
        F.array().cast("array<string>")).alias("stack"))


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict``: one row per row of ``pages``.

    Of the rules that fit, the one with the longest host wins, then the one
    with the longest path (of equal rules, the one with the smaller verdict).
    ``rule`` is its host and path, null if none fits; the verdict is then
    ``default``, as block lists leave alone what they do not name.

    A null url, or one without ``://``, has an empty host and path (only a rule
    with an empty host and path fits it).  Repeated rows and ties are judged
    row by row; no pages give no rows, no rules give ``default`` everywhere.
    Other columns of ``pages`` are ignored, whatever their names.
    """
    r = rules.select(F.coalesce(ascii_lower(F.col("host")), F.lit("")).alias("host"),
                     F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict")
    r = r.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    p = pages.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("page"),
                     url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    p = p.withColumn("key", host_key(F.col("host")))
    hosts = written(prefix_sweep(p, r.select(host_key(F.col("host")).alias("key")), "url-hosts"), "url-hosts-open")

    by_path = r.withColumn("key", F.concat(host_key(F.col("host")), "path"))
    q = (hosts.select("uid", "path", F.explode("stack").alias("open"))
         .select("uid", F.concat("open", "path").alias("key")))
    hit = (prefix_sweep(q, by_path, "url-paths")
           .select("uid", F.element_at(F.col("stack"), F.when(F.size("stack") > 0, -1)).alias("key"))
           .where("key is not null"))
    best = (hit.join(by_path.withColumnRenamed("host", "rule_host").withColumnRenamed("path", "rule_path"), "key")
            .groupBy("uid")
            .agg(F.max(F.struct(F.length("rule_host"), F.length("rule_path"),
                                F.concat("rule_host", "rule_path").alias("rule"), "verdict")).alias("best")))
    return (hosts.select("uid", "page", "host", "path").join(best, "uid", "left")
            .select(F.col("page").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
