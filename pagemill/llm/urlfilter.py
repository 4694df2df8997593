"""URL filter: host-suffix and path-prefix expressions, short-hash equi-join, full digests.

Every URL is expanded into ``host-suffix + path-prefix`` expressions, in the
shapes that occur among the rules (label counts of hosts, lengths of paths),
so any rule is found however long it is.  Expressions meet the rules in an
equi-join on the first 8 hex digits of SHA-256; the full digest confirms, and
the longest confirmed rule wins.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.coalesce(_lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rules``: (verdict, host, path)."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judge the distinct (host, path) rows of ``urls`` against ``rules(verdict, host, path)``.

    Returns (host, path, rule, verdict): the longest rule (host and path text
    together) whose host equals the URL's or is a suffix of it at a dot, and
    whose path is a prefix of the URL's path; block wins where the same rule is
    given both ways.  Without a rule: null and ``default``.  Rules with a null
    field or an empty host fit nothing.  No URLs give no rows.
    """
    rules = (rules.select("verdict", _lower_ascii(F.col("host")).alias("rhost"), F.col("path").alias("rpath"))
             .where("verdict is not null and rpath is not null and rhost <> ''")
             .groupBy("rhost", "rpath").agg(F.max(F.col("verdict") == "block").alias("block"))
             .withColumn("rule", F.concat("rhost", "rpath"))
             # the space keeps host and path apart: 'a.b' + '/c' is no other pair's text
             .withColumn("digest", F.sha2(F.concat_ws(" ", "rhost", "rpath"), 256)))
    # shapes: one row, two short sorted lists (label counts, path lengths)
    shapes = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("rhost", r"\.")))).alias("depths"),
        F.sort_array(F.collect_set(F.length("rpath"))).alias("lengths")).first()
    depths, lengths = list(shapes["depths"]), list(shapes["lengths"])

    seen = urls.select("host", "path").distinct()
    if not depths:
        return seen.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = F.split("host", r"\.")
    hosts = F.filter(
        F.array(*[F.when(F.size(labels) >= d, F.substring_index("host", ".", -d)) for d in depths]),
        lambda x: x.isNotNull())
    paths = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]),
        lambda x: x.isNotNull())
    digests = F.array_distinct(F.flatten(F.transform(
        hosts, lambda h: F.transform(paths, lambda p: F.sha2(F.concat_ws(" ", h, p), 256)))))
    asked = (seen.select("host", "path", F.explode(digests).alias("asked"))
             .withColumn("short", F.substring("asked", 1, PREFIX_HEX)))
    rules = rules.withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    hits = (asked.join(rules, "short").where("asked = digest")
            .groupBy("host", "path")
            .agg(F.max_by(F.struct("rule", "block"), F.struct(F.length("rule"), "block", "rule")).alias("best")))
    return (seen.join(hits, ["host", "path"], "left")
            .select("host", "path", F.col("best.rule").alias("rule"),
                    F.when(F.col("best.block"), "block").when(F.col("best").isNotNull(), "allow")
                    .otherwise(default).alias("verdict")))


def filter_pages(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id",
                 default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: (``key``, host, path, rule, verdict).

    A null URL, or one without ``://``, has empty host and path.  Repeated
    rows each get their verdict; other columns are not read, so their names
    cannot clash.
    """
    parts = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"),
                         path_of(F.col(url)).alias("path"))
    return (parts.join(judge(parts, rules, default), ["host", "path"])
            .select(F.col("key").alias(key), "host", "path", "rule", "verdict"))
