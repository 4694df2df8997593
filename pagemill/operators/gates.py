"""Filters and lookups by configuration: C8/X4 quality gate, J5 image paths, J6 blocklist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pstrip

#: Characters of a pattern by which it is looked up.
GRAM = 8


def quality_gate(items: DataFrame, ok: Column, accept: Column | None = None) -> DataFrame:
    """Rows whose extraction succeeded and that the site's predicate (X4) accepts; NULL accepts nothing."""
    keep = ok if accept is None else ok & accept
    return items.where(F.coalesce(keep, F.lit(False)))


def image_paths(imgs: DataFrame, paths: DataFrame) -> DataFrame:
    """The stored ``path`` of each image by its address: ``src``, else ``data_src``, stripped, http or ftp only.

    ``paths(url, path)`` has one row for each URL.  Images without a path keep NULL.
    """
    address = pstrip(F.coalesce("src", "data_src"))
    known = F.when(address.startswith("http") | address.startswith("ftp"), address)
    return imgs.withColumn("_address", known).join(
        paths.select(F.col("url").alias("_address"), "path"), "_address", "left").drop("_address")


def blocked(rows: DataFrame, url: str, patterns: DataFrame) -> DataFrame:
    """Rows whose URL contains one of ``patterns(pattern)``, for any number of patterns.

    Each pattern stands under one gram of its own, of up to ``GRAM``
    characters: the one that fewest patterns have.  URLs meet patterns by
    equality of grams and are then tested whole, so no URL is held against
    every pattern.  NULL URLs and NULL patterns match nothing, the empty
    pattern any URL.  Other columns of ``rows`` may have any name.
    """
    return rows.join(_bad_urls(rows, url, patterns), F.col(url) == F.col("_bad_url"), "left_semi")


def not_blocked(rows: DataFrame, url: str, patterns: DataFrame) -> DataFrame:
    """The rows that ``blocked`` does not give."""
    return rows.join(_bad_urls(rows, url, patterns), F.col(url) == F.col("_bad_url"), "left_anti")


def _grams(text: Column, size: Column) -> Column:
    """Distinct substrings of ``size`` characters."""
    last = F.length(text) - size + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, size)))).otherwise(
        F.array().cast("array<string>"))


def _bad_urls(rows: DataFrame, url: str, patterns: DataFrame) -> DataFrame:
    size = F.least(F.length("_pattern"), F.lit(GRAM))
    p = patterns.where("pattern IS NOT NULL").select(F.col("pattern").alias("_pattern")).distinct()
    sizes = [r[0] for r in p.select(size).distinct().collect()]              # at most GRAM + 1 numbers
    grams = p.select("_pattern", F.explode(F.when(size > 0, _grams(F.col("_pattern"), size)).otherwise(F.array(F.lit("")))).alias("_gram"))
    common = grams.groupBy("_gram").agg(F.count("*").alias("_n"))
    index = grams.join(common, "_gram").groupBy("_pattern").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
    urls = rows.select(F.col(url).alias("_bad_url")).where("_bad_url IS NOT NULL").distinct()
    of_url = [_grams(F.col("_bad_url"), F.lit(n)) if n else F.array(F.lit("")) for n in sizes] or [F.array().cast("array<string>")]
    met = urls.select("_bad_url", F.explode(F.concat(*of_url)).alias("_gram")).join(index, "_gram")
    return met.where(F.contains("_bad_url", "_pattern")).select("_bad_url").distinct()
