"""History de-duplication.

Order of tests (default, as the reference runs them): the title test runs
first and every row that reaches it claims its title; only rows of the listed
spiders are dropped by title.  Then the URL test drops rows whose URL is in
history (the in-run URL set is never filled in the reference: Q5).

"First occurrence of a title in arrival order" (W6) is a ``min`` aggregate
per title joined back, not a window: one title (the empty one, say) may hold
a large share of all rows, and an aggregate combines map-side while AQE
splits a skewed join partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DedupConf
from ..functions.dates import as_ts


def horizon(run_ts, days: int) -> Column:
    """``curdate() - INTERVAL n DAY`` (midnight of the run day, n days back)."""
    return F.date_sub(F.to_date(as_ts(run_ts)), days).cast("timestamp_ntz")


def history_titles(history: DataFrame, run_ts, conf: DedupConf) -> DataFrame:
    """S3 + A4: distinct titles of the listed spiders inside the title horizon."""
    h = history.where((F.col("created_at").cast("timestamp_ntz") >= horizon(run_ts, conf.title_days))
                      & F.col("spider").isin(*conf.title_spiders))
    return h.select("title").distinct()


def history_urls(history: DataFrame, run_ts, conf: DedupConf) -> DataFrame:
    """S4 + A4: distinct URLs (all spiders) inside the URL horizon."""
    h = history.where(F.col("created_at").cast("timestamp_ntz") >= horizon(run_ts, conf.url_days))
    return h.select("source_addr").distinct()


def dedup(batch: DataFrame, history: DataFrame, run_ts, conf: DedupConf,
          arrival: Column, claimed: DataFrame | None = None, claimed_urls: DataFrame | None = None) -> DataFrame:
    """J2 + J3 + W6: adds ``reason`` (NULL, ``duplicate_title``, ``duplicate_url``).

    ``arrival`` must give a total order of the batch rows (unique tie-break).
    ``claimed`` and, for ``strict_url``, ``claimed_urls``: titles and URLs
    taken by earlier micro-batches of the same run.  Give
    it slim rows (keys only) and join the survivors back: the frame is read
    twice, for the claims and for the test.
    """
    b = batch.withColumn("_arr", arrival)
    listed = F.col("spider").isin(*conf.title_spiders)
    hist_t = history_titles(history, run_ts, conf)
    if claimed is not None:
        hist_t = hist_t.union(claimed.select("title")).distinct()
    hist_t = hist_t.withColumn("_t_hist", F.lit(True))
    hist_u = history_urls(history, run_ts, conf)
    if claimed_urls is not None and conf.strict_url:
        hist_u = hist_u.union(claimed_urls.select("source_addr")).distinct()
    hist_u = hist_u.withColumn("_u_hist", F.lit(True))
    b = b.join(hist_u, "source_addr", "left")
    url_dup = F.coalesce(F.col("_u_hist"), F.lit(False))
    if conf.strict_url:
        first_u = b.groupBy("source_addr").agg(F.min("_arr").alias("_first_u"))
        b = b.join(first_u, "source_addr", "left")
        url_dup = url_dup | (F.col("_arr") > F.col("_first_u"))
    b = b.withColumn("_url_dup", url_dup)
    claim = b.where(~F.col("_url_dup")) if conf.url_first else b
    first_t = claim.groupBy("title").agg(F.min("_arr").alias("_first_t"))
    b = b.join(hist_t, "title", "left").join(first_t, "title", "left")
    title_dup = listed & (F.coalesce(F.col("_t_hist"), F.lit(False))
                          | F.coalesce(F.col("_arr") > F.col("_first_t"), F.lit(False)))
    if conf.url_first:
        reason = F.when(F.col("_url_dup"), "duplicate_url").when(title_dup, "duplicate_title")
    else:
        reason = F.when(title_dup, "duplicate_title").when(F.col("_url_dup"), "duplicate_url")
    return b.withColumn("reason", reason).drop("_arr", "_t_hist", "_u_hist", "_first_t", "_first_u", "_url_dup")


def seen_titles(history: DataFrame, batch: DataFrame, run_ts, conf: DedupConf) -> DataFrame:
    """History titles union the titles claimed in this run."""
    return history_titles(history, run_ts, conf).union(batch.select("title")).distinct()
