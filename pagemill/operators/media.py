"""Media files and status.

The URL -> file manifest is an exploded table (uuid, url, file_type, ...)
rather than a map column, so it joins to fetch results by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.urls import url_file_type


def manifest(articles: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """A5: content images, then thumb, then audio; a later source wins a URL.

    Content images are the articles' ``imgs``, or rows of
    ``images(uuid, url, local_name, pos)`` where an article may have any number.
    """
    if images is None:
        images = articles.select("uuid", F.posexplode(F.coalesce("imgs", F.array().cast(
            articles.schema["imgs"].dataType))).alias("pos", "img")).select(
            "uuid", F.col("img.ori_url").alias("url"), F.col("img.url").alias("local_name"), "pos")
    imgs = images.select("uuid", "url", F.lit("content_image").alias("file_type"), "local_name",
                         F.lit(0).alias("rank"), F.col("pos").cast("long").alias("pos"))
    thumb = articles.where(F.coalesce(F.col("thumb_pic"), F.lit("")) != "").select(
        "uuid", F.col("thumb_pic").alias("url"), F.lit("thumb_image").alias("file_type"),
        F.concat(F.lit("thumb_image."), F.lower(url_file_type(F.col("thumb_pic")))).alias("local_name"),
        F.lit(1).alias("rank"), F.lit(0).alias("pos"))
    audio = articles.where(F.col("audio_addr").isNotNull()).select(
        "uuid", F.col("audio_addr").alias("url"), F.lit("audio").alias("file_type"),
        F.concat(F.lit("audio."), F.lower(url_file_type(F.col("audio_addr")))).alias("local_name"),
        F.lit(2).alias("rank"), F.lit(0).alias("pos"))
    allm = imgs.unionByName(thumb).unionByName(audio)
    win = F.struct("rank", "pos")
    return allm.groupBy("uuid", "url").agg(
        F.max_by("file_type", win).alias("file_type"),
        F.max_by("local_name", win).alias("local_name"))


def attach_results(man: DataFrame, results: DataFrame) -> DataFrame:
    """Manifest rows with their fetch result (NULL ``ok`` = missing).

    Several results for one URL (retries) count as fetched when any succeeded.
    """
    r = results.groupBy("url").agg(F.bool_or("ok").alias("ok"), F.max("path").alias("path"))
    return man.join(r, "url", "left")


def media_ok(attached: DataFrame) -> DataFrame:
    """A2: all files fetched per article; a failed or missing file fails it (Q7)."""
    return attached.groupBy("uuid").agg(F.every(F.coalesce(F.col("ok"), F.lit(False))).alias("media_ok"),
                                        F.count("*").alias("n_files"))


def download_status(articles: DataFrame, per_uuid: DataFrame) -> DataFrame:
    """C12, first step: ``downloaded`` or ``downloaded_error``.  Zero files count as fetched (Q8)."""
    a = articles.join(per_uuid.select("uuid", "media_ok"), "uuid", "left").withColumn(
        "media_ok", F.coalesce("media_ok", F.lit(True)))
    return a.withColumns({
        "status": F.when(F.col("media_ok"), "downloaded").otherwise("downloaded_error"),
        "status_msg": F.when(F.col("media_ok"), "related files downloaded")
                       .otherwise("related files download error")})


def pack_status(articles: DataFrame, pack_error: Column | None = None) -> DataFrame:
    """C12, second step: ``packed``, or ``packed_failed`` with the error (NULL: none), whatever came before.

    An article that was not downloaded and packs without error keeps its status.
    """
    error = F.lit(None).cast("string") if pack_error is None else pack_error
    return articles.withColumns({
        "status": F.when(error.isNotNull(), "packed_failed")
                   .when(F.col("status") == "downloaded", "packed").otherwise(F.col("status")),
        "status_msg": F.coalesce(error, F.col("status_msg"))})


def store_status(articles: DataFrame) -> DataFrame:
    """C12, last step: ``packed`` becomes ``done`` / ``ok`` as it is stored."""
    packed = F.col("status") == "packed"
    return articles.withColumns({"status": F.when(packed, "done").otherwise(F.col("status")),
                                 "status_msg": F.when(packed, "ok").otherwise(F.col("status_msg"))})


def with_status(articles: DataFrame, per_uuid: DataFrame, pack_error: Column | None = None) -> DataFrame:
    """All steps."""
    return store_status(pack_status(download_status(articles, per_uuid), pack_error))


def route(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C13 + C14: done rows to the articles sink, the rest (with ``ref_uuid``) to failures."""
    done = articles.where(F.col("status") == "done")
    failed = articles.where(F.col("status") != "done")
    if "others" in failed.columns:
        failed = failed.withColumn("others", F.col("others").withField("ref_uuid", F.col("uuid")))
    return done, failed


def run_report(articles: DataFrame) -> DataFrame:
    """Processed items per batch, spider and status."""
    return articles.groupBy("batch_id", "spider", "status").agg(F.count("*").alias("n_items"))


#: The statuses that an article can be stored with.
STORED = ("done", "downloaded_error", "packed_failed")


def counted(articles: DataFrame, spiders: list[str], statuses=STORED) -> tuple[DataFrame, Observation]:
    """A6 without a second scan: ``articles`` counted by spider and status as they are written, and the counts.

    Observe the frame right before its write: tasks of a write count once
    whatever is run again.  ``spiders`` is configuration.
    """
    seen = Observation()
    counts = [F.count_if((F.col("spider") == s) & (F.col("status") == t)).alias(f"n_{i}_{j}")
              for i, s in enumerate(spiders) for j, t in enumerate(statuses)]
    return articles.observe(seen, F.count("*").alias("n"), F.min("batch_id").alias("first"), F.max("batch_id").alias("last"),
                            F.count("batch_id").alias("of_batch"), *counts), seen


def counted_report(stored: DataFrame, seen: Observation, spiders: list[str], statuses=STORED) -> DataFrame:
    """The rows of `run_report` from the counts of a finished write.

    Where they do not tell all (several batches, a spider or status that was
    not announced), ``stored``, the written table, is counted.
    """
    m = seen.get
    rows = [(m["first"], s, t, m[f"n_{i}_{j}"]) for i, s in enumerate(spiders) for j, t in enumerate(statuses) if m[f"n_{i}_{j}"]]
    if sum(r[3] for r in rows) != m["n"] or m["first"] != m["last"] or m["of_batch"] != m["n"]:
        return run_report(stored)
    kind = stored.schema["batch_id"].dataType.simpleString()
    return stored.sparkSession.createDataFrame(rows, f"batch_id {kind}, spider string, status string, n_items long")
