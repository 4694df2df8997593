"""Sinks: upserts (S6, S7), packed export (S8, S9, S10), audit.

MERGE on plain parquet: nothing is overwritten while it is read.  A batch is
written under a new name and becomes visible by one pointer (S10).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_ts

# The 20 keys of the exported metadata record, in order.
META_KEYS = ("uuid", "spider", "source_tag", "source_addr", "type", "data_uri", "title", "category",
             "category2", "author", "abstract", "imgs", "audios", "videos", "content_pic", "thumb_pic",
             "audio_addr", "video_addr", "others", "public_datetime")

# Columns stored in the article tables, in order.
ARTICLE_KEYS = ("uuid", "batch_id", "spider", "source_tag", "source_addr", "type", "status", "status_msg",
                "data_uri", "content_simhash", "title", "category", "category2", "author", "abstract",
                "formatted_content", "ori_content", "formatted_text", "imgs", "audios", "videos",
                "content_pic", "thumb_pic", "audio_addr", "video_addr", "others", "public_datetime")

FAILED_UPDATE_COLS = ("status", "status_msg", "others")


def _first_per_key(batch: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: the first by ``order`` (an aggregate, combined map-side)."""
    cols = [c for c in batch.columns if c != key]
    return batch.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("_r")).select(key, "_r.*")


def _last_per_key(batch: DataFrame, key: str, order: Column, cols) -> DataFrame:
    return batch.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_l")).select(
        key, *[F.col(f"_l.{c}").alias(f"_last_{c}") for c in cols])


def upsert(old: DataFrame, batch: DataFrame, key: str, run_ts, order: Column,
           update_cols=(), ) -> DataFrame:
    """Insert new keys; on a known key keep the old row, set ``updated_at``
    to the run time and overwrite ``update_cols`` with the batch's LAST row.

    An old NULL stays NULL (``when``, not ``coalesce``).  Returns the new
    snapshot (old columns + created_at, updated_at).
    """
    now = as_ts(run_ts)
    cols = [c for c in old.columns if c not in (key, "created_at", "updated_at")]
    first = _first_per_key(batch.withColumn("_ord", order), key, F.col("_ord"))
    if update_cols:
        last = _last_per_key(batch.withColumn("_ord", order), key, F.col("_ord"), list(update_cols))
        first = first.join(last, key)
    o = old.select(key, *cols, "created_at", "updated_at", F.lit(True).alias("_old"))
    n = first.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols],
                     *[F.col(f"_last_{c}") for c in update_cols], F.lit(True).alias("_new"))
    j = o.join(n, key, "full_outer")
    known = F.coalesce(F.col("_old"), F.lit(False))
    in_batch = F.coalesce(F.col("_new"), F.lit(False))
    out = [F.col(key)]
    for c in cols:
        if c in update_cols:
            v = F.when(in_batch, F.col(f"_last_{c}")).otherwise(F.col(c))
        else:
            v = F.when(known, F.col(c)).otherwise(F.col(f"_new_{c}"))
        out.append(v.alias(c))
    out.append(F.when(known, F.col("created_at")).otherwise(now).alias("created_at"))
    out.append(F.when(in_batch, now).otherwise(F.col("updated_at")).alias("updated_at"))
    return j.select(*out)


def batch_rows(batch: DataFrame, columns, key: str, run_ts, order: Column, update_cols=()) -> DataFrame:
    """What a batch says of each key, to be merged later: the first row's columns, the last row's ``update_cols``."""
    b = batch.withColumn("_ord", order)
    last = F.max_by(F.struct(*update_cols), "_ord") if update_cols else F.lit(None)
    own = [c for c in columns if c not in (key, "created_at", "updated_at")]
    r = b.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) if c in batch.columns else F.lit(None).alias(c) for c in own]), "_ord").alias("_first"),
                           last.alias("_last"))
    now = as_ts(run_ts)
    return r.select(*[F.col(c) if c == key else now.alias(c) if c in ("created_at", "updated_at")
                      else F.col(f"_last.{c}" if c in update_cols else f"_first.{c}").alias(c) for c in columns])


def meta_json(df: DataFrame, keys=META_KEYS) -> Column:
    """Metadata record as JSON, missing keys as null."""
    fields = [(F.col(k) if k in df.columns else F.lit(None).cast("string")).alias(k) for k in keys]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def non_null_json(df: DataFrame, keys=ARTICLE_KEYS) -> Column:
    """Record as JSON with NULL fields left out."""
    fields = [F.col(k).alias(k) for k in keys if k in df.columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})


def export_frame(articles: DataFrame) -> DataFrame:
    """S8 + S9: one export row per article, by its status *before* packing; full files only when downloaded."""
    full = F.col("status") == "downloaded"
    return articles.select(
        F.substring(F.col("batch_id").cast("string"), 1, 6).alias("yyyymm"),
        "uuid", "data_uri", meta_json(articles).alias("meta_json"),
        F.when(full, F.col("formatted_content")).alias("formatted_content_html"),
        F.when(full, F.col("ori_content")).alias("ori_content_html"),
        F.when(full, F.col("formatted_text")).alias("formatted_text_txt"),
        F.concat(F.lit("status."), F.col("status")).alias("status_file"),
        F.concat(F.col("status_msg"), F.lit("\n")).alias("status_body"))


def publish(df: DataFrame, out_dir: str, batch_id: int, fmt: str = "parquet", by: str = "yyyymm") -> str:
    """A batch under a new name, partitioned by ``by``, then one pointer to it; the path of the data.

    Readers (`published`) go by the last pointer, so they see the batch as it
    was or as it is, whole; a writer that dies leaves no pointer.  Data is
    never overwritten: who began to read the old one can finish.  Two writers
    of one batch at a time: the second to point fails and changes nothing.
    """
    spark, root = df.sparkSession, out_dir.rstrip("/")
    path = f"{root}/data/batch_id={batch_id}/{uuid.uuid4().hex}"
    df.write.partitionBy(by).format(fmt).save(path)
    point(spark, root, batch_id, path, fmt)
    return path


def point(spark: SparkSession, root: str, batch_id: int, path: str, fmt: str) -> None:
    """Make ``path`` what readers of the batch see."""
    last = _pointers(spark, root, batch_id).agg(F.max("version")).first()[0]
    version = 0 if last is None else last + 1
    spark.createDataFrame([(path, fmt)], "path string, format string").coalesce(1).write.mode("errorifexists").parquet(
        f"{root}/pointers/batch_id={batch_id}/version={version}")


def _pointers(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    from pyspark.errors import AnalysisException
    schema = "path string, format string, version bigint"
    try:
        return spark.read.schema(schema).parquet(f"{root}/pointers/batch_id={batch_id}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def pointer(spark: SparkSession, out_dir: str, batch_id: int):
    """(path, format) of the batch that was published last; an error if none was."""
    at = _pointers(spark, out_dir.rstrip("/"), batch_id).orderBy(F.desc("version")).first()
    if at is None:
        raise LookupError(f"batch {batch_id} is not published under {out_dir}")
    return at


def published(spark: SparkSession, out_dir: str, batch_id: int) -> DataFrame:
    """The batch that was published last under ``batch_id``; an error if none was."""
    at = pointer(spark, out_dir, batch_id)
    return spark.read.format(at["format"]).load(at["path"])


# Severity of each audit reason (WARNING and up also go to the
# warnings split).  Duplicates are demoted to DEBUG.
SEVERITY = {
    "entry_without_link": "ERROR",
    "entry_ignored": "INFO",
    "entry_too_old": "INFO",
    "loose_text": "WARNING",
    "layout_missing": "ERROR",
    "body_missing": "WARNING",
    "pub_time_missing": "WARNING",
    "duplicate_title": "DEBUG",
    "duplicate_url": "DEBUG",
    "download_error": "WARNING",
    "pack_error": "ERROR",
}


def severity(reason: Column, demote_duplicates: bool = True) -> Column:
    """Severity of a reason; duplicates are WARNING unless demoted."""
    out = F.lit("INFO")
    for r, s in SEVERITY.items():
        if r.startswith("duplicate") and not demote_duplicates:
            s = "WARNING"
        out = F.when(reason == r, F.lit(s)).otherwise(out)
    return out


def audit_rows(df: DataFrame, run_ts, key: str, url: str, detail: Column | None = None,
               demote_duplicates: bool = True) -> DataFrame:
    """Every rejected row becomes an audit row."""
    detail = F.lit(None).cast("string") if detail is None else detail
    return df.where(F.col("reason").isNotNull()).select(
        as_ts(run_ts).alias("run_ts"), severity(F.col("reason"), demote_duplicates).alias("severity"),
        "reason", F.col(key).cast("string").alias("key"), F.col(url).alias("url"), detail.alias("detail"))


def write_audit(audit: DataFrame, out_dir: str, batch_id: int) -> str:
    """A batch's audit, split by severity (WARNING+ is one partition filter away), published like an export.

    A retried batch replaces its own rows for readers (`published`).
    """
    return publish(audit, out_dir, batch_id, by="severity")


def layout_reason(layout_ok: Column, root_id: Column) -> Column:
    """C9/P10 gates of a detail page: why it gives no article (NULL: it does)."""
    return F.when(~layout_ok, "layout_missing").when(root_id.isNull(), "body_missing")
