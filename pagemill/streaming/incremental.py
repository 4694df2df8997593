"""Incremental mode (T1-T3): Structured Streaming with ``foreachBatch``.

The reference is an incremental crawl, not an event-time stream: it has no
watermarks or windows.  What carries over is (T1) a lookback cut-off per run,
(T2) cross-run "seen" state for de-duplication and (T3) an upsert per
micro-batch.  Seen keys live in the state store, one value for each key, and
expire (`streaming.seen`).  Tables written per epoch lie under the shared
checkpoint folder: a replayed epoch (after a failure) reads what earlier
epochs wrote, never its own output, and overwrites that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DedupConf
from ..functions.dates import end_time
from ..operators.dedup import dedup, horizon
from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir (never a machine-local temp dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


def stream_table(spark: SparkSession, path: str, schema, glob: str | None = None,
                 files_per_trigger: int = 1) -> DataFrame:
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def run_available(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything available now, one micro-batch at a time, then stop."""
    q = (stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def lookback_filter(stream: DataFrame, ts: str, run_ts, hours: Column) -> DataFrame:
    """Rows newer than ``run_ts - hours``.  A filter, not a take-while:
    in a stream the entries of one list page can arrive in any order (Q6)."""
    return stream.where(F.col(ts) >= end_time(run_ts, hours))


SEEN = "title string, source_addr string, spider string, created_at timestamp_ntz"


def _missing(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e)


def earlier_epochs(spark: SparkSession, folder: str, epoch: int, schema: str) -> DataFrame:
    """Rows (with their ``epoch``) that epochs *before* ``epoch`` wrote under ``folder``; a replay
    never sees its own output.

    Epochs are partitions of the folder, so those that are not wanted are not
    read; files of an unfinished write are not visible.
    """
    from pyspark.errors import AnalysisException
    schema += ", epoch bigint"
    try:
        return spark.read.schema(schema).parquet(folder).where(F.col("epoch") < epoch)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], schema)


def dedup_handler(history_dir: str, out_dir: str, run_ts, conf: DedupConf,
                  arrival: Callable[[], Column], seed_history: DataFrame | None = None):
    """T2 by tables: de-duplicate each micro-batch against history + all earlier epochs.

    ``history_dir`` keeps every row's claim: an accepted row claims title and
    URL; a rejected one that reached the title test claims its title, as in
    one batch, and with ``strict_url`` every row claims its URL.  Claims older
    than the horizons do not count.  Each epoch writes ``epoch=<id>`` with
    overwrite and reads only earlier ones, so a replayed epoch gives the same
    rows.  `seen.dedup_stream` does the same with a state store, which reads
    the epoch's own keys only.
    """
    def handle(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        seen = earlier_epochs(spark, history_dir, epoch, SEEN + ", accepted boolean, url_dup boolean")
        hist = spark.createDataFrame([], SEEN) if seed_history is None else seed_history.select(
            "title", "source_addr", "spider", "created_at")
        d = dedup(batch, hist, run_ts, conf, arrival(), claimed=earlier_titles(seen, run_ts, conf),
                  claimed_urls=earlier_urls(seen, run_ts, conf))
        d.where(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")
        d.select("title", "source_addr", "spider", "created_at", F.col("reason").isNull().alias("accepted"),
                 F.coalesce(F.col("reason") == "duplicate_url", F.lit(False)).alias("url_dup")) \
            .write.mode("overwrite").parquet(f"{history_dir}/epoch={epoch}")
    return handle


def earlier_titles(seen: DataFrame, run_ts, conf: DedupConf) -> DataFrame:
    """Titles that rows of earlier epochs claimed, by the same rule as within a batch (W6), inside the horizon."""
    rows = seen.where("NOT url_dup") if conf.url_first else seen
    return rows.where(F.col("created_at") >= horizon(run_ts, conf.title_days)).select("title").distinct()


def earlier_urls(seen: DataFrame, run_ts, conf: DedupConf) -> DataFrame:
    """URLs that rows of earlier epochs claimed (``strict_url``), inside the horizon."""
    return seen.where(F.col("created_at") >= horizon(run_ts, conf.url_days)).select("source_addr").distinct()


# -- T3: upserts, merged when read ---------------------------------------------

LOG = "bucket int, base boolean, written bigint, n bigint, update_cols array<string>"
MAX_DELTAS = 8
DELTA_SHARE = 0.5


def upsert_handler(snapshot_dir: str, key: str, run_ts, order: Callable[[], Column],
                   seed: DataFrame, update_cols=(), buckets: int = 64, max_deltas: int = MAX_DELTAS):
    """Per micro-batch MERGE: one row per key of the batch is appended, and merged when read.

    Rows lie in ``buckets`` key-hash buckets.  An epoch writes the rows of its
    touched buckets (``epoch=<id>/bucket=<b>``); a bucket with more than
    ``max_deltas`` of these, or whose rows since its base reach
    ``DELTA_SHARE`` of the base, is written anew as a base
    (``base=<id>/bucket=<b>``).  Last comes the log of the live parts
    (``log/epoch=<id>``): until it is there, readers and later epochs see the
    state before.  A replayed epoch reads earlier logs only.  A reader meets
    at most ``1 + max_deltas`` parts of a bucket, after any number of epochs.
    Parts that are no longer live are left for readers of older states.
    """
    from ..sinks.stores import batch_rows

    def handle(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        live = _live(spark, snapshot_dir, buckets, epoch, update_cols)
        schema = _schema(seed)
        rows = batch_rows(batch, [f.name for f in seed.schema], key, run_ts, order(), update_cols)
        rows.withColumn("bucket", _bucket(key, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{snapshot_dir}/epoch={epoch}")
        added = {r["bucket"]: r["n"] for r in spark.read.schema(schema).parquet(f"{snapshot_dir}/epoch={epoch}")
                 .groupBy("bucket").agg(F.count("*").alias("n")).collect()}        # at most ``buckets`` rows
        full = []
        for b, n in added.items():
            live.append({"bucket": b, "base": False, "written": epoch, "n": n})
            parts = [x for x in live if x["bucket"] == b]
            base, deltas = sum(x["n"] or 0 for x in parts if x["base"]), [x["n"] for x in parts if not x["base"]]
            if len(deltas) > max_deltas or (base and sum(deltas) >= DELTA_SHARE * base):
                full.append(b)
        if full:
            merged = _merged(_parts(spark, snapshot_dir, [x for x in live if x["bucket"] in full], seed, key, buckets), key, seed, update_cols)
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{snapshot_dir}/base={epoch}")
            sizes = {r["bucket"]: r["n"] for r in spark.read.schema(schema).parquet(f"{snapshot_dir}/base={epoch}")
                     .groupBy("bucket").agg(F.count("*").alias("n")).collect()}
            live = [x for x in live if x["bucket"] not in full] + [
                {"bucket": b, "base": True, "written": epoch, "n": sizes.get(b, 0)} for b in full]
        log = spark.createDataFrame([(x["bucket"], x["base"], x["written"], x["n"], list(update_cols)) for x in live], LOG)
        log.coalesce(1).write.mode("overwrite").parquet(f"{snapshot_dir}/log/epoch={epoch}")
    return handle


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _schema(seed: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in seed.schema) + ", bucket int"


def _live(spark: SparkSession, folder: str, buckets: int, before: int, update_cols=()) -> list[dict]:
    """The live parts by the last log before epoch ``before``: at most (1 + ``max_deltas``) x ``buckets``.  The seed is part -1."""
    log = earlier_epochs(spark, f"{folder}/log", before, LOG)
    last = log.agg(F.max("epoch").alias("e")).first()["e"]
    if last is None:
        return [{"bucket": b, "base": True, "written": -1, "n": None, "update_cols": list(update_cols)} for b in range(buckets)]
    return [r.asDict() for r in log.where(F.col("epoch") == last).collect()]


def _parts(spark: SparkSession, folder: str, live: list[dict], seed: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows of ``live`` parts, with ``bucket`` and ``epoch``, the epoch that wrote them."""
    out = seed.withColumn("bucket", _bucket(key, buckets)).withColumn("epoch", F.lit(-1).cast("bigint")).where(
        F.col("bucket").isin([x["bucket"] for x in live if x["written"] < 0]))
    for name, base in (("epoch", False), ("base", True)):
        paths = [f"{folder}/{name}={x['written']}/bucket={x['bucket']}" for x in live if x["base"] == base and x["written"] >= 0]
        if paths:
            rows = spark.read.schema(f"{_schema(seed)}, {name} bigint").option("basePath", folder).parquet(*paths)
            out = out.unionByName(rows.withColumnRenamed(name, "epoch"))
    return out


def _merged(parts: DataFrame, key: str, seed: DataFrame, update_cols) -> DataFrame:
    """One row per key: the first part's columns, the last part's ``update_cols`` and time (an aggregate, combined map-side)."""
    last = [*update_cols, "updated_at"]
    first = [c for c in seed.columns if c not in (key, *last)]
    m = parts.groupBy("bucket", key).agg(F.min_by(F.struct(*first), "epoch").alias("_first"), F.max_by(F.struct(*last), "epoch").alias("_last"))
    return m.select(*[F.col(c) if c == key else F.col(f"_last.{c}" if c in last else f"_first.{c}").alias(c) for c in seed.columns], "bucket")


def snapshot(spark: SparkSession, snapshot_dir: str, seed: DataFrame, key: str, buckets: int = 64,
             before: int = 1 << 62) -> DataFrame:
    """The current rows (with their ``bucket``) after the epochs before ``before``."""
    live = _live(spark, snapshot_dir, buckets, before)
    return _merged(_parts(spark, snapshot_dir, live, seed, key, buckets), key, seed, live[0]["update_cols"])
