"""T2 with keyed state: titles and URLs seen, in the state store, with a time limit.

Each key (a title, a URL) holds one value, the time of the row that claimed
it.  An epoch reads and writes its own keys only, whatever came before; a
claim stops counting when it is older than the horizon and is removed when
the watermark has passed it.  Spark takes one such operator in a query, so
the strict URL test is a query of its own before the title test, joined to it
by a file sink's exactly-once table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructType

from ..config import DedupConf
from ..functions.dates import as_ts
from ..operators.dedup import history_titles, history_urls
from .incremental import SEEN

_DAY = pd.Timedelta(days=1)


def first_of_key(rows: DataFrame, key: str, days: int, arrival: list[str], claims: str, competes: str, at: str, out: str) -> DataFrame:
    """``rows`` of a stream with ``out``: whether an earlier row, of this epoch or one before, has claimed the row's ``key``.

    Rows whose ``claims`` holds take the key, in the order of ``arrival``;
    only rows whose ``competes`` holds can be late.  A claim counts for a row
    up to ``days`` before the row's day.  Rows with a NULL key are never late.
    ``at`` is the row's time, with a watermark.  However many rows a key has
    in an epoch, one of them is held at a time.
    """
    schema = StructType([*rows.schema.fields]).add(out, BooleanType())

    def judge(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        claimed = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        held = None                                  # the first row so far, if it would be late behind another
        best = best_at = None
        for f in frames:
            f = f.copy()
            null = f[key].isna()
            late = f[competes].astype(bool) & ~null
            if claimed is not None:
                fresh = claimed >= f[at].dt.normalize() - days * _DAY
                if fresh.all():
                    f[out] = late
                    yield f
                    continue
            f[out] = late
            own = f[f[claims].astype(bool) & ~null]
            if claimed is not None:                  # the claim is too old for these
                own = own[~fresh.loc[own.index]]
            if not len(own):
                yield f
                continue
            first = own.sort_values(arrival).iloc[[0]]
            place = tuple(first.iloc[0][c] for c in arrival)
            if best is None or place < best:
                best, best_at = place, first.iloc[0][at]
                if held is not None:
                    yield held                       # it came later than this one
                held = first if first.iloc[0][out] else None
                if held is not None:
                    f = f.drop(index=first.index)
            if len(f):
                yield f
        if held is not None:
            held = held.copy()
            held[out] = False
            yield held
        if best_at is not None:
            claimed = best_at
            state.update((int(best_at.value // 1000),))
        if claimed is not None:
            expires = claimed + (days + 1) * _DAY
            state.setTimeoutTimestamp(max(int(expires.value // 10 ** 6), state.getCurrentWatermarkMs() + 1))

    return rows.groupBy(key).applyInPandasWithState(judge, schema, "claimed bigint", "append", GroupStateTimeout.EventTimeTimeout)


def _run(stream: DataFrame, path: str, checkpoint: str) -> None:
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()


def dedup_stream(stream: DataFrame, work: str, run_ts, conf: DedupConf, arrival: list[str],
                 history: DataFrame | None = None) -> str:
    """Everything that ``stream`` has now, with ``reason`` as `operators.dedup` gives it; the path of the table it adds to.

    ``stream`` has title, source_addr, spider and created_at besides what
    ``arrival`` (columns in order, together unique) names.  Called again, it
    goes on where it stopped: offsets, claims and results lie under ``work``.
    Rows more than the horizon behind the newest are too late and left out.
    """
    spark = stream.sparkSession
    hist = spark.createDataFrame([], SEEN) if history is None else history
    days = max(conf.title_days, conf.url_days)
    at = F.coalesce(F.col("created_at").cast("timestamp"), as_ts(run_ts).cast("timestamp"))
    b = stream.join(history_urls(hist, run_ts, conf).withColumn("_url", F.lit(True)), "source_addr", "left") \
        .withColumn("_url_dup", F.coalesce("_url", F.lit(False))).drop("_url").withColumn("_all", F.lit(True))
    if conf.strict_url:
        b = first_of_key(b.withColumn("_at", at).withWatermark("_at", f"{days} days"), "source_addr", conf.url_days, arrival,
                         "_all", "_all", "_at", "_url_late")
        _run(b, f"{work}/urls", f"{work}/urls-checkpoint")
        b = spark.readStream.schema(b.schema).parquet(f"{work}/urls").withColumn("_url_dup", F.col("_url_dup") | F.col("_url_late")) \
            .drop("_url_late", "_at")
    b = b.join(history_titles(hist, run_ts, conf).withColumn("_title", F.lit(True)), "title", "left")
    b = b.withColumns({"_listed": F.col("spider").isin(*conf.title_spiders), "_at": at,
                       "_claims": ~F.col("_url_dup") if conf.url_first else F.lit(True)})
    b = b.withColumn("_listed", F.coalesce("_listed", F.lit(False)))
    b = first_of_key(b.withWatermark("_at", f"{days} days"), "title", conf.title_days, arrival, "_claims", "_listed", "_at", "_title_late")
    title_dup = F.col("_title_late") | (F.col("_listed") & F.coalesce("_title", F.lit(False)))
    url = F.when(F.col("_url_dup"), "duplicate_url")
    title = F.when(title_dup, "duplicate_title")
    out = b.withColumn("reason", F.coalesce(url, title) if conf.url_first else F.coalesce(title, url)).drop(
        "_url_dup", "_all", "_title", "_listed", "_at", "_claims", "_title_late")
    _run(out, f"{work}/judged", f"{work}/judged-checkpoint")
    return f"{work}/judged"
