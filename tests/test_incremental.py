"""Seen state, merge on read and publishing: stream against batch, expiry, crashes, bounded reads."""
import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pagemill.config import DedupConf
from pagemill.operators.dedup import dedup
from pagemill.sinks import stores as S
from pagemill.streaming import incremental as INC
from pagemill.streaming.seen import dedup_stream

RUN_TS = "2024-01-31 00:00:00"
CONF = DedupConf(title_days=300, url_days=300, title_spiders=("s",))
ROWS = "id bigint, spider string, title string, source_addr string, created_at timestamp_ntz"


def rows(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(["s", "s", "o"]), rng.choice([None, "", *(f"t{k}" for k in range(n // 5))]),
             rng.choice([None, *(f"u{k}" for k in range(n // 4))]), dt.datetime(2024, 1, 20) + dt.timedelta(minutes=i)) for i in range(n)]


def write(spark, data, folder, files):
    """Rows as files that a stream takes one by one, in order."""
    for k in range(files):
        part = data[len(data) * k // files:len(data) * (k + 1) // files]
        spark.createDataFrame(part, ROWS).coalesce(1).write.mode("append").parquet(folder)


def judged(spark, folder, work, conf, hist=None):
    s = INC.stream_table(spark, folder, spark.createDataFrame([], ROWS).schema)
    return {r["id"]: r["reason"] for r in spark.read.parquet(dedup_stream(s, work, RUN_TS, conf, ["id"], hist)).collect()}


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("url_first", [False, True])
def test_stream_equals_batch_in_every_setting(spark, tmp_path, strict, url_first):
    conf = dataclasses.replace(CONF, strict_url=strict, url_first=url_first)
    data = rows(150, 3)
    hist = spark.createDataFrame([(0, "s", "t3", "u5", dt.datetime(2024, 1, 2)), (0, "s", "t4", "u6", dt.datetime(2022, 1, 2))], ROWS)
    write(spark, data, f"{tmp_path}/in", 5)
    batch = dedup(spark.createDataFrame(data, ROWS), hist, RUN_TS, conf, F.col("id"))
    assert judged(spark, f"{tmp_path}/in", f"{tmp_path}/w", conf, hist) == {r["id"]: r["reason"] for r in batch.collect()}
    if strict:                                       # the same by tables
        handle = INC.dedup_handler(f"{tmp_path}/h", f"{tmp_path}/o", RUN_TS, conf, lambda: F.col("id"), hist)
        for k in range(3):
            handle(spark.createDataFrame(data[50 * k:50 * k + 50], ROWS), k)
        got = sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/o").collect())
        assert got == sorted(r["id"] for r in batch.where("reason IS NULL").collect())


def test_claims_expire_and_a_later_run_goes_on(spark, tmp_path):
    day = lambda n: dt.datetime(2023, 1, 1) + dt.timedelta(days=n)
    data = [(1, "s", "a", "u", day(0)), (2, "s", "a", "v", day(299)), (3, "s", "a", "w", day(302)), (4, "s", "a", "x", day(400)),
            (5, "o", "b", "y", day(401)), (6, "s", "b", "z", day(402))]
    write(spark, data[:4], f"{tmp_path}/in", 2)
    assert judged(spark, f"{tmp_path}/in", f"{tmp_path}/w", CONF) == {1: None, 2: "duplicate_title", 3: None, 4: "duplicate_title"}
    write(spark, data[4:], f"{tmp_path}/in", 1)
    assert judged(spark, f"{tmp_path}/in", f"{tmp_path}/w", CONF) == {
        1: None, 2: "duplicate_title", 3: None, 4: "duplicate_title", 5: None, 6: "duplicate_title"}


def test_one_hot_title_in_arrival_order(spark, tmp_path):
    data = [(i, "s" if i % 7 else "o", "hot", f"u{i}", dt.datetime(2024, 1, 20)) for i in range(3000, 0, -1)]
    write(spark, data, f"{tmp_path}/in", 1)
    got = judged(spark, f"{tmp_path}/in", f"{tmp_path}/w", CONF)
    assert sorted(i for i, r in got.items() if r is None) == [1] + [i for i in range(1, 3001) if i % 7 == 0]


SEED = "key long, title string, status string, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_upserts_merge_when_read_as_one_by_one(spark, tmp_path):
    rng = random.Random(2)
    seed = spark.createDataFrame([(k, f"t{k}" if k % 5 else None, "new", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)) for k in range(40)], SEED)
    state = {r["key"]: [r["title"], r["status"], r["created_at"], r["updated_at"]] for r in seed.collect()}
    now = dt.datetime(2024, 1, 31)
    for epoch in range(12):
        batch = [(rng.randint(0, 60), f"e{epoch}-{i}" if i % 4 else None, f"s{epoch}-{i}", i) for i in range(12)]
        for key, title, status, _ in batch:
            state.setdefault(key, [title, None, now, None])
            state[key][1], state[key][3] = status, now
        handle = INC.upsert_handler(f"{tmp_path}/s", "key", RUN_TS, lambda: F.col("o"), seed, ("status",), buckets=3, max_deltas=3)
        df = spark.createDataFrame(batch, "key long, title string, status string, o int")
        handle(df, epoch)
        if epoch % 5 == 0:
            handle(df, epoch)                        # a replay
    got = {r["key"]: [r["title"], r["status"], r["created_at"], r["updated_at"]]
           for r in INC.snapshot(spark, f"{tmp_path}/s", seed, "key", 3).collect()}
    assert got == state
    live = INC._live(spark, f"{tmp_path}/s", 3, 1 << 62)
    assert all(sum(x["bucket"] == b for x in live) <= 4 for b in range(3)) and any(x["base"] and x["written"] >= 0 for x in live)


def test_a_crash_before_the_log_changes_nothing(spark, tmp_path):
    seed = spark.createDataFrame([(1, "a", "new", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))], SEED)
    handle = INC.upsert_handler(f"{tmp_path}/s", "key", RUN_TS, lambda: F.lit(0), seed, ("status",), buckets=2)
    batch = lambda s: spark.createDataFrame([(1, "x", s), (2, "y", s)], "key long, title string, status string")
    handle(batch("one"), 0)
    read = lambda: sorted((r["key"], r["status"]) for r in INC.snapshot(spark, f"{tmp_path}/s", seed, "key", 2).collect())
    # epoch 1 dies after its data
    S.batch_rows(batch("lost"), seed.columns, "key", RUN_TS, F.lit(0), ("status",)).withColumn("bucket", F.lit(0)).write.partitionBy(
        "bucket").parquet(f"{tmp_path}/s/epoch=1")
    assert read() == [(1, "one"), (2, "one")]
    handle(batch("two"), 1)
    assert read() == [(1, "two"), (2, "two")]


def test_publish_shows_old_or_new_whole(spark, tmp_path):
    out = str(tmp_path / "out")
    df = lambda v, n: spark.range(n).select(F.col("id"), F.lit(v).alias("v"), (F.col("id") % 3).cast("string").alias("yyyymm"))
    with pytest.raises(LookupError):
        S.published(spark, out, 7)
    S.publish(df("old", 30), out, 7)
    old = S.published(spark, out, 7)                 # a reader that began before
    dying = F.when(F.col("id") == 59, F.raise_error(F.lit("killed"))).otherwise("new")
    with pytest.raises(Exception, match="killed"):
        S.publish(spark.range(60).select("id", dying.alias("v"), F.lit("1").alias("yyyymm")), out, 7)
    assert {r["v"] for r in S.published(spark, out, 7).collect()} == {"old"}
    S.publish(df("new", 50), out, 7)
    assert {r["v"] for r in old.collect()} == {"old"} and old.count() == 30
    assert {r["v"] for r in S.published(spark, out, 7).collect()} == {"new"} and S.published(spark, out, 7).count() == 50
