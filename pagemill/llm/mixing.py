"""Mixing sources to target weights: Sainte-Lague seats of equal-token blocks.

Word counts of sources give their targets.  Each source's words, in a seeded
order of its documents, are cut into shards and blocks, of ``block`` words or a thirty-second of its target.
Sources get blocks by highest quotients (votes: targets in their blocks), a source's shards
get its blocks the same way (votes: their words), and in a shard every block
is taken as often as its quota fills whole rounds; a seeded choice of blocks
takes the rest.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, worker_cache

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 128        # of a source whose target is 32 such blocks at least; shorter for others
SHARD_WORDS = 1 << 20
SHARD_DOCS = 1 << 16


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes, weights, share: float = 1.5, most: float = 2.0) -> list[float]:
    """``share`` of all sizes by weight; a target stops at ``most`` times its size, the excess is reshared."""
    size, weight = np.asarray(sizes, float), np.asarray(weights, float)
    total, free, out = share * size.sum(), np.ones(len(size), bool), np.zeros(len(size))
    while free.any():
        unit = total / weight[free].sum()
        over = free & (weight * unit > most * size)
        if not over.any():
            out[free] = weight[free] * unit
            break
        out[over] = most * size[over]
        total -= out[over].sum()
        free &= ~over
    return out.tolist()


def sainte_lague(votes: list[float], seats: int, limits: list[int]) -> list[int]:
    """Seats by highest quotient votes / (2 seats + 1); ties to the earlier party; none beyond its limit.

    A common divisor gives all but the last seats at once; those go one by one
    from a heap of quotients, about one for each party.
    """
    seats = min(seats, sum(lim for v, lim in zip(votes, limits) if v > 0))
    v, lim = np.asarray(votes, float), np.asarray(limits, np.int64)
    lim = np.where(v > 0, lim, 0)

    def at(divisor):   # no more seats than highest quotients above 1 / divisor would give
        return np.clip(np.ceil(v / divisor / 2 - 0.5), 0, lim).astype(np.int64)

    low, high = 0.0, 2.0 * float(v.max(initial=0)) + 1
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if mid > 0 and at(mid).sum() <= seats:
            high = mid
        else:
            low = mid
    got = np.maximum(at(high) - 1, 0)     # the last seat of each by quotients themselves: ties are exact there
    heap = [(-v[i] / (2 * got[i] + 1), i) for i in range(len(v)) if got[i] < lim[i]]
    heapq.heapify(heap)
    for _ in range(int(seats - got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < lim[i]:
            heapq.heappush(heap, (-v[i] / (2 * got[i] + 1), i))
    return [int(x) for x in got]


@dataclass(frozen=True)
class MixConf:
    weights: tuple[float, ...] = (5, 2, 1)    # of sources by code point, null last, repeating
    share: float = 1.5
    most: float = 2.0
    block: int = BLOCK_WORDS
    seed: int = 42


def mix(docs: DataFrame, conf: MixConf = MixConf()) -> DataFrame:
    """(doc_id, h, source, size, source_size, target, taken, spans) of every row of ``docs(doc_id, source, text)``.

    ``taken``: words the mix takes, repeats counted; ``spans``: runs of words
    (``start``, ``stop``, ``times``) that it takes.  No block, so no document,
    is taken more than ``most`` (a whole number) times.  Null and empty texts
    have size 0 and nothing taken.  A shard's last block may be shorter; a
    source's words come within about a block of its target, which is a
    thirty-second of it or a word.  The driver holds some 50 bytes for each
    source and shard, whatever their number.  ``h`` is a hash of the text; rows that repeat doc_id, source and text
    follow each other in the order and each get a row.  Other columns are not
    read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    slim = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.xxhash64(F.col("text").cast("string")).alias("h"),
                           F.col("source").cast("string").alias("source"),
                           size_of(F.col("text").cast("string")).alias("size")))
    # sources in the order of their names, numbered; the driver holds a few numbers for each, not the names
    named = cut(slim.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
                .repartitionByRange(F.col("source").isNull(), "source").sortWithinPartitions(F.col("source").isNull(), "source")
                .withColumn("at", F.monotonically_increasing_id()))
    found = named.select("at", "size", "docs").orderBy("at").toArrow()
    at, size, n_docs = (found[c].to_numpy() for c in ("at", "size", "docs"))
    weights = np.resize(np.asarray(conf.weights, float), len(at))
    goals = np.asarray(targets(size, weights, conf.share, conf.most))
    block = np.clip((np.minimum(goals, size) // 32).astype(np.int64), 1, conf.block)
    shards = np.maximum(1, np.maximum(-(-size // SHARD_WORDS), -(-n_docs // SHARD_DOCS)))
    numbers = spark.createDataFrame(pa.table({"at": at, "s": np.arange(len(at)), "target": goals, "block": block, "shards": shards}))
    sources = named.join(numbers, "at").select(F.col("source").alias("s_name"), "s", F.col("size").alias("source_size"), "target", "block", "shards")
    placed = (slim.join(sources, F.col("source").eqNullSafe(F.col("s_name")))
              .withColumn("shard", F.pmod(F.xxhash64(F.lit(conf.seed), "doc_id", "h"), F.col("shards"))))

    # seats: sources first, then each source's shards; a shard's limit is ``most`` rounds of its blocks
    counts = placed.groupBy("s", "shard").agg(F.sum("size").alias("words")).toArrow().sort_by([("s", "ascending"), ("shard", "ascending")])
    s, shard, words = (counts[c].to_numpy() for c in ("s", "shard", "words"))
    most = int(conf.most)
    blocks = -(-words // block[s])
    of_source = np.bincount(s, blocks, len(at)).astype(np.int64)
    # votes: the target in mean blocks of the source, so that short last blocks do not lower its words
    votes = np.where(size > 0, goals * of_source / np.maximum(size, 1), 0.0)
    seats = np.asarray(sainte_lague(votes, round(votes.sum()), most * of_source), np.int64)
    quotas = seats[s]
    edge = np.searchsorted(s, np.arange(len(at) + 1))
    for k in np.flatnonzero(np.diff(edge) > 1):
        a, b = edge[k], edge[k + 1]
        quotas[a:b] = sainte_lague(words[a:b], int(seats[k]), most * blocks[a:b])
    quota = spark.createDataFrame(pa.table({"s": s, "shard": shard, "quota": quotas}))
    seed = conf.seed

    # small shards go together in a group, about the words of one large shard in each
    bins = max(1, -(-int(words.sum()) // SHARD_WORDS), min(len(s), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(o=_mix64(pdf["doc_id"].fillna(-1).to_numpy(np.int64), pdf["h"].to_numpy(np.int64), seed))
        pdf = pdf.sort_values(["s", "shard", "o", "doc_id", "h", "size"], kind="stable", ignore_index=True)
        of = pdf[["s", "shard"]].to_numpy()
        edge = [0, *(np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1).tolist(), len(pdf)]
        size, block, quota = (pdf[c].to_numpy(np.int64) for c in ("size", "block", "quota"))
        spans: list[list[dict]] = []
        for a, b in zip(edge, edge[1:]):
            spans += _choose(size[a:b], int(block[a]), int(quota[a]), int(of[a, 1]), seed)
        taken = [sum((r["stop"] - r["start"]) * r["times"] for r in runs) for runs in spans]
        return pdf.assign(taken=taken, spans=spans)[
            ["doc_id", "h", "source", "size", "source_size", "target", "taken", "spans"]]

    binned = placed.join(quota, ["s", "shard"]).withColumn("bin", F.pmod(F.xxhash64("s", "shard"), F.lit(bins)))
    return binned.groupBy("bin").applyInPandas(
        choose, "doc_id long, h long, source string, size long, source_size long, target double, taken long, "
                "spans array<struct<start:long,stop:long,times:long>>")


def _choose(sizes: np.ndarray, block: int, quota: int, shard: int, seed: int) -> list[list[dict]]:
    """Runs of words taken from each document of a shard: whole rounds of its blocks, and seeded ones for the rest."""
    ends = sizes.cumsum()
    n = -(-int(ends[-1]) // block)
    times = np.full(n, quota // n if n else 0, np.int64)
    if n:
        first = np.argsort(_mix64(np.arange(n), np.full(n, shard), seed + 1), kind="stable")
        times[first[:quota % n]] += 1
    times = times.tolist()
    out = []
    for end, size in zip(ends.tolist(), sizes.tolist()):
        a, runs = end - size, []
        while a < end:
            b = min(end, (a // block + 1) * block)
            t = times[a // block]
            if t:
                at = a - (end - size)
                if runs and runs[-1]["stop"] == at and runs[-1]["times"] == t:
                    runs[-1]["stop"] = at + b - a
                else:
                    runs.append({"start": at, "stop": at + b - a, "times": t})
            a = b
        out.append(runs)
    return out


def _mix64(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Seeded 64-bit order key (splitmix finalizer)."""
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) + np.uint64(seed)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def mixed(docs: DataFrame, conf: MixConf = MixConf()) -> DataFrame:
    """The mix itself: rows of ``docs`` with the taken words, a second row for words taken twice, and so on.

    All columns are kept; ``text`` runs from each taken run's first word to the
    start of the word after it (a wholly taken text is unchanged).  Rows
    without taken words (null, empty and blank texts among them) go.
    """
    key = [F.col("doc_id").cast("long").alias("k_id"), F.xxhash64(F.col("text").cast("string")).alias("k_h"),
           F.col("source").cast("string").alias("k_source")]
    same = Window.partitionBy("k_id", "k_h", "k_source")
    plan = mix(docs, conf).select(
        F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"), F.col("source").alias("k_source"), "spans")
    plan = plan.withColumn("k_n", F.row_number().over(same.orderBy(F.to_json("spans"))))
    rows = docs.select(F.struct("*").alias("row"), *key)
    rows = rows.withColumn("k_n", F.row_number().over(same.orderBy(F.xxhash64(F.to_json("row")))))
    on = (rows["k_id"].eqNullSafe(plan["k_id"]) & (rows["k_h"] == plan["k_h"])
          & rows["k_source"].eqNullSafe(plan["k_source"]) & (rows["k_n"] == plan["k_n"]))
    spans = next(f"spans{i}" for i in range(len(docs.columns) + 1) if f"spans{i}" not in docs.columns)

    def taken_again(times):
        return F.filter(plan["spans"], lambda s: s["times"] >= times)

    passes = [taken_again(r) for r in range(1, int(conf.most) + 1)]
    joined = (rows.join(plan, on).select("row", F.explode(F.array(*passes)).alias(spans))
              .where(F.size(spans) > 0).select("row.*", spans))
    at = joined.columns.index("text")

    def run(batches):
        worker_cache(None)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                cols = part.columns[:-1]
                cols[at] = pa.array([_cut(t.as_py(), s.as_py()) for t, s in zip(part.column(at), part.columns[-1])],
                                    type=batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)


def _cut(text: str, spans: list[dict]) -> str:
    raw = text.encode("utf-8", "surrogatepass")
    words = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    edges = [0 if not k else len(raw) if k == len(words) else words[k] for s in spans for k in (s["start"], s["stop"])]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])).decode("utf-8", "surrogatepass")
