"""SimHash near-dedup: pigeonhole blocks, equi-join on blocks, Hamming check, components.

A fingerprint bit is set where more than half of a text's shingle hashes have
it set.  64 bits are cut into 4 blocks of 16; two fingerprints that differ in
at most 2 bits agree on at least 2 whole blocks, so they meet under one of the
6 pairs of blocks.  Work is on *distinct* fingerprints: copies never pair up.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, scan

BLOCKS = 4
HOT_KEY = 256    # fingerprints under one block key beyond which 1-bit neighbours are joined instead


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles (XXH64, seed 42, repeats count).

    Words are runs of anything but blank and \\x09-\\x0D after A-Z is
    lower-cased; a text of fewer words is one shingle; none (null, empty): 0.
    Memory is bounded by the text: votes are added 4,096 shingles at a time.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII only: both are by bytes
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    first, last = starts[:n].tolist(), (ends[shingle - 1:] - 1).tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, 4096):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[i:i + 4096], last[i:i + 4096])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keys: str = "doc_id long") -> DataFrame:
    """(``keys``, fp) of every row of ``docs(keys..., text)``; ``fp`` is the fingerprint as a signed long."""
    def rows(it):
        for *key, text in it:
            fp = fingerprint(text, shingle)
            yield *key, fp - (1 << 64) if fp >> 63 else fp
    names = [k.split()[0] for k in keys.split(",")]
    return scan(docs.select(*[F.col(n).cast("long") for n in names], F.col("text").cast("string")),
                f"{keys}, fp long", rows)


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints ``fps(fp)`` that connect all within ``max_bits``.

    Block keys of up to ``HOT_KEY`` fingerprints give every verified pair.
    Fingerprints under a fuller key are linked through their 1-bit neighbours
    instead (two within 2 bits share one): each neighbour has at most 65
    members, so the work stays in proportion to the fingerprints, none is
    dropped, and the connected components are the same.
    """
    if max_bits != 2:
        raise ValueError("the block scheme is laid out for 2 differing bits")
    width = 64 // BLOCKS
    masks = []
    for pair in combinations(range(BLOCKS), BLOCKS - max_bits):
        m = sum(((1 << width) - 1) << (width * b) for b in pair)
        masks.append(m - (1 << 64) if m >> 63 else m)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in enumerate(masks)])).alias("b")).select("b.c", "b.k", "fp")
    sizes = keyed.groupBy("c", "k").agg(F.count("*").alias("n")).where("n > 1")
    near = keyed.join(sizes.where(F.col("n") <= HOT_KEY).select("c", "k"), ["c", "k"])
    near = (near.select("c", "k", F.col("fp").alias("u"))
            .join(near.select("c", "k", F.col("fp").alias("v")), ["c", "k"])
            .where("u < v").where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
            .select("u", "v"))
    hot = keyed.join(sizes.where(F.col("n") > HOT_KEY).select("c", "k"), ["c", "k"]).select("fp").distinct()
    flips = [0, *(1 << i for i in range(63)), -(1 << 63)]
    around = (hot.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in flips])).alias("near"))
              .groupBy("near").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
              .select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u <> v")
              .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
    return near.unionByName(around).distinct()


def linked(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, root) of the distinct fingerprints ``fps(fp)``: those reachable from each other share a root."""
    fps = cut(fps)
    roots = components(links(fps, max_bits))
    return fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs(doc_id, text)``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest doc_id reachable (null only where every
    doc_id of the component is null).  Null, empty and blank texts have
    fingerprint zero and link like any other.  Repeated rows each get a row;
    other columns are not read; an empty table gives no rows.
    """
    fps = cut(fingerprints(docs, shingle))
    low = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = linked(low.select("fp"), max_bits).join(low, "fp")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return (fps.join(rooted.join(lowest, "root").select("fp", "component_id"), "fp")
            .select("doc_id", "fp", "component_id"))


def survivors(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with all its columns.

    The row of the smallest doc_id stays (null ids last); among rows of that
    id the one with the smallest hash of all columns, once.  An empty table
    stays empty; other columns may have any names.
    """
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    slim = cut(fingerprints(docs.select("doc_id", row.alias("h"), "text"), shingle, "doc_id long, h long"))
    # one row for each fingerprint before the join: copies are combined where they are read
    low = (slim.groupBy("fp", "doc_id", "h").agg(F.count("*").alias("n"))
           .groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "n")).alias("b")))
    best = (low.join(linked(low.select("fp"), max_bits), "fp").groupBy("root").agg(F.min("b").alias("b"))
            .select(F.col("b.doc_id").alias("k_id"), F.col("b.h").alias("k_h"), F.col("b.n").alias("k_n")))
    kept = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("d_id"), row.alias("d_h")).join(
        best, F.col("d_id").eqNullSafe(F.col("k_id")) & (F.col("d_h") == F.col("k_h")))
    once = kept.where("k_n = 1").select("row.*")
    return once.unionByName(kept.where("k_n > 1").dropDuplicates(["d_id", "d_h"]).select("row.*"))
