"""64-bit SimHash content fingerprint, as relational steps.

Features are 4-character shingles of the lower-cased text with non-word
characters removed, weighted by their count.  Each feature's 64-bit hash is
the low 64 bits of its md5 (two 32-bit halves, so no engine needs unsigned
64-bit arithmetic).  Bit *i* of the fingerprint is set when the weighted vote
of bit *i* over all features is positive.

Shingle counts are aggregated before the 64-way bit explode, so repeated
shingles cost one row; the vote sum is a plain ``groupBy`` (map-side
combined).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 4
NON_WORD_RE = r"[^\p{L}\p{N}_]+"


def simhash_relational(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, simhash string (signed 64-bit decimal, Q13), hi, lo) as joins and group-bys.

    Exact but row-heavy (64 rows per distinct shingle); ``simhash`` is the
    default.
    """
    norm = df.select(key, F.regexp_replace(F.lower(F.col(text)), NON_WORD_RE, "").alias("c"))
    n = F.length("c")
    sh = norm.select(key, F.explode(F.sequence(F.lit(1), F.greatest(n - WIDTH + 1, F.lit(1)))).alias("i"), "c") \
        .select(key, F.substr(F.col("c"), F.col("i"), F.lit(WIDTH)).alias("f"))
    feats = sh.groupBy(key, "f").agg(F.count("*").alias("w"))
    h = F.md5(F.col("f"))
    feats = feats.select(key, "w", F.conv(F.substr(h, F.lit(17), F.lit(8)), 16, 10).cast("bigint").alias("hi"),
                         F.conv(F.substr(h, F.lit(25), F.lit(8)), 16, 10).cast("bigint").alias("lo"))
    bits = feats.select(key, "w", "hi", "lo", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("b"))
    set_ = F.expr("shiftright(CASE WHEN b < 32 THEN lo ELSE hi END, b % 32) & 1 = 1")
    votes = bits.groupBy(key, "b").agg(F.sum(F.when(set_, F.col("w")).otherwise(-F.col("w"))).alias("v"))
    on = votes.where(F.col("v") > 0)
    fp = on.groupBy(key).agg(
        F.expr("sum(CASE WHEN b >= 32 THEN shiftleft(CAST(1 AS BIGINT), b - 32) ELSE CAST(0 AS BIGINT) END)").alias("hi"),
        F.expr("sum(CASE WHEN b < 32 THEN shiftleft(CAST(1 AS BIGINT), b) ELSE CAST(0 AS BIGINT) END)").alias("lo"))
    keys = df.select(key).distinct()
    out = keys.join(fp, key, "left").select(
        key, F.coalesce("hi", F.lit(0).cast("bigint")).alias("hi"), F.coalesce("lo", F.lit(0).cast("bigint")).alias("lo"))
    signed = F.shiftleft(F.col("hi"), 32).bitwiseOR(F.col("lo"))
    return out.select(key, signed.cast("string").alias("simhash"), "hi", "lo")


CHUNK = 8192         # distinct shingles whose bits are unpacked at a time


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of one text; beside its distinct shingles, memory is bounded by ``CHUNK``."""
    import hashlib
    import re
    from collections import Counter
    from itertools import islice

    import numpy as np

    c = re.sub(r"[^\w]+", "", (text or "").lower())
    feats = iter(Counter(c[i:i + WIDTH] for i in range(max(len(c) - WIDTH + 1, 1))).items())
    votes = np.zeros(64, np.int64)
    while some := list(islice(feats, CHUNK)):
        raw = b"".join(hashlib.md5(f.encode("utf-8")).digest()[8:] for f, _ in some)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)      # high bit first
        w = np.array([n for _, n in some], np.int64)
        votes += 2 * (w @ bits) - w.sum()
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def _simhash_batch(texts):
    import pandas as pd

    fps = [fingerprint(t) for t in texts]
    return pd.DataFrame({"hi": pd.Series([f >> 32 for f in fps], dtype="int64"),
                         "lo": pd.Series([f & 0xFFFFFFFF for f in fps], dtype="int64")})


def simhash(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, simhash, hi, lo): same values as ``simhash_relational``.

    A text is one row, so its fingerprint is a per-row computation: an
    Arrow-batched pandas UDF with numpy bit votes, no shuffle at all.
    Python's ``\\w`` (Unicode letters, digits, underscore) is the word class.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("hi long, lo long")
    def fp(texts):
        return _simhash_batch(texts)

    out = df.select(key, fp(F.col(text)).alias("_fp"))
    signed = F.shiftleft(F.col("_fp.hi"), 32).bitwiseOR(F.col("_fp.lo"))
    return out.select(key, signed.cast("string").alias("simhash"), F.col("_fp.hi").alias("hi"),
                      F.col("_fp.lo").alias("lo"))
