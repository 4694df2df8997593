"""Recall against brute force; special vectors, ties, copies."""
import math

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm.ann import AnnConf, nearest


def brute(rows, k, is_query):
    ok = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    out = {}
    for q in filter(is_query, ok):
        s = sorted((-(ok[q] @ v) / math.sqrt((ok[q] @ ok[q]) * (v @ v)), i) for i, v in ok.items() if i != q)
        out[q] = [(i, -x) for x, i in s[:k]]
    return out


def collect(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in df.collect()]
    want = brute(rows, 5, lambda i: i % 50 == 0)
    got = collect(nearest(df, F.col("vec_id") % 50 == 0))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    vec = dict(rows)
    for q, found in got.items():
        assert len(found) == 5
        for i, s in found:
            a, b = np.array(vec[q]), np.array(vec[i])
            assert abs(s - (a @ b) / math.sqrt((a @ a) * (b @ b))) < 1e-12


def test_special_vectors_ties_and_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(300)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300, 420)]          # copies
    rows += [(420, [2.0, 4.0, 6.0, 8.0]), (421, None), (422, []), (423, [0.0] * 4), (424, [1.0, None, 0.0, 0.0]),
             (425, [float("nan")] * 4), (426, [float("inf"), 0.0, 0.0, 0.0]), (427, [1e300, 1e300, 0.0, 0.0]),
             (428, [5e-324, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows] + [(5, rows[5][1], 1.0), (None, [1.0] * 4, 1.0)],
                               "vec_id long, embedding array<double>, score double")
    conf = AnnConf(recall=1.0, leaf_sample=16, block_rows=40, part_queries=3)
    got = collect(nearest(df, F.col("vec_id") % 3 == 0, conf))
    plain = [r for r in rows if r[0] < 421]
    want = brute(plain, 5, lambda i: i % 3 == 0)
    assert set(got) == set(want) | {q for q in (426, 427) if q == 427 and q % 3 == 0}
    for q in (300, 303, 417):
        assert [i for i, _ in got[q]] == [i for i in range(300, 420) if i != q][:5]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0]), (7, [1.0, 1.0])], schema)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 7)]
