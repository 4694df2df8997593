"""Nearest neighbours by cosine: hierarchical k-means tree, best-bin-first, calibrated leaf visits.

A tree of spherical k-means cells is fitted on a bounded sample of unit
vectors; every vector is put into the leaf that a greedy descent reaches.  A
query walks the tree with a priority queue of cells, best centroid first, and
so gets its leaves in order.  How many it visits is calibrated: visits are
widened until ``recall`` of the true neighbours of a bounded set of queries
(found by scanning all vectors) lie in visited leaves.  Candidates are scored
exactly on the original vectors.

Equal vectors are searched once; leaves are cut into blocks of bounded size,
and the queries of a block into parts, so no task holds an unbounded group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, scan


@dataclass(frozen=True)
class AnnConf:
    k: int = 5
    sample: int = 16_384          # vectors that the tree is fitted on
    branch: int = 12
    leaf_sample: int = 48         # sample vectors below which a cell stays a leaf
    rounds: int = 8               # of k-means in each cell
    calibration: int = 256        # queries with scanned neighbours
    recall: float = 0.98          # of those neighbours that visited leaves must hold
    block_rows: int = 4096        # vectors of a block
    part_queries: int = 4096      # queries of a block's part
    seed: int = 5


class Tree:
    """Cells as arrays: ``children[c]`` are cell numbers, ``leaf[c]`` a leaf number or -1."""

    def __init__(self, unit: np.ndarray, conf: AnnConf) -> None:
        rng = np.random.default_rng(conf.seed)
        self.centroids, self.children, self.leaf = [np.zeros(unit.shape[1])], [np.zeros(0, np.int64)], [-1]
        todo, self.leaves = [(0, unit)], 0
        while todo:
            cell, own = todo.pop()
            parts = _kmeans(own, conf, rng) if len(own) > conf.leaf_sample else []
            if len(parts) < 2:
                self.leaf[cell] = self.leaves
                self.leaves += 1
                continue
            kids = []
            for centre, members in parts:
                kids.append(len(self.leaf))
                self.centroids.append(centre)
                self.children.append(np.zeros(0, np.int64))
                self.leaf.append(-1)
                todo.append((kids[-1], members))
            self.children[cell] = np.array(kids)
        self.centroids = np.array(self.centroids)

    def place(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each row, by greedy descent."""
        out = np.full(len(unit), -1, np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            cell, rows = todo.pop()
            if self.leaf[cell] >= 0:
                out[rows] = self.leaf[cell]
                continue
            kids = self.children[cell]
            best = (unit[rows] @ self.centroids[kids].T).argmax(1)
            todo += [(int(kids[b]), rows[best == b]) for b in np.unique(best)]
        return out

    def order(self, q: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves in best-bin-first order, ``most`` of them."""
        near = (self.centroids @ q).tolist()
        queue, out = [(-2.0, 0)], []
        while queue and (most is None or len(out) < most):
            _, cell = heapq.heappop(queue)
            if self.leaf[cell] >= 0:
                out.append(self.leaf[cell])
            else:
                for c in self.children[cell].tolist():
                    heapq.heappush(queue, (-near[c], c))
        return out


def _kmeans(own: np.ndarray, conf: AnnConf, rng) -> list[tuple[np.ndarray, np.ndarray]]:
    centres = own[rng.choice(len(own), min(conf.branch, len(own)), replace=False)]
    for _ in range(conf.rounds):
        of = (own @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, own)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centres)
    of = (own @ centres.T).argmax(1)
    return [(centres[c], own[of == c]) for c in np.unique(of)]


def usable(vector) -> np.ndarray | None:
    """The vector in double precision, or None: null, empty, zero, or holding null or non-finite values."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    v = np.array(vector, float)
    return v if np.isfinite(v).all() and v.any() else None


def unit(v: np.ndarray) -> np.ndarray:
    v = np.ldexp(v, -int(np.frexp(np.abs(v).max())[1]))      # exact: squares neither overflow nor vanish
    return v / np.linalg.norm(v)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row of ``a`` with the same row of ``b``: dot product over both lengths, in double precision."""
    a = np.ldexp(a, -np.frexp(np.abs(a).max(1, keepdims=True))[1])
    b = np.ldexp(b, -np.frexp(np.abs(b).max(1, keepdims=True))[1])
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _pad(vectors: list[np.ndarray], dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's ``k`` best and all that could tie with them."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    kth = np.partition(scores, -k, axis=1)[:, -k]
    return scores >= kth[:, None] - 1e-9


def nearest(vectors: DataFrame, is_query, conf: AnnConf = AnnConf()) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each query of ``vectors(vec_id, embedding)``.

    ``is_query`` is a condition on vec_id.  ``score`` is the cosine in double
    precision on the original vectors; equal scores go to the smaller vec_id.
    Rows whose vector is null, empty, zero or holds null or non-finite values,
    and rows without vec_id, take no part; shorter vectors count as filled up
    with zeros.  Rows that repeat vec_id and vector count once, and every row
    of a query's own vec_id is its own.  A query without other vectors has no
    rows; other columns are not read.
    """
    spark = vectors.sparkSession

    def clean(it):
        for vec_id, vector in it:
            v = usable(vector)
            if vec_id is not None and v is not None:
                yield vec_id, v.tobytes()

    rows = scan(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")),
                "vec_id long, vec binary", clean).distinct()
    # distinct vectors with their k + 2 smallest ids: enough for any query, its own left out
    first = Window.partitionBy("vec").orderBy("vec_id")
    lists = cut(rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= conf.k + 2)
                .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                .withColumn("key", F.xxhash64("vec")))
    dims = lists.agg(F.max(F.octet_length("vec")).alias("d"), F.count("*").alias("n")).first()
    queries = rows.where(is_query)
    out = "query_id long, rank int, vec_id long, score double"
    if not dims["n"]:
        return spark.createDataFrame([], out)
    dim = dims["d"] // 8

    order = F.xxhash64(F.lit(conf.seed), "key")
    sample = [r["vec"] for r in lists.orderBy(order, "vec").limit(conf.sample).select("vec").collect()]
    tree = Tree(_pad([unit(np.frombuffer(v)) for v in sample], dim), conf)
    del sample
    held = spark.sparkContext.broadcast(tree)        # bounded by the sample

    def place(it):
        for some in _some(it):
            leaves = held.value.place(_pad([unit(np.frombuffer(r[0])) for r in some], dim))
            for r, leaf in zip(some, leaves.tolist()):
                yield (*r, leaf)

    placed = cut(scan(lists.select("vec", "ids", "key"), "vec binary, ids array<long>, key long, leaf long", place))
    # one search for each distinct query vector
    asked = queries.select("vec").distinct()
    visits = _calibrate(spark, placed, asked, tree, dim, conf)

    def route(it):
        for (vec,) in it:
            yield vec, held.value.order(unit(_pad([np.frombuffer(vec)], dim)[0]), visits)

    routed = cut(scan(asked, "vec binary, leaves array<long>", route))

    # leaves into blocks: at most one row for each leaf comes to the driver
    sizes = dict(placed.groupBy("leaf").count().collect())
    parts = max(1, -(-routed.count() // conf.part_queries))
    layout, block, room = [], -1, 0
    for leaf in sorted(sizes):
        n = sizes[leaf]
        if n > room:
            block, room = block + 1, conf.block_rows
        blocks = -(-n // conf.block_rows)
        layout.append((leaf, block, blocks, parts))
        room -= n
        block += blocks - 1
    table = F.broadcast(spark.createDataFrame(layout, "leaf long, block long, blocks long, parts long"))
    stored = (placed.join(table, "leaf")
              .withColumn("block", F.col("block") + F.pmod("key", F.col("blocks")))
              .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .select("block", "part", "leaf", "vec", "ids"))
    asking = (routed.select("vec", F.explode("leaves").alias("leaf")).join(table, "leaf")
              .withColumn("part", F.pmod(F.xxhash64("vec"), F.col("parts")))
              .withColumn("block", F.explode(F.sequence(F.col("block"), F.col("block") + F.col("blocks") - 1)))
              .groupBy("block", "part", "vec").agg(F.collect_list("leaf").alias("leaves")))
    k = conf.k

    def search(key: tuple, stored: pa.Table, asking: pa.Table) -> pa.Table:
        found = []
        if stored.num_rows and asking.num_rows:
            vecs = _pad([np.frombuffer(v) for v in stored.column("vec").to_pylist()], dim)
            units = np.array([unit(v) for v in vecs])
            leaf = stored.column("leaf").to_numpy()
            ids = stored.column("ids").to_pylist()
            raw = asking.column("vec").to_pylist()
            leaves = asking.column("leaves").to_pylist()
            for a in range(0, len(raw), 256):
                q = _pad([np.frombuffer(v) for v in raw[a:a + 256]], dim)
                scores = np.array([unit(v) for v in q]) @ units.T
                for i, ls in enumerate(leaves[a:a + 256]):
                    scores[i, ~np.isin(leaf, ls)] = -2
                at_q, at_v = np.nonzero(_top(scores, k + 1) & (scores > -1.5))
                exact = cosine(q[at_q], vecs[at_v])
                found += [(raw[a + i], ids[j], s) for i, j, s in zip(at_q.tolist(), at_v.tolist(), exact.tolist())]
        cols = list(zip(*found)) or [()] * 3
        return pa.table({"q": pa.array(cols[0], pa.binary()), "ids": pa.array(cols[1], pa.list_(pa.int64())),
                         "score": pa.array(cols[2], pa.float64())})

    near = (stored.groupBy("block", "part").cogroup(asking.groupBy("block", "part"))
            .applyInArrow(search, "q binary, ids array<long>, score double"))
    # a query's k + 2 best distinct vectors hold its k nearest ids
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 2).drop("n")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q")).join(near, "q")
            .select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id <> vec_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _some(it, n: int = 1024) -> Iterator[list[tuple]]:
    some = []
    for row in it:
        some.append(row)
        if len(some) == n:
            yield some
            some = []
    if some:
        yield some


def _calibrate(spark, placed: DataFrame, asked: DataFrame, tree: Tree, dim: int, conf: AnnConf) -> int:
    """Leaf visits that hold ``conf.recall`` of the scanned neighbours of up to ``conf.calibration`` queries."""
    raw = [r["vec"] for r in asked.orderBy(F.xxhash64(F.lit(conf.seed), "vec"), "vec").limit(conf.calibration).collect()]
    if not raw:
        return 1
    q = np.array([unit(v) for v in _pad([np.frombuffer(v) for v in raw], dim)])
    held, k = spark.sparkContext.broadcast(q), conf.k

    def best(it):
        top = [[] for _ in range(len(held.value))]           # of this partition, k for each query
        for some in _some(it):
            scores = held.value @ np.array([unit(v) for v in _pad([np.frombuffer(r[0]) for r in some], dim)]).T
            at_q, at_v = np.nonzero(_top(scores, k + 1))
            for i, j in zip(at_q.tolist(), at_v.tolist()):
                top[i].append((float(scores[i, j]), some[j][1]))
            top = [sorted(t, reverse=True)[:k + 1] for t in top]
        for i, t in enumerate(top):
            for s, leaf in t:
                yield i, s, leaf

    w = Window.partitionBy("i").orderBy(F.desc("s"), "leaf")
    truth = (scan(placed.select("vec", "leaf"), "i int, s double, leaf long", best)
             .withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1).collect())
    orders = [{leaf: r for r, leaf in enumerate(tree.order(v), 1)} for v in q]
    # the nearest is the query itself
    needed = np.sort([orders[r["i"]][r["leaf"]] for r in truth if r["n"] > 1])
    visits = 1
    while len(needed) and np.searchsorted(needed, visits, side="right") < conf.recall * len(needed):
        visits += 1
    return visits
