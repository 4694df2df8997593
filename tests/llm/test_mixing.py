"""Seats against the definition; targets; the mix against its contract."""
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm.mixing import MixConf, mix, mixed, sainte_lague, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_quotients(votes, seats, limits):
    got = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if got[i] < limits[i] and votes[i] > 0]
        if not open_:
            break
        got[max(open_, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 12)), min_size=1, max_size=8), st.integers(0, 60))
def test_seats_by_highest_quotients(parties, seats):
    votes, limits = [float(v) for v, _ in parties], [lim for _, lim in parties]
    assert sainte_lague(votes, seats, limits) == by_quotients(votes, seats, limits)


def test_targets_stop_and_reshare():
    assert targets([100, 100, 100], [5, 2, 1]) == pytest.approx([200, 500 / 3, 250 / 3])
    assert targets([10, 10, 1000], [5, 2, 1]) == pytest.approx([20, 20, 1490])
    assert targets([0, 8], [5, 2]) == pytest.approx([0, 12])
    assert targets([], []) == [] and targets([0], [5]) == [0]


def check(rows):
    taken, sizes = defaultdict(int), defaultdict(int)
    target = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        target[r["source"]] = (r["target"], r["source_size"])
    names = sorted(target, key=lambda s: (s is None, (s or "").encode()))
    want = targets([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, w in zip(names, want):
        assert target[s] == (pytest.approx(w), sizes[s])
        assert abs(taken[s] - w) <= max(0.01 * w, 200), s
    return taken


def test_mix_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    check(rows)
    again = mix(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["taken"], str(r["spans"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_nulls_repeats_and_the_texts_taken(spark):
    rows = [(i, f"w{i} " * (i % 37), "é" if i % 3 else "z") for i in range(300)]
    rows += [(7, "a b c", "z")] * 5 + [(None, "n n n", None), (None, None, None), (9, "", None), (10, " \n", "z")]
    df = spark.createDataFrame([(*r, i, [1.0]) for i, r in enumerate(rows)],
                               "doc_id long, text string, source string, spans int, taken array<double>")
    conf = MixConf(block=4)
    plan = mix(df, conf).collect()
    assert len(plan) == len(rows)
    for r in plan:
        assert r["taken"] == sum((s["stop"] - s["start"]) * s["times"] for s in r["spans"]) <= 2 * r["size"]
    out = mixed(df, conf).collect()
    assert mixed(df, conf).columns == df.columns
    assert sum(len(WORD.findall(r["text"])) for r in out) == sum(r["taken"] for r in plan)
    words = defaultdict(int)
    for r in out:
        words[r["source"]] += len(WORD.findall(r["text"]))
    for s, w in words.items():
        assert abs(w - next(p["target"] for p in plan if p["source"] == s)) <= 8
    by_row = defaultdict(list)
    for r in out:
        by_row[r["spans"]].append(r["text"])
    for i, texts in by_row.items():       # every copy is made of words of its own row
        assert len(texts) <= 2 and all(set(t.split()) <= set(rows[i][1].split()) for t in texts)
    assert mix(df.limit(0)).collect() == [] and mixed(df.limit(0)).collect() == []


def test_tiny_sources_come_near_their_targets(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 40:02d}") for i in range(200)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        most[r["source"]] += r["size"]
    assert all(abs(taken[s] - t) <= max(1, 0.05 * t) for s, t in target.items())


def test_many_sources(spark):
    """Far more sources than rows of a broadcast: each near its target, in the order of code points."""
    n = 120_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"),
                               F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id").cast("string"))).alias("source"))
    rows = mix(df).select("source", "size", "target", "taken").collect()
    assert len(rows) == n
    names = sorted(rows, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    want = targets([r["size"] for r in names], [(5, 2, 1)[i % 3] for i in range(n)])
    assert all(r["target"] == pytest.approx(w) and abs(r["taken"] - w) <= 1 for r, w in zip(names, want))


def test_size_counts_words(spark):
    from pagemill.llm.mixing import size_of
    df = spark.createDataFrame([("a b\tc\x0bd  e",), (None,), ("",), (" \x1f \xa0x",)], "text string")
    assert [r[0] for r in df.select(size_of(F.col("text"))).collect()] == [5, 0, 0, 2]
