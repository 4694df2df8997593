"""Fingerprints bit by bit; links and components against all pairs."""
import random
from itertools import combinations

import pytest
import xxhash

from pagemill.llm import simhash
from pagemill.llm.simhash import fingerprint, linked, near_duplicates, survivors


def plain(text, k=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps):
    root = {f: f for f in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(set(fps)), 2):
        if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {f: top(f) for f in fps}


def test_fingerprint_and_jvm_hash(spark):
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 4, 50, 9000):
        t = " \n".join(rng.choice(["A", "é", "ÉA", "zz", "x\xa0y", "\x1f"]) + str(rng.randint(0, 40)) for _ in range(n))
        assert fingerprint(t) == plain(t)
    assert fingerprint(None) == fingerprint(" \t") == 0
    jvm = spark.sql("select xxhash64('a b ü')").first()[0]
    assert jvm % 2 ** 64 == xxhash.xxh64_intdigest("a b ü".encode(), 42)


@pytest.mark.parametrize("hot", [256, 3])
def test_components_against_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    rng = random.Random(hot)
    fps = [rng.getrandbits(64) for _ in range(60)] + [0, 2 ** 64 - 1, 1, 7, 2 ** 63, 2 ** 63 + 3]
    for _ in range(240):        # chains and clusters: 0 to 3 flips of an earlier one
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(0, 3)):
            f ^= 1 << b
        fps.append(f)
    signed = sorted({f - 2 ** 64 if f >> 63 else f for f in fps})
    got = {r["fp"]: r["root"] for r in linked(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = groups(signed)
    assert set(got) == set(signed)
    assert {frozenset(f for f in got if got[f] == r) for r in got.values()} == \
        {frozenset(f for f in want if want[f] == r) for r in want.values()}


def test_query_shape_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    fps = {r["doc_id"]: plain(r["text"]) for r in rows}
    root = groups(list(fps.values()))
    low = {}
    for d, f in fps.items():
        low[root[f]] = min(d, low.get(root[f], d))
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["fp"] % 2 ** 64, r["component_id"]) == (fps[r["doc_id"]], low[root[fps[r["doc_id"]]]])
    kept = survivors(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(low.values())


def test_nulls_repeats_empty_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(3, None, 1), (2, "", 2), (5, " ", 3), (7, "one two three four", 4), (7, "one two three four", 4),
         (8, "one two three four", 5), (None, "another text here now", 6), (None, "another text here now", 6),
         (7, "quite some other words", 7)], "doc_id long, text string, fp int")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in near_duplicates(df).collect())
    assert got == sorted([("3", 2), ("2", 2), ("5", 2), ("7", 7), ("7", 7), ("8", 7), ("None", None), ("None", None), ("7", 7)])
    kept = sorted((str(r["doc_id"]), r["fp"]) for r in survivors(df).collect())
    assert kept == [("2", 2), ("7", 4), ("7", 7), ("None", 6)]
    assert near_duplicates(df.limit(0)).collect() == [] and survivors(df.limit(0)).collect() == []
