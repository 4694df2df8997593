"""Long repeats against brute force over all byte windows."""
import hashlib
import random

import pytest

from pagemill.llm import suffix
from pagemill.llm.suffix import Levels, repeats, report

LETTERS = "abcdefgh ijklé"


def brute(texts, n):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for t in raw:
        for i in range(len(t) - n + 1):
            seen[t[i:i + n]] = seen.get(t[i:i + n], 0) + 1
    out = []
    for t in raw:
        hit = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                hit[i:i + n] = b"\1" * n
        spans = sum(1 for i in range(len(t)) if hit[i] and (not i or not hit[i - 1]))
        kept = bytes(b for b, h in zip(t, hit) if not h)
        out.append((len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed):
    rng = random.Random(seed)

    def word(k):
        return "".join(rng.choice(LETTERS) for _ in range(k))

    shared = [word(rng.choice([150, 199, 200, 201, 260, 900])) for _ in range(6)]
    out = [None, "", "short", "x" * 500, "x" * 210, "ab" * 300, word(199), shared[0] * 2, word(3000)]
    for _ in range(40):
        out.append("".join(word(rng.randint(0, 300)) + rng.choice(shared) for _ in range(rng.randint(1, 4))) + word(30))
    out += [out[-1]] * 5 + [out[-2][:400] + "Z" + out[-2][401:]]
    return out


@pytest.mark.parametrize("seed,group", [(1, 4 << 20), (2, 9000), (3, 3000)])
def test_against_brute_force(spark, monkeypatch, seed, group):
    monkeypatch.setattr(suffix, "GROUP_BYTES", group)
    ts = texts(seed)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ts)], "doc_id long, text string, sha256 string")
    got = {r["doc_id"]: r for r in report(df.repartition(3)).collect()}
    for i, want in enumerate(brute(ts, 200)):
        r = got[i]
        spans = [(s["start"], s["stop"]) for s in r["spans"]]
        assert (r["n_bytes"], sum(b - a for a, b in spans), len(spans), r["kept_sha256"]) == want, i


@pytest.mark.parametrize("piece", [1 << 18, 1 << 11, 401])
def test_runs_cover_every_window_once_with_seeds_by_content(monkeypatch, piece):
    monkeypatch.setattr(suffix, "PIECE", piece)
    raw = [(t or "").encode() for t in texts(5)]
    hasher, seeds, n = suffix.Hasher(200), {}, 0
    for run in hasher.runs(raw):
        for k, first, windows, seed, h in zip(*(x.tolist() for x in run)):
            for i in range(first, first + windows):
                window = raw[k][i:i + 200]
                assert seeds.setdefault(window, (seed - i, h)) == (seed - i, h) and 0 <= seed - i <= 200 - suffix.SEED
                n += 1
    assert n == sum(max(0, len(t) - 199) for t in raw)
    sampled = suffix._sample(raw, suffix.Hasher(200))[0]
    assert {h for _, h in seeds.values()} == set(sampled.tolist())


@pytest.mark.parametrize("few", [0, 12, 10 ** 6])
@pytest.mark.parametrize("keep", [0, 7, 0xFFFFFF << 40])
def test_hash_clashes_remove_nothing(spark, monkeypatch, keep, few):
    """With few hashes, or one, what is removed is the same: bytes decide."""
    import numpy as np
    mix = suffix._mix
    monkeypatch.setattr(suffix, "FEW", few)
    monkeypatch.setattr(suffix, "_mix", lambda x: mix(x) & np.uint64(keep))
    ts = texts(6)[:30]
    batch_of = [(t or "").encode() for t in ts]
    family, hasher, numbers = suffix.Suffixes(200), suffix.Hasher(200), []
    entries = {}
    for k, (text, first, n, seed, _) in enumerate(hasher.runs(batch_of)):
        for t, a, m, p in zip(text.tolist(), first.tolist(), n.tolist(), seed.tolist()):
            key = batch_of[t][p:a + m + 199], batch_of[t][a:p]
            entries.setdefault(key, []).append((t, a))
    for key, places in entries.items():              # every entry a batch of its own
        numbers.append((family.add([(*key, len(places) > 1)])[0], places))
    masks, hit = family.matches(), [bytearray(len(t)) for t in batch_of]
    for number, places in numbers:
        for t, a in places:
            for i in np.flatnonzero(masks[number]).tolist():
                hit[t][a + i:a + i + 200] = b"\1" * 200
    for t, h, want in zip(batch_of, hit, brute(ts, 200)):
        assert sum(h) == want[1] and hashlib.sha256(bytes(b for b, x in zip(t, h) if not x)).hexdigest() == want[3]


CLASH = (
    "fahqlsigrvgmmqqkrtxxqarcdphzmuabeiqvyjyiixnjbqyhjwmznsykfkhhtmlvnqbqsweouecsmfbbbsvqrtqfowikrdyqvsnshouatwyheiiamc"
    " iaccpcyxlfmygqzi rhwubmpfceiufph vbcppemlyvuiroevdfrutfzaib yposfxroxem  pvapgnoptyss",
    "fahqlsigrvgmmqqkrtxxqarcdphzmuabeiqvyjyiixnjbqyhjwmznsykfkhhtmlvnqbqsweouecsmfbbbsvqrtqfowikrdyqvsnshouapystslwaee"
    "qlhvyqhvhflwxtrpqsxtrfkfklhvgfbkxunuav oizkaparfkdjvjweornlbj kfqyjbvnhzrrqhlcukwahaij")


def test_a_known_clash_of_the_window_hash_keeps_all_bytes(spark):
    df = spark.createDataFrame([(1, CLASH[0]), (2, CLASH[1]), (3, CLASH[0][:100])], "doc_id long, text string")
    assert all(len(t) == 200 for t in CLASH)
    assert [list(r["spans"]) for r in report(df).collect()] == [[], [], []]


def test_spans_and_kept_bytes(spark):
    ts = texts(4)
    df = spark.createDataFrame([(t,) for t in ts], "text string")
    raw = {hashlib.sha256((t or "").encode()).hexdigest(): (t or "").encode() for t in ts}
    rows = repeats(df).collect()
    assert rows
    for r in rows:
        t, at, kept = raw[r["sha256"]], 0, b""
        for s in r["spans"]:
            kept += t[at:s["start"]]
            at = s["stop"]
        assert bytes(r["kept"]) == kept + t[at:]


def test_empty_table_and_levels(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert report(df).collect() == []
    import numpy as np
    rng, levels, seen, batches = np.random.default_rng(1), Levels(), {}, []
    for _ in range(37):
        b = np.unique(rng.integers(0, 3000, rng.integers(1, 90)).astype(np.uint64))
        batches.append(b)
        levels.add(b)
        for x in b:
            seen[int(x)] = seen.get(int(x), 0) + 1
    assert levels.matched.tolist() == [seen[int(x)] > 1 for b in batches for x in b]
    assert len(levels.levels) <= 8
