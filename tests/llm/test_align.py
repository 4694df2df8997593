"""Groups, links and corpus counts against a plain merge of both tokenizers' ends."""
import hashlib
import random
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import align as aligned
from pagemill.llm.align import Pair, align, align_documents, documents, pair_counts

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [None, "", " ", "  ", "\n", "a", "a.", ".a", " a", "x\n", "a ", ". ,", "\n\nfoo  bar \n baz", "a\xa0b", "x\xa0 y", "foo\xa0", "a\r\nb\r\n",
       ";\r x", "word.com, it's I'M don't!?", "日本語 テキスト。", "▁ x ▁▁", "<|endoftext|> a <s> </s> <unk>", "\x00a\x1cb \x1c c", "a\x00b c",
       "é.é ́́a", "tab\there\t\tx", "z" * 3000, "a  \n\n  b   ", "...a.,b", "İ K Å ﬁ 　x　", "\x85a b\x85", "𝄞𝄞 😀😀 x", "1.5% #x $y&z"]


@pytest.fixture(scope="module")
def pair():
    return Pair(open(A, "rb").read(), open(B, "rb").read())


def brute(pair, text):
    """(ids of A, ids of B, groups as text, links) or None, from whole-text encoding."""
    if not text:
        return None
    s = " " + text
    a, b = pair.a.encode(s, add_special_tokens=False).ids, pair.b.encode(text)
    ta, tb = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
    if b"".join(ta) != s.encode() or b"".join(tb) != s.encode():
        return None
    ea, eb = list(accumulate(map(len, ta))), list(accumulate(map(len, tb)))
    said, i, j = [], 0, 0
    for x in sorted(set(ea) & set(eb)):
        k, m = bisect_left(ea, x) + 1, bisect_left(eb, x) + 1
        said.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        i, j = k, m
    links, first = [], 0
    for i, x in enumerate(a):
        while eb[first] <= ea[i] - len(ta[i]):
            first += 1
        j = first
        while j < len(b) and eb[j] - len(tb[j]) < ea[i]:
            links.append((x, b[j]))
            j += 1
    return a, b, said, links


def random_texts(n, seed=4):
    rng = random.Random(seed)
    bits = ["a", "b", " ", "\n", ".", "é", "the", " of", "\xa0", "\r", "1", "'s", "日", "!", "  ", "▁", " Word", "ing"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_chunks_give_what_whole_texts_give(pair, spark):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in filter(None, ODD + random_texts(1500) + docs):
        assert "".join(pair.chunks(text)) == " " + text
        found, want = pair.records(pair.chunks(text)), brute(pair, text)
        if want is None:
            assert None in found, text
            continue
        a, b, said, links = want
        assert [sum(r[k] for r in found) for k in range(3)] == [len(a), len(b), len(said)], text
        assert ";".join(r[4] for r in found) == ";".join(said)
        assert np.frombuffer(b"".join(r[3] for r in found), np.int64).tolist() == [x << 32 | y for x, y in links]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from("abc")), min_size=1, max_size=60), st.integers(0, 3))
def test_leaves_are_the_stretches_between_common_ends(steps, intervals):
    ends = np.cumsum([n for n, _ in steps])
    last = ends[-1]
    a = np.array(sorted({e for e, (_, w) in zip(ends, steps) if w != "b"} | {last}))
    b = np.array(sorted({e for e, (_, w) in zip(ends, steps) if w != "a"} | {last}))
    common = sorted(set(a.tolist()) & set(b.tolist()))
    starts = sorted(set(random.Random(intervals).sample(common, min(intervals, len(common)))) | {last})    # given cuts
    a1, b1 = np.searchsorted(a, starts) + 1, np.searchsorted(b, starts) + 1
    got = align(a, b, np.r_[0, a1[:-1]], a1, np.r_[0, b1[:-1]], b1)
    assert a[got[1] - 1].tolist() == common and b[got[3] - 1].tolist() == common
    assert got[0].tolist() == [0, *got[1].tolist()[:-1]] and got[2].tolist() == [0, *got[3].tolist()[:-1]]


@pytest.mark.parametrize("slice_chars", [12 << 20, 700])
def test_documents_against_brute_force(spark, pair, tmp_path, slice_chars):
    texts = ODD + random_texts(120, 9) + random_texts(40, 9) + ["the cat", "the cat", "thecat the", "x" * 20000 + " the"]
    rows = [(i if i % 50 else None, t, 1, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs int, slice string").repartition(3)
    out = str(tmp_path / "s")
    align_documents(df, A, B, out, slice_chars=slice_chars)
    slices = spark.read.parquet(out)
    counts = pair_counts(slices)
    known = [brute(pair, t) for t in texts]
    held = Counter(p for k in known if k for p in set(k[3]))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    assert {(r["a_id"], r["b_id"]): (r["n_docs"], r["best"]) for r in counts.collect()} == {
        p: (n, n == top[p[0]]) for p, n in held.items()}
    want = []
    for (i, *_), k in zip(rows, known):
        a, b, said, links = k or ([], [], [], [])
        want.append((i, len(a), len(b), len(said), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
                     ";".join(said)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in documents(slices, counts).collect())


def test_digest_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "one two"), (2, None), (3, "▁")], "doc_id long, text string")
    said = {}
    for digest in (False, True):
        out = str(tmp_path / str(digest))
        align_documents(df, A, B, out, digest=digest)
        slices = spark.read.parquet(out)
        said[digest] = {r["doc_id"]: r["said"] for r in documents(slices, pair_counts(slices)).collect()}
    assert said[True] == {i: s and hashlib.sha256(s.encode()).hexdigest() for i, s in said[False].items()}
    assert said[True][2] == said[True][3] == ""
    out = str(tmp_path / "none")
    align_documents(df.limit(0), A, B, out)
    slices = spark.read.parquet(out)
    assert documents(slices, pair_counts(slices)).collect() == [] == pair_counts(slices).collect()


def random_words(n, seed):
    rng = random.Random(seed)
    return sorted({" " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(5, 12))) + rng.choice(["", "", ","])
                   for _ in range(n)})


def test_rows_of_slices_stay_small(spark, tmp_path):
    df = spark.createDataFrame([(i, "a b c d e f g h " * 6000) for i in range(100)], "doc_id long, text string").coalesce(1)
    align_documents(df, A, B, str(tmp_path / "s"), digest=True)
    sizes = [sum(len(r[c]) for c in ("codes", "n_chunk_links", "links")) for r in spark.read.parquet(str(tmp_path / "s")).collect()]
    assert sum(sizes) > 4 << 20 and max(sizes) < 6 << 20


def test_slices_are_alike_whatever_is_remembered(monkeypatch):
    words, rng = random_words(600, 5) + [" " + "x" * 80, "\xa0\x00"], random.Random(6)
    slices = [[(i, "".join(rng.choices(words, k=50)) if i % 7 else None) for i in range(20)] for _ in range(6)]
    slices[2].append((20, "▁ bytes differ"))
    found = []
    for most, long in ((1 << 20, 1 << 20), (100, 1 << 20), (1 << 20, 70), (0, 0)):
        monkeypatch.setattr(aligned, "MEMO_CHUNKS", most)
        monkeypatch.setattr(aligned, "LONG_CHARS", long)
        pair, out = Pair(open(A, "rb").read(), open(B, "rb").read()), []
        for rows in slices:
            *plain, codes, n, links, pairs, held = aligned._slice(pair, rows, False)
            codes, n, links = map(aligned._unpacked, (codes, n, links))
            each = np.split(np.array(pairs, np.int64)[links], np.cumsum(n)[:-1])
            out.append((plain, [each[c].tolist() for c in codes], dict(zip(pairs, held))))
        found.append(out)
        left, whole = pair.known, found[1:] and whole or pair.known
        assert len(left.code) <= most // 2 if most < 1 << 20 else len(left.code) > 100
        assert max(map(len, left.code), default=0) <= 64 or long > 1000
        for c in left.code:
            assert left.record(c) == whole.record(c)
    assert found[0] == found[1] == found[2] == found[3]
    known, often = aligned.Known(), [f" {k}" for k in range(9)]
    for c in often:
        known.add(c, (1, 1, 1, b"", c))
    known.used(np.array([1, 9, 1, 8, 1, 1, 7, 1, 1]))
    monkeypatch.setattr(aligned, "MEMO_CHUNKS", 6)
    assert list(known.trimmed().code) == [" 1", " 3", " 6"]


def test_row_groups_hold_few_slices(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text number {i} " * 20) for i in range(40)], "doc_id long, text string").coalesce(1)
    align_documents(df, A, B, str(tmp_path / "s"), slice_chars=700)
    sizes = [m.row_group(i).num_rows for f in (tmp_path / "s").glob("*.parquet")
             for m in [pq.ParquetFile(f).metadata] for i in range(m.num_row_groups)]
    assert sum(sizes) > 10 and max(sizes) <= 4
