"""Rule counts against plain loops; bands on planted junk and on clean prose; edge cases."""
import base64
import random
import re
from collections import Counter

import zstandard

from pagemill.llm import compression
from pagemill.llm.compression import Bands, Judge, keep, repeats, scores


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def prose(rng, n):
    syllables = "the an er on re ti th wh st ing ed ou ha le of nd".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


TEXTS = [None, "", " ", "\n\n \n", "a", "a b c", "a b c a b c", "a a a a", " lead and trail ", "x\x0by\x0cz\r\nq", "日本 語 日本 語 日本", "a\n\na\n a\na ",
         "# * $ <b> & | %\n#", "é é é\né é é", "\x85 \xa0 \x1f a"]


def test_counts_against_plain_loops(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abcd#\n\t") + rng.choice(["", "\n"]) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    texts += [prose(rng, 400), prose(rng, 30) + " " + "again and again " * 40, prose(rng, 60000)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, 1.0, True) for i, t in enumerate(texts)] + [(None, "x", 2.0, False), (5, "a b", 2.0, False)],
                               "doc_id long, text string, ratio double, kept boolean").repartition(3)
    got = {r["doc_id"]: r for r in scores(df).collect() if r["ratio"] != 0}
    assert scores(df).count() == len(texts) + 2
    judge = Judge(Bands())
    for i, t in enumerate(texts):
        if i == 5:
            continue
        r = got[i]
        *counts, failed = brute(t)
        assert [r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]] == counts, t
        assert r["base_failed"] == failed and r["kept"] == (not failed and judge(t)[2] is None)
        assert (r["reason"] is None) == r["kept"]
    kept = keep(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if r["kept"])
    assert scores(df.limit(0)).collect() == [] == keep(df.limit(0)).collect()


def test_many_distinct_words(monkeypatch):
    text = "a b c d a b c e f"
    wide = " ".join(str(i) for i in range(1 << 21)) + " " + text
    assert repeats([wide, text]) == [((1 << 21) + 9, 6), (9, 6)]


def test_whole_text_bands():
    rng, judge = random.Random(1), Judge(Bands())
    for n in (60, 200, 1000, 5000, 40000):
        assert judge(prose(rng, n))[2] is None
        noise = base64.b64encode(rng.randbytes(5 * n)).decode()
        noise = " ".join(noise[k:k + 7] for k in range(0, len(noise), 7))
        assert n < 400 or judge(noise)[2] == "incompressible"
        assert judge((prose(rng, 8) + " ") * (n // 4))[2] == "repetitive"
    ratio = judge("plain text " * 30)[0]
    data = b"plain text " * 30
    assert ratio == len(data) / len(zstandard.ZstdCompressor(level=3).compress(data))
    assert judge("") == judge(None) == (None, 0.0, None)


def test_chunks_find_junk_inside_usual_text():
    rng, judge = random.Random(2), Judge(Bands())
    clean = prose(rng, 6000)
    noise = base64.b64encode(rng.randbytes(16000)).decode()
    ratio, share, reason = judge(clean + noise)
    assert reason == "chunks" and 0.3 < share < 0.6 and 1.45 < ratio < 8
    assert judge(clean)[1:] == (0.0, None)
    one = clean[:30000] + base64.b64encode(rng.randbytes(3000)).decode()
    assert 0 < judge(one)[1] <= 0.3 and judge(one)[2] is None        # a little junk is not a verdict


def test_length_classes_have_their_own_limits():
    bands = Bands(limits=((10, 0.0, 1.0), (40, 0.0, 100.0)))
    judge = Judge(bands)
    assert judge("a" * 30)[2] == "repetitive" and judge("a" * 40)[2] is None and judge("a" * 9)[2] is None
    assert compression.base_reason(49, 0, bands) == "few words"
    assert compression.base_reason(50, 26, bands) == "repeated words" and compression.base_reason(50, 25, bands) is None
