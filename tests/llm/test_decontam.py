"""Hits against a plain scan; spans, documents, parts, edge cases."""
import random
import re

import pytest

from pagemill.llm.decontam import decontaminate, report

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, n=10):
    doc, hit, found = words(text), set(), set()
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            g = w[k:k + n]
            for a in range(len(doc) - len(g) + 1):
                if doc[a:a + len(g)] == g:
                    hit |= set(range(a, a + len(g)))
                    found.add(str(i))
    return len(doc), hit, sorted(found)


def data(seed):
    rng = random.Random(seed)
    say = lambda n: [rng.choice(["A", "b", "été", "c1", "日本", "x_y", "Z"]) + str(rng.randint(0, 6)) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([1, 3, 9, 10, 11, 25]))) if i % 9 else "  ,.") for i in range(1, 30)]
    items += [(30, None), (31, ""), (3, items[4][1]), (32, items[4][1])]
    docs = [None, "", " .\n"]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            own = words(rng.choice(items)[1])
            cut = own[rng.randint(0, 3):] if rng.random() < 0.5 else own
            parts += say(rng.randint(0, 30)) + cut
        docs.append(rng.choice([", ", " ", "-"]).join(parts).upper() if rng.random() < 0.3 else "\n".join(parts))
    return [(i, t) for i, t in enumerate(docs)] + [(5, docs[5])], items


@pytest.mark.parametrize("part_bytes", [8 << 20, 400])
def test_report_against_plain_scan(spark, part_bytes):
    docs, items = data(1)
    bench = spark.createDataFrame(items + [(None, "never listed")], "item_id long, text string")
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, items int")
    got = report(df, bench, part_bytes=part_bytes).collect()
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = brute(dict(docs)[r["doc_id"]], items)
        runs = {k for s in r["spans"] for k in range(s["start"], s["stop"])}
        assert (r["n_words"], runs, r["items"]) == (n, hit, found)
        assert all(a["stop"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_remove_documents_and_spans(spark):
    docs, items = data(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(*d, [d[0]]) for d in docs], "doc_id long, text string, spans array<long>")
    clean = sorted(str(d) for d in docs if not brute(d[1], items)[1])
    kept = decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == clean
    cut = {(r["doc_id"], r["text"]) for r in decontaminate(df, bench, remove="spans").collect()}
    by_id = dict(docs)
    for i, t in cut:
        doc, (_, hit, _) = words(by_id[i]), brute(by_id[i], items)
        assert words(t) == [w for k, w in enumerate(doc) if k not in hit]
    assert decontaminate(df.limit(0), bench).collect() == []
    assert decontaminate(df, bench.limit(0)).count() == len(docs)


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_several_parts_one_at_a_time(spark, remove):
    docs, items = data(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one, many = (decontaminate(df, bench, remove=remove, part_bytes=b) for b in (8 << 20, 250))
    if remove == "documents":
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    else:                                            # what one part cuts may end a window of the next
        hits = {r["doc_id"] for r in report(df, bench).collect() if r["spans"]}
        clean = lambda f: sorted(str(r) for r in f.collect() if r["doc_id"] not in hits)
        assert clean(one) == clean(many) and one.count() == many.count()
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_a_part_is_small():
    import pickle
    import tracemalloc

    from pagemill.llm.decontam import NgramSet
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(60000)]
    items = [(i, " ".join(rng.choices(vocab, k=130))) for i in range(1500)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    part = NgramSet(items)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 18 * size and peak < 60 * size and len(pickle.dumps(part)) < 6 * size
