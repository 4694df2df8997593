"""Noisy-or and its gradient; held-out accuracy; located sentences; edge cases."""
import math
import random

from pyspark.sql import functions as F

from pagemill.llm.queries import op3_toxicity
from pagemill.llm.toxicity import ToxicConf, ToxicModel, fit, fit_sample, locate, score, score_text, sentences


def sample(n=1500, seed=3):
    rng = random.Random(seed)
    common = ["alba", "bero", "cido", "dura", "efti", "gola", "hemi", "ipso"]
    out = []
    for _ in range(n):
        bad = rng.random() < 0.25
        lines = [[rng.choice(common) + rng.choice("abc") for _ in range(rng.randint(3, 9))] for _ in range(rng.randint(2, 30))]
        for _ in range(rng.randint(1, 3) if bad else 0):
            rng.choice(lines).append(rng.choice(["scumfoo", "vilebar", "nastyqux"]))
        out.append((". ".join(" ".join(x) for x in lines) + ".", int(bad), 1.0))
    return out


def test_learns_words_from_document_labels_and_locates_them():
    rows = sample()
    model = fit_sample(rows[:1000])
    right = sum((score_text(t, model) >= 0.5) == bool(y) for t, y, _ in rows[1000:])
    assert right >= 0.98 * 500
    for t, y, _ in rows[1000:1100]:
        found = locate(t, model)
        for s in found:
            assert any(w in t[s["start"]:s["stop"]] for w in ("scumfoo", "vilebar", "nastyqux"))
        assert not y or found


def test_score_is_noisy_or_over_all_sentences():
    model = ToxicModel({"bad": 4.0, "wor-": 1.5, "worse": 0.5}, -5.0, (3,))
    text = "fine text. bad bad\nworse, BAD! . ? worst 12"
    p = 1.0
    for s in sentences(text, model.stems):
        p *= 1 - 1 / (1 + math.exp(5 - sum(model.weights.get(f, 0) for f in s)))
    assert abs(score_text(text, model) - (1 - p)) < 1e-12
    assert score_text(None, model) == score_text("", model) == score_text("12 !?", model) == 0
    assert 0 <= score_text("bad. " * 100_000, model) <= 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op3_toxicity(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null")
    r = got.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int")),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 1, F.col("predicted")))).first()
    assert r[0] > 0.96 and r[1] < 0.02 and r[2] > 0.8


def test_nulls_empty_and_repeats(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "plain words", 5), (3, "plain words", 5), (None, "x", 5)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 0), (2, 1), (3, None), (3, 7), (9, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        rows = score(docs, fit(docs, labels, conf=ToxicConf(min_docs=1))).collect()
        assert len(rows) == 5 and all(0 <= r["score"] < 0.5 and r["offending"] == [] for r in rows)
    assert score(docs.limit(0), fit(docs.limit(0), some)).collect() == []
