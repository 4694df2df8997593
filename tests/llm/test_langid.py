"""Gradients against differences; held-out accuracy; edge cases."""
import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import langid
from pagemill.llm.langid import Gru, Labeller, LangConf, fit, keep_known, predict
from pagemill.llm.queries import op9_language_id


def test_backpropagation_through_time():
    model = Gru(["a", "b", "c"], 5, 1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(2)
    x, y = rng.integers(97, 103, (4, 6)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        return -np.log(model.probs(x)[:, np.arange(4), y]).mean()

    for k, g in model._grads(x, y).items():
        for at in [tuple(rng.integers(0, n) for n in g.shape) for _ in range(6)] + [np.unravel_index(np.abs(g).argmax(), g.shape)]:
            old, e = model.p[k][at], 1e-3
            model.p[k][at] = old + e
            up = loss()
            model.p[k][at] = old - e
            down = loss()
            model.p[k][at] = old
            assert abs((up - down) / (2 * e) - g[at]) < 2e-3 * max(1, abs(g[at])) * 3, k


def test_document_probability_is_the_mean_over_letter_bytes():
    model = Gru(["a", "b"], 4, 3)
    text = "Été, don't12 ÉTÉ!\n" + "x" * 70
    want, n = np.zeros(2), 0
    for run in langid.LETTERS.findall(text.lower()):
        for p in langid.pieces(run):
            want += model.probs(np.frombuffer(p, np.uint8)[None]).sum((0, 1))
            n += len(p)
    got = Labeller(model, 100).probs([None, text, "12 !", ""])
    assert got[0] is None and got[2] is None and got[3] is None
    assert np.allclose(got[1], want / n, atol=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op9_language_id(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    r = got.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.min("score"), F.max("score"), F.count("*")).first()
    assert r[0] > 0.98 and 0 <= r[1] and r[2] <= 1 and r[3] > 2000


def test_every_language_and_whole_texts_teach(spark):
    rows = [(i, f"word{chr(97 + i % 26)} text", f"l{i:03d}") for i in range(320)]
    rows.append((400, "alpha " * 4000 + "omega " * 4000, "long"))       # 48,000 characters
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    conf = LangConf(steps=2)
    assert len(fit(df, conf=conf).langs) == 321
    sample = dict((l, runs) for runs, l in langid.training_sample(df.where("lang = 'long'"), "lang", conf))["long"]
    assert len(sample) == conf.runs_per_doc and 0.4 < sample.count(b"omega") / len(sample) < 0.6


def test_edge_cases(spark):
    rows = [(i, "the and " * 9 if i % 2 else "und der " * 9, "en" if i % 2 else "de", [i]) for i in range(60)]
    rows += [(70, None, "en", []), (71, "", "en", []), (72, "12 !?", "de", []), (73, "the", None, []), (1, "the and", "en", [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score array<long>")
    conf = LangConf(steps=60)
    model = fit(df, conf=conf)
    got = predict(df, model, conf).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[70] == by[71] == by[72] == ("und", 0.0) and by[73][0] == "en" and by[2][0] == "de"
    kept = keep_known(df, model, conf)
    assert kept.schema == df.schema and kept.count() == len(rows) - 3
    assert fit(df.limit(0), conf=conf) is None
    assert {r["lang_pred"] for r in predict(df, None, conf).collect()} == {"und"}
    assert predict(df.limit(0), model, conf).collect() == []
