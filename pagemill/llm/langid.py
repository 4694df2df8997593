"""Language ID: a bidirectional gated recurrent network over bytes, written and trained in numpy.

A text's letter runs (lower-cased, UTF-8) are byte sequences.  Forward and
backward recurrent states label every byte with language probabilities; a
document's probability is the mean over its labelled bytes.  Training is
backpropagation through time with Adam on a bounded sample of labelled rows.
A run's labels depend on the run alone, so each task remembers the sums of
runs it has met.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, rewrite, scan, word_codes, worker_cache

LETTERS = re.compile(r"[^\W\d_]+")
PIECE = 32               # bytes; longer runs are labelled in pieces
UNKNOWN = "und"


@dataclass(frozen=True)
class LangConf:
    docs_per_lang: int = 200      # bound of the training sample
    runs_per_doc: int = 3_000     # drawn by hash from its whole texts; texts to be labelled are always whole
    runs: int = 6_000_000         # of all languages: beyond ten, each text gives fewer (16 at least)
    hidden: int = 16
    steps: int = 700
    batch: int = 256
    rate: float = 0.01
    seed: int = 7
    memo: int = 300_000           # words that a task remembers


class Gru:
    """Parameters of one model; ``probs`` labels, ``train`` fits."""

    def __init__(self, langs: list[str], hidden: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.langs, self.h = langs, hidden
        n, k = hidden, len(langs)
        p = {"out": rng.normal(0, 0.3, (2 * n, k)), "bias": np.zeros(k)}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.5, (256, 3 * n))      # one row per byte: the input weights
            p[f"u{d}"] = rng.normal(0, n ** -0.5, (n, 2 * n))  # update and reset gates
            p[f"c{d}"] = rng.normal(0, n ** -0.5, (n, n))      # candidate
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def _run(self, d: str, x: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States of direction ``d`` over byte columns ``x`` (rows, time), in time order of ``x``."""
        n, p = self.h, self.p
        h = np.zeros((len(x), n), np.float32)
        out = np.empty((x.shape[1], len(x), n), np.float32)
        for t in range(x.shape[1]):
            a = p[f"x{d}"][x[:, t]]
            g = _sigmoid(a[:, :2 * n] + h @ p[f"u{d}"])
            z, r = g[:, :n], g[:, n:]
            c = np.tanh(a[:, 2 * n:] + (r * h) @ p[f"c{d}"])
            if tape is not None:
                tape.append((x[:, t], h, z, r, c))
            h = h + z * (c - h)
            out[t] = h
        return out

    def probs(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of every byte: (time, rows, languages).  All rows of ``x`` are full."""
        both = np.concatenate([self._run("f", x), self._run("b", x[:, ::-1])[::-1]], axis=2)
        return _softmax(both @ self.p["out"] + self.p["bias"])

    def _grads(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, p = self.h, self.p
        tapes = {"f": [], "b": []}
        states = {"f": self._run("f", x, tapes["f"]), "b": self._run("b", x[:, ::-1], tapes["b"])[::-1]}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        err = _softmax(both @ p["out"] + p["bias"])
        err[:, np.arange(len(y)), y] -= 1
        err /= err.shape[0] * err.shape[1]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"] = np.einsum("trs,trk->sk", both, err, optimize=True)
        g["bias"] = err.sum((0, 1))
        back = err @ p["out"].T
        for d, own in (("f", back[:, :, :n]), ("b", back[::-1, :, n:])):
            dh = np.zeros((len(x), n), np.float32)
            for t in range(len(tapes[d]) - 1, -1, -1):
                byte, h, z, r, c = tapes[d][t]
                dh = dh + own[t]
                dc = dh * z * (1 - c * c)
                drh = dc @ p[f"c{d}"].T
                dg = np.concatenate([dh * (c - h) * z * (1 - z), drh * h * r * (1 - r)], axis=1)
                np.add.at(g[f"x{d}"], byte, np.concatenate([dg, dc], axis=1))
                g[f"u{d}"] += h.T @ dg
                g[f"c{d}"] += (r * h).T @ dc
                dh = dh * (1 - z) + drh * r + dg @ p[f"u{d}"].T
        return g

    def train(self, runs: list[bytes], labels: np.ndarray, conf: LangConf) -> None:
        """Adam over batches of equally long pieces (no padding, so every byte counts)."""
        rng = np.random.default_rng(conf.seed)
        by_len: dict[int, list[int]] = {}
        for i, r in enumerate(runs):
            by_len.setdefault(len(r), []).append(i)
        lens = sorted(by_len)
        share = np.array([len(by_len[n]) * n for n in lens], float)
        share /= share.sum()
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, conf.steps + 1):
            of = by_len[lens[rng.choice(len(lens), p=share)]]
            pick = [of[i] for i in rng.integers(0, len(of), conf.batch)]
            x = np.frombuffer(b"".join(runs[i] for i in pick), np.uint8).reshape(len(pick), -1)
            rate = conf.rate * min(1.0, 2 * (1 - (step - 1) / conf.steps))
            for k, g in self._grads(x, labels[pick]).items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** step))
                             / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * a) + 1)


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def pieces(run: str) -> list[bytes]:
    raw = run.encode("utf-8", "surrogatepass")
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


class Labeller:
    """Document probabilities by one model, with the label sums of words met before."""

    def __init__(self, model: Gru, memo: int) -> None:
        self.model, self.room = model, memo
        self.memo: dict[str, int] = {}
        self.sums = np.zeros((0, len(model.langs) + 1), np.float32)     # label sums and labelled bytes

    def _learn(self, words: list[str]) -> np.ndarray:
        """Rows of ``sums`` of new words: labels of their letter runs, added up."""
        sums = np.zeros((len(words), len(self.model.langs) + 1), np.float32)
        by_len: dict[int, tuple[list[int], list[bytes]]] = {}
        for i, w in enumerate(words):
            for run in LETTERS.findall(w):
                for p in pieces(run):
                    at, found = by_len.setdefault(len(p), ([], []))
                    at.append(i)
                    found.append(p)
        for n, (at, found) in by_len.items():
            for a in range(0, len(found), 4096):
                x = np.frombuffer(b"".join(found[a:a + 4096]), np.uint8).reshape(-1, n)
                labels = self.model.probs(x).sum(0)
                np.add.at(sums, at[a:a + 4096], np.concatenate([labels, np.full((len(x), 1), n, np.float32)], axis=1))
        return sums

    def probs(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Mean label of each text's letter bytes; None without a letter."""
        index, ends, words = word_codes([(t or "").lower() for t in texts])
        if len(self.memo) + len(words) > self.room:
            self.memo, self.sums = {}, self.sums[:0]
        new = [w for w in words if w not in self.memo]
        if new:
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new))))
            self.sums = np.concatenate([self.sums, self._learn(new)])
        row = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        out, a = [], 0
        for b in ends.tolist():
            total = self.sums[row[index[a:b]]].sum(0, dtype=np.float64)
            out.append(total[:-1] / total[-1] if total[-1] else None)
            a = b
        return out


def _labeller(held, memo: int) -> Labeller:
    cache, (key, model) = worker_cache("langid"), held.value
    if key not in cache:
        cache.clear()
        cache[key] = Labeller(model, memo)
    return cache[key]


def draw(text: str, n: int, seed: tuple[int, ...]) -> list[bytes]:
    """The pieces of a text's letter runs, or ``n`` of them, drawn from the whole text, in its order."""
    text = text.lower()
    total = sum(len(pieces(m.group())) for m in LETTERS.finditer(text))
    found = (p for m in LETTERS.finditer(text) for p in pieces(m.group()))
    if total <= n:
        return list(found)
    taken = set(np.random.default_rng(seed).choice(total, n, replace=False).tolist())
    return [p for i, p in enumerate(found) if i in taken]


def training_sample(docs: DataFrame, lang: str, conf: LangConf) -> list[tuple[list[bytes], str]]:
    """(pieces, lang) of at most ``docs_per_lang`` rows of every language, by hash order."""
    known = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select(
        F.col(lang).cast("string").alias("l"), F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64("doc_id", F.lit(conf.seed)), F.lit(1 << 30)).alias("o"), F.col("doc_id").cast("long").alias("doc_id"))
    counts = known.groupBy("l").agg(F.count("*").alias("n")).select(
        "l", F.least(F.lit(1.0), 2 * conf.docs_per_lang / F.col("n") + 0.001).alias("part"))
    n_langs = counts.count()
    if not n_langs:
        return []
    n = min(conf.runs_per_doc, max(16, conf.runs // (conf.docs_per_lang * n_langs)))
    near = known.join(F.broadcast(counts), "l").where(F.col("o") < (F.col("part") * (1 << 30)).cast("long")).select("l", "o", "doc_id", "text")

    def drawn(it):
        for l, o, doc_id, text in it:
            yield l, o, doc_id, b" ".join(draw(text, n, (conf.seed, o)))
    w = Window.partitionBy("l").orderBy("o", "doc_id", "runs")
    rows = scan(near, "l string, o long, doc_id long, runs binary", drawn).withColumn("n", F.row_number().over(w)).where(
        F.col("n") <= conf.docs_per_lang).select("l", "runs").collect()
    return [(runs.split(), l) for runs, l in sorted((bytes(r["runs"]), r["l"]) for r in rows)]


def fit(docs: DataFrame, lang: str = "lang", conf: LangConf = LangConf()) -> Gru | None:
    """Train on ``docs(doc_id, text, lang)``; None where no row has a language and a letter."""
    sample = training_sample(docs, lang, conf)
    langs = sorted({l for runs, l in sample if runs})
    if not langs:
        return None
    at = {l: k for k, l in enumerate(langs)}
    runs, labels = [], []
    for words, l in sample:
        runs += words
        if words:
            labels += [at[l]] * len(words)
    model = Gru(langs, conf.hidden, conf.seed)
    y = np.array(labels)
    # each language has the same weight, however much of it the sample holds
    rng = np.random.default_rng(conf.seed)
    per = min(60_000, max(np.bincount(y)), max(100, conf.runs // len(langs)))
    even = np.concatenate([rng.choice(np.flatnonzero(y == k), per) for k in range(len(langs)) if (y == k).any()])
    model.train([runs[i] for i in even], y[even], conf)
    return model


def predict(docs: DataFrame, model: Gru | None, conf: LangConf = LangConf()) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs(doc_id, text)``.

    ``und`` and 0.0 for a null text, one without a letter, or without a model.
    Repeated rows each get a row; other columns are not read.
    """
    label = _label_rows(docs.sparkSession, model, conf)

    def rows(it):
        for some in groups(it):
            for (doc_id, _), (lang, score) in zip(some, label([t for _, t in some])):
                yield doc_id, lang, score
    return scan(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                "doc_id long, lang_pred string, score double", rows, cache="langid")


def keep_known(docs: DataFrame, model: Gru | None, conf: LangConf = LangConf(), least: float = 0.0) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is known and scores at least ``least``."""
    label = _label_rows(docs.sparkSession, model, conf)

    def keep(texts):
        return [(t,) if lang != UNKNOWN and score >= least else None for t, (lang, score) in zip(texts, label(texts))]
    return rewrite(docs, "text", keep, cache="langid")


def _label_rows(spark, model: Gru | None, conf: LangConf):
    import uuid
    held = spark.sparkContext.broadcast((uuid.uuid4().hex, model))     # a few hundred kB
    memo = conf.memo

    def label(texts):
        if held.value[1] is None:
            return [(UNKNOWN, 0.0)] * len(texts)
        found = _labeller(held, memo).probs(texts)
        langs = held.value[1].langs
        return [(UNKNOWN, 0.0) if p is None else (langs[int(p.argmax())], float(min(1.0, p.max()))) for p in found]
    return label
