"""Toxicity by multiple-instance learning: sentence scores, noisy-or, document labels.

A sentence's score is a logistic function of the distinct known features in it
(words and beginnings of words); a document's is noisy-or, 1 - prod(1 - sentence score).  Only documents are
labelled: the gradient of the document's log-loss runs through the noisy-or to
the sentences, so weight gathers on the words of the sentences that explain the
label.  The fitted sentence scores then locate offending sentences.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan

#: A letter run, or what ends a sentence.
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]+")
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
ENDS = frozenset(".!?\n")


@dataclass(frozen=True)
class ToxicConf:
    max_docs: int = 4000     # of each label: bound of the sample that is fitted
    min_docs: int = 8        # of the sample that a word must occur in
    max_words: int = 50_000  # known features, the most frequent
    stems: tuple[int, ...] = (4, 6)     # lengths of word beginnings that are features beside whole words
    steps: int = 200
    rate: float = 0.08
    shrink: float = 2e-4     # L1, per step and unit rate
    bias: float = -6.0       # where the sentence bias starts
    seed: int = 11


@dataclass(frozen=True)
class ToxicModel:
    weights: dict[str, float]
    bias: float
    stems: tuple[int, ...]


def features(word: str, stems: tuple[int, ...]) -> list[str]:
    return [word, *[word[:k] + "-" for k in stems if len(word) > k]]


def sentences(text: str | None, stems: tuple[int, ...]) -> list[set[str]]:
    """The distinct features of each sentence that has any."""
    out, now = [], set()
    for t in TOKEN.findall((text or "").lower()):
        if t[0] in ENDS:
            if now:
                out.append(now)
                now = set()
        else:
            now.update(features(t, stems))
    return [*out, now] if now else out


def fit_sample(sample: list[tuple[str, int, float]], conf: ToxicConf = ToxicConf()) -> ToxicModel:
    """Fit (text, 0 or 1, weight) rows by full-batch Adam with a proximal L1 step on the feature weights."""
    count: dict[str, int] = {}
    for text, *_ in sample:
        for w in set().union(*sentences(text, conf.stems)):
            count[w] = count.get(w, 0) + 1
    known = sorted((w for w, c in count.items() if c >= conf.min_docs), key=lambda w: (-count[w], w))[:conf.max_words]
    at = {w: i for i, w in enumerate(known)}
    del count
    word, sent, doc_of = array("i"), array("i"), array("i")
    for d, (text, *_) in enumerate(sample):
        for s in sentences(text, conf.stems):
            ids = [at[w] for w in s if w in at]
            word.extend(ids)
            sent.extend([len(doc_of)] * len(ids))
            doc_of.append(d)
    word, sent, doc_of = (np.frombuffer(x, np.int32) if x else np.zeros(0, np.int32) for x in (word, sent, doc_of))
    y = np.array([v for _, v, _ in sample], float)
    share = np.array([w for *_, w in sample], float)
    share /= max(share.sum(), 1e-9)
    theta, bias = np.zeros(len(known)), conf.bias
    m, v, mb, vb = np.zeros(len(known)), np.zeros(len(known)), 0.0, 0.0
    for step in range(1, conf.steps + 1 if len(doc_of) else 1):
        s = bias + np.bincount(sent, theta[word], len(doc_of))
        clean = -np.bincount(doc_of, np.logaddexp(0, s), len(y))            # log(1 - p)
        p = -np.expm1(clean)
        # d loss / d sentence score: sigmoid(s) for label 0, -sigmoid(s) (1 - p) / p for label 1
        pull = np.where(y > 0, -np.exp(clean) / np.maximum(p, 1e-9), 1.0) * share
        g_s = pull[doc_of] / (1 + np.exp(-s))
        g, gb = np.bincount(word, g_s[sent], len(known)), g_s.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        scale = conf.rate / (np.sqrt(v / c2) + 1e-8)
        theta = theta - scale * (m / c1)
        theta = np.sign(theta) * np.maximum(np.abs(theta) - scale * conf.shrink, 0)
        bias -= conf.rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    keep = np.flatnonzero(np.abs(theta) > 1e-3)
    return ToxicModel({known[i]: float(theta[i]) for i in keep}, float(bias), conf.stems)


def training_sample(docs: DataFrame, labels: DataFrame, conf: ToxicConf = ToxicConf()) -> list[tuple[str, int, float]]:
    """At most ``max_docs`` rows of each label of ``docs(doc_id, text)`` with ``labels(doc_id, label)``, by hash of the id.

    A row weighs as many labelled rows as it stands for.  Ids are chosen
    without their texts; the texts of the chosen ids (a bounded list) are then
    picked up in one scan.
    """
    order = F.pmod(F.xxhash64("doc_id", F.lit(conf.seed)), F.lit(1 << 30))
    known = docs.select("doc_id").join(labels.where("label in (0, 1)").distinct(), "doc_id")
    out = []
    for label, n in sorted(known.groupBy(F.col("label").cast("int")).count().collect()):
        near = known.where((F.col("label") == label)
                           & (order < int(min(1.0, 1.2 * conf.max_docs / n + 0.001) * (1 << 30))))
        chosen = near.select("doc_id").distinct().orderBy(order, "doc_id").limit(conf.max_docs)
        rows = (docs.join(F.broadcast(chosen), "doc_id")
                .select(F.coalesce("text", F.lit("")).alias("text"), order.alias("o"), "doc_id")
                .orderBy("o", "doc_id", "text").limit(conf.max_docs).collect())
        out += [(r["text"], label, n / len(rows)) for r in rows]
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", conf: ToxicConf = ToxicConf()) -> ToxicModel:
    """Fit ``docs(doc_id, text)`` with ``labels(doc_id, label)``.

    Null and empty texts count as documents without sentences; labels other
    than 0 and 1 and unlabelled documents are not used.  Without any labelled
    row the model has no features, and the bias it starts with.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return fit_sample(training_sample(docs, labels.select("doc_id", F.col(label).alias("label")), conf), conf)


def _known(word: str, model: ToxicModel) -> list[str]:
    """The model's features of a word."""
    weights = model.weights
    return [f for f in features(word, model.stems) if f in weights]


def score_text(text: str | None, model: ToxicModel, memo: dict[str, tuple[str, ...]] | None = None) -> float:
    """Noisy-or over the sentences of the whole text; a text without words scores 0.

    ``memo`` holds the known features of words met before (bounded).
    """
    memo = {} if memo is None else memo
    if len(memo) > 300_000:
        memo.clear()
    base = float(np.logaddexp(0, model.bias))
    total, plain, now, words = 0.0, 0, set(), False
    for t in [*TOKEN.findall((text or "").lower()), "."]:
        got = memo.get(t)
        if got is None:
            if t[0] in ENDS:
                if now:
                    total += float(np.logaddexp(0, model.bias + sum(map(model.weights.__getitem__, now))))
                    now = set()
                else:
                    plain += words
                words = False
                continue
            got = memo[t] = tuple(_known(t, model))
        words = True
        if got:
            now.update(got)
    return float(-np.expm1(-(total + plain * base)))


def locate(text: str | None, model: ToxicModel, least: float = 0.5) -> list[dict]:
    """Sentences (character ``start``, ``stop``, ``score``) that score at least ``least``."""
    out = []
    for m in SENTENCE.finditer(text or ""):
        known = {f for w in TOKEN.findall(m.group().lower()) for f in _known(w, model)}
        s = model.bias + sum(model.weights[f] for f in known)
        p = 1 / (1 + np.exp(-s))
        if known and p >= least:
            out.append({"start": m.start(), "stop": m.end(), "score": float(p)})
    return out


def score(docs: DataFrame, model: ToxicModel, least: float = 0.5) -> DataFrame:
    """(doc_id, score, offending) of every row of ``docs(doc_id, text)``.

    Null and empty texts score 0 and offend nowhere.  Repeated rows each get a
    row; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)      # at most max_words weights

    def rows(it):
        memo: dict = {}
        for doc_id, text in it:
            p = score_text(text, held.value, memo)
            yield doc_id, p, locate(text, held.value, least) if p >= least else []
    return scan(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                "doc_id long, score double, offending array<struct<start:long,stop:long,score:double>>", rows)
