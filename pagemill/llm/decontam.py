"""Benchmark decontamination: broadcast hash set of item n-grams, scan, verify, remove.

Item words are numbered; a window (n consecutive item words, or a whole
shorter item) becomes a 64-bit hash of its word numbers.  A document's words
are looked up in the numbering (anything else breaks a run), the rolling hash
of each run is tested against the set, and hits are verified word by word.
The test set is broadcast only in parts of a measured, bounded size; a larger
one takes one scan of the documents for each part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, rewrite, scan

#: UTF-8 bytes of item text whose word numbering and windows go to the executors at once: in a task some 15 bytes for
#: each byte of text at most (every word another one), about 5 in prose.
PART_BYTES = 8 << 20

# A-Z to a-z; 0-9, a-z and every byte of a non-ASCII character stay; the rest separates
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


class NgramSet:
    """Windows of one part of the test set, in the form that tasks search: packed arrays beside the word numbering.

    The words of all items stand in one array of numbers; a window is its
    place there, and the places of one size are sorted by hash.
    """

    def __init__(self, items: list[tuple[object, str]], n: int = 10) -> None:
        self.vocab: dict[bytes, int] = {}
        vocab, flat, starts = self.vocab, [], [0]
        for _, text in items:
            flat += [vocab.setdefault(w, len(vocab) + 1) for w in words(text)]
            starts.append(len(flat))
        self.items = [item for item, _ in items]
        self.flat, self.starts = np.array(flat, np.int32), np.array(starts, np.int64)
        size = np.diff(self.starts)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in sorted({*np.unique(size[(size > 0) & (size < n)]).tolist(), *([n] if (size >= n).any() else [])}):
            own = np.flatnonzero(size >= n if k == n else size == k)
            count = size[own] - k + 1
            at = np.repeat(self.starts[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            h = _rolling(self.flat.astype(np.uint64), k)[at]
            order = np.argsort(h, kind="stable")
            self.by_size[k] = h[order], at[order].astype(np.int32)

    def hits(self, doc: list[bytes]) -> Iterator[tuple[int, int, frozenset]]:
        """(first word, words, items) of every verified window in ``doc``."""
        if not self.by_size or not doc:
            return
        get = self.vocab.get
        ids = np.fromiter((get(w, 0) for w in doc), np.int32, len(doc))
        gaps = np.concatenate(([0], np.cumsum(ids == 0)))
        for size, (hashes, places) in self.by_size.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(gaps[size:] == gaps[:-size])
            if not len(at):
                continue
            h = _rolling(ids.astype(np.uint64), size)[at]
            first = np.searchsorted(hashes, h)
            near = first.copy()
            near[near == len(hashes)] = 0
            hit = np.flatnonzero(hashes[near] == h)
            stop = np.searchsorted(hashes, h[hit], side="right")
            for k, a, b in zip(at[hit].tolist(), first[hit].tolist(), stop.tolist()):
                same = self.flat[places[a:b, None] + np.arange(size)] == ids[k:k + size]
                found = places[a:b][same.all(axis=1)]
                if len(found):
                    yield k, size, frozenset(self.items[i] for i in np.searchsorted(self.starts, found, side="right") - 1)


def _rolling(ids: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(ids) - size + 1, np.uint64)
    for j in range(size):
        out = out * np.uint64(_BASE) + ids[j:len(ids) - size + 1 + j]
    return out


def test_parts(benchmark: DataFrame, n: int = 10, part_bytes: int = PART_BYTES) -> Iterator[NgramSet]:
    """The test set in parts of about ``part_bytes`` of text, one on the driver at a time.

    Rows without item_id or words hold no windows.  Items are dealt by hash;
    one item larger than a part makes a part of its own.
    """
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text")).where(
        "item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for i in range(parts):
        rows = items.where(part == i).distinct().collect()   # about part_bytes
        yield NgramSet([(r["item_id"], r["text"]) for r in rows], n)


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs(doc_id, text)``.

    ``spans``: merged runs of hit words, ``start`` and ``stop`` in word
    positions; ``items``: ids (as strings, sorted, distinct) of the items with
    windows in the text.  Null and empty texts have no words and no hits.
    Repeated rows each get a row; other columns are not read.
    """
    shape = "spans array<struct<start:long,stop:long>>, items array<string>"
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = out.selectExpr("doc_id", "text", "cast(array() as array<struct<start:long,stop:long>>) spans",
                         "cast(array() as array<string>) items")
    parts = list_ahead(test_parts(benchmark, n, part_bytes))
    for part, last in parts:
        held = docs.sparkSession.sparkContext.broadcast(part)
        if last:
            return scan(out, f"doc_id long, n_words long, {shape}", _reporter(held, False))
        out = cut(scan(out, f"doc_id long, text string, {shape}", _reporter(held, True)))
        held.destroy()


def list_ahead(it):
    """Each element with whether it is the last."""
    it = iter(it)
    now = next(it)
    for after in it:
        yield now, False
        now = after
    yield now, True


def _reporter(held, more: bool):
    def rows(it):
        for doc_id, text, spans, items in it:
            doc = words(text)
            hit, found = np.zeros(len(doc) + 2, np.int8), set(items)
            for s in spans:
                hit[s["start"] + 1:s["stop"] + 1] = 1
            for at, size, ids in held.value.hits(doc):
                hit[at + 1:at + size + 1] = 1
                found.update(map(str, ids))
            edge = np.flatnonzero(np.diff(hit)).tolist()
            runs = [{"start": a, "stop": b} for a, b in zip(edge[::2], edge[1::2])]
            yield doc_id, text if more else len(doc), runs, sorted(found)
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents",
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    ``remove="documents"`` drops every row with a hit word; ``"spans"`` cuts
    the hit words out of the text (from the first one's start to the last
    one's end).  Null and empty texts stay as they are.  A test set of several
    parts takes one scan for each; what the scan before left is cut, and its
    part is let go.
    """
    for part, last in list_ahead(test_parts(benchmark, n, part_bytes)):
        held = docs.sparkSession.sparkContext.broadcast(part)
        docs = rewrite(docs, "text", _dropper(held) if remove == "documents" else _cutter(held))
        if not last:
            docs = cut(docs)
            held.destroy()
    return docs


def _dropper(held):
    return lambda texts: [None if next(held.value.hits(words(t)), None) else (t,) for t in texts]


def _cutter(held):
    def cut_spans(text):
        if not text:
            return (text,)
        raw = text.encode("utf-8", "surrogatepass")
        spaced = raw.translate(_WORD)
        doc = spaced.split()
        hit = np.zeros(len(doc) + 2, np.int8)
        for at, size, _ in held.value.hits(doc):
            hit[at + 1:at + size + 1] = 1
        edge = np.flatnonzero(np.diff(hit)).tolist()
        if not edge:
            return (text,)
        at = [m.span() for m in re.finditer(rb"[^ ]+", spaced)]
        keep, here = [], 0
        for a, b in zip(edge[::2], edge[1::2]):
            keep.append(raw[here:at[a][0]])
            here = at[b - 1][1]
        return (b"".join([*keep, raw[here:]]).decode("utf-8", "surrogatepass"),)
    return lambda texts: list(map(cut_spans, texts))
