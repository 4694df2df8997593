"""Quality rules: word and line rules, and compression bands over whole texts and fixed chunks.

A zstandard ratio (bytes in, over bytes out) tells two kinds of junk that
word counts miss: repetitive text compresses far too well, encoded or random
text hardly at all.  What is usual depends on length, as a short text gives
the compressor little to refer to, so each length class has its own band.
The whole text is held to the band of its length; its chunks of a fixed size
are held to theirs, which finds junk inside an otherwise usual text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, rewrite, scan, word_codes

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio by length, and of the share of a text that lies in chunks outside their limits.

    ``limits`` are (bytes at least, lowest ratio, highest ratio).  Prose gives
    about 1.1 to 1.6 at 200 bytes and 2 to 4 from a few thousand on in any
    script; base64 stays near 1.3 at any length and random bytes at 1; a text
    that says one thing over and over passes 6 from a few hundred bytes on.
    """
    limits: tuple[tuple[int, float, float], ...] = (
        (64, 0.75, 3.0), (256, 1.10, 4.0), (1024, 1.40, 5.0), (4096, 1.45, 6.0), (32768, 1.45, 8.0))
    chunk_bytes: int = 4096
    chunk_limits: tuple[float, float] = (1.45, 6.0)
    max_bad_share: float = 0.3
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


VERDICT = "ratio double, bad_share double, reason string"
SCORES = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          f"base_failed boolean, kept boolean, {VERDICT}")


class Judge:
    """The verdict of ``bands`` on texts: (ratio, share in bad chunks, reason or None)."""

    def __init__(self, bands: Bands) -> None:
        import zstandard
        self.bands = bands
        self.size = lambda data: len(zstandard.ZstdCompressor(level=bands.level).compress(data))

    def __call__(self, text: str | None) -> tuple[float | None, float, str | None]:
        data, bands = (text or "").encode(), self.bands
        if not data:
            return None, 0.0, None
        ratio, reason, share = len(data) / self.size(data), None, 0.0
        band = [x for x in bands.limits if len(data) >= x[0]]
        if band and ratio < band[-1][1]:
            reason = "incompressible"
        elif band and ratio > band[-1][2]:
            reason = "repetitive"
        if len(data) > bands.chunk_bytes:
            low, high = bands.chunk_limits
            # whole chunks; what remains at the end is part of the last one
            edges = [*range(0, len(data) - bands.chunk_bytes + 1, bands.chunk_bytes), len(data)]
            bad = 0
            for a, b in zip(edges, edges[1:]):
                bad += (b - a) * (not low <= (b - a) / self.size(data[a:b]) <= high)
            share = bad / len(data)
            if share > bands.max_bad_share:
                reason = reason or "chunks"
        return ratio, share, reason


def scores(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Rule counts and verdict of every row of ``docs(doc_id, text)``; ``reason`` is null where a text is kept.

    Words are runs of anything but ASCII white space.  ``n_dup_lines`` counts
    lines with a word that equal an earlier line; ``n_repeat_words`` the words
    in three-word windows found twice or more in the text.  Null and empty
    texts have no words and fail (`few words`).  Every row is judged by
    itself: repeated ids give repeated rows.  Other columns are not read.
    """
    def rows(it):
        judge = Judge(bands)
        for some in groups(it):
            texts = [t or "" for _, t in some]
            for (doc_id, _), text, (n, rep) in zip(some, texts, repeats(texts)):
                reason = base_reason(n, rep, bands)
                ratio, share, verdict = judge(text)
                yield (doc_id, n, len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), duplicate_lines(text), rep,
                       reason is not None, reason is None and verdict is None, ratio, share, reason or verdict)

    return scan(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), SCORES, rows)


def keep(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that ``scores`` keeps, with all their columns."""
    def fn(texts):
        judge = Judge(bands)
        known = repeats([t or "" for t in texts])
        return [(t,) if base_reason(n, rep, bands) is None and judge(t)[2] is None else None for t, (n, rep) in zip(texts, known)]

    return rewrite(docs, "text", fn)


def base_reason(n_words: int, n_repeat: int, bands: Bands) -> str | None:
    if n_words < bands.min_words:
        return "few words"
    return "repeated words" if 100 * n_repeat > bands.max_repeat_percent * n_words else None


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(SPACE):
            seen.add(line)
    return n


def repeats(texts: list[str]) -> list[tuple[int, int]]:
    """(words, words in three-word windows that occur twice or more) of each text."""
    index, ends, words = word_codes(texts)
    index = index.astype(np.int64)
    blank = words.index("") if "" in words else -1
    base, out = len(words) + 1, []
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        w = index[a:b]
        if b > a and blank in (w[0], w[-1]):         # white space at an end of the text
            w = w[w != blank]
        if len(w) < 4:
            out.append((len(w), 0))
            continue
        two = w[:-1] * base + w[1:]
        if base >= 1 << 21:                          # three codes do not fit a long: number the pairs first
            two = np.unique(two, return_inverse=True)[1]
        _, at, n = np.unique(two[:-1] * base + w[2:], return_inverse=True, return_counts=True)
        again = n[at] > 1
        hit = np.zeros(len(w), bool)
        for k in range(3):
            hit[k:len(w) - 2 + k] |= again
        out.append((len(w), int(hit.sum())))
    return out
