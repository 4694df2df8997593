"""Exact removal of long repeats with a logarithmic family of sparse suffix arrays.

Texts are dealt into groups (the batches).  A window is ``min_len`` bytes; its
*seed* is the ``SEED``-byte substring of it with the least hash, the leftmost
of equals, so equal windows have equal seeds at equal places.  Consecutive
windows with one seed make a run: the bytes they cover, and in them the place
of the seed.  There are about ``2 / (min_len - SEED)`` runs per byte.

1. *Filter.*  The hashes of all seeds, cut into hash ranges.  A range takes the
   batches one by one: each is merge-scanned against the levels present, then
   becomes a level, and levels of like size merge (`Levels`).  What goes back to
   a batch is one bit for each of its seeds: does it occur elsewhere.
2. *Suffix arrays*, of the suffixes that begin at such seeds.  A batch's are
   sorted by their bytes, dealt into the seeds' ranges, merge-scanned against
   the family of levels there, and levels of like size merge (`Suffixes`).
   Neighbours that begin with one seed are then compared byte by byte, to both
   sides of the seed, and a bit for every window goes back: is it elsewhere.

Hashes choose what is compared and decide nothing: bytes are removed only
where the bytes of two windows are the same.  A string that a third of all
documents share occurs once per batch in a range, never once per document.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan

SEED = 64                  # bytes of the sampled substrings
GROUP_BYTES = 4 << 20      # text of a group, on average; a longer document makes a longer group
RANGE_BYTES = 8 << 20      # text for each hash range
PIECE = 1 << 18            # bytes hashed at a time
FEW = 12                   # neighbours compared in pairs; more are met by their windows

_BASE = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled:filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    return out


class Hasher:
    """Hashes of all windows of a buffer, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, min_len: int) -> None:
        if min_len <= SEED:
            raise ValueError(f"min_len must be over {SEED}")
        self.min_len = min_len
        n = PIECE + min_len + 1
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text number, window start in it, buffer bytes) of pieces that cover all windows once."""
        step, over = PIECE - self.min_len, self.min_len - 1
        part, size = [], 0
        for k, t in enumerate(texts):
            for a in range(0, len(t) - over, step):
                piece = t[a:a + step + over]
                if size + len(piece) > PIECE and part:
                    yield self._join(part)
                    part, size = [], 0
                part.append((k, a, piece))
                size += len(piece)
        if part:
            yield self._join(part)

    def _join(self, part):
        data = np.frombuffer(b"".join(p for *_, p in part), np.uint8)
        n = np.array([len(p) for *_, p in part])
        first = np.cumsum(n) - n
        windows = n - self.min_len + 1
        text = np.repeat([k for k, *_ in part], windows)
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        start = inside + np.repeat([a for _, a, _ in part], windows)
        return text, start, (data, inside + np.repeat(first, windows))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[:len(data)], out=out[1:])
        return out

    def seeds(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the seed of each window starting at ``at``, and the hashes of all substrings of a seed's length."""
        prefix = self.prefix(data)
        n = len(prefix) - 1 - SEED + 1
        h = _mix((prefix[SEED:] - prefix[:n]) * self.down[:n])
        # least hash first, then leftmost place: both in one number
        low, size = (h & ~_PLACE) | np.arange(n, dtype=np.uint64), 1
        wide = self.min_len - SEED + 1
        while size * 2 <= wide:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < wide:
            low = np.minimum(low[:len(low) - (wide - size)], low[wide - size:])
        return (low[at] & _PLACE).astype(np.int64), h

    def runs(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(text number, first window, windows, place of the seed in the text, hash of the seed) of the runs of a buffer."""
        for text, start, (data, at) in self.pieces(texts):
            seed, h = self.seeds(data, at)
            new = np.flatnonzero(np.concatenate(([True], (seed[1:] != seed[:-1]) | (at[1:] != at[:-1] + 1))))
            n = np.diff(np.concatenate((new, [len(at)])))
            # seeds have small hashes: times an odd number, they spread over the ranges and stay distinct
            yield text[new], start[new], n, start[new] + seed[new] - at[new], h[seed[new]] * _SPREAD


_PLACE = np.uint64(PIECE - 1)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Levels:
    """A family of sorted hash arrays; levels of like size merge, each hash is kept once."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []      # hashes, entry numbers
        self.matched = np.zeros(0, bool)                          # of all entries so far

    def add(self, hashes: np.ndarray) -> None:
        """A batch: strictly ascending hashes."""
        first = len(self.matched)
        self.matched = np.concatenate([self.matched, np.zeros(len(hashes), bool)])
        own = np.arange(first, first + len(hashes))
        fresh = np.ones(len(hashes), bool)
        for keys, entries in self.levels:                          # merge-scan
            at = np.searchsorted(keys, hashes)
            at[at == len(keys)] = 0
            same = keys[at] == hashes
            self.matched[own[same]] = True
            self.matched[entries[at[same]]] = True
            fresh &= ~same
        if fresh.any():
            self.levels.append((hashes[fresh], own[fresh]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            keys, entries = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(keys, kind="stable")
            self.levels.append((keys[order], entries[order]))


class Suffixes:
    """A family of sorted suffix lists: (bytes from the seed on, bytes before it), each kept once with a number.

    A batch is merge-scanned against every level; what is new becomes a level,
    and levels of like size merge, so an entry is moved a logarithmic number
    of times.
    """

    def __init__(self, min_len: int) -> None:
        self.min_len = min_len
        self.levels: list[list[tuple[bytes, bytes, int]]] = []
        self.often: list[bool] = []                                # by number: more than one place

    def add(self, batch: list[tuple[bytes, bytes, bool]]) -> list[int]:
        """Numbers of a batch's entries (suffix, left, several places in the batch), which differ from one another."""
        numbers = [-1] * len(batch)
        order = sorted(range(len(batch)), key=lambda k: batch[k][:2])
        for level in self.levels:
            at = 0
            for k in order:
                if numbers[k] < 0:
                    key = batch[k][:2]
                    at = bisect_left(level, key, at)
                    if at < len(level) and level[at][:2] == key:
                        numbers[k] = level[at][2]
                        self.often[numbers[k]] = True
        fresh = []
        for k in order:
            if numbers[k] < 0:
                numbers[k] = len(self.often)
                self.often.append(batch[k][2])
                fresh.append((*batch[k][:2], numbers[k]))
        if fresh:
            self.levels.append(fresh)
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(sorted(b + a))                       # two sorted runs: a merge
        return numbers

    def matches(self) -> list[np.ndarray]:
        """By number: for every window of the entry, whether its bytes are at another place too."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(self.often)
        len_left = [0] * len(self.often)
        whole = sorted(chain.from_iterable(self.levels))
        for _, some in groupby(whole, key=lambda e: e[0][:SEED]):   # neighbours that begin with one seed
            some = list(some)
            n = [len(suffix) + len(left) - self.min_len + 1 for suffix, left, _ in some]
            if len(some) == 1:
                out[some[0][2]] = np.full(n[0], self.often[some[0][2]])
                continue
            for (*_, k), m in zip(some, n):
                out[k] = np.full(m, self.often[k])
            for _, left, k in some:
                len_left[k] = len(left)
            if len(some) <= FEW:
                self._pairs(some, n, out)
                continue
            # windows by the place of the seed in them: equal windows have it at one place
            for j in range(max(len(left) for _, left, _ in some) + 1):
                found: dict[bytes, int] = {}
                for (suffix, left, k), m in zip(some, n):
                    i = len(left) - j
                    if 0 <= i < m:
                        window = left[i:] + suffix[:self.min_len - j]
                        other = found.setdefault(window, k)
                        if other != k:
                            out[k][i] = True
                            out[other][len_left[other] - j] = True
        return out

    def _pairs(self, some: list[tuple[bytes, bytes, int]], n: list[int], out: list[np.ndarray]) -> None:
        """Two entries share the windows that lie within what they share before and from the seed on."""
        for x, (suffix, left, k) in enumerate(some):
            for y in range(x + 1, len(some)):
                suffix2, left2, k2 = some[y]
                right = _common(suffix, suffix2)
                before = _common(left[::-1], left2[::-1])
                first = max(0, self.min_len - right)                # the seed's places in shared windows: first..before
                for e, size, m in ((k, len(left), n[x]), (k2, len(left2), n[y])):
                    a, b = max(0, size - before), min(m, size - first + 1)
                    if a < b:
                        out[e][a:b] = True


def _common(a: bytes, b: bytes) -> int:
    """Length of the common start."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) >> 1
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


# -- tasks ------------------------------------------------------------------

def _pack(texts: list[tuple[bytes, int, bytes]]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(
        b"".join(sha + struct.pack("<QQ", n, len(t)) + t for sha, n, t in texts))


def _unpack(blobs: list[bytes]) -> list[tuple[bytes, int, bytes]]:
    """Distinct texts of a group with their copies, by digest."""
    found: dict[bytes, list] = {}
    for blob in blobs:
        raw, at = zstandard.ZstdDecompressor().decompress(blob), 0
        while at < len(raw):
            sha = raw[at:at + 32]
            n, size = struct.unpack_from("<QQ", raw, at + 32)
            if sha in found:
                found[sha][0] += n
            else:
                found[sha] = [n, raw[at + 48:at + 48 + size]]
            at += 48 + size
    return [(sha, *found[sha]) for sha in sorted(found)]


def _dealer(groups: int, min_len: int):
    """Texts into packed groups; copies within about 16 MB of a task's texts go once."""
    def flush(held):
        by_group: dict[int, list] = {}
        for sha, (n, t) in held.items():
            by_group.setdefault(int.from_bytes(sha[:8], "little") % groups, []).append((sha, n, t))
        for g, texts in by_group.items():
            yield g, _pack(texts)

    def rows(it):
        held, size = {}, 0
        for (text,) in it:
            raw = (text or "").encode("utf-8", "surrogatepass")
            if len(raw) < min_len:
                continue
            sha = hashlib.sha256(raw).digest()
            if sha in held:
                held[sha][0] += 1
                continue
            held[sha] = [1, raw]
            size += len(raw)
            if size >= 16 << 20:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)
    return rows


HASHES = "range int, grp int, hashes binary, own binary"
ENTRIES = "range int, grp int, n int, sizes binary, bytes binary"
REPEATS = "sha256 string, spans array<struct<start:long,stop:long>>, kept binary"
MATCHES = "grp int, range int, round int, n int, bits binary"


_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_ARROW = {HASHES: pa.schema([("range", pa.int32()), ("grp", pa.int32()), ("hashes", pa.binary()), ("own", pa.binary())]),
          ENTRIES: pa.schema([("range", pa.int32()), ("grp", pa.int32()), ("n", pa.int32()), ("sizes", pa.binary()), ("bytes", pa.binary())]),
          MATCHES: pa.schema([("grp", pa.int32()), ("range", pa.int32()), ("round", pa.int32()), ("n", pa.int32()), ("bits", pa.binary())]),
          REPEATS: pa.schema([("sha256", pa.string()), ("spans", pa.list_(_SPAN)), ("kept", pa.binary())])}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = _ARROW[schema]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields)], schema=fields)


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range of each hash; ranges rise with the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _stretches(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, first, stop) of the runs of a sorted array: no more than it has entries."""
    edge = [*np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))).tolist(), len(of)] if len(of) else []
    for a, b in zip(edge, edge[1:]):
        yield int(of[a]), a, b


def _sample(texts: list[bytes], hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Step 1 of a batch: sorted distinct hashes of its seeds, and which of them it has more than once."""
    found = [h for *_, h in hasher.runs(texts)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    keys, counts = np.unique(np.concatenate(found), return_counts=True)
    return keys, counts > 1


def _bits(replies: pa.Table, round_: int) -> dict[int, np.ndarray]:
    return {k: np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
            for k, r, n, bits in zip(*(replies.column(c).to_pylist() for c in ("range", "round", "n", "bits"))) if r == round_}


class _Batch:
    """Step 2 of a batch: the runs whose seed occurs elsewhere, and their distinct entries, dealt into ranges."""

    def __init__(self, texts: list[bytes], hasher: Hasher, replies: pa.Table, ranges: int) -> None:
        runs = [np.concatenate(x) for x in zip(*hasher.runs(texts))]
        self.runs: list[tuple[int, int, int]] = []              # text, first window, entry
        self.entries: list[list] = []                           # suffix, left, several places
        self.by_range: dict[int, list[int]] = {}
        if not runs:
            return
        text, first, n, seed, h = runs
        keys, bits, of = np.unique(h), _bits(replies, 1), {}
        hit = np.zeros(len(keys), bool)
        for k, a, b in _stretches(_range_of(keys, ranges)):
            if k in bits:
                hit[a:b] = bits[k]
        on = hit[np.searchsorted(keys, h)]
        length = hasher.min_len - 1
        for k, a, m, p, r in zip(*(x.tolist() for x in (text[on], first[on], n[on], seed[on], _range_of(h[on], ranges)))):
            t = texts[k]
            key = t[p:a + m + length], t[a:p]
            e = of.get(key)
            if e is None:
                e = of[key] = len(self.entries)
                self.entries.append([*key, False])
                self.by_range.setdefault(r, []).append(e)
            else:
                self.entries[e][2] = True
            self.runs.append((k, a, e))

    def rows(self, g: int) -> pa.RecordBatch:
        out = []
        for r, numbers in self.by_range.items():
            some = [self.entries[e] for e in numbers]
            sizes = np.array([(len(suffix), len(left), several) for suffix, left, several in some], "<i4")
            out.append((r, g, len(some), sizes.tobytes(), b"".join(left + suffix for suffix, left, _ in some)))
        return _batch(ENTRIES, out)

    def matched(self, replies: pa.Table, min_len: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, start) of every window whose bytes are elsewhere too."""
        masks: list[np.ndarray | None] = [None] * len(self.entries)
        for r, bits in _bits(replies, 2).items():
            at = 0
            for e in self.by_range[r]:
                n = len(self.entries[e][0]) + len(self.entries[e][1]) - min_len + 1
                masks[e] = bits[at:at + n]
                at += n
        texts, starts = [], []
        for k, a, e in self.runs:
            if masks[e] is not None:
                found = a + np.flatnonzero(masks[e])
                starts.append(found)
                texts.append(np.full(len(found), k))
        none = np.zeros(0, np.int64)
        return (np.concatenate(texts), np.concatenate(starts)) if starts else (none, none)


def _unpack_entries(n: int, sizes: bytes, data: bytes) -> list[tuple[bytes, bytes, bool]]:
    out, at = [], 0
    for suffix, left, several in np.frombuffer(sizes, "<i4").reshape(n, 3).tolist():
        out.append((data[at + left:at + left + suffix], data[at:at + left], bool(several)))
        at += left + suffix
    return out


def repeats(docs: DataFrame, min_len: int = 200) -> DataFrame:
    """(sha256, spans, kept) of the distinct texts of ``docs(text)`` that hold a repeat.

    A byte is removed where it is covered by a ``min_len``-byte string that
    starts anywhere else as well: in another row or at another place of the
    same one, overlaps included.  ``spans``: the maximal removed runs (byte
    ``start``, ``stop``); ``kept``: the other bytes, in order; ``sha256``: hex
    digest of the text's UTF-8.  Null texts are empty; shorter texts hold no repeat.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    dealt = scan(docs.select(F.col("text").cast("string")), "grp int, texts binary", _dealer(groups, min_len))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, g = [], None
        for b in batches:
            blobs += b.column("texts").to_pylist()
            g = b.column("grp")[0].as_py()
        keys, twice = _sample([t for *_, t in _unpack(blobs)], Hasher(min_len))
        yield _batch(HASHES, [(k, g, keys[a:b].tobytes(), np.packbits(twice[a:b]).tobytes())
                              for k, a, b in _stretches(_range_of(keys, ranges))])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, order = Levels(), []
        for b in batches:
            for k, g, hashes, own in zip(*(b.column(c).to_pylist() for c in ("range", "grp", "hashes", "own"))):
                h = np.frombuffer(hashes, "<u8")
                first = len(levels.matched)
                levels.add(h)
                order.append((g, k, first, len(h), np.unpackbits(np.frombuffer(own, np.uint8), count=len(h)).astype(bool)))
        rows = [(g, k, 1, n, levels.matched[a:a + n] | own) for g, k, a, n, own in order]
        yield _batch(MATCHES, [(*r[:4], np.packbits(r[4]).tobytes()) for r in rows if r[4].any()])

    def merge_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes, order = Suffixes(min_len), []
        for b in batches:
            for k, g, n, sizes, data in zip(*(b.column(c).to_pylist() for c in ("range", "grp", "n", "sizes", "bytes"))):
                order.append((g, k, suffixes.add(_unpack_entries(n, sizes, data))))
        masks = suffixes.matches()
        rows = [(g, k, 2, np.concatenate([masks[e] for e in numbers])) for g, k, numbers in order]
        yield _batch(MATCHES, [(*r[:3], len(r[3]), np.packbits(r[3]).tobytes()) for r in rows if r[3].any()])

    def held(left: pa.Table, right: pa.Table):
        texts = _unpack(left.column("texts").to_pylist())
        return texts, _Batch([t for *_, t in texts], Hasher(min_len), right, ranges)

    def suffixes(left: pa.Table, right: pa.Table) -> pa.Table:
        _, batch = held(left, right)
        g = left.column("grp")[0].as_py() if left.num_rows else 0
        return pa.Table.from_batches([batch.rows(g)])

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, batch = held(left, right)
        text, start = batch.matched(right, min_len)
        order = np.argsort(text, kind="stable")
        text, start = text[order], start[order]
        edge = np.searchsorted(text, np.arange(len(texts) + 1))
        out = []
        for k, (sha, n, t) in enumerate(texts):
            spans = [(0, len(t))] if n > 1 else _runs(start[edge[k]:edge[k + 1]], min_len)
            if spans:
                stops = [0, *(b for _, b in spans)]
                starts = [*(a for a, _ in spans), len(t)]
                out.append((sha.hex(), [{"start": a, "stop": b} for a, b in spans],
                            b"".join(t[a:b] for a, b in zip(stops, starts))))
        return pa.Table.from_batches([_batch(REPEATS, out)])

    by_group = dealt.groupBy("grp")
    # a range is much work for its bytes: tasks by the number of ranges, not by size
    first = by_group.applyInArrow(sample, HASHES).repartition(ranges, "range").groupBy("range").applyInArrow(merge, MATCHES)
    second = by_group.cogroup(first.groupBy("grp")).applyInArrow(suffixes, ENTRIES).repartition(ranges, "range").groupBy(
        "range").applyInArrow(merge_suffixes, MATCHES)
    return by_group.cogroup(first.unionByName(second).groupBy("grp")).applyInArrow(mark, REPEATS)


def _runs(starts: np.ndarray, min_len: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows at ``starts``."""
    if not len(starts):
        return []
    s = np.sort(starts)
    gap = np.flatnonzero(s[1:] > s[:-1] + min_len)
    return list(zip(s[np.concatenate(([0], gap + 1))].tolist(), (s[np.concatenate((gap, [len(s) - 1]))] + min_len).tolist()))


def report(docs: DataFrame, min_len: int = 200) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256) of every row of ``docs(doc_id, text)``; see `repeats`.

    Repeated rows each get a row (all their bytes are repeats, if long enough);
    a null text has no bytes; other columns are not read; an empty table gives
    no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = repeats(docs, min_len).select("sha256", "spans", F.sha2("kept", 256).alias("kept_sha256"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.sha2(text, 256).alias("sha256"))
    none = F.expr("cast(array() as array<struct<start:long,stop:long>>)")
    return rows.join(found, "sha256", "left").select(
        "doc_id", "n_bytes", F.coalesce("spans", none).alias("spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))
