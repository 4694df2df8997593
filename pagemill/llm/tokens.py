"""Token ids in directly addressable codes (DAC): chunk levels, continuation bitmaps, rank directories.

Level 0 holds the low 8 bits of every id; a set bit in its bitmap says that
the id goes on in level 1, which holds the next 8 bits of those ids only, and
so on.  A rank directory (set bits before every 512) finds an id's place in
the next level, so any one id is read without decoding a block.

A *segment* is one such sequence with the offsets of its documents.  Segments
of about ``SEGMENT_CHARS`` characters of text are the binary payloads of a Parquet table in
ascending doc_id order, written and committed by Spark.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, scan, word_codes, worker_cache

MAGIC = b"PMDAC1\0\0"
SEGMENT_CHARS = 3 << 20
RANK_BITS = 512
END_ID = 2
MEMO_WORDS = 500_000     # words whose ids a worker remembers
MEMO_CHARS = 40


# -- the code ---------------------------------------------------------------

def dac_encode(ids: np.ndarray, starts: np.ndarray) -> bytes:
    """One segment: ``ids`` below 2**32 and ``starts``, the first position of each document."""
    ids = np.asarray(ids, np.uint32)
    levels, rest = [], ids
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        per_block = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint32) if len(more) else []
        rank = np.concatenate(([0], np.cumsum(per_block, dtype=np.uint32)))[:-1 if len(more) else 1].astype("<u4")
        levels.append((len(rest), (rest & 255).astype(np.uint8).tobytes(), bits.tobytes(), rank.tobytes()))
        rest = rest[more] >> 8
        if not len(rest):
            break
    starts = np.asarray(starts, "<u4")
    head = MAGIC + struct.pack("<III", len(ids), len(starts), len(levels))
    body = [starts.tobytes()]
    for n, low, bits, rank in levels:
        head += struct.pack("<IIII", n, len(low), len(bits), len(rank))
        body += [low, bits, rank]
    return head + b"".join(body)


class Dac:
    """Reader of one segment: ``dac[i]`` and ``dac.document(k)`` touch only what they need."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a token segment")
        self.n, self.n_docs, n_levels = struct.unpack_from("<III", data, 8)
        at = 20 + 16 * n_levels
        self.starts = np.frombuffer(data, "<u4", self.n_docs, at)
        at += 4 * self.n_docs
        self.levels = []
        for k in range(n_levels):
            n, low, bits, rank = struct.unpack_from("<IIII", data, 20 + 16 * k)
            self.levels.append((np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, bits, at + low),
                                np.frombuffer(data, "<u4", rank // 4, at + low + bits)))
            at += low + bits + rank

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for low, bits, rank in self.levels:
            value |= int(low[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bits, rank, i)
            shift += 8
        return value

    @staticmethod
    def _rank(bits: np.ndarray, rank: np.ndarray, i: int) -> int:
        """Set bits before ``i``: the directory, then at most 64 bytes."""
        block = i // RANK_BITS
        part = np.unpackbits(bits[block * RANK_BITS // 8:(i >> 3) + 1], bitorder="little")
        return int(rank[block]) + int(part[:i - block * RANK_BITS].sum())

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a to b (exclusive); each level is entered by rank, nothing before ``a`` is decoded."""
        out = np.zeros(b - a, np.uint32)
        where = np.arange(b - a)
        for shift, (low, bits, rank) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= low[a:b].astype(np.uint32) << np.uint32(8 * shift)
            first = a >> 3
            more = np.unpackbits(bits[first:(b + 7) >> 3], bitorder="little")[a - 8 * first:b - 8 * first].astype(bool)
            a = self._rank(bits, rank, a) if len(rank) else 0
            where = where[more]
            b = a + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]) if k + 1 < self.n_docs else self.n)


# -- tokenizing -------------------------------------------------------------

class Encoder:
    """Ids of whole texts, the same as ``tokenizer.encode`` of each.

    ``by_words`` is for tokenizers that drop white space and split letter runs
    from punctuation before merging: texts are cut at ASCII white space, each
    distinct word of a group is looked up once, a word of Latin letters apart
    from its closing punctuation, and the ids of words met before are
    remembered (``MEMO_WORDS`` of up to ``MEMO_CHARS`` characters, so memory is
    bounded).  New words of Latin letters are encoded in rows and told apart by
    the tokens that end a word.  Texts that hold the start of a special token's string go to the
    tokenizer whole.
    """

    BODY = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
    LATIN = re.compile("([a-z\xdf-\xf6\xf8-\xff]+)([.,;:!?|*&#%]+)")

    def __init__(self, tokenizer_json: str, by_words: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = [t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_words = by_words
        self.memo: dict[str, bytes] = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.word_ends = None
        if by_words and suffix:
            self.word_ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.word_ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def encode(self, texts: list[str | None], slice_chars: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's end (null: no ids), without special tokens.

        Texts go through in slices of about ``slice_chars`` characters, so that the words of
        all of them are not held together; some words are looked up again.
        """
        if not slice_chars:
            return self._encode([t or "" for t in texts])
        parts = [self._encode([t or "" for t, in some]) for some in groups(((t,) for t in texts), slice_chars)]
        if len(parts) < 2:
            return parts[0] if parts else self._encode([])
        before = np.cumsum([0, *(len(ids) for ids, _ in parts[:-1])])
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([ends + n for (_, ends), n in zip(parts, before.tolist())])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = [not self.by_words or any(s in t for s in self.special) for t in texts]
        index, ends, words = word_codes(["" if w else _lower_latin(t) for t, w in zip(texts, whole)])
        ids = self._ids(words)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        table, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        n = size[index]
        stop = np.cumsum(n)
        flat = table[np.repeat(first[index] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
        text_stop = np.concatenate(([0], stop))[ends]
        for k in np.flatnonzero(whole).tolist():       # from the tokenizer itself, put in place
            own = self.tokenizer.encode(texts[k], add_special_tokens=False).ids
            flat = np.insert(flat, text_stop[k], own) if own else flat
            text_stop[k:] += len(own)
        return flat, text_stop

    def _ids(self, words: list[str]) -> list[bytes]:
        memo = self.memo
        out = list(map(memo.get, words))
        missing = [k for k, ids in enumerate(out) if ids is None]
        if missing:
            parted = {k: m.groups() for k in missing if (m := self.LATIN.fullmatch(words[k]))}
            new = {p for pair in parted.values() for p in pair if p not in memo}
            new.update(words[k] for k in missing if k not in parted)
            found = self._learn(list(new))
            for k, (head, tail) in parted.items():
                # both are in one of the two, and the whole word is new
                out[k] = found[words[k]] = (memo.get(head) or found[head]) + (memo.get(tail) or found[tail])
            for k in missing:
                if k not in parted:
                    out[k] = found[words[k]]
            if len(memo) < MEMO_WORDS:
                memo.update((w, ids) for w, ids in found.items() if len(w) <= MEMO_CHARS)
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        plain = list(filter(self.BODY.fullmatch, words))
        rest = [w for w in words if not self.BODY.fullmatch(w)]
        found = self._learn_bodies(plain) if self.word_ends is not None else None
        if found is None:
            found, rest = {}, words
        for i in range(0, len(rest), 4096):
            some = rest[i:i + 4096]
            found.update((w, _u32(e.ids)) for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)))
        return found

    def _learn_bodies(self, words: list[str]) -> dict[str, bytes] | None:
        """Ids of words of Latin letters, encoded in rows: each ends with the only word-end token in it.  None if they do not."""
        found = {}
        for i in range(0, len(words), 4096):
            some = words[i:i + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.word_ends[ids]) + 1
            if len(stops) != len(some) or stops[-1] != len(ids):
                return None
            raw, at = ids.tobytes(), 0
            for w, stop in zip(some, (4 * stops).tolist()):
                found[w] = raw[at:stop]
                at = stop
        return found


def _lower_latin(text: str) -> str:
    """Lower case where that is sure to be what the tokenizer does itself, character by character."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def _u32(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def _encoder(tokenizer_json: str, by_words: bool) -> Encoder:
    cache = worker_cache("tokens")
    key = (zlib.crc32(tokenizer_json.encode()), len(tokenizer_json), by_words)
    if key not in cache:
        cache[key] = Encoder(tokenizer_json, by_words)
    return cache[key]


# -- Spark ------------------------------------------------------------------

SEGMENTS = "part int, seg int, start_in_part long, n_tokens long, doc_ids array<long>, payload binary"


def write_tokens(docs: DataFrame, tokenizer_path: str, out: str, by_words: bool = False,
                 end_id: int = END_ID, segment_chars: int = SEGMENT_CHARS,
                 slice_chars: int | None = None) -> None:
    """Encode every row of ``docs(doc_id, text)`` into DAC segments under ``out`` (Parquet, payload column).

    Rows go in ascending doc_id order (null first; rows of one id by text
    hash, then text).  Each document is its ids and ``end_id``; null and empty
    texts are ``end_id`` alone.  A segment is closed after ``segment_chars``
    characters of text, at the end of a document.  An empty table writes no
    segments; other columns are not read.  ``slice_chars`` bounds the text
    encoded at once below a segment: less memory, some more time.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        held = spark.sparkContext.broadcast(f.read())       # one vocabulary file, a few MB

    def rows(it):
        part = TaskContext.get().partitionId()
        enc, before = _encoder(held.value, by_words), 0
        for seg, some in enumerate(groups(it, segment_chars)):
            ids, ends = enc.encode([t for *_, t in some], slice_chars)
            ids = np.insert(ids, ends, end_id)
            starts = np.concatenate(([0], ends[:-1])) + np.arange(len(ends))
            yield part, seg, before, len(ids), [r[0] for r in some], dac_encode(ids, starts)
            before += len(ids)

    sorted_docs = (docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("h"),
                               F.col("text").cast("string"))
                   .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text"))
    scan(sorted_docs, SEGMENTS, rows, cache="tokens").write.mode("overwrite").parquet(out)


def read_segments(spark, path: str) -> DataFrame:
    """Segments with ``start``, the position of their first id in the whole order."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # one row for each partition of the writer
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    n = np.array([r["n"] for r in totals], np.int64)
    # as Arrow data: rows of Python tuples would go through Python workers of their own
    starts = spark.createDataFrame(pa.table({"part": pa.array([r["part"] for r in totals], pa.int32()), "before": np.cumsum(n) - n}))
    return (segments.join(F.broadcast(starts), "part")
            .select((F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "doc_ids", "payload"))


def read_documents(spark, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the segments under ``path``.

    ``ids`` are little-endian unsigned 32-bit; with ``digest`` their unsigned
    crc32 takes their place (``ids_crc32``), made where they are read.
    """
    def rows(it):
        for start, doc_ids, payload in it:
            dac = Dac(payload)
            flat = dac.slice(0, len(dac)).astype("<u4")
            for doc_id, k, stop in zip(doc_ids, dac.starts.tolist(), [*dac.starts[1:].tolist(), len(dac)]):
                ids = flat[k:stop].tobytes()
                yield doc_id, start + k, len(ids) // 4, zlib.crc32(ids) if digest else ids
    return scan(read_segments(spark, path).select("start", "doc_ids", "payload"),
                "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary"), rows)
