"""Cross-tokenizer alignment: two tokenizations of one text, grouped at the byte offsets where both cut.

The alignment is divide and conquer: near the middle of an interval a common
end is looked for by bisection, both halves are treated alike, and an interval
without a common end is a leaf group.  Texts are first cut into *chunks* where
both tokenizers must cut; chunks met often are remembered with their groups.

Corpus statistics (how many documents hold an id pair linked) come back to
the documents through a join of each slice's own distinct pairs, so neither a
task nor a broadcast ever holds the pairs of the corpus.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, groups, scan, worker_cache

SLICE_CHARS = 4 << 20        # text of a slice
BATCH_CHARS = 1 << 20        # text tokenized at once
MEMO_CHUNKS = 300_000        # chunks that a worker remembers from slice to slice
MEMO_CHARS = 64              # longer ones are let go,
LONG_CHARS = 4 << 20         # once they have so many characters
GROUP_SLICES = 4             # slices of a Parquet row group: writers and readers hold one
_B_BITS = 32                 # a pair is one long: id of A above, id of B below


# -- divide and conquer -------------------------------------------------------

def align(a: np.ndarray, b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Leaf groups of many intervals at once: token ranges (a0, a1, b0, b1), in order.

    ``a`` and ``b`` are rising token ends; tokens a0..a1-1 and b0..b1-1 of an
    interval cover the same bytes.  Each round looks in every open interval
    for a common end near the middle (A's middle end by bisection in B, then
    its neighbours to both sides) and cuts there; an interval without one is a
    leaf: its tokens share no end within.
    """
    todo, leaves = np.stack([a0, a1, b0, b1]).astype(np.int64), []
    while todo.shape[1]:
        lo, hi = todo[0], todo[1] - 1                    # ends lo..hi-1 lie within
        middle = (lo + hi) >> 1
        cut = np.full(len(lo), -1)
        open_ = np.flatnonzero((hi > lo) & (todo[3] - todo[2] > 1))
        step = 0
        while len(open_):
            for k in (middle[open_] - step, middle[open_] + step) if step else (middle[open_],):
                at = np.clip(k, 0, len(a) - 1)
                hit = (k >= lo[open_]) & (k < hi[open_]) & (b[np.minimum(np.searchsorted(b, a[at]), len(b) - 1)] == a[at])
                cut[open_[hit & (cut[open_] < 0)]] = k[hit & (cut[open_] < 0)]
            step += 1
            open_ = open_[(cut[open_] < 0) & (step <= np.maximum(middle[open_] - lo[open_], hi[open_] - 1 - middle[open_]))]
        leaves.append(todo[:, cut < 0])
        todo, cut = todo[:, cut >= 0], cut[cut >= 0]
        other = np.searchsorted(b, a[cut]) + 1
        todo = np.concatenate([np.stack([todo[0], cut + 1, todo[2], other]), np.stack([cut + 1, todo[1], other, todo[3]])], axis=1)
    out = np.concatenate(leaves, axis=1) if leaves else todo
    return tuple(out[:, np.argsort(out[0], kind="stable")])


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token pairs whose bytes overlap, and the ends of the shared bytes: one pair for every stretch between two ends."""
    ends = np.union1d(a, b)
    return np.searchsorted(a, ends), np.searchsorted(b, ends), ends


# -- two tokenizers -----------------------------------------------------------

class Known:
    """Chunks by number, with sizes, links and group text in columns: less memory than an object for each."""

    def __init__(self) -> None:
        self.code: dict[str, int] = {}               # in the order of the numbers
        self.bad: set[str] = set()                   # bytes differ: no tokens
        self.said: list[str] = []
        self.sizes = array("i")                      # n_a, n_b, n_groups of each
        self.links, self.stop = array("q"), array("q", [0])
        self.uses = np.zeros(0, np.int64)
        self.long_chars = 0

    def add(self, chunk: str, record: tuple | None) -> None:
        if record is None:
            self.bad.add(chunk)
            record = (0, 0, 0, b"", "")
        self.code[chunk] = len(self.said)
        self.sizes.extend(record[:3])
        self.links.frombytes(record[3])
        self.stop.append(len(self.links))
        self.said.append(record[4])
        if len(chunk) > MEMO_CHARS:
            self.long_chars += len(chunk)

    def record(self, chunk: str) -> tuple | None:
        """(n_a, n_b, n_groups, links as packed longs, group text); None where bytes differ."""
        if chunk in self.bad:
            return None
        k = self.code[chunk]
        return (*self.sizes[3 * k:3 * k + 3], self.links[self.stop[k]:self.stop[k + 1]].tobytes(), self.said[k])

    def columns(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes (n_a, n_b, n_groups, n_links) of some chunks, and the links of all of them in a row."""
        stop = np.array(self.stop)
        n = stop[codes + 1] - stop[codes]
        at = np.repeat(stop[codes + 1] - np.cumsum(n), n) + np.arange(n.sum())
        return (np.column_stack([np.frombuffer(self.sizes, np.intc).reshape(-1, 3)[codes], n]),
                np.frombuffer(self.links, np.int64)[at] if len(at) else np.zeros(0, np.int64))

    def used(self, counts: np.ndarray) -> None:
        self.uses = counts + np.pad(self.uses, (0, len(counts) - len(self.uses)))

    def trimmed(self) -> Known:
        """This, or if it is full what was used most, half as much, without the long chunks."""
        if len(self.code) <= MEMO_CHUNKS and self.long_chars <= LONG_CHARS:
            return self
        chunks, most = list(self.code), MEMO_CHUNKS // 2
        uses = np.zeros(len(chunks), np.int64)
        uses[:len(self.uses)] = self.uses
        keep = np.flatnonzero(np.fromiter((len(c) <= MEMO_CHARS for c in chunks), bool, len(chunks)))
        keep = np.sort(keep[np.argsort(-uses[keep], kind="stable")[:most]])
        out, numbers = Known(), keep.tolist()
        out.code = {chunks[k]: new for new, k in enumerate(numbers)}
        out.bad = {c for c in self.bad if c in out.code}
        out.said = [self.said[k] for k in numbers]
        sizes, links = self.columns(keep)
        out.sizes.frombytes(sizes[:, :3].astype(np.intc).tobytes())
        out.links.frombytes(links.tobytes())
        out.stop.frombytes(np.cumsum(sizes[:, 3], dtype=np.int64).tobytes())
        out.uses = uses[keep] >> 1
        return out


class Pair:
    """Tokenizer A (byte-level BPE, `tokenizers`) on space + text and B (`sentencepiece`) on the text."""

    #: GPT-style pre-tokens end between a letter and one of these; whether B's pieces do is looked up.
    TAIL = ".,;:!?|*&#%$"
    LEAD = " a"

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True          # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_proto=b_file)
        place = _byte_level()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = _table({i: bytes(place[c] for c in t) if all(c in place for c in t) else t.encode()
                               for t, i in self.a.get_vocab().items()})
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        self.said = [f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))] + [f"{i}{end}" for end in ",;" for i in range(len(pieces))]
        # chunks end where neither tokenizer can merge across: where B can, nothing is cut
        pieces = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        spaces_lead = not any(re.search("[^▁]▁", p) for p in pieces)
        cuts = " " * spaces_lead + "\n" * (spaces_lead and not any("\n" in p for p in pieces))
        self.tails = bool(cuts) and not any(re.search(f"[^\\W\\d_][{re.escape(self.TAIL)}]", p) for p in pieces)
        self.any_chunks = re.compile(rf"\s*\S+(?:[^\S{cuts}]\s*\S+)*(?:[^\S{cuts}]\s*\Z)?|\s+" if cuts else r"(?s:.+)").findall
        self.odd = re.compile(r"[^\S \n]|\0" if cuts == " \n" else r"(?s:.)").search
        self.parts = re.compile(f"([ \n][A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([{re.escape(self.TAIL)}]+)").fullmatch
        self.known = Known()

    def chunks(self, text: str) -> list[str]:
        """Pieces of space + text that both tokenizers encode apart; together they are the whole."""
        s = f" {text}"
        if s[-1] in " \n" or "  " in s or "\n\n" in s or " \n" in s or "\n " in s or self.odd(s):
            return self.any_chunks(s)
        return s.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]

    def encode_a(self, text: str) -> list[int]:
        """Ids of A for a text as it stands (a leading space is the caller's)."""
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode_b(self, text: str) -> list[int]:
        """Ids of B for a text with its leading space, which B adds itself."""
        return self.b.encode(text[1:])

    def records(self, chunks: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, links as packed longs, group text) of each chunk; None where bytes differ."""
        self.learn(chunks)
        return list(map(self.known.record, chunks))

    def learn(self, chunks: list[str]) -> None:
        """Chunks not yet known get their records."""
        code, add, record = self.known.code, self.known.add, self.known.record
        new = [c for c in dict.fromkeys(chunks) if c not in code]
        split = {c: m.groups() for c in new if (m := self.parts(c))} if self.tails else {}
        todo = dict.fromkeys(p for pair in split.values() for p in pair if p not in code)
        todo.update(dict.fromkeys(c for c in new if c not in split))
        for some in groups(((c,) for c in todo), 1 << 16):
            for c, r in self._learn([c for c, in some]).items():
                if c not in code:
                    add(c, r)
        for c, pair in split.items():
            if c not in code:
                head, tail = map(record, pair)
                add(c, None if head is None or tail is None else (
                    head[0] + tail[0], head[1] + tail[1], head[2] + tail[2], head[3] + tail[3], f"{head[4]};{tail[4]}"))

    def _learn(self, chunks: list[str]) -> dict[str, tuple | None]:
        """Records of new chunks, tokenized in a row: each starts where both tokenizers cut."""
        found, row = {}, [self.LEAD]
        for c in chunks:
            if c[-1].isspace():                      # white space merges with what would follow
                found[c] = self._alone(c)
            else:
                row += [c] if c[0] in " \n" else [self.LEAD, c]
        lead = self._row(row)
        if lead is None:                             # some chunk's bytes differ: each by itself
            lead = {c: self._alone(c) for c in dict.fromkeys(row)}
        return found | lead

    def _alone(self, chunk: str) -> tuple | None:
        own = self._row([self.LEAD, chunk])
        return own and own[chunk]

    def _row(self, chunks: list[str]) -> dict[str, tuple] | None:
        """Records of chunks that follow one another; None if the tokens' bytes are not theirs or do not end with them."""
        text = "".join(chunks)
        list_a, list_b = self.encode_a(text), self.encode_b(text)
        raw = text.encode()
        if b"".join([self.b_bytes[i] for i in list_b]) != raw or b"".join([self.a_bytes[i] for i in list_a]) != raw:
            return None
        ids_a, ids_b = np.array(list_a, np.int64), np.array(list_b, np.int64)
        a, b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        stops = np.cumsum([len(c.encode()) for c in chunks])
        a1, b1 = np.searchsorted(a, stops), np.searchsorted(b, stops)
        if (a[a1] != stops).any() or (b[b1] != stops).any():
            return None
        a1, b1 = a1 + 1, b1 + 1
        a0, b0 = np.concatenate(([0], a1[:-1])), np.concatenate(([0], b1[:-1]))
        ga0, ga1, gb0, gb1 = align(a, b, a0, a1, b0, b1)
        la, lb, ends = overlaps(a, b)
        links = ids_a[la] << _B_BITS | ids_b[lb]
        link_stop = np.searchsorted(ends, stops, side="right")
        # group text: A's ids, then B's, in the order of the groups; each id with the sign that follows it
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[ga1 - 1] = last_b[gb1 - 1] = True
        at_a = np.arange(len(a)) + np.repeat(gb0, ga1 - ga0)
        at_b = np.arange(len(b)) + np.repeat(ga1, gb1 - gb0)
        signs = np.empty(len(a) + len(b), np.int64)
        signs[at_a] = ids_a + last_a * len(self.a_bytes)
        signs[at_b] = ids_b + last_b * len(self.b_bytes) + 2 * len(self.a_bytes)
        said = list(map(self.said.__getitem__, signs.tolist()))
        n_groups = np.searchsorted(ga0, a1) - np.searchsorted(ga0, a0)
        raw_links, out = links.tobytes(), {}
        x = z = 0
        for c, n_a, n_b, n_g, y, end in zip(chunks, (a1 - a0).tolist(), (b1 - b0).tolist(), n_groups.tolist(), link_stop.tolist(),
                                            (a1 + b1).tolist()):
            out[c] = (n_a, n_b, n_g, raw_links[8 * x:8 * y], "".join(said[z:end])[:-1])
            x, z = y, end
        return out


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 is itself, the rest follows at 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _table(of: dict[int, bytes]) -> list[bytes]:
    return [of.get(i, b"") for i in range(max(of) + 1)]


def _pair(a_file: bytes, b_file: bytes) -> Pair:
    cache = worker_cache("align")
    key = zlib.crc32(a_file), zlib.crc32(b_file), len(a_file), len(b_file)
    if key not in cache:
        cache[key] = Pair(a_file, b_file)
    return cache[key]


# -- Spark ------------------------------------------------------------------

#: A slice: its documents, the chunk codes of each, the links of every chunk (numbers into ``pairs``), and how many
#: of its documents hold each pair.  Binary columns are ``_packed``.
SLICES = ("slice long, doc_ids array<long>, n_codes array<int>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, said array<string>, codes binary, n_chunk_links binary, links binary, "
          "pairs array<long>, pair_docs array<long>")


def align_documents(docs: DataFrame, a_path: str, b_path: str, out: str, digest: bool = False,
                    slice_chars: int = SLICE_CHARS) -> None:
    """Tokenize and align every row of ``docs(doc_id, text)`` and write the slices as Parquet under ``out``.

    A reads space + text, B the text.  Rows whose text is null or empty, or
    whose tokens' bytes are not those of space + text, have no tokens, groups
    or links.  Every row is a document, repeated ids too; a null id stays
    null.  Other columns are not read.  ``digest`` keeps the lowercase SHA-256
    of the groups (`a1,a2|b1;a3|b2,b3`) in place of their text.  Texts are
    read whole; a slice holds ``slice_chars`` characters or one longer text.
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as fa, open(b_path, "rb") as fb:
        held = spark.sparkContext.broadcast((fa.read(), fb.read()))      # two vocabulary files, a few MB

    def rows(it):
        part, pair = TaskContext.get().partitionId(), _pair(*held.value)
        for seq, some in enumerate(groups(it, slice_chars)):
            yield (part << 32 | seq, *_slice(pair, some, digest))
            _give_back()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scan(texts, SLICES, rows, cache="align").write.options(**{
        "compression": "zstd", "parquet.block.row.count.limit": GROUP_SLICES}).mode("overwrite").parquet(out)


def _give_back() -> None:
    """Memory that this process has freed goes back to the system: the allocators would keep it while other stages run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):        # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def _slice(pair: Pair, rows: list[tuple], digest: bool) -> tuple:
    known = pair.known
    codes, doc_said = [], []                         # by document
    for some in groups(rows, BATCH_CHARS):
        pieces = [pair.chunks(t) if t else [] for _, t in some]
        pair.learn(chain.from_iterable(pieces))
        for chunks in pieces:
            if known.bad and not known.bad.isdisjoint(chunks):
                chunks = []
            own = list(map(known.code.__getitem__, chunks))
            codes.append(np.array(own, np.int32))
            text = ";".join(map(known.said.__getitem__, own))
            doc_said.append(hashlib.sha256(text.encode()).hexdigest() if digest and chunks else text)
    flat, n_codes = np.concatenate(codes) if codes else np.zeros(0, np.int32), [len(c) for c in codes]
    known.used(uses := np.bincount(flat, minlength=len(known.said)))
    codes, number = np.flatnonzero(uses), np.cumsum(uses > 0, dtype=np.int32) - 1
    flat = number[flat]                              # chunks of the slice, in a row from 0
    stats, links = known.columns(codes)
    pairs, number = np.unique(links, return_inverse=True)
    stop = np.cumsum(stats[:, 3])
    held, stamp = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    sums, ends = [], np.cumsum(n_codes)
    for first, end in zip((ends - n_codes).tolist(), ends.tolist()):
        c = flat[first:end]
        sums.append(stats[c].sum(axis=0))
        if len(c):                                   # distinct pairs of the document
            c = np.unique(c)
            n = stats[c, 3]
            own = number[np.repeat(stop[c] - np.cumsum(n), n) + np.arange(n.sum())]
            order = np.arange(len(own))
            stamp[own] = order
            held[own[stamp[own] == order]] += 1
    sums = np.array(sums, np.int64).reshape(-1, 4).T.tolist()
    pair.known = known.trimmed()
    return ([r[0] for r in rows], n_codes, *sums, doc_said, _packed(flat), _packed(stats[:, 3]), _packed(number), pairs.tolist(),
            held.tolist())


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 as little-endian integers, after a byte that says how long each is."""
    size = next(n for n in (1, 2, 4) if values.max(initial=0) < 1 << 8 * n)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def pair_counts(slices: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, n_docs, best) of every linked id pair: in how many documents, and whether no pair of its A id is in more."""
    counts = (_own_pairs(slices).groupBy("pair").agg(F.sum("n").alias("n_docs"))
              .select("pair", F.shiftright("pair", _B_BITS).alias("a_id"), F.col("pair").bitwiseAND((1 << _B_BITS) - 1).alias("b_id"),
                      "n_docs"))
    counts = cut(counts)
    # pairs of one A id: at most one for every id of B
    top = counts.groupBy("a_id").agg(F.max("n_docs").alias("top"))
    return counts.join(top, "a_id").select("pair", "a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def _own_pairs(slices: DataFrame) -> DataFrame:
    return slices.select("slice", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("at", "p")).select(
        "slice", "at", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").alias("n")).where("n > 0")


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, said string")


def documents(slices: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document of ``align_documents``: sizes, links whose pair is its A id's best, sum of the links' counts, groups."""
    values = _own_pairs(slices).join(counts.select("pair", "n_docs", "best"), "pair").select(
        F.col("slice").alias("of_slice"), "at", "n_docs", "best")
    payload = slices.drop("pairs", "pair_docs")
    schema = _schema(ALIGNED)

    def look_up(own: pa.Table, found: pa.Table) -> pa.Table:
        worker_cache(None)                           # chunks and tokenizers are not used any more
        _give_back()
        at, out = found["at"].to_numpy(), []
        for r in own.to_pylist():
            codes, n, links = (_unpacked(r[c]) for c in ("codes", "n_chunk_links", "links"))
            stop, of_chunk = np.cumsum(n), []
            for c in ("best", "n_docs"):
                value = np.zeros(int(links.max(initial=0)) + 1, np.int64)      # 0: pairs of rows without tokens
                value[at] = found[c].to_numpy()
                of_chunk.append(_sums(value[links], stop))
            ends = np.cumsum(r["n_codes"])
            out.append(pa.table([r["doc_ids"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"],
                                 *(_sums(v[codes], ends) for v in of_chunk), r["said"]], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return payload.groupBy("slice").cogroup(values.groupBy("of_slice")).applyInArrow(look_up, ALIGNED)


def _sums(values: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches that end at ``stops``."""
    total = np.concatenate(([0], np.cumsum(values)))
    stops = np.asarray(stops, np.int64)
    return total[stops] - total[np.concatenate(([0], stops[:-1]))] if len(stops) else stops


def _schema(ddl: str) -> pa.Schema:
    from .common import _arrow_schema
    return _arrow_schema(ddl)
