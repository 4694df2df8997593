"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt into shards by ranges of conv_id.  A shard holds a
bitset of its conversations for every (position, turn); from the root, the
intersection of a node's bitset with these postings gives its children, their
member counts and the list of conversations that end there.  Nodes of
different shards are one where the digests of their turns are one; counts are
then sums, and whatever covers a subtree is summed inside the shards first,
each node counted in the shard of its smallest member only.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, scan

SHARD_CONVS = 2048
SHARD_TURNS = 1 << 16
ROOT = b"\0" * 16


# -- turns -------------------------------------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, said, n_bytes) from ``conversations(conv_id, turn, role, text)``: what the trie needs of a turn.

    ``pos`` counts from 1 in the order of ``turn`` (null first; ties by role,
    then by the digest ``said``, then by size, so in one order always); null
    role or text counts as empty.  ``said`` is the SHA-256 of role and text.
    Rows without a conv_id take no part.  Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), said.alias("said"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    return slim.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "said", "n_bytes")


def share_starts(frame: DataFrame, every: int = 5, parts: int = 9) -> DataFrame:
    """``turns`` with borrowed starts, and a row of pos 0 for every conversation.

    Conversation c begins with the first h turns of conversation c - c % every
    (all of them if fewer, none if absent); its own turns after its first h
    follow.  h is the unsigned crc32 of c in decimals, modulo ``parts``.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % parts).cast("long")
    base = F.col("conv_id") - F.col("conv_id") % every
    convs = frame.where("pos = 1").select("conv_id", base.alias("base"), h.alias("h"))
    # at most ``parts`` - 1 turns of a conversation, to itself and the ``every`` - 1 after it
    starts = (frame.where((F.col("pos") < parts) & (F.col("conv_id") % every == 0))
              .select(F.col("conv_id").alias("base"), "pos", "said", "n_bytes"))
    n_start = starts.groupBy("base").agg(F.max("pos").alias("n_start"))
    borrowed = convs.join(starts, "base").where("pos <= h").select("conv_id", "pos", "said", "n_bytes")
    own = (frame.withColumn("h", h).withColumn("base", base).where("pos > h").join(n_start, "base", "left")
           .select("conv_id", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("n_start", F.lit(0)))).alias("pos"), "said", "n_bytes"))
    return convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("said"),
                        F.lit(0).cast("long").alias("n_bytes")).unionByName(borrowed).unionByName(own)


# -- one shard ---------------------------------------------------------------

class Shard:
    """Vertical index of some conversations: postings[position][turn] is a bitset over them."""

    def __init__(self) -> None:
        self.convs: list[int] = []
        self.said: list[list[bytes]] = []
        self.n_bytes: dict[bytes, int] = {}
        self.n_turns = 0

    def add(self, conv_id: int, said: list[bytes]) -> None:
        self.convs.append(conv_id)
        self.said.append(said)
        self.n_turns += len(said)

    def nodes(self):
        """Depth first, from the root: (number, parent's number, node, parent, depth, bytes of the last turn, members, end list).

        Members and end list are bitsets over the shard's conversations, which
        are in ascending order: the lowest bit is the smallest member.
        """
        postings: list[dict[bytes, int]] = []
        alive = [0]                                  # by depth: conversations that go on
        for k, said in enumerate(self.said):
            for d, turn in enumerate(said):
                if d == len(postings):
                    postings.append({})
                    alive.append(0)
                postings[d][turn] = postings[d].get(turn, 0) | 1 << k
                alive[d] |= 1 << k
        number, todo = 0, [(-1, None, ROOT, 0, 0, (1 << len(self.convs)) - 1)]
        while todo:
            above, parent, node, depth, n_bytes, members = todo.pop()
            on = members & alive[depth]
            yield number, above, node, parent, depth, n_bytes, members, members ^ on
            while on:
                turn = self.said[(on & -on).bit_length() - 1][depth]         # of the smallest member left
                child = members & postings[depth][turn]
                on &= ~child
                key = hashlib.sha256(node + turn).digest()[:16]
                todo.append((number, node, key, depth + 1, self.n_bytes[turn], child))
            number += 1

    def ids(self, bits: int) -> np.ndarray:
        raw = np.frombuffer(bits.to_bytes((len(self.convs) + 7) // 8, "little"), np.uint8)
        return np.array(self.convs, np.int64)[np.flatnonzero(np.unpackbits(raw, bitorder="little", count=len(self.convs)))]


def _shards(it, convs: int, limit: int):
    """Rows (conv_id, pos, said, n_bytes) in order, as shards of whole conversations."""
    shard, last, said = Shard(), None, []
    for conv_id, pos, turn, n_bytes in it:
        if conv_id != last:
            if last is not None:
                shard.add(last, said)
            if len(shard.convs) >= convs or shard.n_turns >= limit:
                yield shard
                shard = Shard()
            last, said = conv_id, []
        if pos:
            said.append(turn)
            shard.n_bytes[turn] = n_bytes
    if last is not None:
        shard.add(last, said)
        yield shard


def pack_ids(ids: np.ndarray) -> bytes:
    """Ascending ids: a bitmap from the first on where that is shorter, else differences; with a leading kind byte."""
    first, span = int(ids[0]), int(ids[-1]) - int(ids[0]) + 1
    if span <= 64 * len(ids):
        bits = np.zeros(span, bool)
        bits[ids - first] = True
        return b"b" + first.to_bytes(8, "little", signed=True) + np.packbits(bits, bitorder="little").tobytes()
    return b"i" + ids.astype("<i8").tobytes()


def unpack_ids(data: bytes) -> np.ndarray:
    if data[:1] == b"i":
        return np.frombuffer(data, "<i8", offset=1)
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=9), bitorder="little")
    return np.flatnonzero(bits) + int.from_bytes(data[1:9], "little", signed=True)


# -- Spark -------------------------------------------------------------------

LOCAL = ("shard long, number int, above int, node binary, parent binary, depth long, n_bytes long, conv_id long, "
         "n_convs long, n_ends long, ends binary")
SUMS = "node binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def local_nodes(rebuilt: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of every shard of ``rebuilt(conv_id, pos, said, n_bytes)``, cut: one row per node and shard.

    A conversation is never split: one longer than ``shard_turns`` is a shard
    of its own with those that came before it.  ``shard`` is the smallest
    conv_id in it, ``ends`` the packed ids of the conversations that end there.
    """
    def rows(it):
        for shard in _shards(it, shard_convs, shard_turns):
            for number, above, node, parent, depth, n_bytes, members, ends in shard.nodes():
                yield (shard.convs[0], number, above, node, parent, depth, n_bytes, shard.convs[(members & -members).bit_length() - 1],
                       members.bit_count(), ends.bit_count(), pack_ids(shard.ids(ends)) if ends else None)

    dealt = cut(rebuilt).repartitionByRange("conv_id").sortWithinPartitions("conv_id", "pos")
    return cut(scan(dealt, LOCAL, rows))


def prefix_trie(rebuilt: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each distinct start of conversations ``rebuilt(conv_id, pos, said, n_bytes)``, from the empty one (depth 0).

    ``rebuilt`` has a row of pos 0 for every conversation, then its turns from
    1 on.  ``node`` identifies the start; conv_id is its smallest member,
    n_convs its members (those that begin with it), n_children the starts one
    turn longer, n_leaves the childless ones in its subtree, saved_tokens the
    sum over its subtree of (n_convs - 1) times the bytes of the last turn,
    ends_sha256 the lowercase SHA-256 of the conversations that end there,
    ascending and joined by commas.  No conversations give no rows.
    """
    local = local_nodes(rebuilt, shard_convs, shard_turns)
    whole = local.groupBy("node").agg(F.min("conv_id").alias("owner"), F.sum("n_convs").alias("all_convs"), F.sum("n_ends").alias("all_ends"))
    # a node that every conversation shares has one row in each shard, not one for each conversation
    rows = local.select("shard", "number", "above", "node", "depth", "n_bytes", "conv_id").join(whole, "node")
    rows = rows.select("shard", "number", "above", "node", "depth", "n_bytes", "conv_id", "owner", "all_convs", "all_ends")
    dealt = rows.repartition("shard").sortWithinPartitions("shard", "number")
    parts = scan(dealt, SUMS, _subtrees)
    nodes = parts.groupBy("node").agg(
        *(F.max(c).alias(c) for c in ("depth", "conv_id", "parent_conv_id", "n_convs")),
        *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    ends = scan(local.where("n_ends > 0").select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard"),
                "node binary, ends_sha256 string", _end_digests)
    return nodes.join(ends, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))


def _subtrees(it):
    """Rows of a shard in depth-first order: sums over each node's subtree, a node counted where its smallest member is."""
    def flush(rows):
        n = len(rows)
        leaves, saved, children = [0] * n, [0] * n, [0] * n
        for k in range(n - 1, -1, -1):
            _, _, above, _, _, n_bytes, conv_id, owner, n_convs, n_ends = rows[k]
            if conv_id == owner:
                leaves[k] += n_ends == n_convs
                saved[k] += (n_convs - 1) * n_bytes
                if above >= 0:
                    children[above] += 1
            if above >= 0:
                leaves[above] += leaves[k]
                saved[above] += saved[k]
        for k, (_, _, above, node, depth, _, _, owner, n_convs, _) in enumerate(rows):
            yield node, depth, owner, rows[above][7] if above >= 0 else None, n_convs, children[k], leaves[k], saved[k]

    some = []
    for row in it:
        if some and row[0] != some[0][0]:
            yield from flush(some)
            some = []
        some.append(row)
    yield from flush(some)


def _end_digests(it):
    """SHA-256 of each node's end list, shard after shard: one node's list is never held whole."""
    node, sha = None, None
    for key, _, ends in it:
        said = ",".join(map(str, unpack_ids(ends).tolist())).encode()
        if key != node:
            if node is not None:
                yield node, sha.hexdigest()
            node, sha = key, hashlib.sha256(said)
        else:
            sha.update(b"," + said)
    if node is not None:
        yield node, sha.hexdigest()
