"""The trie against plain tuples of turns; shards of any size; packed end lists; edge cases."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm.trie import pack_ids, prefix_trie, share_starts, turns, unpack_ids


def rebuilt(rows, share=True):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0), (role or "").encode(), said, text or ""))
    own = {c: [(r.decode(), t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    if not share:
        return own
    return {c: own.get(c - c % 5, [])[:zlib.crc32(str(c).encode()) % 9] + v[zlib.crc32(str(c).encode()) % 9:] for c, v in own.items()}


def brute(convs):
    members = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    out = []
    for node, m in members.items():
        d = len(node)
        sub = [x for x in members if x[:d] == node]
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == d)))
        out.append((min(m), d, min(members[node[:-1]]) if d else None, len(m), sum(len(x) == d + 1 for x in sub),
                    sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in sub) for x in sub),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def data(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 4 * n), n):
        for t in range(rng.choice([1, 1, 2, 4, 9, 14])):
            say = rng.choice(["hello", "hé", "", None, "x" * 30]) if rng.random() < 0.8 else f"own {c} {t}"
            rows.append((c, t * 10, ["user", "assistant"][t % 2], say))
    for c in range(1000, 1030):                      # many copies of one conversation
        rows += [(c, t, "user", f"copy {t}") for t in range(3)]
    rows += [(c, None, None, "null turn") for c in (7, 1001)] + [(None, 0, "user", "no conversation")]
    rows += [(2000, 1, "user", "b"), (2000, 1, "user", "a"), (2000, 1, "user", "a"), (2000, 1, "assistant", "z"), (-8, 0, "user", "hello")]
    rows += [(3000, t, "user", "long") for t in range(300)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string")


@pytest.mark.parametrize("shard_convs,shard_turns", [(2048, 1 << 16), (3, 1 << 16), (2048, 20)])
def test_against_plain_tuples(spark, shard_convs, shard_turns):
    rows = [r for r in data(1) if r[0] is None or r[0] >= 0]
    df = frame(spark, rows).repartition(3)
    got = prefix_trie(share_starts(turns(df)), shard_convs, shard_turns).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rebuilt(rows))


def test_without_shared_starts_and_with_negative_ids(spark):
    rows = data(2, 25)
    t = turns(frame(spark, rows))
    starts = t.where("pos = 1").selectExpr("conv_id", "0L AS pos", "CAST(NULL AS BINARY) AS said", "0L AS n_bytes")
    got = prefix_trie(t.unionByName(starts)).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rebuilt(rows, share=False))


def test_empty_table_and_conversations_without_turns(spark):
    df = frame(spark, [(1, 0, "user", "only")])
    assert prefix_trie(share_starts(turns(df.limit(0)))).collect() == []
    c = next(c for c in range(1, 50) if c % 5 and zlib.crc32(str(c).encode()) % 9)      # its base is absent: no turns are left
    got = prefix_trie(share_starts(turns(frame(spark, [(c, 0, "user", "only")])))).select(COLUMNS).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert prefix_trie(share_starts(turns(frame(spark, [(None, 0, "user", "x")])))).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.sets(st.one_of(st.integers(-300, 300), st.integers(-2 ** 63, 2 ** 63 - 1)), min_size=1, max_size=200))
def test_packed_ids_round_trip(ids):
    ids = sorted(ids)
    assert unpack_ids(pack_ids(np.array(ids, np.int64))).tolist() == ids
