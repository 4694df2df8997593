"""Ids against the tokenizer itself; round trips of the code; order and offsets."""
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagemill.llm import tokens
from pagemill.llm.queries import token_digests
from pagemill.llm.tokens import Dac, Encoder, dac_encode, read_documents, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
T = Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=1500), min_size=1, max_size=4))
def test_dac_round_trip_and_random_access(docs):
    starts = np.cumsum([0, *map(len, docs)])[:-1]
    flat = [x for d in docs for x in d]
    dac = Dac(dac_encode(np.array(flat, np.uint32), starts))
    assert len(dac) == len(flat)
    for k, d in enumerate(docs):
        assert dac.document(k).tolist() == d
    for i in list(range(0, len(flat), 97)) + [len(flat) - 1] * bool(flat):
        assert dac[i] == flat[i]
    with pytest.raises(IndexError):
        dac[len(flat)]


TEXTS = [None, "", " ", "Hello, WORLD!!  it's I'M don't.", "a b   c\x1fd\x1c e\x0bf", "İstanbul ΣΑΣ, ς. K Å",
         "x <|endoftext|> y <|STARTOFTEXT|>. <|", "été, ñ.", "thing. thing, thing... 12.5% 3rd",
         "́ ́a .,;:!?|*&#% é.é", "z" * 5000, "日本語 テキスト。", "ﬁ ß ẞ ÀÉ.", "don't!can't?'s"]


def test_ids_equal_the_tokenizers(spark):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for by_words in (True, False):
        enc = Encoder(open(PATH, encoding="utf-8").read(), by_words)
        for some in (TEXTS, docs, TEXTS):
            ids, ends = enc.encode(some)
            for t, a, b in zip(some, [0, *ends[:-1]], ends):
                assert ids[a:b].tolist() == T.encode(t or "", add_special_tokens=False).ids, t


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=6))
def test_any_text(texts):
    enc = Encoder(open(PATH, encoding="utf-8").read(), True) if not hasattr(test_any_text, "enc") else test_any_text.enc
    test_any_text.enc = enc
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)]
    ids, ends = enc.encode(texts)
    for t, a, b in zip(texts, [0, *ends[:-1]], ends):
        assert ids[a:b].tolist() == T.encode(t, add_special_tokens=False).ids


def test_files_order_and_digests(spark, tmp_path):
    df = spark.createDataFrame(
        [(i * 7 % 50, t, i) for i, t in enumerate(TEXTS * 3)] + [(None, "none", 0), (3, "same", 1), (3, "same", 2)],
        "doc_id long, text string, start int")
    got = token_digests(spark, df.repartition(5)).orderBy("start").collect()
    assert len(got) == df.count()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    at, by_id = 0, {}
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        by_id.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    want = {}
    for r in df.collect():
        x = np.array([*T.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(r["doc_id"], []).append((len(x), zlib.crc32(x.tobytes())))
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in want.items()}
    write_tokens(df, PATH, f"{tmp_path}/t", by_words=True, segment_chars=10)
    assert read_documents(spark, f"{tmp_path}/t").count() == df.count()
    write_tokens(df.limit(0), PATH, f"{tmp_path}/e")
    assert read_documents(spark, f"{tmp_path}/e").collect() == []


def test_encodes_in_slices_and_reads_without_python_rows(spark, tmp_path):
    """A segment's texts go through in slices, whatever the segment's size; the offsets are no Python rows."""
    enc = Encoder(open(PATH, encoding="utf-8").read(), True)
    sizes, whole = [], enc._encode
    enc._encode = lambda some: sizes.append(sum(map(len, some))) or whole(some)
    texts = [f"word{i}, {t}" for i in range(8) for t in TEXTS if t != "z" * 5000]
    ids, ends = enc.encode(texts, 200)
    for t, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
        assert ids[a:b].tolist() == T.encode(t, add_special_tokens=False).ids, t
    assert len(sizes) > 1 and max(sizes) <= 200 + max(map(len, texts))
    assert [x.tolist() for x in enc.encode([], 200)] == [[], []]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    write_tokens(df.repartition(2), PATH, f"{tmp_path}/t", by_words=True)
    assert "ExistingRDD" not in tokens.read_segments(spark, f"{tmp_path}/t")._jdf.queryExecution().toString()
