"""The pipeline on documents, stage by stage against brute force."""
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from pagemill.llm.mixing import targets

from test_decontam import brute as contaminated
from test_simhash import groups, plain

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, None, "s", 0), (9001, "", "en", "s", 0), (9002, "1 2 3", None, None, 5)],
                                docs.schema)
    docs = docs.unionByName(odd)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    now, out = docs, []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, now, SF).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        out.append([r.asDict() for r in now.collect()])
        assert k == 4 or now.columns == docs.columns
    known, unique, clean, mix, tokens = out
    assert sorted(r["doc_id"] for r in known) == sorted(
        r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or ""))

    fps = {r["doc_id"]: plain(r["text"]) for r in known}
    root = groups(list(fps.values()))
    low = {}
    for d, f in fps.items():
        low[root[f]] = min(d, low.get(root[f], d))
    assert sorted(r["doc_id"] for r in unique) == sorted(low.values())
    assert sorted(r["doc_id"] for r in clean) == sorted(
        r["doc_id"] for r in unique if not contaminated(r["text"], items)[1])

    sizes, taken = {}, {}
    for r in clean:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"]))
    for r in mix:
        n = len(WORD.findall(r["text"]))
        assert n and r["n_chars"] == len(r["text"])
        taken[r["source"]] = taken.get(r["source"], 0) + n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    for s, goal in zip(names, targets([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])):
        assert abs(taken.get(s, 0) - goal) <= max(600, 0.05 * goal)

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in mix:
        ids = np.array([*t.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokens) == sorted(want)


def test_run_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
