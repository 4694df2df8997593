"""Rules that the second round added: roots, digits, ranges, streams, texts."""
import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from pagemill.config import DRIVER_PAGES, DedupConf
from pagemill.operators import media as M
from pagemill.operators.blocks import assemble, blocks_from_lines, blocks_from_nodes, clean_blocks, clean_text
from pagemill.operators.detail import lowest_rate_link
from pagemill.operators.shred import HtmlScope, nodes_by_page
from pagemill.operators.simhash import fingerprint, simhash, simhash_relational
from pagemill.operators.windows import ranged, running_number
from pagemill.sinks import stores as S
from pagemill.streaming import incremental as INC

RUN_TS = "2024-01-31 00:00:00"


def test_nested_root_keeps_all_text(spark):
    html = "<article><p>a</p><article><p>inner text</p></article><p>z</p></article><article><p>second</p></article>"
    pages = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    blocks = blocks_from_nodes(nodes_by_page(pages, (HtmlScope("article"),)), DRIVER_PAGES)
    assert assemble(clean_blocks(blocks, DRIVER_PAGES)).first()["formatted_text"] == "a\ninner text\nz"


def test_youtube_is_read_in_the_first_script_with_its_attributes(spark):
    frames = ['<iframe><script src="https://youtube/x"></script></iframe>',
              "<iframe><script>a</script><script>youtube</script></iframe>",
              "<iframe><script>see youtube</script></iframe>", "<iframe>youtube</iframe>"]
    rows = [(i, "u", f"<article><div>{f}</div></article>") for i, f in enumerate(frames)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    blocks = blocks_from_nodes(nodes_by_page(pages, (HtmlScope("article"),)), DRIVER_PAGES)
    assert [r["div_class"] for r in blocks.orderBy("page_id").collect()] == ["content_video", None, "content_video", None]


def test_long_digits_do_not_fail(spark):
    links = spark.createDataFrame([(1, 1, "a", "99999999999999999999 kbps"), (1, 2, "b", "64 kbps"),
                                   (2, 1, "c", "9" * 60 + " kbps"), (2, 2, "d", "none")],
                                  "page_id bigint, pos bigint, href string, text string")
    assert sorted((r["page_id"], r["audio_addr"]) for r in lowest_rate_link(links).collect()) == [(1, "b"), (2, "c")]


def test_manifest_takes_images_as_rows(spark, capsys):
    from pagemill.plans import catalog as C
    arts = spark.sql("""SELECT 'a' AS uuid, 't.jpg' AS thumb_pic, CAST(NULL AS STRING) AS audio_addr,
                        array(named_struct('ori_url', 'x', 'url', '1.jpg'), named_struct('ori_url', 't.jpg', 'url', '2.jpg'),
                              named_struct('ori_url', 'x', 'url', '3.jpg')) AS imgs""")
    rows = spark.createDataFrame([("a", "x", "3.jpg", 30), ("a", "x", "1.jpg", 10), ("a", "t.jpg", "2.jpg", 20)],
                                 "uuid string, url string, local_name string, pos long")
    want = [("a", "t.jpg", "thumb_image", "thumb_image.jpg"), ("a", "x", "content_image", "3.jpg")]
    assert sorted(map(tuple, M.manifest(arts).collect())) == want
    assert sorted(map(tuple, M.manifest(arts.drop("imgs"), rows).collect())) == want
    for q in (C.a5_manifest, C.j4_manifest_results, C.a2_media_ok, C.c12_status, C.c14_ref_uuid):   # no history in one array
        q(spark, "/root/testdata/sf0.001").explain("extended")
        assert "collect_list" not in capsys.readouterr().out


def test_status_steps_and_export(spark):
    a = spark.createDataFrame([("a",), ("b",), ("c",)], "uuid string")
    per = spark.createDataFrame([("a", True), ("b", False)], "uuid string, media_ok boolean")
    d = M.download_status(a, per).withColumns({c: F.lit(c) for c in ("batch_id", "data_uri", "formatted_content",
                                                                     "ori_content", "formatted_text")})
    out = {r["uuid"]: r for r in S.export_frame(d).collect()}
    assert (out["a"]["status_file"], out["a"]["status_body"]) == ("status.downloaded", "related files downloaded\n")
    assert (out["b"]["status_file"], out["b"]["formatted_text_txt"]) == ("status.downloaded_error", None)
    done = M.store_status(M.pack_status(d, F.when(F.col("uuid") == "c", "disk full")))
    assert {r["uuid"]: (r["status"], r["status_msg"]) for r in done.collect()} == {
        "a": ("done", "ok"), "b": ("downloaded_error", "related files download error"), "c": ("packed_failed", "disk full")}


def test_running_number_spreads_a_hot_group(spark):
    rows = [("hot", i // 50, i) for i in range(1800)] + [(f"g{i % 7}", i * 1000, i) for i in range(1800, 2000)]
    df = spark.createDataFrame(rows, "g string, t long, id long")
    assert ranged(df, ["g"], ["t", "id"], 8).where("g = 'hot'").select("_range").distinct().count() >= 7
    got = {r["id"]: r["n"] for r in running_number(df, ["g"], ["t", "id"], ranges=8).collect()}
    for g in {r[0] for r in rows}:
        own = sorted((r[1], r[2]) for r in rows if r[0] == g)
        assert [got[i] for _, i in own] == list(range(1, len(own) + 1))


def test_simhash_forms_agree_and_long_text_is_bounded(spark):
    texts = ["", "abc", "The quick brown fox. " * 40, "été ñandú 12_3", "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a = {r["doc_id"]: r["simhash"] for r in simhash(df).collect()}
    b = {r["doc_id"]: r["simhash"] for r in simhash_relational(df).collect()}
    assert a == b
    import random
    import tracemalloc
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(5_000_000))
    tracemalloc.start()
    fingerprint(text)
    assert tracemalloc.get_traced_memory()[1] < 120 << 20
    tracemalloc.stop()


def test_clean_text_equals_block_cleaning(spark):
    rows = [(1, "a\n___________\nb\n\nI am Jane Doe.\n \nlast"), (2, "words in this story\nx\n____________\ny"),
            (3, ""), (4, "I'm\n\nI am a b c d e f\n"), (5, "\n".join(["I am here now"] + ["l"] * 25)),
            (6, "a\nWords In This Story \n\nfoot")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spec = dataclasses.replace(DRIVER_PAGES)
    a = assemble(clean_blocks(blocks_from_lines(df), spec)).select(
        F.col("page_id").alias("doc_id"), "formatted_text", "footer_text", "signoff_pos", F.col("n_credit").cast("bigint"))
    b = clean_text(df, spec).select("doc_id", "formatted_text", "footer_text", "signoff_pos", "n_credit")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


CONF = DedupConf(title_days=30, url_days=30, title_spiders=("s",))


def _rows(spark, n=240):
    return spark.createDataFrame(
        [(i, "s" if i % 3 else "o", f"t{i * 7 % 60}", f"u{i % 90}", dt.datetime(2024, 1, 20) + dt.timedelta(minutes=i))
         for i in range(n)], "id bigint, spider string, title string, source_addr string, created_at timestamp_ntz")


def test_replayed_epochs_give_the_same_rows_and_stream_equals_batch(spark, tmp_path):
    from pagemill.operators.dedup import dedup
    batch, hist = _rows(spark), _rows(spark, 20).where("id < 5")
    handle = INC.dedup_handler(f"{tmp_path}/h", f"{tmp_path}/o", RUN_TS, CONF, lambda: F.col("id"), hist)

    def accepted(epoch):
        return sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/o/epoch={epoch}").collect())

    parts = [batch.where(F.col("id").between(80 * k, 80 * k + 79)) for k in range(3)]
    for k, part in enumerate(parts):
        handle(part, k)
        once = accepted(k)
        handle(part, k)
        assert accepted(k) == once
    handle(parts[1], 1)         # replay of an earlier epoch
    want = sorted(r["id"] for r in dedup(batch, hist, RUN_TS, CONF, F.col("id")).where("reason is null").collect())
    assert sorted(sum((accepted(k) for k in range(3)), [])) == want


def test_upsert_epochs_rewrite_touched_buckets_only(spark, tmp_path):
    seed = spark.createDataFrame([(k, f"t{k}", "new", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)) for k in range(50)],
                                 "key long, title string, status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    handle = INC.upsert_handler(f"{tmp_path}/s", "key", RUN_TS, lambda: F.lit(0), seed, ("status",), buckets=16)
    one = spark.createDataFrame([(3, "x", "a"), (60, "y", "a")], "key long, title string, status string")
    two = spark.createDataFrame([(60, "z", "b")], "key long, title string, status string")
    for k, batch in enumerate((one, two, two)):
        handle(batch, min(k, 1))        # the last is a replay
    rows = {r["key"]: (r["title"], r["status"]) for r in INC.snapshot(spark, f"{tmp_path}/s", seed, "key", 16).collect()}
    assert len(rows) == 51 and rows[3] == ("t3", "a") and rows[60] == ("y", "b") and rows[4] == ("t4", "new")
    assert spark.read.parquet(f"{tmp_path}/s/epoch=1").select("bucket").distinct().count() == 1
