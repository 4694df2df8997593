"""Golden rows for the news-site markup (list and detail pages of our own)."""
import datetime as dt

from pyspark.sql import functions as F

from pagemill.config import NEWS_SITE
from pagemill.operators.blocks import assemble, blocks_from_nodes, body_roots, clean_blocks
from pagemill.operators.detail import audio_links, lowest_rate_link, page_fields
from pagemill.operators.listing import entries, resolve_entries, take_while
from pagemill.operators.shred import HtmlScope, nodes_by_page
from pagemill.sources.tables import list_pages

from fixtures import DETAIL, LIST_ASYNC, LIST_COMMON, LIST_ERROR

RUN_TS = "2024-01-31 00:00:00"
SCOPES = (HtmlScope("div", cls="wsw"),)


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, kind string")


def test_list_pages_entries_and_take_while(spark):
    pages = _pages(spark, [
        (1, "https://news.example.org/z/1?p=0", LIST_COMMON, "list"),
        (2, "https://news.example.org/z/1?p=1", LIST_ASYNC, "list"),
        (3, "https://news.example.org/z/1?p=2", LIST_ERROR, "list"),
    ])
    nodes = nodes_by_page(pages)
    ents = entries(nodes, NEWS_SITE)
    got = {(r.page_id, r.pos): r for r in ents.collect()}
    assert sorted(got) == [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1)]
    e1, e2, e3 = got[(1, 1)], got[(1, 2)], got[(1, 3)]
    assert (e1.entry_uri, e1.thumb_pic_url, e1.public_date_raw, e1.ignore, e1.list_type) == \
        ("/a/one.html", "https://img.example.org/1.jpg", "2024-01-30 10:00", False, "common")
    assert (e2.thumb_pic_url, e2.ignore) == ("https://img.example.org/2.png", True)
    assert e3.entry_uri is None
    assert got[(2, 1)].list_type == "async"

    meta = list_pages(pages, NEWS_SITE).select("page_id", "url", "page_counter",
                                               F.lit(NEWS_SITE.name).alias("source"))
    res = resolve_entries(ents, meta, RUN_TS)
    r = {(x.page_id, x.pos): x for x in res.collect()}
    assert r[(1, 3)].reason == "entry_without_link"
    assert r[(1, 2)].reason == "entry_ignored"
    assert r[(1, 4)].entry_url == "https://other.example.org/a/old.html"
    assert r[(2, 1)].entry_url == "https://news.example.org/z/p3"
    assert r[(2, 1)].public_datetime_str == "2024-01-05 00:00:00"

    kept = take_while(res, F.lit(24), RUN_TS, max_page=100, skip=F.col("reason").isNotNull())
    # the old entry on page 0 stops page 0 and every later page
    assert [(x.page_id, x.pos) for x in kept.collect()] == [(1, 1)]


def test_detail_page_fields(spark):
    pages = _pages(spark, [(7, "https://news.example.org/a/one.html", DETAIL, "detail")])
    nodes = nodes_by_page(pages, SCOPES)
    f = page_fields(nodes, NEWS_SITE, RUN_TS).collect()[0]
    assert f.title == "A Title & More"
    assert f.public_datetime_str == "2024-01-30 08:15:00"
    assert f.public_datetime == dt.datetime(2024, 1, 30, 8, 15)
    assert f.pub_source == "attr"
    assert f.content_pic == "https://img.example.org/cover.jpg"
    assert f.content_pic_info.alt == "Cover" and f.content_pic_info.url == "content_pic."
    assert f.category == "Science"
    assert f.tags == ["voa", "voa learning english", "Science"]
    assert f.layout_ok

    links = audio_links(nodes, NEWS_SITE)
    best = lowest_rate_link(links).collect()[0]
    assert best.audio_addr == "https://a.example.org/lo.mp3" and best.n_links == 3


def test_detail_body_cleaning(spark):
    pages = _pages(spark, [(7, "https://news.example.org/a/one.html", DETAIL, "detail")])
    nodes = nodes_by_page(pages, SCOPES)
    blocks = blocks_from_nodes(nodes, NEWS_SITE)
    cleaned = clean_blocks(blocks, NEWS_SITE)
    acts = [(r.tag, r.action, r.div_class) for r in cleaned.orderBy("pos").collect()
            if not (r.kind == "text" and r.text.strip() == "")]
    assert acts == [
        (None, "loose_text", None), (None, "keep", None),
        ("div", "drop_div", "unknown"), ("div", "drop_div", "main_audio"), ("div", "drop_div", "quiz"),
        ("div", "keep", "content_image"), ("p", "keep", None), ("p", "ruler", None), ("p", "keep", None),
        ("p", "keep", None), ("div", "drop_div", None), ("div", "keep", "content_image"),
        ("p", "keep", None), ("p", "credit", None), ("p", "credit", None), ("p", "keep", None),
        ("h2", "footer", None), ("p", "footer", None), ("ul", "keep", None)]
    a = assemble(cleaned).collect()[0]
    assert a.formatted_text == ("First image\nFirst paragraph.\n__________\nSecond paragraph here.\n"
                                "I'm Jane Doe.\nNot all emphasis.\nkept list")
    assert [(i.id, i.url, i.ori_url, i.alt) for i in a.imgs] == [
        ("content_image_1", "content_image_1.jpg", "https://img.example.org/Pic.JPG?x=1", "First image"),
        ("content_image_2", "content_image_2.unknown", "https://img.example.org/noext", "")]
    assert a.footer_text == "Words in this Story\nword - a meaning"
    assert a.footer.startswith("[<h2>Words in this Story</h2>, <p>")
    assert 'id="content_image_div_1"' in a.body_html and "<!-- a comment -->" in a.body_html
    root = body_roots(nodes, NEWS_SITE).collect()[0]
    assert root.ori_content.startswith('<div class="wsw">') and root.ori_content.endswith("</div>")


def test_missing_layout_is_flagged(spark):
    pages = _pages(spark, [(9, "https://news.example.org/a/x.html",
                            "<html><body><div id='content'><h1>x</h1></div></body></html>", "detail")])
    f = page_fields(nodes_by_page(pages, SCOPES), NEWS_SITE, RUN_TS).collect()[0]
    assert f.layout_ok is False and f.title == "" and f.pub_source == "run_ts"
