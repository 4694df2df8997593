"""Queries over the whole chain: bundled pages behind list pages made from them, with DuckDB twins.

The list pages hold one entry per bundled page, in the news markup, with
missing links, media icons and old dates in fixed places; the detail pages are
the bundled ones with audio, thumbs, loose text and missing parts put in.
"""

from __future__ import annotations

import dataclasses as dc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DRIVER_PAGES, NEWS_SITE, DedupConf
from ..operators import media as M
from ..operators.detail import audio_links, lowest_rate_link
from ..operators.listing import entries
from ..operators.select import child, desc, sel
from ..operators.shred import HtmlScope, nodes_by_page
from ..session import ensure_checkpoint_dir
from ..sinks import stores as S
from ..sinks.files import publish_files, published_files
from ..sources.tables import media_files, raw_pages
from . import sqlkit as Q
from .flagship import HISTORY, RUN_TS, Hooks, Outcome, detail_articles, ingest

SPEC = dc.replace(
    NEWS_SITE, name="pages", seed_url="", page_param="p", content_scope=None, header_scope=None,
    body_scope=sel(desc("footer")), title=DRIVER_PAGES.title, pub_time=sel(desc("time")), cover_img=None, category=None,
    audio_links=sel(desc("ul", cls_eq="audio"), child("li"), child("a")), body_root=DRIVER_PAGES.body_root, base_tags=("site",))
PER_LIST = 20
SCOPES = (HtmlScope("article"),)


def _p(n: int, k: int) -> Column:
    return F.col("page_id") % n == k


def list_html(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, url, html, source): list pages of 20 entries; a source's pages are numbered by its counter."""
    date = F.when(_p(211, 200), "2023-06-01 10:00").otherwise(
        F.concat(F.lit("2024-01-30 1"), (F.col("page_id") % 10).cast("string"), F.lit(":00")))
    link = F.when(_p(17, 3), "").otherwise(F.concat(F.lit('<a href="/a/'), F.col("page_id").cast("string"), F.lit('.html">x</a>')))
    thumb = F.when(_p(4, 1), F.concat(F.lit('<div class="thumb"><img data-src="https://d.example.org/t/'),
                                      F.col("page_id").cast("string"), F.lit('.jpg" src="small.jpg"></div>'))) \
        .when(_p(4, 2), F.concat(F.lit('<div class="thumb"><img src="https://d.example.org/s/'), F.col("page_id").cast("string"),
                                 F.lit('.png"></div>'))).otherwise("")
    icon = F.when(_p(19, 4), '<span class="ico ico--media-type"></span>').otherwise("")
    entry = F.concat(F.lit('<li><div class="media-block">'), link, thumb, F.lit('<div class="media-block__content"><span class="date">'),
                     date, F.lit("</span>"), icon, F.lit("</div></div></li>"))
    k = F.floor(F.col("page_id") / PER_LIST)
    rows = raw_pages(spark, sf).select(k.alias("k"), F.struct("page_id", entry.alias("e")).alias("e"))
    lists = rows.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda x: x["e"]), "").alias("es"))
    return lists.select(
        F.col("k").alias("page_id"),
        F.concat(F.lit("https://d.example.org/z?p="), F.floor(F.col("k") / 3).cast("string")).alias("url"),
        F.concat(F.lit('<html><body><ul id="articleItems">'), "es", F.lit("</ul></body></html>")).alias("html"),
        F.concat(F.lit("src"), (F.col("k") % 3).cast("string")).alias("source"))


def detail_html(spark: SparkSession, sf: str) -> DataFrame:
    """The bundled pages as detail pages."""
    n = F.col("page_id").cast("string")
    audio = F.when(_p(3, 0), F.concat(
        F.lit('<ul class="audio"><li><a href="https://d.example.org/hi/'), n, F.lit('.mp3">128 kbps</a></li><li><a href="https://d.example.org/lo/'),
        n, F.lit('.mp3">64 KBPS</a></li></ul>'))).otherwise("")
    time = F.when(_p(5, 0), "").otherwise('<time datetime="2024-01-30 08:00">x</time>')
    html = F.replace(F.col("html"), F.lit("</nav>"), F.concat(F.lit("</nav>"), audio, time))
    html = F.when(_p(11, 6), F.replace(html, F.lit("<article>"), F.lit("<article>loose"))).otherwise(html)
    html = F.when(_p(13, 5), F.replace(html, F.lit("article>"), F.lit("section>"))).otherwise(html)
    html = F.when(_p(23, 7), F.replace(html, F.lit("footer>"), F.lit("address>"))).otherwise(html)
    return raw_pages(spark, sf).select("page_id", F.concat(F.lit("https://d.example.org/a/"), n, F.lit(".html")).alias("url"),
                                       html.alias("html"))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """Titles and URLs stored earlier, of the bundled pages themselves; some are beyond the horizon."""
    from ..operators.detail import page_fields
    from .catalog import page_nodes
    t = page_fields(page_nodes(spark, sf), DRIVER_PAGES, RUN_TS).select("page_id", "title")
    when = F.when(_p(2, 0), "2024-01-20 00:00:00").otherwise("2023-12-01 00:00:00").cast("timestamp_ntz")
    titles = t.where(_p(29, 1)).select("title", F.lit("none").alias("source_addr"), F.lit("pages").alias("spider"), when.alias("created_at"))
    urls = t.where(_p(31, 2)).select(F.lit("no title like this").alias("title"), F.concat(
        F.lit("https://d.example.org/a/"), F.col("page_id").cast("string"), F.lit(".html")).alias("source_addr"),
        F.lit("other").alias("spider"), when.alias("created_at"))
    return titles.unionByName(urls)


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Fetched media: the low-rate audio of all, failed for some; thumbs, some missing."""
    p = raw_pages(spark, sf).select("page_id", F.col("page_id").cast("string").alias("n"))
    audio = p.where(_p(3, 0)).select(F.concat(F.lit("https://d.example.org/lo/"), "n", F.lit(".mp3")).alias("url"),
                                     (F.col("page_id") % 9 != 0).alias("ok"))
    thumb = p.where(_p(4, 1) & ~_p(8, 5)).select(F.concat(F.lit("https://d.example.org/t/"), "n", F.lit(".jpg")).alias("url"), F.lit(True).alias("ok"))
    small = p.where(_p(4, 2)).select(F.concat(F.lit("https://d.example.org/s/"), "n", F.lit(".png")).alias("url"), F.lit(True).alias("ok"))
    return audio.unionByName(thumb).unionByName(small).withColumn("path", F.concat(F.lit("full/"), F.md5("url")))


CONF = DedupConf(title_days=30, url_days=30, title_spiders=("pages",))


def run(spark: SparkSession, sf: str) -> Outcome:
    return ingest(list_html(spark, sf), detail_html(spark, sf), SPEC, RUN_TS, F.lit(24), _results(spark, sf), SCOPES,
                  _history(spark, sf), CONF, pack_error=F.when(_p(25, 11), "disk full"))


_TITLE = Q.pstrip(Q.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))
_SQL = f"""
e AS (SELECT page_id, html, page_id // 20 AS k, {_TITLE} AS title, page_id % 211 = 200 AS old,
             CASE WHEN page_id % 17 = 3 THEN 'entry_without_link' WHEN page_id % 19 = 4 THEN 'entry_ignored' END AS r0 FROM pages),
stop AS (SELECT k % 3 AS s, min(page_id) AS stop FROM e WHERE old AND r0 IS NULL GROUP BY 1),
f AS (SELECT e.*, coalesce(r0, CASE WHEN stop IS NOT NULL AND page_id >= stop THEN 'entry_too_old' END,
             CASE WHEN page_id % 23 = 7 THEN 'layout_missing' WHEN page_id % 13 = 5 THEN 'body_missing' END) AS r1
      FROM e LEFT JOIN stop ON stop.s = e.k % 3),
c AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id) AS rn FROM f WHERE r1 IS NULL),
d AS (SELECT page_id, CASE WHEN rn > 1 OR title IN (SELECT title FROM e WHERE page_id % 29 = 1 AND page_id % 2 = 0) THEN 'duplicate_title'
                           WHEN page_id % 31 = 2 AND page_id % 2 = 0 THEN 'duplicate_url' END AS r2 FROM c),
g AS (SELECT f.page_id, f.title, coalesce(r1, r2) AS reason, page_id % 3 = 0 AS audio,
             (page_id % 3 = 0 AND page_id % 9 = 0) OR (page_id % 4 = 1 AND page_id % 8 = 5) AS media_failed
      FROM f LEFT JOIN d USING (page_id)),
a AS (SELECT page_id, title, audio, media_failed,
             CASE WHEN page_id % 25 = 11 THEN 'packed_failed' WHEN media_failed THEN 'downloaded_error' ELSE 'done' END AS status,
             CASE WHEN page_id % 25 = 11 THEN 'disk full' WHEN media_failed THEN 'related files download error' ELSE 'ok' END AS status_msg
      FROM g WHERE reason IS NULL)"""

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def deco(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn
    return deco


@query("articles_pipeline", f"""WITH {_SQL}
SELECT page_id, title, CASE WHEN audio THEN 'w_audio' ELSE 'wo_audio' END AS type, status, status_msg,
       CASE WHEN audio THEN 'https://d.example.org/lo/' || CAST(page_id AS VARCHAR) || '.mp3' END AS audio_addr,
       CASE page_id % 4 WHEN 1 THEN 'https://d.example.org/t/' || CAST(page_id AS VARCHAR) || '.jpg'
            WHEN 2 THEN 'https://d.example.org/s/' || CAST(page_id AS VARCHAR) || '.png' END AS thumb_pic,
       CASE WHEN status <> 'done' THEN {Q.uuid_from("'pages'", "'https://d.example.org/a/' || CAST(page_id AS VARCHAR) || '.html'")} END AS ref_uuid,
       CASE WHEN page_id % 5 = 0 THEN '2024-01-31 00:00:00' ELSE '2024-01-30 08:00:00' END AS public_datetime
FROM a""")
def articles_pipeline(spark, sf):
    a = run(spark, sf).articles
    return a.select("page_id", "title", "type", "status", "status_msg", "audio_addr", "thumb_pic",
                    F.col("others.ref_uuid").alias("ref_uuid"),
                    F.date_format("public_datetime", "yyyy-MM-dd HH:mm:ss").alias("public_datetime"))


@query("s11_audit_reasons", f"""WITH {_SQL},
m AS (SELECT reason, CASE WHEN reason LIKE 'entry%' THEN page_id // 20 ELSE page_id END AS id FROM g WHERE reason IS NOT NULL
      UNION ALL SELECT 'pub_time_missing', page_id FROM a WHERE page_id % 5 = 0
      UNION ALL SELECT 'loose_text', page_id FROM a WHERE page_id % 11 = 6
      UNION ALL SELECT CASE status WHEN 'downloaded_error' THEN 'download_error' ELSE 'pack_error' END, page_id FROM a WHERE status <> 'done')
SELECT reason, CASE WHEN reason IN ('entry_without_link', 'layout_missing', 'pack_error') THEN 'ERROR'
                    WHEN reason LIKE 'duplicate%' THEN 'DEBUG' WHEN reason LIKE 'entry%' THEN 'INFO' ELSE 'WARNING' END AS severity,
       CAST(id AS VARCHAR) AS key, count(*) AS n FROM m GROUP BY 1, 2, 3""")
def s11_audit_reasons(spark, sf):
    """All eleven reasons of the chain, written by batch and read back."""
    path = S.write_audit(run(spark, sf).audit, _folder(spark, "audit"), 20240131000000)
    return spark.read.parquet(path).groupBy("reason", "severity", "key").agg(F.count("*").alias("n"))


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_META = "struct<uuid:string,spider:string,type:string,title:string,category2:string,audio_addr:string,public_datetime:string>"


def _export(spark, sf) -> DataFrame:
    path = S.publish(run(spark, sf).export, _folder(spark, "export"), 20240131000000)
    return spark.read.parquet(path).withColumn("m", F.from_json("meta_json", _META))


_EXPORT_SQL = f"""SELECT {Q.uuid_from("'pages'", "'https://d.example.org/a/' || CAST(page_id AS VARCHAR) || '.html'")} AS uuid,
       '202401' AS yyyymm, title, CASE WHEN audio THEN 'w_audio' ELSE 'wo_audio' END AS type, 20 AS n_keys"""


@query("s8_packed_export", f"""WITH {_SQL}
{_EXPORT_SQL}, 'status.downloaded' AS status_file, 'related files downloaded' || chr(10) AS status_body,
       true AS has_html, true AS has_text
FROM a WHERE NOT media_failed""")
def s8_packed_export(spark, sf):
    """Full export rows, published and read back; the metadata's fields parsed."""
    e = _export(spark, sf).where("status_file = 'status.downloaded'")
    return e.select("uuid", F.col("yyyymm").cast("string").alias("yyyymm"), "m.title", "m.type",
                    F.size(F.json_object_keys("meta_json")).alias("n_keys"), "status_file", "status_body",
                    F.col("formatted_content_html").startswith("<article>").alias("has_html"),
                    F.col("formatted_text_txt").isNotNull().alias("has_text"))


@query("s9_partial_export", f"""WITH {_SQL}
{_EXPORT_SQL}, 'status.downloaded_error' AS status_file, 'related files download error' || chr(10) AS status_body,
       false AS has_html, false AS has_text
FROM a WHERE media_failed""")
def s9_partial_export(spark, sf):
    """Metadata and status only."""
    e = _export(spark, sf).where("status_file <> 'status.downloaded'")
    return e.select("uuid", F.col("yyyymm").cast("string").alias("yyyymm"), "m.title", "m.type",
                    F.size(F.json_object_keys("meta_json")).alias("n_keys"), "status_file", "status_body",
                    F.col("formatted_content_html").isNotNull().alias("has_html"),
                    F.col("formatted_text_txt").isNotNull().alias("has_text"))


@query("s8_article_files", f"""WITH {_SQL},
exported AS ({_EXPORT_SQL}, media_failed FROM a),
files AS (SELECT uuid, yyyymm, title, media_failed, unnest(CASE WHEN media_failed THEN ['meta.json', 'status.downloaded_error']
             ELSE ['meta.json', 'formatted_content.html', 'ori_content.html', 'formatted_text.txt', 'status.downloaded'] END) AS name FROM exported)
SELECT yyyymm, uuid, name, CASE WHEN name = 'meta.json' THEN title END AS title,
       CASE WHEN name LIKE 'status.%' THEN 'related files ' || CASE WHEN media_failed THEN 'download error' ELSE 'downloaded' END || chr(10) END AS status,
       CASE WHEN name LIKE '%.html' THEN true END AS is_markup FROM files""")
def s8_article_files(spark, sf):
    """The files of every article, published and read back."""
    root = _folder(spark, "files")
    publish_files(run(spark, sf).export, root, 20240131000000)
    text = F.col("content").cast("string")
    return published_files(spark, root, 20240131000000).select(
        "yyyymm", "uuid", "name", F.when(F.col("name") == "meta.json", F.get_json_object(text, "$.title")).alias("title"),
        F.when(F.col("name").startswith("status."), text).alias("status"),
        F.when(F.col("name").endswith(".html"), text.startswith("<article")).alias("is_markup"))


@query("p4_entry_fields", """
SELECT page_id // 20 AS list_id, row_number() OVER (PARTITION BY page_id // 20 ORDER BY page_id) AS pos,
       CASE WHEN page_id % 17 <> 3 THEN '/a/' || CAST(page_id AS VARCHAR) || '.html' END AS entry_uri,
       CASE page_id % 4 WHEN 1 THEN 'https://d.example.org/t/' || CAST(page_id AS VARCHAR) || '.jpg'
            WHEN 2 THEN 'https://d.example.org/s/' || CAST(page_id AS VARCHAR) || '.png' END AS thumb_pic_url,
       CASE WHEN page_id % 211 = 200 THEN '2023-06-01 10:00' ELSE '2024-01-30 1' || CAST(page_id % 10 AS VARCHAR) || ':00' END AS public_date_raw,
       page_id % 19 = 4 AS ignore, 'common' AS list_type
FROM pages""")
def p4_entry_fields(spark, sf):
    e = entries(nodes_by_page(list_html(spark, sf).select("page_id", "url", "html")), SPEC)
    return e.select(F.col("page_id").alias("list_id"), F.col("pos").cast("bigint").alias("pos"), "entry_uri", "thumb_pic_url",
                    "public_date_raw", "ignore", "list_type")


@query("p9_audio_links", """
SELECT page_id, 2 AS n_links, 'https://d.example.org/lo/' || CAST(page_id AS VARCHAR) || '.mp3' AS audio_addr,
       'https://d.example.org/hi/' || CAST(page_id AS VARCHAR) || '.mp3=128 kbps|https://d.example.org/lo/' || CAST(page_id AS VARCHAR) || '.mp3=64 KBPS' AS links
FROM pages WHERE page_id % 3 = 0""")
def p9_audio_links(spark, sf):
    links = audio_links(nodes_by_page(detail_html(spark, sf)), SPEC)
    text = links.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("pos", F.concat_ws("=", "href", "text").alias("t")))), lambda x: x["t"]), "|").alias("links"))
    return lowest_rate_link(links).join(text, "page_id").select("page_id", F.col("n_links").cast("int").alias("n_links"), "audio_addr", "links")


@query("f14_nested_json", f"""WITH {_SQL}
SELECT page_id, 'site' AS tag, status <> 'done' AS has_ref,
       CASE WHEN audio THEN 'https://d.example.org/lo/' || CAST(page_id AS VARCHAR) || '.mp3' END AS audio,
       CASE WHEN status <> 'done' THEN 'content_pic,footer,ref_uuid,tags' ELSE 'content_pic,footer,tags' END AS other_keys
FROM a""")
def f14_nested_json(spark, sf):
    """Nested values inside one JSON text, NULLs left out; fields parsed on both sides."""
    a = run(spark, sf).articles
    a = a.select("page_id", S.non_null_json(a, ("uuid", "audios", "others")).alias("j"))
    others = F.get_json_object("j", "$.others")
    return a.select("page_id", F.get_json_object("j", "$.others.tags[0]").alias("tag"),
                    F.get_json_object("j", "$.others.ref_uuid").isNotNull().alias("has_ref"),
                    F.get_json_object("j", "$.audios[0].addr").alias("audio"),
                    F.array_join(F.array_sort(F.json_object_keys(others)), ",").alias("other_keys"))


@query("x1_x3_hooks", f"""WITH
t AS (SELECT page_id, {_TITLE} AS title FROM pages), r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id) AS rn FROM t)
SELECT page_id, title || '!' AS title, '# ' || title AS formatted_text, 'stage one, two' AS category
FROM r WHERE rn = 1 AND title <> ''""")
def x1_x3_hooks(spark, sf):
    """Only headings reach formatting; X2: text marked after it; X3: two stages in order; X4: a predicate."""
    hooks = Hooks(before_format=lambda b: b.where(F.col("tag") == "h1"), after_format=lambda text: F.concat(F.lit("# "), text),
                  stages=(lambda a: a.withColumn("category", F.lit("stage one")),
                          lambda a: a.withColumns({"category": F.concat("category", F.lit(", two")),
                                                   "title": F.concat("title", F.lit("!"))})),
                  accept=F.col("title") != "!")
    a, _ = detail_articles(raw_pages(spark, sf), DRIVER_PAGES, RUN_TS, SCOPES, spark.createDataFrame([], HISTORY), hooks=hooks)
    return a.select("page_id", "title", "formatted_text", "category")


@query("s5_media_store", f"""
SELECT url, 'full/' || md5(url) AS path, octet_length(encode(url)) + 1 AS length FROM (
  SELECT 'https://d.example.org/lo/' || CAST(page_id AS VARCHAR) || '.mp3' AS url FROM pages WHERE page_id % 3 = 0 AND page_id % 9 <> 0
  UNION ALL SELECT 'https://d.example.org/t/' || CAST(page_id AS VARCHAR) || '.jpg' FROM pages WHERE page_id % 4 = 1 AND page_id % 8 <> 5
  UNION ALL SELECT 'https://d.example.org/s/' || CAST(page_id AS VARCHAR) || '.png' FROM pages WHERE page_id % 4 = 2)""")
def s5_media_store(spark, sf):
    """A store with one file per fetched URL, listed (path and length) and joined to the manifest's results."""
    r = _results(spark, sf).where("ok")
    store = _folder(spark, "media")
    r.select("path", F.col("url").alias("value")).write.partitionBy("path").text(store)
    files = media_files(spark, store).select(F.regexp_extract(F.url_decode(F.url_decode("path")), r"path=(full/[0-9a-f]{32})", 1).alias("path"), "length")
    return r.select("url", "path").join(files, "path").select("url", "path", "length")
