"""Registered queries: one per inventory ID, each with its DuckDB twin.

Every query reads the bundled tables (or frames Spark derives from them) in
full.  Keys are ``<id>_<what>``; ``oracle()`` holds the SQL twin where one
exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DRIVER_PAGES
from ..functions import dates as D
from ..functions import text as X
from ..operators.blocks import blocks_from_lines, blocks_from_nodes, body_roots
from ..operators.detail import page_fields
from ..operators.listing import entries as list_entries
from ..operators.shred import HtmlScope, nodes_by_page, write_nodes
from ..sources.tables import documents, raw_pages, table
from . import sqlkit as Q

RUN_TS = Q.RUN_TS
# The twins' own constants, written out again so that a wrong one in the operators shows.
_WS = Q.PY_WS
_NON_BMP = r"[\x{10000}-\x{10FFFF}]"
_ILLEGAL = r"\t|\n|\x{3000}|&nbsp;|\x{A0}|&#x3000;|\r"
_ENDS = _WS[:-1] + r"\x{200B}]"
_PUNCT = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
_FULL = "０１２３４５６７８９ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ－"
_HALF = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle() -> dict[str, str]:
    return dict(_ORACLE)


# -- shared inputs -------------------------------------------------------------

_NODE_TABLES: dict[tuple, str] = {}     # of this application: one node table for each input and scope


def page_nodes(spark: SparkSession, sf_dir: str, scopes=(HtmlScope("article"),)) -> DataFrame:
    """P1 over the bundled pages, written once and reused by every page query of the application.

    The article and its children keep their markup.
    """
    key = (spark.sparkContext.applicationId, sf_dir, tuple(scopes))
    if key not in _NODE_TABLES:
        _NODE_TABLES[key] = write_nodes(raw_pages(spark, sf_dir), scopes)
    return spark.read.parquet(_NODE_TABLES[key])


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# -- P1 shredding ------------------------------------------------------------------

@query("p1_tag_counts", sql="""
SELECT page_id, lower(t) AS tag, count(*) AS n
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS t FROM pages)
GROUP BY 1, 2""")
def p1_tag_counts(spark, sf):
    n = page_nodes(spark, sf)
    return n.where(F.col("kind") == "element").groupBy("page_id", "tag").agg(F.count("*").alias("n"))


# -- P3/P4 entries -----------------------------------------------------------------

@query("p3_entries", sql="""
SELECT page_id, unnest(range(1, len(h) + 1)) AS pos, unnest(h) AS entry_uri, false AS ignore,
       'async' AS list_type
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages)""")
def p3_entries(spark, sf):
    e = list_entries(page_nodes(spark, sf), DRIVER_PAGES)
    return e.select("page_id", "pos", "entry_uri", "ignore", "list_type")


# -- P5 title ----------------------------------------------------------------------

@query("p5_title", sql=f"""
SELECT page_id, {Q.pstrip(Q.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} AS title FROM pages""")
def p5_title(spark, sf):
    return page_fields(page_nodes(spark, sf), DRIVER_PAGES, RUN_TS).select("page_id", "title")


# -- P12 blocks --------------------------------------------------------------------

@query("p12_blocks", sql=f"""
WITH {Q.article_blocks_cte()}
SELECT page_id, ord, regexp_extract(seg, '^<([a-z0-9]+)', 1) AS tag,
       {Q.unescape(Q.strip_tags('seg'))} AS text
FROM ablocks""")
def p12_blocks(spark, sf):
    b = blocks_from_nodes(page_nodes(spark, sf), DRIVER_PAGES)
    w = Window.partitionBy("page_id").orderBy("pos")
    return b.select("page_id", F.row_number().over(w).cast("bigint").alias("ord"), "tag", "text")


# -- P20 raw body ------------------------------------------------------------------

@query("p20_raw_body", sql="""
SELECT page_id, regexp_extract(html, '(?s)<article>.*</article>', 0) AS ori_content FROM pages""")
def p20_raw_body(spark, sf):
    return body_roots(page_nodes(spark, sf), DRIVER_PAGES).select("page_id", "ori_content")


# -- P22 plain text ----------------------------------------------------------------

@query("p22_plain_text", sql=f"SELECT doc_id, {Q.clean_lines('text')} AS formatted_text FROM documents")
def p22_plain_text(spark, sf):
    return docs(spark, sf).select("doc_id", X.clean_lines(F.col("text")).alias("formatted_text"))


# -- A8 word / character counts ------------------------------------------------------

@query("a8_word_stats", sql=f"""
SELECT doc_id, len(list_filter(string_split_regex(text, '{_WS}+'), lambda w: w <> '')) AS n_words,
       len(list_distinct(string_split(text, ''))) AS n_distinct_chars
FROM documents""")
def a8_word_stats(spark, sf):
    d = docs(spark, sf)
    return d.select("doc_id", X.word_count(F.col("text")).alias("n_words"),
                    X.distinct_chars(F.col("text")).alias("n_distinct_chars"))


# -- F1-F4 dates over events ---------------------------------------------------------

# Nine input shapes, chosen per event from its id (every event is used).
_SHAPES_SPARK = [
    ("yyyy-MM-dd HH:mm:ss", ""), ("yyyy-MM-dd HH:mm", ""), ("yyyy-MM-dd", ""),
    ("yyyy年MM月dd日 HH:mm", ""), ("MM-dd HH:mm", ""), ("yyyy-MM-dd'T'HH:mm:ss", "+05:00"),
    ("MMMM dd, yyyy", ""), ("MMM d, yyyy", ""), (None, ""),
]
_SHAPES_SQL = ["'%Y-%m-%d %H:%M:%S'", "'%Y-%m-%d %H:%M'", "'%Y-%m-%d'", "'%Y年%m月%d日 %H:%M'",
               "'%m-%d %H:%M'", "'%Y-%m-%dT%H:%M:%S'", "'%B %d, %Y'", "'%b %-d, %Y'", None]


def _raw_date_spark(ts):
    shape = F.col("event_id") % 9
    out = F.concat(F.lit("junk "), F.col("event_type"))
    for i, (fmt, suffix) in enumerate(_SHAPES_SPARK):
        if fmt is None:
            continue
        out = F.when(shape == i, F.concat(F.date_format(ts, fmt), F.lit(suffix))).otherwise(out)
    return out


def _raw_date_sql(ts: str) -> str:
    parts = []
    for i, fmt in enumerate(_SHAPES_SQL):
        if fmt is None:
            continue
        suffix = " || '+05:00'" if i == 5 else ""
        parts.append(f"WHEN event_id % 9 = {i} THEN strftime({ts}, {fmt}){suffix}")
    return "(CASE " + " ".join(parts) + " ELSE 'junk ' || event_type END)"


# events shifted forward on some rows so that F2's "later than run_ts" branch is hit
def _shift_spark():
    return F.when(F.col("event_id") % 4 == 0, F.col("ts") + F.expr("INTERVAL 10 DAYS")).otherwise(F.col("ts"))
_SHIFT_SQL = "(CASE WHEN event_id % 4 = 0 THEN ts + INTERVAL 10 DAY ELSE ts END)"


@query("f1_normalize_date", sql=f"""
SELECT event_id, raw, {Q.norm_date('raw')} AS normalized
FROM (SELECT event_id, {_raw_date_sql('ts')} AS raw FROM events)""")
def f1_normalize_date(spark, sf):
    e = events(spark, sf).select("event_id", _raw_date_spark(F.col("ts")).alias("raw"))
    return e.select("event_id", "raw", D.normalize_date(F.col("raw"), RUN_TS).alias("normalized"))


@query("f2_news_date", sql=f"""
SELECT event_id, raw, news, try_strptime(news, '%Y-%m-%d %H:%M:%S') IS NOT NULL AS valid
FROM (SELECT event_id, raw, {Q.news_date('raw')} AS news
      FROM (SELECT event_id, {_raw_date_sql(_SHIFT_SQL)} AS raw FROM events))""")
def f2_news_date(spark, sf):
    e = events(spark, sf).select("event_id", _raw_date_spark(_shift_spark()).alias("raw"))
    e = e.withColumn("news", D.news_date(F.col("raw"), RUN_TS))
    return e.select("event_id", "raw", "news", D.parse_loose(F.col("news")).isNotNull().alias("valid"))


@query("f3_batch_id", sql="""
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS batch_id FROM events""")
def f3_batch_id(spark, sf):
    return events(spark, sf).select("event_id", D.batch_id(F.col("ts")).alias("batch_id"))


@query("f4_day_start", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d 00:00:00') AS day_start FROM events""")
def f4_day_start(spark, sf):
    return events(spark, sf).select("event_id", D.day_start(F.col("ts")).alias("day_start"))


# =============================================================================
# Frames derived from ``events``: history / batch articles, list entries, media
# =============================================================================

from ..config import DedupConf, DivProbe, SiteSpec  # noqa: E402
from ..functions import ids as I  # noqa: E402
from ..functions import urls as U  # noqa: E402
from ..operators import dedup as DD  # noqa: E402
from ..operators import media as M  # noqa: E402
from ..operators.gates import image_paths, not_blocked, quality_gate  # noqa: E402
from ..operators.blocks import assemble, classify_pass1, clean_blocks, clean_text, signoff_trim  # noqa: E402
from ..operators.detail import audio_type, lowest_rate_link  # noqa: E402
from ..operators.listing import resolve_entries, take_while  # noqa: E402
from ..operators.select import desc, child, sel, select_text  # noqa: E402
from ..operators.simhash import simhash  # noqa: E402
from ..session import written  # noqa: E402
from ..sinks import stores as S  # noqa: E402

EV_DEDUP = DedupConf(title_days=20, url_days=15, title_spiders=("news_en",))
SPLIT_TS = "2024-01-20 00:00:00"


def ev_articles(spark, sf):
    """Article-shaped rows from events (title and URL repeat on purpose)."""
    e = events(spark, sf)
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", k.alias("k"),
        F.when(F.col("user_id") % 3 == 0, "other").otherwise("news_en").alias("spider"),
        F.concat(F.lit("t"), (k % 40).cast("string")).alias("title"),
        F.concat(F.lit("https://e.example.org/u/"), (F.col("user_id") % 50).cast("string"), F.lit("/"),
                 k.cast("string")).alias("source_addr"),
        F.col("ts").cast("timestamp_ntz").alias("created_at"))


EV_SQL = """ev AS (
  SELECT event_id, ts, user_id, event_type, k,
         CASE WHEN user_id % 3 = 0 THEN 'other' ELSE 'news_en' END AS spider,
         't' || CAST(k % 40 AS VARCHAR) AS title,
         'https://e.example.org/u/' || CAST(user_id % 50 AS VARCHAR) || '/' || CAST(k AS VARCHAR) AS source_addr,
         ts AS created_at
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
hist AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
batch AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '2024-01-20 00:00:00')"""


def ev_split(spark, sf):
    a = ev_articles(spark, sf)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    return a.where(F.col("ts") < split), a.where(F.col("ts") >= split)


@query("s3_history_titles", sql=f"""
WITH {EV_SQL}
SELECT DISTINCT title FROM hist WHERE created_at >= DATE '2024-01-11' AND spider IN ('news_en')""")
def s3_history_titles(spark, sf):
    hist, _ = ev_split(spark, sf)
    return DD.history_titles(hist, RUN_TS, EV_DEDUP)


@query("s4_history_urls", sql=f"""
WITH {EV_SQL}
SELECT DISTINCT source_addr FROM hist WHERE created_at >= DATE '2024-01-16'""")
def s4_history_urls(spark, sf):
    hist, _ = ev_split(spark, sf)
    return DD.history_urls(hist, RUN_TS, EV_DEDUP)


@query("a4_distinct_sets", sql=f"""
WITH {EV_SQL}
SELECT (SELECT count(DISTINCT title) FROM hist WHERE created_at >= DATE '2024-01-11' AND spider IN ('news_en')) AS n_titles,
       (SELECT count(DISTINCT source_addr) FROM hist WHERE created_at >= DATE '2024-01-16') AS n_urls""")
def a4_distinct_sets(spark, sf):
    hist, _ = ev_split(spark, sf)
    t = DD.history_titles(hist, RUN_TS, EV_DEDUP).agg(F.count("*").alias("n_titles"))
    u = DD.history_urls(hist, RUN_TS, EV_DEDUP).agg(F.count("*").alias("n_urls"))
    return t.crossJoin(u)  # two one-row aggregates


@query("j2_title_anti_join", sql=f"""
WITH {EV_SQL}
SELECT event_id FROM batch
WHERE NOT (spider IN ('news_en') AND title IN (
  SELECT title FROM hist WHERE created_at >= DATE '2024-01-11' AND spider IN ('news_en')))""")
def j2_title_anti_join(spark, sf):
    hist, batch = ev_split(spark, sf)
    ht = DD.history_titles(hist, RUN_TS, EV_DEDUP)
    listed = batch.where(F.col("spider").isin(*EV_DEDUP.title_spiders))
    others = batch.where(~F.col("spider").isin(*EV_DEDUP.title_spiders))
    return listed.join(ht, "title", "left_anti").select("event_id").unionByName(others.select("event_id"))


@query("j3_url_anti_join", sql=f"""
WITH {EV_SQL}
SELECT event_id FROM batch
WHERE source_addr NOT IN (SELECT source_addr FROM hist WHERE created_at >= DATE '2024-01-16')""")
def j3_url_anti_join(spark, sf):
    hist, batch = ev_split(spark, sf)
    return batch.join(DD.history_urls(hist, RUN_TS, EV_DEDUP), "source_addr", "left_anti").select("event_id")


_DEDUP_SQL = f"""
WITH {EV_SQL},
ht AS (SELECT DISTINCT title FROM hist WHERE created_at >= DATE '2024-01-11' AND spider IN ('news_en')),
hu AS (SELECT DISTINCT source_addr FROM hist WHERE created_at >= DATE '2024-01-16'),
r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ts, event_id) AS rn FROM batch),
d AS (SELECT event_id, spider, title, source_addr,
        CASE WHEN spider IN ('news_en') AND (title IN (SELECT title FROM ht) OR rn > 1) THEN 'duplicate_title'
             WHEN source_addr IN (SELECT source_addr FROM hu) THEN 'duplicate_url' END AS reason
      FROM r)"""


def ev_dedup(spark, sf):
    hist, batch = ev_split(spark, sf)
    return DD.dedup(batch, hist, RUN_TS, EV_DEDUP, arrival=F.struct("ts", "event_id"))


@query("w6_first_title", sql=_DEDUP_SQL + "\nSELECT event_id, reason FROM d")
def w6_first_title(spark, sf):
    return ev_dedup(spark, sf).select("event_id", "reason")


@query("u1_seen_titles", sql=f"""
WITH {EV_SQL}
SELECT title FROM hist WHERE created_at >= DATE '2024-01-11' AND spider IN ('news_en')
UNION SELECT title FROM batch""")
def u1_seen_titles(spark, sf):
    hist, batch = ev_split(spark, sf)
    return DD.seen_titles(hist, batch, RUN_TS, EV_DEDUP)


@query("s11_audit", sql=_DEDUP_SQL + """,
ent AS (SELECT event_id, source_addr,
          CASE WHEN event_type = 'error' THEN 'entry_without_link' WHEN k > 90 THEN 'entry_ignored' END AS reason
        FROM ev)
SELECT CASE reason WHEN 'entry_without_link' THEN 'ERROR' WHEN 'entry_ignored' THEN 'INFO' ELSE 'DEBUG' END AS severity,
       reason, CAST(event_id AS VARCHAR) AS key, source_addr AS url
FROM (SELECT event_id, source_addr, reason FROM d UNION ALL SELECT event_id, source_addr, reason FROM ent)
WHERE reason IS NOT NULL""")
def s11_audit(spark, sf):
    d = ev_dedup(spark, sf)
    ent = ev_articles(spark, sf).withColumn(
        "reason", F.when(F.col("event_type") == "error", "entry_without_link").when(F.col("k") > 90, "entry_ignored"))
    rows = d.select("event_id", "source_addr", "reason").unionByName(ent.select("event_id", "source_addr", "reason"))
    return S.audit_rows(rows, RUN_TS, "event_id", "source_addr").select("severity", "reason", "key", "url")


@query("s12_severity_counts", sql=_DEDUP_SQL + """
SELECT 'DEBUG' AS severity, count(*) AS n FROM d WHERE reason IS NOT NULL""")
def s12_severity_counts(spark, sf):
    d = ev_dedup(spark, sf)
    a = S.audit_rows(d, RUN_TS, "event_id", "source_addr", demote_duplicates=True)
    return a.groupBy("severity").agg(F.count("*").alias("n"))


# -- list entries from events: C1-C5, W1, L2 ---------------------------------------

EV_HOURS = {"src0": 0, "src1": 24 * 29}
EV_DEFAULT_HOURS = 24 * 28


def _hours_col(source):
    out = F.lit(EV_DEFAULT_HOURS)
    for s, h in EV_HOURS.items():
        out = F.when(source == s, F.lit(h)).otherwise(out)
    return out


def _hours_sql(source):
    cases = " ".join(f"WHEN '{s}' THEN {h}" for s, h in EV_HOURS.items())
    return f"(CASE {source} {cases} ELSE {EV_DEFAULT_HOURS} END)"


def ev_entries(spark, sf):
    a = ev_articles(spark, sf)
    newest = a.agg(F.max("event_id").alias("_max"))  # one-row frame: list pages run newest first
    a = a.crossJoin(newest).withColumn("_rank", F.col("_max") - F.col("event_id"))
    return a.select(
        "event_id", F.concat(F.lit("src"), (F.col("user_id") % 5).cast("string")).alias("source"),
        (F.col("_rank") / 20).cast("bigint").alias("page_counter"), (F.col("_rank") % 20).alias("pos"),
        F.col("ts").alias("public_datetime"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("/e/"), F.col("event_id").cast("string"))).alias("entry_uri"),
        (F.col("k") > 90).alias("ignore"))


def ev_resolved(spark, sf):
    """The entries through C1, C2, F9 and F2; each event is a list page of its own."""
    e = ev_entries(spark, sf).withColumn("page_id", F.col("event_id"))
    meta = e.select("page_id", F.lit("https://e.example.org/z?p=0").alias("url"), "source", "page_counter")
    ents = e.select("page_id", "event_id", "pos", "entry_uri", "ignore",
                    F.date_format("public_datetime", "yyyy-MM-dd HH:mm:ss").alias("public_date_raw"))
    return resolve_entries(ents, meta, RUN_TS)


EV_ENTRIES_SQL = f"""{EV_SQL},
ent AS (SELECT event_id, 'src' || CAST(user_id % 5 AS VARCHAR) AS source,
          ((SELECT max(event_id) FROM ev) - event_id) // 20 AS page_counter,
          ((SELECT max(event_id) FROM ev) - event_id) % 20 AS pos, ts AS public_datetime,
          CASE WHEN event_type = 'error' THEN NULL ELSE '/e/' || CAST(event_id AS VARCHAR) END AS entry_uri,
          k > 90 AS ignore
        FROM ev),
ent2 AS (SELECT *, (entry_uri IS NULL OR ignore) AS skip,
           TIMESTAMP '{RUN_TS}' - to_hours(CASE WHEN {_hours_sql('source')} = 0 THEN 1 ELSE {_hours_sql('source')} END) AS endtime
         FROM ent)"""


@query("c1_reject_no_link", sql=f"""
WITH {EV_ENTRIES_SQL}
SELECT source, count(*) FILTER (WHERE entry_uri IS NULL) AS n_rejected,
       count(*) FILTER (WHERE entry_uri IS NOT NULL) AS n_passed FROM ent GROUP BY source""")
def c1_reject_no_link(spark, sf):
    return ev_resolved(spark, sf).groupBy("source").agg(
        F.count(F.when(F.col("reason") == "entry_without_link", 1)).alias("n_rejected"),
        F.count(F.when(F.coalesce(F.col("reason") != "entry_without_link", F.lit(True)), 1)).alias("n_passed"))


@query("c2_skip_ignored", sql=f"""
WITH {EV_ENTRIES_SQL}
SELECT source, count(*) FILTER (WHERE entry_uri IS NOT NULL AND ignore) AS n_ignored FROM ent GROUP BY source""")
def c2_skip_ignored(spark, sf):
    return ev_resolved(spark, sf).groupBy("source").agg(
        F.count(F.when(F.col("reason") == "entry_ignored", 1)).alias("n_ignored"))


@query("c3_end_time", sql=f"""
WITH {EV_ENTRIES_SQL}
SELECT DISTINCT source, strftime(endtime, '%Y-%m-%d %H:%M:%S') AS endtime FROM ent2""")
def c3_end_time(spark, sf):
    e = ev_entries(spark, sf).select("source").distinct()
    return e.select("source", F.date_format(D.end_time(RUN_TS, _hours_col(F.col("source"))),
                                            "yyyy-MM-dd HH:mm:ss").alias("endtime"))


@query("c4_end_time_epoch", sql=f"""
WITH {EV_ENTRIES_SQL}
SELECT DISTINCT source, CAST(epoch(endtime) AS BIGINT) AS endtime_epoch FROM ent2""")
def c4_end_time_epoch(spark, sf):
    e = ev_entries(spark, sf).select("source").distinct()
    return e.select("source", D.end_time_epoch(RUN_TS, _hours_col(F.col("source"))).alias("endtime_epoch"))


@query("c5_lookback_predicate", sql=f"""
WITH {EV_ENTRIES_SQL}
SELECT event_id, public_datetime < endtime AS is_old FROM ent2 WHERE NOT skip""")
def c5_lookback_predicate(spark, sf):
    e = ev_entries(spark, sf)
    skip = F.col("entry_uri").isNull() | F.col("ignore")
    return e.where(~skip).select(
        "event_id", (F.col("public_datetime") < D.end_time(RUN_TS, _hours_col(F.col("source")))).alias("is_old"))


@query("w1_take_while", sql=f"""
WITH {EV_ENTRIES_SQL},
stops AS (SELECT source, min(page_counter * 1000 + pos) AS stop FROM ent2
          WHERE NOT skip AND public_datetime < endtime GROUP BY source)
SELECT e.event_id, e.source, e.page_counter, e.pos FROM ent2 e LEFT JOIN stops s USING (source)
WHERE NOT e.skip AND (s.stop IS NULL OR e.page_counter * 1000 + e.pos < s.stop)""")
def w1_take_while(spark, sf):
    e = ev_entries(spark, sf)
    kept = take_while(e, _hours_col(F.col("source")), RUN_TS,
                      skip=F.col("entry_uri").isNull() | F.col("ignore"))
    return kept.select("event_id", "source", "page_counter", "pos")


# -- audio links and media from events: C7, A1, A5, J4, A2, C12-C14, A6 -------------

def ev_links(spark, sf):
    a = ev_articles(spark, sf)
    rate = (F.col("k") * 20).cast("string")
    text = (F.when(F.col("event_type").isin("click", "view"), F.concat(rate, F.lit(" kbps")))
            .when(F.col("event_type") == "purchase", F.concat(rate, F.lit(" KBPS")))
            .when(F.col("event_type") == "signup", F.lit("MP3 file")).otherwise(F.lit("n/a")))
    return a.select(F.col("user_id").alias("page_id"), F.col("event_id").alias("pos"), text.alias("text"),
                    F.concat(F.lit("https://a.example.org/"), F.col("event_id").cast("string"), F.lit(".mp3")).alias("href"))


@query("a1_lowest_bitrate", sql=f"""
WITH {EV_SQL},
l AS (SELECT user_id, event_id AS pos, 'https://a.example.org/' || CAST(event_id AS VARCHAR) || '.mp3' AS href,
        CASE WHEN event_type IN ('click', 'view') THEN CAST(k * 20 AS VARCHAR) || ' kbps'
             WHEN event_type = 'purchase' THEN CAST(k * 20 AS VARCHAR) || ' KBPS'
             WHEN event_type = 'signup' THEN 'MP3 file' ELSE 'n/a' END AS text FROM ev),
r AS (SELECT *, TRY_CAST(NULLIF(regexp_extract(text, '(?i)(\\d+) kbps', 1), '') AS INTEGER) AS rate FROM l)
SELECT user_id AS page_id, arg_min(href, CAST(CASE WHEN rate < 1024 THEN rate ELSE 1024 END AS BIGINT) * 1000000000 + pos) AS audio_addr,
       count(*) AS n_links
FROM r GROUP BY user_id""")
def a1_lowest_bitrate(spark, sf):
    return lowest_rate_link(ev_links(spark, sf))


@query("c7_audio_type", sql=f"""
WITH {EV_SQL}
SELECT event_id, CASE WHEN coalesce(CASE WHEN event_type IN ('view', 'click') THEN 'https://a.example.org/' || CAST(event_id AS VARCHAR) || '.mp3'
                                          WHEN event_type = 'signup' THEN '' END, '') <> '' THEN 'w_audio' ELSE 'wo_audio' END AS type
FROM ev""")
def c7_audio_type(spark, sf):
    a = ev_articles(spark, sf)
    addr = (F.when(F.col("event_type").isin("view", "click"),
                   F.concat(F.lit("https://a.example.org/"), F.col("event_id").cast("string"), F.lit(".mp3")))
            .when(F.col("event_type") == "signup", F.lit("")))
    return a.select("event_id", audio_type(addr).alias("type"))


def ev_media(spark, sf):
    """Articles (one per user) with thumb and audio; fetch results from purchases; images, one row each."""
    a = ev_articles(spark, sf)
    url = F.concat(F.lit("https://cdn.example.org/"), (F.col("event_id") % 700).cast("string"), F.lit(".jpg"))
    uuid = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    imgs = a.where(F.col("event_type").isin("click", "view")).select(
        uuid.alias("uuid"), url.alias("url"),
        F.concat(F.lit("content_image_"), F.col("event_id").cast("string"), F.lit(".jpg")).alias("local_name"),
        F.col("event_id").alias("pos"))
    arts = a.groupBy("user_id").agg(F.min("event_id").alias("first_event")).select(
        uuid.alias("uuid"), "user_id",
        F.concat(F.lit("https://cdn.example.org/"), (F.col("first_event") % 700).cast("string"), F.lit(".jpg")).alias("thumb_pic"),
        F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("https://cdn.example.org/a/"), F.col("user_id").cast("string"), F.lit(".MP3"))).alias("audio_addr"))
    results = a.where(F.col("event_type") == "purchase").select(
        url.alias("url"), (F.col("k") % 10 != 0).alias("ok"), F.concat(F.lit("full/"), F.md5(url)).alias("path"))
    return arts, results, imgs


EV_MEDIA_SQL = f"""{EV_SQL},
img AS (SELECT user_id, event_id, 'https://cdn.example.org/' || CAST(event_id % 700 AS VARCHAR) || '.jpg' AS url
        FROM ev WHERE event_type IN ('click', 'view')),
users AS (SELECT user_id, min(event_id) AS first_event FROM ev GROUP BY user_id),
man_all AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS uuid, url, 'content_image' AS file_type,
         'content_image_' || CAST(event_id AS VARCHAR) || '.jpg' AS local_name, 0 AS rank, event_id AS pos FROM img
  UNION ALL
  SELECT 'u' || CAST(user_id AS VARCHAR), 'https://cdn.example.org/' || CAST(first_event % 700 AS VARCHAR) || '.jpg',
         'thumb_image', 'thumb_image.jpg', 1, 0 FROM users
  UNION ALL
  SELECT 'u' || CAST(user_id AS VARCHAR), 'https://cdn.example.org/a/' || CAST(user_id AS VARCHAR) || '.MP3',
         'audio', 'audio.mp3', 2, 0 FROM users WHERE user_id % 4 <> 0),
man AS (SELECT uuid, url, arg_max(file_type, rank * 1000000000 + pos) AS file_type,
               arg_max(local_name, rank * 1000000000 + pos) AS local_name FROM man_all GROUP BY uuid, url),
res AS (SELECT url, bool_or(ok) AS ok FROM (
          SELECT 'https://cdn.example.org/' || CAST(event_id % 700 AS VARCHAR) || '.jpg' AS url, k % 10 <> 0 AS ok
          FROM ev WHERE event_type = 'purchase') GROUP BY url),
att AS (SELECT man.*, res.ok FROM man LEFT JOIN res USING (url)),
per AS (SELECT uuid, bool_and(coalesce(ok, false)) AS media_ok, count(*) AS n_files FROM att GROUP BY uuid)"""


@query("a5_manifest", sql=f"WITH {EV_MEDIA_SQL}\nSELECT uuid, url, file_type, local_name FROM man")
def a5_manifest(spark, sf):
    arts, _, imgs = ev_media(spark, sf)
    return M.manifest(arts, imgs)


@query("j4_manifest_results", sql=f"WITH {EV_MEDIA_SQL}\nSELECT uuid, url, ok FROM att")
def j4_manifest_results(spark, sf):
    arts, results, imgs = ev_media(spark, sf)
    return M.attach_results(M.manifest(arts, imgs), results).select("uuid", "url", "ok")


@query("a2_media_ok", sql=f"WITH {EV_MEDIA_SQL}\nSELECT uuid, media_ok, n_files FROM per")
def a2_media_ok(spark, sf):
    arts, results, imgs = ev_media(spark, sf)
    return M.media_ok(M.attach_results(M.manifest(arts, imgs), results))


def ev_status(spark, sf):
    arts, results, imgs = ev_media(spark, sf)
    per = M.media_ok(M.attach_results(M.manifest(arts, imgs), results))
    a = arts.withColumn("others", F.struct(F.array().cast("array<string>").alias("tags"),
                                           F.lit(None).cast("string").alias("ref_uuid")))
    return M.with_status(a, per, pack_error=F.when(F.col("user_id") % 11 == 0, "disk full"))


EV_STATUS_SQL = f"""{EV_MEDIA_SQL},
st AS (SELECT 'u' || CAST(u.user_id AS VARCHAR) AS uuid, u.user_id,
         CASE WHEN u.user_id % 11 = 0 THEN 'packed_failed' WHEN NOT coalesce(p.media_ok, true) THEN 'downloaded_error' ELSE 'done' END AS status,
         CASE WHEN u.user_id % 11 = 0 THEN 'disk full' WHEN NOT coalesce(p.media_ok, true) THEN 'related files download error' ELSE 'ok' END AS status_msg,
         CASE WHEN NOT coalesce(p.media_ok, true) THEN 'downloaded_error' ELSE 'downloaded' END AS fetched
       FROM users u LEFT JOIN per p ON p.uuid = 'u' || CAST(u.user_id AS VARCHAR))"""


@query("c12_status", sql=f"WITH {EV_STATUS_SQL}\nSELECT uuid, status, status_msg FROM st")
def c12_status(spark, sf):
    return ev_status(spark, sf).select("uuid", "status", "status_msg")


@query("c13_route", sql=f"""WITH {EV_STATUS_SQL}
SELECT CASE WHEN status = 'done' THEN 'articles' ELSE 'failed_articles' END AS route, count(*) AS n FROM st GROUP BY 1""")
def c13_route(spark, sf):
    done, failed = M.route(ev_status(spark, sf))
    return (done.agg(F.count("*").alias("n")).select(F.lit("articles").alias("route"), "n")
            .unionByName(failed.agg(F.count("*").alias("n")).select(F.lit("failed_articles").alias("route"), "n"))
            .where(F.col("n") > 0))


@query("c14_ref_uuid", sql=f"WITH {EV_STATUS_SQL}\nSELECT uuid, uuid AS ref_uuid FROM st WHERE status <> 'done'")
def c14_ref_uuid(spark, sf):
    _, failed = M.route(ev_status(spark, sf))
    return failed.select("uuid", F.col("others.ref_uuid").alias("ref_uuid"))


@query("a6_run_report", sql=f"""
WITH {EV_SQL}
SELECT CAST(strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') AS BIGINT) AS batch_id, spider,
       CASE event_type WHEN 'error' THEN 'downloaded_error' WHEN 'purchase' THEN 'done' ELSE 'packed_failed' END AS status,
       count(*) AS n_items
FROM ev GROUP BY 1, 2, 3""")
def a6_run_report(spark, sf):
    a = ev_articles(spark, sf).select(
        D.batch_id(F.date_trunc("day", F.col("ts"))).alias("batch_id"), "spider",
        F.when(F.col("event_type") == "error", "downloaded_error").when(F.col("event_type") == "purchase", "done")
        .otherwise("packed_failed").alias("status"))
    return M.run_report(a)


@query("a6_counts_in_write", sql=f"""
WITH {EV_SQL}
SELECT CAST(20240131000000 AS BIGINT) AS batch_id, spider,
       CASE event_type WHEN 'error' THEN 'downloaded_error' WHEN 'purchase' THEN 'done' ELSE 'packed_failed' END AS status,
       count(*) AS n_items
FROM ev GROUP BY 1, 2, 3""")
def a6_counts_in_write(spark, sf):
    """One batch is stored and counted in the same pass."""
    a = ev_articles(spark, sf).select(
        "event_id", D.batch_id(RUN_TS).alias("batch_id"), "spider",
        F.when(F.col("event_type") == "error", "downloaded_error").when(F.col("event_type") == "purchase", "done")
        .otherwise("packed_failed").alias("status"))
    spiders = ["news_en", "other"]
    a, seen = M.counted(a, spiders)
    return M.counted_report(written(a, "articles"), seen, spiders)


@query("w7_running_counter", sql=f"""
WITH {EV_SQL}
SELECT event_id, spider, CAST(strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') AS BIGINT) AS batch_id,
       row_number() OVER (PARTITION BY spider, date_trunc('day', ts) ORDER BY ts, event_id) AS n
FROM ev""")
def w7_running_counter(spark, sf):
    from ..operators.windows import running_number
    a = ev_articles(spark, sf).withColumn("batch_id", D.batch_id(F.date_trunc("day", F.col("ts"))))
    return running_number(a, ["spider", "batch_id"], ["ts", "event_id"], "n").select(
        "event_id", "spider", "batch_id", "n")


# -- F5-F7, F14, F16, C10 over events --------------------------------------------------

@query("f5_record_id", sql=f"""
SELECT page_id, {Q.uuid_from("'pages'", 'url')} AS uuid FROM pages""")
def f5_record_id(spark, sf):
    return raw_pages(spark, sf).select("page_id", I.uuid_from(F.lit("pages"), F.col("url")).alias("uuid"))


@query("f6_data_uri", sql=f"""
SELECT event_id, substr(strftime(ts, '%Y%m%d%H%M%S'), 1, 6) || '/' || {Q.uuid_from('event_id')} AS data_uri FROM events""")
def f6_data_uri(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", I.data_uri(D.batch_id(F.col("ts")), I.uuid_from(F.col("event_id"))).alias("data_uri"))


@query("f7_picture_dir", sql="""
SELECT event_id, 'imgs/' || strftime(ts, '%Y%m%d') || '/' || event_type || '/' || strftime(ts, '%H%M%S') AS pic_dir FROM events""")
def f7_picture_dir(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", I.picture_dir("imgs/", F.col("event_type"), F.col("ts")).alias("pic_dir"))


@query("f16_regex_int", sql="""
SELECT event_id, TRY_CAST(NULLIF(regexp_extract(props, '"k": (\\d+)', 1), '') AS DECIMAL(38, 0)) AS k FROM events""")
def f16_regex_int(spark, sf):
    return events(spark, sf).select("event_id", X.regex_int(F.col("props"), r'"k": (\d+)').alias("k"))


@query("c10_non_null_keys", sql=f"""
WITH {EV_SQL}
SELECT event_id, concat_ws(',', 'event_id',
    CASE WHEN spider IS NOT NULL THEN 'spider' END,
    CASE WHEN event_type <> 'error' THEN 'source_addr' END,
    CASE WHEN k > 50 THEN 'category' END) AS keys
FROM ev""")
def c10_non_null_keys(spark, sf):
    a = ev_articles(spark, sf).select(
        "event_id", "spider", F.when(F.col("event_type") != "error", F.col("source_addr")).alias("source_addr"),
        F.when(F.col("k") > 50, F.col("title")).alias("category"))
    record = S.non_null_json(a, ("event_id", "spider", "source_addr", "category"))
    return a.select("event_id", F.array_join(F.json_object_keys(record), ",").alias("keys"))


# =============================================================================
# orders / customer: snapshot + changes
# =============================================================================

_ORD_SPLIT_OLD = "1996-01-01"
_ORD_SPLIT_NEW = "1995-07-01"


def _orders_old_new(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    d = F.col("o_orderdate").cast("timestamp_ntz")
    old = o.where(d < F.lit(_ORD_SPLIT_OLD).cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("title"),
        F.lit("new").alias("status"), F.lit("new").alias("status_msg"),
        d.alias("created_at"), d.alias("updated_at"))
    new = o.where(d >= F.lit(_ORD_SPLIT_NEW).cast("timestamp_ntz")).join(
        c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderkey").alias("key"),
        F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("c_mktsegment")).alias("title"),
        F.col("o_orderstatus").alias("ostatus"))
    return old, new


_ORD_SQL = f"""old AS (SELECT o_orderkey AS key, o_orderpriority AS title, 'new' AS status, 'new' AS status_msg,
                CAST(o_orderdate AS TIMESTAMP) AS created_at, CAST(o_orderdate AS TIMESTAMP) AS updated_at
              FROM orders WHERE o_orderdate < DATE '{_ORD_SPLIT_OLD}'),
new AS (SELECT o_orderkey AS key, o_orderpriority || '/' || c_mktsegment AS title, o_orderstatus AS ostatus
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= DATE '{_ORD_SPLIT_NEW}')"""


@query("s6_articles_upsert", sql=f"""
WITH {_ORD_SQL}
SELECT coalesce(o.key, n.key) AS key,
       CASE WHEN o.key IS NOT NULL THEN o.title ELSE n.title || CASE n.key % 3 WHEN 0 THEN '/c' WHEN 1 THEN '/b' ELSE '/a' END END AS title,
       CASE WHEN o.key IS NOT NULL THEN o.status ELSE 'done' END AS status,
       strftime(CASE WHEN o.key IS NOT NULL THEN o.created_at ELSE TIMESTAMP '{RUN_TS}' END, '%Y-%m-%d %H:%M:%S') AS created_at,
       strftime(CASE WHEN n.key IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE o.updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM old o FULL OUTER JOIN new n ON o.key = n.key""")
def s6_articles_upsert(spark, sf):
    old, new = _orders_old_new(spark, sf)
    # one to three rows for a key, the one to keep last in the table
    copies = F.filter(F.array(*map(F.lit, "abc")), lambda x, i: i <= F.col("key") % 3 * -1 + 2)
    batch = new.select("key", "title", F.explode(copies).alias("copy")).select(
        "key", F.concat("title", F.lit("/"), "copy").alias("title"), F.lit("done").alias("status"), F.lit("ok").alias("status_msg"), "copy")
    snap = S.upsert(old, batch, "key", RUN_TS, order=-F.ascii("copy"))
    return snap.select("key", "title", "status", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                       F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


@query("s7_failed_upsert", sql=f"""
WITH {_ORD_SQL},
b AS (SELECT key, title, 'downloaded_error' AS status, 'first' AS status_msg, 0 AS seq FROM new
      UNION ALL
      SELECT key, title, CASE ostatus WHEN 'F' THEN 'packed_failed' WHEN 'O' THEN 'downloaded_error' ELSE 'new' END,
             'second', 1 FROM new),
bf AS (SELECT key, arg_min(title, seq) AS title, arg_max(status, seq) AS status, arg_max(status_msg, seq) AS status_msg
       FROM b GROUP BY key)
SELECT coalesce(o.key, n.key) AS key,
       CASE WHEN o.key IS NOT NULL THEN o.title ELSE n.title END AS title,
       CASE WHEN n.key IS NOT NULL THEN n.status ELSE o.status END AS status,
       CASE WHEN n.key IS NOT NULL THEN n.status_msg ELSE o.status_msg END AS status_msg,
       strftime(CASE WHEN n.key IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE o.updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM old o FULL OUTER JOIN bf n ON o.key = n.key""")
def s7_failed_upsert(spark, sf):
    old, new = _orders_old_new(spark, sf)
    first = new.select("key", "title", F.lit("downloaded_error").alias("status"), F.lit("first").alias("status_msg"),
                       F.lit(0).alias("seq"))
    second = new.select("key", "title", F.when(F.col("ostatus") == "F", "packed_failed")
                        .when(F.col("ostatus") == "O", "downloaded_error").otherwise("new").alias("status"),
                        F.lit("second").alias("status_msg"), F.lit(1).alias("seq"))
    batch = first.unionByName(second)
    snap = S.upsert(old, batch, "key", RUN_TS, order=F.col("seq"), update_cols=("status", "status_msg"))
    return snap.select("key", "title", "status", "status_msg",
                       F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


# =============================================================================
# Pages: S1, S2, P2, P6-P11, P13-P15, P19, A7, W3, J1, J7, L1-L3, C6, C8, C9, F8-F15
# =============================================================================

import dataclasses as _dc  # noqa: E402

from ..operators.detail import page_fields as _page_fields, route_layouts  # noqa: E402
from ..operators.listing import page_types, join_details  # noqa: E402
from ..sources.tables import detail_pages, list_pages  # noqa: E402

_HOST_SQL = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
_PAGE_COUNTER_SQL = "coalesce(TRY_CAST(NULLIF(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS BIGINT), 0)"


@query("s1_list_pages", sql=f"SELECT page_id, url, {_PAGE_COUNTER_SQL} AS page_counter FROM pages")
def s1_list_pages(spark, sf):
    return list_pages(raw_pages(spark, sf), DRIVER_PAGES).select("page_id", "url", "page_counter")


@query("s2_detail_pages", sql="""
SELECT page_id, url, html LIKE '%<article>%' AS has_body FROM pages""")
def s2_detail_pages(spark, sf):
    p = detail_pages(raw_pages(spark, sf))
    roots = body_roots(page_nodes(spark, sf), DRIVER_PAGES).select("page_id", F.lit(True).alias("has_body"))
    return p.join(roots, "page_id", "left").select("page_id", "url", F.coalesce("has_body", F.lit(False)).alias("has_body"))


_TYPED = _dc.replace(DRIVER_PAGES, list_common_marker=sel(desc("article"), child("p"), child("b")))


@query("p2_list_page_type", sql="""
SELECT page_id, CASE WHEN html LIKE '%<p><b>%' THEN 'common' WHEN html LIKE '%<li>%' THEN 'async' ELSE 'error' END AS list_type
FROM pages""")
def p2_list_page_type(spark, sf):
    return page_types(page_nodes(spark, sf), _TYPED)


_CAT = _dc.replace(DRIVER_PAGES, category=sel(desc("nav"), desc("li"), child("a")), base_tags=("site",))
_FIRST_LINK_SQL = Q.pstrip(Q.unescape("regexp_extract(html, '<li><a href=\"[^\"]*\">([^<]*)</a>', 1)"))


@query("p8_category_tags", sql=f"""
SELECT page_id, category, 'site' || CASE WHEN category <> '' THEN '|' || category ELSE '' END AS tags
FROM (SELECT page_id, {_FIRST_LINK_SQL} AS category FROM pages)""")
def p8_category_tags(spark, sf):
    f = _page_fields(page_nodes(spark, sf), _CAT, RUN_TS)
    return f.select("page_id", "category", F.array_join("tags", "|").alias("tags"))


_PUB = _dc.replace(DRIVER_PAGES, pub_time=sel(desc("time")), cover_img=sel(desc("figure"), desc("img")))


_TIMED_SQL = """(CASE page_id % 4 WHEN 0 THEN '2024-01-0' || CAST(page_id % 9 + 1 AS VARCHAR) || ' 10:00'
    WHEN 1 THEN '2024-02-0' || CAST(page_id % 9 + 1 AS VARCHAR) || ' 08:30:00' WHEN 2 THEN 'Jan ' || CAST(page_id % 28 + 1 AS VARCHAR) || ', 2024' END)"""


def _timed_pages(spark, sf):
    """Pages with a ``<time>``: by attribute, by attribute in the future, by text only, without; half with a cover."""
    d = (F.col("page_id") % 9 + 1).cast("string")
    time = (F.when(F.col("page_id") % 4 == 0, F.concat(F.lit('<time datetime=" 2024-01-0'), d, F.lit(' 10:00 ">then</time>')))
            .when(F.col("page_id") % 4 == 1, F.concat(F.lit('<time datetime="2024-02-0'), d, F.lit(' 08:30:00">then</time>')))
            .when(F.col("page_id") % 4 == 2, F.concat(F.lit("<time> Jan "), (F.col("page_id") % 28 + 1).cast("string"),
                                                      F.lit(", 2024 </time>"))).otherwise(F.lit("")))
    cover = F.when(F.col("page_id") % 2 == 0, F.concat(
        F.lit('<figure><div><img src=" /c'), F.col("page_id").cast("string"), F.lit('.jpg " alt=" Cover '),
        F.col("page_id").cast("string"), F.lit('"></div><img src="/second.jpg"></figure>'))).otherwise(F.lit("<figure></figure>"))
    html = F.replace(F.col("html"), F.lit("</h1>"), F.concat(F.lit("</h1>"), time, cover))
    return raw_pages(spark, sf).select("page_id", "url", html.alias("html"))


@query("p6_pub_time", sql=f"""
SELECT page_id, {Q.news_date('raw')} AS public_datetime_str,
       CASE WHEN page_id % 4 < 2 THEN 'attr' WHEN page_id % 4 = 2 THEN 'text' ELSE 'run_ts' END AS pub_source
FROM (SELECT page_id, {_TIMED_SQL} AS raw FROM pages)""")
def p6_pub_time(spark, sf):
    f = _page_fields(nodes_by_page(_timed_pages(spark, sf)), _PUB, RUN_TS)
    return f.select("page_id", "public_datetime_str", "pub_source")


@query("p7_cover_image", sql="""
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/c' || CAST(page_id AS VARCHAR) || '.jpg' ELSE '' END AS content_pic,
       'content_pic.' AS info_url, CASE WHEN page_id % 2 = 0 THEN 'Cover ' || CAST(page_id AS VARCHAR) ELSE '' END AS info_alt
FROM pages""")
def p7_cover_image(spark, sf):
    f = _page_fields(nodes_by_page(_timed_pages(spark, sf)), _PUB, RUN_TS)
    return f.select("page_id", "content_pic", F.col("content_pic_info.url").alias("info_url"),
                    F.col("content_pic_info.alt").alias("info_alt"))


@query("p10_body_root", sql="SELECT page_id, 'article' AS root_tag FROM pages WHERE html LIKE '%<article>%'")
def p10_body_root(spark, sf):
    return body_roots(page_nodes(spark, sf), DRIVER_PAGES).select("page_id", "root_tag")


_SCOPED = _dc.replace(DRIVER_PAGES, header_scope=sel(desc("footer")))
_UNSCOPED = _dc.replace(DRIVER_PAGES, header_scope=sel(desc("aside")))


@query("p11_scope_guard", sql=f"""
SELECT page_id, {Q.pstrip(Q.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} AS title_scoped,
       '' AS title_unscoped FROM pages""")
def p11_scope_guard(spark, sf):
    n = page_nodes(spark, sf)
    a = _page_fields(n, _SCOPED, RUN_TS).select("page_id", F.col("title").alias("title_scoped"))
    b = _page_fields(n, _UNSCOPED, RUN_TS).select("page_id", F.col("title").alias("title_unscoped"))
    return a.join(b, "page_id")


# One div of each kind, and loose text, put at the start of the article by page id.
_DIVS = (
    '<div><div class="x media-pholder">p</div></div>', '<div><div class="quiz">q</div><figure class="media-image"></figure></div>',
    '<div><div class="external-content-placeholder"></div></div>',
    '<div><iframe src="v"><script src="https://youtube.example/x"></script></iframe></div>',
    '<div><iframe src="v"><script>var a = 1;</script><script>youtube</script></iframe></div>',
    '<div><figure class="media-image"><div class="thumb"><img src="/p.png" alt="a"></div></figure></div>',
    '<div class="clear">nothing known</div>')
_DIV_CLASSES = ("main_audio", "quiz", "content_video", "content_video", None, "content_image", "unknown")


def _block_pages(spark, sf):
    div = F.element_at(F.array(*map(F.lit, _DIVS)), (F.col("page_id") % len(_DIVS) + 1).cast("int"))
    loose = F.when(F.col("page_id") % 3 == 0, " loose text ").when(F.col("page_id") % 3 == 1, " \n ").otherwise("")
    html = F.replace(F.col("html"), F.lit("<article>"), F.concat(F.lit("<article>"), loose, div, F.lit("<!-- c -->")))
    return raw_pages(spark, sf).select("page_id", "url", html.alias("html"))


@query("p13_loose_text", sql="""
SELECT page_id, CAST(page_id % 3 < 2 AS INTEGER) AS n_loose, CAST(page_id % 3 = 0 AS INTEGER) AS n_loose_not_blank,
       1 AS n_comments FROM pages""")
def p13_loose_text(spark, sf):
    c = classify_pass1(blocks_from_nodes(nodes_by_page(_block_pages(spark, sf), (HtmlScope("article"),)), DRIVER_PAGES), DRIVER_PAGES)
    loose = F.col("action") == "loose_text"
    return c.groupBy("page_id").agg(
        F.sum(loose.cast("int")).cast("int").alias("n_loose"),
        F.sum((loose & (X.pstrip(F.col("text")) != "")).cast("int")).cast("int").alias("n_loose_not_blank"),
        F.sum(((F.col("kind") == "comment") & (F.col("action") == "keep")).cast("int")).cast("int").alias("n_comments"))


_DIV_CLASS_SQL = "(CASE page_id % 7 " + " ".join(
    f"WHEN {i} THEN " + (f"'{c}'" if c else "NULL") for i, c in enumerate(_DIV_CLASSES)) + " END)"


@query("p14_div_class", sql=f"SELECT page_id, {_DIV_CLASS_SQL} AS div_class FROM pages")
def p14_div_class(spark, sf):
    b = blocks_from_nodes(nodes_by_page(_block_pages(spark, sf), (HtmlScope("article"),)), DRIVER_PAGES)
    return b.where(F.col("tag") == "div").select("page_id", "div_class")


@query("p15_dispatch", sql=f"""
SELECT page_id, CASE WHEN {_DIV_CLASS_SQL} = 'content_image' THEN 'keep' ELSE 'drop_div' END AS div_action,
       n_other, n_other AS n_kept
FROM (SELECT page_id, len(regexp_extract_all(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>|<h1>')) AS n_other FROM pages)""")
def p15_dispatch(spark, sf):
    c = classify_pass1(blocks_from_nodes(nodes_by_page(_block_pages(spark, sf), (HtmlScope("article"),)), DRIVER_PAGES), DRIVER_PAGES)
    other = (F.col("kind") == "element") & (F.col("tag") != "div")
    return c.groupBy("page_id").agg(F.max(F.when(F.col("tag") == "div", F.col("action"))).alias("div_action"),
                                    F.count(F.when(other, 1)).alias("n_other"),
                                    F.count(F.when(other & (F.col("action") == "keep"), 1)).alias("n_kept"))


@query("p19_image_rewrite", sql=f"""
SELECT page_id, pos, 'content_image_' || CAST(pos AS VARCHAR) AS id,
       'content_image_' || CAST(pos AS VARCHAR) || '.' || itype AS url,
       printf('{I.IMAGE_TEMPLATE.replace("{p}", "pm").replace(chr(10), "' || chr(10) || '")}',
              'content_image_div_' || CAST(pos AS VARCHAR), 'content_image_' || CAST(pos AS VARCHAR), '',
              'content_image_' || CAST(pos AS VARCHAR) || '.' || itype, ori, '') AS html
FROM (SELECT page_id, pos, ori, CASE WHEN lower(regexp_extract(ori, '([^./]*)$', 1)) IN ('png','jpg','jpeg','bmp','webp')
                                     THEN lower(regexp_extract(ori, '([^./]*)$', 1)) ELSE 'unknown' END AS itype
      FROM (SELECT page_id, unnest(h) AS ori, unnest(range(1, len(h) + 1)) AS pos
            FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages)))""")
def p19_image_rewrite(spark, sf):
    e = list_entries(page_nodes(spark, sf), DRIVER_PAGES)
    none = F.lit(None).cast("string")
    blocks = e.select("page_id", "pos", F.col("pos").alias("block_id"), F.lit("element").alias("kind"),
                      F.lit("div").alias("tag"), none.alias("cls"), F.lit("").alias("text"), F.lit("").alias("em_text"),
                      F.lit(False).alias("has_em"), none.alias("html"), F.lit("content_image").alias("div_class"),
                      F.concat(F.lit(" "), F.col("entry_uri")).alias("img_src"), none.alias("img_alt"))
    return classify_pass1(blocks, DRIVER_PAGES).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "img.id", "img.url", "html")


@query("a7_em_text", sql=f"""
WITH {Q.article_blocks_cte()}
SELECT page_id, ord, seg LIKE '%<b>%' AS has_em,
       CASE WHEN seg LIKE '%<b>%' THEN {Q.unescape(Q.strip_tags("regexp_extract(seg, '(?s)<b>(.*)$', 1)"))} ELSE '' END AS em_text
FROM ablocks""")
def a7_em_text(spark, sf):
    b = blocks_from_nodes(page_nodes(spark, sf), DRIVER_PAGES, em_tag="b")
    w = Window.partitionBy("page_id").orderBy("pos")
    return b.select("page_id", F.row_number().over(w).cast("bigint").alias("ord"), "has_em", "em_text")


@query("w3_image_counter", sql=f"""
WITH {Q.article_blocks_cte()}
SELECT page_id, ord, CASE WHEN seg LIKE '%<b>%' THEN
         count(*) FILTER (WHERE seg LIKE '%<b>%') OVER (PARTITION BY page_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       END AS img_no
FROM ablocks""")
def w3_image_counter(spark, sf):
    b = blocks_from_nodes(page_nodes(spark, sf), DRIVER_PAGES, em_tag="b")
    b = b.withColumn("tag", F.when(F.col("has_em"), "div").otherwise(F.col("tag"))) \
        .withColumn("div_class", F.when(F.col("has_em"), "content_image"))
    c = classify_pass1(b, DRIVER_PAGES)
    w = Window.partitionBy("page_id").orderBy("pos")
    return c.select("page_id", F.row_number().over(w).cast("bigint").alias("ord"), F.col("img_no").cast("bigint").alias("img_no"))


@query("l3_block_order", sql=f"""
WITH {Q.article_blocks_cte()}
SELECT page_id, string_agg(regexp_extract(seg, '^<([a-z0-9]+)', 1), ',' ORDER BY ord) AS tags FROM ablocks GROUP BY page_id""")
def l3_block_order(spark, sf):
    b = blocks_from_nodes(page_nodes(spark, sf), DRIVER_PAGES)
    return b.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tag"))),
                                                             lambda x: x["tag"]), ",").alias("tags"))


@query("l1_first_footer_text", sql=f"""
SELECT page_id, coalesce({Q.unescape("regexp_extract(html, '<footer>([^<]*)', 1)")}, '') AS footer_text FROM pages""")
def l1_first_footer_text(spark, sf):
    from ..operators.select import first_value
    n = page_nodes(spark, sf)
    t = select_text(n, sel(desc("footer")))
    f = first_value(t, ["page_id"], F.col("text"), "footer_text", default="")
    return raw_pages(spark, sf).select("page_id").join(f, "page_id", "left").select(
        "page_id", F.coalesce("footer_text", F.lit("")).alias("footer_text"))


@query("j7_axes", sql="""
SELECT page_id, len(regexp_extract_all(html, '<a ')) AS n_desc_a, len(regexp_extract_all(html, '<li>')) AS n_child_li FROM pages""")
def j7_axes(spark, sf):
    n = page_nodes(spark, sf)
    from ..operators.listing import _elem
    return n.groupBy("page_id").agg(
        F.count(F.when(_elem(sel(desc("nav"), desc("a"))), 1)).alias("n_desc_a"),
        F.count(F.when(_elem(sel(desc("ul"), child("li"))), 1)).alias("n_child_li"))


_ENTRY_URLS_SQL = """ent AS (
  SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || href AS entry_url, pos
  FROM (SELECT page_id, url, unnest(h) AS href, unnest(range(1, len(h) + 1)) AS pos
        FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages)))"""


@query("j1_entry_detail", sql=f"""
WITH {_ENTRY_URLS_SQL},
det AS (SELECT e.page_id AS detail_id, e.entry_url AS url,
               {Q.pstrip(Q.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} AS title
        FROM ent e JOIN pages p USING (page_id) WHERE e.pos = 2)
SELECT ent.page_id, ent.pos, det.detail_id, det.title FROM ent JOIN det ON ent.entry_url = det.url""")
def j1_entry_detail(spark, sf):
    """Entries of every list page; a page's own fields stand for the detail page behind its second entry."""
    n = page_nodes(spark, sf)
    meta = list_pages(raw_pages(spark, sf), DRIVER_PAGES).select("page_id", "url", "page_counter", F.lit("pages").alias("source"))
    ents = resolve_entries(list_entries(n, DRIVER_PAGES), meta, RUN_TS).where(F.col("reason").isNull()).drop("url")
    ents = ents.checkpoint()      # read twice below
    titles = _page_fields(n, DRIVER_PAGES, RUN_TS).select("page_id", "title")
    det = ents.where(F.col("pos") == 2).select("page_id", F.col("entry_url").alias("url")).join(titles, "page_id").select(
        F.col("page_id").alias("detail_id"), "url", "title")
    return join_details(ents, det).select("page_id", F.col("pos").cast("bigint").alias("pos"), "detail_id", "title")


_MANY_SQL = "page_id % 150"


@query("l2_page_cap", sql=f"""
WITH p AS (SELECT page_id, 'src' || CAST(page_id // 150 % 4 AS VARCHAR) AS source, {_MANY_SQL} AS page_counter,
                  page_id % 150 = 137 OR page_id // 150 = 1 AND page_id % 150 = 40 AS bare FROM pages),
stop AS (SELECT source, min(page_counter) AS empty FROM p WHERE bare GROUP BY source)
SELECT page_id, source, page_counter FROM p LEFT JOIN stop USING (source)
WHERE page_counter <= 100 AND (empty IS NULL OR page_counter < empty)""")
def l2_page_cap(spark, sf):
    """L2's own limit of 100 list pages; page 137 of every source, and page 40 of one, have no entries."""
    i, block = F.col("page_id"), F.floor(F.col("page_id") / 150)
    bare = (i % 150 == 137) | ((block == 1) & (i % 150 == 40))
    p = raw_pages(spark, sf).select(
        "page_id", F.concat(F.lit("https://src"), (block % 4).cast("string"), F.lit(".example.org/z?page="),
                            (i % 150).cast("string")).alias("url"),
        F.when(bare, F.lit("<html><body></body></html>")).otherwise(F.col("html")).alias("html"))
    lp = list_pages(p, DRIVER_PAGES).withColumn("source", F.regexp_extract(U.url_parts(F.col("url"))["netloc"], "^src[0-9]", 0))
    sizes = list_entries(nodes_by_page(p), DRIVER_PAGES).groupBy("page_id").agg(F.count("*").alias("n_entries"))
    ps = lp.join(sizes, "page_id", "left").withColumn("n_entries", F.coalesce("n_entries", F.lit(0)))
    kept = take_while(ps.withColumn("pos", F.lit(0)).withColumn("public_datetime", F.lit(RUN_TS).cast("timestamp_ntz")),
                      F.lit(24), RUN_TS, max_page=100,
                      page_sizes=ps.select("source", "page_counter", "n_entries"))
    return kept.select("page_id", "source", "page_counter")


@query("c6_constants", sql=f"""
SELECT page_id, {Q.uuid_from("'pages'", 'url')} AS uuid, 'pages' AS spider, 'new' AS status, 'new' AS status_msg,
       CAST(20240131000000 AS BIGINT) AS batch_id, '202401/' || {Q.uuid_from("'pages'", 'url')} AS data_uri FROM pages""")
def c6_constants(spark, sf):
    p = raw_pages(spark, sf)
    uid = I.uuid_from(F.lit("pages"), F.col("url"))
    bid = D.batch_id(RUN_TS)
    return p.select("page_id", uid.alias("uuid"), F.lit("pages").alias("spider"), F.lit("new").alias("status"),
                    F.lit("new").alias("status_msg"), bid.alias("batch_id"), I.data_uri(bid, uid).alias("data_uri"))


_LAYOUTS = {"common": DRIVER_PAGES, "footed": _dc.replace(DRIVER_PAGES, title=sel(desc("title")), layout="footed")}


@query("c9_layout_routing", sql=f"""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'footed' ELSE 'common' END AS layout,
       CASE WHEN page_id % 3 = 0 THEN {Q.pstrip(Q.unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)"))}
            ELSE {Q.pstrip(Q.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} END AS title
FROM pages WHERE page_id % 7 <> 0""")
def c9_layout_routing(spark, sf):
    """A layout of each page, an extractor for each layout; pages of an unknown layout give nothing."""
    layout = (F.when(F.col("page_id") % 7 == 0, "unknown").when(F.col("page_id") % 3 == 0, "footed").otherwise("common"))
    routed = raw_pages(spark, sf).select("page_id", layout.alias("layout"))
    return route_layouts(routed, page_nodes(spark, sf), _LAYOUTS, RUN_TS).select("page_id", "layout", "title")


# Ten layouts: odd ones take their title from the head, each has a tag of its own.
_TEN_LAYOUTS = {f"l{k}": _dc.replace(DRIVER_PAGES, title=sel(desc("title")) if k % 2 else DRIVER_PAGES.title, layout=f"l{k}",
                                     base_tags=(f"t{k}",) if k else ()) for k in range(10)}


@query("c9_ten_layouts", sql=f"""
SELECT page_id, 'l' || CAST(page_id % 11 AS VARCHAR) AS layout, CASE WHEN page_id % 11 > 0 THEN 't' || CAST(page_id % 11 AS VARCHAR) END AS tag,
       CASE WHEN page_id % 11 % 2 = 1 THEN {Q.pstrip(Q.unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)"))}
            ELSE {Q.pstrip(Q.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} END AS title
FROM pages WHERE page_id % 11 <> 10""")
def c9_ten_layouts(spark, sf):
    """Ten extractors in one pass over the nodes; an eleventh layout is unknown."""
    routed = raw_pages(spark, sf).select("page_id", F.concat(F.lit("l"), (F.col("page_id") % 11).cast("string")).alias("layout"))
    return route_layouts(routed, page_nodes(spark, sf), _TEN_LAYOUTS, RUN_TS).select(
        "page_id", "layout", F.get("tags", F.lit(0)).alias("tag"), "title")


@query("f8_content_id", sql=f"""
SELECT page_id, '0_pages_' || md5({Q.pstrip(Q.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))}) AS content_id FROM pages""")
def f8_content_id(spark, sf):
    p = raw_pages(spark, sf).join(_page_fields(page_nodes(spark, sf), DRIVER_PAGES, RUN_TS).select("page_id", "title"), "page_id")
    return p.select("page_id", I.content_id(F.lit("pages"), F.col("url"), F.col("title"), ("pages",), RUN_TS,
                                            F.lit(0)).alias("content_id"))


@query("f9_url_join", sql=f"""
SELECT page_id, pos, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || href AS entry_url
FROM (SELECT page_id, url, unnest(h) AS href, unnest(range(1, len(h) + 1)) AS pos
      FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages))""")
def f9_url_join(spark, sf):
    e = list_entries(page_nodes(spark, sf), DRIVER_PAGES).join(raw_pages(spark, sf).select("page_id", "url"), "page_id")
    return e.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                    U.url_join(F.col("url"), F.col("entry_uri")).alias("entry_url"))


_PATH_SQL = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


@query("f10_file_type", sql=f"""
SELECT page_id, ftype AS file_type, CASE WHEN lower(ftype) IN ('png','jpg','jpeg','bmp','webp') THEN lower(ftype) ELSE 'unknown' END AS image_type
FROM (SELECT page_id, regexp_extract(regexp_extract({_PATH_SQL}, '([^/]*)$', 1), '([^.]*)$', 1) AS ftype FROM pages)""")
def f10_file_type(spark, sf):
    p = raw_pages(spark, sf)
    return p.select("page_id", U.url_file_type(F.col("url")).alias("file_type"), U.image_type(F.col("url")).alias("image_type"))


@query("f11_next_page", sql=f"""
SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) || '?page=' || CAST({_PAGE_COUNTER_SQL} + 1 AS VARCHAR) ||
       CASE WHEN regexp_extract(url, '#(.*)$', 1) <> '' THEN '#' || regexp_extract(url, '#(.*)$', 1) ELSE '' END AS next_url
FROM pages""")
def f11_next_page(spark, sf):
    lp = list_pages(raw_pages(spark, sf), DRIVER_PAGES)
    return lp.select("page_id", U.next_page_url(F.col("url"), F.col("page_counter") + 1, "page").alias("next_url"))


@query("f15_basename_join", sql=f"""
SELECT page_id, base, 'exports/' || CAST(page_id AS VARCHAR) || '/' || base AS local_path
FROM (SELECT page_id, regexp_extract({_PATH_SQL}, '([^/]*)$', 1) AS base FROM pages)""")
def f15_basename_join(spark, sf):
    p = raw_pages(spark, sf)
    base = U.url_basename(F.col("url"))
    return p.select("page_id", base.alias("base"),
                    U.path_join(F.lit("exports"), F.col("page_id").cast("string"), base).alias("local_path"))


@query("f21_fetchable_urls", sql=f"""
SELECT page_id, array_to_string(list_filter(list_transform(list_prepend(url, h), lambda x: {Q.pstrip('x')}),
                                lambda x: starts_with(x, 'http') OR starts_with(x, 'ftp')), ' ') AS urls
FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages)""")
def f21_fetchable_urls(spark, sf):
    e = list_entries(page_nodes(spark, sf), DRIVER_PAGES)
    hrefs = e.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "entry_uri"))),
                                                 lambda x: x["entry_uri"]).alias("h"))
    p = raw_pages(spark, sf).join(hrefs, "page_id", "left")
    arr = F.concat(F.array(F.col("url")), F.coalesce("h", F.array().cast("array<string>")))
    return p.select("page_id", F.array_join(U.keep_fetchable(arr), " ").alias("urls"))


@query("f22_numbered_paths", sql=f"""
SELECT page_id, array_to_string(list_transform(h, lambda x, i: 'pics/' || CAST(page_id AS VARCHAR) || '_' || CAST(i - 1 AS VARCHAR) || '.jpg'), ' ') AS paths,
       len(list_distinct(h)) AS n_distinct
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages)""")
def f22_numbered_paths(spark, sf):
    e = list_entries(page_nodes(spark, sf), DRIVER_PAGES)
    h = e.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "entry_uri"))),
                                             lambda x: x["entry_uri"]).alias("h"))
    pid = F.col("page_id").cast("string")
    return h.select("page_id", F.array_join(U.numbered_paths(F.lit("pics"), pid, F.col("h")), " ").alias("paths"),
                    F.size(U.url_to_path_map(F.lit("pics"), pid, F.col("h"))).alias("n_distinct"))


@query("f24_unify_br", sql=f"""
SELECT page_id, regexp_replace(replace({Q.ARTICLE_INNER}, '<br>', '<br/><br />'), '(<br */>)+', '<br />', 'g') AS html FROM pages""")
def f24_unify_br(spark, sf):
    p = raw_pages(spark, sf)
    inner = F.regexp_extract(F.col("html"), r"(?s)<article>(.*)</article>", 1)
    return p.select("page_id", X.unify_br(F.replace(inner, F.lit("<br>"), F.lit("<br/><br />"))).alias("html"))


# =============================================================================
# Documents as blocks: P16-P18, P23, W2, W4, W5, A3, C8, F12, F17-F20, F23, A9
# =============================================================================

_LINES_SQL = """lines AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS pos, len(s) AS n_lines
  FROM (SELECT doc_id, string_split(txt, chr(10)) AS s FROM docs))"""

_RULER_DOCS_SQL = "docs AS (SELECT doc_id, text || chr(10) || repeat('_', 10 + CAST(doc_id % 3 AS INTEGER)) AS txt FROM documents)"


@query("p16_rulers", sql=f"""
WITH {_RULER_DOCS_SQL}, {_LINES_SQL}
SELECT doc_id, count(*) FILTER (WHERE regexp_full_match({Q.pstrip('line')}, '_{{11,}}')) AS n_rulers FROM lines GROUP BY doc_id""")
def p16_rulers(spark, sf):
    d = docs(spark, sf).select("doc_id", F.concat(F.col("text"), F.lit("\n"),
                                                  F.repeat(F.lit("_"), (F.col("doc_id") % 3 + 10).cast("int"))).alias("text"))
    c = classify_pass1(blocks_from_lines(d), DRIVER_PAGES)
    return c.groupBy(F.col("page_id").alias("doc_id")).agg(F.count(F.when(F.col("action") == "ruler", 1)).alias("n_rulers"))


_LICENSE = "licensed under the apache license, version 2.0."
_DOC_SPEC = _dc.replace(DRIVER_PAGES, footer_markers=(_LICENSE,))
_PLAIN_DOCS_SQL = "docs AS (SELECT doc_id, text AS txt FROM documents)"
_FOOTER_SQL = f"""mk AS (SELECT doc_id, min(pos) AS mpos FROM lines
                WHERE lower({Q.pstrip('line')}) = '{_LICENSE}' GROUP BY doc_id)"""


@query("p17_footer_split", sql=f"""
WITH {_PLAIN_DOCS_SQL}, {_LINES_SQL}, {_FOOTER_SQL}
SELECT l.doc_id, count(*) FILTER (WHERE mk.mpos IS NOT NULL AND l.pos >= mk.mpos) AS n_footer
FROM lines l LEFT JOIN mk USING (doc_id) GROUP BY l.doc_id""")
def p17_footer_split(spark, sf):
    c = classify_pass1(blocks_from_lines(docs(spark, sf)), _DOC_SPEC)
    return c.groupBy(F.col("page_id").alias("doc_id")).agg(F.count(F.when(F.col("action") == "footer", 1)).alias("n_footer"))


@query("p23_footer_text", sql=f"""
WITH {_PLAIN_DOCS_SQL}, {_LINES_SQL}, {_FOOTER_SQL}
SELECT l.doc_id, coalesce({Q.clean_lines("string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE mk.mpos IS NOT NULL AND l.pos >= mk.mpos)")}, '') AS footer_text
FROM lines l LEFT JOIN mk USING (doc_id) GROUP BY l.doc_id""")
def p23_footer_text(spark, sf):
    return clean_text(docs(spark, sf), _DOC_SPEC).select("doc_id", "footer_text")


_MIT = "released under the mit license."


@query("w2_sticky_flag", sql=f"""
WITH {_PLAIN_DOCS_SQL}, {_LINES_SQL},
f AS (SELECT doc_id, pos, max(CASE WHEN lower({Q.pstrip('line')}) = '{_MIT}' THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS flag FROM lines)
SELECT doc_id, CAST(sum(flag) AS BIGINT) AS n_after_marker FROM f GROUP BY doc_id""")
def w2_sticky_flag(spark, sf):
    spec = _dc.replace(DRIVER_PAGES, footer_markers=(_MIT,))
    c = classify_pass1(blocks_from_lines(docs(spark, sf)), spec)
    return c.groupBy(F.col("page_id").alias("doc_id")).agg(F.sum(F.col("in_footer").cast("bigint")).alias("n_after_marker"))


_SIGNOFF_DOCS_SQL = """docs AS (SELECT doc_id, text || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'I am reporting live.' ELSE 'I’m Jane Q Public Doe Junior.' END
                   || chr(10) || '   ' || chr(10) || 'Closing words here.' AS txt FROM documents)"""


def _signoff_docs(spark, sf):
    d = docs(spark, sf)
    line = F.when(F.col("doc_id") % 2 == 0, F.lit("I am reporting live.")).otherwise(F.lit("I’m Jane Q Public Doe Junior."))
    return d.select("doc_id", F.concat(F.col("text"), F.lit("\n"), line, F.lit("\n   \nClosing words here.")).alias("text"))


def _signoff_sql(prefixes, window=20) -> str:
    low = f"lower({Q.pstrip('line')})"
    starts = " OR ".join(f"starts_with({low}, '{p.replace(chr(39), chr(39) * 2)}')" for p in prefixes)
    nw = f"len(list_filter(string_split_regex({low}, '{_WS}+'), lambda w: w <> ''))"
    return f"""so AS (SELECT doc_id, max(pos) AS signoff FROM lines
             WHERE pos > n_lines - {window} AND {nw} BETWEEN 2 AND 5 AND ({starts}) GROUP BY doc_id)"""


@query("p18_trailing_credit", sql=f"""
WITH {_SIGNOFF_DOCS_SQL}, {_LINES_SQL}, {_signoff_sql(DRIVER_PAGES.signoff_prefixes)},
m AS (SELECT l.*, so.signoff, (so.signoff IS NOT NULL AND l.pos >= so.signoff AND {Q.pstrip('l.line')} = '') AS credit
      FROM lines l LEFT JOIN so USING (doc_id))
SELECT doc_id, any_value(signoff) AS signoff_pos, count(*) FILTER (WHERE credit) AS n_credit,
       {Q.clean_lines("string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT credit)")} AS formatted_text
FROM m GROUP BY doc_id""")
def p18_trailing_credit(spark, sf):
    return clean_text(_signoff_docs(spark, sf), DRIVER_PAGES).select("doc_id", "signoff_pos", "n_credit", "formatted_text")


_THE_SPEC = _dc.replace(DRIVER_PAGES, signoff_prefixes=("the",))


@query("w5_last_match", sql=f"""
WITH {_PLAIN_DOCS_SQL}, {_LINES_SQL}, {_signoff_sql(("the",))}
SELECT d.doc_id, so.signoff AS signoff_pos FROM documents d LEFT JOIN so USING (doc_id)""")
def w5_last_match(spark, sf):
    b = blocks_from_lines(docs(spark, sf))
    t = signoff_trim(b, _THE_SPEC)
    return t.groupBy(F.col("page_id").alias("doc_id")).agg(F.max("signoff").alias("signoff_pos"))


@query("w4_last_rows", sql=f"""
WITH {_PLAIN_DOCS_SQL}, {_LINES_SQL}
SELECT doc_id, count(*) FILTER (WHERE pos > n_lines - 20) AS n_last, min(pos) FILTER (WHERE pos > n_lines - 20) AS first_last_pos
FROM lines GROUP BY doc_id""")
def w4_last_rows(spark, sf):
    r = signoff_trim(blocks_from_lines(docs(spark, sf)), _THE_SPEC).where(F.col("from_end") <= _THE_SPEC.signoff_window)
    return r.groupBy(F.col("page_id").alias("doc_id")).agg(F.count("*").alias("n_last"),
                                                           F.min("pos").cast("bigint").alias("first_last_pos"))


@query("a3_ordered_concat", sql=f"""
WITH {_PLAIN_DOCS_SQL}, {_LINES_SQL}
SELECT doc_id, coalesce(string_agg(line, ' | ' ORDER BY pos) FILTER (
  WHERE len(list_filter(string_split_regex(line, '{_WS}+'), lambda w: w <> '')) > 3), '') AS long_lines
FROM lines GROUP BY doc_id""")
def a3_ordered_concat(spark, sf):
    from ..operators.blocks import _ordered_concat
    b = blocks_from_lines(docs(spark, sf))
    return b.groupBy(F.col("page_id").alias("doc_id")).agg(
        _ordered_concat(F.when(X.word_count(F.col("text")) > 3, F.col("text")), F.col("pos"), " | ").alias("long_lines"))


@query("c8_quality_gate", sql=f"""
SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE {Q.clean_lines('d.text')} <> '' AND coalesce(l.quality, 1) = 1""")
def c8_quality_gate(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    d = docs(spark, sf).join(lab, "doc_id", "left").withColumn("ok", X.clean_lines(F.col("text")) != "")
    return quality_gate(d, F.col("ok"), F.coalesce(F.col("quality"), F.lit(1)) == 1).select("doc_id")


@query("f12_word_strip", sql=f"""
SELECT doc_id, lower({Q.pstrip('text')}) AS low, starts_with(lower({Q.pstrip('text')}), 'the') AS starts_the,
       array_to_string(list_transform(list_filter(string_split_regex(lower(text), '{_WS}+'), lambda w: w <> ''),
                                      lambda w: trim(w, '{_PUNCT}')), ' ') AS words
FROM documents""")
def f12_word_strip(spark, sf):
    low = F.lower(X.pstrip(F.col("text")))
    return docs(spark, sf).select("doc_id", low.alias("low"), low.startswith("the").alias("starts_the"),
                                  F.array_join(F.transform(X.pwords(F.lower(F.col("text"))), X.strip_punct), " ").alias("words"))


def _inject_spark(c):
    return F.concat(F.lit("　  "), c, F.lit(" &nbsp;\tx&#x3000;\r\U0001F600 end​"))


_INJECT_SQL = ("(chr(12288) || ' ' || chr(160) || {x} || chr(160) || '&nbsp;' || chr(9) || 'x&#x3000;' || chr(13) || "
               "chr(128512) || ' end' || chr(8203))")


@query("f17_clean_line", sql=f"""
SELECT doc_id, regexp_replace({Q.pstrip(_INJECT_SQL.format(x='text'))}, '{_ILLEGAL}', '', 'g') AS cleaned FROM documents""")
def f17_clean_line(spark, sf):
    return docs(spark, sf).select("doc_id", X.clean_illegal_line(_inject_spark(F.col("text"))).alias("cleaned"))


@query("f18_drop_emoji", sql=f"""
SELECT doc_id, regexp_replace({Q.pstrip(_INJECT_SQL.format(x='text'))}, '{_NON_BMP}', '', 'g') AS cleaned FROM documents""")
def f18_drop_emoji(spark, sf):
    return docs(spark, sf).select("doc_id", X.drop_non_bmp(_inject_spark(F.col("text"))).alias("cleaned"))


@query("f19_clean_line_list", sql=f"""
SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x:
   regexp_replace({Q.pstrip("regexp_replace(" + Q.pstrip(_INJECT_SQL.format(x='x')) + ", '" + _ILLEGAL + "', '', 'g')")}, '{_NON_BMP}', '', 'g')), chr(10)) AS cleaned
FROM documents""")
def f19_clean_line_list(spark, sf):
    arr = F.transform(F.split(F.col("text"), "\n"), _inject_spark)
    return docs(spark, sf).select("doc_id", F.array_join(X.clean_line_list(arr), "\n").alias("cleaned"))


@query("f20_empty_strip", sql=f"""
SELECT doc_id, regexp_replace({_INJECT_SQL.format(x='text')}, '^{_ENDS}+|{_ENDS}+$', '', 'g') AS stripped FROM documents""")
def f20_empty_strip(spark, sf):
    return docs(spark, sf).select("doc_id", X.empty_strip(_inject_spark(F.col("text"))).alias("stripped"))


@query("f23_full_to_half", sql=f"""
SELECT doc_id, translate('ＡＢＣ１２３－ｘｙｚ ' || text, '{_FULL}', '{_HALF}') AS half FROM documents""")
def f23_full_to_half(spark, sf):
    return docs(spark, sf).select("doc_id", X.full_to_half(F.concat(F.lit("ＡＢＣ１２３－ｘｙｚ "), F.col("text"))).alias("half"))


@query("a9_simhash", sql="""
WITH n AS (SELECT doc_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}_]+', '', 'g') AS c FROM documents),
sh AS (SELECT doc_id, substr(c, i, 4) AS f FROM (SELECT doc_id, c, unnest(range(1, greatest(length(c) - 3, 1) + 1)) AS i FROM n)),
fw AS (SELECT doc_id, f, count(*) AS w, CAST(('0x' || substr(md5(f), 17, 8)) AS BIGINT) AS hi,
              CAST(('0x' || substr(md5(f), 25, 8)) AS BIGINT) AS lo FROM sh GROUP BY doc_id, f),
bits AS (SELECT doc_id, b, sum(CASE WHEN ((CASE WHEN b < 32 THEN lo ELSE hi END) >> (b % 32)) & 1 = 1 THEN w ELSE -w END) AS v
         FROM (SELECT *, unnest(range(0, 64)) AS b FROM fw) GROUP BY doc_id, b),
fp AS (SELECT doc_id, CAST(sum(CASE WHEN b >= 32 AND v > 0 THEN CAST(1 AS BIGINT) << (b - 32) ELSE 0 END) AS BIGINT) AS hi,
              CAST(sum(CASE WHEN b < 32 AND v > 0 THEN CAST(1 AS BIGINT) << b ELSE 0 END) AS BIGINT) AS lo FROM bits GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN coalesce(hi, 0) >= 2147483648 THEN CAST(coalesce(hi, 0) AS HUGEINT) * 4294967296 + coalesce(lo, 0) - CAST(18446744073709551616 AS HUGEINT)
            ELSE CAST(coalesce(hi, 0) AS HUGEINT) * 4294967296 + coalesce(lo, 0) END AS VARCHAR) AS simhash,
       coalesce(hi, 0) AS hi, coalesce(lo, 0) AS lo
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN fp USING (doc_id)""")
def a9_simhash(spark, sf):
    return simhash(docs(spark, sf))


# =============================================================================
# Incremental mode: T1-T3 (Structured Streaming + foreachBatch)
# =============================================================================

import uuid as _uuid  # noqa: E402

from ..streaming import incremental as INC  # noqa: E402
from ..streaming.seen import dedup_stream  # noqa: E402


def _run_dir(spark, name):
    return INC.scratch_dir(spark, f"{name}-{_uuid.uuid4().hex[:12]}")


@query("t1_stream_lookback", sql=f"""
SELECT event_id FROM events WHERE ts >= TIMESTAMP '{RUN_TS}' - INTERVAL 240 HOUR""")
def t1_stream_lookback(spark, sf):
    schema = events(spark, sf).schema
    s = INC.stream_table(spark, sf, schema, glob="events.parquet")
    kept = INC.lookback_filter(s.select("event_id", "ts"), "ts", RUN_TS, F.lit(240))
    out = _run_dir(spark, "t1")

    def write(batch, epoch):
        batch.select("event_id").write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")
    INC.run_available(kept, write, f"{out}/ckpt")
    return spark.read.parquet(f"{out}/data").select("event_id")


def _event_files(spark, sf, out, n=4):
    """The events as ``n`` files in arrival order, so that a stream takes them in as many micro-batches."""
    files = events(spark, sf).repartitionByRange(n, "ts", "event_id").sortWithinPartitions("ts", "event_id")
    files.write.parquet(f"{out}/events")
    return f"{out}/events"


@query("t2_stream_dedup", sql=_DEDUP_SQL + "\nSELECT event_id FROM d WHERE reason IS NULL")
def t2_stream_dedup(spark, sf):
    """T2 with the state store: the new events in four micro-batches against history and what earlier ones claimed."""
    hist, _ = ev_split(spark, sf)
    out = _run_dir(spark, "t2")
    s = INC.stream_table(spark, _event_files(spark, sf, out), events(spark, sf).schema)
    k = F.get_json_object("props", "$.k").cast("int")
    batch = s.select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("user_id") % 3 == 0, "other").otherwise("news_en").alias("spider"),
        F.concat(F.lit("t"), (k % 40).cast("string")).alias("title"),
        F.concat(F.lit("https://e.example.org/u/"), (F.col("user_id") % 50).cast("string"), F.lit("/"),
                 k.cast("string")).alias("source_addr"),
        F.col("ts").cast("timestamp_ntz").alias("created_at")).where(
        F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))
    path = dedup_stream(batch, out, RUN_TS, EV_DEDUP, ["ts", "event_id"], hist)
    return spark.read.parquet(path).where("reason IS NULL").select("event_id")


@query("t3_stream_upsert", sql=f"""
WITH {_ORD_SQL},
n AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 3 END AS first_epoch,
        CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE o_orderkey % 3 END AS last_epoch, o_orderpriority AS title
      FROM orders WHERE o_orderdate >= DATE '{_ORD_SPLIT_NEW}')
SELECT coalesce(o.key, n.key) AS key, CASE WHEN o.key IS NOT NULL THEN o.title ELSE n.title || '/' || CAST(first_epoch AS VARCHAR) || '/a' END AS title,
       CASE WHEN n.key IS NOT NULL THEN 'done/' || CAST(last_epoch AS VARCHAR) || '/b' ELSE o.status END AS status,
       strftime(CASE WHEN n.key IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE o.updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM old o FULL OUTER JOIN n ON o.key = n.key""")
def t3_stream_upsert(spark, sf):
    """T3 in three epochs: each key twice in an epoch, and every fifth key in all of them."""
    old, _ = _orders_old_new(spark, sf)
    out = _run_dir(spark, "t3")
    orders = table(spark, sf, "orders").withColumn("copy", F.explode(F.array(F.lit("a"), F.lit("b"))))
    for k in range(3):                               # three parts of the input, one after another
        part = orders.where((F.col("o_orderkey") % 3 == k) | (F.col("o_orderkey") % 5 == 0)).withColumn("phase", F.lit(k))
        part.write.mode("append").parquet(f"{out}/orders")
    files = spark.read.parquet(f"{out}/orders")
    s = INC.stream_table(spark, f"{out}/orders", files.schema, files_per_trigger=max(1, len(files.inputFiles()) // 3))
    tag = F.concat(F.lit("/"), F.col("phase").cast("string"), F.lit("/"), F.col("copy"))
    batch = s.where(F.col("o_orderdate").cast("timestamp_ntz") >= F.lit(_ORD_SPLIT_NEW).cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("key"), F.concat("o_orderpriority", tag).alias("title"),
        F.concat(F.lit("done"), tag).alias("status"), F.lit("ok").alias("status_msg"), "phase", "copy")
    handler = INC.upsert_handler(f"{out}/snap", "key", RUN_TS, lambda: F.struct("phase", "copy"), old, ("status", "status_msg"))
    INC.run_available(batch, handler, f"{out}/ckpt")
    return INC.snapshot(spark, f"{out}/snap", old, "key").select(
        "key", "title", "status", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


# =============================================================================
# P21, J5, J6 (pages); S8 + S10 export/publish and S5 media store (rows only)
# =============================================================================

# What the cleaner drops or rewrites, put into each article: a div of each kind and loose text at its start (as for
# P13-P15), a ruler, a sign-off, a credit and an empty paragraph at its end.
_TAIL = "<p>____________</p><p>I&apos;m Ann Lee.</p><p><em>Ann Lee wrote this.</em></p><p> </p><p class='x \"y\"'>Kept &lt;last&gt;.</p>"
_TAIL_CLEAN = "<p>I''m Ann Lee.</p><p class=''x \"y\"''>Kept &lt;last&gt;.</p>"
_IMAGE_CLEAN = I.IMAGE_TEMPLATE.replace("{p}", "pm").replace(chr(10), "' || chr(10) || '") % (
    "content_image_div_1", "content_image_1", "a", "content_image_1.png", "/p.png", "a")


def _tailed_pages(spark, sf):
    return _block_pages(spark, sf).withColumn("html", F.replace(F.col("html"), F.lit("</article>"), F.lit(_TAIL + "</article>")))


@query("p21_clean_html", sql=f"""
SELECT page_id, '<article>' || CASE WHEN page_id % 7 = 5 THEN '{_IMAGE_CLEAN}' ELSE '' END || '<!-- c -->'
         || {Q.canonical("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")}
         || '{_TAIL_CLEAN}</article>' AS formatted_content
FROM pages""")
def p21_clean_html(spark, sf):
    from ..operators.blocks import wrap_root
    n = nodes_by_page(_tailed_pages(spark, sf), (HtmlScope("article"),))
    body = assemble(clean_blocks(blocks_from_nodes(n, DRIVER_PAGES), DRIVER_PAGES))
    return body_roots(n, DRIVER_PAGES).join(body, "page_id", "left").select(
        "page_id", wrap_root(F.col("body_html"), F.col("root_open"), F.col("root_tag")).alias("formatted_content"))


# Markup for the reformatters, put at the start of each article; pages of even id have stored paths for some images.
_STYLED = ("<p>see <a href='/x'><b>this</b> link</a> now</p><iframe src='v'><p>in</p></iframe><blockquote><p>q</p></blockquote>"
           "<p> &nbsp; </p><p>&amp;nbsp;</p><div id='js_sponsor_ad_area'>ad</div><span class='x db'>s</span><script>var a='</p>';</script>"
           "<p><img src=' http://i.example.org/1.png ' alt='x' style='height: 20px'></p><p><img data-src='ftp://i.example.org/2.png'></p>"
           "<p><img src='http://i.example.org/spam.png' alt='y'></p><div><img src='/r.png' alt='z'></div><p><strong>bold</strong></p>")


def _styled_pages(spark, sf):
    table_ = F.when(F.col("page_id") % 5 == 0, "<table><tr><td>1</td></tr></table>").otherwise("")
    html = F.replace(F.col("html"), F.lit("<article>"), F.concat(F.lit("<article>" + _STYLED), table_))
    return raw_pages(spark, sf).select("page_id", "url", html.alias("html"))


def _stored_paths(pages):
    urls = F.array(*map(F.lit, ("http://i.example.org/1.png", "ftp://i.example.org/2.png", "http://i.example.org/spam.png")))
    return pages.where(F.col("page_id") % 2 == 0).select("page_id", F.posexplode(urls).alias("k", "url")).select(
        "page_id", "url", F.concat(F.lit("pics/"), F.col("page_id").cast("string"), F.lit("_"), (F.col("k") + 1).cast("string")).alias("path"))


_SQUEEZE = f"regexp_replace(regexp_replace(regexp_replace(m, '{_WS}+<', '<', 'g'), '>{_WS}+', '>', 'g'), '{_ILLEGAL}', '', 'g')"


@query("f25_reformat_styles", sql=f"""
WITH a AS (SELECT page_id, CAST(page_id AS VARCHAR) AS i, {Q.canonical("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} AS body FROM pages),
m AS (SELECT page_id, '<article><p>see this link now</p>'
        || CASE WHEN page_id % 2 = 0
           THEN '<p><img src="pics/' || i || '_1" style="height:auto"/></p><p><img data-src="ftp://i.example.org/2.png" src="pics/' || i
                || '_2"/></p><div><img src="/r.png"/></div>'
           ELSE '<p><img src=" http://i.example.org/1.png " alt="x" style="height: 20px"/></p><p><img data-src="ftp://i.example.org/2.png"/></p>'
                || '<p><img src="http://i.example.org/spam.png" alt="y"/></p><div><img src="/r.png" alt="z"/></div>' END
        || '<p><strong>bold</strong></p>' || CASE WHEN page_id % 5 = 0 THEN '<table><tr><td>1</td></tr></table>' ELSE '' END
        || body || '</article>' AS m FROM a)
SELECT page_id, {_SQUEEZE} AS formatted_content FROM m""")
def f25_reformat_styles(spark, sf):
    from ..operators.markup import reformat_keeping_styles
    pages = _styled_pages(spark, sf)
    return reformat_keeping_styles(nodes_by_page(pages), DRIVER_PAGES.body_root, _stored_paths(pages),
                                   spark.createDataFrame([("/spam.",)], "pattern string"))


@query("f26_reformat_paragraphs", sql=f"""
WITH a AS (SELECT page_id, CAST(page_id AS VARCHAR) AS i, {Q.canonical("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} AS body FROM pages),
ps AS (SELECT page_id, list_transform(regexp_extract_all(body, '(?s)<p>.*?</p>'), lambda p: regexp_replace(regexp_replace(regexp_replace(
         replace(replace(p, ' <', '<'), '> ', '>'), '<p[^\n]*?>', '', 'g'), '</p>', '<br/>', 'g'), '{_ILLEGAL}', '', 'g')) AS ps FROM a)
SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' ELSE 'see<b>this</b>link now<br/>in<br/>q<br/>' || '&amp;nbsp;<br/>'
         || CASE WHEN page_id % 2 = 0
            THEN '<img src="pics/' || i || '_1" style="height: 20px"/><br/><img data-src="ftp://i.example.org/2.png" src="pics/' || i
                 || '_2"/><br/><img src="pics/' || i || '_3"/><br/><img src="/r.png"/><br/>'
            ELSE '<img src=" http://i.example.org/1.png " alt="x" style="height: 20px"/><br/><img data-src="ftp://i.example.org/2.png"/><br/>'
                 || '<img src="http://i.example.org/spam.png" alt="y"/><br/><img src="/r.png" alt="z"/><br/>' END
         || '<b>bold</b><br/>' || array_to_string(list_transform(ps, lambda p: CASE WHEN regexp_replace(p, '(<br */>)+', '', 'g') = '' THEN '' ELSE p END), '')
       END AS formatted_content FROM ps JOIN a USING (page_id)""")
def f26_reformat_paragraphs(spark, sf):
    from ..operators.markup import reformat_by_paragraphs
    pages = _styled_pages(spark, sf)
    return reformat_by_paragraphs(nodes_by_page(pages), DRIVER_PAGES.body_root, _stored_paths(pages))


# Fixed test blocklist (a config table: its size is bounded by configuration).
_BLOCKLIST = ("/the", "/de", "spam")


@query("j6_blocklist_anti_join", sql=f"""
SELECT page_id, pos, href FROM (
  SELECT page_id, unnest(h) AS href, unnest(range(1, len(h) + 1)) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages))
WHERE NOT ({' OR '.join(f"contains(href, '{p}')" for p in _BLOCKLIST)})""")
def j6_blocklist_anti_join(spark, sf):
    e = list_entries(page_nodes(spark, sf), DRIVER_PAGES).select("page_id", F.col("pos").cast("bigint").alias("pos"),
                                                                F.col("entry_uri").alias("href"))
    return not_blocked(e, "href", spark.createDataFrame([(p,) for p in _BLOCKLIST], "pattern string"))


@query("j5_image_path_lookup", sql="""
WITH l AS (SELECT page_id, unnest(h) AS href, unnest(t) AS txt, unnest(range(1, len(h) + 1)) AS pos
           FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h,
                        regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS t FROM pages)),
u AS (SELECT *, CASE pos % 3 WHEN 0 THEN 'ftp://i.example.org' WHEN 1 THEN 'http://i.example.org' ELSE '' END || href AS url FROM l),
paths AS (SELECT DISTINCT url, 'pics/' || md5(url) || '.jpg' AS path FROM u WHERE regexp_matches(txt, '^[A-Z]'))
SELECT u.page_id, u.pos, u.href, CASE WHEN pos % 3 < 2 THEN paths.path END AS path FROM u LEFT JOIN paths USING (url)""")
def j5_image_path_lookup(spark, sf):
    n = page_nodes(spark, sf)
    e = list_entries(n, DRIVER_PAGES)
    txt = select_text(n, sel(desc("nav"), desc("li"), child("a"))).select("page_id", F.col("chain")[F.size("chain") - 2]["nid"].alias("anchor_id"), "text")
    e = e.join(txt, ["page_id", "anchor_id"], "left")
    # by row: in src, in data-src only, or no http/ftp address; only those with a capital have a stored path
    url = F.concat(F.when(F.col("pos") % 3 == 0, "ftp://i.example.org").when(F.col("pos") % 3 == 1, "http://i.example.org").otherwise(""),
                   F.col("entry_uri"))
    imgs = e.select("page_id", F.col("pos").cast("bigint").alias("pos"), F.col("entry_uri").alias("href"), "text",
                    F.when(F.col("pos") % 2 == 0, F.concat(F.lit(" "), url)).alias("src"), url.alias("data_src"))
    paths = imgs.where(F.col("text").rlike("^[A-Z]")).select(F.col("data_src").alias("url")).distinct() \
        .select("url", F.concat(F.lit("pics/"), F.md5("url"), F.lit(".jpg")).alias("path"))
    return image_paths(imgs, paths).select("page_id", "pos", "href", "path")


@query("s10_publish_export", sql=f"""WITH {EV_STATUS_SQL}
SELECT uuid, '202401' AS yyyymm, '202401/' || uuid AS data_uri, 'status.' || fetched AS status_file,
       CASE fetched WHEN 'downloaded' THEN 'related files downloaded' ELSE 'related files download error' END || chr(10) AS status_body,
       fetched = 'downloaded' AS is_full
FROM st""")
def s10_publish_export(spark, sf):
    """S8 + S9 + S10: export rows published twice under one batch id and read back: the last run shows."""
    arts, results, imgs = ev_media(spark, sf)
    a = M.download_status(arts, M.media_ok(M.attach_results(M.manifest(arts, imgs), results)))
    empty = {c: F.lit("") for c in ("formatted_content", "ori_content", "formatted_text")}
    a = a.withColumns({"batch_id": F.lit(20240131000000).cast("bigint"), "spider": F.lit("news_en"),
                       "data_uri": F.concat(F.lit("202401/"), "uuid")} | empty)
    out = _run_dir(spark, "s10")
    S.publish(S.export_frame(a).withColumn("status_body", F.lit("an earlier run")), out, 20240131000000)
    S.publish(S.export_frame(a), out, 20240131000000)
    return S.published(spark, out, 20240131000000).select("uuid", F.col("yyyymm").cast("string").alias("yyyymm"), "data_uri", "status_file",
                                           "status_body", F.col("formatted_text_txt").isNotNull().alias("is_full"))


from . import chain as _chain  # noqa: E402  (uses page_nodes above)

_QUERIES.update(_chain.QUERIES)
_ORACLE.update(_chain.ORACLE)
