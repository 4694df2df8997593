"""The whole chain: list pages -> entries -> detail pages -> articles -> media status -> export, upserts, audit.

`ingest` runs it over any pages; `articles_from_pages` (also ``entry(spark)``)
is its detail half over the bundled pages.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DRIVER_PAGES, DedupConf, SiteSpec
from ..functions.dates import batch_id as batch_id_of
from ..functions.ids import data_uri, uuid_from
from ..functions.text import pstrip
from ..operators import media as M
from ..operators.blocks import assemble, blocks_from_nodes, body_roots, clean_blocks, wrap_root
from ..operators.dedup import dedup
from ..operators.detail import audio_links, audio_type, lowest_rate_link, page_fields
from ..operators.listing import entries, join_details, resolve_entries, take_while
from ..operators.shred import HtmlScope, nodes_by_page
from ..session import ensure_checkpoint_dir
from ..sinks.stores import ARTICLE_KEYS, audit_rows, export_frame, layout_reason
from ..sources.tables import list_pages, raw_pages

RUN_TS = "2024-01-31 00:00:00"
HISTORY = "title string, source_addr string, spider string, created_at timestamp_ntz"


@dataclass(frozen=True)
class Hooks:
    """What a site may add to the chain."""
    before_format: Callable[[DataFrame], DataFrame] = lambda blocks: blocks
    after_format: Callable[[Column], Column] = lambda text: text
    stages: tuple[Callable[[DataFrame], DataFrame], ...] = ()        # over article rows, in order
    accept: Column | None = None                                     # X4: quality predicate; None accepts all


@dataclass(frozen=True)
class Outcome:
    articles: DataFrame     # done and failed, with their final status
    export: DataFrame       # S8 / S9 rows
    audit: DataFrame        # S11: one row for everything rejected or remarked on
    steps: dict = field(default_factory=dict)


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def headers(nodes: DataFrame, pages: DataFrame, spec: SiteSpec, run_ts) -> DataFrame:
    """Slim detail rows: fields, body root id and the gate's ``reason``."""
    roots = body_roots(nodes, spec).select("page_id", "root_id")
    h = pages.drop("html").join(page_fields(nodes, spec, run_ts), "page_id").join(roots, "page_id", "left")
    return h.withColumns({"reason": layout_reason(F.col("layout_ok"), F.col("root_id")),
                          "spider": F.lit(spec.name), "source_addr": F.col("url")})


def bodies(nodes: DataFrame, spec: SiteSpec, hooks: Hooks = Hooks()) -> DataFrame:
    """Cleaned bodies (P12-P23, A3) with their raw markup, and the audio (P9, A1): one row per page."""
    roots = body_roots(nodes, spec)
    blocks = hooks.before_format(blocks_from_nodes(nodes, spec))
    cleaned = clean_blocks(blocks, spec)
    loose = (F.col("action") == "loose_text") & (pstrip(F.col("text")) != "")
    noted = cleaned.groupBy("page_id").agg(F.count(F.when(loose, 1)).alias("n_loose_text"))
    b = roots.join(assemble(cleaned), "page_id", "left").join(noted, "page_id", "left")
    if spec.audio_links is None:
        return b.withColumn("audio_addr", F.lit(None).cast("string"))
    return b.join(lowest_rate_link(audio_links(nodes, spec)).select("page_id", "audio_addr"), "page_id", "left")


def article_rows(heads: DataFrame, body: DataFrame, spec: SiteSpec, run_ts, hooks: Hooks = Hooks()) -> DataFrame:
    """The article schema, from accepted header rows and their bodies."""
    a = heads.drop("root_id").join(body, "page_id")
    bid = batch_id_of(run_ts)
    uid = uuid_from(F.lit(spec.name), F.col("url"))
    none = F.lit(None).cast("string")
    thumb = F.col("thumb_pic_url") if "thumb_pic_url" in heads.columns else none
    audio = F.col("audio_addr")
    out = a.select(
        "page_id", uid.alias("uuid"), bid.alias("batch_id"), "spider", F.lit(spec.name).alias("source_tag"), "source_addr",
        audio_type(audio).alias("type"), F.lit("new").alias("status"), F.lit("new").alias("status_msg"),
        data_uri(bid, uid).alias("data_uri"), "title", "category", "public_datetime", "pub_source", "ori_content",
        wrap_root(F.col("body_html"), F.col("root_open"), F.col("root_tag")).alias("formatted_content"),
        hooks.after_format(F.coalesce("formatted_text", F.lit(""))).alias("formatted_text"),
        "imgs", "content_pic", thumb.alias("thumb_pic"), audio.alias("audio_addr"),
        F.when(audio.isNotNull(), F.array(F.struct(F.lit("main").alias("type"), audio.alias("addr")))).alias("audios"),
        F.struct(F.col("tags"), F.col("content_pic_info").alias("content_pic"), F.col("footer"),
                 none.alias("ref_uuid")).alias("others"),
        F.coalesce("n_loose_text", F.lit(0)).alias("n_loose_text"),
        *[none.alias(c) for c in ("category2", "author", "abstract", "videos", "video_addr", "content_simhash")])
    for stage in hooks.stages:
        out = stage(out)
    return out.where(F.coalesce(hooks.accept, F.lit(False))) if hooks.accept is not None else out


def detail_articles(pages: DataFrame, spec: SiteSpec, run_ts, scopes, history: DataFrame | None = None,
                    conf: DedupConf | None = None, hooks: Hooks = Hooks()) -> tuple[DataFrame, DataFrame]:
    """(article rows, all header rows with ``reason``) of detail pages.

    The gate and the de-duplication (J2, J3, W6) decide on slim header rows;
    only the survivors' nodes go on to the block work.
    """
    spark = pages.sparkSession
    nodes = nodes_by_page(pages, scopes)
    heads = _cut(headers(nodes, pages, spec, run_ts))
    history = spark.createDataFrame([], HISTORY) if history is None else history
    conf = conf or DedupConf(title_spiders=(spec.name,))
    slim = heads.where(F.col("reason").isNull()).select("page_id", "title", "source_addr", "spider")
    dup = dedup(slim, history, run_ts, conf, arrival=F.col("page_id")).select("page_id", F.col("reason").alias("dup"))
    heads = _cut(heads.join(dup, "page_id", "left").withColumn("reason", F.coalesce("reason", "dup")).drop("dup"))
    accepted = heads.where(F.col("reason").isNull())
    wanted = nodes.join(accepted.select("page_id"), "page_id", "left_semi")
    return article_rows(accepted, bodies(wanted, spec, hooks), spec, run_ts, hooks), heads


def ingest(lists: DataFrame, details: DataFrame, spec: SiteSpec, run_ts, hours: Column, results: DataFrame,
           scopes, history: DataFrame | None = None, conf: DedupConf | None = None, hooks: Hooks = Hooks(),
           pack_error: Column | None = None, max_page: int | None = None) -> Outcome:
    """The whole chain over ``lists`` and ``details`` (page_id, url, html; lists: source as well).

    ``results(url, ok, path)``: fetched media.  Everything that is dropped or
    remarked on is in the audit, with its reason.
    """
    # list pages: P2-P4, C1, C2, F9, F2, W1, L2
    meta = list_pages(lists, spec).select("page_id", "url", "page_counter", "source")
    found = _cut(resolve_entries(entries(nodes_by_page(lists.select("page_id", "url", "html")), spec), meta, run_ts))
    sizes = meta.join(found.groupBy("page_id").agg(F.count("*").alias("n")), "page_id", "left").select(
        "source", "page_counter", F.coalesce("n", F.lit(0)).alias("n_entries"))
    kept = take_while(found, hours, run_ts, max_page=max_page, skip=F.col("reason").isNotNull(), page_sizes=sizes)
    place = F.struct("page_counter", "pos")
    wanted = kept.groupBy("entry_url").agg(F.min_by("thumb_pic_url", place).alias("thumb_pic_url"))   # a URL is fetched once
    stopped = found.where(F.col("reason").isNull()).join(
        kept.select("page_id", "pos"), ["page_id", "pos"], "left_anti").withColumn("reason", F.lit("entry_too_old"))

    # detail pages: J1, P5-P23, gates, de-duplication
    pages = join_details(wanted, details.select("page_id", "url", "html")).select("page_id", "url", "html", "thumb_pic_url")
    articles, heads = detail_articles(pages, spec, run_ts, scopes, history, conf, hooks)
    articles = _cut(articles)

    # media, export, status: A5, J4, A2, C12, S8, S9, C14
    per = M.media_ok(M.attach_results(M.manifest(articles), results))
    fetched = M.download_status(articles, per)
    stored = M.store_status(M.pack_status(fetched, pack_error))
    done, failed = M.route(stored)
    final = done.unionByName(failed)

    def remarks(df: DataFrame, reason: Column, detail: Column | None = None) -> DataFrame:
        return audit_rows(df.withColumn("reason", reason), run_ts, "page_id", "source_addr", detail)

    listed = found.where(F.col("reason").isNotNull()).unionByName(stopped)
    audit = (audit_rows(listed, run_ts, "page_id", "entry_url")
             .unionByName(audit_rows(heads, run_ts, "page_id", "source_addr"))
             .unionByName(remarks(articles, F.when(F.col("pub_source") == "run_ts", "pub_time_missing")))
             .unionByName(remarks(articles, F.when(F.col("n_loose_text") > 0, "loose_text")))
             .unionByName(remarks(final, F.when(F.col("status") == "downloaded_error", "download_error")
                                  .when(F.col("status") == "packed_failed", "pack_error"), F.col("status_msg"))))
    return Outcome(final, export_frame(fetched), audit, {"entries": found, "kept": kept, "headers": heads})


def store_rows(articles: DataFrame) -> DataFrame:
    """The stored columns (S6, S7), in their order."""
    return articles.select(*ARTICLE_KEYS)


def articles_from_pages(spark: SparkSession, sf_dir: str, spec: SiteSpec = DRIVER_PAGES,
                        run_ts: str = RUN_TS) -> DataFrame:
    articles, _ = detail_articles(raw_pages(spark, sf_dir), spec, run_ts, (HtmlScope("article"),))
    return articles.select(
        "uuid", "batch_id", "spider", "source_addr", "data_uri", "title", "status",
        F.date_format("public_datetime", "yyyy-MM-dd HH:mm:ss").alias("public_datetime"),
        "formatted_text", F.length("formatted_content").alias("formatted_len"))
