"""Detail-page fields (P5-P11, P9 + A1, C6, C7, C9).

All page-level fields come out of ONE pass over the node table: each field is
a predicate column, and one ``groupBy(page_id)`` takes the first value in
document order per field (L1).  A page is shredded in one task, so grouping by
page adds no skew beyond the page itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SiteSpec
from ..functions.dates import news_date, parse_loose
from ..functions.text import pstrip, regex_int
from .select import Selector, element_match, matching, matching_by, near_any, parent_match

AUDIO_RATE_RE = r"(?i)(\d+) kbps"
AUDIO_RATE_CAP = 1024


def _first(value: Column, cond: Column) -> Column:
    """First ``value`` in document order among rows where ``cond`` holds and value is set."""
    return F.min_by(value, F.when(cond & value.isNotNull(), F.col("node_id")))


def _elem(selector: Selector | None) -> Column:
    if selector is None:
        return F.lit(False)
    last = selector.steps[-1]
    tag_ok = F.lit(True) if last.tag == "*" else (F.col("tag") == last.tag)
    return (F.col("kind") == "element") & tag_ok & element_match(selector)


def _text_of(selector: Selector | None) -> Column:
    if selector is None:
        return F.lit(False)
    return (F.col("kind") == "text") & parent_match(selector)


def _selectors(spec: SiteSpec) -> tuple[dict[str, Selector], dict[str, Selector]]:
    elements = {n: x for n, x in (("content", spec.content_scope), ("header", spec.header_scope),
                                  ("body", spec.body_scope), ("pub", spec.pub_time), ("cover", spec.cover_img))
                if x is not None}
    texts = {n: x for n, x in (("title_text", spec.title), ("pub_text", spec.pub_time), ("category_text", spec.category))
             if x is not None}
    return elements, texts


def page_fields(nodes: DataFrame, spec: SiteSpec, run_ts) -> DataFrame:
    """One row per page with header fields and layout flags."""
    elements, texts = _selectors(spec)
    rows = matching(nodes, elements, texts, "page_id", "node_id", "attrs", "text", root=True)
    return _fields(rows, elements | texts, ["page_id"], lambda of: of(spec), run_ts)


def _fields(rows: DataFrame, names, keys: list[str], pick, run_ts) -> DataFrame:
    """The fields of each page from the nodes that its selectors match; ``pick`` takes what hangs on the page's spec."""
    attrs = F.col("attrs")

    def flag(name: str) -> Column:
        return F.col(f"m.{name}") if name in names else F.lit(False)

    g = rows.groupBy(*keys).agg(
        F.bool_or(flag("content")).alias("has_content"),
        F.bool_or(flag("header")).alias("has_header"),
        F.bool_or(flag("body")).alias("has_body"),
        _first(F.col("text"), flag("title_text")).alias("_title"),
        _first(attrs["datetime"], flag("pub")).alias("_pub_attr"),
        _first(F.col("text"), flag("pub_text")).alias("_pub_text"),
        _first(attrs["src"], flag("cover")).alias("_cover_src"),
        _first(attrs["alt"], flag("cover")).alias("_cover_alt"),
        _first(F.col("text"), flag("category_text")).alias("_category"))
    # Header searches are document-wide but run only when the scope exists
    scoped = pick(lambda spec: F.col("has_header") if spec.header_scope is not None else F.lit(True))

    def field(name):
        return F.when(scoped, pstrip(F.coalesce(F.col(name), F.lit("")))).otherwise(F.lit(""))

    pub_attr, pub_text = field("_pub_attr"), field("_pub_text")
    pub_raw = F.when(pub_attr != "", pub_attr).when(pub_text != "", pub_text)   # Q3
    pub_str = news_date(pub_raw, run_ts)
    category = field("_category")
    base_tags = pick(lambda spec: F.array(*[F.lit(t) for t in spec.base_tags]).cast("array<string>"))
    tags = F.concat(base_tags,
                    F.when(category != "", F.array(category)).otherwise(F.array().cast("array<string>")))
    cover_src, cover_alt = field("_cover_src"), field("_cover_alt")
    layout_ok = pick(lambda spec: (F.col("has_content") if spec.content_scope is not None else F.lit(True))
                     & (F.col("has_body") if spec.body_scope is not None else F.lit(True)))
    return g.select(
        *keys,
        field("_title").alias("title"),
        pub_str.alias("public_datetime_str"),
        parse_loose(pub_str).alias("public_datetime"),
        F.when(pub_attr != "", "attr").when(pub_text != "", "text").otherwise("run_ts").alias("pub_source"),
        cover_src.alias("content_pic"),
        F.struct(F.lit("content_pic.").alias("url"), cover_src.alias("ori_url"), cover_alt.alias("alt")).alias("content_pic_info"),
        category.alias("category"),
        tags.alias("tags"),
        layout_ok.alias("layout_ok"),
        F.coalesce("has_header", F.lit(False)).alias("has_header"),
    )


def route_layouts(routed: DataFrame, nodes: DataFrame, layouts: dict[str, SiteSpec], run_ts) -> DataFrame:
    """``routed(page_id, layout)`` pages through their layout's extractor; other layouts give no row.

    One pass over the nodes however many layouts: each node meets its page's
    layout once and runs that layout's selectors only.
    """
    sites = {name: _selectors(spec) for name, spec in layouts.items()}
    known = routed.where(F.col("layout").isin(*layouts)).select("page_id", "layout").distinct()
    near = nodes.where(near_any(sites)).select("page_id", "node_id", "kind", "tag", "attrs", "text", "chain")
    rows = matching_by(near.join(known, "page_id"), "layout", sites, "page_id", "layout", "node_id", "attrs", "text")

    def pick(of) -> Column:
        out = F.when(F.lit(False), None)
        for name, spec in layouts.items():
            out = out.when(F.col("layout") == name, of(spec))
        return out

    names = {n for elements, texts in sites.values() for n in elements | texts}
    return routed.join(_fields(rows, names, ["page_id", "layout"], pick, run_ts), ["page_id", "layout"])


def audio_links(nodes: DataFrame, spec: SiteSpec) -> DataFrame:
    """Audio links (page_id, pos, href, text), text taken per anchor (Q9)."""
    if spec.audio_links is None:
        return nodes.sparkSession.createDataFrame([], "page_id bigint, pos int, href string, text string")
    link = _elem(spec.audio_links)
    text = _text_of(spec.audio_links)
    rows = nodes.where(link | text).withColumn(
        "link_id", F.when(F.col("kind") == "element", F.col("node_id"))
        .otherwise(F.element_at("chain", -1)["nid"]))
    return rows.groupBy("page_id", "link_id").agg(
        F.first(F.when(F.col("kind") == "element", F.col("attrs")["href"]), ignorenulls=True).alias("href"),
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("kind") == "text", F.struct("node_id", "text")))), lambda x: x["text"]), "").alias("text"),
        F.bool_or(F.col("kind") == "element").alias("_is_link"),
    ).where("_is_link").select("page_id", F.col("link_id").alias("pos"), "href", "text")


def lowest_rate_link(links: DataFrame, key: str = "page_id", pattern: str = AUDIO_RATE_RE,
                     cap: int = AUDIO_RATE_CAP) -> DataFrame:
    """A1: arg-min of the bitrate in the link text; strict ``<`` from ``cap``,
    ties to the first link, no match -> the first link."""
    rate = regex_int(F.col("text"), pattern)
    rank = F.struct(F.coalesce(F.when(rate < cap, rate), F.lit(cap)).alias("r"), F.col("pos").alias("p"))
    return links.groupBy(key).agg(F.min_by("href", rank).alias("audio_addr"),
                                  F.count("*").alias("n_links"))


def audio_type(audio_addr: Column) -> Column:
    """``w_audio`` when an audio address is set."""
    return F.when(F.coalesce(audio_addr, F.lit("")) != "", "w_audio").otherwise("wo_audio")
