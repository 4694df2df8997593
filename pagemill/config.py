"""Site and run parameters (X5, X6: one ``SiteSpec`` per site and layout).

Selectors are ``Step`` tuples built here in Python; nothing is parsed from
strings.  Two specs ship: ``NEWS_SITE`` (the list/detail markup of the news
site the reference crawls) and ``DRIVER_PAGES`` (the markup of the bundled
``pages`` table: ``nav li a`` links, an ``article`` body with an ``h1``).
"""

from __future__ import annotations

from dataclasses import dataclass

from .operators.select import Selector, Step, child, desc, sel


@dataclass(frozen=True)
class DivProbe:
    """A div block is classified by the first probe that finds a descendant."""
    name: str
    tag: str
    cls_tok: str | None = None


@dataclass(frozen=True)
class SiteSpec:
    name: str
    seed_url: str
    page_param: str = "p"
    # list pages
    list_common_marker: Selector | None = None
    entry_common: Selector | None = None
    entry_any: Selector | None = None
    entry_link: tuple[Step, ...] = ()
    entry_link_attr: str = "href"
    entry_thumb: tuple[Step, ...] = ()
    entry_date: tuple[Step, ...] = ()
    entry_ignore: tuple[Step, ...] = ()
    # detail pages
    content_scope: Selector | None = None
    header_scope: Selector | None = None
    body_scope: Selector | None = None
    title: Selector | None = None
    pub_time: Selector | None = None
    cover_img: Selector | None = None
    category: Selector | None = None
    audio_links: Selector | None = None
    body_root: Selector | None = None
    # body cleaning
    div_probes: tuple[DivProbe, ...] = ()
    image_probe: DivProbe | None = None
    image_thumb: tuple[Step, ...] = ()
    footer_markers: tuple[str, ...] = ()
    footer_tags: tuple[str, ...] = ("p", "h2")
    signoff_prefixes: tuple[str, ...] = ()
    signoff_window: int | None = None       # W4: blocks from the end; a spec with prefixes must state it
    signoff_words: tuple[int, int] = (2, 5)
    ruler_min_len: int = 11
    base_tags: tuple[str, ...] = ()
    layout: str = "common"


# Markup of the news site (class names, ids, marker text).
NEWS_SITE = SiteSpec(
    name="news_en",
    seed_url="https://news.example.org/z/1?p=0",
    page_param="p",
    list_common_marker=sel(desc("ul", eid="articleItems")),
    entry_common=sel(desc("ul", eid="articleItems"), child("li"), child("div", cls_sub="media-block")),
    entry_any=sel(desc("li"), child("div", cls_sub="media-block")),
    entry_link=(child("a"),),
    entry_thumb=(desc("div", cls_sub="thumb"), child("img")),
    entry_date=(desc("div", cls_sub="media-block__content"), child("span", cls_sub="date")),
    entry_ignore=(desc("span", cls_sub="ico--media-type"),),
    content_scope=sel(desc("div", eid="content")),
    header_scope=sel(desc("div", cls_sub="hdr-container")),
    body_scope=sel(desc("div", cls_sub="body-container")),
    title=sel(desc("div", cls_sub="col-title"), child("h1", cls_sub="title")),
    pub_time=sel(desc("div", cls_sub="published"), child("span"), child("time")),
    cover_img=sel(desc("div", cls_sub="cover-media"), child("figure", cls_sub="media-image"), desc("img")),
    category=sel(desc("div", cls_sub="col-category"), child("div", cls_sub="category"), child("a")),
    audio_links=sel(desc("div", cls_sub="media-pholder--audio"), child("div", cls_eq="media-download"),
                    desc("div", cls_eq="inner"), desc("li", cls_eq="subitem"), child("a")),
    body_root=sel(desc("div", eid="content"), desc("div", cls_tok="body-container"),
                  desc("div", eid="article-content"), desc("div", cls_tok="wsw")),
    div_probes=(DivProbe("main_audio", "div", "media-pholder"),
                DivProbe("quiz", "div", "quiz"),
                DivProbe("content_video", "div", "external-content-placeholder")),
    image_probe=DivProbe("content_image", "figure", "media-image"),
    image_thumb=(desc("div", cls_tok="thumb"), desc("img")),
    footer_markers=("words in this story",),
    signoff_prefixes=("i'm", "i am", "i’m"),
    signoff_window=20,
    base_tags=("voa", "voa learning english"),
)

# Markup of the bundled ``pages`` table.
DRIVER_PAGES = SiteSpec(
    name="pages",
    seed_url="",
    page_param="page",
    entry_any=sel(desc("nav"), desc("li")),
    entry_link=(child("a"),),
    title=sel(desc("h1")),
    body_root=sel(desc("article")),
    div_probes=NEWS_SITE.div_probes,
    image_probe=NEWS_SITE.image_probe,
    image_thumb=NEWS_SITE.image_thumb,
    footer_markers=NEWS_SITE.footer_markers,
    signoff_prefixes=NEWS_SITE.signoff_prefixes,
    signoff_window=NEWS_SITE.signoff_window,
)


@dataclass(frozen=True)
class DedupConf:
    """History de-duplication."""
    title_days: int = 300
    url_days: int = 300
    title_spiders: tuple[str, ...] = ("news_en",)
    url_first: bool = False      # Q5 option: URL test before the title test
    strict_url: bool = False     # Q5 option: URLs seen earlier in the run also drop
