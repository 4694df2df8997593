"""List crawl as tables.

Entries and their fields come from one pass over the node table: every field
selector is the entry selector extended by relative steps, and its anchor
capture gives the entry a node belongs to.  One ``groupBy(page_id,
anchor_id)`` then collects the fields (no interval self-join).

The take-while (W1) and the page cap / empty-page stop (L2) are computed as
per-source aggregates joined back, not as a window over the whole source: a
source can hold a large share of all entries, and a window would put it in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SiteSpec
from ..functions.dates import end_time, news_date, parse_loose
from ..functions.urls import url_join
from .select import Selector, element_match, matching


def _elem(selector) -> Column:
    last = selector.steps[-1]
    tag_ok = F.lit(True) if last.tag == "*" else (F.col("tag") == last.tag)
    return (F.col("kind") == "element") & tag_ok & element_match(selector)


def page_types(nodes: DataFrame, spec: SiteSpec) -> DataFrame:
    """``common`` / ``async`` / ``error`` per list page."""
    common = _elem(spec.list_common_marker) if spec.list_common_marker is not None else F.lit(False)
    anyk = _elem(spec.entry_any)
    g = nodes.groupBy("page_id").agg(F.bool_or(common).alias("c"), F.bool_or(anyk).alias("a"))
    return g.select("page_id", F.when(F.col("c"), "common").when(F.col("a"), "async")
                    .otherwise("error").alias("list_type"))


def entries(nodes: DataFrame, spec: SiteSpec) -> DataFrame:
    """P3 + P4: one row per selected entry with its raw fields.

    Columns: page_id, anchor_id, pos (1-based, document order), entry_uri,
    thumb_pic_url, public_date_raw, ignore, list_type.  One scan: the page type
    (P2) comes from the same rows, as a window over the page's entries.
    """
    ent = spec.entry_any
    elements = {"entry": Selector(ent.steps, anchor=len(ent.steps))}
    for name, steps in (("link", spec.entry_link), ("thumb", spec.entry_thumb), ("ignore", spec.entry_ignore)):
        if steps:
            elements[name] = ent.then(*steps)
    if spec.entry_common is not None:
        elements["in_common"] = spec.entry_common
    if spec.list_common_marker is not None:
        elements["marker"] = spec.list_common_marker
    texts = {"date": ent.then(*spec.entry_date)} if spec.entry_date else {}
    rows = matching(nodes, elements, texts, "page_id", "node_id", "attrs", "text")

    def flag(name: str) -> Column:
        return F.col(f"m.{name}") if name in elements or name in texts else F.lit(False)

    def first(value: Column, cond: Column) -> Column:
        return F.min_by(value, F.when(cond & value.isNotNull(), F.col("node_id")))

    own = F.coalesce(*[F.when(flag(n), F.col(f"m.{n}_anchor")) for n in ("entry", "link", "thumb", "ignore", "date")
                       if n in elements or n in texts])
    attrs = F.col("attrs")
    g = rows.withColumn("anchor_id", own).groupBy("page_id", "anchor_id").agg(
        F.bool_or(flag("entry")).alias("_is_entry"),
        F.bool_or(flag("entry") & flag("in_common")).alias("in_common"),
        F.bool_or(flag("marker")).alias("_marker"),
        first(attrs[spec.entry_link_attr], flag("link")).alias("entry_uri"),
        F.coalesce(first(attrs["data-src"], flag("thumb")), first(attrs["src"], flag("thumb"))).alias("thumb_pic_url"),
        first(F.col("text"), flag("date")).alias("public_date_raw"),
        F.bool_or(flag("ignore")).alias("ignore"))
    page = Window.partitionBy("page_id")
    g = g.withColumn("list_type", F.when(F.bool_or("_marker").over(page), "common").otherwise("async"))
    g = g.where(F.col("_is_entry") & ((F.col("list_type") != "common") | F.col("in_common")))
    return g.select("page_id", "anchor_id", F.row_number().over(page.orderBy("anchor_id")).alias("pos"), "entry_uri",
                    "thumb_pic_url", "public_date_raw", F.coalesce("ignore", F.lit(False)).alias("ignore"), "list_type")


def resolve_entries(ents: DataFrame, list_meta: DataFrame, run_ts) -> DataFrame:
    """Reason column, absolute entry URL and normalized date.

    ``list_meta``: (page_id, url, page_counter, source).  ``reason`` is NULL
    for entries that go on; rejected/ignored rows stay for the audit (S11).
    """
    e = ents.join(list_meta, "page_id")
    pub = news_date(F.col("public_date_raw"), run_ts)
    return e.select(
        "*",
        F.when(F.col("entry_uri").isNull(), F.lit("entry_without_link"))
        .when(F.col("ignore"), F.lit("entry_ignored")).alias("reason"),
        url_join(F.col("url"), F.col("entry_uri")).alias("entry_url"),
        pub.alias("public_datetime_str"),
        parse_loose(pub).alias("public_datetime"),
    )


def take_while(entries_df: DataFrame, hours: Column, run_ts, max_page: int | None = None,
               source: str = "source", page: str = "page_counter", pos: str = "pos",
               ts: str = "public_datetime", skip: Column | None = None,
               page_sizes: DataFrame | None = None) -> DataFrame:
    """C5 + W1 + L2: entries before the first too-old one of their source.

    The first non-skipped entry older than ``run_ts - hours`` stops its page
    and every later page of the source; skipped rows (rejected / ignored) are
    never tested.  With ``max_page`` (L2) later pages are not crawled; nor are
    those after the first page with no (``page_sizes``: source, page, n_entries).
    Returns the kept, non-skipped rows; the stop is a per-source aggregate.
    """
    skip = F.lit(False) if skip is None else skip
    e = entries_df.withColumn("_skip", F.coalesce(skip, F.lit(False))) \
        .withColumn("_endtime", end_time(run_ts, hours))
    old = ~F.col("_skip") & F.coalesce(F.col(ts) < F.col("_endtime"), F.lit(False))  # Q14: no date never stops
    key = F.struct(F.col(page).alias("pg"), F.col(pos).alias("ps"))
    stops = e.where(old).groupBy(source).agg(F.min(key).alias("_stop"))
    kept = e.join(stops, source, "left").where(
        (F.col("_stop").isNull() | (key < F.col("_stop"))) & ~F.col("_skip"))
    if max_page is not None:
        kept = kept.where(F.col(page) <= max_page)
    if page_sizes is not None:
        empty = page_sizes.where(F.col("n_entries") == 0).groupBy(source).agg(F.min(page).alias("_empty"))
        kept = kept.join(empty, source, "left").where(F.col("_empty").isNull() | (F.col(page) < F.col("_empty")))
        kept = kept.drop("_empty")
    return kept.drop("_stop", "_skip", "_endtime")


def join_details(entries_df: DataFrame, details: DataFrame) -> DataFrame:
    """Carry list fields onto the detail page fetched from the entry URL."""
    return entries_df.join(details, entries_df["entry_url"] == details["url"], "inner")
