"""Markup from nodes: a canonical serializer (P21) and the two reformatters.

Every node gives its events (an element a start and an end, a text one), and
the events of a group folded in order are its markup.  Tree rewrites are
predicates on the node row and its ancestor chain: a dropped subtree is a
filter, an unwrapped element gives no events, a renamed one gives others.
Nothing is parsed again and no Python runs; one row holds one page's result,
as one row held its source.

Canonical form: attributes in source order, always quoted (with ``'`` where
the value has ``"`` only); ``&``, ``<`` and ``>`` as entities, nothing else;
void elements as ``<br/>``; comments, scripts and styles as they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ILLEGAL_LINE_RE, PY_WS, pstrip
from ..session import written
from .gates import blocked
from .select import Selector, match_all
from .shred import VOID_TAGS

# What the style-keeping reformatter takes out with everything inside.
DROPPED_TAGS = ("iframe", "mpvoice", "qqmusic", "blockquote", "script")
DROPPED_SPAN_CLASSES = ("db", "audio_area", "tc", "tips_global", "unsupport_tips")
DROPPED_DIV_ID = "js_sponsor_ad_area"

_LEAD_BR = ("^(<br */>)+", "")
_ILLEGAL = (ILLEGAL_LINE_RE, "")


def _rewritten(c: Column, *rules: tuple[str, str]) -> Column:
    for pattern, new in rules:
        c = F.regexp_replace(c, pattern, new)
    return c


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _attribute(entry: Column) -> Column:
    v = escaped(entry["value"])
    quoted = F.when(~v.contains('"'), F.concat(F.lit('"'), v, F.lit('"'))).when(
        ~v.contains("'"), F.concat(F.lit("'"), v, F.lit("'"))).otherwise(
        F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit("&quot;")), F.lit('"')))
    return F.concat(F.lit(" "), entry["key"], F.lit("="), quoted)


def start_tag(tag: Column | None = None, attrs: Column | None = None) -> Column:
    """An element's start tag; a void element is all of it."""
    attrs = F.coalesce(F.col("attrs") if attrs is None else attrs, F.create_map().cast("map<string,string>"))
    said = F.array_join(F.transform(F.map_entries(attrs), _attribute), "")
    return F.concat(F.lit("<"), F.col("tag") if tag is None else tag, said,
                    F.when(F.col("tag").isin(*sorted(VOID_TAGS)), "/>").otherwise(">"))


def events(tag: Column | None = None, attrs: Column | None = None, hidden: Column | None = None) -> Column:
    """The ordered pieces of markup that a node row gives: structs (a, b, c, s) to be sorted and joined.

    An element's end comes after everything inside it, inner ends first.
    ``hidden`` elements give nothing, their content stays.
    """
    tag = F.col("tag") if tag is None else tag
    is_void = F.col("tag").isin(*sorted(VOID_TAGS))

    def piece(a: Column, b: int, c: Column, s: Column) -> Column:
        return F.struct(a.alias("a"), F.lit(b).alias("b"), c.alias("c"), s.alias("s"))

    start = piece(F.col("node_id"), 0, F.lit(0), start_tag(tag, attrs))
    end = piece(F.col("end_id"), 1, -F.col("node_id"), F.concat(F.lit("</"), tag, F.lit(">")))
    text = F.when(F.col("kind") == "text", escaped(F.col("text"))).when(
        F.col("kind") == "comment", F.concat(F.lit("<!--"), F.col("text"), F.lit("-->"))).otherwise(F.col("text"))
    nothing = F.array().cast("array<struct<a:int,b:int,c:int,s:string>>")
    element = F.when(is_void, F.array(start)).otherwise(F.array(start, end))
    if hidden is not None:
        element = F.when(hidden, nothing).otherwise(element)
    return F.when(F.col("kind") == "element", element).otherwise(F.array(piece(F.col("node_id"), 0, F.lit(0), text)))


def folded(pieces: Column) -> Column:
    """Aggregate: the events of a group, sorted and joined."""
    return F.array_join(F.transform(F.array_sort(F.flatten(F.collect_list(pieces))), lambda x: x["s"]), "")


def serialize(nodes: DataFrame, by: list[str]) -> DataFrame:
    """(by, markup): the nodes of each group as canonical markup; an element brings its own tags only."""
    return nodes.groupBy(*by).agg(folded(events()).alias("markup"))


def under_root(nodes: DataFrame, root: Selector) -> DataFrame:
    """The nodes under roots, roots included, with ``root_id`` (the outermost) and ``inner``, the chain below the root.

    Told on the node row; of a page with several roots all give rows
    (`first_roots` says which comes first).
    """
    outermost = Selector(root.steps, anchor=len(root.steps), outermost=True)
    anchor = F.filter(F.array(match_all({"root": outermost}, {})["root_anchor"]),
                      lambda a: a.isNotNull() & ((F.col("kind") == "element") | (a != F.col("node_id"))))
    return nodes.select("page_id", "node_id", "end_id", "depth", "kind", "tag", "attrs", "text", "chain",
                        F.explode(anchor).alias("root_id")).withColumn(
        "inner", F.filter("chain", lambda e: e["nid"] > F.col("root_id"))).drop("chain")


def first_roots(rows: DataFrame, *more: Column) -> DataFrame:
    """(page_id, first_root, more): the first root of each page, and further aggregates."""
    return rows.groupBy("page_id").agg(F.min("root_id").alias("first_root"), *more)


# -- images ------------------------------------------------------------------

def _addresses(imgs: DataFrame, paths: DataFrame) -> DataFrame:
    """Images of pages that have stored paths: ``address`` (src, else data-src, http or ftp only) as written, and its path."""
    def web(c: Column) -> Column:
        return F.coalesce(pstrip(c).startswith("http") | pstrip(c).startswith("ftp"), F.lit(False))

    src, other = F.col("attrs")["src"], F.col("attrs")["data-src"]
    address = F.when(web(src), src).when(web(other), other)
    known = paths.select("page_id", F.col("url").alias("_url"), F.col("path").alias("_path"))
    pages = known.select("page_id").distinct()
    return (imgs.withColumn("_address", address).withColumn("_url", pstrip(address))
            .join(pages, "page_id", "left_semi").join(known, ["page_id", "_url"], "left"))


def _with_src(attrs: Column, value: Column) -> Column:
    """``attrs`` with ``src`` set: in its place, or at the end."""
    put = F.transform_values(attrs, lambda k, v: F.when(k == "src", value).otherwise(v))
    return F.when(F.map_contains_key(attrs, "src"), put).otherwise(F.map_concat(attrs, F.create_map(F.lit("src"), value)))


def _without_alt(attrs: Column) -> Column:
    return F.map_filter(attrs, lambda k, v: k != "alt")


def _of_page(changed: DataFrame) -> DataFrame:
    """(page_id, changes): the changed attributes of a page's images by node; a NULL value takes the image out."""
    return changed.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("node_id", "_attrs"))).alias("changes"))


def _change() -> tuple[Column, Column]:
    """(attributes as changed, whether the node stays) of a node beside its page's ``changes``."""
    known = F.coalesce(F.map_contains_key("changes", F.col("node_id")), F.lit(False))
    new = F.col("changes")[F.col("node_id")]
    return F.when(known, new).otherwise(F.col("attrs")), ~known | new.isNotNull()


# -- F25 -----------------------------------------------------------------------

def _span_or_ad(e: Column) -> Column:
    tokens = F.split(F.coalesce(e["cls"], F.lit("")), r"[ \t\n\r\f]+")
    span = (e["tag"] == "span") & F.arrays_overlap(tokens, F.array(*map(F.lit, DROPPED_SPAN_CLASSES)))
    return span | ((e["tag"] == "div") & F.coalesce(e["eid"] == DROPPED_DIV_ID, F.lit(False)))


def _dropped(e: Column) -> Column:
    return e["tag"].isin(*DROPPED_TAGS) | _span_or_ad(e)


def reformat_keeping_styles(nodes: DataFrame, root: Selector, paths: DataFrame, patterns: DataFrame) -> DataFrame:
    """(page_id, formatted_content) of every page that has a root; styles and structure stay.

    Links become their text; players, quotes, scripts and the sponsor area go
    with all inside.  On pages with rows in ``paths(page_id, url, path)``
    images lose ``alt``; one with an http or ftp address gets its stored path
    as ``src`` (empty if none is stored) and ``height:auto`` for heights in
    px, or goes if its address holds one of ``patterns(pattern)``; others
    stay.  Paragraphs without text and image go, as do those whose only text
    is an escaped blank.  Line ends and illegal blanks go, and white space
    around tags is taken out.
    """
    n = under_root(nodes, root)
    at = F.array_position(F.transform("inner", lambda e: e["tag"]), "a").cast("int")
    n = n.withColumn("_in_a", at > 0).withColumn("_outer", F.when(at > 0, F.slice("inner", F.lit(1), F.greatest(at - 1, F.lit(0)))).otherwise(F.col("inner")))
    own = F.struct(F.col("tag").alias("tag"), F.col("attrs")["id"].alias("eid"), F.col("attrs")["class"].alias("cls"))
    is_root = F.col("node_id") == F.col("root_id")
    out = F.exists("_outer", _dropped) | (F.coalesce((F.col("kind") == "element") & _dropped(own), F.lit(False)) & ~is_root)
    n = n.where(F.when(F.col("_in_a"), (F.col("kind") == "text") & ~F.exists("_outer", _dropped)).otherwise(~out))
    text = F.when(F.col("kind") == "text", F.col("text"))
    cleaned = _rewritten(pstrip(text), _LEAD_BR, (" <", "<"), ("> ", ">"), _ILLEGAL)
    # read several times, each time by other columns: written once
    n = written(n.select(
        "page_id", "root_id", "node_id", "end_id", "depth", "kind", "tag", "attrs", "text", "_in_a",
        F.coalesce((F.col("tag") == "a") & ~is_root, F.lit(False)).alias("_link"),
        F.coalesce(F.col("tag") == "img", F.lit(False)).alias("_img"),
        F.coalesce((F.col("tag") == "p") & ~is_root, F.lit(False)).alias("_is_p"),
        F.coalesce(pstrip(text) == "", F.lit(True)).alias("_blank"), F.coalesce(cleaned == "", F.lit(True)).alias("_void"),
        F.transform(F.filter("_outer", lambda e: e["tag"] == "p"), lambda e: e["nid"]).alias("_ps")), "styled")

    imgs = _addresses(n.where("_img").select("page_id", "node_id", "attrs"), paths)
    gone = blocked(imgs.where("_path IS NOT NULL"), "_address", patterns).select("page_id", "node_id", F.lit(True).alias("_gone"))
    style = F.transform_values(_without_alt(F.col("attrs")), lambda k, v: F.when(
        k == "style", F.regexp_replace(v, rf"height:{PY_WS}*[0-9]+px", "height:auto")).otherwise(v))
    changed = imgs.join(gone, ["page_id", "node_id"], "left").select(
        "page_id", "node_id", F.when(F.col("_gone"), F.lit(None)).when(F.col("_address").isNull(), _without_alt(F.col("attrs")))
        .otherwise(_with_src(style, F.coalesce("_path", F.lit("")))).alias("_attrs"))

    # paragraphs: what is in each, by the nodes under it (one in another counts for both)
    said = ["page_id", "node_id", "depth", "kind", "_in_a", "_link", "_img", "_is_p", "_blank", "_void", "_ps"]
    inside = (n.where("NOT _img").select(*said)
              .unionByName(n.where("_img").select(*said).join(gone, ["page_id", "node_id"], "left_anti"))
              .withColumn("p", F.explode(F.when(F.col("_is_p"), F.concat("_ps", F.array("node_id"))).otherwise(F.col("_ps"))))
              .withColumn("_other", F.col("p") != F.col("node_id")))
    counts = F.col("_other") & ~F.col("_in_a")            # a link is one text, whatever was in it
    per_p = inside.groupBy("page_id", "p").agg(
        F.bool_or(F.col("_other") & F.col("_img")).alias("img"), F.bool_and(~F.col("_other") | F.col("_blank")).alias("blank"),
        F.bool_and(~F.col("_other") | F.col("_void")).alias("void"), F.sum(counts.cast("int")).alias("n"),
        F.max(F.when(counts, F.col("depth"))).alias("deepest"), F.max(F.when(~F.col("_other"), F.col("depth"))).alias("own"),
        F.bool_or(F.col("_other") & ((F.col("kind") == "text") | F.col("_link"))).alias("text"))
    one_string = F.col("text") & (F.col("n") == F.col("deepest") - F.col("own"))        # each node inside is an only child
    dead = (per_p.where(F.col("own").isNotNull() & ((F.col("blank") & ~F.col("img")) | (one_string & F.col("void"))))
            .groupBy("page_id").agg(F.collect_set("p").alias("_dead")))

    # all that is known of a page beside its nodes: the nodes move once
    page = first_roots(n).join(dead, "page_id", "left").join(_of_page(changed), "page_id", "left")
    attrs, stays = _change()
    n = (n.select("page_id", "root_id", "node_id", "end_id", "kind", "tag", "attrs", "text", "_link", "_ps").join(page, "page_id")
         .where((F.col("root_id") == F.col("first_root")) & stays & (
             F.col("_dead").isNull() | ~(F.arrays_overlap("_dead", "_ps") | F.array_contains("_dead", F.col("node_id"))))))
    whole = n.groupBy("page_id").agg(folded(events(attrs=attrs, hidden=F.col("_link"))).alias("_m"))
    m = pstrip(F.replace(pstrip(F.col("_m")), F.lit("\n"), F.lit("")))
    return whole.select("page_id", _rewritten(m, _LEAD_BR, (f"{PY_WS}+<", "<"), (f">{PY_WS}+", ">"), _ILLEGAL).alias("formatted_content"))


# -- F26 -----------------------------------------------------------------------

def reformat_by_paragraphs(nodes: DataFrame, root: Selector, paths: DataFrame) -> DataFrame:
    """(page_id, formatted_content): the paragraphs of every page that has a root, in order, each ended by ``<br/>``.

    A page with a table gives the empty string.  Only paragraphs count, and
    images outside them, each a paragraph of its own; paragraphs and links
    inside one are unwrapped, ``strong`` becomes ``b``, frames go.  On pages
    with rows in ``paths(page_id, url, path)`` images lose ``alt`` and those
    with a stored path get it as ``src``.  One of line breaks only is empty.
    """
    n = under_root(nodes, root)
    at = F.array_position(F.transform("inner", lambda e: e["tag"]), "p").cast("int")
    is_root = F.col("node_id") == F.col("root_id")
    n = n.withColumn("_at", at).withColumn("unit", F.when(is_root, F.col("node_id")).when(
        F.col("_at") > 0, F.try_element_at("inner", F.greatest("_at", F.lit(1)))["nid"]).when(F.col("tag").isin("p", "img"), F.col("node_id")))
    below = F.when(F.col("_at") > 0, F.slice("inner", F.col("_at") + 1, F.size("inner"))).otherwise(F.slice("inner", 1, 0))
    is_unit = F.col("node_id") == F.col("unit")
    is_table = F.coalesce((F.col("tag") == "table") & ~is_root, F.lit(False))
    framed = F.exists(below, lambda e: e["tag"] == "iframe") | (F.coalesce(F.col("tag") == "iframe", F.lit(False)) & ~is_unit)
    # read several times, each time by other columns: written once
    n = written(n.where((F.col("unit").isNotNull() & ~framed) | is_table).select(
        "page_id", "root_id", "node_id", "end_id", "kind", "tag", "attrs", "text", F.when(~framed, F.col("unit")).alias("unit"),
        F.coalesce(is_unit, F.lit(False)).alias("_is_unit"), is_root.alias("_is_root"), is_table.alias("_table"),
        F.coalesce((F.col("tag") == "img") & ~is_root & ~framed, F.lit(False)).alias("_img")), "units")
    changed = _addresses(n.where("_img").select("page_id", "node_id", "attrs"), paths).select(
        "page_id", "node_id", F.when(F.col("_path").isNull(), _without_alt(F.col("attrs")))
        .otherwise(_with_src(_without_alt(F.col("attrs")), F.col("_path"))).alias("_attrs"))
    page = first_roots(n, F.collect_set(F.when(F.col("_table"), F.col("root_id"))).alias("_tables")).join(_of_page(changed), "page_id", "left")
    # the nodes move once; a root's own row says nothing, but every page keeps it
    n = n.join(page, "page_id").where((F.col("root_id") == F.col("first_root")) & F.col("unit").isNotNull() & (
        F.col("_is_root") | ~F.array_contains("_tables", F.col("root_id"))))
    attrs, _ = _change()
    tag = F.when((F.col("tag") == "strong"), F.lit("b")).otherwise(F.col("tag"))
    hidden = F.col("_is_root") | (F.col("tag").isin("p", "a") & ~F.col("_is_unit"))
    units = n.groupBy("page_id", "unit").agg(folded(events(tag=tag, attrs=attrs, hidden=hidden)).alias("_m"),
                                             F.bool_or(F.col("_img") & F.col("_is_unit")).alias("_bare"))
    u = F.when(F.col("_bare"), F.concat(F.lit("<p>"), F.col("_m"), F.lit("</p>"))).otherwise(F.col("_m"))
    u = _rewritten(pstrip(u), (" <", "<"), ("> ", ">"), (r"<p[^\n]*?>", ""), ("</p>", "<br/>"), _ILLEGAL)
    units = units.select("page_id", "unit", u.alias("u")).withColumn(
        "u", F.when(F.regexp_replace("u", "(<br */>)+", "") == "", "").otherwise(F.col("u")))
    return units.groupBy("page_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("unit", "u"))), lambda x: x["u"]), "").alias("formatted_content"))
