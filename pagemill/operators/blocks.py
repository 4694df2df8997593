"""Body cleaning: blocks.

A *block* is a direct child of a page's body root (or one line of a
document).  Blocks are grouped from the node table by (page, root, block), which combines
map-side; the windows over ``pos`` and the per-page concatenation then share
one exchange of the (far fewer) blocks by ``page_id``.  A page is parsed in
one task anyway, so per-page grouping adds no new skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SiteSpec
from ..functions.ids import image_html
from ..functions.text import PUNCTUATION, clean_lines, let, pstrip, pwords, starts_with_any
from ..functions.urls import image_type
from .markup import events, folded, start_tag
from .select import Selector, chain_state, element_match

BLOCK_COLS = ["page_id", "pos", "block_id", "kind", "tag", "cls", "text", "em_text", "has_em",
              "html", "div_class", "img_src", "img_alt"]


def _tok(cls: Column, token: str | None) -> Column:
    if token is None:
        return F.lit(True)
    return F.array_contains(F.split(F.coalesce(cls, F.lit("")), r"[ \t\n\r\f]+"), F.lit(token))


def _ordered_concat(value: Column, order: Column, sep: str = "") -> Column:
    """A3: concat of ``value`` in ``order`` (NULL values skipped)."""
    items = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["v"]), sep)


def body_roots(nodes: DataFrame, spec: SiteSpec) -> DataFrame:
    """P10/P20: first body root per page, with its raw outer HTML."""
    roots = nodes.where((F.col("kind") == "element") & element_match(spec.body_root))
    return roots.groupBy("page_id").agg(
        F.min("node_id").alias("root_id"),
        F.min_by("html", "node_id").alias("ori_content"),
        F.min_by("tag", "node_id").alias("root_tag"),
        F.min_by(start_tag(), "node_id").alias("root_open"))


def blocks_from_nodes(nodes: DataFrame, spec: SiteSpec, em_tag: str = "em") -> DataFrame:
    """P12 + P14 probes + A7: one row per direct child of the first body root."""
    # a root inside another belongs to the outer one's content
    root_sel = Selector(spec.body_root.steps, anchor=len(spec.body_root.steps), outermost=True)
    st = chain_state(root_sel)
    under = (nodes.select("*", F.explode(F.filter(F.array(st), lambda s: s["anchor"].isNotNull())).alias("_st"))
             .withColumn("root_id", F.col("_st.anchor"))
             .withColumn("_bpos", F.col("_st.anchor_pos") + 1)  # 0-based chain index of the block
             .withColumn("block_id", F.when(F.col("_bpos") < F.size("chain"),
                                            F.element_at("chain", F.col("_bpos") + 1)["nid"])
                         .otherwise(F.col("node_id")))
             .withColumn("_below", F.when(F.col("_bpos") + 2 <= F.size("chain"),
                                          F.slice("chain", F.col("_bpos") + 2, F.size("chain")))
                         .otherwise(F.array().cast(nodes.schema["chain"].dataType)))
             .drop("_st"))
    is_block = F.col("node_id") == F.col("block_id")
    below = ~is_block
    cls = F.col("attrs")["class"]
    n_em = F.size(F.filter("_below", lambda e: e["tag"] == em_tag))
    in_thumb = F.exists("_below", lambda e: (e["tag"] == spec.image_thumb[0].tag)
                        & _tok(e["cls"], spec.image_thumb[0].cls_tok)) if spec.image_thumb else F.lit(False)
    script = (F.col("tag") == "script") & F.exists("_below", lambda e: e["tag"] == "iframe")
    aggs = [
        F.first(F.when(is_block, F.col("sib")), ignorenulls=True).alias("pos"),
        F.first(F.when(is_block, F.col("kind")), ignorenulls=True).alias("kind"),
        F.first(F.when(is_block, F.col("tag")), ignorenulls=True).alias("tag"),
        F.first(F.when(is_block, cls), ignorenulls=True).alias("cls"),
        folded(events()).alias("html"),
        _ordered_concat(F.when(F.col("kind") == "text", F.col("text")), F.col("node_id")).alias("text"),
        _ordered_concat(F.when((F.col("kind") == "text") & (n_em > 0), F.repeat(F.col("text"), n_em)),
                        F.col("node_id")).alias("em_text"),
        F.bool_or(below & (F.col("tag") == em_tag)).alias("has_em"),
        F.bool_or(below & (F.col("tag") == "iframe")).alias("has_iframe"),
        # the first script of the first iframe, its attributes included
        F.min_by(F.col("node_id"), F.when(script, F.col("node_id"))).alias("_script"),
        F.collect_set(F.when(script & F.exists(F.map_values("attrs"), lambda v: v.contains("youtube")), F.col("node_id"))
                      .when((F.col("kind") == "rawtext") & F.col("text").contains("youtube"),
                            F.element_at("chain", -1)["nid"])).alias("_youtube"),
        F.min_by(F.struct(F.col("attrs")["src"].alias("src"), F.col("attrs")["alt"].alias("alt")),
                 F.when(below & (F.col("tag") == "img") & in_thumb, F.col("node_id"))).alias("_img"),
    ]
    probes = list(spec.div_probes) + ([spec.image_probe] if spec.image_probe else [])
    for p in probes:
        aggs.append(F.bool_or(below & (F.col("tag") == p.tag) & _tok(cls, p.cls_tok)).alias(f"_p_{p.name}"))
    blocks = under.groupBy("page_id", "root_id", "block_id").agg(*aggs)
    # keep the page's first root only (window reuses the page_id partitioning)
    blocks = (blocks.withColumn("_first_root", F.min("root_id").over(Window.partitionBy("page_id")))
              .where(F.col("root_id") == F.col("_first_root")))
    div_class = F.lit(None).cast("string")
    chain_expr = None
    for p in spec.div_probes:
        cond = F.col(f"_p_{p.name}")
        chain_expr = F.when(cond, F.lit(p.name)) if chain_expr is None else chain_expr.when(cond, F.lit(p.name))
    iframe_class = F.when(F.array_contains("_youtube", F.col("_script")), F.lit("content_video")).otherwise(F.lit(None).cast("string"))
    chain_expr = (chain_expr.when(F.col("has_iframe"), iframe_class) if chain_expr is not None
                  else F.when(F.col("has_iframe"), iframe_class))
    if spec.image_probe:
        chain_expr = chain_expr.when(F.col(f"_p_{spec.image_probe.name}"), F.lit(spec.image_probe.name))
    div_class = chain_expr.otherwise(F.lit("unknown"))
    return blocks.select(
        "page_id", "pos", "block_id", "kind", "tag", "cls",
        F.when(F.col("kind") == "comment", F.lit("")).otherwise(F.col("text")).alias("text"),
        "em_text", F.coalesce("has_em", F.lit(False)).alias("has_em"),
        "html",
        F.when(F.col("tag") == "div", div_class).alias("div_class"),
        F.col("_img.src").alias("img_src"), F.col("_img.alt").alias("img_alt"))


def blocks_from_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      tag: str = "p") -> DataFrame:
    """Blocks from plain text: one ``tag`` block per line, ``pos`` from 1."""
    lines = docs.select(F.col(id_col).alias("page_id"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "text"))
    return lines.select(
        "page_id", (F.col("pos") + 1).alias("pos"), (F.col("pos") + 1).alias("block_id"),
        F.lit("element").alias("kind"), F.lit(tag).alias("tag"), F.lit(None).cast("string").alias("cls"),
        "text", F.lit("").alias("em_text"), F.lit(False).alias("has_em"),
        F.concat(F.lit(f"<{tag}>"), F.col("text"), F.lit(f"</{tag}>")).alias("html"),
        F.lit(None).cast("string").alias("div_class"),
        F.lit(None).cast("string").alias("img_src"), F.lit(None).cast("string").alias("img_alt"))


def is_ruler(text: Column, min_len: int = 11) -> Column:
    """P16 (Q4): all underscores and longer than 10 characters."""
    return pstrip(text).rlike(f"^_{{{min_len},}}$")


def is_marker(tag: Column, text: Column, markers, tags=("p", "h2")) -> Column:
    return tag.isin(*tags) & F.lower(pstrip(text)).isin(*[m.lower() for m in markers])


def classify_pass1(blocks: DataFrame, spec: SiteSpec, markers=None) -> DataFrame:
    """First pass over blocks in ``pos`` order.

    Adds ``action``: ``loose_text`` (dropped; audited when non-blank),
    ``drop_div``, ``ruler``, ``footer`` (moved to the footer), ``keep``.
    Image blocks are rewritten (number, ids, template, info struct).
    """
    markers = spec.footer_markers if markers is None else markers
    w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ruler = (F.col("tag") == "p") & is_ruler(F.col("text"), spec.ruler_min_len)
    marker = (F.col("kind") == "element") & ~ruler & is_marker(F.col("tag"), F.col("text"), markers, spec.footer_tags)
    b = blocks.withColumn("_marker", marker).withColumn("_ruler", ruler)
    b = b.withColumn("in_footer", F.max(F.col("_marker").cast("int")).over(w) == 1)
    is_img = (F.col("tag") == "div") & (F.col("div_class") == "content_image")
    action = (F.when(F.col("kind") == "text", F.lit("loose_text"))
              .when((F.col("tag") == "div") & ~F.coalesce(is_img, F.lit(False)), F.lit("drop_div"))
              .when(F.col("_ruler"), F.lit("ruler"))
              .when(F.col("tag").isin(*spec.footer_tags) & F.col("in_footer"), F.lit("footer"))
              .otherwise(F.lit("keep")))
    b = b.withColumn("action", action)
    # Running image number over the page's image blocks
    img_w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("img_no", F.when(is_img, F.sum(is_img.cast("int")).over(img_w)))
    ori = pstrip(F.coalesce(F.col("img_src"), F.lit("")))
    alt = pstrip(F.coalesce(F.col("img_alt"), F.lit("")))
    img_id = F.concat(F.lit("content_image_"), F.col("img_no").cast("string"))
    url = F.concat(img_id, F.lit("."), image_type(ori))
    new_html = image_html(F.concat(F.lit("content_image_div_"), F.col("img_no").cast("string")),
                          img_id, url, alt, alt, ori)
    b = (b.withColumn("img", F.when(is_img, F.struct(img_id.alias("id"), url.alias("url"),
                                                      ori.alias("ori_url"), alt.alias("alt"))))
         .withColumn("html", F.when(is_img, new_html).otherwise(F.col("html")))
         .withColumn("text", F.when(is_img, F.concat(F.lit("\n    \n    \n    "), alt, F.lit("\n    \n    ")))
                     .otherwise(F.col("text")))
         .withColumn("em_text", F.when(is_img, F.lit("")).otherwise(F.col("em_text")))
         .withColumn("has_em", F.when(is_img, F.lit(False)).otherwise(F.col("has_em"))))
    return b.drop("_marker", "_ruler")


def signoff_trim(blocks: DataFrame, spec: SiteSpec, eligible: Column | None = None) -> DataFrame:
    """Trailing credit trim over the ``eligible`` blocks.

    Within the last ``signoff_window`` eligible blocks, the sign-off is the
    last ``p`` with 2-5 words whose text starts with a sign-off prefix.  From
    it on, eligible blocks whose text is blank or equals their ``em`` text
    are credits.  Conditional windows over one page partitioning: no filter
    and re-union, so the frame is computed once.
    """
    lo, hi = spec.signoff_words
    ok = F.lit(True) if eligible is None else eligible
    w_desc = (Window.partitionBy("page_id").orderBy(F.col("pos").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_page = Window.partitionBy("page_id")
    low = F.lower(pstrip(F.col("text")))
    n_words = F.size(F.transform(pwords(low), lambda x: F.btrim(x, F.lit(PUNCTUATION))))
    match = ((F.col("tag") == "p") & (F.col("kind") == "element") & (n_words >= lo) & (n_words <= hi)
             & starts_with_any(low, spec.signoff_prefixes))
    k = blocks.withColumn("_ok", ok)
    k = k.withColumn("from_end", F.when(F.col("_ok"), F.sum(F.col("_ok").cast("int")).over(w_desc)))
    k = k.withColumn("signoff", F.max(F.when(F.col("_ok") & (F.col("from_end") <= spec.signoff_window) & match,
                                             F.col("pos"))).over(w_page))
    stripped = pstrip(F.col("text"))
    credit = F.col("_ok") & (F.col("pos") >= F.col("signoff")) & (
        (stripped == "") | (F.col("has_em") & (stripped == pstrip(F.col("em_text")))))
    return k.withColumn("credit", F.coalesce(credit, F.lit(False))).drop("_ok")


def clean_blocks(blocks: DataFrame, spec: SiteSpec, markers=None) -> DataFrame:
    """Pass 1 then pass 2; every block keeps a final ``action``."""
    p1 = classify_pass1(blocks, spec, markers)
    p2 = signoff_trim(p1, spec, eligible=F.col("action") == "keep")
    return p2.withColumn("action", F.when(F.col("credit"), F.lit("credit")).otherwise(F.col("action")))


def assemble(cleaned: DataFrame, sep: str = "\n") -> DataFrame:
    """Per-page clean HTML, plain text, images and footer.

    ``sep`` joins block texts before line cleaning (Q10: the reference joins
    with nothing; ``sep=''`` reproduces that).
    """
    keep = F.col("action") == "keep"
    foot = F.col("action") == "footer"
    return cleaned.groupBy("page_id").agg(
        _ordered_concat(F.when(keep, F.col("html")), F.col("pos")).alias("body_html"),
        clean_lines(_ordered_concat(F.when(keep, F.col("text")), F.col("pos"), sep)).alias("formatted_text"),
        F.transform(F.array_sort(F.collect_list(F.when(keep & F.col("img").isNotNull(),
                                                       F.struct(F.col("img_no").alias("n"), F.col("img").alias("i"))))),
                    lambda x: x["i"]).alias("imgs"),
        F.transform(F.array_sort(F.collect_list(F.when(foot, F.struct(F.col("pos").alias("p"), F.col("html").alias("h"))))),
                    lambda x: x["h"]).alias("footer_blocks"),
        clean_lines(_ordered_concat(F.when(foot, F.col("text")), F.col("pos"), sep)).alias("footer_text"),
        F.sum(F.when(F.col("action") == "loose_text", 1).otherwise(0)).cast("int").alias("n_loose"),
        F.max("signoff").alias("signoff_pos"),
        F.count(F.when(F.col("action") == "credit", 1)).alias("n_credit"),
    ).withColumn("footer", F.concat(F.lit("["), F.array_join("footer_blocks", ", "), F.lit("]")))


def wrap_root(body_html: Column, root_open: Column, root_tag: Column) -> Column:
    """The kept blocks inside the root's own start and end tag."""
    return F.concat(root_open, F.coalesce(body_html, F.lit("")), F.lit("</"), root_tag, F.lit(">"))


def clean_text(docs: DataFrame, spec: SiteSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """P16-P18, P22, P23, W2, W4, W5 for plain texts whose lines are ``p`` blocks.

    (id, formatted_text, footer_text, signoff_pos, n_rulers, n_footer,
    n_credit).  A text is one row, so this is array work on the row: each line
    is stripped once, nothing is exploded, shuffled or sorted.  The same
    answers as `clean_blocks` over `blocks_from_lines`.
    """
    lo, hi = spec.signoff_words
    markers = [m.lower() for m in spec.footer_markers]

    def kept_of(s: Column) -> Column:
        """(pos, line) of the lines before the footer marker that are no rulers."""
        return F.filter(s["lines"], lambda x: ~x["ruler"] & ((s["mark"] == 0) | (x["pos"] < s["mark"])))

    def mark(lines: Column) -> Column:
        hit = F.filter(lines, lambda x: ~x["ruler"] & F.lower(x["line"]).isin(*markers)) if markers else F.slice(lines, 1, 0)
        return F.struct(lines.alias("lines"), F.coalesce(F.array_min(F.transform(hit, lambda x: x["pos"])), F.lit(0)).alias("mark"))

    def is_signoff(line: Column) -> Column:
        return let(F.lower(line), lambda low: starts_with_any(low, spec.signoff_prefixes)
                   & F.size(pwords(low)).between(lo, hi))

    def signoff(s: Column) -> Column:
        return let(kept_of(s), lambda kept: F.struct(
            s["lines"].alias("lines"), s["mark"].alias("mark"), kept.alias("kept"),
            F.array_max(F.transform(F.filter(
                F.slice(kept, F.greatest(F.size(kept) - spec.signoff_window + 1, F.lit(1)), F.lit(spec.signoff_window)),
                lambda x: is_signoff(x["line"])), lambda x: x["pos"])).alias("signoff")))

    def outcome(s: Column) -> Column:
        foot = F.filter(s["lines"], lambda x: ~x["ruler"] & (s["mark"] > 0) & (x["pos"] >= s["mark"]))
        blank_after = F.filter(s["kept"], lambda x: (x["line"] == "") & F.coalesce(x["pos"] >= s["signoff"], F.lit(False)))

        def joined(items: Column) -> Column:
            return F.array_join(F.filter(F.transform(items, lambda x: x["line"]), lambda x: x != ""), "\n")

        return F.struct(
            joined(s["kept"]).alias("formatted_text"), joined(foot).alias("footer_text"), s["signoff"].alias("signoff_pos"),
            F.size(F.filter(s["lines"], lambda x: x["ruler"])).cast("bigint").alias("n_rulers"),
            F.size(foot).cast("bigint").alias("n_footer"), F.size(blank_after).cast("bigint").alias("n_credit"))

    stripped = F.transform(F.split(F.col(text_col), "\n"), lambda x, i: let(pstrip(x), lambda t: F.struct(
        (i + 1).alias("pos"), t.alias("line"), t.rlike(f"^_{{{spec.ruler_min_len},}}$").alias("ruler"))))
    out = let(let(let(stripped, mark), signoff), outcome)
    return docs.select(F.col(id_col), F.explode(F.array(out)).alias("o")).select(id_col, "o.*")
