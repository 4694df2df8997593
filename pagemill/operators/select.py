"""Selectors over the ``nodes`` table (J7 child/descendant axes, L1, P11).

A selector is a tuple of ``Step`` objects (built in Python, never parsed from
a string).  It is compiled to one Column expression that runs an NFA over the
node's ancestor chain with ``aggregate``: bit *k* of ``exact`` says "the
previous chain element matched step *k*", bit *k* of ``ever`` says "some
earlier element did".  A ``child`` step needs the ``exact`` bit of the step
before it, a ``desc`` step the ``ever`` bit.  So every axis test is evaluated
on the row itself: no self-join on ``page_id`` and no per-page shuffle.

An ``anchor`` step index captures the node id (and chain position) of the
innermost (or outermost) ancestor that completed the selector up to that step; relative
fields ("``.//img`` under this entry") group by it.

Two class tests exist and are kept apart: ``cls_sub`` is XPath's
``contains(@class, x)`` (substring), ``cls_tok`` is a class *token* test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let


@dataclass(frozen=True)
class Step:
    tag: str = "*"
    axis: str = "desc"            # "desc" = //, "child" = /
    eid: str | None = None        # @id = value
    cls_sub: str | None = None    # contains(@class, value)
    cls_tok: str | None = None    # class token
    cls_eq: str | None = None     # @class = value


def child(tag="*", **kw) -> Step:
    return Step(tag=tag, axis="child", **kw)


def desc(tag="*", **kw) -> Step:
    return Step(tag=tag, axis="desc", **kw)


@dataclass(frozen=True)
class Selector:
    steps: tuple[Step, ...]
    anchor: int | None = None     # 1-based step index whose match is captured
    outermost: bool = False       # capture the outermost such ancestor, not the innermost

    def then(self, *more: Step) -> "Selector":
        """Relative selector: these steps below the current one, anchored here."""
        return Selector(self.steps + tuple(more), anchor=len(self.steps))


def sel(*steps: Step) -> Selector:
    return Selector(tuple(steps))


def _step_match(step: Step, tag: Column, eid: Column, cls: Column) -> Column:
    cond = F.lit(True) if step.tag == "*" else (tag == F.lit(step.tag))
    if step.eid is not None:
        cond = cond & F.coalesce(eid == F.lit(step.eid), F.lit(False))
    if step.cls_sub is not None:
        cond = cond & F.coalesce(cls.contains(step.cls_sub), F.lit(False))
    if step.cls_eq is not None:
        cond = cond & F.coalesce(cls == F.lit(step.cls_eq), F.lit(False))
    if step.cls_tok is not None:
        toks = F.split(F.coalesce(cls, F.lit("")), r"[ \t\n\r\f]+")
        cond = cond & F.array_contains(toks, F.lit(step.cls_tok))
    return cond


def _transition(selector: Selector, state: Column, tag, eid, cls, nid, pos) -> Column:
    exact, ever = state["exact"], state["ever"]
    new_exact = F.lit(0)
    for k, step in enumerate(selector.steps, start=1):
        prev = exact if step.axis == "child" else ever
        ok = _step_match(step, tag, eid, cls) & (prev.bitwiseAND(F.lit(1 << (k - 1))) != 0)
        new_exact = new_exact + F.when(ok, F.lit(1 << k)).otherwise(F.lit(0))
    fields = [new_exact.alias("exact"), ever.bitwiseOR(new_exact).alias("ever")]
    if selector.anchor is not None:
        hit = new_exact.bitwiseAND(F.lit(1 << selector.anchor)) != 0
        if selector.outermost:
            hit = hit & state["anchor"].isNull()
        fields.append(F.when(hit, nid).otherwise(state["anchor"]).alias("anchor"))
        fields.append(F.when(hit, pos).otherwise(state["anchor_pos"]).alias("anchor_pos"))
    fields.append((state["n"] + 1).alias("n"))
    return F.struct(*fields)


def _init(selector: Selector) -> Column:
    fields = [F.lit(1).alias("exact"), F.lit(1).alias("ever")]
    if selector.anchor is not None:
        fields += [F.lit(None).cast("int").alias("anchor"), F.lit(None).cast("int").alias("anchor_pos")]
    fields.append(F.lit(0).alias("n"))
    return F.struct(*fields)


def chain_state(selector: Selector, chain: Column | None = None) -> Column:
    """NFA state after consuming the ancestor chain (root first)."""
    return F.aggregate(
        F.col("chain") if chain is None else chain, _init(selector),
        lambda st, e: _transition(selector, st, e["tag"], e["eid"], e["cls"], e["nid"], st["n"]))


def _final_bit(selector: Selector, state: Column) -> Column:
    return state["exact"].bitwiseAND(F.lit(1 << len(selector.steps))) != 0


def element_match(selector: Selector) -> Column:
    """True for element nodes matching the whole selector (node = last step)."""
    st = _transition(selector, chain_state(selector), F.col("tag"), F.col("attrs")["id"],
                     F.col("attrs")["class"], F.col("node_id"), F.size("chain"))
    return (F.col("kind") == "element") & _final_bit(selector, st)


def element_anchor(selector: Selector) -> Column:
    st = _transition(selector, chain_state(selector), F.col("tag"), F.col("attrs")["id"],
                     F.col("attrs")["class"], F.col("node_id"), F.size("chain"))
    return st["anchor"]


def parent_match(selector: Selector) -> Column:
    """True when the node's parent matches the selector (``.../x/text()``)."""
    return _final_bit(selector, chain_state(selector))


def parent_anchor(selector: Selector) -> Column:
    return chain_state(selector)["anchor"]


def match_all(elements: dict[str, Selector], texts: dict[str, Selector]) -> Column:
    """All selectors in one fold over the ancestor chain.

    A struct with a boolean for each name (``elements``: the node is an element
    that the selector matches; ``texts``: the node is a text whose parent it
    matches) and ``<name>_anchor`` where the selector has an anchor.
    """
    both = elements | texts
    folded = F.aggregate(
        F.col("chain"), F.struct(*[_init(s).alias(n) for n, s in both.items()]),
        lambda st, e: F.struct(*[_transition(s, st[n], e["tag"], e["eid"], e["cls"], e["nid"], st[n]["n"]).alias(n)
                                 for n, s in both.items()]))

    def last_step(st: Column) -> Column:
        return F.struct(*[_transition(s, st[n], F.col("tag"), F.col("attrs")["id"], F.col("attrs")["class"],
                                      F.col("node_id"), F.size("chain")).alias(n) for n, s in elements.items()],
                        *[st[n].alias(n) for n in texts])

    def result(st: Column) -> Column:
        fields = []
        for n, s in both.items():
            fields.append(((F.col("kind") == ("element" if n in elements else "text")) & _final_bit(s, st[n])).alias(n))
            if s.anchor is not None:
                fields.append(st[n]["anchor"].alias(f"{n}_anchor"))
        return F.struct(*fields)

    return let(let(folded, last_step), result)


def matching(nodes: DataFrame, elements: dict[str, Selector], texts: dict[str, Selector], *cols: str,
             root: bool = False) -> DataFrame:
    """``cols`` and ``m`` (see `match_all`) of the nodes that any selector matches; ``root``: and of each page's first.

    The tag test runs first; the fold is evaluated once per node (a generator
    is no place that the optimizer copies an expression through).
    """
    tags = {s.steps[-1].tag for s in elements.values()}
    first = F.col("node_id") == 0 if root else F.lit(False)
    near = F.col("kind") == "element" if "*" in tags else (F.col("kind") == "element") & F.col("tag").isin(*tags)
    if texts:
        near = near | (F.col("kind") == "text")

    def any_match(m: Column) -> Column:
        out = first
        for n in elements | texts:
            out = out | m[n]
        return out

    return nodes.where(near | first).select(
        *cols, F.explode(F.filter(F.array(match_all(elements, texts)), any_match)).alias("m"))


Site = tuple[dict[str, Selector], dict[str, Selector]]          # the selectors of elements and of texts


def _near(elements: dict[str, Selector], texts: dict[str, Selector]) -> Column:
    """The cheap test: a tag that some selector ends in, or a text."""
    tags = sorted({s.steps[-1].tag for s in elements.values()})
    out = (F.col("kind") == "text") if texts else F.lit(False)
    if "*" in tags:
        return out | (F.col("kind") == "element")
    return out | F.coalesce((F.col("kind") == "element") & F.col("tag").isin(*tags), F.lit(False)) if tags else out


def near_any(sites: dict[str, Site]) -> Column:
    """Nodes that the selectors of some site may match, or a page's first: a test without the site."""
    out = F.col("node_id") == 0
    for elements, texts in sites.values():
        out = out | _near(elements, texts)
    return out


def matching_by(nodes: DataFrame, site: str, sites: dict[str, Site], *cols: str) -> DataFrame:
    """`matching` for many sites in one pass: a row's column ``site`` picks its selectors, only those are run.

    ``m`` has a boolean for each name of any site, false where the row's site
    has no such selector.  Each page's first node stays; rows of other sites go.
    """
    names = sorted({n for elements, texts in sites.values() for n in elements | texts})

    def flags(own):
        return lambda x: F.struct(*[(F.coalesce(x[n], F.lit(False)) if n in own else F.lit(False)).alias(n) for n in names])

    m = near = None
    for name, (elements, texts) in sites.items():
        mine = F.col(site) == name
        found = let(match_all(elements, texts), flags(elements | texts))
        m = F.when(mine, found) if m is None else m.when(mine, found)
        near = F.when(mine, _near(elements, texts)) if near is None else near.when(mine, _near(elements, texts))
    first = F.col("node_id") == 0

    def any_match(x: Column) -> Column:
        out = first
        for n in names:
            out = out | x[n]
        return out

    return nodes.where(F.col(site).isin(*sites) & (near | first)).select(*cols, F.explode(F.filter(F.array(m), any_match)).alias("m"))


def select_elements(nodes: DataFrame, selector: Selector, prefilter_tag: bool = True) -> DataFrame:
    """Element nodes matching ``selector``; the cheap tag test runs first."""
    last = selector.steps[-1]
    df = nodes.where(F.col("kind") == "element")
    if prefilter_tag and last.tag != "*":
        df = df.where(F.col("tag") == last.tag)
    df = df.where(element_match(selector))
    if selector.anchor is not None:
        df = df.withColumn("anchor_id", element_anchor(selector))
    return df


def select_text(nodes: DataFrame, selector: Selector) -> DataFrame:
    """Text-node children of elements matching ``selector`` (XPath ``/text()``)."""
    df = nodes.where((F.col("kind") == "text") & parent_match(selector))
    if selector.anchor is not None:
        df = df.withColumn("anchor_id", parent_anchor(selector))
    return df


def first_value(df: DataFrame, keys: list[str], value: Column, name: str,
                default: str | None = None) -> DataFrame:
    """L1: first value in document order per key, with a default."""
    v = F.min_by(value, F.col("node_id"))
    if default is not None:
        v = F.coalesce(v, F.lit(default))
    return df.groupBy(*keys).agg(v.alias(name))
