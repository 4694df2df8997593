"""Shred raw HTML pages into a ``nodes`` table (one row per DOM node).

This is the only Python step on the main path.  It runs per partition through
``mapInArrow``; everything after it is relational.  Each node row carries its
ancestor chain (root first) so that XPath-style axes become array predicates on
the row itself (see ``operators.select``) instead of self-joins on ``page_id``.

Tree-recovery rules (stated, since a browser's or lxml's recovery of broken
markup is not reproducible exactly):

* void elements never get children;
* ``script`` / ``style`` content is raw text (kind ``rawtext``), never markup,
  and is excluded from element text;
* a start tag of a block element closes an open ``p``; ``li`` closes an open
  ``li`` (likewise ``dt``/``dd``, ``tr``, ``td``/``th``, ``option``); closing
  an element also closes everything opened inside it;
* an end tag with no matching open element is ignored;
* comments are kept as nodes (kind ``comment``), the doctype is dropped;
* character references are decoded in text and attribute values.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# HTML element classes used by the recovery rules above.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset(("script", "style"))
CLOSES_P = frozenset(
    "address article aside blockquote details dialog dd div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
SELF_CLOSING_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
                         "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
                         "option": ("option",)}
SCOPE_BOUNDARY = frozenset(("table", "td", "th", "button", "html", "ul", "ol", "object", "template"))

CHAIN_TYPE = T.ArrayType(T.StructType([
    T.StructField("nid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("eid", T.StringType()),
    T.StructField("cls", T.StringType()),
]))

NODES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("end_id", T.IntegerType()),
    T.StructField("parent_id", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("sib", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()),
    T.StructField("start_off", T.IntegerType()),
    T.StructField("end_off", T.IntegerType()),
    T.StructField("html", T.StringType()),
    T.StructField("chain", CHAIN_TYPE),
])

_ARROW_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("node_id", pa.int32()), ("end_id", pa.int32()),
    ("parent_id", pa.int32()), ("depth", pa.int32()), ("sib", pa.int32()),
    ("kind", pa.string()), ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()),
    ("start_off", pa.int32()), ("end_off", pa.int32()), ("html", pa.string()),
    ("chain", pa.list_(pa.struct([("nid", pa.int32()), ("tag", pa.string()),
                                  ("eid", pa.string()), ("cls", pa.string())]))),
])


@dataclass(frozen=True)
class HtmlScope:
    """Elements whose outer HTML (and their children's) the shredder keeps.

    Keeping markup only for body roots and their direct children is a
    projection pushed into the scan: the rest of the page's HTML never leaves
    the task.  ``cls`` is a class *token* test.
    """
    tag: str
    eid: str | None = None
    cls: str | None = None

    def matches(self, tag, attrs) -> bool:
        if tag != self.tag:
            return False
        if self.eid is not None and attrs.get("id") != self.eid:
            return False
        if self.cls is not None and self.cls not in (attrs.get("class") or "").split():
            return False
        return True


class _TreeBuilder(HTMLParser):
    def __init__(self, html: str, scopes: tuple[HtmlScope, ...]):
        super().__init__(convert_charrefs=True)
        self.src = html
        self.scopes = scopes
        self.line_starts = [0]
        at = html.find("\n")
        while at >= 0:
            self.line_starts.append(at + 1)
            at = html.find("\n", at + 1)
        self.rows: list[list] = []  # node_id -> row
        self.stack: list[list] = []  # [node_id, tag, eid, cls, n_children, keep_children]
        self.chain: list[dict] = []
        self.top_children = 0

    # -- helpers -------------------------------------------------------
    def _offset(self) -> int:
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def _new_node(self, kind, tag, attrs, text, start):
        nid = len(self.rows)
        if self.stack:
            parent = self.stack[-1]
            parent_id, sib = parent[0], parent[4]
            parent[4] += 1
        else:
            parent_id, sib = -1, self.top_children
            self.top_children += 1
        row = [nid, nid, parent_id, len(self.stack), sib, kind, tag, attrs, text,
               start, start, None, list(self.chain)]
        self.rows.append(row)
        return row

    def _close_top(self, end_off):
        entry = self.stack.pop()
        self.chain.pop()
        row = self.rows[entry[0]]
        row[1] = len(self.rows) - 1
        row[10] = end_off
        if row[11] is not None:
            row[11] = self.src[row[9]:end_off]

    def _in_scope(self, names) -> int:
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][1]
            if tag in names:
                return i
            if tag in SCOPE_BOUNDARY:
                return -1
        return -1

    def _close_to(self, index, end_off):
        while len(self.stack) > index:
            self._close_top(end_off)

    # -- parser callbacks ---------------------------------------------
    def handle_starttag(self, tag, attrs):
        start = self._offset()
        if tag in CLOSES_P:
            i = self._in_scope(("p",))
            if i >= 0:
                self._close_to(i, start)
        if tag in SELF_CLOSING_SIBLINGS:
            i = self._in_scope(SELF_CLOSING_SIBLINGS[tag])
            if i >= 0:
                self._close_to(i, start)
        amap = {}
        for k, v in attrs:
            if k not in amap:
                amap[k] = "" if v is None else v
        raw = self.get_starttag_text() or ""
        row = self._new_node("element", tag, amap, None, start)
        keep = bool(self.stack and self.stack[-1][5]) or any(s.matches(tag, amap) for s in self.scopes)
        if keep:
            row[11] = ""
        if tag in VOID_TAGS:
            row[10] = start + len(raw)
            if keep:
                row[11] = raw
            return
        is_scope = any(s.matches(tag, amap) for s in self.scopes)
        self.stack.append([row[0], tag, amap.get("id"), amap.get("class"), 0, is_scope])
        self.chain.append({"nid": row[0], "tag": tag, "eid": amap.get("id"), "cls": amap.get("class")})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.stack and self.stack[-1][1] == tag:
            self._close_top(self._offset() + len(self.get_starttag_text() or ""))

    def handle_endtag(self, tag):
        start = self._offset()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][1] == tag:
                gt = self.src.find(">", start)
                self._close_to(i + 1, start)  # elements left open inside it
                self._close_top(len(self.src) if gt < 0 else gt + 1)
                return
        # stray end tag: ignored

    def handle_data(self, data):
        start = self._offset()
        kind = "rawtext" if self.stack and self.stack[-1][1] in RAW_TAGS else "text"
        row = self._new_node(kind, None, None, data, start)
        row[10] = start + len(data)
        if self.stack and self.stack[-1][5]:
            row[11] = data

    def handle_comment(self, data):
        start = self._offset()
        row = self._new_node("comment", None, None, data, start)
        row[10] = start + len(data) + 7
        if self.stack and self.stack[-1][5]:
            row[11] = "<!--" + data + "-->"

    def finish(self):
        self.close()
        self._close_to(0, len(self.src))
        return self.rows


def shred_html(html: str, scopes: tuple[HtmlScope, ...] = ()) -> list[list]:
    """Parse one page; returns node rows (see ``NODES_SCHEMA`` minus page_id)."""
    tb = _TreeBuilder(html or "", scopes)
    tb.feed(html or "")
    return tb.finish()


BATCH_NODES = 20_000     # node rows of an output batch; a page is never split over more batches than it needs


def _batches_to_nodes(scopes):
    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):      # one page's HTML in Python at a time
                pid = batch.column(0)[i].as_py()
                for r in shred_html(batch.column(1)[i].as_py(), scopes):
                    yield (pid, *r[:7], None if r[7] is None else list(r[7].items()), *r[8:])

    def fn(batches):
        it = rows(batches)
        while some := list(islice(it, BATCH_NODES)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*some), _ARROW_SCHEMA)], schema=_ARROW_SCHEMA)
    return fn


def shred(pages: DataFrame, scopes: tuple[HtmlScope, ...] = ()) -> DataFrame:
    """raw pages (page_id, html, ...) -> nodes.

    Only ``page_id`` and ``html`` enter Python; other page columns are joined
    back by callers that need them.
    """
    return pages.select("page_id", "html").mapInArrow(_batches_to_nodes(tuple(scopes)), NODES_SCHEMA)


def write_nodes(pages: DataFrame, scopes: tuple[HtmlScope, ...] = ()) -> str:
    """P1, written once as a parquet table under the shared checkpoint folder; its path.

    Several consumers (field aggregates, entries, body blocks) read the node
    table.  Left lazy, each would re-run the Python shredder, because the
    optimizer pushes each consumer's own filter and projection below any
    shared exchange.  Written once, the shredder runs once per page, a lost
    executor re-reads the table instead of re-parsing HTML, and every
    consumer's ``kind``/``tag`` filters and column pruning reach the scan.
    """
    import uuid

    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/nodes-{uuid.uuid4().hex[:16]}"
    shred(pages, scopes).write.mode("overwrite").parquet(path)
    return path


def nodes_by_page(pages: DataFrame, scopes: tuple[HtmlScope, ...] = ()) -> DataFrame:
    """The node table of ``pages``, written by `write_nodes`."""
    return pages.sparkSession.read.parquet(write_nodes(pages, scopes))
