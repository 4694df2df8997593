"""Canonical markup, the reformatters on golden pages, and the blocklist at any size."""
import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators.gates import blocked, not_blocked
from pagemill.operators.markup import events, folded, reformat_by_paragraphs, reformat_keeping_styles
from pagemill.operators.select import desc, sel
from pagemill.operators.shred import shred, shred_html

ROOT = sel(desc("article"))


def nodes(spark, pages):
    return shred(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"))


def markup(spark, pages):
    n = nodes(spark, pages).groupBy("page_id").agg(folded(events()).alias("m"))
    got = {r["page_id"]: r["m"] for r in n.collect()}
    return [got.get(i) for i in range(len(pages))]


def test_canonical_markup(spark):
    pages = ["<p>a<br>b<p class=x id='y'>c &lt; d &amp; \"e\"", "<div a='say \"hi\"' b=\"it's\" c='&quot;&#39;&lt;'><!-- c --><script>a < b && c</script></div>",
             "<ul><li>1<li>2</ul><img src=x><hr/>t", "a<b><i>x</i></b>&copy;<b></b>"]
    assert markup(spark, pages) == [
        '<p>a<br/>b</p><p class="x" id="y">c &lt; d &amp; "e"</p>',
        "<div a='say \"hi\"' b=\"it's\" c=\"&quot;'&lt;\"><!-- c --><script>a < b && c</script></div>",
        '<ul><li>1</li><li>2</li></ul><img src="x"/><hr/>t', "a<b><i>x</i></b>©<b></b>"]


def test_parsing_the_output_gives_the_same_nodes(spark):
    rng = random.Random(5)
    tags = ["p", "div", "b", "a", "ul", "li", "span", "table", "tr", "td", "br", "img", "h1", "em"]
    pages = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 40)):
            t = rng.choice(tags)
            parts.append(rng.choice([f"<{t}>", f"</{t}>", f"<{t} class='a&amp;b' x=\"'\">", "text & more ", "<!-- n -->", " &lt;", "é", "<script>1<2</script>"]))
        pages.append("".join(parts))
    out = markup(spark, pages)
    for page, m in zip(pages, out):
        assert _shape(m or "") == _shape(page)


def _shape(html):
    """(depth, kind, tag, attributes or text) in document order; neighbouring text pieces are one (a parser may cut text anywhere)."""
    out = []
    for _, _, parent, depth, _, kind, tag, attrs, text, *_ in shred_html(html):
        if kind in ("text", "rawtext") and out and out[-1][1] == kind and out[-1][4] == parent:
            out[-1][3] += text
        else:
            out.append([depth, kind, tag, list(attrs.items()) if attrs is not None else text, parent])
    return [x[:4] for x in out]


def keep_styles(spark, pages, paths=(), patterns=()):
    p = spark.createDataFrame(list(paths), "page_id long, url string, path string")
    b = spark.createDataFrame([(x,) for x in patterns], "pattern string")
    got = {r["page_id"]: r["formatted_content"] for r in reformat_keeping_styles(nodes(spark, pages), ROOT, p, b).collect()}
    return [got.get(i) for i in range(len(pages))]


def test_reformat_keeping_styles(spark):
    pages = [
        "<article><p>see <a href=x><b>this</b> link<img src=q></a> now</p>\n <p style='c'>two</p></article>",
        "<article><iframe><p>in</p></iframe><mpvoice>v</mpvoice><qqmusic></qqmusic><blockquote><p>q</p></blockquote><script>s</script>"
        "<span class='x db'>a</span><span class='tips_global'>b</span><span class=dbx>stays</span><div id=js_sponsor_ad_area>ad</div><div>d</div></article>",
        "<article><p> \t</p><p>&nbsp;</p><p><b> </b></p><p><br></p><p><img src=k></p><p>&amp;nbsp;</p><p><b>&amp;nbsp;</b></p><p>&amp;nbsp;<i>x</i></p>"
        "<p><a>&amp;nbsp;</a></p></article>",
        "<article><p><img alt=a src=' http://i/1.png ' style='height: 20px;width:3px'></p><img data-src='ftp://i/2.png'><img src='http://i/none.png' alt=b>"
        "<img src='rel.png' alt=c><p>x<img src='http://i/spam/3.png'></p><p><img src='http://i/spam/3.png'></p></article>",
        "<article><img alt=a src='http://i/1.png' style='height:20px'></article>",
        "<p>no root</p>", "<article></article>", "<article><p>outer <article><p>inner</p></article></p></article>",
        "<article>a \n  <b> c</b>　d\r\n\te</article>"]
    paths = [(3, "http://i/1.png", "p/1"), (3, "ftp://i/2.png", "p/2"), (3, "http://i/spam/3.png", "p/3"), (0, "http://unused", "u")]
    assert keep_styles(spark, pages, paths, ["/spam/", None]) == [
        '<article><p>see this link now</p><p style="c">two</p></article>',
        '<article><span class="dbx">stays</span><div>d</div></article>',
        '<article><p><img src="k"/></p><p>&amp;nbsp;<i>x</i></p></article>',
        '<article><p><img src="p/1" style="height:auto;width:3px"/></p><img data-src="ftp://i/2.png" src="p/2"/><img src=""/>'
        '<img src="rel.png"/><p>x</p></article>',
        '<article><img alt="a" src="http://i/1.png" style="height:20px"/></article>',
        None, "<article></article>", "<article><p>outer</p><article><p>inner</p></article></article>",
        "<article>a<b>c</b>de</article>"]


def by_paragraphs(spark, pages, paths=()):
    p = spark.createDataFrame(list(paths), "page_id long, url string, path string")
    got = {r["page_id"]: r["formatted_content"] for r in reformat_by_paragraphs(nodes(spark, pages), ROOT, p).collect()}
    return [got.get(i) for i in range(len(pages))]


def test_reformat_by_paragraphs(spark):
    pages = [
        "<article><h1>t</h1><p class=c>one <a href=x>link <strong>s</strong></a></p>lost<p>two<iframe>f</iframe></p><p> </p><p><br></p></article>",
        "<article><p>x</p><table><tr><td>1</td></tr></table></article>",
        "<article><div><img src='http://i/1.png' alt=a></div><p>t <img alt=b data-src=ftp://i/2.png></p><img src=rel.png alt=k></article>",
        "<article><p>a<object><p>b</p></object>c</p><p>d</p></article>", "<article>none</article>", "<p>no root</p>",
        "<article><img src='http://i/1.png' alt=a></article>", "<article><p><pre>x</pre></p></article>"]
    assert by_paragraphs(spark, pages, [(2, "http://i/1.png", "p/1"), (2, "ftp://i/2.png", "p/2")]) == [
        "one link<b>s</b><br/>two<br/>",
        "", '<img src="p/1"/><br/>t<img data-src="ftp://i/2.png" src="p/2"/><br/><img src="rel.png"/><br/>',
        "a<object>b</object>c<br/>d<br/>", "", None, '<img src="http://i/1.png" alt="a"/><br/>', ""]


@pytest.mark.parametrize("n", [3, 1500])
def test_blocklist_equals_the_plain_test(spark, n):
    rng = random.Random(n)
    word = lambda k: "".join(rng.choice("ab/é.") for _ in range(k))
    urls = ["http://" + word(rng.randint(0, 30)) for _ in range(400)] + [None, ""]
    patterns = [word(rng.randint(1, 14)) if i % 3 else "http://" + word(6) for i in range(n)] + [None]
    df = spark.createDataFrame([(u, "own", 1) for u in urls + urls[:20]], "url string, pattern string, _n int")
    pat = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    hit = lambda u: u is not None and any(p in u for p in patterns if p is not None)
    kept = not_blocked(df, "url", pat)
    assert "NestedLoop" not in kept._jdf.queryExecution().toString()
    want = [u for u in urls + urls[:20] if not hit(u)]
    assert sorted(str(r["url"]) for r in kept.collect()) == sorted(map(str, want)) and kept.columns == df.columns
    assert sorted(r["url"] for r in blocked(df, "url", pat).collect()) == sorted(u for u in urls + urls[:20] if hit(u))


def test_blocklist_of_nothing_and_of_the_empty_pattern(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "url string")
    none = spark.createDataFrame([], "pattern string")
    assert not_blocked(df, "url", none).count() == 3 and blocked(df, "url", none).count() == 0
    every = spark.createDataFrame([("",)], "pattern string")
    assert [r["url"] for r in not_blocked(df, "url", every).collect()] == [None]
    assert not_blocked(df.where(F.lit(False)), "url", every).collect() == []
