from pagemill.operators.shred import HtmlScope, shred_html


def rows_by_tag(html, scopes=()):
    return [r for r in shred_html(html, scopes)]


def test_p_closes_open_p_and_inline_children():
    rows = rows_by_tag("<article><p><b>bold<br><p>two</p></article>")
    tags = [(r[5], r[6], r[2]) for r in rows]
    # article=0, p=1, b=2, text=3, br=4, p=5 (sibling of the first p), text=6
    assert tags[5] == ("element", "p", 0)
    assert tags[2] == ("element", "b", 1)


def test_script_is_raw_text_and_comment_kept():
    rows = rows_by_tag('<head><script>var t="</p>";</script></head><body><!-- c --><p>x</p></body>')
    kinds = [r[5] for r in rows]
    assert "rawtext" in kinds and "comment" in kinds
    raw = [r for r in rows if r[5] == "rawtext"][0]
    assert raw[8] == 'var t="</p>";'


def test_void_and_stray_end_tags():
    rows = rows_by_tag("<div><img src=a><br/></span>text</div>")
    div = rows[0]
    assert div[1] == len(rows) - 1  # end_id covers everything
    assert [r[6] for r in rows if r[5] == "element"] == ["div", "img", "br"]


def test_entities_and_attribute_defaults():
    rows = rows_by_tag('<a href="/x?a=1&amp;b=2" hidden>A &amp; B</a>')
    assert rows[0][7] == {"href": "/x?a=1&b=2", "hidden": ""}
    assert rows[1][8] == "A & B"


def test_scope_keeps_outer_html_of_root_and_children():
    html = "<body><article><h1>T</h1><p>one<p>two</article></body>"
    rows = rows_by_tag(html, (HtmlScope("article"),))
    art = [r for r in rows if r[6] == "article"][0]
    assert art[11] == "<article><h1>T</h1><p>one<p>two</article>"
    ps = [r[11] for r in rows if r[6] == "p"]
    assert ps == ["<p>one", "<p>two"]


def test_li_closes_li():
    rows = rows_by_tag("<ul><li>a<li>b</ul>")
    lis = [r for r in rows if r[6] == "li"]
    assert lis[0][2] == lis[1][2] == 0
