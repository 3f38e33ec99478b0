import pytest
from pyspark.sql import functions as F

from foliospark.functions import html as H, markdown as M
from foliospark.operators import convert


def one(spark, fn, text):
    return spark.createDataFrame([(text,)], "x string").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("html, markdown", [
    ("<html><body><h1>Sample</h1><p>Test content.</p></body></html>", "# Sample\n\nTest content."),
    ("", ""),
    ("<p>a <b>bold</b> <i>it</i> <em><strong>both</strong></em><br>next", "a **bold** *it* ***both***  \nnext"),
    ("<p>open <b>bold<p>next</b>", "open bold\n\nnext"),
    ("<p><b> pad </b>x<b></b>", "**pad** x"),
    ("<p><a class='c' href='u'>t</a> <a name=x>no</a>", "[t](u) no"),
    ("<b><a href=\"u\">t</a></b>", "**[t](u)**"),
    ("<ul><li>one<li><p>two</p></ul><p>end", "- one\n- two\n\nend"),
    ("<ol><li>a</li><li>b</li></ol>", "1. a\n1. b"),
    ("x<pre class=c>\n  a &lt;b&gt;\n\n  *c*\n</pre>y", "x\n\n```\n  a <b>\n\n  *c*\n```\n\ny"),
    ("<p>use <code>a*b</code> not a*b", "use `a*b` not a\\*b"),
    ("<blockquote><p>q1</p><p>q2</p></blockquote>z", "> q1\n> \n> q2\n\nz"),
    ("<table><thead><tr><th>A</th><th>B|C</th></tr></thead><tbody><tr><td>1</td><td><p>2</p></td></tr></tbody></table>",
     "| A | B\\|C |\n| --- | --- |\n| 1 | 2 |"),
    ("<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>",
     "| | |\n| --- | --- |\n| 1 | 2 |\n| 3 | 4 |"),
    ("a<hr/>b", "a\n\n---\n\nb"),
    ("<p># no<p>1. no<p>- no<p>a # b", "\\# no\n\n1\\. no\n\n\\- no\n\na # b"),
    ("<p>&lt;tag&gt; &amp;lt; &#8217; &#x41; &#0; &nope; &euro;", "\\<tag> &lt; ’ A � &nope; €"),
    ("<script>var t='</p>'</script><style>p{}</style><!-- c --><p>x", "x"),
    ("<p>x<script>never closed <p>y", "x"),
    ("<h2>a <i>b</i></h2><h6>c</h6>", "## a *b*\n\n###### c"),
    ("<title>t</title><custom>kept</custom>", "tkept"),
])
def test_html_to_markdown(spark, html, markdown):
    assert one(spark, H.to_markdown, html) == markdown


HTML = [
    ('<p>x <a href="u"><span>t</span> <b>b</b></a> y', "x [t **b**](u) y"), ("<a href=u>t</a>", "[t](u)"), ("<a class=c href='a b?x=1&amp;y=2' id=z>t</a>", "[t](a%20b?x=1&y=2)"),
    ('<a href="u"><h2>T <i>i</i></h2></a><p>z', "## [T *i*](u)\n\nz"), ('<a href="u"><div>a</div><div>b</div></a>', "[a b](u)"), ("<a href=u>open <p>next", "open\n\nnext"),
    ("no</a> <a name=x>n</a>", "no n"), ('<img src="i.png" alt="An  image"> <IMG alt=x> <img src=j.png>', "![An image](i.png) ![](j.png)"),
    ('wow!<a href="u"><img src=i alt="p"></a>', "wow\\![![p](i)](u)"),
    ("<ul><li>a<ul><li>b<ol><li>c</li><li>d</li></ol></li></ul></li><li>e</li></ul>z", "- a\n  - b\n    1. c\n    1. d\n- e\n\nz"),
    ("<ol><li>a<ul><li>b</ul>more<li>c</ol><p>z", "1. a\n   - b\n   more\n1. c\n\nz"), ("</ul></ol><li>x</ul><ol><li>y", "- x\n\n1. y"),
    ("<ul><li><a href=u><em>x</em></a><li><p>q</p></ul>", "- [*x*](u)\n- q"),
]


def test_links_images_and_lists_to_markdown(spark):
    rows = spark.createDataFrame([(k, h) for k, (h, _) in enumerate(HTML)], "page_id int, html string")
    got = {r.page_id: r.markdown for r in convert.html_to_markdown(rows).collect()}
    for k, (html, markdown) in enumerate(HTML):
        assert got[k] == markdown, html


def test_many_unclosed_tags_are_linear(spark):
    html = "<b>x<p>" * 30_000 + "<script>" * 10_000
    assert one(spark, H.to_markdown, html).startswith("x\n\nx")


def test_html_text_blocks_links(spark):
    html = ("<title>A &amp; b</title><script>'</p>'</script><h1>H</h1><p>one<br>two<p>three<ul><li>i <a href='x?a&amp;b'>L "
            "<b>m</b></a></ul><footer>f</footer><a>no</a>")
    assert one(spark, H.plain_text, html) == "A & b H one two three i L m f no"
    assert one(spark, H.title_of, html) == "A & b"
    assert [(b.tag, b.html) for b in one(spark, H.block_pieces, html)] == [
        ("h1", "H"), ("p", "one<br>two"), ("p", "three"), ("li", "i <a href='x?a&amp;b'>L <b>m</b></a>")]
    assert [(x.href, x.text) for x in one(spark, H.link_pieces, html)] == [("x?a&b", "L m")]


@pytest.mark.parametrize("markdown, html", [
    ("# Sample\n\nThis is a test markdown document.\n",
     '<h1 id="sample">Sample</h1>\n<p>This is a test markdown document.</p>'),
    ("", ""),
    ("a\nb\n\nc", "<p>a\nb</p>\n<p>c</p>"),
    ("- a\n- b\n\n- c\n1. x\n2) y", "<ul>\n<li>a</li>\n<li>b</li>\n<li>c</li>\n</ul>\n<ol>\n<li>x</li>\n<li>y</li>\n</ol>"),
    ("**b** *i* __b__ _i_ a_b_c `x*y<` [l](u) ![p](q)",
     '<p><strong>b</strong> <em>i</em> <strong>b</strong> <em>i</em> a_b_c <code>x*y&lt;</code> '
     '<a href="u">l</a> <img src="q" alt="p" /></p>'),
    ("```py\nif a < b:\n# no\n```\nend", '<pre class="py"><code>if a &lt; b:\n# no</code></pre>\n<p>end</p>'),
    ("~~~\n```\nx\n~~~", "<pre><code>```\nx</code></pre>"),
    ("```\nopen", "<pre><code>open</code></pre>"),
    ("> q\n> r\n\n***", "<blockquote>\n<p>q\nr</p>\n</blockquote>\n<hr />"),
    ("AT&T &amp; 1 < 2 <b>x</b>", "<p>AT&amp;T &amp; 1 &lt; 2 <b>x</b></p>"),
    ("line  \nnext", "<p>line<br />\nnext</p>"),
    ("a\r\nb", "<p>a\nb</p>"),
    ("####### seven", "<p>####### seven</p>"),
    ("* not * em", "<ul>\n<li>not * em</li>\n</ul>"),
])
def test_markdown_to_html(spark, markdown, html):
    assert one(spark, M.to_html, markdown) == html


MARKDOWN = [
    ("Title\n=====\ntext\nSub\n---\n\n---\n- i\n---", '<h1 id="title">Title</h1>\n<p>text</p>\n<h2 id="sub">Sub</h2>\n<hr />\n<ul>\n<li>i</li>\n</ul>\n<hr />'),
    ("a\n===\n# a\n## a ##\n### b", '<h1 id="a">a</h1>\n<h1 id="a-1">a</h1>\n<h2 id="a-2">a</h2>\n<h3 id="b">b</h3>'),
    ("| a | b **c** |\n|---|:-:|\n| 1 | 2\\|3 |\n4|5|6\n7|\nend", "<table>\n<thead>\n<tr>\n<th>a</th>\n<th align=\"center\">b <strong>c</strong></th>\n"
     "</tr>\n</thead>\n<tbody>\n<tr>\n<td>1</td>\n<td align=\"center\">2|3</td>\n</tr>\n<tr>\n<td>4</td>\n<td align=\"center\">5</td>\n</tr>\n"
     "<tr>\n<td>7</td>\n<td align=\"center\"></td>\n</tr>\n</tbody>\n</table>\n<p>end</p>"),
    ("x|y\n:--|--:", '<table>\n<thead>\n<tr>\n<th align="left">x</th>\n<th align="right">y</th>\n</tr>\n</thead>\n</table>'),
    ("a|b|c\n--|--\nd", "<p>a|b|c\n--|--\nd</p>"),
    ("- a\n  - b\n    1. c\n    2. d\n  - e\n- f", "<ul>\n<li>a\n<ul>\n<li>b\n<ol>\n<li>c</li>\n<li>d</li>\n</ol>\n</li>\n<li>e</li>\n</ul>\n</li>\n<li>f</li>\n</ul>"),
    ("1. a\n   more\n\n   - b\n\n\n- c\nend", "<ol>\n<li>a\nmore\n<ul>\n<li>b</li>\n</ul>\n</li>\n</ol>\n<ul>\n<li>c</li>\n</ul>\n<p>end</p>"),
    ("* a\n\t+ b\n1. c\n   * d\n# h", "<ul>\n<li>a\n<ul>\n<li>b</li>\n</ul>\n</li>\n</ul>\n<ol>\n<li>c\n<ul>\n<li>d</li>\n</ul>\n</li>\n</ol>\n<h1 id=\"h\">h</h1>"),
    ("p\n\n- a\n  - b\n\nq", "<p>p</p>\n<ul>\n<li>a\n<ul>\n<li>b</li>\n</ul>\n</li>\n</ul>\n<p>q</p>"),
    ("[a b][Ref] [ref][] [ref] [no] ![pic][ref] [x](y) `[ref]`\n\n[REF]: http://x.org/q?a=1&b \"T\"\n[ref]: other", '<p><a href="http://x.org/q?a=1&b">a b</a> '
     '<a href="http://x.org/q?a=1&b">ref</a> <a href="http://x.org/q?a=1&b">ref</a> [no] <img src="http://x.org/q?a=1&b" alt="pic" /> <a href="y">x</a> '
     "<code>[ref]</code></p>"),
    ("```\na|b\n---|---\n[r]: u\n  - x\n===\n```\n[r]", "<pre><code>a|b\n---|---\n[r]: u\n  - x\n===</code></pre>\n<p>[r]</p>"),
]


def test_tables_nested_lists_underlined_headings_references(spark):
    rows = spark.createDataFrame([(k, m) for k, (m, _) in enumerate(MARKDOWN)], "doc_id int, markdown string")
    got = {r.doc_id: r.html for r in convert.markdown_to_html(rows, standalone=False).collect()}
    for k, (markdown, html) in enumerate(MARKDOWN):
        assert got[k] == html, markdown


def test_anchors_are_the_ids_of_the_page(spark):
    import re

    text = "# A\n## See [link](u)\n# A\nB c\n---\n#### A\n### `A`\n## [t][r] & *x*\n\n[r]: http://u\n\n    # code? no\nLast\n==="
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, markdown string")
    html = {r.doc_id: r.html for r in convert.markdown_to_html(docs, standalone=False).collect()}
    toc = convert.markdown_toc(docs, depth=6).orderBy("pos").collect()
    ids = re.findall(r'id="([^"]*)"', html[1])
    assert [t.anchor for t in toc] == ids == ["a", "see-link", "a-1", "b-c", "a-2", "a-3", "t-x", "last"]
    assert [t.number for t in toc] == ["1", "1.1", "2", "2.1", "2.1.0.1", "2.1.1", "2.2", "3"]
    assert [t.anchor for t in convert.markdown_toc(docs, depth=1).orderBy("pos").collect()] == ["a", "a-1", "last"]
    assert "Exchange" not in convert.markdown_toc(docs)._jdf.queryExecution().executedPlan().toString()


def test_long_lists_and_tables_take_little_more_than_linear_time(spark):
    import time

    for line, extra in (("- a\n  - b\n", ""), ("a|b\n", "c|d\n--|--\n"), ("# a\n", "")):
        page = spark.range(1).select(F.lit(1).alias("doc_id"), F.concat(F.lit(extra), F.repeat(F.lit(line), 20_000)).alias("markdown"))
        started = time.monotonic()
        convert.markdown_to_html(page).collect()
        assert time.monotonic() - started < 60, line


def test_markdown_page(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id int, markdown string")
    page = convert.markdown_to_html(docs).first().html
    assert page.startswith("<!DOCTYPE html>") and "<body>\n<p>x</p>\n</body>" in page
    assert convert.markdown_to_html(docs, standalone=False).first().html == "<p>x</p>"


def test_markdown_blocks_and_toc(spark):
    text = "# A\n\n```\n# no\n```\n### Deep\n## B ##\n- i\n***\n# A\n#### four\ntext"
    docs = spark.createDataFrame([(1, text), (2, "")], "doc_id int, markdown string")
    blocks = convert.markdown_blocks(docs).orderBy("pos").collect()
    assert [(b.pos, b.kind, b.level, b.text) for b in blocks] == [
        (0, "heading", 1, "A"), (1, "blank", 0, ""), (2, "code", 0, "# no"), (3, "heading", 3, "Deep"),
        (4, "heading", 2, "B"), (5, "item", 0, "i"), (6, "rule", 0, ""), (7, "heading", 1, "A"),
        (8, "heading", 4, "four"), (9, "text", 0, "text")]
    toc = convert.markdown_toc(docs).orderBy("pos").collect()
    assert [(t.number, t.text, t.anchor) for t in toc] == [
        ("1", "A", "a"), ("1.0.1", "Deep", "deep"), ("1.1", "B", "b"), ("2", "A", "a-1")]
    assert [t.number for t in convert.markdown_toc(docs, depth=1).orderBy("pos").collect()] == ["1", "2"]


def test_email_body(spark):
    rows = [
        (1, 0, "image/png", "x"), (2, 0, "text/html", "only"), (3, 0, "text/html", "h1"), (3, 1, "TEXT/PLAIN; charset=x", "p1"),
        (3, 2, "text/plain", "p2"), (4, 0, "text/html", "h1"), (4, 1, "text/html", "h2"), (4, 2, "image/png", "z"),
        (5, 0, "multipart/mixed", "n"), (5, 1, "image/png", "z"), (6, 0, "text/csv", "a,b")]
    parts = spark.createDataFrame(rows, "doc_id int, part_no int, content_type string, content string")
    got = {r.doc_id: r.body for r in convert.email_body(parts).collect()}
    assert got == {1: "", 2: "only", 3: "p1", 4: "h2", 5: "", 6: "a,b"}


def test_unclosed_tags_take_linear_time(spark):
    import time

    page = spark.range(1).select(F.lit(1).alias("page_id"), F.repeat(F.lit("<p x <a y <td "), 70_000).alias("html"))
    page.count()
    for operator in (convert.html_text, convert.html_to_markdown, convert.html_blocks, convert.html_links):
        started = time.monotonic()
        operator(page).collect()
        assert time.monotonic() - started < 20, operator.__name__


def test_all_references_and_unquoted_links(spark):
    page = spark.createDataFrame([(1, "<a class=x href=/a?b=1>Caf&eacute;</a> &NotEqualTilde; &#x1F600; &#00000233; &nosuch; &#x110000;")],
                                 "page_id int, html string")
    assert convert.html_text(page).first().text == "Café ≂̸ 😀 é &nosuch; \ufffd"
    assert [(r.href, r.text) for r in convert.html_links(page).collect()] == [("/a?b=1", "Café")]


def test_angle_brackets_in_quoted_values(spark):
    html = ("<p class='x<y'>one <a title=\"a < b\" href=\"/x\">text</a> <img alt=\"x<y\"> <b title='>'>two</b>"
            "<li data-a=\"</p>\">it's <a href='/q?a<b'>L</a></li><p it's=1>three<p x=\"open")
    page = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [(r.href, r.text) for r in convert.html_links(page).collect()] == [("/x", "text"), ("/q?a<b", "L")]
    assert convert.html_text(page).first().text == "one text two it's L three<p x=\"open"
    assert convert.html_to_markdown(page).first().markdown.startswith("one [text](/x) **two**\n- it's [L](/q?a<b)")
    assert [(b.tag, b.html) for b in one(spark, H.block_pieces, html)][0] == (
        "p", "one <a title=\"a < b\" href=\"/x\">text</a> <img alt=\"x<y\"> <b title='>'>two</b>")


def test_unclosed_quoting_tags_take_linear_time(spark):
    import time

    page = spark.range(1).select(F.lit(1).alias("page_id"), F.concat(F.lit("<p "), F.repeat(F.lit("a=\"<p \" b='<a '"), 60_000)).alias("html"))
    page.count()
    for operator in (convert.html_text, convert.html_to_markdown, convert.html_blocks, convert.html_links):
        started = time.monotonic()
        operator(page).collect()
        assert time.monotonic() - started < 20, operator.__name__
