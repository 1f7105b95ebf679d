from pyspark.sql import functions as F

from leafmill.functions import html as H
from leafmill.functions.references import expand_references, unescape
from leafmill.functions.text import strip_markup
from leafmill.operators.routes import html_documents

BLOCKS = {
    "<ul><li>a<p>b</p> c</li><li><div>d</div>e<li>f</ul>tail": ["a", "b", "c", "d", "e", "f"],
    "<p>foo <code>x</code> bar <code>y</code> z</p><code>alone</code> out": ["foo x bar y z", "alone"],
    "<table><tr><th>h<td>c<tr><td><p>q</td></table>z": ["h", "c", "q"],
    "<pre><code>k\n v</code></pre> no <blockquote><div>w</div></blockquote>": ["k\n v", "w"],
    "<dl><dt>t<dd>d</dl><p>a<div>b</div>c": ["t", "d", "a"],
    "<li>one<ul><li>two</ul>three</li>four": ["one", "two", "three"],
    "<table><tr><td><ul><li>x</ul>y</td></tr></table>": ["x", "y"],
    "<div><p>p1<p>p2</div>tail": ["p1", "p2"],
    "<P CLASS=x>Up <B>bold</b><br>next</P>": ["Up boldnext"],
    "<script>var t='</p><p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes": ["yes"],
    "<p> \u00a0 </p><p></p>": [],
    "no blocks <b>here</b>": [],
    "<p>1 < 2 and 3 > 2</p>": ["1 < 2 and 3 > 2"],
    "<p>a<!-- <p>open": ["a"],
    "<p>x<script>var <p>y": ["x"],
    "<p>5 <b>< 6": ["5 < 6"],
    "<article>x<p>in</p>y</article>": ["in"],
}


def test_blocks(column):
    assert column(list(BLOCKS), "string", lambda c: H.blocks(H.visible_html(c))) == list(BLOCKS.values())


def test_many_blocks(column):
    page = "".join(f"<div><p>{i}</p></div>" for i in range(3000))
    (got,) = column([page], "string", lambda c: H.blocks(H.visible_html(c)))
    assert got == [str(i) for i in range(3000)]


def test_chapter_blocks(column):
    page = "<pre>no</pre><p>a <code>b</code><dl><dd>no<p>c</dl><li>d<dt>e"
    (got,) = column([page], "string", lambda c: H.blocks(H.visible_html(c), H.CHAPTER_BLOCKS))
    assert got == ["a b", "c", "d", "e"]


def test_references(column):
    cases = {
        "&lt;b&gt; &quot;q&quot; &#39;s&#39;": "<b> \"q\" 's'",
        "&eacute;&#233;&#xE9;&#x1F600;": "ééé\U0001f600",
        "&amp;lt; &amp;amp; &amp;eacute;": "&lt; &amp; &eacute;",
        "&bogus; & &x &;": "&bogus; & &x &;",
        "&nbsp;&copy;&middot;&hellip;": "\u00a0©·…",
        "&#60;&#38;": "<&",
        "&#0; &#55296; &#1114112;": "&#0; &#55296; &#1114112;",
        "none": "none",
    }
    assert column(list(cases), "string", lambda c: unescape(expand_references(c))) == list(cases.values())
    (xml,) = column(["&eacute;&#233;"], "string", lambda c: unescape(expand_references(c, named=False)))
    assert xml == "&eacute;é"


def test_headings_and_titles(column):
    page = "<title> T &amp; x </title><svg><title>s</title></svg><h1>A<b>b</b></h1><H2 class=x>c&lt;d</h2><h3> </h3><h6>z</h6>"
    (got,) = column([page], "string", lambda c: H.headings(H.visible_html(c)))
    assert [tuple(h) for h in got] == [(1, "Ab"), (2, "c<d"), (6, "z")]
    assert column([page, "<p>x", "<title> </title>"], "string", lambda c: H.title(H.visible_html(c))) == ["T & x", None, None]
    assert column([page], "string", lambda c: H.titles(H.visible_html(c))) == [["T & x", "s"]]


def test_unclosed_headings(column):
    (got,) = column(["<h1>a<h2>b</h2><h3>c"], "string", lambda c: H.headings(H.visible_html(c)))
    assert [tuple(h) for h in got] == [(1, "a"), (2, "b"), (3, "c")]


def test_stray_marks_cost_no_rescans(column):
    pages = ["<" * 300_000, "<!--" * 100_000, "<script>" * 50_000, "<script " * 50_000, "<h1>" * 20_000, "<p>" + "<b " * 100_000]
    assert column(pages, "string", lambda c: F.size(H.blocks(H.visible_html(c)))) == [0, 0, 0, 0, 0, 1]
    assert column(pages, "string", lambda c: F.size(H.headings(H.visible_html(c)))) == [0] * 6
    assert column(["<" * 300_000], "string", strip_markup) == ["<" * 300_000]


def test_document(files):
    rows = html_documents(
        files(("a.html", b"<title>T</title><h1>H</h1><p>one\r\n\r\n\r\ntwo<p>three"), ("b.html", b"<p>x"), ("c.html", b"-"))
    ).collect()
    a, b, c = sorted(rows, key=lambda r: r.path)
    assert a.text == "# T\n\none\n\ntwo\n\nthree" and a.meta.title == "T" and a.meta.format == "HTML"
    assert [tuple(h) for h in a.structure] == [(1, "H")]
    assert b.text == "x" and b.structure is None and b.meta.title is None
    assert c.text == "" and c.meta.word_count == 0
