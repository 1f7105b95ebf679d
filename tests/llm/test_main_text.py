import pytest
from llm_data import clashing

from leafmill.llm import main_text as mt

P = "This is a paragraph of the story with a good number of ordinary words in it."
Q = "And here the story goes on for a while, as stories do, until it comes to its end."
MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News of today</a></li></ul></nav>'
FOOT = "<footer>&copy; 2020 The Daily. All rights reserved.</footer>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("no tags at all", "no tags at all"),
        (f"<html><body>{MENU}<article><h1>Title</h1><p>{P}</p></article>{FOOT}</body></html>", f"Title {P}"),
        (f"<body>{MENU}<div class='ad'>Buy this thing now, it is cheap and good.</div><main><p>{P}<p>{Q}</main>{FOOT}", f"{P} {Q}"),
        (f"<body>{MENU}<div id=content><p>{P}</p><aside>See also our other tales.</aside><p>{Q}</p></div>{FOOT}", f"{P} {Q}"),
        (f"<article><p>{P}</p><form><label>Name</label><input name=x></form><p>{Q}</p></article>", f"{P} {Q}"),
        (f"<article><p>{P}</p></article><section class='comments'><p>I liked this one a lot!</p></section>", P),
        (f"<article><p>{P}</p><div class='cookie-notice'>We use cookies on this site.</div></article>", P),
        ("<article><p>a &amp; b &lt;c&gt; &#233;&nbsp;d\n\n e</p></article>", "a & b <c> é d e"),
        ("<article><p>one<b>two</b> <i>three</i><br>four</p></article>", "onetwo three four"),
        ("<article><p>x</p><script>var t='</p>words';</script><style>p{}</style><!-- hidden words --><p>y</p></article>", "x y"),
        ("<article><p><b>open<br><p>next</p></article><footer>end of the page here", "open next"),
        ("<article><p title='a > b'>kept</p><p hidden>not</p></article>", "kept"),
    ],
)
def test_pages(page, text):
    assert mt.main_text(page, {}) == text


def test_broken_and_long_pages_take_linear_time():
    import time

    start = time.time()
    for page in ("<" * 200_000, "<p " * 50_000, "<a title='" * 20_000, "<div>" * 20_000 + "x", "<!--" * 50_000):
        mt.main_text(page, {})
    assert time.time() - start < 30


def test_extract(spark):
    long = "word " * 60_000
    rows = [
        (1, "u", None),
        (2, None, ""),
        (None, "u", f"<article><p>{P}</p></article>"),
        (3, "u", f"<article><p>{long}</p></article>"),
        (3, "u", f"<article><p>{long}</p></article>"),
        (4, "u", "   "),
    ]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(mt.extract(pages).collect(), key=lambda r: (r.page_id or 0, r.n_chars))
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [
        (None, P, len(P)),
        (1, "", 0),
        (2, "", 0),
        (3, long.strip(), len(long) - 1),
        (3, long.strip(), len(long) - 1),
        (4, "", 0),
    ]
    assert mt.extract(pages.limit(0)).count() == 0


def test_fitted_weights_find_what_the_prior_cannot(spark):
    # Boxes without a telling name stand before the article of labelled pages; the last page has no label.
    box = "<div class='zq'>Nothing to see in this box, just a few words of no use to anyone at all.</div>"
    rows = [(i, "u", f"<body>{box}<article><p>{P} {i}</p><p>{Q}</p></article></body>") for i in range(80)]
    pages = spark.createDataFrame([*rows, (99, "u", f"<body>{box}<div><p>{P}</p><p>{Q}</p></div></body>")], "page_id long, url string, html string")
    weights = mt.fit(pages, least=10)
    assert weights["t div div.zq"] < -2
    assert {r.page_id: r.text for r in mt.extract(pages, weights).collect()}[99] == f"{P} {Q}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # A head without an end ends at what cannot stand in it.
        (f"<html><head><title>T</title><meta charset=utf-8><body>{MENU}<article><p>{P}</p></article>{FOOT}</body></html>", P),
        (f"<head><title>T</title><link rel=x><p>{P}</p>", P),
        (f"<head><title>T</title> {P}", P),
        (f"<head><title>T</title><script>var x;</script><style>p{{}}</style></head><body><p>{P}</p>", P),
        # A form around the page is no form in the page.
        (f"<body><form id='aspnetForm' role='form' method=post>{MENU}<div><p>{P}</p><p>{Q}</p></div>{FOOT}</form></body>", f"{P} {Q}"),
        (f"<body><form><article><p>{P}</p><select><option>{Q} {Q}</select></article></form><form><p>Name</p></form>", P),
        (f"<article><p>{P}</p><form><p>Leave your name and mail</p></form><p>{Q}</p></article>", f"{P} {Q}"),
        # hidden counts as the name of an attribute only.
        ("<article><p>see <a href=x title='a hidden gem'>this</a> <b class=\"card hidden lg\">one</b></p></article>", "see this one"),
        ("<article><p>a <i title=hidden>b</i> <i class=\"x\" hidden>c</i><i hidden=\"\">d</i><i id='y'hidden>e</i></p></article>", "a b"),
    ],
)
def test_pages_of_other_makes(page, text):
    assert mt.main_text(page, {}) == text
