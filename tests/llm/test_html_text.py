import html
import re

import pytest

from lendloom.llm.html_text import extract, main_text

PAGE = """<html><head><title>T</title><script>var x="</p><article>no";</script><style>p{}</style></head><body>
<nav><a href=1>Menu</a></nav><header><h1>Site</h1></header><div class="sidebar widget"><p>side text</p></div>
<article class="post"><header><h1>Head &amp; more</h1></header><p>First <b>bo</b>ld&nbsp;text.<p>Second.<div class='ad'>Buy</div>
<ul><li>one<li>two</ul><form><p>mail</p></form><!-- no --><section id="comments"><p>nice</p></section><p>Last</article>
<footer>&copy; x</footer></body></html>"""
PLAIN = "Long text that is surely more than eighty characters in all, so that it makes a surge here."


@pytest.mark.parametrize("page, text", [
    (PAGE, "Head & more First bold text. Second. one two Last"),
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a &lt;b&gt; c", "a <b> c"), ("<div><a href=x>only</a></div>", ""),
    (f"<div id=menu><a>Home</a></div><div><p>{PLAIN}</p><p>Short.</p></div><div class='comments'>c</div>", f"{PLAIN} Short."),
    ("<article><p>one</p></article><p>out</p><article><p>two</p></article>", "one two"),
    ("<script>never closed <p>x</p>", ""), ("<p>" + "w " * 200_000, ("w " * 200_000).strip()), ("<article>" + "<div>" * 3000 + "deep", "deep"),
])
def test_main_text(page, text):
    assert main_text(page) == text


def test_pages_of_the_table(spark):
    """Generated pages: the text of the article element, block by block."""
    rows = extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        text = re.sub(r"<(/?)(\w+)[^>]*>", lambda m: " " if m[2] in ("p", "h1", "br") else "", inner)
        assert r["text"] == " ".join(html.unescape(text).split()) and r["n_chars"] == len(r["text"])
    assert len(rows) == len(pages)


def test_clashing_and_empty(spark):
    df = spark.createDataFrame([(1, "u", "<p>hi", 5), (1, "u", "<p>hi", 5), (None, None, None, None)], "page_id long, url string, html string, n_chars int")
    assert sorted(tuple(r) for r in extract(df).collect() if r["page_id"]) == [(1, "u", "hi", 2)] * 2
    assert extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', "one two three"),
    ("<article><p>one <math/> two <svg><text>no</text></svg> three</p></article>", "one two three"),
    ("<article><p>one</p><svg><p>two</p></article>", "one two"), ("<article><p>one</p><iframe src=x><p>two</p></article>", "one two"),
    ("<article><p>one</p><video a='x>y'>no</video><p>two</p></article>", "one two"),
])
def test_embedded_elements(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<article><h1><a href=x>Head</a></h1><p>one</p><p><a>l1</a></p><p><a>l2</a></p><p><a>l3</a></p><p><a>l4</a></p></article>", "Head one l1 l2 l3 l4"),
    ("<main><ul><li><a>a</a><li><a>b</a></ul><p>one</p></main>", "a b one"),
    (f"<div><h1>Title</h1><p>a.</p><p>b.</p><p>c.</p><p>{PLAIN}</p></div>", f"Title a. b. c. {PLAIN}"),
    (f"<div><h1><a>Title</a></h1><p>a.</p><p>b.</p><p>c.</p><p>{PLAIN}</p></div>", f"Title a. b. c. {PLAIN}"),
    (f"<div><div>far</div><div>x</div></div><div><p>a.</p><p>b.</p><p>{PLAIN}</p></div>", f"a. b. {PLAIN}"),
])
def test_titles_and_linked_lines(page, text):
    assert main_text(page) == text
