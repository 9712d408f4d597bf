from __future__ import annotations

import html as entities
import itertools
import re

import pytest
from conftest import SMALL
from llm_helpers import clashing

from floorline.llm.html_main import Flow, extract_main_text, main_text
from floorline.llm.queries import registered


def plain(page):
    """The main text of the generated pages, whose article holds only h1, p, b and br."""
    body = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:h1|p|br)>", re.sub(r"<[^>]*\Z", "", body[1])) if body else []
    parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return " ".join(p for p in parts if p)


def test_generated_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = {r["page_id"]: r for r in registered()["op2_html_main_text"](spark, SMALL).collect()}
    assert found.keys() == pages.keys()
    for i, page in pages.items():
        assert found[i]["text"] == plain(page) and found[i]["n_chars"] == len(plain(page))


PAGE = """<!doctype html><html><head><title>Not this</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href="/">Home</a></header><div id="cookie-notice"><p>We use cookies, please agree to them all.</p></div>
<nav><ul><li><a href="1">One</a></li><li><a href="2">Two</a></li></ul></nav>
<main><article><header><h1>Real &amp; true</h1></header><p>First   paragraph
with <b>bold</b> and a <a href="x">link</a>.</p><p>Short.</p><script>var x = "</p>";</script>
<div class="ad-banner"><p>Buy this great product now, it is really good.</p></div><ul><li>Item one</li><li>Item two</li></ul>
<aside><p>Related stories, which are long enough to look like text.</p></aside>
<form><p>Subscribe to our newsletter for more of this.</p><input><button>Go</button></form><!-- hidden > text -->
<p>Last &lt;paragraph&gt;<br>after a break.</article>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I agree with the whole article, it says what I think.</p></article></section></main>
<aside class="sidebar"><p>Sidebar text with a long sentence that goes on and on and on.</p></aside>
<footer><p>&copy; 2020 Site. All rights are reserved to the company.</p></footer></body></html>"""
TEXT = "Real & true First paragraph with bold and a link. Short. Item one Item two Last <paragraph> after a break."


def test_article_among_everything_else():
    assert main_text(PAGE) == TEXT


def test_page_without_landmarks():
    page = ('<div class="menu"><a href=1>One</a> | <a href=2>Two</a></div><div id="content"><h1>Title</h1><div>The first block of text is '
            'long enough, with commas, and it stops.</div><div>Another block of text goes on with the story until its end.</div><p>Ok.</p>'
            '</div><div class="footer">Copyright someone</div>')
    assert main_text(page) == ("Title The first block of text is long enough, with commas, and it stops. "
                               "Another block of text goes on with the story until its end. Ok.")


LONG = "A paragraph of the article, which is long enough to be taken for text. "


@pytest.mark.parametrize("page,text", [
    # A site's name in its header, a title in a part of the article named header, comments that outweigh the article.
    ("<header><h1>The name of this whole site, quite long</h1></header><article><div class=post-header><h1>Title</h1></div>"
     f"<p>{LONG}</article><div id=disqus_thread>" + f"<p>{LONG}</p>" * 5 + "</div>", f"Title {LONG.strip()}"),
    # A wrapper named after its sidebar.
    (f"<div class='page with-sidebar'><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><div class=sidebar><p>Links and more of them.</p></div></div>",
     f"Title {LONG}{LONG.strip()}"),
    (f"<main><div role=alert>Our site will be down tonight for some hours.</div><p>{LONG}</p><section class='post-comments'><p>{LONG}</p></section></main>",
     LONG.strip()),
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a < b &amp; c", "a < b & c"), ("<article><p>cut in a tag <a href='x", "cut in a tag"),
    ("<article><p>cut in a reference &am", "cut in a reference &am"), ("<article><p>x</p><script>never ended <p>y</p>", "x"),
    ("<nav><a href=1>One</a></nav>", ""), ("<article><p title=it's>quote's</p>", "quote's"), ("</p></div><article><p>a</b></i>b</p>", "ab"),
    ("<article>é<p>中文<p>&#x41;&#66;", "é 中文 AB"),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_nulls_repeats_long_pages_and_clashing_columns(spark):
    long = "<article>" + "<p>A sentence of some length, and its end.</p>" * 3000 + "</article><footer>foot</footer>"
    data = [(1, "u", None), (1, None, ""), (2, "u", PAGE), (2, "u", PAGE), (None, "u", long)]
    frame = clashing(spark.createDataFrame(data, "page_id long, url string, html string"))
    found = extract_main_text(frame)
    assert found.columns == [*frame.columns, "text"]
    assert sorted((r["text"] for r in found.collect()), key=len) == ["", "", TEXT, TEXT, " ".join(["A sentence of some length, and its end."] * 3000)]
    assert extract_main_text(frame.limit(0)).count() == 0


def test_cut_is_minimal():
    """Against all cuts of small graphs."""
    import random

    rng = random.Random(6)
    for _ in range(60):
        n = 6
        edges = [(rng.randrange(n), rng.randrange(n), rng.randrange(1, 9), rng.randrange(0, 9)) for _ in range(11)]
        edges = [e for e in edges if e[0] != e[1]]
        flow = Flow(n)
        for a, b, there, back in edges:
            flow.join(a, b, there, back)
        reached = flow.cut(0, n - 1)
        cost = lambda side: sum((t if side[a] and not side[b] else 0) + (k if side[b] and not side[a] else 0) for a, b, t, k in edges)
        assert cost(reached) == min(cost([True, *middle, False]) for middle in itertools.product((True, False), repeat=n - 2))
