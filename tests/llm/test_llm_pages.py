"""Messages against all assignments, layouts not trained on, and the given pages."""

import html
import itertools
import math
import random
import re

import pytest

from tidemark.llm import dom_content
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return dom_content.trained()


def test_marginals_are_exact():
    rng = random.Random(3)
    for _ in range(30):
        nodes = [dom_content.Node(-1, "#page", (), "", 0)]
        for n in range(1, 8):
            nodes.append(dom_content.Node(rng.randrange(n), rng.choice(("#", "div")), (), "", 0))
        odds = [rng.uniform(-2, 2) for _ in nodes]
        pairs = {kind: [[rng.uniform(-2, 2) for _ in "01"] for _ in "01"] for kind in (True, False)}
        belief, _ = dom_content._beliefs(nodes, odds, dom_content.Model({}, pairs))
        total, on = 0.0, [0.0] * len(nodes)
        for states in itertools.product((0, 1), repeat=len(nodes)):
            score = sum(x for x, s in zip(odds, states, strict=True) if s)
            score += sum(pairs[nodes[i].tag == "#"][states[nodes[i].parent]][states[i]] for i in range(1, len(nodes)))
            total += math.exp(score)
            on = [o + math.exp(score) * s for o, s in zip(on, states, strict=True)]
        assert belief == pytest.approx([o / total for o in on])


def test_held_out_layouts(model):
    hit, miss, extra = dom_content.accuracy(model, dom_content.labelled_pages(150, 77))
    assert miss <= 0.02 * hit and extra <= 0.02 * hit


def test_markup(model):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
      <div id="cookie-banner"><p>We use cookies to keep things going, do accept them.</p></div>
      <nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav>
      <article><h1>A &amp; B &lt;3</h1><!-- <p>hidden</p> --><p>First   line,
      <b>bold</b> and <a href="x">a link</a>&nbsp;inside it, long enough.<script>var a = "</p><p>no";</script>
      <p>Second one &#233;&#x20AC; and &copy of it.<br>Still the second one, here.
      <div class="ad">Buy this now, it is cheap and good.</div>
      <p title="a > b">Third one is a sentence of some length as well.</article>
      <section id="comments"><h3>Replies</h3><p>I read all of this and it is a nice article, thanks.</p></section>
      <footer>&copy; somebody</footer></body></html>"""
    assert dom_content.content_blocks(page, model) == [
        "A & B <3",
        "First line, bold and a link inside it, long enough.",
        "Second one é€ and © of it. Still the second one, here.",
        "Third one is a sentence of some length as well.",
    ]


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "<!--", "<script>x", "<a b='", "text <b", "<table><td>x<table><tr>y"])
def test_broken_pages_do_not_fail(model, page):
    assert isinstance(dom_content.content_blocks(page, model), list)


def test_deep_and_long_pages(model):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert isinstance(dom_content.content_blocks(deep, model), list)
    long = "<article>" + "<p>One more sentence of the article.</p>" * 5000 + "</article>"
    assert len(dom_content.content_blocks(long, model)) == 5000


def test_query(spark):
    rows = {r.page_id: r for r in QUERIES["op4_main_text"](spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert rows.keys() == {p.page_id for p in pages}
    for page in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S).group(1)
        parts = re.split(r"<p>|</p>|<h1>|</h1>", inner)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        row = rows[page.page_id]
        assert row.text == "\n\n".join(p for p in parts if p)
        assert (row.n_chars, row.url) == (len(row.text), page.url)
