"""Main-text extraction: exact inference, held-out layouts, broken pages."""

import itertools

import numpy as np
import pytest

from tomeflow.llm import html, html_pages
from tomeflow.llm.html import Forest, Page, extract_pages, trained


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(2)
    page = Page("<body><div><p>a<p>b</div><ul><li>c</ul></body>")
    n = len(page.tags)
    own, edges = rng.normal(size=n), rng.normal(size=(2, 2, 2))
    forest = Forest([page, page])
    p, joint, z = forest.marginals(np.tile(own, 2), edges)
    weight = np.zeros(n)
    total = 0.0
    for labels in itertools.product((0, 1), repeat=n):
        s = sum(own[i] for i in range(n) if labels[i]) + sum(edges[forest.kind[i], labels[page.parents[i]], labels[i]] for i in range(1, n))
        total += np.exp(s)
        weight += np.exp(s) * np.array(labels)
    assert np.allclose(p[:n], weight / total) and np.allclose(p[n:], weight / total)
    assert np.allclose(z, np.log(total))
    assert np.allclose(joint[1:n].sum(axis=(1, 2)), 1)


def test_held_out_layouts():
    sources = html_pages.labelled_pages(300, seed=77)
    got = trained().extract(sources)
    want = [(lambda p: p.text(html._marks(s, p)))(Page(s)) for s in sources]
    assert sum(g == w for g, w in zip(got, want)) / len(sources) > 0.93


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><div><a href="/">Home</a></div></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- ad 3 -->
<div class="cookie-notice">We use cookies here.</div><div class="ad">Buy things now.</div>
<article><h1>Title &amp; more</h1><p><b>Title<br><p>First   para&shy;graph with <i>some</i> &eacute;t&#233; words.</p>
<div class="advert">An advert inside.</div><p>Short.</p><p>Second one, a &lt; b.</p></article>
<section class="comments"><h2>Comments</h2><p>I think this is wrong, said a reader at length.</p></section>
<aside class="sidebar"><p>Related things to read.</p></aside><form><input><button>Send</button></form>
<footer>&copy; site &middot; Words here.</footer></body></html>"""


def test_a_page_with_everything():
    (got,) = trained().extract([PAGE])
    assert got == "Title & more Title First para\xadgraph with some été words. Short. Second one, a < b."


@pytest.mark.parametrize("cut", [40, 200, 400, 700, 900, 1100])
def test_cut_off_pages_are_read_as_far_as_they_go(cut):
    (got,) = trained().extract([PAGE[:cut]])
    assert "Buy" not in got and "cookies" not in got


def test_operator_and_edge_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "", "", "x"), (3, "u", "<article><p>" + "word " * 60000, "x"), (4, "u", "<<a <p <!-- <script>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_pages(pages).collect()
    assert [(r.page_id, r.url) for r in got] == [(r[0], r[1]) for r in rows]
    assert got[0].text == got[1].text and got[2].text == got[3].text == ""
    assert got[4].n_chars == 5 * 60000 - 1
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract_pages(pages.limit(0)).count() == 0


def test_formulas_are_text_and_open_elements_do_not_swallow_the_page():
    body = "<p>" + "Plain words of a long enough article paragraph stand here. " * 4 + "{}</p>"
    page = "<html><body><article><h1>Title of it</h1>" + body * 3 + "</article></body></html>"
    math = "Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>E=mc^2</annotation></math> as shown."
    (got,) = trained().extract([page.format(math, "<svg/> after", "<canvas> to the end")])
    assert "Energy is E=mc2 as shown." in got and got.count("Plain words") == 12 and "after" in got and got.endswith("to the end")


def test_the_query_has_the_columns_of_its_contract(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", 3), (2, None, None, 3)], "page_id long, url string, html string, n_chars int")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = html.op7_html_text(spark, str(tmp_path))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.n_chars for r in got.collect()}[2] == 0
