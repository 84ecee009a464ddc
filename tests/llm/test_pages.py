"""HTML extraction: blocks, the chain, and held-out accuracy on labelled pages."""

import random
import re
from html import unescape

import time

import numpy as np
import pytest

from cases import SF
from riskloom.llm import html_crf
from riskloom.llm.dom import blocks


@pytest.fixture(scope="module")
def chain():
    return html_crf.train()


def test_blocks():
    page = "<div id=a>one <b>two</b><br>three<p>four<p>fi&eacute;ve &amp;lt;<ul><li>six<li><a href=x>sev&nbsp;en</a></ul><script>var a='<p>no</p>'</script><!-- no --> eight < 9"
    got = blocks(page)
    assert [b.text for b in got] == ["one two three", "four", "fiéve &lt;", "six", "sev en", "eight < 9"]
    assert got[4].linked == 6 and got[0].path[0] == ("div", "a")
    assert blocks(None) == [] and blocks("") == [] and blocks("<script>x") == [] and blocks("<!-- x") == []
    assert [b.text for b in blocks("<p a='<'>x</p></p></div><td>y<td>z")] == ["x", "y", "z"]
    assert len(blocks("<div>" * 5000 + "deep")) == 1 and [b.text for b in blocks("a" * 300_000)] == ["a" * 300_000]


def test_chain_decodes_like_all_sequences(chain):
    r = random.Random(5)
    for _ in range(30):
        page, _ = html_crf.labelled_page(r)
        page = page[:9]
        e = [chain.of_path(b.path) + sum(chain.weights.get(f, 0.0) for f in html_crf.text_features(b)) for b in page]

        def score(y, e=e):
            return chain.ends[0][y[0]] + chain.ends[1][y[-1]] + sum(chain.moves[a][b] for a, b in zip(y, y[1:], strict=False)) + sum(x for x, v in zip(e, y, strict=True) if v)

        best = max(score([k >> i & 1 for i in range(len(page))]) for k in range(1 << len(page)))
        assert score(chain.decode(page)) == pytest.approx(best)


def test_held_out_pages(chain):
    r = random.Random(1234)
    pages = [html_crf.labelled_page(r) for _ in range(200)]
    right = sum(a == b for p, y in pages for a, b in zip(chain.decode(p), y, strict=True))
    assert right / sum(len(y) for _, y in pages) > 0.985


def test_more_steps_fit_the_training_pages_no_worse():
    r = random.Random(2)
    pages = [html_crf.labelled_page(r) for _ in range(40)]
    wrong = [sum(a != b for p, y in pages for a, b in zip(html_crf.fit(pages, steps=n).decode(p), y, strict=True)) for n in (3, 300)]
    assert wrong[1] <= wrong[0] and wrong[1] <= 5
    assert np.isfinite(list(html_crf.fit(pages, steps=300).weights.values())).all()


def test_written_layouts(chain):
    page = """<html><head><title>T</title></head><body><header class="masthead"><a href="/">Site name</a></header><nav><ul><li><a href=/a>Home</a></li></ul></nav>
    <div class="cookie-consent"><p>We use cookies to make this site better for you.</p></div>
    <main><article><h1>Rain over the valley</h1><p>It rained for nine days, and the river rose above the lower fields.</p><p>People carried their things uphill.</p>
    <aside class="related"><a href=/b>More rain news</a></aside><ul><li>First, the mill closed.</li></ul></article></main>
    <section id="comments"><h3>Comments</h3><p>What a sad story, I hope that everyone is well.</p></section>
    <form action="/s"><label>Search</label><button>Go</button></form><footer><p>&copy; 2020 The Paper. All rights reserved.</p></footer></body></html>"""
    assert chain.text(page) == "Rain over the valley\nIt rained for nine days, and the river rose above the lower fields.\nPeople carried their things uphill.\nFirst, the mill closed."


def test_pages_table(spark, chain):
    from riskloom.session import ship

    ship(spark)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_crf.extract(pages, chain).join(pages, "page_id").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1].replace("<b>", "").replace("<br>", " ")
        want = [" ".join(unescape(x).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert r.text == "\n".join(x for x in want if x) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x"), (2, None, "<p>", "x")], "page_id long, url string, html string, text string")
    got = html_crf.extract(odd, chain)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and [r.text for r in got.collect()] == [""] * 4
    assert html_crf.extract(odd.limit(0), chain).count() == 0


def texts(html):
    return [b.text for b in blocks(html)]


def test_attributes_without_quotes():
    assert texts("<p><a href=/o'neil>Text one</a> more</p><p>it's two</p><p>three</p>") == ["Text one more", "it's two", "three"]
    assert texts("""<p title=say"hi class='x > y'>one</p><p data=a=b>two</p><p x = "a>b" y='c>d' z>three</p><p "odd' >four</p>""") == ["one", "two", "three", "four"]
    assert blocks("<div class=o'ad><p>x</p></div>")[0].path[0] == ("div", "o'ad")


def test_elements_beyond_the_deepest():
    deep = "<div class='ad'>" + "<div>" * 300 + "<p>in</p>" + "</div>" * 300 + "<p>after</p></div><p>out</p>"
    got = blocks(deep)
    assert [b.text for b in got] == ["in", "after", "out"]
    assert ("div", "ad") in got[1].path and got[2].path == (("p", ""),)


def test_unclosed_elements_take_linear_time():
    assert texts("<svg><p>a</p>" * 3 + "</svg><p>b</p>")[-1] == "b"
    start = time.perf_counter()
    for name in ("svg", "object", "template"):
        blocks(f"<{name}><p>x</p>" * 40_000)
    assert time.perf_counter() - start < 20
