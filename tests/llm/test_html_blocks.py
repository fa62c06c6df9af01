"""Blocks of awkward markup, the labeller's gradient, and main texts of pages."""

import html
import re
import time
import tracemalloc

import numpy as np
import pytest
from llm_cases import awkward

from bazaarlens.llm import html_blocks
from bazaarlens.llm.frames import table

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in html_blocks.blocks_of(page)]


def test_blocks():
    assert texts(None) == texts("") == texts("<div></div><p> \n </p>") == []
    assert texts("<p>a<p>b &amp;amp; c<br>d</p>e") == ["a", "b &amp; c d", "e"]
    assert texts("x <b>bold</b>\n\n <i>it</i>alic") == ["x bold italic"]
    assert texts("<script>var t='</p>';</script><style>p{}</style>a<!-- <p>no</p> -->b") == ["ab"]
    assert texts("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>") == ["one", "two", "in", "three"]
    assert texts('<p title="a > b">q</p><p>1 < 2 &lt; 3') == ["q", "1 < 2 < 3"]
    assert texts("<div><p>open<div>inner</p></div>tail") == ["open", "inner", "tail"]
    assert texts("<title>t</title><p>&#233;&eacute;&nbsp;x</p></section>") == ["éé x"]
    assert texts("<script>unclosed <p>a") == []
    assert texts("<P CLASS=A>up</P>") == ["up"]


def test_unclosed_head_title_and_body():
    assert texts("<head><title>t</title><body><article><p>x</article>") == ["x"]
    assert texts("<head><title>t</title><meta name=a><link href=b><p>x<p>y") == ["x", "y"]
    assert texts("<head><title>t<body><p>x") == texts("<head><title>t</head><p>x") == texts("<title>t<p>x") == ["x"]
    assert texts("<head><title>t</title>Hello <b>you</b>") == ["Hello you"]
    assert texts("<head><script>s</script><svg><title>t</title></svg><p>x") == ["x"]
    assert texts("<html><head><style>s</style></head><body><p>x") == ["x"]
    assert texts("<title>How <p> works</title><p>x") == ["x"]
    assert texts("<canvas><p>x</p><object data=a>y") == ["x", "y"]
    assert texts("<canvas><p>x</p></canvas><object>y</object>z") == ["z"]


def test_quotes_that_open_no_value():
    page = "<p title=it's>First para</p><p>Second, don't stop</p><p>Third</p>"
    assert texts(page) == ["First para", "Second, don't stop", "Third"]
    assert texts('<article>a <img alt="13"" src=x> b</article>') == ["a b"]
    assert texts('<a href=x?a="b>c</a> <p title="d>e</p>') == ["c", "e"]
    assert texts("<p title = 'a > b' id=\"c>d\">q") == ["q"]


def test_elements_that_close_themselves_or_never():
    assert texts('<article><p>a</p><svg class="i" /><p>b</p></article>') == ["a", "b"]
    assert texts("<p>a<svg/>b<svg><path d=x /><text>no</text></svg>c") == ["abc"]
    assert texts("<svg><g><p>a</p><svg>no</svg><p>b") == ["a", "b"]
    assert texts("<svg><foreignObject><p>no</p></foreignObject></svg><p>b") == ["b"]
    assert texts("<svg><path><p>a</p>") == ["a"]
    assert texts("<noscript><p>a</p><div>b") == ["a", "b"]
    assert texts("a<noscript><div>no</div></noscript>b<NOSCRIPT>no</NOSCRIPT >c") == ["abc"]
    assert texts("<p>a</p><svg class=i />" * 3) == ["a"] * 3


def test_deep_pages_take_no_longer_than_flat_ones():
    tracemalloc.start()
    began = time.process_time()
    blocks = html_blocks.blocks_of("<div>x" * 30_000)
    assert time.process_time() - began < 5 and tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    assert len(blocks) == 30_000 and len(blocks[-1].path) == 30_000 and blocks[0].path == ("div",)
    assert len(html_blocks.blocks_of("<span>x</b><center>" * 20_000)) == 20_000
    x, _, _ = html_blocks.Labeller().grid([blocks[:200]])
    flat = [html_blocks.Block(html_blocks.spot_of(b.path), b.text, b.linked, b.size) for b in blocks[:200]]
    assert np.allclose(x, html_blocks.Labeller().grid([flat])[0], atol=1e-3)


def test_cut_training_blocks_keep_their_share_of_links():
    whole = html_blocks.blocks_of("<p>" + "word " * 400 + "<a>" + "link " * 100 + "</a>")[0]
    cut = html_blocks.Block(whole.spot, whole.text[:400], whole.linked, whole.size)
    assert html_blocks.measures(cut)[:2] == html_blocks.measures(whole)[:2]
    assert 0.1 < html_blocks.measures(cut)[1] < 0.3


def test_paths_and_links():
    block, other = html_blocks.blocks_of('<div class="Menu top" id=m><a href="/x">link</a> y</div><article><p>z')
    assert block.path == ("div", ".menu", ".top", ".m") and block.linked == 4
    assert other.path == ("article", "p") and html_blocks.teacher(other.path) and not html_blocks.teacher(block.path)
    assert not html_blocks.teacher(("article", "div", ".comments", "p"))


def test_gradient_of_the_network():
    draw = np.random.default_rng(1)
    pages = [html_blocks.blocks_of(p) for p in ("<nav><a>x</a></nav><article><p>one two<p>three</article>", "<p>a</p>")]
    truth = [[False, True, True], [False]]
    net = html_blocks.Labeller()
    for name, w in net.weights.items():
        net.weights[name] = w.astype(np.float64)

    def loss():
        x, real, (_, step, page) = net.grid(pages)
        p = net.probabilities(x.astype(np.float64), real)[0][step, page]
        y = np.array([v for ys in truth for v in ys])
        return -np.mean(np.where(y, np.log(p), np.log(1 - p)))

    slopes = net.slopes(pages, truth)
    for name, slope in slopes.items():
        flat, by = net.weights[name].reshape(-1), slope.reshape(-1)
        for at in [int(np.abs(by).argmax()), *draw.integers(0, len(flat), 3)]:
            held = flat[at]
            flat[at] = held + 1e-3
            up = loss()
            flat[at] = held - 1e-3
            down = loss()
            flat[at] = held
            assert abs((up - down) / 2e-3 - by[at]) < 2e-3 * max(1, abs(by[at])), name


@pytest.fixture(scope="module")
def labeller(spark):
    return html_blocks.fit(table(spark, SF, "pages"))


def test_given_pages(spark, labeller):
    def main_text(page):
        inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>|<br>", inside)
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts]
        return "\n".join(p for p in parts if p)

    pages = table(spark, SF, "pages")
    want = {r.page_id: main_text(r.html) for r in pages.collect()}
    found = html_blocks.extracted(pages, labeller).collect()
    assert len(found) == len(want) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in found)


PAGE = """<html><body><header><p>Site name</p></header><nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav>
<aside class="sidebar"><p>Popular this week in our shop</p></aside>
<{tag}><h1>A headline</h1><p>The first paragraph, with some words.</p>
<div class="ad">Buy things now</div><p>The second paragraph is <i>longer</i> and ends.</p></{end}>
<div class="comments"><p>Nice text, I liked it.</p></div><form><label>Your name</label></form>
<div class="cookie-notice"><p>We use cookies.</p></div><footer>All rights &copy; us</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", 'div class="content"', 'div class="post"', 'div id="content"'])
def test_other_parts_of_a_page_are_left_out(labeller, tag):
    page = PAGE.format(tag=tag, end=tag.split()[0])
    want = "A headline\nThe first paragraph, with some words.\nThe second paragraph is longer and ends."
    assert list(html_blocks.main_texts(labeller, [page])) == [want]


def test_a_page_is_labelled_alike_alone_and_among_others(labeller, monkeypatch):
    pages = [PAGE.format(tag="article", end="article"), "<p>x</p>", None, PAGE * 3, "<article>" + "<p>word</p>" * 3000]
    together = list(html_blocks.main_texts(labeller, pages))
    assert together == [next(iter(html_blocks.main_texts(labeller, [p]))) for p in pages]
    assert together[4].count("word") == 3000


def test_awkward_frames(spark, labeller):
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<article><p>a"), (2, "u", "<article><p>a")]
    pages = awkward(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = sorted((r.page_id or 0, r.n_chars) for r in html_blocks.extracted(pages, labeller).collect())
    assert [f[0] for f in found] == [0, 1, 2, 2] and found[0][1] == found[1][1] == 0
    assert html_blocks.extract(pages.limit(0)).count() == 0
    assert html_blocks.extract(pages).count() == 4
