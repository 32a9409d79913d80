import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import boosting
from docloom.llm.html_text import Page, decode, extract, features, fit, made, made_page, main_text, told_by_tags


@pytest.fixture(scope="module")
def trees():
    return fit([])


def test_decoder_finds_the_best_consistent_set():
    r = np.random.default_rng(0)
    for _ in range(100):
        n = r.integers(2, 9)
        parent = [-1] + [int(r.integers(0, v)) for v in range(1, n)]
        odds = r.normal(size=n) * 2
        value = lambda k: sum((-np.log1p(np.exp(-o)) if x else -np.log1p(np.exp(o))) for o, x in zip(odds[1:], k[1:]))  # noqa: B023, E731
        options = [(1, *k) for k in itertools.product((0, 1), repeat=n - 1)]
        options = [k for k in options if all(not k[v] or k[parent[v]] for v in range(1, n))]
        got = decode(parent, odds)
        assert all(not got[v] or got[parent[v]] for v in range(1, n))
        assert np.isclose(value(got), max(map(value, options)))


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.3)).astype(float)
    t = boosting.fit(x[:2000], y[:2000])
    assert ((t.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95


def test_held_out_nodes(trees):
    r = random.Random(99)
    pages = [Page(made_page(r)) for _ in range(60)]
    x, y = np.concatenate([features(p) for p in pages]), np.concatenate([made(p) for p in pages])
    known = y >= 0
    assert ((trees.log_odds(x[known]) > 0) == y[known]).mean() > 0.97


PAGE = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav><!-- <p>old</p> -->
<div class="cookie-banner">We use cookies. <button>OK</button></div><div class="ad">Buy this now.</div>
<article><h1>The   title &lt;1&gt;</h1><p><b>First one,<br>still&nbsp;first.<p>Second
 &eacute;t&#233;, with <a href="x">a link</a> and text.</p><ul><li>Point one of the list, in words.<li>Point two of the list, in words.</ul><script>no()</script></article>
<section id="comments"><p>Reader says this, and that.</p></section><aside><p>Related things.</p></aside>
<form action="/s"><input name="q"><label>Search here</label></form><footer>&copy; someone</footer>"""
TEXT = "The title <1>\n\nFirst one, still first.\n\nSecond été, with a link and text.\n\nPoint one of the list, in words.\n\nPoint two of the list, in words."


def test_whole_page(trees):
    assert extract([PAGE], trees) == [TEXT]


@pytest.mark.parametrize("page", [PAGE.replace("</head>", ""), PAGE.replace("</head><body>", ""), PAGE.replace("</head>", "<template><div>Not shown.</div></template>")])
def test_head_without_its_end_tag(trees, page):
    assert extract([page], trees) == [TEXT]


def test_text_and_inline_tags_end_a_head():
    for html in ("<head><title>t</title>Some words", "<head><meta x><b>Some words</b>", "<html><head>\n<link x>\n<img>Some words"):
        assert [t for _, t in Page(html).blocks] == ["Some words"]


def test_share_of_same_siblings_at_every_size():
    for n in (50, 199, 200, 700):
        page = Page("<body>" + "<p>Words.</p>" * n + "<div>Advert</div></body>")
        same = features(page)[:, 9]
        assert np.isclose(same[page.tag.index("p")], n / (n + 1)) and np.isclose(same[page.tag.index("div")], 1 / (n + 1))


@pytest.mark.parametrize("html", ["", "<", "<p", "a < b & c", "<p>" * 3000, "<div>" * 3000 + "x", "</p></div>", "<script>", '<p class="', "<a><b></a></b>", "<!-- x", "<li><li><td>", "&#0;&bogus;"])
def test_anything_parses(trees, html):
    assert isinstance(extract([html], trees)[0], str)


def test_query_rows(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, None, None, 5), (None, "v", "", 5), (3, "w", PAGE.replace("Second", "Second " + "word, " * 50_000), 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(2)
    got = sorted(((r.page_id, r.url, r.n_chars) for r in main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", len(TEXT)), (1, "u", len(TEXT)), (2, None, 0), (None, "v", 0), (3, "w", len(TEXT) + 300_000)], key=str)
    assert main_text(df.where(F.lit(False))).count() == 0


BOXES = """<html><body><div><a href="/a">Home</a> <a href="/b">News</a> <a href="/c">Sport</a></div>%s<div class="cookie-banner">We use cookies.</div><footer>c 2024</footer></body></html>"""
INNER = """<h1>Title of it</h1><p class="more">First words of the article that go on for a while.</p><p class="author">By Somebody</p>
<div class="trending"><p>Trending upwards were the prices of all things, they said.</p></div><p id="header">Short.</p><ul class="tags"><li>one thing</li><li>another</li></ul>
<div class="side single"><p>There are two sides to this.</p><p class="print">And a third one.</p></div>%s<p>Last.</p>"""
KEPT = "Title of it\n\nFirst words of the article that go on for a while.\n\nBy Somebody\n\nTrending upwards were the prices of all things, they said.\n\nShort.\n\none thing\n\nanother\n\nThere are two sides to this.\n\nAnd a third one.\n\nLast."


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>'])
def test_misleading_names_in_an_article(trees, wrap):
    """Pages labelled by hand: names that often stand on boilerplate stand on parts of the article; a menu has neither tag nor name."""
    assert extract([BOXES % (wrap % (INNER % ""))], trees) == [KEPT]
    boxes = '<div class="ad">Buy now</div><section id="comments"><div><p>Jo</p><p>nice article, thanks a lot for it</p></div></section><aside><p>Other things.</p></aside><form><p>Write to us</p></form><div class="newsletter">Subscribe to it.</div>'
    assert extract([BOXES % (wrap % (INNER % boxes))], trees) == [KEPT]


def test_labels_of_the_table_look_at_tags_alone():
    html = PAGE.replace("<article>", '<article><div class="x"><p>Unknown.</p></div>')
    a, b = (told_by_tags(Page(h)) for h in (html, html.replace('class="ad"', 'class="more"').replace('id="comments"', "")))
    page = Page(html)
    assert (a == b).all() and a[page.tag.index("article")] == 1 and a[page.tag.index("nav")] == 0 and a[page.tokens.index("ad")] == 0 and a[page.tokens.index("x")] == -1


def test_extraction_against_brute_force(trees):
    """Each block comes out if and only if the best of all parent-closed sets of nodes holds its node."""
    r = random.Random(3)
    done = 0
    while done < 25:
        page = Page(html := made_page(r))
        n = len(page.tag)
        if n > 16:
            continue
        done += 1
        odds = trees.log_odds(features(page))
        sets = [(1, *k) for k in itertools.product((0, 1), repeat=n - 1)]
        sets = [k for k in sets if all(not k[v] or k[page.parent[v]] for v in range(1, n))]
        best = max(sets, key=lambda k: sum(-np.logaddexp(0, -o) if x else -np.logaddexp(0, o) for o, x in zip(odds[1:], k[1:])))
        assert extract([html], trees) == ["\n\n".join(t for v, t in page.blocks if best[v])]
