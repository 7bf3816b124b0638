"""Operator 5: HTML extraction by minimum cut."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from livemetrics.llm.html_extract import extract_pages, main_text, min_cut, page_blocks
from tests.llm.helpers import prose

LONG = "This paragraph has enough words to look like the running text of an article, and it ends."


def cost(label, score, edges):
    cut = sum(c for (i, j), c in edges.items() if label[i] != label[j])
    return cut + sum(max(s, 0) if not keep else max(-s, 0) for s, keep in zip(score, label))


def test_cut_is_minimal_against_all_labellings():
    rnd = random.Random(5)
    for _ in range(150):
        n = rnd.randint(1, 9)
        score = [rnd.choice([-3.0, -1.2, -0.4, 0.0, 0.3, 1.1, 2.5]) for _ in range(n)]
        edges = {(i, j): rnd.choice([0.2, 0.9, 2.0]) for i, j in itertools.combinations(range(n), 2) if rnd.random() < 0.5}
        best = min(cost(x, score, edges) for x in itertools.product([False, True], repeat=n))
        assert cost(min_cut(score, edges), score, edges) == pytest.approx(best)


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{ x: "</p>" }}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div id="cookie-notice">We use cookies to make this site better for all of you, please accept them now.</div>
<div class="layout"><div class="sidebar"><h3>Related</h3><ul><li><a href="x">Link</a></li></ul></div>
<main><article><header><h1>Real &amp; true   title</h1></header><p>{LONG}</p>
<div class="ad"><p>Buy our things now, they are good and cheap and this advert is long enough to read.</p></div>
<p>Caf&eacute;&nbsp;&#8212; short.</p><ul><li>a &lt; b</li><li>c</li></ul><pre>x
  y</pre>
<form action="x"><label>Email address</label><input name="e"><button>Send</button></form>
<section class="comments"><h2>Comments</h2><p>I liked this very much and write a long comment about all of it.</p></section>
</article></main></div><footer>&copy; Site, all rights reserved</footer><script>var t = "<p>no</p>";</script></body></html>"""
    assert main_text(page).split("\n") == ["Real & true title", LONG, "Café — short.", "a < b", "c", "x y"]


def test_blocks_of_broken_markup():
    assert [b.text for b in page_blocks("<p><b>One.<br><p>Two <i>it</i>s</p>three<div>four</p>five</div")] == \
        ["One.", "Two its", "three", "four", "five"]
    assert [b.text for b in page_blocks("a < b<!-- x --> c<script>var x = '<p>'")] == ["a < b c"]
    assert [b.text for b in page_blocks('<a title="x > y">link</a> &am &amp <p hidden>gone</p>')] == ["link &am &"]
    assert main_text(f"<article><p>{LONG}</p><p>cut off <a href='x") == f"{LONG}\ncut off"


def test_self_closed_svg_and_text_of_math_object_noscript():
    assert [b.text for b in page_blocks('<p>One <svg class="i"/> two.</p><p>Three <math/>four.</p>')] == ["One two.", "Three four."]
    assert [b.text for b in page_blocks("<p>a <svg><text>drawn</text></svg> b <svg/>c</p>")] == ["a b c"]
    page = f"<article><p>{LONG} <math><mi>x</mi></math> <object>in object</object> <noscript>no script</noscript></p><p>{LONG}</p></article>"
    assert main_text(page).split("\n") == [f"{LONG} x in object no script", LONG]


def test_smoothing_keeps_a_short_line_and_drops_a_link_row():
    page = (f'<body><div><a href="1">Home</a> <a href="2">News</a></div><div><h1>A title of it</h1><p>{LONG}</p><p>Ok</p>'
            f'<p>{LONG}</p></div><div><a href="1">About us</a> | <a href="2">Contact</a></div></body>')
    assert main_text(page).split("\n") == ["A title of it", LONG, "Ok", LONG]


def test_pages_table(spark):
    page = f"<article><h1>Head</h1><p>{LONG}</p></article><footer>foot</footer>"
    big = "<article>" + "".join(f"<p>{prose(i, 30)}.</p>" for i in range(2000)) + "</article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "<nav><a>only a menu</a></nav>"), (4, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1))
    out = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract_pages(df).collect()), key=repr)
    want = [(i, u, main_text(h)) for i, u, h in rows]
    assert out == sorted(((i, u, t, len(t)) for i, u, t in want), key=repr)
    assert dict((i, t) for i, _, t in want)[1] == f"Head\n{LONG}" and dict((i, t) for i, _, t in want)[None] == ""
    assert len(dict((i, t) for i, _, t in want)[4].split("\n")) == 2000
    assert extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("around", ['<div class="message-body">%s</div>', '<body><form id="aspnetForm">%s</form></body>',
                                    '<div class="search-layout"><div id="content">%s</div></div>'])
@pytest.mark.parametrize("title", ["", "<h1>A title</h1>"])
def test_names_and_forms_around_the_whole_article_are_neutral(around, title):
    text = "This is a long sentence of the article with many words in it indeed. " * 3
    assert main_text(around % f"{title}<p>{text}</p>") == "\n".join(["A title"] * bool(title) + [text.strip()])


def test_comments_and_small_forms_still_go():
    text = "This is a long sentence of the article with many words in it indeed. " * 9
    other = "<p>Somebody wrote a longer remark here that is no part of the article above at all.</p>"
    for rest in ('<div class="comment-body">%s</div>', '<div class="comments"><div class="message">%s</div></div>',
                 '<form class="newsletter">%s</form>', '<div class="search-form">%s</div>'):
        assert main_text(f"<h1>A title</h1><p>{text}</p>" + rest % other) == "A title\n" + text.strip()


def test_many_open_elements_take_linear_time():
    assert len(page_blocks("<div class=x>word " * 60_000)) == 60_000
    assert len(page_blocks("<b class=x>word </i><li>" * 60_000)) == 60_000
