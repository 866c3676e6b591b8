"""Extraction against a plain reading of the article, and message passing against enumeration."""

import html
import itertools
import math
import random
import re

from pyspark.sql import functions as F

from urbanlake.llm import html_text as ht
from urbanlake.llm.common import QUERIES


def test_marginals_by_enumeration():
    random.seed(1)
    parent = [-1, 0, 0, 1, 1, 2, 5]
    score = [random.uniform(-2, 2) for _ in parent]
    edges = [[0.7, -0.4], [-1.1, 0.9]]
    total, one, pairs = 0.0, [0.0] * 7, [[0.0, 0.0], [0.0, 0.0]]
    for y in itertools.product((0, 1), repeat=7):
        w = math.exp(sum(s for s, v in zip(score, y) if v) + sum(edges[y[parent[i]]][y[i]] for i in range(1, 7)))
        total += w
        for i, v in enumerate(y):
            one[i] += w * v
        for i in range(1, 7):
            pairs[y[parent[i]]][y[i]] += w
    belief, _ = ht.marginals(parent, score, edges)
    for b, o in zip(belief, one):
        assert abs(1 / (1 + math.exp(-b)) - o / total) < 1e-9
    got = ht.pair_marginals(parent, score, edges)
    assert all(abs(got[a][b] - pairs[a][b] / total) < 1e-9 for a in (0, 1) for b in (0, 1))


def plain(source):
    body = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op9_html_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(pages[r.page_id]) and r.n_chars == len(r.text), r.page_id


OTHER = """<!doctype html><body><header><h1>Site</h1></header><div id="menu"><a href=/>Home</a></div>
<div class="cookie-notice">We use cookies, as all do.</div>
<div class="content"><h2>A &lt;title&gt; &amp; more</h2><p>First  paragraph with <b>bold</b>text, and
more of it, so that it is long enough to look like one.<p>Second, with <a href="x">a link</a> inside. It ends here.
<ul><li>One thing, said in a list.<li>Another thing, said in the same list.</ul>
<form><label>Mail</label><input name=m></form></div>
<div class="comments"><p>I think, therefore I comment on what I read here, at some length.</p></div>
<aside>Read also: this.</aside><footer>&copy; 2020</footer><script>document.write("<p>no</p>")</script>"""


def test_page_without_semantic_markup(spark):
    model = ht.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    assert ht.main_text(OTHER, model).split("\n") == [
        "A <title> & more", "First paragraph with boldtext, and more of it, so that it is long enough to look like one.",
        "Second, with a link inside. It ends here.", "One thing, said in a list.", "Another thing, said in the same list.",
    ]


ARTICLES = [
    ("<article><p class=legal>The law says so, in a long sentence.</p><p class='side'>On the other side, it does not.</p><p>Plain paragraph, as long as the others.</p></article>",
     "The law says so, in a long sentence.\nOn the other side, it does not.\nPlain paragraph, as long as the others."),
    ("<article class='post social'><p>A post about the social life of cats, at length.</p></article>", "A post about the social life of cats, at length."),
    ("<article><p title=don't>Text after an attribute, which has a quote.</p><p>More of the same text.</p></article>", "Text after an attribute, which has a quote.\nMore of the same text."),
    ("<article><p>Of <math><mi>x</mi><mo>=</mo><mn>1</mn></math> it is said, that <object data=a>it holds</object>.</p><xmp><b>kept</b> &amp; as it is.</xmp></article>",
     "Of x=1 it is said, that it holds.\n<b>kept</b> &amp; as it is."),
    ("<main><h1>Title</h1><p>First, some text.</p><div class='share social'><a href=x>Share it</a></div><div class=ad>Buy this now, it is cheap.</div>"
     "<section id=comments><article class=comment><p>I do not agree with what is said here, at all.</p></article></section></main>", "Title\nFirst, some text."),
]


def test_articles_lose_nothing_by_their_class_words(spark):
    for model in (ht.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")), ht.fit([])):
        for page, text in ARTICLES:
            assert ht.main_text(f"<html><body><nav><a href=/>Home</a></nav>{page}<footer>End</footer></body></html>", model) == text


def test_given_pages_do_not_need_the_words(monkeypatch):
    monkeypatch.setattr(ht, "STRONG_WORDS", set())
    monkeypatch.setattr(ht, "WEAK_WORDS", set())
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()
    model = ht.fit(pages)
    assert all(ht.main_text(p, model) == plain(p) for p in pages)


def test_pages_move_the_weights():
    """Where pages call the parts of their articles by a word, the word loses its weight."""
    page = "<body><div class=top>x</div><article><div class=legal><p>Text, and more of it, which is long enough.</p></div><p>And so on, and so on.</p></article>"
    model = ht.fit([page] * 20)
    assert model.weights[ht.FEATURES.index("weak_box")] > ht.PRIOR["weak_box"] + 1
    assert ht.main_text(page, model).count("\n") == 1


def test_many_open_quotes_take_linear_time():
    ht.main_text('<a x="' * 200_000 + "<p title='" * 100_000 + "<b " * 100_000, ht.fit([]))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "<p"), (4, "<div>" * 3000 + "x"), (5, "no markup at all"), (None, OTHER), (6, "<article>" + "<p>long, text. " * 20000)]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, html string").withColumn("text", F.lit("own"))
    got = ht.extract(df, ht.fit([]))
    assert got.count() == len(rows) + 1
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[1] == texts[2] == "" and texts[6].count("\n") == 19999
    assert ht.extract(df.limit(0), ht.train(df.limit(0))).count() == 0
