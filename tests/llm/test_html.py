"""Main text: message passing against enumeration, fresh labelled pages, hand-made pages."""

import itertools
import math
import random

import numpy as np
import pytest

from tamarind.llm import html_extract as H
from tamarind.llm import html_pages as P


@pytest.fixture(scope="module")
def model():
    return H.train(P.labelled_pages())


def test_marginals_equal_enumeration():
    page = H.Page("<body><div class='ad'>x</div><article><p>one</p><p>two <b>b</b></p></article></body>")
    forest = H.Forest([page])
    n = len(page.parent)
    rng = np.random.default_rng(1)
    weight, pair = rng.normal(size=H.N_FEATURES), rng.normal(size=(2, 2))
    p, joint, log_z = forest.marginals(weight, pair)
    unary = forest.features @ weight
    total, each = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        e = math.exp(sum(unary[i] * y[i] for i in range(n)) + sum(pair[y[page.parent[i]], y[i]] for i in range(1, n)))
        total += e
        each += e * np.array(y)
    assert np.allclose(p, each / total) and log_z == pytest.approx(math.log(total))
    assert np.allclose(joint[1:].sum(axis=(1, 2)), 1) and np.allclose(joint[1:, :, 1].sum(axis=1), p[1:])


def test_fresh_labelled_pages(model):
    rng = random.Random(77)
    pages = [f"<html><body>{P._before(rng)}{P._article(rng)}{P._after(rng)}{P._foot(rng)}</body></html>" for _ in range(150)]
    forest = H.Forest([H.Page(h) for h in pages])
    p, _, _ = forest.marginals(*model)
    assert ((p > 0.5) == forest.label)[forest.leaf].mean() > 0.99


def test_every_part_but_the_article_is_left_out(model):
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><a href=/>Site</a></header><nav><ul><li><a href=1>one</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
    <!-- c --><div class="ad">Buy now.</div><main><article><h1>The &amp; title</h1><p>First   para&nbsp;graph\n&copy; <b>bold</b><i>it</i>.
    <p>Second.<div class="ad">Buy more.</div><ul><li>Item</li><li>x</li></ul><form><input><button>Go</button></form></article></main>
    <aside class="sidebar"><p>Side text here.</p></aside><section class="comments"><h2>Comments</h2><p>I liked it.</p></section>
    <footer>&copy; Site</footer></body></html>"""
    assert H.extract_texts([html], model) == ["The & title\n\nFirst para graph © boldit.\n\nSecond.\n\nItem\n\nx"]


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<html></html>", ""), ("<article>" + "<p>word</p>" * 3000, "\n\n".join(["word"] * 3000)),
    ("<article><p>a<br>b</p></article>", "a b"), ("<article><p>&lt;p&gt; &#233;&eacute; &bogus;</p></article>", "<p> éé &bogus;"),
    ("<nav><a href=x>only a menu</a></nav>", "")])
def test_small_pages(model, html, text):
    assert H.extract_texts([html], model) == [text]


def test_deep_and_broken_pages_do_not_fail(model):
    pages = ["<div>" * 3000 + "deep", "</p></div></article>", "<table><tr><td>x<table>", "<a<b>>&#x0;<!--", "<script>", "<p>" + "&amp;" * 50000]
    assert len(H.extract_texts(pages, model)) == len(pages)


def test_odd_rows(spark, model):
    df = spark.createDataFrame([(1, "u", None, "t"), (2, "u", "", "t"), (3, "u", "<article><p>x</p></article>", "t"), (3, "u", "<article><p>x</p></article>", "t"),
                                (4, None, "<p", "t")], "page_id long, url string, html string, text string")
    rows = H.extract(df, model=model)
    assert rows.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted((r.page_id, r.text, r.n_chars) for r in rows.collect())[:4] == [(1, "", 0), (2, "", 0), (3, "x", 1), (3, "x", 1)]
    assert H.extract(df.limit(0), model=model).collect() == []


@pytest.mark.parametrize("value", ["='x'", "='12.5'", "=''", "", "='0'"])
def test_label_attributes_of_given_pages_mean_nothing(model, value):
    assert H.extract_texts([f"<article><p data-y{value}>One word.</p></article>"], model) == ["One word."]


@pytest.mark.parametrize("html, text", [
    ("<head><title>T</title><article><p>One.</p><p>Two.</p></article>", "One.\n\nTwo."),
    ("<html><head><meta charset=x><title>T</title><style>p{}</style><noscript><link></noscript><body><article><p>One.</p></article>", "One."),
    ("<article><p>One <svg><path d=x> two.</p><p>Three.</p></article>", "One\n\nThree."),
    ("<article><div><svg><path></div><p>Two.</p></article>", "Two."),
    ("<article><p>One.<iframe src=x></p><p>Two.</p></article>", "One.\n\nTwo."),
    ("<article><p>One.</p><svg><p>Two.</p></article>", "One.\n\nTwo."),
    ("<article><p>One.</p><object><p>Two.</p><noscript><p>Three.</p></article>", "One.\n\nTwo.\n\nThree."),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p></article>", "Let x=2 be."),
    ("<article><p>One <noscript>two</noscript> <object>three</object> <canvas>four</canvas> <map>five</map>.</p></article>",
     "One two three four five."),
    ("<article><div><template><div>no</div><p>no</p></template><p>One.</p></div><svg><g><text>no</text></g><path/></svg><p>Two.</p></article>",
     "One.\n\nTwo.")])
def test_unclosed_and_other_elements_drop_no_text(model, html, text):
    assert H.extract_texts([html], model) == [text]


@pytest.mark.parametrize("html", ["<ul>" * 60_000, "<div>x" * 50_000, "<ul><li>a" * 30_000, "<svg>" + "<g>" * 60_000 + "</g>" * 20_000,
                                  "<p>" + "<span>" * 60_000, "<table><tr><td>" * 20_000])
def test_deep_nests_take_linear_time(html):
    import time
    begin = time.perf_counter()
    H.Forest([H.Page(html, labelled=False)]).marginals(np.zeros(H.N_FEATURES), np.zeros((2, 2)), joints=False)
    assert time.perf_counter() - begin < 8
