import html
import random
import re

import numpy as np
import pytest

from snapmart.llm import blocks, extraction, lstm


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return extraction.train(pages)


def article(source):
    """The paragraphs of the article, by plain patterns that fit these pages alone."""
    inner = re.search(r"(?s)<article>(.*?)(</article>|\Z)", source)
    out = []
    for x in re.split(r"</?(?:p|h1)>", inner[1] if inner else ""):
        x = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*(>|\Z)", "", x.replace("<br>", " ")))).strip()
        out += [x] if x else []
    return "\n".join(out)


def test_pages_match_their_articles(spark, pages, model):
    got = extraction.extracted(pages, model, ["html", "url"]).collect()
    assert len(got) == pages.count()
    assert [r.html for r in got if r.text != article(r.html or "")] == []


def test_made_pages(model):
    rng = random.Random(77)
    wrong = total = 0
    for _ in range(200):
        page = blocks.parse(extraction.made_page(rng))
        labels = np.array([extraction.teacher(b.path) for b in page])
        wrong += ((model.logits([blocks.vectors(page)])[0] > 0) != labels).sum()
        total += len(page)
    assert wrong < 0.005 * total


def test_a_page_of_its_own(model):
    source = """<html><head><title>T</title><script>if (a < b) { x("</p>") }</script></head><body><header><a href=/>Home</a> <a href=/n>News</a></header>
    <div class='cookie-banner'>We use cookies <button>Accept</button></div><main><article><h1>Head &amp; tail</h1><p>First  paragraph,<br>with <i>some</i> more words
    in it.</p><form><input value=">"><label>Email</label></form><p>Second &lt;one&gt; &#233;.</article></main><aside><ul><li><a href=x>Most read</a></ul></aside>
    <section class="comments"><p>Great article, thanks!</p></section><footer>&copy; 2024</footer></body>"""
    assert extraction.main_text([source], model) == ["Head & tail\nFirst paragraph, with some more words in it.\nSecond <one> é."]


HELD = ("svg", "video", "audio", "object", "canvas", "select", "noscript", "template", "math")


@pytest.mark.parametrize("tag", HELD)
def test_text_of_and_behind_other_elements(model, tag):
    sentence = "Some plain words, told here at length, make up this paragraph."
    unclosed = f"<article><p>First one.</p><{tag} class=x><p>{sentence}</p><p>{sentence}</p></article><footer>&copy; 2024</footer>"
    assert extraction.main_text([unclosed], model) == [f"First one.\n{sentence}\n{sentence}"]
    inside = blocks.parse(f"<article><p>First one.</p><{tag}>{sentence}</{tag}><p>Last one.</p></article>")
    assert [b.text for b in inside] == ["First one.", sentence, "Last one."]
    assert [tag in b.path for b in inside] == [False, True, False]


def test_odd_pages(spark, model):
    rows = [(1, None, "t"), (2, "", "t"), (3, "<", "t"), (4, "<p", "t"), (5, "<article><p>cut off &am", "t"), (6, "<!-- never closed <p>x", "t"), (7, "<script>alert(1)", "t"),
            (8, "</div></p></b>" * 50, "t"), (9, "<article>" + "<div><b>" * 3000 + "deep", "t"), (9, "<article><p>" + "word " * 200_000 + "</p></article>", "t"), (10, "<p a='<'>x</p><article><p>A.</p></article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extraction.extracted(pages, model, ["page_id", "text"])
    assert got.columns == ["page_id", "text"]
    found = got.collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found if len(r.text) < 1000}
    assert texts[1] == texts[2] == texts[4] == texts[6] == texts[7] == texts[8] == ""
    assert texts[5] == "cut off &am" and texts[10].endswith("A.")
    assert extraction.extracted(pages.limit(0), model).count() == 0


def test_training_without_pages(spark):
    model = extraction.train(spark.createDataFrame([], "html string, url string"))
    assert extraction.main_text(["<nav><ul><li><a href=x>Home</a></li></ul></nav><article><p>Some words, told here.</p></article>"], model) == ["Some words, told here."]


def test_gradients():
    rng = np.random.default_rng(0)
    weights = {"v": rng.normal(size=6), "a": rng.normal(size=1)}
    for d in (0, 1):
        weights |= {f"w{d}": rng.normal(size=(4, 12)), f"u{d}": rng.normal(size=(3, 12)), f"b{d}": rng.normal(size=12)}
    model, x, lengths = lstm.Labeller(weights), rng.normal(size=(5, 2, 4)), np.array([5, 3])
    y = (rng.random((5, 2)) > 0.5).astype(float)
    _, grads = model.gradients(x, lengths, y)
    for k, g in grads.items():
        at = tuple(rng.integers(0, n) for n in g.shape)
        keep = weights[k][at]
        losses = []
        for step in (1e-5, -1e-5):
            weights[k][at] = keep + step
            losses.append(model.gradients(x, lengths, y)[0])
        weights[k][at] = keep
        assert abs((losses[0] - losses[1]) / 2e-5 - g[at]) < 1e-5


def test_batches_do_not_change_logits():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(n, 4)).astype(np.float32) for n in (3, 1, 7, 2)]
    model = lstm.train(x, [np.zeros(len(s), np.float32) for s in x], hidden=3, steps=2, batch=2)
    for a, s in zip(model.logits(x), x, strict=True):
        assert np.allclose(a, model.logits([s], cells=1)[0], atol=1e-5)
    assert model.logits([np.zeros((0, 4), np.float32)])[0].shape == (0,)
