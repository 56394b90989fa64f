"""Main text of web pages by a recurrent block labeller.

A page is a sequence of text blocks. Each is a vector of its hashed tag path, its hashed
words and a few numbers; a bidirectional LSTM reads the sequence from both ends and
labels every block, main text or not, in the light of the whole page.

There are no labelled pages, so the labeller is trained on two kinds that label
themselves: a bounded sample of the given pages, where tags and class names that say
what they hold (``teacher``) give the labels, and made-up pages that vary the wrappers
and the unwanted parts, some with the telling names taken away. The model then labels
every block of every page; the teacher is not asked again.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm import lstm
from snapmart.llm.blocks import Block, parse, vectors
from snapmart.llm.common import batches

#: Bounds of the training sample: pages, and characters of one.
PAGES, LONGEST = 200, 30_000
MADE = 600

CONTENT = {"article", "main", ".article", ".content", ".post", ".entry", ".story", ".main", ".body"}
UNWANTED = {
    "nav", "footer", "aside", "form", "head", "header", "button", "fieldset", "dialog", "menu", ".nav", ".navbar", ".navigation", ".menu", ".footer", ".header", ".sidebar",
    ".side", ".widget", ".ad", ".ads", ".advert", ".advertisement", ".banner", ".promo", ".sponsor", ".sponsored", ".cookie", ".cookies", ".consent", ".notice", ".alert",
    ".popup", ".modal", ".overlay", ".newsletter", ".subscribe", ".signup", ".login", ".search", ".form", ".share", ".social", ".related", ".recommended", ".breadcrumb",
    ".breadcrumbs", ".pagination", ".tags", ".meta", ".comments", ".comment", ".discussion", ".replies", ".reply", ".respond",
}


def teacher(path: frozenset[str]) -> bool:
    """Whether what stands around a block says that it is main text."""
    return not path & UNWANTED and bool(path & CONTENT)


# ---- made-up pages ----------------------------------------------------------------

_STEMS = "ba co de fi gu ha il jo ka lu mi no or pe qua ri sa tu ve wi xen yo zu the and of la el der die und que les".split()
_HINTS = {
    "nav": "Home About Contact News Products Blog Menu Login Sitemap Archive",
    "ad": "Sponsored Advertisement Buy now Best price Limited offer Click here",
    "notice": "We use cookies to improve your experience Accept all cookies privacy policy consent",
    "form": "Email Password Sign in Subscribe to our newsletter Submit Search",
    "comments": "Reply Posted by guest Comment Report Like Great article thanks for sharing",
    "footer": "All rights reserved Terms of use Privacy Imprint Contact",
    "side": "Related stories Most read Popular Trending You may also like Tags",
}
_FORMS = {
    "nav": ("<nav>{}</nav>", "<div class=\"menu\">{}</div>", "<ul id=\"nav\">{}</ul>", "<header><nav>{}</nav></header>", "<div class=\"navbar top\">{}</div>"),
    "ad": ("<div class=\"ad\">{}</div>", "<div class=\"advert\">{}</div>", "<aside class=\"sponsored\">{}</aside>", "<div id=\"banner\">{}</div>", "<section class=\"promo\">{}</section>"),
    "notice": ("<div class=\"cookie-notice\">{}</div>", "<div id=\"consent\"><p>{}</p></div>", "<div class=\"notice\">{}</div>", "<dialog>{}</dialog>", "<div class=\"alert\" role=\"alert\">{}</div>"),
    "form": ("<form>{}</form>", "<form class=\"login\">{}</form>", "<div class=\"newsletter\"><form>{}</form></div>", "<div class=\"search\">{}</div>"),
    "comments": ("<section class=\"comments\">{}</section>", "<div id=\"comments\">{}</div>", "<div class=\"comment\"><p>{}</p></div>", "<ol class=\"comment-list\">{}</ol>", "<div class=\"discussion\">{}</div>"),
    "footer": ("<footer>{}</footer>", "<div id=\"footer\">{}</div>", "<div class=\"site-footer\"><p>{}</p></div>"),
    "side": ("<aside>{}</aside>", "<div class=\"sidebar\">{}</div>", "<div id=\"side\"><ul>{}</ul></div>", "<div class=\"related\">{}</div>", "<div class=\"widget\">{}</div>"),
}
_WRAPPERS = ("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<div class=\"content\">{}</div>", "<div id=\"post\">{}</div>", "<div class=\"entry\">{}</div>", "<article class=\"story\">{}</article>")


def _words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(_STEMS) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def _sentences(rng: random.Random, n: int) -> str:
    out = []
    for i, w in enumerate(_words(rng, n)):
        new = not i or out[-1][-1] in ".!?"
        out.append((w.capitalize() if new else w) + (rng.choice([".", ".", ",", "!", "?"]) if rng.random() < 0.15 else ""))
    return " ".join(out)


def _unwanted(rng: random.Random, kind: str) -> str:
    hints = _HINTS[kind].split()
    if kind in ("nav", "side") or rng.random() < 0.2:
        inner = "".join(f'<li><a href="/x">{rng.choice(hints) if rng.random() < 0.5 else _words(rng, 1)[0]}</a></li>' for _ in range(rng.randint(2, 8)))
        inner = inner if "<ul" in kind else f"<ul>{inner}</ul>"
    elif rng.random() < 0.3:
        inner = "".join(f"<p>{_sentences(rng, rng.randint(3, 25))}</p>" for _ in range(rng.randint(1, 4)))
    else:
        inner = f"{'&copy; ' if kind == 'footer' and rng.random() < 0.5 else ''}{' '.join(rng.sample(hints, min(len(hints), 4))) if rng.random() < 0.4 else ''} {_sentences(rng, rng.randint(2, 20))}"
    return rng.choice(_FORMS[kind]).format(inner)


def made_page(rng: random.Random) -> str:
    """A page of random words, main text wrapped one way or another among unwanted parts."""
    body = [f"<h1>{_sentences(rng, rng.randint(3, 12))}</h1>"] if rng.random() < 0.9 else []
    for _ in range(rng.randint(1, 14)):
        text = _sentences(rng, rng.choice([1, 3, 8, 20, 40, 90]))
        body.append(rng.choice([f"<p>{text}</p>"] * 6 + [f"<p><b>{text}<br>", f"<h2>{text}</h2>", f"<ul><li>{text}</li><li>{_words(rng, 1)[0]}</li></ul>", f"<blockquote><p>{text}</p></blockquote>", f"<div>{text}</div>", f"<pre>{text}</pre>"]))
    for kind in ("ad", "form", "comments", "side", "notice"):
        if rng.random() < 0.15:
            body.insert(rng.randint(1, len(body)), _unwanted(rng, kind))
    before = [_unwanted(rng, k) for k in rng.sample(["nav", "ad", "notice", "form", "side"], rng.randint(0, 4))]
    after = [_unwanted(rng, k) for k in rng.sample(["footer", "ad", "comments", "side", "nav", "form"], rng.randint(0, 4))]
    head = f"<!DOCTYPE html><html><head><title>{_sentences(rng, 6)}</title><style>p{{}}</style></head><body>"
    return head + "".join(before) + rng.choice(_WRAPPERS).format("".join(body)) + "".join(after) + ("</body></html>" if rng.random() < 0.7 else "")


def _nameless(blocks: list[Block]) -> list[Block]:
    """The same blocks without the names that tell the teacher."""
    plain = {b.path: (b.path - UNWANTED) - CONTENT for b in blocks}
    return [Block(b.text, plain[b.path], b.linked, b.place) for b in blocks]


def fit(pages: list[str], made: int = MADE, seed: int = 0) -> lstm.Labeller:
    rng = random.Random(seed)
    x, y = [], []
    for source in [*pages, *(made_page(rng) for _ in range(made))]:
        blocks = parse(source)
        labels = np.array([teacher(b.path) for b in blocks], np.float32)
        if not labels.any():  # nothing there says where the main text is
            continue
        x.append(vectors(blocks))
        y.append(labels)
        if rng.random() < 0.1:
            x.append(vectors(_nameless(blocks)))
            y.append(labels)
    return lstm.train(x, y, seed=seed)


def train(pages: DataFrame, html: str = "html", key: str = "url") -> lstm.Labeller:
    """Fit on at most ``PAGES`` pages, drawn by a hash of page and key, and on made-up ones.

    The hash is held against the rate that gives as many pages (and half as many
    again), so the tasks together send no more than that to the driver.
    """
    place = F.xxhash64(F.col(key), F.col(html)).cast("double") / F.lit(2.0**64) + 0.5
    usable = pages.select(F.col(html).alias("html"), place.alias("place")).where(F.char_length("html").between(1, LONGEST))
    n = usable.count()
    drawn = usable.where(F.col("place") < 1.5 * PAGES / max(n, 1))
    return fit([r.html for r in drawn.orderBy("place", "html").limit(PAGES).collect()])


def main_text(sources: list[str], model: lstm.Labeller) -> list[str]:
    pages = [parse(s) for s in sources]
    logits = model.logits([vectors(p) for p in pages])
    return ["\n".join(b.text for b, v in zip(p, values, strict=True) if v > 0) for p, values in zip(pages, logits, strict=True)]


def extracted(pages: DataFrame, model: lstm.Labeller, columns: list[str] | None = None, html: str = "html", name: str = "text") -> DataFrame:
    """``columns`` of the pages (all by default) and the main text, blocks joined by line ends.

    A null or empty page, and one without main text, has the empty text. Markup may be
    unclosed or cut off anywhere. Rows come back as often as they came; a column that
    bears ``name`` is replaced.
    """
    columns = [c for c in (pages.columns if columns is None else columns) if c.lower() != name.lower()]
    schema = pages.select(*columns).schema.add(name, "string")
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sources in batches(html, rows):
            found = pa.array(main_text(sources.to_pylist(), shared.value), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in columns), found], [*columns, name])

    return pages.select(*dict.fromkeys([*columns, html])).mapInArrow(run, schema)
