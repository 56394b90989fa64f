"""HTML to a sequence of text blocks, each with what stands around it.

A block is the text between two block-level tags. Tags may be unclosed, misnested or
cut off; scripts, styles and the like are no text; character references are decoded.
What stands in formulas, drawings, media, lists of choices and the like is text with
these in its path, for the labeller to judge.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np

PATH, WORDS, NUMBERS = 256, 64, 8

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

#: Elements without markup in them, none of it text.
RAW = {"script", "style", "textarea", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt",
    "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "br",
    "mfrac", "mi", "mn", "mo", "mover", "mroot", "mrow", "ms", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "munderover", "semantics", "tspan",
}
HEAD = VOID | RAW | {"head", "title", "noscript", "template"}
#: A block-level start tag ends these, as they hold no such blocks.
FOREIGN = {"svg", "math"}
#: A start tag ends these open elements, unless one of the walls stands between.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
NO_PARAGRAPH = {"article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"}
WALLS = {"foreignobject", "object", "template", "ul", "ol", "dl", "table", "div", "section", "article", "aside", "main", "nav", "form", "body", "html"}


@dataclass
class Block:
    text: str
    path: frozenset[str]
    linked: int  # characters inside links
    place: int


def tokens_of(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and each word of its class, id and role."""
    if not attributes:
        return (tag,)
    words = [w for m in _ATTRIBUTE.finditer(attributes) for w in _PART.findall((m[2] or m[3] or m[4] or "").lower())]
    return (tag, *(f".{w}" for w in words))


def parse(source: str) -> list[Block]:
    """The blocks of a page in order, those without text left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: dict[str, int] = {}
    path: frozenset[str] | None = None
    text: list[str] = []
    linked = links = 0
    at, n = 0, len(source)

    def flush() -> None:
        nonlocal linked, path
        if text:
            joined = "".join(text)
            text.clear()
            if "&" in joined:
                joined = html.unescape(joined)
            joined = _SPACE.sub(" ", joined).strip()
            if joined:
                if path is None:
                    path = frozenset(held)
                out.append(Block(joined, path, linked, len(out)))
        linked = 0

    def push(tag: str, names: tuple[str, ...]) -> None:
        nonlocal path
        stack.append((tag, names))
        for x in names:
            held[x] = held.get(x, 0) + 1
        path = None

    def pop() -> None:
        nonlocal path, links
        tag, names = stack.pop()
        for x in names:
            held[x] -= 1
            if not held[x]:
                del held[x]
        if tag == "a":
            links -= 1
        path = None

    def close(tags: set[str]) -> None:
        """Pop down to the nearest open element of these, if no wall hides it."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in WALLS:
                return

    while at < n:
        m = _TOKEN.search(source, at)
        until = m.start() if m else n
        if until > at:
            text.append(source[at:until])
            if links:
                linked += until - at
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        elif tag == "br":
            text.append(" ")
        if m[1]:
            if held.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = end.end() if end else n
            continue
        if tag in VOID or (m[3].endswith("/") and FOREIGN & held.keys()):
            continue
        if "head" in held and tag not in HEAD:
            close({"head"})
        if tag == "p" or tag in NO_PARAGRAPH:
            for x in FOREIGN & held.keys():
                close({x})
        if tag in CLOSES:
            close(CLOSES[tag])
        elif tag in NO_PARAGRAPH and "p" in held:
            close({"p"})
        if tag == "a":
            links += 1
        push(tag, tokens_of(tag, m[3]))
    flush()
    return out


def _bucket(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


_path_cache: dict[frozenset, np.ndarray] = {}


def path_vector(path: frozenset[str]) -> np.ndarray:
    """Hashed tokens of the path, one apiece."""
    if path not in _path_cache:
        if len(_path_cache) > 50_000:
            _path_cache.clear()
        v = np.zeros(PATH, np.float32)
        for t in path:
            v[_bucket(t, PATH)] = 1
        _path_cache[path] = v
    return _path_cache[path]


def vectors(blocks: list[Block]) -> np.ndarray:
    """A row a block: path tokens, hashed words in parts of the block's words, and a few numbers."""
    out = np.zeros((len(blocks), PATH + WORDS + NUMBERS), np.float32)
    total = max(len(blocks) - 1, 1)
    for row, b in zip(out, blocks, strict=True):
        row[:PATH] = path_vector(b.path)
        words = b.text.lower().split()
        counts = np.bincount(np.fromiter((hash_of(w) for w in words), np.int64, len(words)), minlength=WORDS)
        row[PATH : PATH + WORDS] = counts / len(words)
        n = len(b.text)
        row[PATH + WORDS :] = (
            1, np.log1p(n) / 8, np.log1p(len(words)) / 6, min(b.linked / n, 1.0), b.place / total,
            b.text[-1] in ".!?…", min(sum(b.text.count(c) for c in ".,;:") / len(words), 1), "©" in b.text,
        )
    return out


_word_cache: dict[str, int] = {}


def hash_of(word: str) -> int:
    found = _word_cache.get(word)
    if found is None:
        if len(_word_cache) > 300_000:
            _word_cache.clear()
        found = _word_cache[word] = _bucket(word, WORDS)
    return found
