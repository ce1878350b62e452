"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text that no block-level tag interrupts. Each block has the
features of its ancestors (tags, and the words of class, id and role) and of its text (length, share
inside links, closing punctuation). The field has two labels, main and other; it's trained on labelled
pages by gradient descent on the exact likelihood (forward and backward sums), and decoded by Viterbi.
Main blocks are joined by an empty line, in page order.

Labelled pages are pages whose elements carry ``data-main="1"`` or ``"0"``; leaf blocks take the label
of the nearest such ancestor. ``labelled_pages`` makes a bounded, fixed set in many layouts; any other
set can be passed to ``train``.

Pages are read forward only and elements hold a link to their parent, so time and space grow with the
page's length however broken or deeply nested it is.

Defined cases: null and empty pages, and pages without text, give an empty text; a tag that the page's
end cuts off is dropped with what it holds; a quote that nothing closes ends with its tag; a ``<`` that
begins no tag is text; scripts, styles, comments and form controls are never text; repeated pages give
equal texts; other columns pass through, but for one with the name of the new column, which is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags that end a leaf block, those whose content is no text, and those without content.
BLOCK = frozenset(
    "html head title body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("script style noscript template svg math iframe object textarea select button canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SPACE = frozenset("br img td wbr input".split())
_USED = frozenset(["class", "id", "role", "data-main", "hidden", "style"])
#: An end tag may hold white space, a slash and attributes; one that the page cuts off ends with it.
_END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.IGNORECASE) for tag in SILENT}
#: The end of a comment, from behind its first two hyphens on: ``<!-->`` and ``<!--->`` are whole comments.
_COMMENT_END = re.compile(r"-?>")
_LONG_COMMENT_END = re.compile(r"--!?>")
#: A new element of the first kind closes an open one of the second.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: An attribute's name and, after an equals sign, the quote that opens its value or the bare value.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("|'|[^\s>"'][^\s>]*+)?+)?+""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_GAP = re.compile(r"[\s/]*+")
_NONE = re.compile(r"display\s*+:\s*+none", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")
_LONG_REFERENCE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{8,});?")
_END = tuple(".!?…:;\"'”’»)]")


@dataclass(slots=True, eq=False)
class Node:
    """An open element: its tag, the feature names that no ancestor has, and the label that it or an ancestor states."""

    tag: str
    fresh: list[str]
    parent: Node | None
    label: int | None


@dataclass(slots=True, eq=False)
class Block:
    node: Node
    text: str
    linked: int

    @property
    def label(self) -> int | None:
        return self.node.label


def read_tag(html: str, at: int, last_quotes: dict[str, int]) -> tuple[int, dict[str, str], bool] | None:
    """(end, attributes, self-closing) of a tag whose name ends at ``at``; None if the page ends inside it.

    Reads forward only. A quote that nothing closes (``last_quotes`` tells where the last of each kind is) ends with
    the tag, at the next ``>``.
    """
    held: dict[str, str] = {}
    n = len(html)
    while True:
        begin, at = at, _GAP.match(html, at).end()
        if at >= n:
            return None
        if html[at] == ">":
            return at + 1, held, html[at - 1] == "/" and at > begin
        m = _ATTRIBUTE.match(html, at)
        name, value, at = m[1], m[2] or "", m.end()
        if value in ("'", '"'):
            end = html.find(value, at) if at <= last_quotes[value] else -1
            if end < 0:
                end = html.find(">", at)
                return (end + 1, held, False) if end >= 0 else None
            value, at = html[at:end], end + 1
        if len(name) < 10 and (key := name.lower()) in _USED:
            held.setdefault(key, value)


def leaf_blocks(html: str | None) -> list[Block]:
    """Leaf blocks with text, in page order, in time and space proportional to the page."""
    out: list[Block] = []
    if not html:
        return out
    stack = [Node("", [], None, None)]
    names: set[str] = set()  # feature names of the open elements
    opened: Counter[str] = Counter()
    last_quotes = {q: html.rfind(q) for q in "'\""}
    parts: list[str] = []
    linked = anchors = at = 0
    n = len(html)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(stack[-1], text, linked))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = decoded(raw) if "&" in raw else raw
            parts.append(text)
            if anchors:
                linked += len(text.strip())

    def close() -> None:
        gone = stack.pop()
        names.difference_update(gone.fresh)
        opened[gone.tag] -= 1

    begin = 0  # of the text that isn't added yet
    while (at := html.find("<", at)) >= 0:
        mark = html[at + 1 : at + 2]
        if mark in ("!", "?"):
            add(html[begin:at])
            if html.startswith("<!--", at):
                ended = _COMMENT_END.match(html, at + 4) or _LONG_COMMENT_END.search(html, at + 4)
                begin = at = n if ended is None else ended.end()
            else:
                end = html.find(">", at)
                begin = at = n if end < 0 else end + 1
            continue
        closing = mark == "/"
        m = _NAME.match(html, at + 1 + closing)
        if m is None:  # no tag but text
            at += 1
            continue
        add(html[begin:at])
        begin = at = m.end()
        tag = m[0].lower() if len(m[0]) < 16 else ""
        if html.startswith(">", at):
            begin = at = at + 1
            attributes, closed = {}, False
        elif (found := read_tag(html, at, last_quotes)) is not None:
            begin, attributes, closed = found
            at = begin
        else:
            begin = n
            break
        if closing:
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag in BLOCK:
                flush()
                if opened[tag]:
                    while stack[-1].tag != tag:
                        close()
                    close()
            continue
        if tag in SILENT:
            if not (closed and tag in ("svg", "math")):
                end = _END_OF[tag].search(html, at)
                begin = at = n if end is None else end.end()
            parts.append(" ")
            continue
        if tag == "a":
            anchors += 1
        if tag in _SPACE:
            parts.append(" ")
        if tag not in BLOCK:
            continue
        flush()
        anchors = 0
        top = stack[-1].tag
        if top == "p" or tag in _CLOSES and top in _CLOSES[tag]:
            close()
        if tag in VOID:
            continue
        own, label = ["tag:" + tag], stack[-1].label
        if attributes:
            for key in ("class", "id", "role"):
                if value := attributes.get(key):
                    own += {"word:" + t[0] for t in _TOKEN.finditer(value.lower())}
            if "data-main" in attributes:
                label = int(attributes["data-main"] == "1")
            if "hidden" in attributes or _NONE.search(attributes.get("style", "")):
                own.append("word:hidden")
        fresh = sorted(set(own) - names)
        names.update(fresh)
        opened[tag] += 1
        stack.append(Node(tag, fresh, stack[-1], label))
    add(html[begin:])
    flush()
    return out


def decoded(raw: str) -> str:
    """Text with its character references resolved; numbers beyond any code point become U+FFFD."""
    return unescape(_LONG_REFERENCE.sub("\ufffd", raw) if "&#" in raw else raw)


def node_features(node: Node) -> list[str]:
    """Tags and attribute words of an element and its ancestors, and its own tag."""
    names, at = [], node
    while at is not None:
        names += at.fresh
        at = at.parent
    return [*sorted(names), "leaf:" + node.tag]


def text_features(block: Block) -> tuple[int, int, int]:
    """Buckets of length, share inside links, and closing punctuation."""
    n = len(block.text)
    return min(n.bit_length(), 11), min(4, 4 * block.linked // n), int(block.text.endswith(_END))


@dataclass(frozen=True)
class Model:
    """Weights for main against other: of features, of a label before a label, and of a label at the start."""

    weight: dict[str, float]
    step: tuple[tuple[float, float], tuple[float, float]]
    start: tuple[float, float]


class Scorer:
    """A model that labels and extracts."""

    def __init__(self, model: Model) -> None:
        self.model, self.texts = model, {}

    def emissions(self, blocks: list[Block]) -> list[float]:
        """Each block's weight for main. An element's sum is its parent's and its own new features'."""
        weight = self.model.weight
        sums: dict[int, float] = {}
        out = []
        for block in blocks:
            chain, at = [], block.node
            while at is not None and id(at) not in sums:
                chain.append(at)
                at = at.parent
            for node in reversed(chain):
                before = sums[id(node.parent)] if node.parent is not None else 0.0
                sums[id(node)] = before + sum(weight.get(x, 0.0) for x in node.fresh)
            key = text_features(block)
            text = self.texts.get(key)
            if text is None:
                text = self.texts[key] = sum(weight.get(f"text:{k}:{v}", 0.0) for k, v in enumerate(key))
            out.append(sums[id(block.node)] + weight.get("leaf:" + block.node.tag, 0.0) + text)
        return out

    def viterbi(self, blocks: list[Block]) -> list[int]:
        """The most likely labels; of equal ones, other."""
        if not blocks:
            return []
        (oo, om), (mo, mm) = self.model.step
        other, main = self.model.start
        back = []
        for k, e in enumerate(self.emissions(blocks)):
            if k == 0:
                main += e
                continue
            to_other, to_main = other + oo >= main + mo, other + om >= main + mm
            back.append((0 if to_other else 1, 0 if to_main else 1))
            other, main = (other + oo if to_other else main + mo), (other + om if to_main else main + mm) + e
        label = int(main > other)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def extract(self, html: str | None) -> str:
        blocks = leaf_blocks(html)
        return "\n\n".join(b.text for b, label in zip(blocks, self.viterbi(blocks), strict=True) if label)


def fit(pages: list[str], passes: int = 100, rate: float = 3.0, decay: float = 2e-5) -> Model:
    """Maximum likelihood with an L2 penalty by Adagrad over pages of labelled blocks."""
    names: dict[str, int] = {}
    chains = []
    for page in pages:
        blocks = [b for b in leaf_blocks(page) if b.label is not None]
        if not blocks:
            continue
        rows = []
        for b in blocks:
            own = node_features(b.node) + [f"text:{k}:{v}" for k, v in enumerate(text_features(b))]
            rows.append(np.array([names.setdefault(x, len(names)) for x in own]))
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        chains.append((np.concatenate(rows), owner, np.array([b.label for b in blocks])))
    w, step, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    sums = [np.full(x.shape, 1e-8) for x in (w, step, start)]
    for _ in range(passes):
        grads = [decay * w * len(chains), decay * step * len(chains), decay * start * len(chains)]
        for feature, owner, y in chains:
            n = len(y)
            up = np.exp(np.clip(np.bincount(owner, weights=w[feature], minlength=n), -40, 40)).tolist()
            p, pairs = _marginals(up, np.exp(step).tolist(), np.exp(start).tolist())
            np.add.at(grads[0], feature, (p - y)[owner])
            grads[1] += pairs
            np.add.at(grads[1], (y[:-1], y[1:]), -1.0)
            grads[2] += [1 - p[0], p[0]]
            grads[2][y[0]] -= 1
        for x, g, s in zip((w, step, start), grads, sums, strict=True):
            s += g * g
            x -= rate * g / np.sqrt(s)
    return Model({k: float(w[i]) for k, i in names.items()}, tuple(tuple(map(float, r)) for r in step), tuple(map(float, start)))


def _marginals(up: list[float], step: list[list[float]], start: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Probability of main at each block, and expected steps between labels, by scaled forward and backward sums."""
    (oo, om), (mo, mm) = step
    forward, other, main = [], start[0], start[1] * up[0]
    for k, g in enumerate(up):
        if k:
            other, main = other * oo + main * mo, (other * om + main * mm) * g
        total = other + main
        other, main = other / total, main / total
        forward.append((other, main))
    p, sums, after = [forward[-1][1]], [0.0] * 4, (1.0, 1.0)
    for k in range(len(up) - 1, 0, -1):
        a, b = forward[k - 1]
        x, y = after[0], after[1] * up[k]
        cells = (a * oo * x, a * om * y, b * mo * x, b * mm * y)
        total = sum(cells)
        sums = [s + c / total for s, c in zip(sums, cells, strict=True)]
        p.append((cells[2] + cells[3]) / total)
        x, y = oo * x + om * y, mo * x + mm * y
        after = (x / (x + y), y / (x + y))
    return np.array(p[::-1]), np.array(sums).reshape(2, 2)


def labelled_pages(n: int = 300, seed: int = 11) -> list[str]:
    """A fixed set of labelled pages in many layouts: menus, headers, sidebars, notices, adverts, forms, comments and articles."""
    rng = np.random.default_rng(seed)
    syllables = ["ta", "ri", "mo", "len", "sha", "dor", "ve", "ist", "un", "ка", "né", "zü"]

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(low, high)))

    def sentence(low: int = 4, high: int = 22) -> str:
        return words(low, high).capitalize() + rng.choice([".", ".", ".", "!", "?", " &amp; co.", ""])

    def paragraph() -> str:
        tag = rng.choice(["p", "p", "p", "p", "p", "blockquote", "h2", "h3", "li", "pre", "div"])
        body = sentence(1, 6) if tag in ("h2", "h3") or rng.random() < 0.2 else " ".join(sentence() for _ in range(rng.integers(1, 7)))
        if rng.random() < 0.15:
            body = words(1, 3)
        if rng.random() < 0.25:
            body = f"<b>{body}" + rng.choice(["</b>", "<br>", ""])
        if rng.random() < 0.15:
            body += f' <a href="/x">{words(1, 4)}</a>'
        end = f"</{tag}>" if rng.random() < 0.85 or tag != "p" else ""
        return f"<{tag}>{body}{end}"

    def links(low: int, high: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{words(1, 4)}</a></li>' for k in range(rng.integers(low, high))) + "</ul>"

    def other(kind: str) -> str:
        short, long = sentence(1, 12), " ".join(sentence() for _ in range(rng.integers(1, 4)))
        name = {
            "menu": ["menu", "navbar", "nav-links", "breadcrumb", "navigation"], "side": ["sidebar", "widget", "related-posts", "side-bar rail"],
            "ad": ["ad", "ads", "advert", "ad-slot", "banner", "sponsored", "promo"], "notice": ["cookie-notice", "cookie-banner", "consent", "gdpr", "notice", "alert", "popup", "modal"],
            "form": ["newsletter-form", "subscribe", "search", "signup", "login"], "comments": ["comments", "comment-list", "reader-comments", "responses", "disqus"],
            "share": ["share", "social", "share-buttons", "tags", "meta", "byline"],
        }
        pick = rng.choice(name[kind]) if kind in name else ""
        at = rng.choice([f'class="{pick}"', f'id="{pick}"', f"class='{pick} box'"])
        return {
            "nav": lambda: f'<nav data-main="0">{links(3, 9) if rng.random() < 0.8 else words(1, 9)}</nav>',
            "header": lambda: f'<header data-main="0"><div class="site-header logo">{words(1, 4)}</div>{links(0, 5)}<p>{short}</p></header>' if rng.random() < 0.7 else f'<header data-main="0">{short}</header>',
            "footer": lambda: f'<footer data-main="0">&copy; {words(1, 3)} &middot; {rng.choice([short, long])}{links(0, 4)}</footer>',
            "aside": lambda: f'<aside data-main="0">{short}</aside>' if rng.random() < 0.4 else f'<aside data-main="0"><h3>{words(1, 4)}</h3><p>{long}</p>{links(0, 5)}</aside>',
            "menu": lambda: f'<div {at} data-main="0">{links(2, 8)}</div>', "side": lambda: f'<div {at} data-main="0"><h4>{words(1, 4)}</h4>{links(1, 6)}<p>{short}</p></div>',
            "ad": lambda: f'<div {at} data-main="0">{rng.choice([short, long])}</div>', "notice": lambda: f'<{(t := rng.choice(["div", "section", "dialog"]))} {at} data-main="0"><p>{long}</p></{t}>',
            "form": lambda: f'<form {at} data-main="0"><label>{words(1, 4)}</label><p>{short}</p><button>{words(1, 2)}</button></form>',
            "comments": lambda: f'<{(t := rng.choice(["section", "div", "ol"]))} {at} data-main="0">' + "".join(f'<div class="comment"><h4>{words(1, 3)}</h4><p>{" ".join(sentence() for _ in range(rng.integers(1, 4)))}</p></div>' for _ in range(rng.integers(1, 5))) + f"</{t}>",
            "share": lambda: f'<div {at} data-main="0">{links(1, 4)}</div>',
        }[kind]()

    pages = []
    for _ in range(n):
        bare = rng.random() < 0.3  # a fragment: no head, and often nothing before the article
        before = [other(k) for k in rng.choice(["nav", "header", "menu", "ad", "notice", "form", "aside"], 0 if bare and rng.random() < 0.7 else rng.integers(0, 5))]
        after = [other(k) for k in rng.choice(["footer", "aside", "side", "ad", "comments", "form", "notice", "nav"], rng.integers(1, 5))]
        body = [paragraph() for _ in range(rng.integers(1, 14))]
        title = f"<h1>{sentence(2, 9)}</h1>" if rng.random() < 0.85 else ""
        if rng.random() < 0.6:
            body.insert(int(rng.integers(0, len(body) + 1)), other(rng.choice(["ad", "aside", "share", "form", "side"])))
        if rng.random() < 0.2:
            body.append(other("comments"))
        wrap = rng.choice(["article", "article", "article", "main", 'main><article', 'div class="content"', 'div id="article-body"', 'div class="post-content entry"', 'section class="story text"', 'div role="main"'])
        close = "".join(f"</{re.match(r'[a-z]+', x)[0]}>" for x in reversed(wrap.split("><")))
        head = f'<!DOCTYPE html><html><head><title data-main="0">{sentence(2, 9)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
        head = "<body>" if bare else head
        pages.append(head + "".join(before) + f'<{wrap} data-main="1">{title}{"".join(body)}{close}' + "".join(after) + rng.choice(["</body></html>", ""]))
    return pages


@lru_cache(maxsize=1)
def default_model() -> Model:
    return fit(labelled_pages())


def extract(pages: DataFrame, model: Model | None = None, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text in the new column ``into``. The model is a few thousand weights."""
    held = pages.sparkSession.sparkContext.broadcast(model or default_model())

    @F.arrow_udf("string")
    def main_text(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(held.value)
        for column in columns:
            yield pa.array([scorer.extract(x.as_py()) for x in column], pa.string())

    return pages.withColumn(into, main_text(F.col(html).cast("string")))
