"""Main text of web pages, by a tree-structured graphical model over DOM nodes.

Every block element is a node that is content or not. A node's own evidence (tag, words of
class, id and role, lengths, link share, place) and the potentials between parent and child
make a tree model. Sum-product messages pass upward and downward once, which yields each
node's exact marginal; text directly in nodes of marginal one half or more is kept. Weights
are those of greatest conditional likelihood on labelled pages, found with the same
messages; the labelled pages are built here from page plans whose parts are known.

Inline elements belong to the block around them. Scripts, styles, comments, titles, the
insides of form controls and buttons, what a video, audio or canvas shows instead of itself,
and blocks that are hidden by attribute or style are no text; other text in an open head ends the head, as in
browsers, and is text of the page. Character references are decoded, white space
within a block is one space, and blocks are joined in page order by two line feeds. Null,
empty and text-free pages give an empty text; repeated rows get a row each.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|object)(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|select|object|button|video|audio|canvas)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
_STYLE = re.compile(r"(?<![\w-])style\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PART = re.compile(r"[a-z]+", re.I)
#: Block elements; all others are inline.
BLOCKS = (
    "html body main article section div nav header footer aside form fieldset figure figcaption h1 h2 h3 h4 h5 h6 p ul"
    " ol li dl dt dd blockquote pre table thead tbody tfoot tr td th address details summary hgroup center dialog menu"
).split()
_BLOCK = {tag: i for i, tag in enumerate(BLOCKS)}
_VOID = {"hr"}
#: What an opening tag ends, if it is open within the nearest of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_WORDS, _BINS, _NUMBERS = 2048, 8, 7
_N_FEATURES = 1 + 2 * len(BLOCKS) + _WORDS + _BINS * _NUMBERS
_KINDS = 4


@dataclass
class Page:
    """Nodes in document order (a parent comes first) and the texts directly in them."""

    parent: list[int] = field(default_factory=list)
    tag: list[int] = field(default_factory=list)
    words: list[list[int]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    texts: list[tuple[int, str]] = field(default_factory=list)
    link_chars: list[int] = field(default_factory=list)


def _unclosed(match: re.Match) -> bool:
    """Whether a comment or a raw element goes on to the end of the page."""
    if match[0].startswith("<!--"):
        return not match[0].endswith("-->")
    if not match["raw"]:
        return False
    inside = match[0][match[0].index(">") + 1 :]
    return not inside[:-1].rstrip().lower().endswith(f"</{match['raw'].lower()}")


def parse(source: str) -> Page:
    page = Page()
    stack: list[int] = []
    run: list[str] = []
    names = page.tag
    hidden: set[int] = set()
    in_link = False

    def open_node(tag: str, attrs: str) -> None:
        page.parent.append(stack[-1] if stack else -1)
        names.append(_BLOCK[tag])
        found: list[int] = []
        if attrs:
            for a, b, c in _NAMED.findall(attrs):
                found += [zlib.crc32(w.lower().encode()) % _WORDS for w in _PART.findall(a or b or c)]
            page.label.append(1 if 'data-content="1"' in attrs else 0)
            styles = (a or b for a, b in _STYLE.findall(attrs))
            if _HIDDEN.search(_QUOTED.sub('""', attrs)) or any(map(_UNSEEN.search, styles)):
                hidden.add(len(names) - 1)
        else:
            page.label.append(0)
        if page.parent[-1] in hidden:
            hidden.add(len(names) - 1)
        page.words.append(found)
        page.link_chars.append(0)
        stack.append(len(names) - 1)

    def open_body() -> None:
        """As in browsers, what stands outside of a body opens one."""
        if not stack:
            open_node("html", "")
        if len(stack) == 1 and names[stack[0]] == _BLOCK["html"]:
            open_node("body", "")

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                open_body()
                if stack[-1] not in hidden:
                    page.texts.append((stack[-1], text))

    def close(tags: set[str], within: set[str]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            name = BLOCKS[names[stack[depth]]]
            if name in tags:
                flush()
                del stack[depth:]
                return
            if name in within:
                return

    # Behind the last ">" no tag can end, so none is looked for: each "<" would be searched to the end.
    at, end, match = 0, source.rfind(">") + 1, None
    for match in _TOKEN.finditer(source, 0, end):
        if match.start() > at:
            piece = source[at : match.start()]
            run.append(piece)
            if in_link and stack:
                page.link_chars[stack[-1]] += len(piece)
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = not match["end"]
        elif tag in ("br", "hr", "img", "input", "button", "option", "label"):
            run.append(" ")
        if tag not in _BLOCK:
            continue
        if match["end"]:
            if any(names[n] == _BLOCK[tag] for n in stack):
                close({tag}, set())
            else:
                flush()
        else:
            flush()
            in_link = False
            close({"p"}, {"li", "td", "th", "blockquote", "div", "article", "section", "body", "dd"})
            if tag in _ENDS:
                close(*_ENDS[tag])
            if tag not in ("html", "body"):
                open_body()
                open_node(tag, match["attrs"])
            elif not any(names[n] == _BLOCK[tag] for n in stack):
                if tag == "body" and not stack:
                    open_node("html", "")
                open_node(tag, match["attrs"])
    if not (match and at == end and _unclosed(match)):
        piece, comment, _ = source[end:].partition("<!--")
        run.append(source[at:end] + piece)
        if comment and in_link and stack:
            page.link_chars[stack[-1]] += len(run[-1])
    flush()
    return page


def _bin(values: np.ndarray) -> np.ndarray:
    return np.minimum(_BINS - 1, np.log2(1 + values).astype(np.int64))


def node_features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of all pages together: parents, depths, kinds of edges, and features as index and owner."""
    sizes = np.array([len(p.tag) for p in pages])
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    parent = np.concatenate([np.array(p.parent, dtype=np.int64) for p in pages]) if n else np.empty(0, np.int64)
    base = np.repeat(starts, sizes)
    parent = np.where(parent >= 0, parent + base, -1)
    tag = np.array([t for p in pages for t in p.tag], dtype=np.int64)
    depth = np.zeros(n, dtype=np.int64)
    chars, marks, links = np.zeros(n), np.zeros(n), np.array([c for p in pages for c in p.link_chars], dtype=float)
    for start, page in zip(starts.tolist(), pages, strict=True):
        for node, text in page.texts:
            chars[start + node] += len(text)
            marks[start + node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
    for i in range(n):
        if parent[i] >= 0:
            depth[i] = depth[parent[i]] + 1
    sums = np.stack([chars, marks, links, (tag == _BLOCK["p"]).astype(float)])
    for level in range(int(depth.max(initial=0)), 0, -1):
        here = np.flatnonzero(depth == level)
        for row in sums:
            np.add.at(row, parent[here], row[here])
    whole, points, linked, paragraphs = sums
    own_tag = 1 + tag
    up_tag = 1 + len(BLOCKS) + np.where(parent >= 0, tag[parent], 0)
    first = 1 + 2 * len(BLOCKS) + _WORDS
    order = np.arange(n) - base
    numbers = [
        _bin(chars),
        _bin(whole / 16),
        np.minimum(_BINS - 1, (8 * linked / np.maximum(1, whole)).astype(np.int64)),
        _bin(points),
        _bin(paragraphs),
        _bin(1000 * points / np.maximum(1, whole) / 4),
        np.minimum(_BINS - 1, 8 * order // np.maximum(1, np.repeat(sizes, sizes))),
    ]
    every = np.arange(n)
    index = [np.zeros(n, dtype=np.int64), own_tag, up_tag] + [first + k * _BINS + b for k, b in enumerate(numbers)]
    owner = [every] * len(index)
    words = [(start + i, w) for start, p in zip(starts.tolist(), pages, strict=True) for i, ws in enumerate(p.words) for w in ws]
    if words:
        pairs = np.array(words, dtype=np.int64)
        index.append(1 + 2 * len(BLOCKS) + pairs[:, 1])
        owner.append(pairs[:, 0])
    kind = np.select(
        [np.isin(tag, [_BLOCK[t] for t in ("p", "h1", "h2", "h3", "pre", "blockquote")]), np.isin(tag, [_BLOCK[t] for t in ("li", "ul", "ol", "td", "tr")]), np.isin(tag, [_BLOCK[t] for t in ("div", "section", "article", "main")])],
        [0, 1, 2],
        3,
    )
    return parent, depth, kind, np.concatenate(index), np.concatenate(owner)


def sum_product(unary: np.ndarray, pair: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact node marginals, and joint marginals of each node (second) with its parent (first)."""
    n = len(unary)
    below, message = unary.copy(), np.zeros((n, 2))
    levels = [np.flatnonzero(depth == level) for level in range(int(depth.max(initial=0)) + 1)]
    for here in levels[:0:-1]:
        message[here] = np.logaddexp.reduce(below[here][:, None, :] + pair[here], axis=2)
        np.add.at(below, parent[here], message[here])
    full = below.copy()
    joint = np.zeros((n, 2, 2))
    for here in levels[1:]:
        above = full[parent[here]] - message[here]
        table = above[:, :, None] + pair[here]
        full[here] += np.logaddexp.reduce(table, axis=1)
        table = table + below[here][:, None, :]
        joint[here] = np.exp(table - np.logaddexp.reduce(table.reshape(len(here), 4), axis=1)[:, None, None])
    full -= np.logaddexp.reduce(full, axis=1)[:, None]
    return np.exp(full), joint


@dataclass(frozen=True)
class TreeModel:
    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, pages: list[Page]) -> np.ndarray:
        """Probability of content of all nodes of the pages."""
        parent, depth, kind, index, owner = node_features(pages)
        score = np.bincount(owner, self.weights[index], len(parent))
        unary = np.stack([np.zeros(len(parent)), score], axis=1)
        return sum_product(unary, self.pairs[kind], parent, depth)[0][:, 1]


def fit(pages: list[Page], steps: int = 250, rate: float = 0.1, decay: float = 3e-4) -> TreeModel:
    """Weights of greatest conditional likelihood (Adam), with expectations from the messages."""
    parent, depth, kind, index, owner = node_features(pages)
    label = np.array([x for p in pages for x in p.label])
    n, linked = len(parent), np.flatnonzero(parent >= 0)
    theta = [np.zeros(_N_FEATURES), np.zeros((_KINDS, 2, 2))]
    state = [[np.zeros_like(t), np.zeros_like(t)] for t in theta]
    seen = np.zeros((_KINDS, 2, 2))
    np.add.at(seen, (kind[linked], label[parent[linked]], label[linked]), 1)
    for step in range(1, steps + 1):
        score = np.bincount(owner, theta[0][index], n)
        node, joint = sum_product(np.stack([np.zeros(n), score], axis=1), theta[1][kind], parent, depth)
        expected = np.zeros((_KINDS, 2, 2))
        np.add.at(expected, kind[linked], joint[linked])
        grads = [
            np.bincount(index, (node[:, 1] - label)[owner], _N_FEATURES) / len(pages) + decay * theta[0],
            (expected - seen) / len(pages) + decay * theta[1],
        ]
        for t, g, (m, v) in zip(theta, grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            t -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return TreeModel(*theta)


def labelled_pages(n: int = 800, seed: int = 5) -> list[str]:
    """Pages from plans of known parts; content elements carry ``data-content="1"``."""
    rng = random.Random(seed)
    syllables = "an be co du er fi go ha in ka le mo na or pe ra se ti un ve".split()

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high)))

    def sentence() -> str:
        return words(4, 18).capitalize() + rng.choice((".", ".", ".", ",", "?", "!"))

    def prose(low: int = 1, high: int = 6) -> str:
        return " ".join(sentence() for _ in range(rng.randint(low, high)))

    def element(tag: str, inside: str, names: str = "", content: bool = False) -> str:
        kind = rng.choice(("class", "class", "id")) if names else ""
        name = f' {kind}="{rng.choice(names.split())}"' if names and rng.random() < 0.8 else ""
        mark = ' data-content="1"' if content else ""
        end = "" if tag in ("p", "li") and rng.random() < 0.1 else f"</{tag}>"
        return f"<{tag}{name}{mark}>{inside}{end}"

    def links(low: int = 3, high: int = 9, text: tuple[int, int] = (1, 3)) -> str:
        items = (f'<li><a href="/{i}">{words(*text)}</a></li>' for i in range(rng.randint(low, high)))
        return "<ul>" + "".join(items) + "</ul>"

    def furniture() -> str:
        kinds = (
            lambda: element("nav", links(), "menu nav navbar main-menu top-nav breadcrumb"),
            lambda: element("div", links(), "menu nav navigation breadcrumbs pagination tags share social"),
            lambda: element("aside", f"<h3>{words(1, 3)}</h3>" + links(3, 7, (2, 8)), "sidebar related widget"),
            lambda: element("div", f"<h3>{words(1, 3)}</h3>" + rng.choice((links(3, 7, (2, 8)), f"<p>{prose(1, 3)}</p>")), "sidebar side related widget recommended trending more-stories"),
            lambda: element("aside", f"<p>{prose(1, 3)}</p>", "sidebar promo"),
            lambda: element("div", prose(1, 2), "ad ad ad-box ads advert advertisement sponsored promo banner ad-slot"),
            lambda: element("div", element("p", prose(1, 2)), "ad advert sponsored promo"),
            lambda: element("div", element("p", prose(1, 2)) + "<button>ok</button>", "cookie cookies consent notice alert banner gdpr cookie-notice popup modal"),
            lambda: element("section", element("p", prose(1, 2)), "notice consent newsletter subscribe"),
            lambda: f"<table><tr>{''.join(f'<td><a href=/{i}>{words(1, 2)}</a></td>' for i in range(rng.randint(2, 6)))}</tr></table>",
            lambda: element("form", f"<label>{words(1, 3)}</label><input>" + element("p", sentence()) + "<button>go</button>", "search login subscribe newsletter contact"),
        )
        return rng.choice(kinds)()

    def comments() -> str:
        def one() -> str:
            return element(rng.choice(("div", "li", "article")), element("p", prose(1, 3)), "comment reply")

        inside = "".join(one() for _ in range(rng.randint(1, 6)))
        return element(rng.choice(("section", "div")), f"<h3>{words(1, 2)}</h3>" + inside, "comments discussion responses comment-list respond")

    def paragraph() -> str:
        return element("p", rng.choice((sentence, sentence, prose))(), content=True)

    def plain_page() -> str:
        """Text without a heading, a wrapper or names, with little or nothing beside it."""
        some = rng.randint(1, rng.choice((1, 2, 6)))
        head = element("h1", rng.choice((words(1, 4), sentence())), content=True) if rng.random() < 0.4 else ""
        paragraphs = "".join(paragraph() for _ in range(some))
        mark = ""
        kind = rng.random()
        if kind < 0.35:
            text = head + paragraphs
        elif kind < 0.65:
            text = element(rng.choice(("article", "article", "main")), head + paragraphs, content=True)
        elif kind < 0.75:
            note = f' data-content="1"><x-note>{sentence()}</x-note>'
            text = f"<article{note}{paragraphs}</article>"
        else:
            mark, text = ' data-content="1"', head + "<br>".join(sentence() for _ in range(some))
        before = "".join(furniture() for _ in range(rng.choice((0, 1, 1, 2)))) if not mark else ""
        after = rng.choice(("", "", f"<footer>{prose(1, 2)}</footer>")) if before else ""
        return f"<html><body{mark}>{before}{text}{after}</body></html>"

    def article() -> str:
        parts = [element("h1", rng.choice((words(1, 9), sentence())), content=True)] if rng.random() < 0.85 else []
        plain = rng.random() < 0.25
        poor = rng.random() < 0.1
        for _ in range(rng.choice((1, 2, rng.randint(1, 14)))):
            kind = rng.random()
            if poor and kind < 0.86:
                again = " ".join([words(1, 1).capitalize() + rng.choice(("", "", ",", "."))] * rng.randint(2, 200))
                parts.append(element("p", rng.choice((again, words(1, 3).capitalize() + ".")), content=True))
            elif kind < 0.72:
                parts.append(element("p", words(1, rng.choice((5, 30, 150))) if plain else prose(1, 7), content=True))
            elif kind < 0.78:
                parts.append(element("p", f"<b>{sentence()}<br>", content=True))
            elif kind < 0.86:
                parts.append(element("h2", words(2, 6), content=True))
            elif kind < 0.9:
                items = "".join(element("li", sentence(), content=True) for _ in range(rng.randint(2, 5)))
                parts.append(element("ul", items, content=True))
            elif kind < 0.94:
                parts.append(element("blockquote", element("p", prose(1, 2), content=True), content=True))
            elif kind < 0.96:
                cells = "".join(element("td", words(1, 4), content=True) for _ in range(2))
                parts.append(element("table", element("tr", cells, content=True), content=True))
            else:
                parts.append(rng.choice((lambda: element("div", prose(1, 2), "ad advert promo"), furniture))())
        tag = rng.choice(("article", "article", "article", "main", "div", "section"))
        names = "content post entry story article-body post-content main text" if tag in ("div", "section") else ""
        if tag == "div":
            return f'<div class="{rng.choice(names.split())}" data-content="1">' + "".join(parts) + "</div>"
        return element(tag, "".join(parts), names, content=True)

    def one_page() -> str:
        if rng.random() < 0.23:
            return plain_page()
        parts = []
        if rng.random() < 0.6:
            parts.append(element("header", f"<h1>{words(1, 3)}</h1>" * rng.randint(0, 1) + f"<p>{words(2, 6)}</p>", "header masthead site-header top"))
        if rng.random() < 0.7:
            parts.append(element("nav", links(), "menu nav"))
        parts += [furniture() for _ in range(rng.randint(0, 3))]
        parts.append(article())
        if rng.random() < 0.4:
            parts.append(comments())
        parts += [furniture() for _ in range(rng.randint(0, 2))]
        if rng.random() < 0.85:
            foot = rng.choice((f"&copy; {words(1, 3)} &middot; {prose(1, 2)}", links(2, 5), f"<p>{prose(1, 2)}</p>"))
            parts.append(element(rng.choice(("footer", "footer", "div")), foot, "footer legal copyright site-footer bottom"))
        body = "".join(parts)
        if rng.random() < 0.2:
            body = element("div", body, "page wrapper container site")
        return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{body}</body></html>"

    return [one_page() for _ in range(n)]


@lru_cache(maxsize=4)
def trained_model(n: int = 800, seed: int = 5) -> TreeModel:
    return fit([parse(page) for page in labelled_pages(n, seed)])


def main_texts(sources: list[str], model: TreeModel) -> list[str]:
    pages = [parse(s) for s in sources]
    found, at = [], 0
    content = model.marginals(pages) >= 0.5 if any(p.tag for p in pages) else ()
    for page in pages:
        found.append("\n\n".join(text for node, text in page.texts if content[at + node]))
        at += len(page.tag)
    return found


def extract_text(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``url``, ``text`` and ``n_chars``."""
    model = model or trained_model()
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html"), F.col("url"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, block in common.text_blocks([batch], max_rows=256, max_bytes=2 << 20):
                texts = main_texts(block, model)
                part = batch.slice(at, len(block))
                at += len(block)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(texts), pa.array(list(map(len, texts)), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return plain.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
