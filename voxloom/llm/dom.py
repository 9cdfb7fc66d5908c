"""Pages as trees of nodes, and the features of a node.

``parse`` reads a page as it is: tags that HTML closes by themselves, unclosed tags, comments, scripts that hold markup, and
character references without a semicolon. Nodes are the block elements, the parts of forms and inline elements with a class,
id or role; bare inline elements belong to the node around them. Text is kept in pieces (block, node, text): a block is what
stands between two borders of block elements, so inline markup does not cut words, and ``<br>`` is white space.

The work is linear in the length of a page, but for end tags that match nothing near.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# --- fixed values: element names and attribute words, by what they stand for -----------------------------------------

HEADINGS = "h1 h2 h3 h4 h5 h6".split()
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table caption colgroup thead tbody "
    "tfoot tr td th ul button select textarea label input".split() + HEADINGS
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math object".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u span sub sup mark abbr cite q time".split())
#: A start tag of the key closes an open element of the value, up to the nearest border.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"),
    "tfoot": ("tr", "td", "th", "thead", "tbody"),
}
BORDERS = frozenset("table td th caption ul ol dl select button html body".split())
#: What a node is about, by element name or by a word of its class, id or role.
TOPICS = {
    "content": "article main content post entry story body text articlebody prose reading",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs sitemap skip",
    "header": "header masthead banner logo topbar branding",
    "footer": "footer contentinfo copyright legal imprint colophon",
    "side": "aside sidebar complementary widget related recommended recommendations trending popular teaser sticky rail more",
    "ad": "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion promoted commercial banner-ad outbrain taboola",
    "notice": "notice cookie cookies consent gdpr alert dialog modal popup overlay message warning newsletter subscribe subscription paywall announcement toast",
    "form": "form search login signin signup register input contact-form field",
    "comment": "comment comments commentlist reply replies respond disqus discussion feedback reviews",
    "share": "share sharing social follow like likes facebook twitter",
    "meta": "meta byline author date published timestamp tags category categories caption credit",
}
ELEMENT_TOPICS = {
    "article": "content", "main": "content", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side",
    "dialog": "notice", "form": "form", "search": "form", "button": "form", "select": "form", "option": "form", "textarea": "form",
    "label": "form", "input": "form", "fieldset": "form", "legend": "form", "optgroup": "form", "address": "meta", "figcaption": "meta",
}
KINDS = {
    "p": "p", "li": "item", "dt": "item", "dd": "item", "ul": "list", "ol": "list", "dl": "list", "div": "box", "section": "box",
    "blockquote": "quote", "pre": "quote", "figure": "quote", "body": "page", "html": "page", "": "page", "a": "inline", "span": "inline",
} | {h: "heading" for h in HEADINGS} | {t: "table" for t in "table thead tbody tfoot tr td th caption".split()}

TOPIC_NAMES = list(TOPICS)
KIND_NAMES = sorted(set(KINDS.values()))
KIND_INDEX = {tag: KIND_NAMES.index(kind) for tag, kind in KINDS.items()}
EXACT = {word: 1 << k for k, words in enumerate(TOPICS.values()) for word in words.split()}
#: Long words also count inside of run-together names.
INSIDE = [(word, bit) for word, bit in EXACT.items() if len(word) >= 6 and word != "content"]

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</(?![a-zA-Z])[^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>?|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Comments that training pages carry around what is main text.
MAIN_ON, MAIN_OFF = "<!--main-->", "<!--/main-->"


@dataclass
class Page:
    """Nodes in the order of their start tags (0 is the page), and pieces of text in page order."""

    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    topics: list[int] = field(default_factory=lambda: [0])
    depths: list[int] = field(default_factory=lambda: [0])
    inline_tags: list[int] = field(default_factory=lambda: [0])
    link_chars: list[int] = field(default_factory=lambda: [0])
    pieces: list[tuple[int, int, str]] = field(default_factory=list)
    #: per piece whether it is main text, known for training pages only
    marks: list[bool] = field(default_factory=list)


@lru_cache(20_000)
def _topics_of_value(value: str) -> int:
    bits = 0
    for name in value.split():
        lower = name.lower()
        bits |= EXACT.get(lower, 0)
        for part in WORD_PART.findall(name):
            bits |= EXACT.get(part.lower(), 0)
        for word, bit in INSIDE:
            if word in lower:
                bits |= bit
    return bits


def topics_of(attributes: str) -> int:
    bits = 0
    for match in ATTRIBUTE.finditer(attributes):
        bits |= _topics_of_value(match[2] or match[3] or match[4] or "")
    return bits


class _Parser:
    def __init__(self):
        self.page = Page()
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.open: Counter[str] = Counter()
        self.block = 0
        self.main = False

    def _pop(self) -> None:
        tag, _ = self.stack.pop()
        self.open[tag] -= 1
        if tag in BLOCKS:
            self.block += 1

    def _close(self, tags: tuple[str, ...], borders: frozenset[str]) -> None:
        """Close the nearest of ``tags`` with all inside it, unless a border comes first."""
        if not any(self.open[t] > 0 for t in tags):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at][0]
            if tag in tags:
                while len(self.stack) > at:
                    self._pop()
                return
            if tag in borders:
                return

    def start(self, tag: str, attributes: str) -> None:
        page = self.page
        if tag in BLOCKS:
            self._close(("p",), BORDERS)
            if tag in CLOSES:
                self._close(CLOSES[tag], BORDERS - set(CLOSES[tag]))
            self.block += 1
        node = self.stack[-1][1]
        topics = topics_of(attributes) if "=" in attributes else 0
        if tag in BLOCKS or topics:
            page.tags.append(tag)
            page.parents.append(node)
            page.topics.append(topics | EXACT.get(ELEMENT_TOPICS.get(tag, ""), 0))
            page.depths.append(page.depths[node] + 1)
            page.inline_tags.append(0)
            page.link_chars.append(0)
            node = len(page.tags) - 1
        else:
            page.inline_tags[node] += 1
        if tag == "br":
            self.text(" ")
        if tag not in VOID:
            self.stack.append((tag, node))
            self.open[tag] += 1

    def end(self, tag: str) -> None:
        if self.open[tag] <= 0:
            if tag in BLOCKS:
                self.block += 1
            return
        if tag in FORMATTING:
            # a block that is open inside of it stays open
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at][0] == tag:
                    del self.stack[at]
                    self.open[tag] -= 1
                    return
                if self.stack[at][0] in BLOCKS:
                    return
        self._close((tag,), frozenset() if tag in BORDERS else frozenset({"table", "td", "th", "caption"}))

    def text(self, text: str) -> None:
        node = self.stack[-1][1]
        if self.open["a"] > 0:
            self.page.link_chars[node] += len(text)
        self.page.pieces.append((self.block, node, text))
        self.page.marks.append(self.main)


def parse(source: str) -> Page:
    parser, at, size = _Parser(), 0, len(source)
    while at < size:
        match = TOKEN.match(source, at)
        at = match.end()
        token = match[0]
        if match[2] is not None:
            tag = match[2].lower()
            if match[1]:
                parser.end(tag)
            elif tag in RAW:
                found = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                parser.start(tag, match[3])
                if not match[3].rstrip().endswith("/") or tag not in ("svg", "math"):
                    at = found.start() if found else size
                parser.end(tag)
                if found and at == found.start():
                    closing = source.find(">", at)
                    at = size if closing < 0 else closing + 1
            else:
                parser.start(tag, match[3])
        elif token.startswith("<![CDATA["):
            continue
        elif token[0] == "<" and len(token) > 1:
            parser.main = token == MAIN_ON or (parser.main and token != MAIN_OFF)
        elif token:
            parser.text(html.unescape(token) if "&" in token else token)
    return parser.page


NUMBERS = (
    "chars", "own_chars", "link_share", "tags_per_char", "words", "word_length", "marks_per_word", "commas_per_word", "digit_share",
    "page_share", "depth", "children", "position", "sibling_place", "siblings", "sibling_alike", "sibling_chars", "sibling_links",
    "before_chars", "after_chars", "parent_links", "parent_own_chars",
)
FEATURES = (*KIND_NAMES, *[f"own_{t}" for t in TOPIC_NAMES], *[f"above_{t}" for t in TOPIC_NAMES], *NUMBERS)


def own_texts(page: Page) -> list[str]:
    """The text of each node without that of the nodes inside it."""
    parts: list[list[str]] = [[] for _ in page.tags]
    for _, node, text in page.pieces:
        parts[node].append(text)
    return [" ".join("".join(p).split()) for p in parts]


def features(page: Page) -> np.ndarray:
    """A row of ``FEATURES`` per node."""
    n = len(page.tags)
    texts = own_texts(page)
    own = np.zeros((n, 7))  # characters, link characters, tags, words, sentence marks, commas, digits
    for k, text in enumerate(texts):
        own[k, 2] = 1 + page.inline_tags[k]
        if text:
            own[k, 0] = len(text)
            own[k, 1] = min(page.link_chars[k], len(text))
            own[k, 3] = text.count(" ") + 1
            own[k, 4] = text.count(".") + text.count("!") + text.count("?") + text.count("。")
            own[k, 5] = text.count(",") + text.count("，")
            own[k, 6] = sum(map(text.count, "0123456789"))
    total = own.copy()
    children: list[list[int]] = [[] for _ in range(n)]
    above = [0] * n
    for k in range(n - 1, 0, -1):
        total[page.parents[k]] += total[k]
    for k in range(1, n):
        parent = page.parents[k]
        children[parent].append(k)
        above[k] = above[parent] | page.topics[parent]
    before = np.concatenate([[0.0], np.cumsum(own[:, 0])[:-1]])
    whole = max(1.0, float(total[0, 0]))
    chars = np.log1p(total[:, 0])
    links = total[:, 1] / np.maximum(total[:, 0], 1)
    out = np.zeros((n, len(FEATURES)), dtype=np.float32)
    kinds = len(KIND_NAMES)
    topics = len(TOPIC_NAMES)
    out[np.arange(n), [KIND_INDEX.get(tag, KIND_INDEX["div"]) for tag in page.tags]] = 1
    out[:, kinds : kinds + topics] = np.array(page.topics)[:, None] >> np.arange(topics) & 1
    base = kinds + 2 * topics
    out[:, kinds + topics : base] = np.array(above)[:, None] >> np.arange(topics) & 1
    words = np.maximum(total[:, 3], 1)
    size = np.maximum(total[:, 0], 1)
    out[:, base : base + 13] = np.column_stack([
        chars, np.log1p(own[:, 0]), links, np.minimum(total[:, 2] / size, 10), np.log1p(total[:, 3]), np.minimum(size / words, 50),
        total[:, 4] / words, total[:, 5] / words, total[:, 6] / size, total[:, 0] / whole, page.depths, [len(c) for c in children],
        before / whole,
    ])
    for parent, group in enumerate(children):
        if not group:
            continue
        count, sizes = len(group), chars[group]
        names = Counter(page.tags[k] for k in group)
        out[group, base + 13 :] = np.column_stack([
            np.arange(count) / count, np.full(count, math.log1p(count)), [names[page.tags[k]] / count for k in group],
            np.full(count, sizes.mean()), np.full(count, links[group].mean()), np.concatenate([[-1.0], sizes[:-1]]),
            np.concatenate([sizes[1:], [-1.0]]), np.full(count, links[parent]), np.full(count, math.log1p(own[parent, 0])),
        ])
    return out


def node_labels(page: Page) -> np.ndarray:
    """1 for nodes whose text is main text, 0 where it is not, -1 for mixed nodes and nodes without text."""
    n = len(page.tags)
    main, total = np.zeros(n), np.zeros(n)
    for (_, node, text), mark in zip(page.pieces, page.marks):
        size = len(text.strip())
        total[node] += size
        main[node] += size * mark
    for k in range(n - 1, 0, -1):
        total[page.parents[k]] += total[k]
        main[page.parents[k]] += main[k]
    share = main / np.maximum(total, 1)
    return np.where(total == 0, -1, np.where(share > 0.95, 1, np.where(share < 0.05, 0, -1))).astype(np.int8)


def text_of(page: Page, chosen: np.ndarray) -> str:
    """The pieces of the chosen nodes: white space inside a block is one space, blocks are joined by one."""
    blocks: list[str] = []
    at, parts = -1, []
    for block, node, text in page.pieces:
        if not chosen[node]:
            continue
        if block != at and parts:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
        at = block
        parts.append(text)
    blocks.append(" ".join("".join(parts).split()))
    return " ".join(b for b in blocks if b)
