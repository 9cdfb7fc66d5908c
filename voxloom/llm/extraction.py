"""Main text of web pages: boosted trees over the nodes of a page, and one choice for the whole tree.

A page becomes a tree of nodes (``dom``). Gradient-boosted trees give each node the log odds that its text is main text, from
the density of text, links and tags under it, the words of its attributes and of those above it, its depth and its
siblings. The nodes are then decided together: going down a branch a node is outside, main or cut, a main part may begin once
and what is cut stays cut, so no node under a cut one comes back and no ancestor contradicts its descendants. The choice with
the largest sum of log odds, weighted by the node's own text, is found in one pass from the leaves.

The tables hold no labels. The model is fitted on at most ``SAMPLE`` pages of at most ``SAMPLE_CHARS`` characters, the smallest
by hash: their texts are set into invented layouts, in which the place of the main text is known, with menus, headers,
footers, sidebars, notices, adverts, forms and reader comments around and inside of it, under telling and under bare names;
and the pages themselves take part where an ``article`` or ``main`` element tells. The rows of the sample (numbers only) come
to the driver, which fits the trees; every page is then extracted whole in one pass, without a shuffle.

Defined results: null and empty pages and pages without main text give an empty text. Repeated pages give equal texts.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.boosting import Trees, boost
from voxloom.llm.dom import FEATURES, MAIN_OFF, MAIN_ON, TOPIC_NAMES, Page, features, node_labels, parse, text_of

SAMPLE, SAMPLE_CHARS, LAYOUTS = 240, 100_000, 5
#: Pages whose nodes are scored at once.
GROUP = 64
CLIP = 4.0

#: Names that layouts give to main parts and to the parts around them.
MAIN_NAMES = (
    "article", "main", "article", 'div class="content"', 'div id="main-content"', 'div class="post-body entry"', 'section class="story"',
    'div class="article__text"', "div", "section", 'div class="text"', 'div itemprop="articleBody"',
)
NAMES = {
    "nav": ("nav", 'div class="menu"', 'div id="navigation"', 'ul class="nav-list"', 'div class="breadcrumbs"', 'div role="navigation"'),
    "header": ("header", 'div class="header"', 'div id="masthead"', 'div class="top-banner"', 'div role="banner"'),
    "footer": ("footer", 'div class="footer"', 'div id="site-footer"', 'section class="copyright legal"', 'div role="contentinfo"'),
    "side": ("aside", 'div class="sidebar"', 'div id="right-sidebar"', 'section class="related"', 'div class="widget recommended"'),
    "ad": ('div class="ad"', 'div class="ads"', 'div id="advertisement"', 'p class="sponsored"', 'section class="promo"', 'aside class="ad-slot"'),
    "notice": (
        'div class="cookie-notice"', 'div id="consent"', 'div role="alert"', 'div class="notice"', 'p class="notice"', 'div class="newsletter"',
        "dialog", 'div class="popup-message"',
    ),
    "form": ("form", 'form class="search"', 'div class="login-form"', 'form id="contact"'),
    "comment": (
        'section id="comments"', 'div class="comments"', 'ol class="comment-list"', 'div id="disqus_thread"', 'div class="reader-comments"',
        'section class="discussion"',
    ),
    "share": ('div class="share"', 'ul class="social-links"', 'p class="follow-us"'),
    "meta": ('div class="byline"', 'p class="meta"', 'div class="tags"'),
}
FILLER = "the page has some words of its own and they stand here in a row. "


def _closed(name: str, inside: str) -> str:
    return f"<{name}>{inside}</{name.split(' ')[0]}>"


def layout(prose: list[str], chance: random.Random) -> str:
    """An invented page around texts of a real one; marks tell where its main text begins and ends."""
    line = lambda: chance.choice(prose)
    short = lambda most: " ".join(line().split()[: chance.randint(1, most)])
    inline = lambda text: text if chance.random() < 0.7 else f'{text[: len(text) // 2]}<{chance.choice(["b", "i", "em", "span"])}>{text[len(text) // 2 :]}'

    def links(count: int) -> str:
        form = chance.choice(("<li><a href='/x'>{}</a></li>", "<a href='/x'>{}</a> ", "<p><a href='/x'>{}</a></p>"))
        made = "".join(form.format(short(3)) for _ in range(count))
        return f"<ul>{made}</ul>" if form.startswith("<li") else made

    def words(kind: str) -> str:
        """What such a part holds; all kinds but menus may hold prose as well."""
        if kind in ("nav", "share") or kind in ("footer", "side", "header") and chance.random() < 0.5:
            return links(chance.randint(2, 9))
        if kind == "form":
            fields = "".join(f"<label>{short(3)}</label><input name='q'>" for _ in range(chance.randint(1, 3)))
            return f"<p>{short(8)}</p>{fields}<button>{short(2)}</button>"
        if kind == "comment":
            one = lambda: f'<{chance.choice(("p", "div", "li"))}>{short(3)}</p><p>{line()}</p>'
            each = chance.choice(('<div class="comment">{}</div>', '<li class="comment-item">{}</li>', "<article>{}</article>", "<div>{}</div>"))
            return "".join(each.format(one()) for _ in range(chance.randint(1, 4)))
        if kind == "header":
            return f"<h1>{short(4)}</h1><p>{short(8)}</p>"
        if kind == "meta":
            return short(6)
        text = line() if chance.random() < 0.5 else short(14)
        return text if chance.random() < 0.6 else f"<h3>{short(4)}</h3><p>{text}</p>"

    def part(kind: str) -> str:
        return _closed(chance.choice(NAMES[kind]), words(kind))

    def paragraph() -> str:
        text = inline(line() if chance.random() < 0.75 else short(3))
        form = chance.random()
        if form < 0.07:
            return "<ul>" + "".join(f"<li>{short(20)}</li>" for _ in range(chance.randint(2, 5))) + "</ul>"
        if form < 0.12:
            return f"<h2>{short(6)}</h2>"
        if form < 0.16:
            return f"<blockquote>{text}</blockquote>"
        if form < 0.19:
            return f"<table><tr><td>{short(4)}</td><td>{short(4)}</td></tr></table>"
        if form < 0.24:
            return f'<p>{text} <a href="/y">{short(4)}</a> {short(9)}</p>'
        if form < 0.32:
            return f"<p><b>{text}<br>"
        if form < 0.38:
            return f"<div>{text}</div>"
        return f"<p>{text}</p>" if chance.random() < 0.8 else f"<p>{text}"

    body = [f"<h1>{short(12)}</h1>" if chance.random() < 0.8 else ""]
    body += [paragraph() for _ in range(chance.randint(1, 14))]
    for _ in range(chance.choice((0, 0, 1, 2))):
        off = part(chance.choice(("ad", "share", "side", "form", "notice", "meta", "nav", "comment", "header", "footer")))
        body.insert(chance.randint(1, len(body)), f"{MAIN_OFF}{off}{MAIN_ON}")
    main = _closed(chance.choice(MAIN_NAMES), MAIN_ON + "".join(body) + MAIN_OFF)
    front = [part(k) for k in chance.sample(("nav", "header", "ad", "notice", "form", "share", "side"), chance.randint(1, 4))]
    back = [part(k) for k in chance.sample(("comment", "side", "ad", "footer", "notice", "form", "nav"), chance.randint(1, 4))]
    whole = "".join(front) + main + "".join(back)
    for _ in range(chance.choice((0, 0, 1, 2))):
        whole = _closed(chance.choice(("div", 'div class="container"', 'div id="page"', 'div class="wrapper row"')), whole)
    return f"<html><head><title>{short(5)}</title></head><body>{whole}</body></html>"


_NOT_MAIN = sum(1 << k for k, name in enumerate(TOPIC_NAMES) if name != "content")


def _own_marks(page: Page) -> bool:
    """Marks the text of a real page by its ``article`` or ``main`` element; false where it has none."""
    above = [False] * len(page.tags)
    for k in range(1, len(page.tags)):
        inside = above[page.parents[k]] or page.tags[k] in ("article", "main")
        above[k] = inside and not page.topics[k] & _NOT_MAIN
    page.marks = [above[node] for _, node, _ in page.pieces]
    return any(t in ("article", "main") for t in page.tags)


def examples(source: str, layouts: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of a page and of the layouts around its texts."""
    page = parse(source)
    told = _own_marks(page)
    whole: dict[int, list[str]] = {}
    for (block, _, text), main in zip(page.pieces, page.marks):
        if main or not told:
            whole.setdefault(block, []).append(text)
    texts = [" ".join("".join(p).split()) for p in whole.values()]
    escape = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    prose = [escape(t) for t in texts if t] or [FILLER * 3]
    pages = [page] if told else []
    chance = random.Random(seed)
    pages += [parse(layout(prose, chance)) for _ in range(layouts)]
    rows, labels = [], []
    for one in pages:
        label = node_labels(one)
        rows.append(features(one)[label >= 0])
        labels.append(label[label >= 0])
    return np.concatenate(rows), np.concatenate(labels)


@dataclass
class Model:
    trees: Trees

    def choose(self, page: Page, odds: np.ndarray) -> np.ndarray:
        """Which nodes are main text, by the best consistent choice for the whole tree."""
        n = len(page.tags)
        weight = np.full(n, 0.5)
        for _, node, text in page.pieces:
            weight[node] += len(text.strip())
        gain = (np.log1p(weight) * np.clip(odds, -CLIP, CLIP)).tolist()
        as_main, as_outside = gain, [0.0] * n
        parents = page.parents
        for k in range(n - 1, 0, -1):
            parent = parents[k]
            as_main[parent] += max(as_main[k], 0.0)  # a child of a main node is main or cut
            as_outside[parent] += max(as_main[k], as_outside[k])
        state = [1 if as_main[0] > as_outside[0] else 0] + [0] * (n - 1)
        for k in range(1, n):
            above = state[parents[k]]
            if above == 1:
                state[k] = 1 if as_main[k] > 0 else 2
            elif above == 0:
                state[k] = 1 if as_main[k] > as_outside[k] else 0
            else:
                state[k] = 2
        return np.array(state) == 1

    def texts(self, sources: list[str | None]) -> list[str]:
        pages = [parse(s or "") for s in sources]
        if not pages:
            return []
        rows = [features(p) for p in pages]
        odds = np.split(self.trees.log_odds(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
        return [text_of(p, self.choose(p, o)) for p, o in zip(pages, odds)]


def fit(pages: DataFrame, html: str = "html", sample: int = SAMPLE, layouts: int = LAYOUTS) -> Model:
    """The model from a bounded sample of distinct pages; of each, numbers only come to the driver."""
    source = F.col(html).cast("string")
    chosen = (
        pages.select(source.alias("h")).where(F.length("h").between(1, SAMPLE_CHARS)).select(F.xxhash64("h").alias("k"), "h")
        .orderBy("k", "h").limit(sample).dropDuplicates(["k"])
    )

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text in zip(batch["k"], batch["h"]):
                rows, labels = examples(text, layouts, int(key))
                out.append((int(key), rows.astype("<f4").tobytes(), labels.astype("i1").tobytes()))
            yield pd.DataFrame(out, columns=["k", "rows", "labels"])

    found = sorted(chosen.repartition(8, "k").mapInPandas(numbers, "k bigint, rows binary, labels binary").collect())
    if not found:
        rows, labels = examples("", 40, 1)
    else:
        rows = np.concatenate([np.frombuffer(r["rows"], "<f4").reshape(-1, len(FEATURES)) for r in found])
        labels = np.concatenate([np.frombuffer(r["labels"], "i1") for r in found])
    return Model(boost(rows, labels.astype(float)))


def main_text(spark: SparkSession, html: Column, model: Model) -> Column:
    """The main text of pages; only the page itself goes to the worker."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for batch in batches:
            sources = batch.tolist()
            texts: list[str] = []
            for at in range(0, len(sources), GROUP):
                texts += known.texts(sources[at : at + GROUP])
            yield pd.Series(texts, dtype="str")

    return F.pandas_udf(run, "string")(html.cast("string"))


def extract(pages: DataFrame, html: str = "html", into: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The table with the main text of every page in ``into``."""
    return pages.withColumn(into, main_text(pages.sparkSession, F.col(html), fit(pages, html, sample)))


# --- the query -------------------------------------------------------------------------------------------------------


def query(pages: DataFrame) -> DataFrame:
    rows = extract(pages.select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
