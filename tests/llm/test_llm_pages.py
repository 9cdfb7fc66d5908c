"""HTML extraction: the parser, the trees, the choice over a tree, and pages with a known main text."""

from __future__ import annotations

import html
import itertools
import random
import re

import numpy as np
import pytest

from conftest import SMALL
from voxloom.llm import boosting, dom, extraction
from voxloom.llm.queries import QUERIES


def whole_text(source):
    page = dom.parse(source)
    return dom.text_of(page, np.ones(len(page.tags), dtype=bool))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""), ("plain  words\n here", "plain words here"), ("<p>a<b>b</b>c<p>d", "abc d"), ("a<br>b<br/>c", "a b c"),
        ("<p>x &amp y &lt;z&gt; &eacute; &#233; &unknown; &am</p>", "x & y <z> é é &unknown; &am"),
        ("<script>if (a<b) '</p>'</script>t<style>p{}</style><!-- <p>no</p> -->u", "tu"), ("<!DOCTYPE html><?xml?>t</>u", "tu"),
        ("<ul><li>a<li>b</ul>c", "a b c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<p title='>'>a</p >b", "a b"),
        ("<p class=\"x>y</p>", "y"), ("a < b and c <d", "a < b and c"), ("<div><p>a</div>b</p>c", "a b c"), ("<b><p>a</b>b</p>c", "ab c"),
        ("<title>no</title><textarea><p>no</textarea>yes", "yes"), ("<script>never closed <p>x", ""), ("<!-- never closed <p>x", ""),
        ("<p>a<div>b</div>c", "a b c"), ("<h1>a</h1>b<hr>c", "a b c"), ("<a href=x>a</a><a>b</a>", "ab"), ("</p></div></x>a", "a"),
    ],
)
def test_parser(source, text):
    assert whole_text(source) == text


def test_parser_is_linear():
    for part in ("<div>", "<p>a", "</b>", "<b>", "<a '", "<li>", "<!--", "<td>", "<p class=\"", "&am", "< "):
        dom.features(dom.parse(part * 20_000))


def test_nodes_know_their_topics():
    page = dom.parse('<div class="side-bar cookieNotice"><span id=adsense>x</span><article class="post">y</article></div><span>z</span>')
    names = [{dom.TOPIC_NAMES[t] for t in range(len(dom.TOPIC_NAMES)) if bits >> t & 1} for bits in page.topics]
    assert page.tags == ["", "div", "span", "article"] and page.parents == [-1, 0, 1, 1]
    assert names[1] >= {"notice"} and names[2] == {"ad"} and names[3] == {"content"}
    assert dom.features(page).shape == (4, len(dom.FEATURES))
    assert not set(dom.FEATURES[len(dom.KIND_NAMES) :]) & set(dom.KIND_NAMES)


def test_trees_learn_what_no_line_tells_apart():
    chance = np.random.default_rng(1)
    rows = chance.uniform(-1, 1, (4000, 5)).astype(np.float32)
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.3)).astype(float)
    trees = boosting.boost(rows[:3000], labels[:3000], trees=20)
    assert ((trees.log_odds(rows[3000:]) > 0) == labels[3000:]).mean() > 0.97
    assert np.array_equal(trees.log_odds(rows), boosting.boost(rows[:3000], labels[:3000], trees=20).log_odds(rows))
    one = boosting.boost(rows[:50], np.ones(50))
    assert (one.log_odds(rows) > 0).all()


def test_choice_is_the_best_consistent_one():
    chance = random.Random(4)
    for _ in range(200):
        n = chance.randint(1, 7)
        page = dom.Page(["div"] * n, [-1] + [chance.randint(0, k - 1) for k in range(1, n)], [0] * n, [0] * n, [0] * n, [0] * n)
        page.pieces = [(k, k, "x" * chance.randint(0, 9)) for k in range(n)]
        odds = np.array([chance.uniform(-6, 6) for _ in range(n)])
        weight = np.log1p([0.5 + len(t) for _, _, t in page.pieces]) * np.clip(odds, -extraction.CLIP, extraction.CLIP)
        best = -1e9
        for state in itertools.product((0, 1, 2), repeat=n):
            # outside, main, cut: a state never goes back down a branch, and what is cut was main above
            steps = [(state[page.parents[k]], state[k]) for k in range(1, n)]
            if state[0] < 2 and all(b in {0: (0, 1), 1: (1, 2), 2: (2,)}[a] for a, b in steps):
                best = max(best, sum(w for w, s in zip(weight, state) if s == 1))
        model = extraction.Model(boosting.Trees(1, 0.0, *[np.zeros((0, 1))] * 3))
        chosen = model.choose(page, odds)
        assert weight[chosen].sum() == pytest.approx(best)


def test_articles_of_the_small_table(spark):
    rows = QUERIES["op11_html_extraction"](spark, SMALL).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = [" ".join(html.unescape(x).split()) for x in re.split("<[^>]*>", article)]
        assert r["text"] == " ".join(p for p in parts if p)
        assert (r["url"], r["n_chars"]) == (pages[r["page_id"]]["url"], len(r["text"]))


def test_layouts_that_the_model_has_not_seen(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = extraction.fit(pages)
    chance = random.Random(17)
    sentences = [" ".join(f"word{chance.randint(1, 400)}" for _ in range(chance.randint(3, 60))) + "." for _ in range(300)]
    total = missed = extra = 0
    for _ in range(150):
        page = dom.parse(extraction.layout(sentences, chance))
        chosen = model.choose(page, model.trees.log_odds(dom.features(page)))
        for (_, node, text), main in zip(page.pieces, page.marks):
            size = len(text.strip())
            total += size
            missed += size * (main and not chosen[node])
            extra += size * (chosen[node] and not main)
    assert missed <= 0.01 * total and extra <= 0.02 * total


MIXED = """<html><body><header><h1>Site name</h1><nav><a href=/>Home</a> <a href=/n>News</a></nav></header>
<div class="cookie-notice">We use cookies to make this site better for you, please say yes.</div>
<div class="content"><h1>How the river came back</h1><p>For years the river had been dry, and few had hoped to see it again.</p>
<div class="advert">Buy two lamps and get a third one for nothing, this week only.</div>
<p>Then, one night in <b>May</b>, it rained &amp; rained.<br>It did not stop.</p><form><label>Your mail</label><input><button>Send</button></form>
<p>The end.</p></div><aside class="sidebar"><p>More stories that you may like to read when you have the time for it.</p></aside>
<section id="comments"><div class="comment"><p>I was there as well and it was quite a night for all of us.</p></div></section>
<footer>&copy; the paper, all rights reserved.</footer></body></html>"""
MAIN = (
    "How the river came back For years the river had been dry, and few had hoped to see it again. Then, one night in May, it rained & "
    "rained. It did not stop. The end."
)


def test_a_page_with_every_kind_of_side_part(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, k string, rows string"
    small = spark.read.parquet(f"{SMALL}/pages.parquet").selectExpr("page_id", "url", "html")
    rows = [(-1, "a", MIXED), (-2, None, None), (-3, "c", ""), (-4, "d", " <p> "), (-5, "e", "<nav>a b</nav>"), (-1, "a", MIXED), (None, "f", MIXED)]
    odd = spark.createDataFrame([(*r, "t", "n", "k", "r") for r in rows], schema)
    got = extraction.extract(small.unionByName(odd, allowMissingColumns=True), into="text").where("page_id < 0 or page_id is null").collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got) == sorted([(-1, MAIN), (-1, MAIN), (0, MAIN), (-2, ""), (-3, ""), (-4, ""), (-5, "")])
    assert {r["k"] for r in got} == {"k"}
    assert extraction.query(small.limit(0)).collect() == []
    alone = extraction.query(odd.where("page_id in (-2, -3)")).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in alone) == [(-3, "", 0), (-2, "", 0)]


def test_a_very_long_page(spark):
    paragraphs = "".join(f"<p>Paragraph {k} tells of day {k}, and of little else.</p>" for k in range(20_000))
    page = f"<body><nav><a href=/>Home</a></nav><article>{paragraphs}</article><footer>end</footer></body>"
    small = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html")
    long = spark.createDataFrame([(-1, "x", page)], small.schema)
    row = extraction.query(small.unionByName(long)).where("page_id = -1").first()
    assert row["text"] == " ".join(f"Paragraph {k} tells of day {k}, and of little else." for k in range(20_000))
