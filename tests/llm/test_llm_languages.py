"""Character language models against Kneser-Ney by definition, and the two ways of scoring against each other."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from voxloom.llm import langid

TEXTS = [
    ("Abcab abd, cab!", "x"), ("abba  bab 7 abba", "x"), ("ba", "x"), ("zzyx yxz zyx", "y"), ("xyz xyz", "y"), ("a", "z"),
]


def letters_of(text):
    """Lower-case letters, one blank behind each run of them where something follows."""
    out = []
    for c in text:
        if c.isalpha():
            out.append(c.lower())
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out)


class Plain:
    """Interpolated Kneser-Ney by definition: counts of four characters, distinct predecessors below."""

    def __init__(self, texts):
        four = defaultdict(int)
        for text in texts:
            line = "   " + letters_of(text)
            for k in range(3, len(line)):
                four[line[k - 3 : k + 1]] += 1
        self.counts = {4: dict(four)}
        for order in (3, 2, 1):
            kinds = defaultdict(set)
            for gram in self.counts[order + 1]:
                kinds[gram[1:]].add(gram[0])
            self.counts[order] = {g: len(v) for g, v in kinds.items()}
        self.discounts = {}
        for order, counts in self.counts.items():
            once, twice = (sum(v == n for v in counts.values()) for n in (1, 2))
            self.discounts[order] = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def probability(self, gram):
        order = len(gram)
        if not order:
            return 1 / 65536
        below = self.probability(gram[1:])
        after = [n for g, n in self.counts[order].items() if g[:-1] == gram[:-1]]
        if not after:
            return below
        d = self.discounts[order]
        return (max(self.counts[order].get(gram, 0) - d, 0) + d * len(after) * below) / sum(after)


def packed(gram):
    return sum(ord(c) << 16 * (3 - k) for k, c in enumerate(gram))


def test_every_probability_is_that_of_the_definition(spark):
    rows = spark.createDataFrame(TEXTS, "text string, lang string")
    counts = langid.Counts(rows, "text", "lang", F.lit(False))
    model = counts.model()
    assert model.languages == ["x", "y", "z"]
    plain = {lang: Plain([t for t, name in TEXTS if name == lang]) for lang in model.languages}
    chance = random.Random(3)
    grams = sorted({"".join(chance.choice(" abcdxyzq") for _ in range(4)) for _ in range(400)} | {g for p in plain.values() for g in p.counts[4]})
    keys = np.array([packed(g) for g in grams], dtype=np.uint64)
    expected = {(lang, g): plain[lang].probability(g) for lang in model.languages for g in grams}
    for number, lang in enumerate(model.languages):
        found = np.exp(model.log_probability(keys, number).astype(float))
        assert found == pytest.approx([expected[lang, g] for g in grams], rel=1e-4)
    wanted = spark.createDataFrame(
        [(lang, int(k)) for lang in model.languages for k in keys.view(np.int64)], "lang string, seq long"
    )
    joined = {(r["lang"], r["seq"]): r["p"] for r in counts.probabilities(wanted).collect()}
    assert len(joined) == len(expected)
    for (lang, gram), p in expected.items():
        assert joined[lang, packed(gram)] == pytest.approx(p, rel=1e-9)


def test_hashes_of_different_sequences_differ():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 300_000).astype(np.uint64)
    assert len(np.unique(langid.hashed(np.unique(keys)))) == len(np.unique(keys))


def test_models_of_any_size_score_alike(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(None, "und so", "de"), (5, None, "en"), (5, "", None), (7, "12 !", "en")], docs.schema)
    # repeated rows, null keys and texts without letters too
    docs = docs.unionAll(docs.where("doc_id < 5")).unionAll(odd)
    whole = langid.identify(docs)
    parts = langid.identify(docs, cells=0)
    keyed = lambda rows: sorted((str(r["doc_id"]), r["lang_pred"], r["held_out"], r["accepted"], round(r["score"], 3), round(r["entropy"] or 0, 3)) for r in rows)
    assert keyed(parts.collect()) == keyed(whole.collect())


@pytest.mark.parametrize("piece", [1, 3, 7, 50])
def test_pieces_change_nothing(monkeypatch, piece):
    chance = random.Random(5)
    texts = ["".join(chance.choice("abÄ  \n.9") for _ in range(n)) for n in (0, 1, 2, 5, 40, 90)]
    letters = langid.Letters()
    expected = [letters.sequences([t])[0].tolist() for t in texts]
    monkeypatch.setattr(langid, "PIECE", piece)
    found = [[] for _ in texts]
    for numbers, pieces, before in langid._pieces(enumerate(texts)):
        keys, sizes = letters.sequences(pieces, before)
        for number, part in zip(numbers, np.split(keys, np.cumsum(sizes)[:-1])):
            found[number] += part.tolist()
    assert found == expected


def test_rejection_is_measured_on_texts_that_were_not_counted(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(10**9, "qzx wvk jjq xxz " * 20, None)], docs.schema)
    rows = langid.identify(docs.unionAll(strange)).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] != 10**9]
    assert sum(r["accepted"] for r in held) >= 0.95 * len(held)
    assert not next(r for r in rows if r["doc_id"] == 10**9)["accepted"]


def test_a_language_of_a_single_text_is_learnt(spark):
    rows = spark.createDataFrame([(k, "wort und tat " * 3, f"l{k}") for k in range(1, 30)], "doc_id long, text string, lang string")
    found = langid.identify(rows).collect()
    assert len(found) == 29 and all(r["lang_pred"].startswith("l") and r["accepted"] for r in found)
