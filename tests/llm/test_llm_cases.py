"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names; and each method against a plain version."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxloom import session
from voxloom.llm import decontaminate, jaccard, langid, licenses, linededup, packing, quality, rules, sharding, toxicity
from voxloom.llm.components import components

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k % 997}" for k in range(60_000))
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t\n ", "en", "a", 5), (4, "one", None, "b", 3),
    (5, "same text here\nand two\nand three\nand four", "en", "a", 1), (6, "same text here\nand two\nand three\nand four", "en", "a", 1),
    (6, "same text here\nand two\nand three\nand four", "en", "a", 1), (7, LONG, "en", "a", 9), (None, "no id at all", "en", "a", 3),
    (8, "!!! ??? 123", "en", "a", 3), (9, "emoji \U0001f600 and 中文", "zh", "a", 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def label_rows(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality long, toxic long")


def benchmark_rows(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def operators(spark):
    labels = label_rows(spark, [(4, 1, 0), (5, 0, 1), (6, 1, 0), (7, 1, None), (None, 1, 1)])
    items = benchmark_rows(spark, [(1, "same text here and two and three and four"), (2, None), (3, "short")])
    return {
        "op1": lambda d: quality.query(d, labels), "op2": licenses.query, "op3": langid.query, "op4": linededup.query,
        "op5": lambda d: toxicity.query(d, labels), "op6": lambda d: decontaminate.query(d, items), "op7": sharding.query,
        "op9": rules.query, "op10": jaccard.query,
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op9", "op10"])
def test_odd_rows_and_empty_tables(spark, odd, none, name):
    query = operators(spark)[name]
    rows = query(odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ODD)
    assert query(none).collect() == []


def test_odd_values(spark, odd):
    at = {r["doc_id"]: r for r in langid.query(odd).collect()}
    assert [at[k]["lang_pred"] for k in (1, 2, 3, 8)] == ["und"] * 4 and at[4]["lang_pred"] in ("en", "zh")
    lines = {r["doc_id"]: r for r in linededup.query(odd).collect()}
    assert (lines[1]["text"], lines[2]["text"], lines[5]["n_removed"]) == (None, "", 0)
    assert (lines[6]["text"], lines[6]["n_removed"]) == ("", 4)
    leaks = {r["doc_id"]: r for r in decontaminate.query(odd, benchmark_rows(spark, [(4, "SAME text, here and two and three and four")])).collect()}
    assert [k for k in leaks if leaks[k]["contaminated"]] == [5, 6]
    assert not any(r["contaminated"] for r in decontaminate.query(odd, benchmark_rows(spark)).collect())
    same = {r["doc_id"]: r for r in jaccard.query(odd).collect()}
    assert (same[5]["component_id"], same[6]["component_id"], same[None]["component_id"]) == (5, 5, None)
    assert [same[k]["n_shingles"] for k in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert len({same[k]["component_id"] for k in (1, 2, 3)}) == 3
    words = {r["doc_id"]: r for r in rules.query(odd).collect()}
    assert (words[1]["n_words"], words[3]["n_words"], words[7]["n_words"]) == (0, 0, 60_000)
    assert words[7]["n_repeat_words"] == 60_000 and words[1]["base_failed"]


def test_packing_odd_rows(spark, odd, none):
    rows = packing.pack(odd, TOKENIZER).collect()
    assert sum(r["doc_tokens"] for r in rows if r["start"] == 0) == sum(r["length"] for r in rows)
    assert {r["doc_id"] for r in rows} == {r[0] for r in ODD}
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    assert packing.pack(none, TOKENIZER).collect() == []


# --- 2, 6: scans ------------------------------------------------------------------------------------------------------


def test_licence_places(spark):
    texts = [
        "CC BY cc-by (Cc by)", "all rights reserved all rights reserved", "licensed under the GNU General Public License, version 3",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "rights reserved all", "mit",
    ]
    rows = licenses.query(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["n_base"] for r in rows] == [3, 2, 1, 0, 0, 0]
    assert [(r["first_word"], r["last_word"]) for r in rows[:3]] == [(0, 4), (0, 3), (4, 4)]
    assert [r["labels"] for r in rows] == ["cc-by", "reserved", "gpl,gpl-3.0", "mit", "", ""]
    assert rows[3]["score"] == 1.0 and rows[5]["score"] == 0.0


def test_licence_paragraphs_with_changed_words(spark):
    mit = next(t for t in licenses.TEMPLATES if t.label == "mit" and len(t.words) > 60)
    words = mit.words
    texts = [
        "Notice. " + mit.text.capitalize() + " end",
        " ".join(words[:30] + ["really"] + words[30:]),  # a word put in
        " ".join(words[:40] + words[43:]),  # three left out
        " ".join("other" if i in (17, 45) else w for i, w in enumerate(words)),  # two replaced
        " ".join(words[4:]),  # the first phrase is missing
        " ".join(sorted(words)),  # the words without their order
    ]
    rows = licenses.query(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert ["mit" in r["labels"].split(",") for r in rows] == [True, True, True, True, False, False]
    assert rows[0]["score"] == 1.0 and all(r["n_base"] == 0 for r in rows)


def test_licence_templates_of_other_words(spark):
    own = [licenses.notice("house", "this recording may be played at home but not sold or lent to strangers", "played at home")]
    texts = ["x This recording may be played at home, but not sold or lent to strangers", "this recording may be sold", "mit license", "", None]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), templates=own).orderBy("id").collect()
    assert [[(f["t"], f["s"]) for f in r["found"]] for r in rows] == [[(0, 1)], [], [], [], []]


@pytest.mark.parametrize(("stretch", "wrong"), [(13, 2), (12, 2), (11, 1), (10, 1), (9, 1), (8, 0)])
def test_masks_leave_no_gap(stretch, wrong):
    for bad in itertools.combinations(range(stretch), wrong):
        assert any(
            not {at + c for c in mask} & set(bad) for mask in decontaminate.MASKS for at in range(stretch - decontaminate.SPAN + 1)
        )


def test_leaks_equal_all_stretches(spark):
    chance = random.Random(5)
    words = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(chance.choices(words, k=chance.randint(6, 20)))) for k in range(15)]
    texts = []
    for k in range(60):
        own = chance.choices(words, k=chance.randint(0, 30))
        item = items[chance.randrange(15)][1].split()
        for place in chance.sample(range(len(item)), chance.randint(0, 4)):
            item[place] = "other"
        at = chance.randint(0, len(own))
        texts.append((k, " ".join(own[:at] + item + own[at:])))

    def leaks(text, item):
        n = min(13, len(item))
        if len(item) < 8:
            return False
        spare = 0 if n < 9 else n // 6
        return any(
            sum(a == b for a, b in zip(text[i : i + n], item[j : j + n])) >= n - spare
            for j in range(len(item) - n + 1) for i in range(len(text) - n + 1)
        )

    want = {(k, i) for k, t in texts for i, x in items if leaks(t.split(), x.split())}
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), benchmark_rows(spark, items)
    for block in (200_000, 20):
        found = decontaminate.leaks(docs, "doc_id", "text", bench, "item_id", "text", block).collect()
        assert {(r["key"], r["item"]) for r in found} == want and want


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "Who wrote Emma?"), (2, "yes"), (3, "who wrote"), (4, "\u4f60\u597d"), (5, "?!"), (6, "a b c d e f g"), (7, "who WROTE emma")]
    texts = [
        (1, "So: who wrote Emma"), (2, "who wrote it, emma"), (3, "a b c d e f h"), (4, "x \u4f60\u597d. y"), (5, ""), (6, None),
        (7, "Yes"), (8, "a b c d e f g"), (9, "wrote who"), (None, "oh yes"),
    ]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), benchmark_rows(spark, items)
    want = {1: [1, 3], 2: [3], 4: [4], 7: [2], 8: [6], None: [2]}
    for block in (200_000, 2):
        got = decontaminate.find_leaks(docs, bench, block=block).collect()
        assert {r["doc_id"]: [int(i) for i in r["items"]] for r in got if r["contaminated"]} == want
        left = decontaminate.drop_leaks(docs, bench, block=block).collect()
        assert {r["doc_id"] for r in left} == {3, 5, 6, 9}


# --- 4: lines ---------------------------------------------------------------------------------------------------------


def test_lines_equal_plain_version(spark):
    chance = random.Random(2)
    rows = [(k, "\n".join(chance.choices(["a", "b", "c", ""], k=chance.randint(1, 9)))) for k in range(80)]
    seen, want = set(), {}
    for k, text in rows:
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            gone |= {i, i + 1, i + 2} if window in seen else set()
            seen.add(window)
        want[k] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in got} == want


def test_passages_inside_paragraphs(spark):
    """A passage that starts and ends mid-paragraph goes, what ends the units stays, and lines are seen as well."""
    passage = "It rained all day! Nobody came. Was it late? "
    rows = [
        (1, f"Own start. {passage}Own end."), (2, f"Other start. {passage}Other end.\nLast line"), (3, "It rained all day! Nobody came. "),
        (4, "one\n\ntwo\n"), (5, "top\none\n\ntwo\nend"), (6, None), (7, ""), (8, passage.strip()),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in linededup.passage_query(docs).collect()}
    assert {k: (r["text"], r["n_removed"]) for k, r in got.items()} == {
        1: (rows[0][1], 0), 2: ("Other start. Other end.\nLast line", 3), 3: (rows[2][1], 0), 4: (rows[3][1], 0),
        5: ("top\nend", 3), 6: (None, 0), 7: ("", 0), 8: ("", 3),
    }
    assert all(r["n_removed"] == 0 for r in linededup.query(docs).collect() if r["doc_id"] in (2, 8))
    clean = corpus_pipeline.remove_repeated_lines(spark, docs, "")
    assert {r["doc_id"] for r in clean.collect()} == {1, 2, 3, 4, 5, 6, 7}


# --- 1, 3, 5: models --------------------------------------------------------------------------------------------------


def test_discriminant_equals_plain_density():
    chance = np.random.default_rng(3)
    d = len(quality.STATISTICS)
    rows = {c: chance.normal(c, 1 + c, (200, d)) for c in (0, 1)}
    model = quality.Discriminant({c: (200.0, x.sum(axis=0), x.T @ x) for c, x in rows.items()})
    spread = {c: np.cov(x.T, bias=True) for c, x in rows.items()}
    pooled, x = (spread[0] + spread[1]) / 2, chance.normal(0.5, 1, (5, d))
    density = {}
    for c in (0, 1):
        cov = (1 - quality.POOLED) * spread[c] + quality.POOLED * pooled
        cov = (1 - quality.DIAGONAL) * cov + quality.DIAGONAL * np.diag(np.diag(cov)) + quality.FLOOR * np.eye(d)
        away = x - rows[c].mean(axis=0)
        density[c] = -0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
    assert np.allclose(model.score(x), 1 / (1 + np.exp(density[0] - density[1])))
    assert quality.Discriminant({}).score(x).tolist() == [0.5] * 5


def test_segments_equal_plain_version():
    def plain(scores):
        """Maximal segments by definition: take the best of the whole, then of what lies left and right of it."""
        best = max(
            ((sum(scores[i:j]), i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,)
        )
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return [*plain(scores[:i]), (i, j - i, best[0]), *[(a + j, n, s) for a, n, s in plain(scores[j:])]]

    chance = random.Random(4)
    for _ in range(300):
        scores = [chance.choice([-1, -1, 3, 5, 7]) + chance.random() / 1000 * 0 for _ in range(chance.randint(0, 14))]
        scores = [s if s > 0 else -2.25 for s in scores]
        places = [(i, float(s)) for i, s in enumerate(scores) if s > 0]
        found = toxicity.segments(places, -2.25)
        assert sum(s for _, _, s in found) == pytest.approx(sum(s for _, _, s in plain(scores)))
        assert max((s for *_, s in found), default=0) == pytest.approx(max((s for *_, s in plain(scores)), default=0))


def test_kneser_ney_sums_to_one(spark):
    rows = spark.createDataFrame([("abcab abd", "x"), ("abba bab", "x"), ("zzyx", "y")], "text string, lang string")
    model = langid.train(rows, "text", "lang")
    letters = [32, *map(ord, "abcdxyz")]
    for context in ("abc", "zzz", "qqq", "  a"):
        keys = np.array([sum(ord(c) << 16 * (3 - k) for k, c in enumerate(context)) + x for x in range(1, 1 << 16)], dtype=np.uint64)
        for language in (0, 1):
            assert np.exp(model.log_probability(keys, language).astype(float)).sum() == pytest.approx(1, abs=2e-3)
    assert letters and model.languages == ["x", "y"]


# --- 7, 8: shards and packing -----------------------------------------------------------------------------------------


def test_shards_with_a_hot_key(spark):
    rows = spark.createDataFrame([(7 if k % 3 else k, "x" * (k % 11), k) for k in range(400)], "doc_id long, text string, shard long")
    found = sharding.shard_by_bytes(rows, 8).collect()
    assert len(found) == 400
    sizes = {}
    for r in sorted(found, key=lambda r: (r["shard"], r["slot"])):
        sizes.setdefault(r["shard"], []).append(r)
    totals = [sum(r["size"] for r in part) for part in sizes.values()]
    assert len(totals) == 8 and max(totals) - min(totals) <= 24
    assert all([r["slot"] for r in part] == list(range(len(part))) for part in sizes.values())


def test_packer_holds_all_limits():
    chance = random.Random(6)
    limits = packing.Limits(tokens=100, segments=4, loss=60)
    packer, want, sequences = packing.Packer(limits, open=5), {}, []
    for k in range(400):
        n = chance.choice([1, 2, 5, 30, 99, 250])
        prompt = chance.randint(0, n)
        want[k] = n
        sequences += list(packer.add(packing.Piece(k, bytes(4 * n), prompt, 0, n)))
    sequences += list(packer.finish())
    got = {}
    for pieces in sequences:
        assert sum(p.length for p in pieces) <= 100 and len(pieces) <= 4
        assert sum(p.loss(p.length) for p in pieces) <= 60
        for p in pieces:
            got.setdefault(p.doc, []).append((p.start, p.length))
    for k, n in want.items():
        at = 0
        for start, length in sorted(got[k]):
            assert start == at
            at += length
        assert at == n


def test_word_tokenizer_equals_whole_texts():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    texts = [
        "", "Hello, World. It's 2.5% (or so)...", "a.b. c,d, x\x1cy z\x85w", "ÄÖÜ ßtraße ΣΑΣ. İstanbul, é café.",
        "<|endoftext|> <|ENDOFTEXT|>, 中文 \U0001f600‍. 　wide space don't WON'T", "\n\nfirst\nsecond .,., ...", LONG[:3000],
    ]
    tokenizer = packing.WordTokenizer(TOKENIZER)
    for text in texts:
        ids, _ = tokenizer.encode(text)
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids + [2], text


# --- 9: rules ---------------------------------------------------------------------------------------------------------


def test_repeated_words_and_ablation(spark):
    chance = random.Random(8)
    texts = [" ".join(chance.choices("abc", k=chance.randint(0, 60))) for _ in range(60)]
    rows = rules.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).cache()
    for r in rows.collect():
        words, covered, seen = texts[r["doc_id"]].split(), set(), {}
        for i in range(len(words) - 7):
            seen.setdefault(tuple(words[i : i + 8]), []).append(i)
        for starts in seen.values():
            covered |= {i + k for i in starts for k in range(8)} if len(starts) > 1 else set()
        assert r["n_repeat_words"] == len(covered)
    kept = rows.where(rules.passes(F.col("failed"), rules.POLICIES["base"])).count()
    cells = {r["rule"]: r for r in rules.ablation(rows, "base").collect()}
    assert {r["n_kept"] for r in cells.values()} == {kept}
    alone = rows.where(F.col("failed").bitwiseAND(F.lit(3)) == 1).count()
    assert cells["few_words"]["n_alone"] == alone


# --- 10: components and trees -----------------------------------------------------------------------------------------


def test_nothing_that_grows_passes_through_the_driver(spark, monkeypatch):
    """The planner takes small files for small tables, whatever their lists unfold to; only marks of bounded size are broadcast."""
    plans = []

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.materialize(df, name)

    for module in ("jaccard", "components"):
        monkeypatch.setattr(f"voxloom.llm.{module}.materialize", watched)
    rows = [(k, " ".join([*(f"g{k // 3}w{j}" for j in range(39)), f"end{k}"])) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for counted in (False, True):
        plans.clear()
        found = jaccard.jaccard_components(docs, counted=counted)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        assert {(r["doc_id"] // 3 * 3, r["component_id"]) for r in found.collect()} == {(k, k) for k in range(0, 60, 3)}
        assert sum(plan.count("BroadcastExchange") for plan in plans) <= 1 and sum(plan.count("SortMergeJoin") for plan in plans) > 8


@pytest.mark.parametrize("taken, collects", [(300, False), (400, True)])
def test_a_grown_driver_is_collected(taken, collects):
    class Driver:
        calls = []
        sparkContext = _jvm = java = lang = Runtime = property(lambda self: self)
        System = property(lambda self: type("System", (), {"gc": lambda: self.calls.append(1)}))

        def getRuntime(self):
            return self

        def totalMemory(self):
            return taken

        def maxMemory(self):
            return 750

    driver = Driver()
    assert session.collect_driver(driver) == collects and bool(driver.calls) == collects
    driver.calls.clear()


def test_components_of_paths_and_hubs(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100 + k, 100) for k in range(1, 30)] + [(500, 129), (7, 7), (7, 3)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, 500: 100}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_tree_join_equals_all_pairs(percent):
    chance = np.random.default_rng(9)
    base = [np.unique(chance.integers(0, 1 << 63, chance.integers(1, 60)).astype(np.uint64) << np.uint64(1)) for _ in range(60)]
    sets = []
    for k in range(1500):
        own = base[k % 60].copy()
        change = chance.random(len(own)) < chance.random() * 0.2
        own[change] = chance.integers(0, 1 << 63, change.sum()).astype(np.uint64)
        sets.append(np.unique(own))
    got = jaccard.joined_components(sets, percent)
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    plain = [set(s.tolist()) for s in sets]
    for k in range(len(sets)):
        for j in range(k % 60, k, 60):
            both = len(plain[k] & plain[j])
            if 100 * both >= percent * (len(plain[k]) + len(plain[j]) - both):
                root[find(k)] = find(j)
    pairs = {(int(got[k]), find(k)) for k in range(len(sets))}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_cluster_in_blocks(spark, monkeypatch):
    """A cluster above the block size is cut up and still finds every link."""
    chance = random.Random(11)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(60):
        own = words[:100]
        for place in chance.sample(range(100), chance.randint(0, 3)):
            own = [*own[:place], f"x{chance.random()}", *own[place + 1 :]]
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r["doc_id"]: r["component_id"] for r in jaccard.query(docs).collect()}
    monkeypatch.setattr(jaccard, "CLUSTER_SHINGLES", 1000)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.query(docs).collect()} == want
    assert 1 < len(set(want.values())) < 60


def test_link_numbers_equal_all_pairs(spark, monkeypatch):
    """Every pair counts once, weighted by equal texts, in one block and in many."""
    chance = random.Random(3)
    rows = []
    for k in range(90):
        own = [f"g{k % 3}w{j}" for j in range(80)]
        for place in chance.sample(range(80), chance.randint(0, 2)):
            own[place] = f"x{chance.randint(0, 20)}"
        rows.append((k, " ".join(own)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (101, rows[0][1]), (102, ""), (None, rows[0][1])]
    texts = {k: frozenset(tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)) for k, t in rows if k is not None and t}
    linked = lambda a, b: 100 * len(a & b) >= 90 * len(a | b)
    want = {k: sum(linked(a, b) for j, b in texts.items() if j != k) for k, a in texts.items()} | {102: 0, None: 0}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (jaccard.CLUSTER_SHINGLES, 700):
        monkeypatch.setattr(jaccard, "CLUSTER_SHINGLES", most)
        got = jaccard.query(docs).collect()
        assert len(got) == len(rows) and {r["doc_id"]: r["n_links"] for r in got} == want
    assert max(want.values()) > 5


# --- pipeline ---------------------------------------------------------------------------------------------------------


def test_stages_keep_columns_and_clean_rows(spark, odd, none, tmp_path):
    label_rows(spark, [(4, 1, 0), (5, 0, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    benchmark_rows(spark, [(1, "nothing that any of these texts has in it at all")]).write.parquet(f"{tmp_path}/benchmark.parquet")
    named = odd.withColumns({c: F.lit(1) for c in ("score", "n_lines", "starts", "tie", "component_id", "key", "_size")})
    for docs in (named, named.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert {1, 2, 3, 4, 7, 8, 9, None} <= {r["doc_id"] for r in out.collect()} or docs is not named, name
        assert (corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).count() > 0) == (docs is named)


def test_pipeline_takes_effect(spark, tmp_path):
    clean = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(40)]
    bad = "you idiot you moron you scum"
    rows = [(k, t) for k, t in enumerate(clean)] + [(100 + k, f"{clean[k]} {bad}") for k in range(40)]
    rows += [(200, clean[0] + " end"), (201, " ".join(f"leak{j}" for j in range(20)) + " " + clean[1][:40])]
    rows += [(300, "l one\nl two\nl three"), (301, "top\nl one\nl two\nl three\nown line")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    label_rows(spark, [(k, 1, int(100 <= k < 140)) for k, _ in rows]).write.parquet(f"{tmp_path}/labels.parquet")
    benchmark_rows(spark, [(1, " ".join(f"leak{j}" for j in range(20)))]).write.parquet(f"{tmp_path}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in packed}
    assert ids == {*range(40), 300, 301}
    assert pa.types  # the pieces carry bytes
    assert all(len(r["ids"]) == 4 * r["length"] for r in packed)


def test_frequent_windows_are_told_apart(spark, monkeypatch):
    # every third text holds the same passage, some hold a rarer one
    text = lambda k: "\n".join(["x", "y", "z"] * (k % 3 == 0) + ["p", "q", "r"] * (k % 40 == 1) + [f"own {k} {i}" for i in range(4)])
    df = spark.range(400).select(F.col("id").alias("doc_id")).join(
        spark.createDataFrame([(k, text(k)) for k in range(400)], "doc_id long, text string"), "doc_id"
    )
    rows = {}
    for least in (10, 10**9):
        monkeypatch.setattr(linededup, "HOT_PLACES", least)
        rows[least] = {r["doc_id"]: (r["n_removed"], r["text"]) for r in linededup.query(df).collect()}
    assert rows[10] == rows[10**9] and len(rows[10]) == 400
    assert [k for k, (n, _) in rows[10].items() if n] == [k for k in rows[10] if k and k % 3 == 0 or k > 1 and k % 40 == 1]


def test_upper_tail():
    from math import comb

    for n, share in ((7, 0.3), (30, 0.05), (40, 0.9)):
        for hits in range(n + 1):
            want = sum(comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(hits, n + 1))
            assert toxicity.upper_tail(hits, n, share) == pytest.approx(want, rel=1e-6)


def test_few_toxic_labels_teach_something(spark):
    chance = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(120):
        text = chance.choices(words, k=60)
        if k % 10 == 0:
            text[::20] = ["vile"] * 3
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = label_rows(spark, [(k, 1, int(k % 10 == 0)) for k in range(80)])
    scored = toxicity.query(docs, labels).collect()
    assert {r["doc_id"] for r in scored if r["predicted"]} == set(range(0, 120, 10))
    assert len({r["score"] for r in scored}) > 1


def test_words_are_encoded_as_the_tokenizer_does():
    tokenizer = packing.WordTokenizer(TOKENIZER)
    assert tokenizer._by_bytes
    texts = [
        "\u03a3\u039f\u03a6\u039f\u03a3 \u0130stanbul \u00c9T\u00c9 \u01c5ungla \ufb01ne \u017ftra\u00dfe \ud55c\uad6d\uc5b4 \u65e5\u672c\u8a9e \u1e9e Gr\u00f6\u00dfe, don't it's x.y, A.B. word. \u2167 \u00aa \u00ba \U0001d518x",
        "e\u0301te\u0301 \u00e9t\u00e9 N\u0303a \u0421\u041b\u041e\u0412\u041e \u0441\u043b\u043e\u0432\u043e. \u0905\u0915\u094d\u0937\u0930 a\x1cb", "", " \n ",
    ]
    for text in texts:
        for _ in range(2):
            ids = np.frombuffer(tokenizer.encode(text)[0], dtype="<u4").tolist()
            assert ids == [*tokenizer._tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID], text


def test_seeds_of_the_benchmark_have_a_bounded_size(spark):
    """A seed carries the words around it and not its whole item."""
    long_item = " ".join(f"w{k}" for k in range(3000))
    items = decontaminate.benchmark_items(spark.createDataFrame([(1, long_item)], "item_id long, text string"), "item_id", "text")
    rows = decontaminate.benchmark_seeds(items).collect()
    assert len(rows) == 3 * (3000 - 7)
    assert {len(r["near"]) for r in rows} == {18}
    docs = spark.createDataFrame(
        [(1, "x " + " ".join(f"w{k}" for k in range(2980, 3000)) + " y"), (2, "w1 w2 w3 w4 w5 w6")], "doc_id long, text string"
    )
    benchmark = spark.createDataFrame([(1, long_item)], "item_id long, text string")
    found = {r["doc_id"]: r["contaminated"] for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found == {1: True, 2: False}


def test_marks_keep_every_member(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.lit("x").alias("t"))
    members = spark.range(10).select((F.col("id") * 1_999).alias("id")).unionAll(spark.range(1, 2))
    kept = jaccard.maybe_in(rows, members, "id")
    assert kept.columns == ["id", "t"]
    found = [r["id"] for r in kept.collect()]
    assert set(found) >= {1, *range(1_999, 19_000, 1_999)} and len(found) < 100


def test_only_texts_of_clusters_are_dealt_out(spark, monkeypatch):
    near = " ".join(f"near{k}" for k in range(300))
    texts = [" ".join(f"w{d}x{k}" for k in range(20)) for d in range(200)] + [near, near + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    deal, write, dealt, names = jaccard.in_groups, jaccard.materialize, [], []

    def spied(rows, group, *rest, **named):
        if group == "cluster":
            dealt.append(named["wide"].count())
        return deal(rows, group, *rest, **named)

    monkeypatch.setattr(jaccard, "in_groups", spied)
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: names.append(name) or write(df, name))
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard.query(docs).collect()}
    assert got == {d: (d, 0) for d in range(200)} | {200: (200, 1), 201: (200, 1)}
    assert len(dealt) == 1 and 2 <= dealt[0] < 20
    # cells are written once for both of their readers, and go when the clusters are known
    assert names.count("jaccard-cells") == 1 and not any("jaccard-cells" in path for path in session._written)
