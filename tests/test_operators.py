"""Operators against plain restatements, with a hot key and several block sizes."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxloom.operators import aggregates as A
from voxloom.operators import batches as B
from voxloom.operators import detect as D
from voxloom.operators import filters as P
from voxloom.operators import hooks as H
from voxloom.operators import joins as J
from voxloom.operators import ordered as O
from voxloom.operators import sampling as S
from voxloom.operators import windows as W
from voxloom.operators.tries import Trie, register_prefix_split
from voxloom.session import BATCHES


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds most rows; the order has gaps, so blocks differ in size and some are missing."""
    rng = random.Random(1)
    data = []
    for key, n in (("hot", 500), ("warm", 40), ("cold", 1)):
        at = 0
        for _ in range(n):
            at += rng.choice([1, 1, 2, 90])
            data.append((key, at, rng.randint(-9, 9), rng.choice("aab")))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k string, o bigint, v bigint, t string").cache()


def by_key(data):
    out = {}
    for key, o, v, t in sorted(data):
        out.setdefault(key, []).append((o, v, t))
    return out


@pytest.mark.parametrize("width", [1, 7, 1000, 10**6])
def test_blocks_do_not_change_results(rows, width):
    data, df = rows
    block = O.value_block(F.col("o"), width)
    pos = {(r["k"], r["o"]): (r["pos"], r["n"]) for r in O.with_position(df, ["k"], ["o"], block, "pos", "n").collect()}
    total = {(r["k"], r["o"]): r["s"] for r in O.with_running(df, ["k"], ["o"], block, F.col("v"), "s").collect()}
    low = {(r["k"], r["o"]): r["s"] for r in O.with_running(df, ["k"], ["o"], block, F.col("v"), "s", "min").collect()}
    prev = {(r["k"], r["o"]): r["p"] for r in O.with_previous(df, ["k"], ["o"], block, F.col("t"), "p").collect()}
    kept = {(r["k"], r["o"]) for r in W.collapse_consecutive(df, ["k"], ["o"], block, "t").collect()}
    lists = {r["k"]: r["all"] for r in O.collect_in_order(df, ["k"], "o", block, "t", "all").collect()}
    for key, items in by_key(data).items():
        assert lists[key] == [t for _, _, t in items]
        for i, (o, _, t) in enumerate(items):
            before = [v for _, v, _ in items[:i]]
            assert pos[key, o] == (i, len(items))
            assert total[key, o] == sum(before)
            assert low[key, o] == min(before, default=None)
            assert prev[key, o] == (items[i - 1][2] if i else None)
            assert ((key, o) in kept) == (i == 0 or items[i - 1][2] != t)


@pytest.mark.parametrize("block", [5, 64, 10**6])
def test_window_energy(spark, block):
    rng = random.Random(2)
    values = [rng.randint(-5, 5) for _ in range(300)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, pos bigint, v int")
    got = {r["pos"]: r["energy"] for r in W.window_energy(df, "k", "pos", "v", 5, block=block).collect()}
    assert got == {i: sum(abs(v) for v in values[i : i + 5]) for i in range(296)}


@pytest.mark.parametrize("block", [1, 16, 10**6])
def test_value_range_chunks(spark, block):
    rng = random.Random(4)
    lists = {k: sorted(rng.sample(range(0, 400), n)) for k, n in ((1, 60), (2, 5), (3, 1))}
    lists[4] = [0, 500, 501, 502, 503, 504]
    want = {}
    for k, values in lists.items():
        cut = 0
        for i, v in enumerate(values):
            cut += v >= (cut + 1) * 20
            want[k, i] = cut
    df = spark.createDataFrame([(k, i, v) for k, vs in lists.items() for i, v in enumerate(vs)], "k int, pos bigint, v int")
    got = W.value_range_chunks(df, "k", "pos", "v", 20, O.value_block(F.col("pos"), block)).collect()
    assert {(r["k"], r["pos"]): r["range_chunk"] for r in got} == want


@pytest.mark.parametrize("n,parts", [(10, 4), (3, 5), (16, 16), (17, 16), (100, 7)])
def test_contiguous_parts(spark, n, parts):
    df = spark.range(n).select(O.contiguous_part(F.col("id"), F.lit(n).cast("bigint"), parts).alias("p"))
    sizes = [r["count"] for r in df.groupBy("p").count().orderBy("p").collect()]
    assert len(sizes) == min(n, parts) and sum(sizes) == n
    assert sizes == sorted(sizes, reverse=True) and sizes[0] - sizes[-1] <= 1


@pytest.mark.parametrize("n,ratio", [(1, 0.003), (10, 0.25), (1000, 0.003), (999, 0.5), (1000, 0.999)])
def test_split_is_exact_and_repeatable(spark, n, ratio):
    first = S.train_eval_split(spark.range(n), "id", ratio)
    rows = {r["id"]: r["split"] for r in first.collect()}
    assert len(rows) == n
    assert sum(s == "eval" for s in rows.values()) == S.eval_rows(n, ratio)
    again = S.train_eval_split(spark.range(n).repartition(5), "id", ratio)
    assert {r["id"]: r["split"] for r in again.collect()} == rows
    with pytest.raises(ValueError):
        S.train_eval_split(spark.range(3), "id", 1.5)


def test_results_do_not_depend_on_the_number_of_partitions(spark):
    seen = []
    for partitions in ("1", "3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rows = S.seeded_shuffle(spark.range(200), "id").collect()
        seen.append(sorted((r["pos"], r["id"]) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1] == seen[2]
    assert [p for p, _ in seen[0]] == list(range(200))
    assert [i for _, i in seen[0]] != list(range(200))


def test_samples_and_splits_read_narrow(spark):
    plan = S.cut_point(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id", 0.1)
    assert "text" not in plan._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_reject_order(spark):
    texts = ["ok", "x" * 30, "y" * 11, "a b c d", "a b", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = P.with_reject_reason(df, "t", max_chars=20, max_tokens=3).orderBy("i").collect()
    assert [r["reason"] for r in rows] == [None, "repetition", "repetition", "token_limit", None, None]
    assert [r["token_count"] for r in rows] == [1, None, None, 4, 2, None]
    off = P.with_reject_reason(df, "t", max_repeat=100).collect()
    assert all(r["reason"] is None for r in off)


def test_samples(spark):
    def turn(role, content):
        return (content, role)

    data = [
        ([turn("user", "<audio>"), turn("assistant", " hi "), turn("assistant", "no")], ["a.wav", "b.wav"]),
        ([turn("assistant", " "), turn("assistant", "later")], ["a.wav"]),
        ([turn("user", "x")], ["a.wav"]),
        ([turn("assistant", "x")], []),
        (None, None),
    ]
    df = spark.createDataFrame(data, "messages array<struct<content:string,role:string>>, audios array<string>")
    out = df.select(P.first_assistant_turn(F.col("messages")).alias("t"), P.first_audio_path(F.col("audios")).alias("a"))
    assert [tuple(r) for r in out.collect()] == [("hi", "a.wav"), ("", "a.wav"), (None, "a.wav"), ("x", None), (None, None)]
    assert [r["t"] for r in out.where(P.is_valid_sample(F.col("t"), F.col("a"))).collect()] == ["hi"]


def test_small_columns(column):
    x = F.col("x")
    assert column(["a", "/a"], P.join_base_path("/b/", x)) == ["/b/a", "/a"]
    assert column(["a"], P.join_base_path("", x)) == ["a"]
    assert column([0.0, 30.0, 30.1, -1.0, None], P.within_duration(x), "double") == [False, True, False, False, False]
    tok = "<|audio_pad|>"
    assert column([f"a{tok}b{tok}"], P.expand_audio_tokens(x, F.array(F.lit(2), F.lit(0), F.lit(9)))) == [f"a{tok}{tok}b"]
    with pytest.raises(PySparkException):
        column([f"{tok}{tok}"], P.expand_audio_tokens(x, F.array(F.lit(2))))
    assert column([None, "English"], P.build_prompt(F.lit("c"), x, "[%s]")) == ["[c]", "[c]language English<asr_text>"]


def test_sequence_errors(spark):
    def measure(texts):
        if (texts == "bad").any():
            raise ValueError("x" * 200)
        return texts.str.len()

    df = spark.createDataFrame([(0, "abc"), (1, "bad"), (2, "de")], "i int, t string").coalesce(1)
    rows = P.sequence_lengths(df, "i", "t", measure).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [(0, 3, None), (1, -1, "x" * 100), (2, 2, None)]


@pytest.mark.parametrize("side", ["left", "right"])
def test_pad_and_mask(spark, side):
    df = spark.createDataFrame([(0, [5, 6, 7], 1), (0, [8], 1), (1, [9, 0], 0)], "b int, ids array<int>, p int")
    rows = {tuple(r["ids"]): r for r in B.pad_and_mask(df, "b", "ids", "p", 0, side).collect()}
    gap = {"left": [[0, 0, 8], [0, 0, 1], [-100] * 3], "right": [[8, 0, 0], [1, 0, 0], [-100] * 3]}[side]
    one = rows[(8,)]
    assert [one["input_ids"], one["attention_mask"], one["labels"]] == gap
    assert rows[(5, 6, 7)]["labels"] == [-100, 6, 7]
    assert rows[(9, 0)]["labels"] == [9, -100]


def test_batch_arguments(spark):
    df = spark.range(3).withColumnRenamed("id", "i")
    one = spark.createDataFrame([(9, "c")], "i bigint, c string")
    assert [r["c"] for r in J.broadcast_argument(df, one, "c", "i").collect()] == ["c"] * 3
    each = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "i bigint, c string")
    assert sorted(r["c"] for r in J.broadcast_argument(df, each, "c", "i").collect()) == ["x", "y", "z"]
    elsewhere = each.withColumn("i", F.col("i") + 5)
    for wrong in (each.limit(2), elsewhere, each.unionByName(elsewhere)):
        with pytest.raises(Exception, match="batch size mismatch"):
            J.broadcast_argument(df, wrong, "c", "i").collect()
    assert [r["c"] for r in J.broadcast_argument(df, one.select("c"), "c", "i").collect()] == ["c"] * 3


def test_unsupported_languages(spark):
    df = spark.createDataFrame([("English",), ("Klingon",)], "l string")
    assert [r["l"] for r in J.unsupported_languages(df, "l").collect()] == ["Klingon"]
    with pytest.raises(PySparkException):
        J.unsupported_languages(df, "l", strict=True).collect()
    codes = spark.createDataFrame([("zh-cn",), ("zh-tw",), ("xx",), (None,)], "c string")
    names = {r["c"]: r["language"] for r in J.map_language_code(codes, "c").collect()}
    assert names == {"zh-cn": "Chinese", "zh-tw": "Chinese", "xx": "None", None: "None"}


def test_dictionary_split(spark):
    docs = spark.createDataFrame([(0, "학교에서 학교 집에 모름,"), (1, ""), (2, "학교는")], "d int, t string")
    words = spark.createDataFrame([("학",), ("학교",), ("집",), ("다른말",)], "word string")
    rows = J.dictionary_left_split(docs, "d", "t", words).orderBy("d", "at").collect()
    assert [(r["left"], r["right"]) for r in rows] == [("학교", "에서"), ("학교", ""), ("집", "에"), ("모름", ""), ("학교", "는")]


def test_merges(spark):
    rows = [
        ("a", 0, "English", "x", [("w", 0.0, 1.0)]), ("a", 1, " ", None, None), ("a", 2, "English", "y", []),
        ("a", 3, "French", "z", [("v", 1.0, 2.0)]), ("a", 4, "English", "", None), ("b", 0, None, "q", None),
    ]
    span = "array<struct<text:string,start_time:double,end_time:double>>"
    df = spark.createDataFrame(rows, f"s string, c int, l string, t string, a {span}")
    for width in (1, 2, 100):
        block = O.value_block(F.col("c"), width)
        assert dict(A.merge_chunk_text(df, "s", "c", "t", block).collect()) == {"a": "xyz", "b": "q"}
        assert dict(A.merge_languages(df, "s", "c", "l", block).collect()) == {"a": "English,French,English", "b": ""}
        spans = dict(A.merge_alignments(df, "s", "c", "a", block).collect())
        assert [r["text"] for r in spans["a"]] == ["w", "v"] and spans["b"] is None


def test_detector_rules(spark):
    df = spark.createDataFrame([("zh", "zh-cn"), ("zh-tw", "zh-cn"), ("", "en"), ("en", "en"), (None, "en")], "p string, e string")
    strict = [r[0] for r in df.select(A.code_matches(F.col("p"), F.col("e"))).collect()]
    loose = [r[0] for r in df.select(A.code_matches(F.col("p"), F.col("e"), symmetric=True)).collect()]
    assert strict == [True, True, False, True, False]
    assert loose == [True, True, True, True, False]
    scores = spark.createDataFrame(
        [("a", 0, 1.0, 5, 10), ("b", 1, 1.0, 5, 10), ("c", 2, 2.0, 9, 10)],
        "detector string, rank int, avg_measure double, correct int, total int",
    )
    assert tuple(A.best_detector(scores, "rank").first()) == ("a", "c")


def test_scripts(column):
    texts = ["مرحبا", "നമസ്കാരം", "你好", "Hello", "नमस्ते", "", "12 !", "ab 你好吗", None]
    want = ["Arabic", "Malayalam", "Chinese", "English", "Hindi", "None", "None", "Chinese", "None"]
    assert column(texts, D.script_language(F.col("x"))) == want


def test_trigrams(spark):
    data = [(0, "the cat the cat", "en"), (1, "le chat noir", "fr"), (2, "", "en"), (3, "?!", "fr")]
    df = spark.createDataFrame(data, "i int, t string, l string")
    got = dict(D.trigram_language(df, "i", "t", D.trigram_profile(df, "t", "l", ("en", "fr")), ("en", "fr")).collect())
    assert got[0] == "en" and got[1] == "fr"
    # a text without letters has the two-blank frame only, no trigram
    assert got[2] == "None" and got[3] == "None"


def test_hooks_report_failures(spark):
    def moody():
        def find(text):
            if text == "x":
                raise RuntimeError("no")
            return "en", 1.0

        return find

    def absent():
        raise ImportError("gone")

    df = spark.createDataFrame([(0, "a"), (1, "x")], "i int, t string")
    rows = df.select("i", H.detector(moody)("t").alias("m"), H.detector(absent)("t").alias("a")).orderBy("i").collect()
    assert [tuple(r["m"]) for r in rows] == [("en", 1.0, None), (None, 0.0, "error: no")]
    assert {r["a"]["error"] for r in rows} == {"unavailable: gone"}


def test_recogniser_batches_are_capped(spark):
    def counting():
        return lambda prompts, wavs: [str(len(prompts))] * len(prompts)

    df = spark.range(10).select("id", F.lit("p").alias("p"), F.array(F.lit(1.0).cast("float")).alias("w")).coalesce(1)
    sizes = [int(r["raw"]) for r in H.transcribe_batches(df, ["id"], "p", "w", counting, 4).orderBy("id").collect()]
    assert max(sizes) == 4


def test_blocks_fit_the_hottest_key(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("ts"))
    assert O.fitting_seconds(df, ["k"], "ts") == 86400
    assert O.fitting_seconds(df, ["k"], "ts", rows=100) == 8640
    assert O.fitting_seconds(df.limit(0), ["k"], "ts") == 86400


def test_null_keys_and_orders_keep_their_rows(spark):
    rows = [(None, 1, None), (None, 2, None), (None, None, "a"), (1, None, "a"), (1, 5, None), (1, 6, None), (1, 7, "b")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    block = O.value_block(F.col("o"), 2)
    placed = O.with_position(df, ["k"], ["o"], block).collect()
    assert sorted((r["k"] or 0, r["pos"]) for r in placed) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (1, 3)]
    before = O.with_running(df, ["k"], ["o"], block, F.lit(1), "n").collect()
    assert sorted((r["k"] or 0, r["n"]) for r in before) == sorted((r["k"] or 0, r["pos"]) for r in placed)
    kept = W.collapse_consecutive(df, ["k"], ["o"], block, "v").collect()
    assert sorted((r["k"] or 0, r["o"] or 0, r["v"] or "") for r in kept) == [(0, 0, "a"), (0, 1, ""), (1, 0, "a"), (1, 5, ""), (1, 7, "b")]


def test_sparse_numbers_make_few_blocks(spark):
    df = spark.range(2000).select((F.col("id") * 4_000_000_000_000_000).alias("o"))
    df = df.unionAll(spark.createDataFrame([(None,)], "o bigint"))
    blocks = df.select(O.range_block(df, "o", 64).alias("b"))
    assert 50 <= blocks.distinct().count() <= 65
    placed = O.with_position(df, [], ["o"], O.range_block(df, "o", 64)).orderBy("pos").collect()
    assert [r["pos"] for r in placed] == list(range(2001)) and placed[0]["o"] is None
    assert [r["o"] for r in placed[1:]] == sorted(r["o"] for r in placed[1:])


def test_blocks_hold_like_numbers_of_rows(spark):
    # ids close together and one far away, ids in heaps, and a hot value
    far = spark.range(200_000).unionAll(spark.createDataFrame([(1 << 61,)], "id bigint"))
    heaps = spark.range(50_000).select((F.col("id") * F.col("id") * F.col("id")).alias("id"))
    hot = spark.range(20_000).select(F.when(F.col("id") < 5_000, 7).otherwise(F.col("id")).alias("id"))
    for df, blocks, most in ((far, 4096, 4 * 49), (heaps, 64, 4 * 782), (hot, 64, 5_000 + 4 * 313)):
        sizes = df.groupBy(O.range_block(df, "id", blocks).alias("b")).count().collect()
        assert sum(r["count"] for r in sizes) == df.count() and len(sizes) <= blocks
        assert max(r["count"] for r in sizes) <= most
        ranges = df.groupBy(O.range_block(df, "id", blocks).alias("b")).agg(F.min("id").alias("a"), F.max("id").alias("z")).orderBy("b").collect()
        assert all(r["z"] < s["a"] for r, s in zip(ranges, ranges[1:]))
    for kind in ("double", "decimal(20,2)", "int"):
        df = spark.range(1000).select((F.col("id") - 500).cast(kind).alias("id"))
        assert max(r["count"] for r in df.groupBy(O.range_block(df, "id", 10).alias("b")).count().collect()) <= 200
    none = spark.createDataFrame([(None,), (None,)], "id bigint")
    assert [r[0] for r in none.select(O.range_block(none, "id")).collect()] == [None, None]


def test_splits_and_shards_with_null_and_equal_keys(spark):
    df = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("i"))
    split = [r["split"] for r in S.train_eval_split(df, "k", 0.1).collect()]
    assert len(split) == 100 and "eval" in split
    unique = [r["split"] for r in S.train_eval_split(df, "i", 0.1).collect()]
    assert unique.count("eval") == 10
    assert S.seeded_shuffle(df, "k").count() == 100
    for shards in (1, 7, 90, 400):
        found = S.with_shuffled_shard(df.select("i"), "i", shards).collect()
        sizes = [0] * min(shards, 100)
        for r in found:
            sizes[r["shard"]] += 1
        assert sum(sizes) == 100 and max(sizes) - min(sizes) <= 1
    assert S.with_shuffled_shard(df, "k", 7).count() == 100


def test_trie_finds_the_longest_entry():
    import random

    chance = random.Random(8)
    assert Trie([]).longest_prefix("a") == 0 and Trie(["", "a"]).longest_prefix("") == 0
    for letters in ("ab", "abc\uac00\U0001f600"):
        for _ in range(40):
            entries = ["".join(chance.choices(letters, k=chance.randint(1, 6))) for _ in range(chance.randint(1, 40))]
            trie = Trie(entries)
            for _ in range(60):
                word = "".join(chance.choices(letters, k=chance.randint(0, 9)))
                want = max((len(e) for e in entries if word.startswith(e)), default=0)
                assert trie.longest_prefix(word) == want


def test_both_dictionary_splits_agree(spark):
    df = spark.createDataFrame([(1, "abcd xy  abx. zz"), (2, None), (3, ""), (4, "ab ab\tabcde"), (None, "xyz")], "i int, t string")
    entries = spark.createDataFrame([("ab",), ("abc",), ("x",), ("ab",), (None,), ("",)], "word string")
    small, large = (J.dictionary_left_split(df, "i", "t", entries, shipped_bytes=n) for n in (1 << 20, 0))
    rows = lambda d: sorted(map(str, d.collect()))
    assert rows(small) == rows(large) and small.count() == 8
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    none = entries.limit(0)
    assert rows(J.dictionary_left_split(df, "i", "t", none)) == rows(J.dictionary_left_split(df, "i", "t", none, shipped_bytes=-1))


def test_dictionary_table_function(spark):
    register_prefix_split(spark, spark.createDataFrame([("ab",), ("abc",)], "word string"), name="test_prefixes")
    spark.createDataFrame([(1, "abcd xy abx"), (2, None)], "i int, t string").createOrReplaceTempView("test_texts")
    rows = spark.sql("SELECT i, at, word, prefix FROM test_texts, LATERAL test_prefixes(t) ORDER BY i, at").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "abcd", 3), (1, 1, "xy", 0), (1, 2, "abx", 2)]


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_spans_over_sample_rows(spark, block):
    samples = spark.range(100).select((F.col("id") % 2).alias("k"), F.floor(F.col("id") / 2).alias("p"), F.col("id").cast("float").alias("x"))
    spans = [(0, 0, 0.0, 1.0), (0, 1, 2.0, 9.0), (0, 2, 3.0, 3.0), (1, 3, -2.0, 0.5), (1, 4, 40.0, 50.0), (1, 5, None, 1.0), (2, 6, 0.0, 1.0), (1, 7, 0.1, 0.12)]
    df = spark.createDataFrame(spans, "k bigint, w int, a double, b double")
    cut = J.slice_span_rows(samples, df, "k", "p", "x", "w", F.col("a"), F.col("b"), 8, block)
    own = lambda k, a, b: [float(2 * p + k) for p in range(max(0, a), min(50, b))]
    want = {0: own(0, 0, 8), 1: own(0, 16, 72), 3: own(1, 0, 4)}
    assert {r["w"]: (r["n"], r["wav"]) for r in cut.collect()} == {w: (len(v), v) for w, v in want.items()}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_batches_are_bounded_by_their_audio(spark):
    # one signal of twenty minutes among short ones
    def sizes():
        return lambda prompts, wavs: [f"{len(wavs)} {max(map(len, wavs)) * len(wavs) * 4}"] * len(wavs)

    long, short = 20 * 60 * 16, 16
    df = spark.range(300).coalesce(1).select(
        "id", F.lit("p").alias("p"), F.array_repeat(F.lit(0.5).cast("float"), F.when(F.col("id") == 150, long).otherwise(short)).alias("w")
    )
    bound = 10 * short * 4
    rows = {r["id"]: tuple(map(int, r["raw"].split())) for r in H.transcribe_batches(df, ["id"], "p", "w", sizes, 64, bound).collect()}
    assert len(rows) == 300 and rows[150] == (1, 4 * long)
    assert all(size <= bound for i, (_, size) in rows.items() if i != 150) and max(n for n, _ in rows.values()) == 10


def test_model_profile_names_its_resources():
    profile = H.model_profile(task_cpus=2, gpus=0.5, executor_cores=8, executor_memory="16g", python_memory="4g")
    assert profile.taskResources["cpus"].amount == 2 and profile.taskResources["gpu"].amount == 0.5
    assert profile.executorResources["gpu"].amount == 1 and profile.executorResources["pyspark.memory"].amount == 4096


def test_latencies_are_merged(spark):
    calls = spark.range(1, 100_001).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("d"), (F.col("id") * 1_000_000).alias("nanos"))
    calls = calls.unionAll(spark.createDataFrame([("a", None), ("c", None)], "d string, nanos bigint"))
    first, second = (A.latency_sketches(calls.where(F.coalesce("nanos", F.lit(0)) % 4_000_000 < 2_000_000) if k else calls.where(F.coalesce("nanos", F.lit(0)) % 4_000_000 >= 2_000_000), ["d"]) for k in (0, 1))
    both = {r["d"]: r for r in A.latency_summary(A.merged_latencies(first.unionByName(second), ["d"]), ["d"]).collect()}
    assert set(both) == {"a", "b"} and all(r["calls"] == 50_000 for r in both.values())
    assert (both["a"]["min_ms"], both["a"]["max_ms"], both["a"]["avg_ms"]) == (2.0, 100_000.0, 50_001.0)
    assert both["b"]["p50_ms"] == pytest.approx(50_000, rel=0.05) and both["b"]["p95_ms"] == pytest.approx(95_000, rel=0.03)


def test_detector_calls_are_observed(spark):
    def fails():
        def find(text):
            if text == "3":
                raise ValueError("three")
            return "en", 1.0

        return find

    def gone():
        raise ImportError("none")

    grid = H.timed_grid(spark.range(10).select(F.col("id").cast("string").alias("t")), {"fails": fails, "gone": gone}, "t", ["t"])
    seen, watch = A.observed_calls(grid, "calls")
    rows = seen.collect()
    assert len(rows) == 20 and watch.get["calls"] == 10 and watch.get["failed"] == 11 and watch.get["nanos"] > 0
    assert all((r["nanos"] is None) == (r["detector"] == "gone") for r in rows)


def unbounded(spark):
    for name in BATCHES:
        spark.conf.unset(name)


def counting_factory():
    # made inside a function, so that it travels with the job and not by the name of this module
    def factory():
        return lambda texts, wavs, counts: [[len(texts), 0]] * len(texts)

    return factory


def test_detectors_get_bounded_batches(spark):
    for build in (lambda: H.detector(str.split), lambda: H.token_counter(str.split)):
        unbounded(spark)
        build()
        assert {name: spark.conf.get(name) for name in BATCHES} == BATCHES
    # what the session has set itself stays
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    H.detector(str.split)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "70"
    unbounded(spark)


def test_aligner_gets_bounded_batches(spark):
    unbounded(spark)
    rows = spark.range(0, 2500, 1, 1).select(
        "id", F.array(F.lit("w")).alias("words"), F.lit("w").alias("text"), F.array().cast("array<float>").alias("wav")
    )
    # no size of its own: the model sees what comes as one batch
    spans = H.align_batches(rows, ["id"], "wav", "words", "text", counting_factory(), segment_ms=1000.0, batch_size=0)
    assert spans.select(F.max(F.col("time_stamps")[0]["start_time"])).first()[0] <= 1000


def test_aligner_has_one_worker_a_task(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c"], None, 1.5), (2, [], [0.5], None)], "id int, w array<string>, wav array<float>, o double")

    def falling():
        return lambda texts, wavs, counts: [[0, 2, 4, 1, 6, 8][: 2 * n] for n in counts]

    spans = H.align_batches(rows.withColumn("t", F.lit("a b c")), ["id"], "wav", "w", "t", falling, segment_ms=500.0, offset="o")
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan and "InPandas" not in plan
    found = {r["id"]: [tuple(s) for s in r["time_stamps"]] for r in spans.collect()}
    assert found == {1: [("a", 1.5, 2.5), ("b", 3.5, 3.5), ("c", 4.5, 5.5)], 2: []}


def test_dictionary_gets_bounded_batches(spark):
    unbounded(spark)
    words = spark.createDataFrame([("a",)], "word string")
    docs = spark.createDataFrame([(1, "ab c")], "d int, t string")
    parts = J.dictionary_left_split(docs, "d", "t", words).orderBy("at").collect()
    assert [(r["left"], r["right"]) for r in parts] == [("a", "b"), ("c", "")]
    assert {name: spark.conf.get(name) for name in BATCHES} == BATCHES
