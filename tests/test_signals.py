"""Waveform functions, timestamp repair and cuts against plain restatements."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.functions import align as L
from voxloom.functions import signal as G
from voxloom.operators import longsignals as B
from voxloom.operators import windows as W

x = F.col("x")


def test_audio_token_length(column):
    frames = list(range(0, 1203))

    def halved(n, times):
        return n if times == 0 else halved(-(-n // 2), times - 1)

    assert column(frames, G.audio_token_length(x), "bigint") == [halved(n % 100, 3) + 13 * (n // 100) for n in frames]


def test_to_mono(column):
    rows = [[1.0, 2.0, 4.0], [3.0, 2.0, 0.0]]
    frames = [[1.0, 3.0], [2.0, 2.0]]
    tall = [[float(i), float(i + 2)] for i in range(10)]
    got = column([rows, frames, tall, [[5.0, 6.0]], []], G.to_mono(x), "array<array<float>>")
    assert got == [[2.0, 2.0, 2.0], [2.0, 2.0], [float(i + 1) for i in range(10)], [5.0, 6.0], []]


def test_ranges(column):
    cases = [[], [0.0, 0.0], [0.5, -0.5], [2.0, -4.0], [1.0, -1.0]]
    assert column(cases, G.normalize_range(x), "array<float>") == [[], [0.0, 0.0], [0.5, -0.5], [0.5, -1.0], [1.0, -1.0]]
    loud = column([[1.0000001, 0.5], [2.0, 1.0]], G.normalize_float_pcm(x), "array<float>")
    assert loud == [[1.0, 0.5], [1.0, 0.5]]
    ints = [[-32768, 0, 16384, 32767]]
    assert column(ints, G.normalize_int_pcm(x, 16), "array<int>")[0] == pytest.approx([-1.0, 0.0, 0.5, 32767 / 32768])
    assert column([[0, 128, 192]], G.normalize_int_pcm(x, 8, signed=False), "array<int>") == [[-1.0, 0.0, 0.5]]
    assert column([[-32768, 16384]], G.stream_pcm16(x), "array<smallint>") == [[-1.0, 0.5]]


@pytest.mark.parametrize("sr", [8, 11, 16, 22, 44])
def test_resample(column, sr):
    rng = np.random.default_rng(sr)
    for n in (0, 1, 2, 13, 40):
        wav = rng.normal(size=n).astype(np.float32)
        size = int(np.floor(n * 16 / sr + 0.5))
        want = np.interp(np.arange(size) * sr / 16, np.arange(n), wav) if n and sr != 16 else wav
        got = column([wav.tolist()], G.resample_linear(x, F.lit(sr), 16), "array<float>")[0]
        assert got == pytest.approx(want.tolist(), abs=1e-6)
        size = round(n / sr * 16)
        want = np.interp(np.arange(size) * n / max(size, 1), np.arange(n), wav) if n and sr != 16 else wav
        got = column([wav.tolist()], G.resample_even_grid(x, F.lit(sr), 16), "array<float>")[0]
        assert got == pytest.approx(want.tolist(), abs=1e-6)


def test_slices(spark):
    spans = [(0.0, 0.5), (0.5, 0.5), (0.9, 0.2), (None, 1.0), (-1.0, 0.25), (0.75, 9.0), (2.0, 3.0), (0.1, 0.12)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i int, a double, b double")
    wav = F.array(*[F.lit(float(v)).cast("float") for v in range(8)])
    got = [r[0] for r in df.orderBy("i").select(G.slice_span(wav, F.lit(8), F.col("a"), F.col("b"))).collect()]
    assert got == [[0.0, 1.0, 2.0, 3.0], None, None, None, [0.0, 1.0], [6.0, 7.0], None, None]


def best_chain(values):
    """Quadratic search: earliest end of the longest chain, earliest parent of every element."""
    size, parent = [], []
    for i, v in enumerate(values):
        options = [(size[j], -j) for j in range(i) if values[j] <= v]
        longest, at = max(options, default=(0, 1))
        size.append(longest + 1)
        parent.append(-at)
    mask = [False] * len(values)
    at = size.index(max(size)) if size else -1
    while at >= 0:
        mask[at], at = True, parent[at]
    return mask


def filled(values):
    mask = best_chain(values)
    out = list(values)
    for i, ok in enumerate(mask):
        if ok:
            continue
        left = max((j for j in range(i) if mask[j]), default=None)
        right = min((j for j in range(i + 1, len(values)) if mask[j]), default=None)
        if left is None or right is None:
            out[i] = values[right if left is None else left]
        elif right - left <= 3:
            out[i] = values[left] if i - left <= right - i else values[right]
        else:
            out[i] = int(values[left] + (values[right] - values[left]) / (right - left) * (i - left))
    return [int(v) for v in out]


def series():
    rng = random.Random(3)
    cases = [[], [5], [1, 2, 3], [1, 9, 2, 3], [9, 1, 2], [1, 2, 0], [1, 9, 8, 7, 2], [3, 3, 3], [3, 2, 1], [1, 5, 9, 2, 3, 4]]
    for _ in range(300):
        n = rng.randint(1, 40)
        cases.append([i * rng.choice([1, 10]) + rng.randint(-15, 15) for i in range(n)])
    return cases


def test_monotone_mask_and_repair(column):
    cases = series()
    assert column(cases, L.monotone_keep_mask(x), "array<bigint>") == [best_chain(c) for c in cases]
    assert column(cases, L.repair_timestamps(x), "array<bigint>") == [filled(c) for c in cases]


def test_lists_in_a_worker_are_repaired_alike(column):
    cases = series() + [None, [2**53 + 1, 2**53 + 2]]
    none_first = [[None, 3, 4], [5, 1, 2], None]
    for values in (cases, none_first):
        lists = pa.array(values, type=pa.list_(pa.int64()))
        slots = [v for v in L.repaired_lists(lists, 80.0).to_pylist()]
        millis = [v and [x if x is None else int(x * 80.0) for x in v] for v in values]
        assert slots == column(millis, L.repair_timestamps(x), "array<bigint>")
    # a fall between two lists is none in them
    assert L.repaired_lists(pa.array([[1, 9], [], [0, 4]]), 1.5).to_pylist() == [[1, 13], [], [0, 6]]


def test_only_what_is_out_of_order_is_searched(monkeypatch):
    sizes = []
    search = L._searched
    monkeypatch.setattr(L, "_searched", lambda v: sizes.append(len(v)) or search(v))
    values = list(range(100_000))
    values[50_000] = 49_990
    assert L.longest_monotone(values).sum() == 99_999
    assert sizes == [10]


def test_pair_timestamps(spark):
    df = spark.createDataFrame([(["a", "b"], [80, 160, 1234, 2000])], "w array<string>, t array<bigint>")
    rows = df.select(L.pair_timestamps(F.col("w"), F.col("t"), F.lit(180.5))).first()[0]
    assert [tuple(r) for r in rows] == [("a", 180.58, 180.66), ("b", 181.734, 182.5)]


def test_split_long_signal_partitions_the_signal(spark):
    rng = np.random.default_rng(5)
    waves = [rng.normal(size=n).astype(np.float32) for n in (0, 10, 16, 17, 80, 331)] + [np.zeros(100, np.float32)]
    df = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(waves)], "id int, wav array<float>")
    rows = W.split_long_signal(df, "id", "wav", 16, 1.0, 0.4, 100.0).orderBy("id", "chunk_index").collect()
    for i, wav in enumerate(waves):
        mine = [r for r in rows if r["id"] == i]
        assert [r["chunk_index"] for r in mine] == list(range(len(mine)))
        joined = np.concatenate([np.asarray(r["wav"][: r["n_samples"]], np.float32) for r in mine])
        assert np.array_equal(joined, wav)
        starts = np.cumsum([0] + [r["n_samples"] for r in mine])[:-1] / 16
        assert [r["offset_sec"] for r in mine] == pytest.approx(starts.tolist())
        if len(mine) > 1:
            assert all(len(r["wav"]) == max(8, r["n_samples"]) for r in mine)
            assert all(not any(r["wav"][r["n_samples"] :]) for r in mine)
        assert all(r["n_samples"] <= 16 + 7 for r in mine)


def test_first_cut_is_the_quiet_boundary(spark):
    rng = np.random.default_rng(9)
    waves = [rng.normal(size=64).astype(np.float32) for _ in range(40)] + [np.zeros(64, np.float32)]
    df = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(waves)], "id int, wav array<float>")
    cuts = {r["id"]: r["boundary"] for r in W.quiet_boundary(df, "id", "wav", 16, 2.0, 1.0).collect()}
    assert cuts == {i: W.cut_positions(w, 16, 2.0, 1.0)[1] for i, w in enumerate(waves)}


def test_quiet_gap_is_found():
    wav = np.ones(64, np.float32)
    wav[36:42] = 0.0
    assert W.cut_positions(wav, 16, 2.0, 1.0)[1] == 36
    # a range no wider than the window cuts at the target
    assert W.cut_positions(wav, 16, 2.0, 0.1)[1] == 32


def _blocks(rng, name, wav):
    """A signal in blocks of random lengths, some of them empty, in random order."""
    edges = sorted({0, len(wav), *rng.integers(0, len(wav) + 1, size=len(wav) // 9).tolist()})
    blocks = [(name, a, wav[a:b].tolist()) for a, b in zip(edges, edges[1:])] + [(name, len(wav) // 2, [])]
    rng.shuffle(blocks)
    return [(n, int(a), w) for n, a, w in blocks]


@pytest.mark.parametrize("longest,expand,window_ms", [(1.0, 0.5, 100.0), (1.0, 2.0, 100.0), (2.0, 0.1, 500.0), (1.0, 0.0, 100.0)])
def test_blocks_are_cut_like_rows(spark, longest, expand, window_ms):
    rng = np.random.default_rng(17)
    waves = [rng.normal(size=n).astype(np.float32) for n in (0, 1, 16, 17, 80, 331, 2000)]
    waves += [np.zeros(300, np.float32), np.repeat(np.float32([1, 0, 2]), 90), rng.integers(0, 3, size=700).astype(np.float32)]
    names = [None, *range(1, len(waves))]
    whole = spark.createDataFrame([(k, w.tolist()) for k, w in zip(names, waves)], "id int, wav array<float>")
    blocks = [b for k, w in zip(names, waves) for b in _blocks(rng, k, w)] + [(77, None, [1.0]), (78, 0, None)]
    stored = spark.createDataFrame(blocks, "id int, first long, x array<float>")
    order = lambda df: [tuple(r) for r in df.orderBy("id", "chunk_index").collect()]
    expected = order(W.split_long_signal(whole, "id", "wav", 16, longest, expand, window_ms))
    got = order(B.split_blocks(stored, "id", "first", "x", 16, longest, expand, window_ms, stretch=1))
    assert [(*r[:2], pytest.approx(r[2]), *r[3:]) for r in expected] == got
    assert len(got) > 100


def test_blocks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int, first long, x array<float>")
    assert B.split_blocks(empty, "id", "first", "x", 16, 1.0).collect() == []


def test_stretches_of_a_long_signal_are_tables_of_a_few_runs():
    rng = np.random.default_rng(3)
    loud = np.abs(rng.normal(size=60_000)).astype(np.float32)
    cuts = B.next_cuts(loud, 50_000, 4000, 2000, 100)
    exits = B.leaving(cuts)
    assert len(B._runs(cuts)[0]) < 200 and len(B._runs(exits)[0]) < 20
    walked = W.cut_positions(loud, 100, 40.0, 20.0, 1000.0)
    assert B.window_size(100, 1000.0) == 100
    assert [int(cuts[c]) for c in walked if c < 50_000] == [*walked[1:], B.NO_CUT][: sum(c < 50_000 for c in walked)]


def test_first_minima_by_definition():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 4, size=50)
    for width in range(1, 51):
        assert B.first_minima(values, width).tolist() == [i + int(values[i : i + width].argmin()) for i in range(51 - width)]
