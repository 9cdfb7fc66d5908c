"""Window-like operators: consecutive repeats, offsets, energies, cuts at quiet points, value ranges."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from voxloom.constants import MIN_CHUNK_SECONDS, MIN_WINDOW_MS, MIN_WINDOW_SAMPLES, SEARCH_EXPAND_SECONDS
from voxloom.operators.ordered import BLOCK, with_previous, with_running


def collapse_consecutive(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: str):
    """Rows whose value differs from the row before in the same key; nulls are equal to each other."""
    seen = with_previous(df, keys, order, block, F.col(value), "_prev", "_known")
    return seen.where(~F.col("_known") | ~F.col("_prev").eqNullSafe(F.col(value))).drop("_prev", "_known")


def chunk_offsets(
    df: DataFrame, sample: str, chunk: str, block: Column, length: Column, sr: float, name: str = "offset_sec"
) -> DataFrame:
    """Start second of each chunk: the samples of the earlier chunks over the rate."""
    run = with_running(df, [sample], [chunk], block, length.cast("bigint"), "_before")
    return run.withColumn(name, F.col("_before") / F.lit(float(sr))).drop("_before")


def window_size(sr: float, window_ms: float = MIN_WINDOW_MS) -> int:
    return max(MIN_WINDOW_SAMPLES, int(window_ms / 1000.0 * sr))


def window_energy(
    df: DataFrame, key: str, pos: str, value: str, window: int, name: str = "energy", block: int = 65536
) -> DataFrame:
    """Sum of absolute values over ``window`` rows from each row on; rows without a full window are left out.

    The sum is a difference of two running sums, so the cost does not depend on the window; it is rounded to nine places,
    at which equal energies tie.

    Signals are cut into blocks of positions; the first rows of a block also go to the block before, so every window
    is complete inside one block and a long signal is spread over many tasks.
    """
    block = max(block, window)
    own = F.floor(F.col(pos) / block)
    shared = (F.col(pos) >= block) & (F.pmod(F.col(pos), F.lit(block)) < window - 1)
    copies = df.withColumn(BLOCK, F.explode(F.when(shared, F.array(own - 1, own)).otherwise(F.array(own))))
    order = Window.partitionBy(key, BLOCK).orderBy(pos)
    running = copies.withColumn("_sum", F.sum(F.abs(value)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ahead = running.withColumn("_ahead", F.lead("_sum", window - 1).over(order))
    return (
        ahead.where(F.col("_ahead").isNotNull() & (F.col(BLOCK) == own))
        .withColumn(name, F.round(F.col("_ahead") - F.col("_sum") + F.abs(value), 9))
        .drop("_sum", "_ahead", BLOCK)
    )


def quiet_boundary(
    df: DataFrame,
    key: str,
    wav: str,
    sr: float,
    max_chunk_sec: float,
    expand_sec: float = SEARCH_EXPAND_SECONDS,
    window_ms: float = MIN_WINDOW_MS,
) -> DataFrame:
    """First cut (key, boundary) of each signal longer than the maximum.

    The quietest window around the target cut is taken, then the quietest sample in it, first ones on ties. Only the
    search range is unfolded into rows, which is bounded by the parameters and not by the length of the signal.
    """
    target, expand, win = int(max_chunk_sec * sr), int(expand_sec * sr), window_size(sr, window_ms)
    n = F.size(wav)
    left = max(0, target - expand)
    span = F.least(n, F.lit(target + expand)) - left
    long = df.where(n > target).select(key, F.slice(wav, F.lit(left + 1), span).alias("_seg"))
    # energies as doubles: a float sum would depend on the order of the additions
    samples = long.where(F.size("_seg") > win).select(
        key, F.posexplode(F.transform("_seg", lambda x: x.cast("double"))).alias("_i", "_x")
    )
    energy = window_energy(samples, key, "_i", "_x", win)
    best = energy.groupBy(key).agg(F.min_by("_i", F.struct("energy", "_i")).alias("_w"))
    chosen = long.join(best, key, "left")
    window = F.transform(F.slice("_seg", F.col("_w") + 1, F.lit(win)), F.abs)
    inner = F.array_position(window, F.array_min(window)).cast("int") - 1
    cut = F.coalesce(F.lit(left) + F.col("_w") + inner, F.lit(target))
    return chosen.select(key, F.greatest(cut, F.lit(1)).cast("int").alias("boundary"))


def cut_positions(
    wav: np.ndarray, sr: float, max_chunk_sec: float, expand_sec: float = SEARCH_EXPAND_SECONDS,
    window_ms: float = MIN_WINDOW_MS,
) -> list[int]:
    """All cuts of one signal. Each cut starts from the one before, so a signal is walked from left to right."""
    longest, expand, win = int(max_chunk_sec * sr), int(expand_sec * sr), window_size(sr, window_ms)
    loud = np.abs(wav)
    # one running sum serves every window of every cut
    upto = np.concatenate([[0.0], np.cumsum(loud, dtype=np.float64)])
    cuts = [0]
    while len(wav) - cuts[-1] > longest:
        target = cuts[-1] + longest
        low = max(cuts[-1], target - expand)
        around = loud[low : target + expand]
        if len(around) > win:
            ends = upto[low + win : low + len(around) + 1]
            # rounded, so that equal energies tie
            quiet = int(np.round(ends - upto[low : low + len(ends)], 9).argmin())
            target = low + quiet + int(around[quiet : quiet + win].argmin())
        cuts.append(max(target, cuts[-1] + 1))
    return cuts


def split_long_signal(
    df: DataFrame,
    key: str,
    wav: str,
    sr: float,
    max_chunk_sec: float,
    expand_sec: float = SEARCH_EXPAND_SECONDS,
    window_ms: float = MIN_WINDOW_MS,
) -> DataFrame:
    """(key, chunk_index, offset_sec, n_samples, wav): chunks of each signal cut at quiet points.

    The chunks partition the signal; a signal that was cut gets its chunks padded with zeros to half a second, while
    ``n_samples`` and the offsets stay those of the unpadded signal. One row in, its chunks out, no shuffle.
    """
    shortest = int(MIN_CHUNK_SECONDS * sr)

    def chunks_of(name, signal: np.ndarray) -> Iterator[tuple]:
        signal = np.asarray(signal, dtype=np.float32)
        if len(signal) / sr <= max_chunk_sec:
            yield name, 0, 0.0, len(signal), signal
            return
        cuts = cut_positions(signal, sr, max_chunk_sec, expand_sec, window_ms)
        ends = [*cuts[1:], len(signal)]
        offset = 0.0
        for i, (a, b) in enumerate(zip(cuts, ends)):
            part = signal[a:b]
            if b - a < shortest:
                part = np.pad(part, (0, shortest - (b - a)))
            yield name, i, offset, b - a, part
            offset += (b - a) / sr

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [c for k, w in zip(batch[key], batch[wav]) if w is not None for c in chunks_of(k, w)]
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "offset_sec", "n_samples", "wav"])

    schema = StructType(
        [
            df.schema[key],
            StructField("chunk_index", IntegerType()),
            StructField("offset_sec", DoubleType()),
            StructField("n_samples", IntegerType()),
            StructField("wav", ArrayType(FloatType())),
        ]
    )
    return df.select(key, wav).mapInPandas(run, schema)


def value_range_chunks(
    df: DataFrame, key: str, pos: str, value: str, size: int, block: Column, name: str = "range_chunk"
) -> DataFrame:
    """Chunk number of each row of an increasing list that is cut when a value reaches k * size, k rising by one per cut.

    The number grows by at most one per row even over a wide gap. It has the closed form
    ``pos + min(1, min over j <= pos of (floor(v_j / size) - j))``, a running minimum instead of a fold over the list.
    """
    lead = F.floor(F.col(value) / size) - F.col(pos)
    run = with_running(df, [key], [pos], block, lead, "_low", how="min")
    return run.withColumn(name, F.col(pos) + F.least(F.lit(1), F.col("_low"), lead)).drop("_low")


def range_bounds(df: DataFrame, key: str, pos: str, chunk: str = "range_chunk") -> DataFrame:
    """(start, end) index pairs, the end not included, per chunk."""
    return df.groupBy(key, chunk).agg(F.min(pos).alias("start"), (F.max(pos) + 1).alias("end"))
