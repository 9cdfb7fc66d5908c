"""Cuts at quiet points for signals that are stored as blocks of samples, one row per block.

Every cut depends on the one before, but where the next cut falls depends on the start of a chunk only, and on no more
samples than one chunk can have. So a signal is dealt into stretches, each with the head of the next, and every stretch
makes a table: from each of its positions, where is the first cut behind this stretch? Neighbouring starts mostly share
their next quiet point, so such a table is a few runs of starts. Tables of neighbours are put together by pointer
doubling: after k rounds a table leads over 2^k stretches, and the tables that begin with the signal know where its
chunks enter each stretch. From there every stretch lists its own cuts.

No task sees more than a stretch and the samples of the longest chunk, and the rounds move tables and no samples.

Defined results: the blocks of a signal follow each other without gaps, in any order of rows, of any and different
lengths. Rows without samples or without a start are left out; a signal of empty blocks is one chunk of no samples. A
null key is a signal like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from voxloom.constants import MIN_CHUNK_SECONDS, MIN_WINDOW_MS, SEARCH_EXPAND_SECONDS
from voxloom.operators.ordered import with_running
from voxloom.operators.windows import window_size
from voxloom.session import materialize, release_since, written

#: Samples of a stretch, if a chunk cannot be longer.
STRETCH = 1 << 20
NO_CUT = -1


def first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value of every ``width`` consecutive ones, by ranges that double."""
    at, span = np.arange(len(values)), 1
    while 2 * span <= width:
        left, right = at[:-span], at[span:]
        at = np.where(values[right] < values[left], right, left)
        span *= 2
    left, right = at[: len(values) - width + 1], at[width - span :]
    return np.where(values[right] < values[left], right, left)


def next_cuts(loud: np.ndarray, own: int, longest: int, expand: int, win: int) -> np.ndarray:
    """For a chunk that starts at 0, 1, .. ``own`` - 1: where it ends by a cut, or ``NO_CUT`` if it ends with the signal.

    ``loud`` goes on behind the own samples for ``longest + expand`` samples, or to the end of the signal.
    """
    starts = np.arange(own)
    cuts = starts + longest
    low = starts + max(0, longest - expand)
    width = min(longest, expand) + expand
    if len(loud) >= win and width > win:
        upto = np.concatenate([[0.0], np.cumsum(loud, dtype=np.float64)])
        # rounded, so that equal energies tie; windows over the end of the signal are never the quietest
        energy = np.full(max(len(loud), int(low[-1]) + width), np.inf)
        energy[: len(loud) - win + 1] = np.round(upto[win:] - upto[:-win], 9)
        quiet = first_minima(energy, width - win + 1)[low]
        searched = len(loud) - low > win
        cuts[searched] = first_minima(loud, win)[quiet[searched]]
    return np.where(len(loud) - starts > longest, np.maximum(cuts, starts + 1), NO_CUT)


def leaving(cuts: np.ndarray) -> np.ndarray:
    """From each start the first cut behind the stretch, counted from its end; ``NO_CUT`` if there is none."""
    out, own = cuts.copy(), len(cuts)
    while True:
        inside = (out >= 0) & (out < own)
        if not inside.any():
            return np.where(out >= 0, out - own, NO_CUT)
        out[inside] = out[out[inside]]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, values[first]


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _parts(df: DataFrame, key: str, start: str, samples: str, stretch: int) -> DataFrame:
    """(key, _g, _at, _part): blocks cut at the borders of the stretches; an empty block stays as an empty part."""
    begin, size = F.col("_start"), F.size("_samples")
    rows = df.select(F.col(key), F.col(start).cast("bigint").alias("_start"), F.col(samples).cast("array<float>").alias("_samples"))
    rows = rows.where(F.col("_start").isNotNull() & F.col("_samples").isNotNull())
    last = F.floor((begin + F.greatest(size, F.lit(1)) - 1) / stretch)
    rows = rows.withColumn("_g", F.explode(F.sequence(F.floor(begin / stretch), last)))
    at = F.greatest(begin, F.col("_g") * stretch)
    stop = F.least(begin + size, (F.col("_g") + 1) * stretch)
    part = F.slice("_samples", (at - begin + 1).cast("int"), F.greatest(stop - at, F.lit(0)).cast("int"))
    return rows.select(key, "_g", at.alias("_at"), part.alias("_part"))


def _tables(parts: DataFrame, key: str, stretch: int, longest: int, expand: int, win: int) -> DataFrame:
    """(key, _g, _n, _from, _next, _starts, _exits): per stretch its next cuts and the cuts behind it, as runs of starts.

    ``_n`` is where the samples end that the stretch has seen: the end of the signal, if that is in sight.
    """
    reach = longest + expand
    into = F.col("_at") - F.col("_g") * stretch
    lent = (F.col("_g") > 0) & (into < reach) & (F.size("_part") > 0)
    shared = parts.withColumn("_to", F.explode(F.when(lent, F.array("_g", F.col("_g") - 1)).otherwise(F.array("_g"))))
    head = F.slice("_part", F.lit(1), F.greatest(F.lit(reach) - into, F.lit(0)).cast("int"))
    shared = shared.select(key, F.col("_to").alias("_g"), "_at", F.when(F.col("_to") == F.col("_g"), F.col("_part")).otherwise(head).alias("_part"))

    def table_of(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        g = int(group[1])
        base = g * stretch
        n = max(at + len(part) for at, part in zip(rows["_at"], rows["_part"]))
        loud = np.zeros(n - base, np.float32)
        for at, part in zip(rows["_at"], rows["_part"]):
            loud[at - base : at - base + len(part)] = np.abs(np.asarray(part, np.float32))
        own = max(1, min(stretch, len(loud)))
        cuts = next_cuts(loud, own, longest, expand, win)
        # chunks enter the first stretch at its first sample only
        exits = leaving(cuts)[:1] if g == 0 else leaving(cuts)
        return pd.DataFrame([(group[0], g, n, *_runs(cuts), *_runs(exits))], columns=schema.names)

    ints = ArrayType(IntegerType())
    schema = StructType(
        [shared.schema[key], StructField("_g", LongType()), StructField("_n", LongType())]
        + [StructField(name, ints) for name in ("_from", "_next", "_starts", "_exits")]
    )
    return shared.groupBy(key, "_g").applyInPandas(table_of, schema)


def _followed(exits: pd.Series, starts: pd.Series, following: pd.Series) -> pd.Series:
    """Where the exits of one table lead by the next one."""

    def lead(e: np.ndarray, s: np.ndarray, f: np.ndarray) -> np.ndarray:
        e = np.asarray(e)
        return np.where(e >= 0, np.asarray(f)[np.searchsorted(s, e, "right") - 1], NO_CUT)

    return pd.Series([None if e is None else lead(e, s, f) for e, s, f in zip(exits, starts, following)], dtype=object)


def _doubled(tables: DataFrame, key: str) -> DataFrame:
    """(key, _g, _starts, _exits): the tables of the stretches from the first of the signal up to each."""
    spark, followed = tables.sparkSession, F.pandas_udf(_followed, ArrayType(IntegerType()))
    last = tables.agg(F.max("_g")).first()[0] or 0
    done, step = tables.select(key, "_g", "_starts", "_exits"), 1
    while step <= last:
        mark = written()
        before = done.select(F.col(key).alias("_key"), (F.col("_g") + step).alias("_h"), F.col("_starts").alias("_s"), F.col("_exits").alias("_e"))
        both = done.join(before, _same(key, "_key") & (F.col("_g") == F.col("_h")), "left")
        led = F.when(F.col("_e").isNull(), F.col("_exits")).otherwise(followed("_e", "_starts", "_exits"))
        done = materialize(both.select(key, "_g", F.coalesce("_s", "_starts").alias("_starts"), led.alias("_exits")), "cut-tables")
        if step > 1:
            release_since(spark, mark - 1, done)
        step *= 2
    return done


def block_cuts(
    df: DataFrame, key: str, start: str, samples: str, sr: float, max_chunk_sec: float,
    expand_sec: float = SEARCH_EXPAND_SECONDS, window_ms: float = MIN_WINDOW_MS, stretch: int = STRETCH,
) -> DataFrame:
    """(key, chunk_index, start, n_samples): where ``split_long_signal`` cuts signals whose blocks are (key, start, samples).

    ``start`` is the number of a block's first sample in its signal.
    """
    longest, expand, win = int(max_chunk_sec * sr), int(expand_sec * sr), window_size(sr, window_ms)
    # a chunk never passes a whole stretch
    stretch = max(stretch, longest + expand)
    parts = _parts(df, key, start, samples, stretch)
    tables = materialize(_tables(parts, key, stretch, longest, expand, win), "cut-stretches")
    reached = _doubled(tables, key)
    entered = reached.select(F.col(key).alias("_key"), (F.col("_g") + 1).alias("_h"), F.get("_exits", F.lit(0)).alias("_entry"))
    first = F.col("_g") == 0
    stretches = tables.select(key, "_g", "_n", "_from", "_next")
    known = stretches.join(entered, _same(key, "_key") & (F.col("_g") == F.col("_h")), "left").drop("_key", "_h")
    known = known.withColumn("_entry", F.when(first, 0).otherwise(F.col("_entry"))).where("_entry >= 0")

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, g, n, starts, following, at in batch[[key, "_g", "_n", "_from", "_next", "_entry"]].itertuples(index=False):
                base, own = g * stretch, max(1, min(stretch, n - g * stretch))
                while 0 <= at < own:
                    cut = following[np.searchsorted(starts, at, "right") - 1]
                    rows.append((name, g, base + at, (base + cut if cut >= 0 else n) - (base + at)))
                    at = cut
            yield pd.DataFrame(rows, columns=schema.names)

    schema = StructType([df.schema[key], *[StructField(name, LongType()) for name in ("_g", "start", "n_samples")]])
    cuts = known.mapInPandas(walked, schema)
    numbered = with_running(cuts, [key], ["start"], F.col("_g"), F.lit(1).cast("bigint"), "chunk_index")
    return numbered.select(key, F.col("chunk_index").cast("int").alias("chunk_index"), "start", "n_samples")


def split_blocks(
    df: DataFrame, key: str, start: str, samples: str, sr: float, max_chunk_sec: float,
    expand_sec: float = SEARCH_EXPAND_SECONDS, window_ms: float = MIN_WINDOW_MS, stretch: int = STRETCH,
) -> DataFrame:
    """(key, chunk_index, offset_sec, n_samples, wav): the chunks of ``split_long_signal`` for signals stored as blocks.

    The parts of a chunk meet by chunk, so the longest chunk is the longest value.
    """
    longest, expand = int(max_chunk_sec * sr), int(expand_sec * sr)
    stretch = max(stretch, longest + expand)
    cuts = materialize(block_cuts(df, key, start, samples, sr, max_chunk_sec, expand_sec, window_ms, stretch), "chunk-cuts")
    end = F.col("start") + F.col("n_samples")
    touched = F.sequence(F.floor(F.col("start") / stretch), F.floor(F.greatest(end - 1, F.col("start")) / stretch))
    spans = cuts.select(F.col(key).alias("_key"), "chunk_index", "start", "n_samples", F.explode(touched).alias("_h"))
    parts = _parts(df, key, start, samples, stretch)
    met = spans.join(parts, _same("_key", key) & (F.col("_h") == F.col("_g")))
    begin = F.greatest("start", "_at")
    stop = F.least(end, F.col("_at") + F.size("_part"))
    piece = F.slice("_part", (begin - F.col("_at") + 1).cast("int"), F.greatest(stop - begin, F.lit(0)).cast("int"))
    pieces = met.where((stop > begin) | (F.col("n_samples") == 0)).select(
        key, "chunk_index", "start", "n_samples", F.struct(begin.alias("at"), piece.alias("x")).alias("_piece")
    )
    chunks = pieces.groupBy(key, "chunk_index", "start", "n_samples").agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    whole = F.flatten(F.transform("_pieces", lambda p: p["x"]))
    # only chunks of a signal that was cut are padded; one of these is shorter than the longest or not the first
    cut = (F.col("chunk_index") > 0) | F.col("_more")
    shortest = int(MIN_CHUNK_SECONDS * sr)
    missing = F.greatest(F.lit(shortest) - F.col("n_samples"), F.lit(0)).cast("int")
    padded = F.concat(whole, F.array_repeat(F.lit(0.0).cast("float"), missing))
    several = cuts.where("chunk_index = 1").select(F.col(key).alias("_key"), F.lit(True).alias("_m"))
    chunks = chunks.join(several, _same(key, "_key"), "left").withColumn("_more", F.coalesce("_m", F.lit(False)))
    return chunks.select(
        key, "chunk_index", (F.col("start") / F.lit(float(sr))).alias("offset_sec"), F.col("n_samples").cast("int").alias("n_samples"),
        F.when(cut, padded).otherwise(whole).alias("wav"),
    )
