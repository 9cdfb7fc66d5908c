"""Seeded shuffles, samples and splits that come out the same for every partitioning and engine.

The order is the digest of (seed, key), so a rerun, a retry or another cluster size gives the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.constants import EVAL_RATIO, SEED
from voxloom.functions.binding import bind
from voxloom.operators.ordered import contiguous_part, hash_block, with_position


def shuffle_key(key: Column, seed: int = SEED) -> Column:
    """Digest of seed and key; a null key has a digest of its own."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("\0"))).cast("binary"))


def seeded_shuffle(
    df: DataFrame, key: str, seed: int = SEED, name: str = "pos", total: str | None = None, digits: int = 3
) -> DataFrame:
    """Adds the position of each row in the shuffled order. No sort runs over more than one digest block."""
    keyed = df.withColumn("_digest", shuffle_key(F.col(key), seed))
    return with_position(keyed, [], ["_digest", key], hash_block(F.col("_digest"), digits), name, total).drop("_digest")


def with_shuffled_shard(df: DataFrame, key: str, shards: int, seed: int = SEED, name: str = "shard") -> DataFrame:
    """Adds the shard number of each row after the seeded shuffle: contiguous parts whose sizes differ by at most one.

    The positions are computed from the keys alone and only say where each shard begins. The cut points are kept by digest
    block: a row meets the one line of its block, with the shards that begin before the block and the few cuts inside
    it, so the work per row does not grow with the number of shards. The table of blocks has 16^digits lines and all cuts,
    which is what is broadcast. Rows that share a key share a shard.
    """
    digits = 3
    placed = seeded_shuffle(df.select(key), key, seed, "_pos", "_total", digits)
    part = contiguous_part(F.col("_pos"), F.col("_total"), shards)
    before = contiguous_part(F.col("_pos") - 1, F.col("_total"), shards)
    point = F.struct(shuffle_key(F.col(key), seed).alias("digest"), F.col(key).alias("key"))
    cuts = placed.where((F.col("_pos") > 0) & (part != before)).select(point.alias("cut"))
    inside = cuts.groupBy(hash_block(F.col("cut.digest"), digits).alias("_block")).agg(
        F.array_sort(F.collect_list("cut")).alias("_cuts"), F.count(F.lit(1)).alias("_n")
    )
    blocks = df.sparkSession.range(16**digits).select(F.col("id").alias("_block")).join(inside, "_block", "left")
    running = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    lines = blocks.select("_block", "_cuts", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_earlier"))
    met = df.withColumn("_block", hash_block(shuffle_key(F.col(key), seed), digits)).join(F.broadcast(lines), "_block")
    both = F.struct(F.col("_cuts").alias("cuts"), point.alias("mine"))
    passed = bind(both, lambda s: F.size(F.filter(s["cuts"], lambda cut: cut <= s["mine"])))
    found = F.col("_earlier") + F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(passed)
    return met.withColumn(name, found.cast("int")).drop("_block", "_cuts", "_earlier")


def sample_fixed(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): the first in the shuffled order, with the digest kept."""
    keyed = df.withColumn("digest", shuffle_key(F.col(key), seed))
    return keyed.orderBy("digest", key).limit(n)


def cut_point(df: DataFrame, key: str, ratio: float, seed: int = SEED, digits: int = 4) -> DataFrame:
    """One row: the last (digest, key) that belongs to the first ``ceil(ratio * rows)`` rows of the shuffled order.

    Rows are counted per digest block (at most 16^digits small rows), the block that holds the cut is found from the
    running count, and only that block is sorted. No other column of the table is read.
    """
    narrow = df.select(F.struct(shuffle_key(F.col(key), seed).alias("digest"), F.col(key).alias("key")).alias("k"))
    narrow = narrow.withColumn("_block", hash_block(F.col("k.digest"), digits))
    blocks = narrow.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(F.lit(0))
    running = F.sum("_size").over(whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0))
    want = F.ceil(F.round(F.sum("_size").over(whole) * F.lit(ratio), 9))
    marked = blocks.select("_block", "_size", running.alias("_end"), want.alias("_want"))
    target = marked.where((F.col("_end") >= F.col("_want")) & (F.col("_end") - F.col("_size") < F.col("_want")))
    place = target.select((F.col("_want") - F.col("_end") + F.col("_size")).alias("n")).scalar()
    inside = narrow.where(F.col("_block") == target.select("_block").scalar())
    ranked = inside.withColumn("_rank", F.row_number().over(Window.partitionBy("_block").orderBy("k")))
    return ranked.where(F.col("_rank") == place).select("k")


def train_eval_split(
    df: DataFrame, key: str, ratio: float = EVAL_RATIO, seed: int = SEED, name: str = "split"
) -> DataFrame:
    """Disjoint, repeatable split: adds ``train`` or ``eval`` to every row.

    The whole rows are never shuffled: they are compared with the cut point, a scalar. The number of eval rows is
    ``ceil(ratio * rows)`` where the keys are unique. Rows that share a key, a null key included, stay together, so copies
    of the key at the cut can add to it.
    """
    if not 0 < ratio < 1:
        raise ValueError(f"ratio must be between 0 and 1, got {ratio}")
    cut = cut_point(df, key, ratio, seed).scalar()
    mine = F.struct(shuffle_key(F.col(key), seed).alias("digest"), F.col(key).alias("key"))
    return df.withColumn(name, F.when(mine <= cut, F.lit("eval")).otherwise(F.lit("train")))


def eval_rows(n: int, ratio: float = EVAL_RATIO) -> int:
    return math.ceil(round(n * ratio, 9))
