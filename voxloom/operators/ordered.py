"""Ordered computations that do not gather a whole key in one task.

A plain window over a hot key puts all its rows in one task. Here a key is cut into blocks along its order: every block
is handled by itself, block summaries (one row per block) are combined with a small window, and the result is joined
back. ``block`` is any column that never decreases along ``order`` inside a key; it decides how many rows one task sees.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for timestamps with and without a zone (the session zone should be UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def time_block(ts: Column, seconds: int = 86400) -> Column:
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000))


def fitting_seconds(df: DataFrame, keys: Sequence[str], ts: str, rows: int = 2_000_000, longest: int = 86400) -> int:
    """Block length in seconds at which the fullest block of the hottest key holds about ``rows`` rows.

    One narrow count per key and longest block, combined before its shuffle; a single number comes back.
    """
    counts = df.groupBy(*keys, time_block(F.col(ts), longest).alias(BLOCK)).agg(F.count(F.lit(1)).alias("n"))
    fullest = counts.agg(F.max("n")).first()[0] or 0
    return max(1, longest // max(1, -(-fullest // rows)))


def value_block(value: Column, width: int = 65536) -> Column:
    """Blocks of a fixed width; the values of a key should lie close together."""
    return F.floor(value / width)


def _at_most(borders: Sequence, value: Column, kind: str) -> Column:
    """How many of the sorted borders are at most ``value``, by bisection of a literal array."""
    literal = F.expr(f"array({', '.join(f'{b}BD' if isinstance(b, Decimal) else repr(b) for b in borders)})").cast(f"array<{kind}>")
    count = len(borders)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(count.bit_length()))])

    def narrowed(low: Column, step: Column) -> Column:
        # a border past the end is null, which is never reached
        return F.when(F.get(literal, low + step - 1) <= value, low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0), narrowed)


def range_block(df: DataFrame, column: str, blocks: int = 4096) -> Column:
    """At most ``blocks`` blocks of about equal numbers of rows (and one for nulls), whatever the numbers are like.

    The borders are quantiles from a summary that every partition makes of its own values and that are merged, with an
    error of a quarter of a block. They come back once, at most ``blocks`` numbers, and are looked up by bisection.
    Equal values share a block, so the column should be a key.
    """
    marks = ", ".join(f"{k / blocks!r}D" for k in range(1, blocks))
    found = df.agg(F.expr(f"approx_percentile(`{column}`, array({marks}), {4 * blocks})").alias("borders")).first()[0]
    borders = sorted(set(found or ()))
    here = _at_most(borders, F.col(column), df.schema[column].dataType.simpleString()) if borders else F.lit(0)
    return F.when(F.col(column).isNotNull(), here).cast("bigint")


def hash_block(digest: Column, digits: int = 3) -> Column:
    """Leading hexadecimal digits of a digest: blocks of even size without any sampling of the data."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def _attach(df: DataFrame, bases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Block summaries onto the rows of their block. A null key or block is a value like any other."""
    names = {c: f"_on_{i}" for i, c in enumerate([*keys, BLOCK])}
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return df.join(bases.withColumnsRenamed(names), same).drop(*names.values())


def _before(keys: Sequence[str]):
    window = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def _whole(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, name: str = "pos", total: str | None = None
) -> DataFrame:
    """0-based position of each row in its key, and optionally the number of rows of the key."""
    keys = list(keys)
    df = df.withColumn(BLOCK, block)
    sizes = df.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_size"))
    bases = sizes.withColumn("_base", F.coalesce(F.sum("_size").over(_before(keys)), F.lit(0)))
    if total:
        bases = bases.withColumn(total, F.sum("_size").over(_whole(keys)))
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    return (
        _attach(df, bases.drop("_size"), keys)
        .withColumn(name, F.col("_base") + F.row_number().over(inside) - 1)
        .drop("_base", BLOCK)
    )


def with_running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: Column, name: str, how: str = "sum"
) -> DataFrame:
    """Sum (or min) of ``value`` over the earlier rows of the key, the row itself not included."""
    keys = list(keys)
    fold = {"sum": F.sum, "min": F.min}[how]
    df = df.withColumn(BLOCK, block).withColumn("_value", value)
    parts = df.groupBy(*keys, BLOCK).agg(fold("_value").alias("_part"))
    bases = parts.withColumn("_base", fold("_part").over(_before(keys))).drop("_part")
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = fold("_value").over(inside)
    if how == "sum":
        result = F.coalesce(F.col("_base"), F.lit(0)) + F.coalesce(local, F.lit(0))
    else:
        result = F.least(F.col("_base"), local)
    return _attach(df, bases, keys).withColumn(name, result).drop("_base", "_value", BLOCK)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, value: Column, name: str = "prev",
    known: str | None = None,
) -> DataFrame:
    """``value`` of the row before, also across block borders; null for the first row of a key.

    ``known`` adds whether there is a row before, which a null value does not tell.
    """
    keys = list(keys)
    df = df.withColumn(BLOCK, block).withColumn("_value", value)
    # the last row of a block is the greatest by the order columns
    lasts = df.groupBy(*keys, BLOCK).agg(F.struct(F.max_by("_value", F.struct(*order)).alias("v")).alias("_last"))
    by_block = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(BLOCK)
    carried = lasts.withColumn("_carry", F.lag("_last").over(by_block)).drop("_last")
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    first = F.row_number().over(inside) == 1
    out = _attach(df, carried, keys).withColumn(
        name, F.when(first, F.col("_carry.v")).otherwise(F.lag("_value").over(inside))
    )
    if known:
        out = out.withColumn(known, F.col("_carry").isNotNull() | ~first)
    return out.drop("_carry", "_value", BLOCK)


def collect_in_order(df: DataFrame, keys: Sequence[str], order: str, block: Column, value: str, name: str) -> DataFrame:
    """One array per key in order. Blocks are collected and sorted on their own; only sorted blocks meet in the end,
    so no task sorts a whole key (the array itself is the result and has to fit one row)."""
    blocks = (
        df.withColumn(BLOCK, block)
        .groupBy(*keys, BLOCK)
        .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_items"))
    )
    whole = blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(BLOCK, "_items"))).alias("_blocks"))
    flat = F.flatten(F.transform("_blocks", lambda b: F.transform(b["_items"], lambda x: x["v"])))
    return whole.select(*keys, flat.alias(name))


def contiguous_part(position: Column, total: Column, parts: int) -> Column:
    """Part number for ``parts`` contiguous parts whose sizes differ by at most one, the larger ones first.

    With fewer rows than parts every row is a part of its own.
    """
    n = F.least(F.lit(parts).cast("bigint"), total)
    small = F.floor(total / n)
    larger = total % n
    border = larger * (small + 1)
    return F.when(position < border, F.floor(position / (small + 1))).otherwise(
        larger + F.floor((position - border) / small)
    )


def batch_number(position: Column, size: int) -> Column:
    """Consecutive batches of ``size`` rows; a size of zero or less means one batch."""
    return F.lit(0).cast("bigint") if size <= 0 else F.floor(position / size)
