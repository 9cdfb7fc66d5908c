"""Feeding a stored table to a stream, at once or in pieces."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.ordered import fitting_seconds, time_block, with_position
from voxloom.session import scratch_path
from voxloom.sources.pieces import read_pieces, write_pieces
from voxloom.streaming.sessions import GROUPS, StreamSettings, run_available, stream_steps


def read_table_stream(df: DataFrame, folder: str, pattern: str = "*.parquet", batch_bytes: int = 1 << 30) -> DataFrame:
    """The files of a stored table as a stream with the schema of ``df``.

    A batch takes files up to a limit in bytes. The limit decides how much a batch brings, not what comes out.
    """
    reader = df.sparkSession.readStream.schema(df.schema).option("pathGlobFilter", pattern)
    return reader.option("maxBytesPerTrigger", str(batch_bytes)).parquet(folder)


def numbered_samples(df: DataFrame, key: str, ts: str, order: Sequence[str], value: str, end: bool = False) -> DataFrame:
    """(key, number, value, end): samples numbered per session in time order, with one closing row per session on demand.

    A sender numbers its samples itself; this is for stored tables.
    """
    narrow = df.select(key, ts, *[c for c in order if c != ts], value)
    block = time_block(F.col(ts), fitting_seconds(narrow, [key], ts))
    placed = with_position(narrow, [key], order, block, "number")
    samples = placed.select(key, F.col("number").cast("bigint").alias("number"), value, F.lit(False).alias("end"))
    if not end:
        return samples
    closing = narrow.groupBy(key).agg(F.count(F.lit(1)).alias("number")).select(
        key, "number", F.lit(None).cast("double").alias(value), F.lit(True).alias("end")
    )
    return samples.unionByName(closing)


def piece_of(number: Column, end: Column, size: int) -> Column:
    """Piece of a sample when a session is fed in pieces of ``size`` samples; the closing row has a piece of its own behind them."""
    return F.when(end, F.ceil(number / size)).otherwise(F.floor(number / size)).cast("bigint")


def replay(
    samples: DataFrame, size: int, key: str, settings: StreamSettings, factory: Callable, out: str | None = None,
    checkpoint: str | None = None, folder: str | None = None,
) -> DataFrame:
    """Feed whole numbered sessions to one stream, ``size`` samples of every session a trigger, and give all its steps.

    The pieces are written once, as numbered pieces of a stored table; the run reads one of them per trigger, in order, until
    none is left. Closing rows, where ``samples`` has them, come in a piece of their own and flush the tails.

    Every trigger opens and commits all partitions of the state and starts a worker for each, however little it brings, so
    there are two for each core and no more than the session has shuffle partitions or the state has groups.
    """
    spark = samples.sparkSession
    folder = folder or scratch_path(spark, "replay-in")
    cores = max(1, spark.sparkContext.defaultParallelism)
    # a file is a task of the trigger that reads it
    write_pieces(samples, folder, piece_of(F.col("number"), F.col("end"), size), files=min(max(4, cores), 64))
    stream = stream_steps(read_pieces(spark, samples.schema, folder), key, "number", settings, factory)
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * cores, GROUPS)
    return run_available(stream, "replay", out, checkpoint, parts, paced=True)
