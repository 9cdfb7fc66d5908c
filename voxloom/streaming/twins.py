"""Batch counterparts of the stream operators: the same results from a stored table, with no key held by one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.constants import RECOGNITION_LANGUAGES, SAMPLE_RATE, SESSION_TTL_SECONDS
from voxloom.functions.language import forced_language
from voxloom.operators.ordered import fitting_seconds, micros, time_block, with_position, with_previous, with_running


def initial_states(
    df: DataFrame, session: str, chunk_seconds: Column, language: Column, context: Column, sr: int = SAMPLE_RATE
) -> DataFrame:
    """One checked initial state per session; a chunk length of zero or less or an unknown language is an error."""
    checked = F.when(chunk_seconds > 0, chunk_seconds).otherwise(F.raise_error(F.lit("chunk seconds must be above 0")))
    return df.select(
        session,
        F.lit(0).alias("chunk_id"),
        F.greatest(F.lit(1), F.bround(checked * sr).cast("int")).alias("chunk_samples"),
        F.coalesce(context, F.lit("")).alias("context"),
        forced_language(language, RECOGNITION_LANGUAGES).alias("force_language"),
        F.lit("").alias("language"),
        F.lit("").alias("text"),
        F.array().cast("array<float>").alias("buffer"),
    )


def chunk_buffer(
    df: DataFrame, session: str, ts: str, order: Sequence[str], value: str, size: int, tail: bool = False
) -> DataFrame:
    """(session, chunk_id, n_new, sum_new): full chunks of ``size`` samples in arrival order, with the tail on demand."""
    narrow = df.select(session, ts, *[c for c in order if c != ts], value)
    block = time_block(F.col(ts), fitting_seconds(narrow, [session], ts))
    placed = with_position(narrow, [session], order, block)
    chunks = placed.groupBy(session, F.floor(F.col("pos") / size).alias("chunk_id")).agg(
        F.count(F.lit(1)).alias("n_new"), F.sum(F.col(value).cast("float").cast("double")).alias("sum_new")
    )
    return chunks if tail else chunks.where(F.col("n_new") == size)


def cumulative(chunks: DataFrame, session: str, block: int = 4096) -> DataFrame:
    """What each step has seen so far: the chunks up to and including its own."""
    blocks = F.floor(F.col("chunk_id") / block)
    seen = with_running(chunks, [session], ["chunk_id"], blocks, F.col("n_new"), "_n")
    seen = with_running(seen, [session], ["chunk_id"], blocks, F.col("sum_new"), "_s")
    return (
        seen.withColumn("n_seen", F.col("_n") + F.col("n_new"))
        .withColumn("sum_seen", F.col("_s") + F.col("sum_new"))
        .drop("_n", "_s")
    )


def idle_sessions(
    df: DataFrame, key: str, ts: str, order: Sequence[str], ttl_seconds: float = SESSION_TTL_SECONDS
) -> DataFrame:
    """(key, session, started, ended, n): a gap of more than the limit ends a session; a gap of just the limit does not."""
    narrow = df.select(key, ts, *[c for c in order if c != ts])
    block = time_block(F.col(ts), fitting_seconds(narrow, [key], ts))
    gaps = with_previous(narrow, [key], order, block, F.col(ts), "_before")
    late = (micros(F.col(ts)) - micros(F.col("_before"))) > int(ttl_seconds * 1_000_000)
    opened = gaps.withColumn("_opens", F.coalesce(late.cast("int"), F.lit(0)))
    numbered = with_running(opened, [key], order, block, F.col("_opens"), "_earlier")
    return numbered.groupBy(key, (F.col("_earlier") + F.col("_opens")).alias("session")).agg(
        F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count(F.lit(1)).alias("n")
    )
