"""Aggregations: corpus statistics, detector scores, and the merge of chunk results back to samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from voxloom.functions.text import trim_py
from voxloom.operators.ordered import collect_in_order, value_block, with_previous


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent; 0 where there is nothing to share."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(part * 100.0 / whole, digits))


def distribution(df: DataFrame, *keys: str) -> DataFrame:
    """Rows and percent per key. The total is taken over the counts, not over the rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("pct", percent(F.col("n"), total))


def filter_summary(df: DataFrame, keep: Column) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(keep).alias("kept"), F.count_if(~keep).alias("removed")
    ).withColumn("removed_pct", percent(F.col("removed"), F.col("total")))


def reject_counts(df: DataFrame, reason: str = "reason") -> DataFrame:
    r = F.col(reason)
    return df.agg(
        F.count_if(r.isNull()).alias("kept"),
        F.count_if(r.isNotNull()).alias("rejected"),
        F.count_if(r == "repetition").alias("rejected_repetition"),
    )


def rejected_range(df: DataFrame, measure: str, rejected: Column) -> DataFrame:
    """Smallest and largest measure of the rejected rows; failed rows (measure <= 0) do not count."""
    m = F.when(rejected & (F.col(measure) > 0), F.col(measure))
    return df.agg(F.min(m).alias("low"), F.max(m).alias("high"))


def code_matches(predicted: Column, expected: Column, symmetric: bool = False) -> Column:
    """Equal, or the prediction starts with the base of the expected code.

    ``symmetric`` also accepts an expected code that starts with the base of the prediction, which makes an empty
    prediction correct.
    """
    base = F.substring_index(expected, "-", 1)
    hit = (predicted == expected) | F.startswith(predicted, base)
    if symmetric:
        hit = hit | F.startswith(expected, F.substring_index(predicted, "-", 1))
    return F.coalesce(hit, F.lit(False))


def detector_accuracy(grid: DataFrame, keys: Sequence[str], measure: str, symmetric: bool = False) -> DataFrame:
    """Correct, total, percent and the spread of a measured column per detector (and language)."""
    hit = code_matches(F.col("predicted"), F.col("expected_code"), symmetric)
    return grid.groupBy(*keys).agg(
        F.count_if(hit).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.round(F.avg(hit.cast("int")) * 100, 1).alias("accuracy_pct"),
        F.round(F.avg(measure), 3).alias("avg_measure"),
        F.min(measure).alias("min_measure"),
        F.max(measure).alias("max_measure"),
    )


#: Shares of the calls for which times are given.
LATENCY_RANKS = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}


def latency_sketches(calls: DataFrame, keys: Sequence[str], nanos: str = "nanos") -> DataFrame:
    """Calls, sum, least and largest time, and a mergeable sketch of all times, per detector. Every partition makes sketches of
    its own calls, which are merged; calls that did not take place have no time."""
    took = calls.where(F.col(nanos).isNotNull())
    return took.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"), F.sum(nanos).alias("sum_nanos"), F.min(nanos).alias("min_nanos"), F.max(nanos).alias("max_nanos"),
        F.kll_sketch_agg_bigint(nanos).alias("sketch"),
    )


def merged_latencies(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of several runs put together; merging is all that is needed, the calls are not."""
    return sketches.groupBy(*keys).agg(
        F.sum("calls").alias("calls"), F.sum("sum_nanos").alias("sum_nanos"), F.min("min_nanos").alias("min_nanos"),
        F.max("max_nanos").alias("max_nanos"), F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )


def latency_summary(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, calls, avg_ms, min_ms, max_ms, p50_ms, p95_ms, p99_ms) of one row of sketches per key."""
    milli = lambda c: c / F.lit(1e6)
    ranks = [milli(F.kll_sketch_get_quantile_bigint("sketch", F.lit(rank))).alias(name) for name, rank in LATENCY_RANKS.items()]
    return sketches.select(
        *keys, "calls", milli(F.col("sum_nanos") / F.col("calls")).alias("avg_ms"), milli(F.col("min_nanos")).alias("min_ms"),
        milli(F.col("max_nanos")).alias("max_ms"), *ranks,
    )


def observed_calls(calls: DataFrame, name: str, nanos: str = "nanos", error: str = "error") -> tuple[DataFrame, Observation]:
    """The table with counters that fill while it is consumed for whatever purpose: calls, failures and their time in all."""
    watch = Observation(name)
    return calls.observe(
        watch, F.count(nanos).alias("calls"), F.count_if(F.col(error).isNotNull()).alias("failed"),
        F.coalesce(F.sum(nanos), F.lit(0)).alias("nanos"),
    ), watch


def best_detector(scores: DataFrame, rank: str) -> DataFrame:
    """Fastest (smallest average) and most accurate detector; on a tie the smaller rank wins."""
    ratio = F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(F.lit(0.0))
    return scores.agg(
        F.min_by("detector", F.struct(F.col("avg_measure"), F.col(rank))).alias("fastest"),
        F.max_by("detector", F.struct(ratio, -F.col(rank))).alias("most_accurate"),
    )


def merge_chunk_text(df: DataFrame, sample: str, chunk: str, text: str, block: Column | None = None) -> DataFrame:
    """Chunk texts of a sample in chunk order, with nothing in between."""
    block = value_block(F.col(chunk)) if block is None else block
    merged = collect_in_order(df, [sample], chunk, block, text, "_texts")
    return merged.select(sample, F.array_join("_texts", "").alias("merged_text"))


def merge_languages(df: DataFrame, sample: str, chunk: str, language: str, block: Column | None = None) -> DataFrame:
    """Languages of a sample in chunk order without blanks and without repeats of the one before, comma separated.

    Only the rows where the language changes are collected.
    """
    block = value_block(F.col(chunk)) if block is None else block
    named = df.select(sample, chunk, trim_py(F.coalesce(F.col(language), F.lit(""))).alias("_lang"))
    seen = with_previous(
        named.where(F.col("_lang") != ""), [sample], [chunk], block, F.col("_lang"), "_prev"
    )
    changes = seen.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_lang")))
    merged = collect_in_order(changes, [sample], chunk, block, "_lang", "_langs")
    joined = merged.select(sample, F.array_join("_langs", ",").alias("languages"))
    # a sample without any language keeps an empty string
    return (
        df.select(sample).distinct().join(joined, sample, "left")
        .withColumn("languages", F.coalesce("languages", F.lit("")))
    )


def merge_alignments(df: DataFrame, sample: str, chunk: str, spans: str, block: Column | None = None) -> DataFrame:
    """Span lists of a sample one after the other in chunk order; null when there is no span at all."""
    block = value_block(F.col(chunk)) if block is None else block
    lists = df.withColumn("_spans", F.coalesce(F.col(spans), F.array()))
    merged = collect_in_order(lists, [sample], chunk, block, "_spans", "_all")
    flat = F.flatten("_all")
    return merged.select(sample, F.when(F.size(flat) > 0, flat).alias("time_stamps"))
