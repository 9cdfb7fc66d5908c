"""The offline recognition chain as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.constants import (
    MAX_ALIGNMENT_SECONDS,
    MAX_RECOGNITION_SECONDS,
    RECOGNITION_LANGUAGES,
    SAMPLE_RATE,
    SEARCH_EXPAND_SECONDS,
)
from voxloom.functions.language import forced_language, parse_model_output
from voxloom.functions.signal import normalize_waveform
from voxloom.functions.text import encode_alignment_text, words_by_language
from voxloom.operators.aggregates import merge_alignments, merge_chunk_text, merge_languages
from voxloom.operators.filters import build_prompt
from voxloom.operators.hooks import alignable, align_batches, transcribe_batches
from voxloom.operators.joins import gather_results, scatter_to_chunks
from voxloom.operators.windows import split_long_signal
from voxloom.session import materialize


def transcribe(
    recordings: DataFrame,
    key: str,
    template: str,
    recogniser: Callable,
    aligner: Callable | None = None,
    max_chunk_sec: float | None = None,
    expand_sec: float = SEARCH_EXPAND_SECONDS,
    target_sr: int = SAMPLE_RATE,
    batch_size: int = 32,
    segment_ms: float = 80.0,
) -> DataFrame:
    """(key, language, text, time_stamps) per recording.

    ``recordings`` has key, channels (array of arrays), sr, context and language (null for automatic). Chunks shorter
    than the limit of the aligner are made when timestamps are wanted. The model outputs are written to the shared
    folder before they are merged, so the recogniser runs once although three merges read its results.
    """
    limit = max_chunk_sec or (MAX_ALIGNMENT_SECONDS if aligner else MAX_RECOGNITION_SECONDS)
    waves = recordings.select(
        key, normalize_waveform(F.col("channels"), F.col("sr"), target_sr).alias("signal")
    )
    arguments = recordings.select(
        key, "context", forced_language(F.col("language"), RECOGNITION_LANGUAGES).alias("forced")
    )
    chunks = split_long_signal(waves, key, "signal", target_sr, limit, expand_sec)
    chunks = scatter_to_chunks(chunks, arguments, key).withColumn(
        "prompt", build_prompt(F.col("context"), F.col("forced"), template)
    )
    carried = [key, "chunk_index", "offset_sec", "forced", *(["wav"] if aligner else [])]
    raw = transcribe_batches(chunks, carried, "prompt", "wav", recogniser, batch_size)
    parsed = materialize(parse_model_output(raw, "raw", "forced", "language", "text"), "chunks")
    if aligner:
        words = alignable(parsed, "text").withColumn("words", words_by_language(F.col("text"), F.col("language")))
        words = words.withColumn("encoded", encode_alignment_text(F.col("words")))
        spans = align_batches(
            words, [key, "chunk_index"], "wav", "words", "encoded", aligner, segment_ms, "offset_sec", batch_size
        )
        parsed = gather_results(parsed.drop("wav"), spans, key, "chunk_index")
    text = merge_chunk_text(parsed, key, "chunk_index", "text").withColumnRenamed("merged_text", "text")
    language = merge_languages(parsed, key, "chunk_index", "language").withColumnRenamed("languages", "language")
    done = text.join(language, key)
    if aligner:
        return done.join(merge_alignments(parsed, key, "chunk_index", "time_stamps"), key)
    return done
