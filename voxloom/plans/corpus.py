"""The corpus job: raw chat-style samples to a validated, tagged, filtered, sharded and split training set."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.constants import CORPUS_CODES, EVAL_RATIO, NO_LANGUAGE, SEED
from voxloom.functions.text import extract_transcript, format_training_text
from voxloom.operators.detect import combined_language, script_language, trigram_language
from voxloom.operators.filters import (
    first_assistant_turn,
    first_audio_path,
    is_valid_sample,
    join_base_path,
    rejected_rows,
    with_reject_reason,
    within_duration,
)
from voxloom.operators.sampling import train_eval_split
from voxloom.sources.writers import export_splits, write_parquet_shards, write_rejected, write_undetected


def with_language(rows: DataFrame, text: str, profile: DataFrame, labels: Sequence[str], name: str = "language") -> DataFrame:
    """Language name of each row: by script, and for Latin letters by a trigram profile of ``labels``. A code that the corpus
    does not map gives the no-language name. One pass; the other columns go along."""
    keyed = rows.select("*", F.monotonically_increasing_id().alias("_id"), script_language(F.col(text)).alias("_script"))
    told = trigram_language(keyed, "_id", text, profile, labels, "_code", [*rows.columns, "_script"])
    codes = F.create_map(*[F.lit(x) for pair in CORPUS_CODES.items() for x in pair])
    mapped = F.coalesce(F.try_element_at(codes, F.col("_code")), F.lit(NO_LANGUAGE))
    return told.withColumn(name, combined_language(F.col("_script"), mapped)).drop("_id", "_code", "_script")


def convert(
    samples: DataFrame, base_path: str = "", language: Callable[[Column], Column] = script_language,
    profile: DataFrame | None = None, labels: Sequence[str] = (),
) -> DataFrame:
    """(audio, text) of the valid samples. ``language`` gives the language name of a transcript.

    A script does not tell languages in Latin letters apart; with a trigram ``profile`` of ``labels`` they are, and what
    is not mapped has no language.
    """
    transcript = first_assistant_turn(F.col("messages"))
    audio = first_audio_path(F.col("audios"))
    rows = samples.select(transcript.alias("transcript"), audio.alias("audio"))
    valid = rows.where(is_valid_sample(F.col("transcript"), F.col("audio")))
    if profile is None:
        tagged = valid.withColumn("language", language(F.col("transcript")))
    else:
        tagged = with_language(valid, "transcript", profile, labels)
    return tagged.select(
        join_base_path(base_path, F.col("audio")).alias("audio"),
        format_training_text(F.col("language"), F.col("transcript")).alias("text"),
    )


def write_converted(rows: DataFrame, path: str, shards: int, seed: int = SEED) -> None:
    """Shuffled shards and the side file of rows without a language. Shards are keyed by the audio path."""
    write_parquet_shards(rows, f"{path}/shards", "audio", shards, seed)
    write_undetected(rows, f"{path}/undetected_languages")


def filter_by_duration(rows: DataFrame, durations: DataFrame, longest: float) -> DataFrame:
    """Rows whose audio has a readable length up to the limit; ``durations`` has (audio, duration)."""
    kept = durations.where(within_duration(F.col("duration"), longest)).select("audio")
    return rows.join(kept, "audio", "left_semi")


def filter_by_length(
    rows: DataFrame, rejected_path: str | None = None, order: str = "audio", **limits
) -> DataFrame:
    """Rows that pass the repetition, character and token checks; the others go to the side file when a path is given."""
    checked = with_reject_reason(rows.withColumn("_transcript", extract_transcript(F.col("text"))), "_transcript", **limits)
    if rejected_path:
        write_rejected(rejected_rows(checked, "_transcript", "audio"), rejected_path, "char_count", order)
    return checked.where(F.col("reason").isNull()).select(*rows.columns)


def split_and_export(
    rows: DataFrame, path: str, key: str = "audio", ratio: float = EVAL_RATIO, seed: int = SEED
) -> DataFrame:
    """Writes the train and eval folders of JSON lines; returns the rows with their split."""
    split = train_eval_split(rows, key, ratio, seed)
    export_splits(split, path)
    return split
