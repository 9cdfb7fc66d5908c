"""Row-level operators of the corpus job: validation, limits, reject reasons, prompts. None of them shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from voxloom.constants import (
    AUDIO_TOKEN,
    LANGUAGE_PREFIX,
    MAX_DURATION_SECONDS,
    MAX_REPEAT_FILTER,
    MAX_SEQUENCE_LENGTH,
    TEXT_TAG,
)
from voxloom.functions.signal import audio_token_length
from voxloom.functions.text import count_tokens, has_long_run, is_blank, preview, trim_py


def first_assistant_turn(messages: Column) -> Column:
    """Trimmed content of the first assistant message of an array; later assistant turns are never tried."""
    return trim_py(F.get(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(0))["content"])


def first_assistant_rows(df: DataFrame, sample: str, turn: str, role: str, content: str, name: str = "transcript"):
    """The same from one row per message; partial aggregation keeps one row per sample and task."""
    return (
        df.where(F.col(role) == "assistant")
        .groupBy(sample)
        .agg(trim_py(F.min_by(content, turn)).alias(name))
    )


def first_audio_path(audios: Column) -> Column:
    return F.get(audios, F.lit(0))


def join_base_path(base: str, path: Column) -> Column:
    """Prefix a base directory; an absolute path wins."""
    if not base:
        return path
    base = base if base.endswith("/") else base + "/"
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base), path))


def is_valid_sample(transcript: Column, audio: Column) -> Column:
    return (F.coalesce(transcript, F.lit("")) != "") & (F.coalesce(audio, F.lit("")) != "")


def within_duration(duration: Column, longest: float = MAX_DURATION_SECONDS) -> Column:
    """0 < duration <= longest; -1 (unreadable) and null are out."""
    return F.coalesce((duration > 0.0) & (duration <= longest), F.lit(False))


def over_char_limit(transcript: Column, max_chars: int | None) -> Column:
    return F.length(transcript) > max_chars if max_chars else F.lit(False)


def over_token_limit(tokens: Column, max_tokens: int | None) -> Column:
    return tokens > max_tokens if max_tokens else F.lit(False)


def with_reject_reason(
    df: DataFrame,
    transcript: str,
    max_chars: int | None = None,
    max_tokens: int | None = None,
    max_repeat: int = MAX_REPEAT_FILTER,
    counter: Callable[[Column], Column] = count_tokens,
) -> DataFrame:
    """Adds char_count, token_count and reason. The first failing check wins: repetition, char_limit, token_limit.

    Tokens are counted only for rows that passed the cheaper checks; elsewhere the count is null.
    """
    text = F.col(transcript)
    cheap = F.when(has_long_run(text, max_repeat), "repetition").when(over_char_limit(text, max_chars), "char_limit")
    df = df.withColumn("char_count", F.length(text)).withColumn("_cheap", cheap)
    tokens = F.when(F.col("_cheap").isNull(), counter(text)) if max_tokens else F.lit(None)
    df = df.withColumn("token_count", tokens.cast("int"))
    late = F.when(over_token_limit(F.col("token_count"), max_tokens), "token_limit")
    return df.withColumn("reason", F.coalesce("_cheap", late)).drop("_cheap")


def rejected_rows(df: DataFrame, transcript: str, *carry: str) -> DataFrame:
    """The side table of rejected rows; expects the columns of :func:`with_reject_reason`."""
    return df.where(F.col("reason").isNotNull()).select(
        *carry, "char_count", "token_count", "reason", preview(F.col(transcript)).alias("transcript_preview")
    )


def sequence_length(prefix_tokens: Column, frames: Column, text_tokens: Column, end_tokens: int = 1) -> Column:
    return prefix_tokens + audio_token_length(frames) + text_tokens + end_tokens


def within_sequence(length: Column, longest: int = MAX_SEQUENCE_LENGTH) -> Column:
    return length <= longest


def sequence_lengths(
    df: DataFrame, key: str, text: str, measure: Callable[[pd.Series], pd.Series]
) -> DataFrame:
    """(key, seq_len, error) from a user's measuring function on a batch of texts.

    A batch that raises is measured row by row, and a row that raises gets seq_len -1 and the first 100 characters of
    the message; a bad row never fails the job.
    """

    def one(value: str) -> tuple[int, str | None]:
        try:
            return int(measure(pd.Series([value])).iloc[0]), None
        except Exception as problem:  # the user's function may raise anything
            return -1, str(problem)[:100]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                out = pd.DataFrame({key: batch[key], "seq_len": measure(batch[text]).astype("int32"), "error": None})
            except Exception:  # find the rows that raise
                pairs = [one(v) for v in batch[text]]
                out = pd.DataFrame(
                    {key: batch[key], "seq_len": [p[0] for p in pairs], "error": [p[1] for p in pairs]}
                )
            yield out

    schema = StructType(
        [df.schema[key], StructField("seq_len", IntegerType()), StructField("error", StringType())]
    )
    return df.select(key, text).mapInPandas(run, schema)


def prefix_text(prompt: Column, template: str) -> Column:
    """Rendered chat prefix; ``template`` has one ``%s`` for the system prompt."""
    return F.format_string(template, F.coalesce(prompt, F.lit("")))


def build_prefix_rows(df: DataFrame, template: str) -> DataFrame:
    """prompt (default empty), audio, target, prefix_text; every other column is dropped."""
    prompt = F.coalesce(F.col("prompt"), F.lit("")) if "prompt" in df.columns else F.lit("")
    return df.select(
        prompt.alias("prompt"), "audio", F.col("text").alias("target"), prefix_text(prompt, template).alias("prefix_text")
    )


def build_prompt(context: Column, forced: Column, template: str) -> Column:
    """Recognition prompt: rendered context, plus the forced language tag where a language is forced."""
    tag = F.when(is_blank(forced), F.lit("")).otherwise(F.concat(F.lit(LANGUAGE_PREFIX), forced, F.lit(TEXT_TAG)))
    return F.concat(prefix_text(context, template), tag)


def expand_audio_tokens(text: Column, lengths: Column, token: str = AUDIO_TOKEN) -> Column:
    """Repeat the i-th placeholder lengths[i] times. Fewer lengths than placeholders is an error."""
    quoted = "\\Q" + token + "\\E"
    pieces = F.split(text, quoted, -1)
    marks = F.size(pieces) - 1
    grown = F.zip_with(
        F.slice(pieces, 2, marks),
        F.slice(lengths, 1, marks),
        lambda piece, n: F.concat(F.repeat(F.lit(token), n.cast("int")), piece),
    )
    whole = F.concat(F.get(pieces, F.lit(0)), F.array_join(grown, ""))
    short = F.raise_error(F.lit("fewer audio lengths than placeholders"))
    return F.when(F.size(lengths) < marks, short).otherwise(whole)


def nonempty_text(df: DataFrame, text: str) -> DataFrame:
    return df.where(~is_blank(F.col(text)))
