"""Text expressions: trimming, tags, repetition, tokens. All of them are built-in expressions, no Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.constants import (
    AUDIO_MARKS,
    CJK_CLASS,
    KEPT_CLASS,
    LANGUAGE_PREFIX,
    MAX_REPEAT_FILTER,
    MAX_UNIT_REPAIR,
    NO_LANGUAGE,
    PREVIEW_CHARS,
    REPEAT_LIMIT_REPAIR,
    TEXT_TAG,
    TIMESTAMP_MARK,
    UNKNOWN_LANGUAGE,
    WHITESPACE,
    WHITESPACE_CLASS,
)


def trim_py(text: Column) -> Column:
    """Trim every Unicode blank at both ends, not only U+0020."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.coalesce(trim_py(text), F.lit("")) == ""


def after_first(text: Column, mark: str) -> Column:
    """What follows the first ``mark``; the caller checks that there is one."""
    return F.substr(text, F.locate(mark, text) + len(mark))


def format_training_text(language: Column, transcript: Column) -> Column:
    return F.concat(F.lit(LANGUAGE_PREFIX), language, F.lit(TEXT_TAG), transcript)


def extract_transcript(text: Column) -> Column:
    """Text after the first tag of the last line; the whole text where the last line has no tag.

    Only the last line counts because the format is read up to the end of a line; one closing newline is not a line.
    """
    text = F.coalesce(text, F.lit(""))
    body = F.when(text.endswith("\n"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    last_line = F.substring_index(body, "\n", -1)
    return F.when(last_line.contains(TEXT_TAG), after_first(last_line, TEXT_TAG)).otherwise(text)


def extract_language_tag(text: Column) -> Column:
    head = F.replace(F.substring_index(text, TEXT_TAG, 1), F.lit(LANGUAGE_PREFIX), F.lit(""))
    return F.when(text.startswith(LANGUAGE_PREFIX), trim_py(head)).otherwise(F.lit(UNKNOWN_LANGUAGE))


def is_undetected(text: Column) -> Column:
    return text.startswith(f"{LANGUAGE_PREFIX}{NO_LANGUAGE}{TEXT_TAG}")


def strip_undetected_tag(text: Column) -> Column:
    """Removes every occurrence of the tag, also inside the transcript."""
    return F.replace(text, F.lit(f"{LANGUAGE_PREFIX}{NO_LANGUAGE}{TEXT_TAG}"), F.lit(""))


def has_long_run(text: Column, max_repeat: int = MAX_REPEAT_FILTER) -> Column:
    """True when one character (never a newline) follows itself ``max_repeat`` times or more."""
    return F.coalesce(text.rlike(rf"(?d)(.)\1{{{max_repeat}}}"), F.lit(False))


def collapse_char_runs(text: Column, limit: int = REPEAT_LIMIT_REPAIR) -> Column:
    """A run of more than ``limit`` equal characters becomes one character."""
    return F.regexp_replace(text, rf"(?s)(.)\1{{{limit},}}+", "$1")


def collapse_pattern_repeats(text: Column, limit: int = REPEAT_LIMIT_REPAIR, max_unit: int = MAX_UNIT_REPAIR) -> Column:
    """The shortest unit of up to ``max_unit`` characters repeated ``limit`` times or more becomes one unit.

    A repeat counts only where ``2 * limit`` characters are left. Units of two or more reach that by themselves, so the
    look-ahead sits in the one-character case, behind the repeat test, and the scan stays cheap on ordinary text.
    """
    more = limit - 1
    single = rf"(.)(?=\1{{{more}}})(?=.{{{2 * limit - 1}}})\1{{{more},}}+"
    longer = rf"(.{{2,{max_unit}}}?)\2{{{more},}}+"
    return F.regexp_replace(text, rf"(?s)(?:{single}|{longer})", "$1$2")


def may_repeat(text: Column, limit: int = REPEAT_LIMIT_REPAIR, max_unit: int = MAX_UNIT_REPAIR) -> Column:
    """False only where no unit of two or more characters repeats ``limit`` times.

    Such a repeat covers ``limit`` units, so it still holds at least half as many whole units behind the next position
    that is a multiple of ``max_unit``. Looking at those positions alone is enough to rule a text out.
    """
    copies = limit - (max_unit - 1) // 2 - 1
    return text.rlike(rf"(?s)\A(?:.{{{max_unit}}})*?(.{{2,{max_unit}}}?)\1{{{copies - 1}}}")


def repair_repetitions(text: Column) -> Column:
    """Runs first, then repeated units. Two cheap tests keep ordinary text away from the patterns that try every unit
    length at every character."""
    has_run = text.rlike(rf"(?s)(.)\1{{{REPEAT_LIMIT_REPAIR - 1}}}")
    return (
        F.when(has_run, collapse_pattern_repeats(collapse_char_runs(text)))
        .when(may_repeat(text), collapse_pattern_repeats(text))
        .otherwise(text)
    )


def preview(text: Column, size: int = PREVIEW_CHARS) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def clean_token(text: Column) -> Column:
    """Keep letters, numbers and the apostrophe."""
    return F.regexp_replace(text, f"[^{KEPT_CLASS}]", "")


_SPACED_TOKEN = f"[{CJK_CLASS}]|[^{CJK_CLASS}{WHITESPACE_CLASS}]+"


def _clean_words(text: Column) -> Column:
    # dropping characters never moves a blank, so the whole text is cleaned in one pass before it is cut into words
    return F.regexp_replace(text, f"[^{KEPT_CLASS}{WHITESPACE_CLASS}]", "")


def tokenize_space_lang(text: Column) -> Column:
    """Words between blanks, cleaned; every ideograph is a token of its own."""
    return F.regexp_extract_all(_clean_words(text), F.lit(_SPACED_TOKEN), F.lit(0))


def count_tokens(text: Column) -> Column:
    """``size(tokenize_space_lang(text))`` without building the array."""
    return F.regexp_count(_clean_words(text), F.lit(_SPACED_TOKEN))


def tokenize_chinese_mixed(text: Column) -> Column:
    """Ideographs alone, other kept characters in runs; anything else ends a run."""
    return F.regexp_extract_all(text, F.lit(f"[{CJK_CLASS}]|[{KEPT_CLASS}&&[^{CJK_CLASS}]]+"), F.lit(0))


def encode_alignment_text(words: Column) -> Column:
    pair = TIMESTAMP_MARK * 2
    return F.concat(F.lit(AUDIO_MARKS), F.array_join(words, pair), F.lit(pair))


def words_by_language(text: Column, language: Column, korean: Column | None = None, japanese: Column | None = None):
    """Word list by language route. Korean and Japanese words come from the caller (dictionary split or a user function)."""
    spaced = tokenize_space_lang(text)
    route = F.lower(language)
    if korean is None and japanese is None:
        return spaced
    chosen = F.when(route == "korean", korean if korean is not None else spaced)
    chosen = chosen.when(route == "japanese", japanese if japanese is not None else spaced)
    return chosen.otherwise(spaced)
