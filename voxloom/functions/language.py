"""Language names and the parser of raw recogniser output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.constants import LANGUAGE_PREFIX, LINE_END, TEXT_TAG, WHITESPACE_CLASS
from voxloom.functions.binding import bind
from voxloom.functions.text import after_first, repair_repetitions, trim_py


def normalize_language_name(name: Column, strict: bool = False) -> Column:
    """First character upper case, the rest lower case. A blank name is null, or an error in strict mode."""
    missing = F.raise_error(F.lit("language name is empty")) if strict else F.lit(None).cast("string")

    def shaped(n: Column) -> Column:
        proper = F.concat(F.upper(F.substring(n, 1, 1)), F.lower(F.substr(n, F.lit(2))))
        return F.when(F.coalesce(n, F.lit("")) == "", missing).otherwise(proper)

    return bind(trim_py(name), shaped)


def language_display(name: Column) -> Column:
    """Underscores to blanks, one blank between words, first letter of each word upper case, other letters untouched."""
    words = F.filter(
        F.split(F.replace(F.coalesce(name, F.lit("")), F.lit("_"), F.lit(" ")), f"[{WHITESPACE_CLASS}]+"),
        lambda w: w != "",
    )
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")


def head_language(head: Column) -> Column:
    """Language named by the first line of the head that starts with the prefix, any case; empty if there is none."""
    lines = F.transform(F.split(head, LINE_END), trim_py)
    named = F.get(F.filter(lines, lambda line: F.lower(line).startswith(LANGUAGE_PREFIX)), F.lit(0))
    return F.coalesce(normalize_language_name(F.substr(named, F.lit(len(LANGUAGE_PREFIX) + 1))), F.lit(""))


def parse_model_output(
    df: DataFrame, raw: str, forced: str | None = None, language: str = "language", text: str = "parsed", repair: bool = True
) -> DataFrame:
    """Adds (language, text) read from a raw output such as ``language X<asr_text>...``.

    The repaired string is a step of its own: it is used several times and Catalyst does not inline an expensive
    expression into several places, so the repair patterns run once per row.
    """
    fixed = trim_py(F.coalesce(F.col(raw), F.lit("")))
    if repair:
        fixed = repair_repetitions(fixed)
    df = df.withColumn("_fixed", fixed)
    s = F.col("_fixed")
    head = F.substring_index(s, TEXT_TAG, 1)
    body = trim_py(after_first(s, TEXT_TAG))
    tagged = s.contains(TEXT_TAG)
    unknown = F.lower(head).contains(f"{LANGUAGE_PREFIX}none")
    name = F.when(s == "", F.lit("")).when(~tagged, F.lit("")).when(unknown, F.lit("")).otherwise(head_language(head))
    value = F.when(s == "", F.lit("")).when(~tagged, trim_py(s)).otherwise(body)
    if forced is not None:
        is_forced = (s != "") & (F.coalesce(F.col(forced), F.lit("")) != "")
        name = F.when(is_forced, F.col(forced)).otherwise(name)
        value = F.when(is_forced, s).otherwise(value)
    return df.withColumn(language, name).withColumn(text, value).drop("_fixed")


def forced_language(name: Column, supported: tuple[str, ...]) -> Column:
    """Normalized forced language; null when blank, an error when it is not in the list."""

    def checked(n: Column) -> Column:
        error = F.raise_error(F.concat(F.lit("unsupported language: "), n))
        return F.when(n.isNull() | n.isin(*supported), n).otherwise(error)

    return bind(normalize_language_name(name), checked)
