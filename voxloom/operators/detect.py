"""Language detection as Spark jobs: script shares, and letter-trigram profiles learned from labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.constants import NO_LANGUAGE, SCRIPT_CLASSES

#: every trigram is made of these letters and the blank, which bounds the profile to about 60^3 rows
LETTERS = "a-zß-öø-ÿœ"


def script_language(text: Column) -> Column:
    """Language of the script with most letters; the first in table order on ties, none for a text without letters."""
    shares = [
        F.struct(F.regexp_count(text, F.lit(f"[{cls}]")).alias("n"), F.lit(-i).alias("order"), F.lit(name).alias("name"))
        for i, (name, cls) in enumerate(SCRIPT_CLASSES.items())
    ]
    top = F.greatest(*shares)
    return F.when(F.coalesce(top["n"], F.lit(0)) > 0, top["name"]).otherwise(F.lit(NO_LANGUAGE))


def combined_language(script: Column, trigram: Column, latin: str = "English") -> Column:
    """Script first: a text in Latin letters, or without letters, is told by its trigrams."""
    return F.when(script.isin(latin, NO_LANGUAGE), trigram).otherwise(script)


def _letters(text: Column) -> Column:
    """Lower-case letters with one blank between words. A lone blank is already right, so the pattern passes it by."""
    gaps = f"[^{LETTERS} ][^{LETTERS}]*+| [^{LETTERS}]++"
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), gaps, " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """All overlapping letter trigrams in one linear pass."""
    return F.regexp_extract_all(_letters(text), F.lit("(?=(.{3}))"), F.lit(1))


def trigram_profile(df: DataFrame, text: str, label: str, labels: Sequence[str]) -> DataFrame:
    """(trigram, one integer score per label). Counts are combined before the shuffle; the result is bounded by the
    alphabet, not by the corpus."""
    grams = df.select(label, F.explode(trigrams(F.col(text))).alias("trigram"))
    counts = grams.groupBy("trigram").agg(*[F.count_if(F.col(label) == code).alias(code) for code in labels])
    whole = Window.partitionBy(F.lit(0))
    scores = [
        F.round(F.log((F.col(code) + 1) / (F.sum(code).over(whole) + 1)) * 1000).cast("bigint").alias(code)
        for code in labels
    ]
    return counts.select("trigram", *scores)


def trigram_language(
    df: DataFrame, key: str, text: str, profile: DataFrame, labels: Sequence[str], name: str = "predicted",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, keep, predicted): the label with the highest summed score, the first label on ties. ``keep`` names further
    columns of a row that go along, so that nothing is joined back.

    The profile is bounded by the alphabet and is broadcast. The scores of a text are summed in the task that holds it,
    so one row per text is shuffled.
    """
    grams = df.select(key, *keep, F.explode_outer(trigrams(F.col(text))).alias("trigram"))
    scored = grams.join(F.broadcast(profile), "trigram", "left")
    sums = scored.groupBy(key, *keep).agg(*[F.sum(code).alias(code) for code in labels])
    ranked = F.greatest(
        *[F.struct(F.col(code).alias("s"), F.lit(-i).alias("order"), F.lit(code).alias("code")) for i, code in enumerate(labels)]
    )
    return sums.select(key, *keep, F.when(F.col(labels[0]).isNotNull(), ranked["code"]).otherwise(F.lit(NO_LANGUAGE)).alias(name))
