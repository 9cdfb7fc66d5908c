"""What the operators of this subpackage share."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.sources.readers import table

#: The six characters that separate words where a contract says ``[^\\x20\\x09-\\x0D]+``.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = "[\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: All of ASCII that is no letter or digit.
MARKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the fold of a document. A null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def blank_words(text: Column) -> Column:
    """Words between blanks, in order; empty for null and for texts without a word."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{BLANK_CLASS}+"))


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased, in order; empty for null and for texts
    without a word. One pass lowers letters and blanks out marks, so the split looks for blanks only."""
    plain = F.btrim(F.translate(F.coalesce(text, F.lit("")), UPPER + MARKS, LOWER + " " * len(MARKS)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def own_names(*parameters: str) -> Callable:
    """Lets an operator work on a table whose columns bear names of its own, so no column of the table meets one that the
    operator uses inside. ``parameters`` are those that name a column of the table. Afterwards the columns have their
    names back; a column named like a new one (in any case) gives way to it."""

    def wrap(operator: Callable) -> Callable:
        signature = inspect.signature(operator)

        @functools.wraps(operator)
        def run(df: DataFrame, *args, **named) -> DataFrame:
            bound = signature.bind(df, *args, **named)
            bound.apply_defaults()
            given = list(bound.arguments)
            fresh = {c: f"given__{k}" for k, c in enumerate(df.columns)}
            folded = {c.lower(): f for c, f in fresh.items()}
            bound.arguments[given[0]] = df.toDF(*fresh.values())
            for name in parameters:
                column = bound.arguments[name]
                if column is None:
                    continue
                # a whole column or, behind the first dot, a field of one
                first, dot, field = (column, "", "") if column in fresh else column.partition(".")
                bound.arguments[name] = fresh.get(first, folded.get(first.lower(), first)) + dot + field
            out = operator(*bound.args, **bound.kwargs)
            back = {f: c for c, f in fresh.items()}
            new = {c.lower() for c in out.columns if c not in back}
            left = [c for c in out.columns if c not in back or back[c].lower() not in new]
            return out.select(*left).toDF(*[back.get(c, c) for c in left])

        return run

    return wrap
