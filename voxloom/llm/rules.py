"""Quality rules as a ledger: every rule is measured once per text and leaves one bit, policies are masks over the bits.

``ledger`` adds the measurements and ``failed``, a long in which bit k is set if rule k fails. A policy is a versioned mask,
so another version is applied to a stored ledger without reading a text again, and ``ablation`` tells from counts per
bit pattern what each rule of a policy contributes. Everything is column expressions on the row itself: no shuffle, no
Python, and one row's work does not depend on any other row. The ablation groups by the bit pattern, of which there are
at most 2 to the number of rules.

Defined results: a null, empty or blank text has no words and fails ``few_words``; other columns, null or not, are passed
through; a column of the table with the name of a measurement is replaced. Repeated rows are measured each by itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.binding import bind
from voxloom.llm.common import BLANK_CLASS, BLANKS, blank_words, own_names

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _removed(text: Column, characters: str) -> Column:
    """Number of the characters of a text that are in ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def duplicate_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANK_CLASS[1:]}"))
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def _covered(hashes: Column, width: int) -> Column:
    """Words in windows whose hash is found twice or more: sort (hash, start), mark equal neighbours, merge the starts."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def marked(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda k, j: F.get(s, k)["h"] == F.get(s, j)["h"]
        twice = lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))
        return F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), last), twice), lambda k: F.get(s, k)["i"]))

    def length(p: Column) -> Column:
        step = lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))
        return F.aggregate(F.transform(p, step), F.lit(0), lambda total, x: total + x)

    return bind(bind(pairs, marked), length)


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words which the text holds twice or more, the first copy included.

    Windows are compared by a 64-bit hash inside one text. A text without a repeated window, the usual case, is told by
    one distinct; the others are sorted, so a very long text takes n log n.
    """
    starts = lambda w: F.sequence(F.lit(1), F.size(w) - (width - 1))
    hashes = bind(words, lambda w: F.transform(starts(w), lambda i: F.xxhash64(F.slice(w, i, width))))
    found = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h, width)))
    return F.when(F.size(words) <= width, F.lit(0)).otherwise(found).cast("bigint")


#: name -> measurement, given the text (never null) and its words. Each is a long.
MEASUREMENTS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("bigint"),
    "word_chars": lambda text, words: F.length(F.translate(text, BLANKS, "")).cast("bigint"),
    "n_symbols": lambda text, words: _removed(text, SYMBOLS).cast("bigint"),
    "n_dup_lines": lambda text, words: duplicate_lines(text),
    "n_repeat_words": lambda text, words: repeated_window_words(words),
    "n_lines": lambda text, words: (_removed(text, "\n") + 1).cast("bigint"),
    "n_shouts": lambda text, words: _removed(text, "!").cast("bigint"),
    "n_distinct": lambda text, words: F.size(F.array_distinct(words)).cast("bigint"),
}


@dataclass(frozen=True)
class Rule:
    """A rule fails where its condition over the measurements holds. The condition is integer SQL, the same text for
    Spark and for any other engine, and its place in the list is its bit."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "5 * n_symbols > n_words AND n_words > 0"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words AND n_words > 0"),
    Rule("shouting", "10 * n_shouts > 3 * n_words AND n_words > 0"),
    Rule("few_distinct", "n_words >= 100 AND 20 * n_distinct < n_words"),
)


def mask_of(*names: str) -> int:
    """The mask of some rules; an unknown name is an error."""
    order = [rule.name for rule in RULES]
    return sum(1 << order.index(name) for name in dict.fromkeys(names))


#: Policies are never changed, only added to: a version names the rules that reject.
POLICIES = {
    "base": mask_of("few_words", "repeated_windows"),
    "v1": mask_of("few_words", "repeated_windows", "many_symbols", "short_words", "long_words"),
    "v2": mask_of(*(rule.name for rule in RULES if rule.name != "duplicate_lines")),
}


@own_names("text")
def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """The table with all measurements and the failure bits; ``text`` itself stays as it is."""
    kept = [c for c in df.columns if c not in {*MEASUREMENTS, "failed"}]
    whole = F.coalesce(F.col(text), F.lit(""))
    split = df.select(*kept, whole.alias("_whole"), blank_words(F.col(text)).alias("_words"))
    measured = split.select(
        *kept, *[make(F.col("_whole"), F.col("_words")).alias(name) for name, make in MEASUREMENTS.items()]
    )
    bits = [F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, rule in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def passes(failed: Column, mask: int) -> Column:
    """The verdict of a policy: no bit of its mask is set."""
    return failed.bitwiseAND(F.lit(mask).cast("bigint")) == 0


def ablation(rows: DataFrame, version: str) -> DataFrame:
    """One row per rule of a policy: ``n_failed`` rows that it rejects, ``n_alone`` rows that only it rejects (what the
    policy would keep without it), and ``n_kept`` with the whole policy, over all rows of a ledger."""
    mask = POLICIES[version]
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("bigint")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    rules = [(k, rule.name) for k, rule in enumerate(RULES) if mask >> k & 1]
    cells = [
        F.struct(
            F.lit(name).alias("rule"),
            total(F.col("bits").bitwiseAND(F.lit(1 << k).cast("bigint")) != 0).alias("n_failed"),
            total(F.col("bits") == F.lit(1 << k)).alias("n_alone"),
            total(F.col("bits") == 0).alias("n_kept"),
        )
        for k, name in rules
    ]
    return patterns.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


# --- the query and its SQL ------------------------------------------------------------------------------------------

POLICY = "v2"


def query(docs: DataFrame) -> DataFrame:
    rows = ledger(docs.select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(F.col("failed"), POLICIES["base"])).alias("base_failed"),
        passes(F.col("failed"), POLICIES[POLICY]).alias("kept"),
        F.col("failed").alias("failed_bits"), F.lit(POLICY).alias("policy"),
    )


def sql() -> str:
    bits = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES))
    symbols = "".join(SYMBOLS)
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM base),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(next_i - i, 8)))::BIGINT AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next_i FROM twice) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM split) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{symbols}', '')))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         length(t) - length(replace(t, chr(10), '')) + 1 AS n_lines, length(t) - length(replace(t, '!', '')) AS n_shouts,
         len(list_distinct(w)) AS n_distinct
  FROM split LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
marked AS (SELECT *, ({bits})::BIGINT AS failed_bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & {POLICIES['base']} <> 0 AS base_failed,
       failed_bits & {POLICIES[POLICY]} = 0 AS kept, failed_bits, '{POLICY}' AS policy
FROM marked"""
