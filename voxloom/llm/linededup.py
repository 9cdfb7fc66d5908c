"""Line deduplication over overlapping windows of three lines.

Every three consecutive lines of a text are a window. A window that occurs more than once in the table is repeated; its
first occurrence stays, and the lines that later occurrences cover are removed, overlapping windows merged. First means
the smallest document id, then the smallest line. A line that goes equals a line that an earlier place keeps, so no
content is lost from the table as a whole.

With ``sentences`` the units are finer: a text is cut behind every line break and behind '. ', '! ' and '? ', so a repeated
passage is seen inside a paragraph and from the middle of one. Units keep what ends them, and the units left are put
together as they are; blanks and line breaks at the end of a unit do not count when units are compared. Three equal lines
are at least three equal units, so whatever the lines show, the units show.

One pass hashes the lines (two 64-bit hashes with different seeds, so 128 bits a window). Counts are combined before the
shuffle, so a window that a third of all documents hold is one row per task. The repeated windows are written; those that
make up more than a ``HOT_WINDOWS``-th of all repeated places, so fewer than that many, are broadcast, and their places
pass the join that the others meet theirs in. Only line numbers go back to the texts.

Defined results: null, empty and blank texts and texts of one or two lines (units) have no window and stay as they are. Rows with
the same id, a null id included, have the same rank: none of them is later than another, only copies inside the row or
under a smaller id go (a null id is the smallest; text ids are ordered by their bytes, a null one like the empty one). Repeated rows are treated alike. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from voxloom.functions.binding import bind
from voxloom.llm.common import own_names
from voxloom.session import materialize

LINES = 3
#: Most windows that are broadcast because they are frequent, and the least places of such a window.
HOT_WINDOWS, HOT_PLACES = 20_000, 1_000
#: Between units: behind a line break or the blank after a sentence.
UNIT_ENDS = "(?<=\n)|(?<=[.!?] )"
#: ids of rows without one rank before all others
NO_ID = -(1 << 63)


def _rank(df: DataFrame, key: str) -> Column:
    """Whole numbers by size, texts by their bytes; a null is before all numbers and stands beside the empty text."""
    kind = df.select(F.col(key)).schema[0].dataType
    return F.coalesce(F.col(key), F.lit("")) if isinstance(kind, StringType) else F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID))


def _units(text: Column, sentences: bool) -> Column:
    """Lines without their breaks, or units with what ends them."""
    return F.split(text, UNIT_ENDS if sentences else "\n")


def _hashes(text: Column, sentences: bool) -> Column:
    """Per line two hashes; null for a null text."""
    both = lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))
    units = _units(text, sentences)
    return F.transform(units, lambda u: both(F.rtrim(u, F.lit(" \n")))) if sentences else F.transform(units, both)


def _windows(text: Column, lines: int, sentences: bool) -> Column:
    """Sorted (a, b, at) of a text's windows."""

    def of(h: Column) -> Column:
        part = lambda i, name: F.xxhash64(*[F.get(h, i + k)[name] for k in range(lines)])
        window = lambda i: F.struct(part(i, "a").alias("a"), part(i, "b").alias("b"), i.alias("at"))
        made = F.array_sort(F.transform(F.sequence(F.lit(0), F.size(h) - lines), window))
        return F.when(F.size(h) >= lines, made)

    return bind(_hashes(text, sentences), of)


def window_rows(df: DataFrame, key: str, text: str, lines: int = LINES, sentences: bool = False) -> DataFrame:
    """(key, tie, at, a, b, again): one row per window; ``again`` if the same text holds it further up."""
    rows = df.select(
        _rank(df, key).alias("key"),
        F.xxhash64(text).alias("tie"),
        _windows(F.col(text), lines, sentences).alias("w"),
    )
    flagged = bind(
        F.col("w"),
        lambda w: F.transform(
            w,
            lambda x, k: F.struct(
                x["a"].alias("a"), x["b"].alias("b"), x["at"].alias("at"),
                F.coalesce((F.get(w, k - 1)["a"] == x["a"]) & (F.get(w, k - 1)["b"] == x["b"]), F.lit(False)).alias("again"),
            ),
        ),
    )
    return rows.select("key", "tie", F.inline(flagged))


def later_windows(df: DataFrame, key: str, text: str, lines: int = LINES, sentences: bool = False) -> DataFrame:
    """(key, tie, starts): for each text the first lines of its windows that occurred before."""
    windows = window_rows(df, key, text, lines, sentences)
    repeated = (
        windows.groupBy("a", "b")
        .agg(F.min("key").alias("first_key"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    repeated = materialize(repeated, "line-windows")
    often = max(HOT_PLACES, (repeated.agg(F.sum("n")).first()[0] or 0) // HOT_WINDOWS)
    hot = repeated.where(F.col("n") > often).select("a", "b", F.col("first_key").alias("hot_key"))
    marked = windows.join(F.broadcast(hot), ["a", "b"], "left")
    # a place of a frequent window has its answer; it goes through the join under a key of its own that meets nothing
    plain = F.col("hot_key").isNull()
    spread = marked.select(
        "key", "tie", "at", "again", "hot_key", F.when(plain, F.col("a")).otherwise(F.xxhash64("key", "tie", "at")).alias("x"),
        F.when(plain, F.col("b")).alias("y"),
    )
    others = repeated.where(F.col("n") <= often).select(F.col("a").alias("x"), F.col("b").alias("y"), "first_key")
    found = spread.join(others, ["x", "y"], "left").withColumn("first", F.coalesce("hot_key", "first_key"))
    later = found.where((F.col("key") > F.col("first")) | (F.col("again") & F.col("first").isNotNull()))
    return later.groupBy("key", "tie").agg(F.collect_set("at").alias("starts"))


@own_names("key", "text", "into")
def dedup_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", lines: int = LINES, into: str | None = None,
    sentences: bool = False,
) -> DataFrame:
    """The table with ``text`` cleaned, and ``n_lines`` and ``n_removed`` (longs, lines or units before and gone).

    ``into`` names a column for the cleaned text and leaves the other as it is.
    """
    into = into or text
    kept = [c for c in df.columns if c not in {"n_lines", "n_removed"}]
    rows = df.select(
        *kept,
        _rank(df, key).alias("_key"),
        F.xxhash64(text).alias("_tie"),
    )
    gone = later_windows(df, key, text, lines, sentences).select(F.col("key").alias("_key"), F.col("tie").alias("_tie"), "starts")
    joined = rows.join(gone, ["_key", "_tie"], "left")
    covered = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (lines - 1))))
    )

    def cleaned(x: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["covered"])
        return F.array_join(F.transform(left, lambda i: F.get(x["lines"], i)), "" if sentences else "\n")

    whole = _units(F.col(text), sentences)
    both = F.struct(whole.alias("lines"), covered.alias("covered"))
    clean = F.when(F.col("starts").isNull(), F.col(text)).otherwise(bind(both, cleaned)).alias(into)
    return joined.select(
        *[clean if c == into else F.col(c) for c in kept],
        *([] if into in kept else [clean]),
        F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(whole)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def drop_emptied(cleaned: DataFrame, text: str | None = None) -> DataFrame:
    """Without the rows of which every line went: their content stands elsewhere. With the column of the cleaned ``text``,
    also without the rows of which only blanks are left."""
    left = F.col("n_removed") < F.col("n_lines")
    if text:
        left = left & (F.btrim(F.col(text), F.lit(" \n")) != "")
    return cleaned.where((F.col("n_removed") == 0) | left)


# --- the query and its SQL ------------------------------------------------------------------------------------------


def query(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


def passage_query(docs: DataFrame) -> DataFrame:
    rows = dedup_lines(docs.select("doc_id", "text"), sentences=True)
    return rows.select("doc_id", F.col("n_lines").alias("n_units"), "n_removed", "text")


def dedup_sql(source: str) -> str:
    """CTEs that end in ``deduped`` (doc_id, n_lines, n_removed, text) of a table with unique ids."""
    return f"""dl AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM {source} WHERE text IS NOT NULL),
dw AS (
  SELECT doc_id, i, l, lead(l, 1) OVER w AS l2, lead(l, 2) OVER w AS l3
  FROM dl WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY l, l2, l3 ORDER BY doc_id, i) AS k FROM dw WHERE l3 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM ranked, (SELECT unnest([0, 1, 2]) AS d) WHERE k > 1),
left_over AS (
  SELECT doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         coalesce(string_agg(l, chr(10) ORDER BY dl.i) FILTER (WHERE g.i IS NULL), '') AS text
  FROM dl LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id),
deduped AS (
  SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, o.text
  FROM {source} d LEFT JOIN left_over o USING (doc_id))"""


def sql() -> str:
    return f"WITH {dedup_sql('documents')} SELECT doc_id, n_lines, n_removed, text FROM deduped"


def passage_sql() -> str:
    """Units are matched whole here and cut apart in the operator."""
    return """WITH cut AS (
  SELECT doc_id, list_concat(regexp_extract_all(text, '(?s).*?(?:\\n|[.!?] )|.+'),
    CASE WHEN text = '' OR right(text, 1) = chr(10) OR right(text, 2) IN ('. ', '! ', '? ') THEN [''] ELSE [] END) AS us
  FROM documents WHERE text IS NOT NULL),
du AS (SELECT doc_id, unnest(us) AS u, generate_subscripts(us, 1) AS i FROM cut),
dc AS (SELECT doc_id, i, u, rtrim(u, ' ' || chr(10)) AS c FROM du),
dw AS (
  SELECT doc_id, i, c, lead(c, 1) OVER w AS c2, lead(c, 2) OVER w AS c3
  FROM dc WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY c, c2, c3 ORDER BY doc_id, i) AS k FROM dw WHERE c3 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM ranked, (SELECT unnest([0, 1, 2]) AS d) WHERE k > 1),
left_over AS (
  SELECT doc_id, count(*) AS n_units, count(g.i) AS n_removed,
         coalesce(string_agg(u, '' ORDER BY dc.i) FILTER (WHERE g.i IS NULL), '') AS text
  FROM dc LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed, o.text
FROM documents d LEFT JOIN left_over o USING (doc_id)"""
