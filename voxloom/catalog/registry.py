"""Registry of the named queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.constants import CORPUS_CODES, LANGUAGE_PREFIX, NO_LANGUAGE, TEXT_TAG, WHITESPACE
from voxloom.functions.text import format_training_text
from voxloom.operators.joins import map_language_code
from voxloom.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


# --- inputs shared by many queries ----------------------------------------------------------------------------------


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def training_samples(spark: SparkSession, folder: str, shared: bool = False) -> DataFrame:
    """documents as training samples: language by code, tagged text, and an audio path."""
    docs = documents(spark, folder) if shared else table(spark, folder, "documents")
    docs = map_language_code(docs, "lang")
    return docs.withColumn("tagged", format_training_text(F.col("language"), F.col("text"))).withColumn(
        "audio", F.concat(F.lit("clips/"), "source", F.lit("/"), "doc_id", F.lit(".wav"))
    )


def sql_trim(expression: str) -> str:
    return f"trim({expression}, '{WHITESPACE}')"


LANGUAGE_CASE = (
    "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CORPUS_CODES.items()) + f" ELSE '{NO_LANGUAGE}' END"
)
SAMPLES = f"""samples AS (
  SELECT doc_id, lang, source, text, n_chars, {LANGUAGE_CASE} AS language,
         '{LANGUAGE_PREFIX}' || {LANGUAGE_CASE} || '{TEXT_TAG}' || text AS tagged,
         'clips/' || source || '/' || doc_id || '.wav' AS audio
  FROM documents)"""


def runs_sql(source: str = "documents", text: str = "text") -> str:
    """Runs of equal characters of a text column, one row per run, with its place in the text."""
    return f"""chars AS (
  SELECT doc_id, unnest(string_split({text}, '')) AS c, unnest(range(1, length({text}) + 1)) AS i FROM {source}),
runs AS (
  SELECT doc_id, c, min(i) AS first_i, count(*) AS n
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, c ORDER BY i) AS g FROM chars)
  GROUP BY doc_id, c, g)"""


RUNS = runs_sql()


def repaired_sql(source: str, text: str) -> str:
    """Repaired texts ``fixed(doc_id, f)``, found from stretches in which every character equals the one k places on.

    A stretch of n such places from a on holds units of k characters; 19 k places or more make twenty units. The texts
    are walked from cut to cut: the first place with a unit, the shortest unit there, all its copies but one removed.
    """
    same = ", ".join(f"lead(c, {k}) OVER w = c" for k in range(1, 21))
    return f"""{runs_sql(source, text)},
collapsed AS (
  SELECT doc_id, string_agg(CASE WHEN n > 20 THEN c ELSE repeat(c, n) END, '' ORDER BY first_i) AS s FROM runs GROUP BY doc_id),
cells AS (SELECT doc_id, unnest(string_split(s, '')) AS c, unnest(range(1, length(s) + 1)) AS i FROM collapsed),
ahead AS (SELECT doc_id, i, [{same}] AS e FROM cells WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
places AS (SELECT doc_id, i, unnest(e) AS eq, unnest(range(1, 21)) AS k FROM ahead),
stretches AS (
  SELECT doc_id, k, min(i) AS a, count(*) AS n
  FROM (SELECT doc_id, i, k, i - row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS g FROM places WHERE eq)
  GROUP BY doc_id, k, g),
units AS (
  SELECT s.doc_id, list({{'k': s.k, 'a': s.a, 'n': s.n}}) AS u, any_value(length(c.s)) AS size
  FROM stretches s JOIN collapsed c USING (doc_id) WHERE s.n >= 19 * s.k GROUP BY s.doc_id),
walk AS (
  SELECT doc_id, u, size, 1::BIGINT AS p, 0::BIGINT AS cut_from FROM units
  UNION ALL
  SELECT doc_id, u, size, hit.i + hit.copies * hit.k, hit.i + hit.k
  FROM (SELECT *, list_min(list_transform(
           list_filter(u, lambda x: greatest(x.a, p) <= x.a + x.n - 19 * x.k AND greatest(x.a, p) <= size - 39),
           lambda x: {{'i': greatest(x.a, p), 'k': x.k, 'copies': (x.a + x.n - greatest(x.a, p) + x.k) // x.k}})) AS hit
        FROM walk) WHERE hit IS NOT NULL),
gone AS (SELECT doc_id, unnest(range(cut_from, p)) AS i FROM walk WHERE cut_from > 0),
fixed AS (SELECT doc_id, string_agg(c, '' ORDER BY i) AS f FROM cells ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)"""
