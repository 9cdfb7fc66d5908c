"""Queries over language detection: script shares, trigram profiles, detector grids and their scores."""

import time

from pyspark.sql import functions as F

from voxloom.catalog.registry import SAMPLES, documents, query, training_samples
from voxloom.constants import SCRIPT_CLASSES
from voxloom.operators import aggregates as A
from voxloom.operators import detect as D
from voxloom.operators.hooks import timed_grid
from voxloom.operators.joins import detector_grid
from voxloom.session import materialize

LABELS = ("en", "fr", "de", "es")

_SCRIPT_SQL = f"""scripts AS (
  SELECT doc_id, {', '.join(f"len(regexp_extract_all(text, '[{c}]')) AS s{i}" for i, c in enumerate(SCRIPT_CLASSES.values()))} FROM documents),
scripted AS (SELECT doc_id, CASE greatest(s0, s1, s2, s3, s4) WHEN 0 THEN 'None' {' '.join(f"WHEN s{i} THEN '{n}'" for i, n in enumerate(SCRIPT_CLASSES))} END AS script FROM scripts)"""
_GRAMS_SQL = f"""letters AS (
  SELECT doc_id, lang, doc_id % 5 <> 0 AS taught, string_split(' ' || trim(regexp_replace(lower(text), '[^{D.LETTERS}]+', ' ', 'g')) || ' ', '') AS c FROM documents),
grams AS (SELECT doc_id, lang, taught, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS g FROM letters),
counts AS (SELECT g, {', '.join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in LABELS)} FROM grams WHERE taught GROUP BY g),
profile AS (SELECT g, {', '.join(f"CAST(round(ln(({x} + 1)::DOUBLE / (sum({x}) OVER () + 1)::DOUBLE) * 1000) AS BIGINT) AS {x}" for x in LABELS)} FROM counts),
scores AS (SELECT doc_id, {', '.join(f"sum(p.{x}) AS {x}" for x in LABELS)} FROM grams JOIN profile p USING (g) GROUP BY doc_id),
guessed AS (SELECT d.doc_id, d.lang, CASE WHEN s.en IS NULL THEN 'None' {' '.join(f"WHEN s.{x} = greatest(s.en, s.fr, s.de, s.es) THEN '{x}'" for x in LABELS)} END AS predicted
            FROM documents d LEFT JOIN scores s USING (doc_id))"""


@query("detect_script", f"WITH {_SCRIPT_SQL} SELECT doc_id, script FROM scripted")
def _(spark, d):
    return documents(spark, d).select("doc_id", D.script_language(F.col("text")).alias("script"))


def _profile(spark, d):
    """Learnt from four fifths of the documents; detectors are compared on the fifth that it has not seen."""
    taught = documents(spark, d).select("doc_id", "text", "lang").where(F.col("doc_id") % 5 != 0)
    return D.trigram_profile(taught, "text", "lang", LABELS)


def _predicted(spark, d):
    return D.trigram_language(documents(spark, d), "doc_id", "text", _profile(spark, d), LABELS)


@query("detect_language", f"WITH {_GRAMS_SQL} SELECT doc_id, predicted FROM guessed")
def _(spark, d):
    return _predicted(spark, d)


@query(
    "trigram_profile",
    f"WITH {_GRAMS_SQL} SELECT g AS trigram, {', '.join(LABELS)} FROM profile",
)
def _(spark, d):
    return _profile(spark, d)


# what each detector should answer per language; a missing code means the detector does not cover the language
_EXPECTED = (
    ("script", "English", "English"), ("script", "French", None), ("script", "German", None), ("script", "Spanish", None),
    ("trigram", "English", "en"), ("trigram", "French", "fr"), ("trigram", "German", "de"), ("trigram", "Spanish", "es"),
    ("combined", "English", "en"), ("combined", "French", "fr"), ("combined", "German", "de"), ("combined", "Spanish", "es"),
)


def _expected(spark):
    rows = F.array(*[
        F.struct(F.lit(a).alias("detector"), F.lit(b).alias("language"), F.lit(c).cast("string").alias("expected_code"))
        for a, b, c in _EXPECTED
    ])
    return spark.range(1).select(F.inline(rows))


def _grid(spark, d):
    """The texts the profile has not seen. One scan: script and other columns go along with the scoring."""
    docs = training_samples(spark, d).where(F.col("doc_id") % 5 == 0).select(
        "doc_id", "language", "n_chars", "text", D.script_language(F.col("text")).alias("script")
    )
    keep = ["language", "n_chars", "script"]
    scored = D.trigram_language(docs, "doc_id", "text", _profile(spark, d), LABELS, "trigram_code", keep)
    answers = {
        "script": F.col("script"), "trigram": F.col("trigram_code"),
        "combined": D.combined_language(F.col("script"), F.col("trigram_code")),
    }
    return detector_grid(scored, answers, _expected(spark), "language").select(
        "detector", "language", "doc_id", "n_chars", "predicted", "expected_code"
    )


_GRID_SQL = f"""{SAMPLES}, {_SCRIPT_SQL}, {_GRAMS_SQL},
expected(detector, language, expected_code) AS (VALUES {', '.join('(' + ', '.join('NULL' if v is None else f"'{v}'" for v in row) + ')' for row in _EXPECTED)}),
answers AS (
  SELECT 'script' AS detector, doc_id, script AS predicted FROM scripted
  UNION ALL SELECT 'trigram', doc_id, predicted FROM guessed
  UNION ALL SELECT 'combined', doc_id, CASE WHEN script IN ('English', 'None') THEN predicted ELSE script END
            FROM scripted JOIN guessed USING (doc_id)),
grid AS (
  SELECT a.detector, s.language, s.doc_id, s.n_chars, a.predicted, e.expected_code
  FROM answers a JOIN samples s USING (doc_id) JOIN expected e ON e.detector = a.detector AND e.language = s.language
  WHERE e.expected_code IS NOT NULL AND s.doc_id % 5 = 0),
hits AS (SELECT *, predicted = expected_code OR starts_with(predicted, split_part(expected_code, '-', 1)) AS hit FROM grid)"""


@query("detector_grid", f"WITH {_GRID_SQL} SELECT * FROM grid")
def _(spark, d):
    return _grid(spark, d)


_ACCURACY_SQL = """count(*) FILTER (hit) AS correct, count(*) AS total, round(avg(hit::INT) * 100, 1) AS accuracy_pct,
  round(avg(n_chars), 3) AS avg_measure, min(n_chars) AS min_measure, max(n_chars) AS max_measure"""


@query("detector_accuracy", f"WITH {_GRID_SQL} SELECT detector, language, {_ACCURACY_SQL} FROM hits GROUP BY detector, language")
def _(spark, d):
    return A.detector_accuracy(_grid(spark, d), ["detector", "language"], "n_chars")


@query(
    "best_detector",
    f"""WITH {_GRID_SQL}, marks AS (SELECT detector, {_ACCURACY_SQL}, CASE detector WHEN 'script' THEN 0 WHEN 'trigram' THEN 1 ELSE 2 END AS rank FROM hits GROUP BY detector)
    SELECT (SELECT detector FROM marks ORDER BY avg_measure, rank LIMIT 1) AS fastest,
           (SELECT detector FROM marks ORDER BY correct / total DESC, rank LIMIT 1) AS most_accurate""",
)
def _(spark, d):
    scores = A.detector_accuracy(_grid(spark, d), ["detector"], "n_chars")
    rank = F.when(F.col("detector") == "script", 0).when(F.col("detector") == "trigram", 1).otherwise(2)
    return A.best_detector(scores.withColumn("rank", rank), "rank")


# --- measured times -------------------------------------------------------------------------------------------------


def quick_detector():
    return lambda text: ("en" if " the " in f" {text} " else "de" if " und " in f" {text} " else "xx", 0.9)


def slow_detector():
    def find(text):
        until = time.perf_counter() + 0.001
        while time.perf_counter() < until:
            pass
        return ("es" if " los " in f" {text} " else "en"), 0.5

    return find


def missing_detector():
    raise ImportError("no such library")


_REGISTRY = {"quick": quick_detector, "slow": slow_detector, "missing": missing_detector}
_TIMED_SQL = """asked AS (SELECT doc_id, lang, text FROM documents),
answers AS (
  SELECT 'quick' AS detector, lang, CASE WHEN contains(' ' || text || ' ', ' the ') THEN 'en' WHEN contains(' ' || text || ' ', ' und ') THEN 'de' ELSE 'xx' END AS code FROM asked
  UNION ALL SELECT 'slow', lang, CASE WHEN contains(' ' || text || ' ', ' los ') THEN 'es' ELSE 'en' END FROM asked),
marks AS (SELECT detector, count(*) AS calls, count(*) FILTER (code = lang) AS correct FROM answers GROUP BY detector)"""


def _timed(spark, d):
    """Every detector on every text of the table: none of them has learnt from it."""
    asked = documents(spark, d).select("lang", "text")
    return materialize(timed_grid(asked, _REGISTRY, "text", ["lang"]), "calls")


def _marks(calls):
    times = A.latency_summary(A.latency_sketches(calls, ["detector"]), ["detector"])
    right = calls.where(F.col("nanos").isNotNull()).groupBy("detector").agg(
        F.count_if(F.col("predicted") == F.col("lang")).alias("correct"), F.count(F.lit(1)).alias("total")
    )
    return times.join(right, "detector")


@query("detector_latency", f"WITH {_TIMED_SQL} SELECT detector, calls, correct, true AS timed, detector = 'slow' AS above_a_millisecond FROM marks")
def _(spark, d):
    # the times themselves differ from run to run; that they are there, in order and plausible is what can be compared
    c = F.col
    ordered = (c("min_ms") > 0) & (c("min_ms") <= c("p50_ms")) & (c("p50_ms") <= c("p95_ms")) & (c("p95_ms") <= c("p99_ms")) & (c("p99_ms") <= c("max_ms"))
    between = (c("min_ms") <= c("avg_ms")) & (c("avg_ms") <= c("max_ms"))
    return _marks(_timed(spark, d)).select(
        "detector", "calls", "correct", (ordered & between).alias("timed"), (c("p50_ms") >= 1).alias("above_a_millisecond")
    )


@query(
    "fastest_detector",
    f"""WITH {_TIMED_SQL} SELECT 'quick' AS fastest, (SELECT detector FROM marks ORDER BY correct / calls DESC, detector LIMIT 1) AS most_accurate""",
)
def _(spark, d):
    # by measured time per call; the slow one takes a millisecond at least
    scores = _marks(_timed(spark, d)).withColumn("rank", F.when(F.col("detector") == "quick", 0).otherwise(1))
    return A.best_detector(scores.withColumnRenamed("p50_ms", "avg_measure"), "rank")
