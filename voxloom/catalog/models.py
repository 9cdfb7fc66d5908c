"""Queries over the user-function hooks with deterministic stand-ins, and over the timestamp repair they feed."""

import numpy as np
from pyspark.sql import functions as F

from voxloom.catalog.corpus import TEMPLATE
from voxloom.catalog.registry import documents, query
from voxloom.catalog.texts import WORDS_SQL
from voxloom.functions import align as L
from voxloom.functions.language import parse_model_output
from voxloom.functions.text import encode_alignment_text, tokenize_space_lang
from voxloom.operators import hooks as H
from voxloom.operators.filters import build_prompt
from voxloom.plans.transcribe import transcribe
from voxloom.sources.readers import table


def recogniser():
    """Counts samples and positive samples; answers without a head where the prompt forces the language."""

    def answer(prompt, wav):
        text = f"{len(wav)} samples {int((np.asarray(wav) > 0).sum())} positive"
        return text if prompt.endswith("<asr_text>") else f"language English<asr_text>{text}"

    return lambda prompts, wavs: [answer(p, w) for p, w in zip(prompts, wavs)]


def aligner():
    """Rising slots, three apart, with one dip at the sixth."""

    def slots(count):
        out = list(range(0, 6 * count, 3))
        if len(out) > 5:
            out[5] = 0
        return out

    return lambda texts, wavs, counts: [slots(c) for c in counts]


def blank_tokenizer():
    return str.split


def the_detector():
    return lambda text: ("en", 0.9) if " the " in text else ("xx", 0.5)


def broken_detector():
    raise ImportError("no such library")


@query(
    "transcribe_batches",
    """SELECT vec_id, CASE WHEN label = 2 THEN 'French' ELSE 'English' END AS language,
       len(embedding) || ' samples ' || len(list_filter(embedding, lambda x: x > 0)) || ' positive' AS text FROM embeddings""",
)
def _(spark, d):
    forced = F.when(F.col("label") == 2, "French")
    rows = table(spark, d, "embeddings").withColumn("forced", forced).withColumn(
        "prompt", build_prompt(F.lit("numbers"), F.col("forced"), TEMPLATE)
    )
    rows = rows.select("vec_id", "forced", "prompt", F.col("embedding").alias("wav"))
    raw = H.transcribe_batches(rows, ["vec_id", "forced"], "prompt", "wav", recogniser, batch_size=16)
    return parse_model_output(raw, "raw", "forced", "language", "text").select("vec_id", "language", "text")


@query(
    "align_batches",
    f"""WITH {WORDS_SQL}, w AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS i FROM words),
    t AS (SELECT doc_id, i, word, 6 * i AS a, CASE WHEN i = 2 THEN 12 ELSE 6 * i + 3 END AS b FROM w),
    s AS (SELECT doc_id, count(*) AS words, max(CASE WHEN i = 2 THEN b * 80 END) AS repaired_ms,
           round(sum(round(a * 80 / 1000.0, 3)), 2) AS starts, round(sum(round(b * 80 / 1000.0, 3)), 2) AS ends FROM t GROUP BY doc_id)
    SELECT doc_id, coalesce(words, 0) AS words, repaired_ms, coalesce(starts, 0) AS starts, coalesce(ends, 0) AS ends
    FROM documents LEFT JOIN s USING (doc_id)""",
)
def _(spark, d):
    docs = documents(spark, d).select("doc_id", tokenize_space_lang(F.col("text")).alias("words"))
    # the stand-in aligner looks at the words only, so an empty signal is enough
    rows = docs.withColumn("encoded", encode_alignment_text(F.col("words"))).withColumn("wav", F.array().cast("array<float>"))
    spans = H.align_batches(rows, ["doc_id"], "wav", "words", "encoded", aligner)

    def total(name):
        return F.round(F.aggregate("time_stamps", F.lit(0.0), lambda a, s: a + s[name]), 2)

    third = F.get("time_stamps", F.lit(2))["end_time"]
    return spans.select(
        "doc_id", F.size("time_stamps").cast("bigint").alias("words"), F.round(third * 1000).cast("bigint").alias("repaired_ms"),
        total("start_time").alias("starts"), total("end_time").alias("ends"),
    )


@query(
    "tokenizer_hook",
    r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS tokens FROM documents",
)
def _(spark, d):
    count = H.token_counter(blank_tokenizer)
    return table(spark, d, "documents").select("doc_id", count("text").cast("bigint").alias("tokens"))


@query(
    "detector_hook",
    """SELECT doc_id, CASE WHEN contains(text, ' the ') THEN 'en' ELSE 'xx' END AS code, CASE WHEN contains(text, ' the ') THEN 0.9 ELSE 0.5 END::DOUBLE AS confidence,
              'unavailable: no such library' AS broken FROM documents""",
)
def _(spark, d):
    found, broken = H.detector(the_detector)("text"), H.detector(broken_detector)("text")
    rows = table(spark, d, "documents").select("doc_id", found.alias("f"), broken.alias("b"))
    return rows.select("doc_id", "f.code", "f.confidence", F.col("b.error").alias("broken"))


# rising series with noise: long gaps, short gaps and edges all occur
_SERIES_SQL = """series AS (SELECT vec_id, list_transform(embedding, lambda x, i: CAST(floor(x * (40 + label * 40)) AS BIGINT) + i * 2) AS v FROM embeddings),
grown AS (
  SELECT vec_id, v, 1 AS i, [1] AS len, [0] AS parent FROM series
  UNION ALL
  SELECT vec_id, v, i + 1, list_append(len, coalesce(list_max(c), 0) + 1),
         list_append(parent, CASE WHEN coalesce(list_max(c), 0) = 0 THEN 0 ELSE list_position(c, list_max(c)) END)
  FROM (SELECT *, list_transform(range(1, i + 1), lambda j: CASE WHEN v[j] <= v[i + 1] THEN len[j] ELSE 0 END) AS c FROM grown WHERE i < len(v))),
traced AS (
  SELECT vec_id, parent, list_position(len, list_max(len)) AS k FROM grown WHERE i = len(v)
  UNION ALL SELECT vec_id, parent, parent[k] FROM traced WHERE parent[k] > 0),
cells AS (SELECT vec_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM series),
masked AS (SELECT c.vec_id, c.i, c.x, t.k IS NOT NULL AS kept FROM cells c LEFT JOIN traced t ON t.vec_id = c.vec_id AND t.k = c.i)"""


def _series(spark, d):
    noisy = F.transform("embedding", lambda x, i: F.floor(x.cast("double") * (40 + F.col("label") * 40)).cast("bigint") + (i + 1) * 2)
    return table(spark, d, "embeddings").select("vec_id", noisy.alias("v"))


@query("monotone_keep_mask", f"WITH RECURSIVE {_SERIES_SQL} SELECT vec_id, i, x, kept FROM masked")
def _(spark, d):
    masked = _series(spark, d).select("vec_id", "v", L.monotone_keep_mask("v").alias("m"))
    cells = masked.select("vec_id", F.posexplode(F.arrays_zip("v", "m")).alias("i", "c"))
    return cells.select("vec_id", (F.col("i") + 1).cast("bigint").alias("i"), F.col("c.v").alias("x"), F.col("c.m").alias("kept"))


@query(
    "repair_timestamps",
    f"""WITH RECURSIVE {_SERIES_SQL},
    near AS (
      SELECT *, last_value(CASE WHEN kept THEN i END IGNORE NULLS) OVER (PARTITION BY vec_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS li,
             first_value(CASE WHEN kept THEN i END IGNORE NULLS) OVER (PARTITION BY vec_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ri FROM masked),
    valued AS (SELECT n.vec_id, n.i, n.x, n.kept, n.li, n.ri, a.x AS lx, b.x AS rx FROM near n
               LEFT JOIN cells a ON a.vec_id = n.vec_id AND a.i = n.li LEFT JOIN cells b ON b.vec_id = n.vec_id AND b.i = n.ri)
    SELECT vec_id, i, CASE WHEN kept THEN x WHEN lx IS NULL THEN rx WHEN rx IS NULL THEN lx
      WHEN ri - li - 1 <= 2 THEN CASE WHEN i - li <= ri - i THEN lx ELSE rx END
      ELSE CAST(trunc(lx + (rx - lx)::DOUBLE / (ri - li) * (i - li)) AS BIGINT) END AS repaired FROM valued""",
)
def _(spark, d):
    cells = _series(spark, d).select("vec_id", F.posexplode(L.repair_timestamps("v")).alias("i", "repaired"))
    return cells.select("vec_id", (F.col("i") + 1).cast("bigint").alias("i"), "repaired")


@query("transcribe_recordings")
def _(spark, d):
    # the whole offline chain over short signals at a low rate: cut, recognise, parse, align, merge
    recordings = table(spark, d, "embeddings").select(
        "vec_id", F.array("embedding").alias("channels"), F.lit(16).alias("sr"), F.lit("numbers").alias("context"),
        F.when(F.col("label") == 2, "french").alias("language"),
    )
    done = transcribe(
        recordings, "vec_id", TEMPLATE, recogniser, aligner, max_chunk_sec=2.0, expand_sec=0.5, target_sr=16
    )
    return done.select("vec_id", "language", "text", F.size("time_stamps").alias("spans"), F.element_at("time_stamps", -1)["end_time"].alias("last_end"))
