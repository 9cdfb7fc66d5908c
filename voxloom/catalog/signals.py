"""Queries over waveforms. An embedding stands for a short signal at a low rate, so that seconds are meaningful."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from voxloom.catalog.registry import query
from voxloom.functions import signal as G
from voxloom.operators import windows as W
from voxloom.operators.joins import slice_span_rows
from voxloom.operators.longsignals import split_blocks
from voxloom.operators.ordered import with_running
from voxloom.sources import audio as U
from voxloom.session import scratch_path
from voxloom.sources.readers import table

SR = 16


def _waves(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("wav"), "label")


def _stats(df, wav="out"):
    """Size and a weighted sum of a signal, so that order matters; the sum runs in double precision in array order."""
    x = F.transform(wav, lambda v, i: v.cast("double") * (i + 1))
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    return df.select("vec_id", F.size(wav).cast("bigint").alias("n"), F.round(total, 3).alias("weighted"))


def _stats_sql(expression: str, source: str = "embeddings") -> str:
    return f"""SELECT vec_id, len(out) AS n, round(coalesce(list_sum(list_transform(out, lambda v, i: v::DOUBLE * i)), 0), 3) AS weighted
               FROM (SELECT vec_id, {expression} AS out FROM {source})"""


# --- inputs ---------------------------------------------------------------------------------------------------------


@query(
    "classify_audio_input",
    """WITH v AS (
      SELECT 'p' || page_id AS id, CASE WHEN page_id % 4 = 0 THEN url WHEN page_id % 4 = 1 THEN upper(url) WHEN page_id % 4 = 2 THEN 'ftp' || url ELSE 'http:///' || url END AS v FROM pages
      UNION ALL SELECT 'd' || doc_id, CASE WHEN doc_id % 9 = 0 THEN 'data:audio/wav;base64,' || text ELSE text END FROM documents)
    SELECT id, CASE WHEN regexp_matches(v, '^(?i:https?)://[^/?#]') THEN 'url' WHEN starts_with(v, 'data:audio') THEN 'base64'
      WHEN NOT contains(v, '/') AND NOT contains(v, chr(92)) AND length(v) > 256 THEN 'base64' ELSE 'path' END AS kind FROM v""",
)
def _(spark, d):
    # urls as they are, in capitals, with another scheme and without a host; texts with and without a data head
    form = F.col("page_id") % 4
    url = (
        F.when(form == 0, F.col("url")).when(form == 1, F.upper("url"))
        .when(form == 2, F.concat(F.lit("ftp"), "url")).otherwise(F.concat(F.lit("http:///"), "url"))
    )
    pages = table(spark, d, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), url.alias("v"))
    text = F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("data:audio/wav;base64,"), "text")).otherwise(F.col("text"))
    docs = table(spark, d, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), text.alias("v"))
    return pages.unionByName(docs).select("id", U.classify_audio_input(F.col("v")).alias("kind"))


@query(
    "decode_base64_payload",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN NULL ELSE octet_length(encode(text)) END AS n,
              CASE WHEN doc_id % 5 = 4 THEN NULL ELSE md5(text) END AS payload_md5 FROM documents""",
)
def _(spark, d):
    # plain, with a head, with blanks before the head, and (one in five) broken
    form = F.col("doc_id") % 5
    body = F.base64(F.encode("text", "utf-8"))
    body = F.regexp_replace(body, r"\s", "")
    value = (
        F.when(form == 1, F.concat(F.lit("data:audio/wav;base64,"), body))
        .when(form == 2, F.concat(F.lit(" \ndata:audio/wav;base64,"), body))
        .when(form == 4, F.concat(F.lit("*"), body)).otherwise(body)
    )
    payload = U.decode_base64_payload(value)
    return table(spark, d, "documents").select(
        "doc_id", F.octet_length(payload).cast("bigint").alias("n"), F.md5(payload).alias("payload_md5")
    )


@F.pandas_udf(BinaryType())
def _pack(signals: pd.Series) -> pd.Series:
    return signals.map(lambda s: np.asarray(s, dtype="<f4").tobytes())


@query(
    "decode_pcm_f32",
    """SELECT vec_id, CASE WHEN label = 3 THEN -1 ELSE len(embedding) END AS n,
       CASE WHEN label = 3 THEN NULL ELSE round(list_sum(list_transform(embedding, lambda v, i: v::DOUBLE * i)), 3) END AS weighted FROM embeddings""",
)
def _(spark, d):
    packed = _waves(spark, d).withColumn("body", _pack("wav"))
    # a label of three stands for a body that lost a byte
    body = F.when(F.col("label") == 3, F.substring("body", 1, 255)).otherwise(F.col("body"))
    decoded = packed.select("vec_id", U.decode_pcm_f32(body).alias("out"))
    total = F.aggregate(F.transform("out", lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return decoded.select(
        "vec_id", F.coalesce(F.size("out"), F.lit(-1)).cast("bigint").alias("n"), F.round(total, 3).alias("weighted")
    )


@query(
    "scan_audio_manifest",
    """SELECT vec_id, CASE WHEN label = 7 THEN NULL ELSE 8 END AS sr, CASE WHEN label = 7 THEN -1.0 ELSE len(embedding) / 8.0 END AS duration FROM embeddings""",
)
def _(spark, d):
    # one file per signal in the shared folder; one label stands for files that were cut off in the header
    folder = scratch_path(spark, "clips")
    content = U.wav_bytes(G.to_pcm16(F.col("wav")), 8)
    content = F.when(F.col("label") == 7, F.substring(content, 1, 20)).otherwise(content)
    name = F.concat("vec_id", F.lit(".wav"))
    U.write_audio_files(_waves(spark, d).select(name.alias("name"), content.alias("content")), folder)
    files = U.scan_audio_manifest(spark, folder)
    return files.select(F.regexp_extract("path", r"(\d+)\.wav$", 1).cast("bigint").alias("vec_id"), "sr", "duration")


# --- waveform functions ---------------------------------------------------------------------------------------------


@query(
    "audio_token_length",
    """SELECT l_orderkey, l_linenumber, CAST(floor(((floor((((floor(((f % 100) - 1) / 2.0) + 1) - 1)) / 2.0) + 1) - 1) / 2.0) + 1 + (f // 100) * 13 AS BIGINT) AS tokens
       FROM (SELECT l_orderkey, l_linenumber, l_partkey * 100 + l_linenumber * (l_suppkey % 30) AS f FROM lineitem)""",
)
def _(spark, d):
    frames = F.col("l_partkey") * 100 + F.col("l_linenumber") * (F.col("l_suppkey") % 30)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", G.audio_token_length(frames).alias("tokens"))


@query(
    "to_mono",
    _stats_sql(
        """CASE WHEN label % 2 = 0 THEN list_transform(embedding, lambda v, i: ((v + embedding[len(embedding) + 1 - i])::FLOAT / 2)::FLOAT)
                ELSE list_transform(range(1, len(embedding) // 2 + 1), lambda i: ((embedding[2 * i - 1] + embedding[2 * i])::FLOAT / 2)::FLOAT) END"""
    ),
)
def _(spark, d):
    # two channels of 64 samples (the second is the first reversed), or 32 frames of two channels
    wav = F.col("wav")
    rows = F.array(wav, F.reverse(wav))
    frames = F.transform(F.sequence(F.lit(0), F.floor(F.size(wav) / 2).cast("int") - 1), lambda i: F.slice(wav, i * 2 + 1, F.lit(2)))
    waves = _waves(spark, d).withColumn("channels", F.when(F.col("label") % 2 == 0, rows).otherwise(frames))
    return _stats(waves.withColumn("out", G.to_mono(F.col("channels"))))


_NORMAL_SQL = """CASE WHEN list_max(list_transform(x, lambda v: abs(v))) > 1
     THEN list_transform(x, lambda v: greatest(least((v / list_max(list_transform(x, lambda w: abs(w))))::FLOAT, 1), -1)) ELSE x END"""


@query(
    "normalize_range",
    _stats_sql(_NORMAL_SQL, "(SELECT vec_id, list_transform(embedding, lambda v: (v * (label * 2)::FLOAT)::FLOAT) AS x FROM embeddings)"),
)
def _(spark, d):
    waves = _waves(spark, d)
    scaled = waves.withColumn("x", F.transform("wav", lambda v: v * (F.col("label") * 2).cast("float")))
    return _stats(scaled.withColumn("out", G.normalize_range(F.col("x"))))


@query(
    "normalize_int_pcm",
    """SELECT event_id, greatest(-1, least(1, s / 32768.0))::FLOAT AS signed16, greatest(-1, least(1, ((s % 256) - 128) / 128.0))::FLOAT AS unsigned8,
              (s / 32768.0)::FLOAT AS stream16, greatest(-1, least(1, CASE WHEN value > 1 + 1e-6 THEN value::FLOAT / (value::FLOAT::DOUBLE + 1e-12) ELSE value END))::FLOAT AS scaled
       FROM (SELECT event_id, value, CAST(floor(value * 100) AS BIGINT) % 32768 AS s FROM events)""",
)
def _(spark, d):
    whole = (F.floor(F.col("value") * 100) % 32768).cast("bigint")
    events = table(spark, d, "events").select("event_id", "value", whole.alias("s"))

    def first(column):
        return F.get(column, F.lit(0))

    return events.select(
        "event_id",
        first(G.normalize_int_pcm(F.array("s"), 16)).alias("signed16"),
        first(G.normalize_int_pcm(F.array(F.col("s") % 256), 8, signed=False)).alias("unsigned8"),
        first(G.stream_pcm16(F.array(F.col("s").cast("smallint")))).alias("stream16"),
        first(G.normalize_float_pcm(F.array(F.col("value").cast("float")))).alias("scaled"),
    )


def _resample_sql(position: str, count: str) -> str:
    at = f"({position})"
    return f"""list_transform(range(0, ({count})::BIGINT), lambda i:
      (embedding[floor({at})::INT + 1]::DOUBLE * (1 - ({at} - floor({at}))) + embedding[least(floor({at})::INT + 2, len(embedding))]::DOUBLE * ({at} - floor({at})))::FLOAT)"""


@query(
    "resample_linear",
    """SELECT a.vec_id, a.n, a.weighted, b.n AS grid_n, b.weighted AS grid_weighted FROM ("""
    + _stats_sql(_resample_sql("i * ((label + 9) / 16.0::DOUBLE)", "floor(len(embedding) * 16.0::DOUBLE / (label + 9) + 0.5)"))
    + ") a JOIN ("
    + _stats_sql(_resample_sql("i::DOUBLE * len(embedding) / round_even(len(embedding)::DOUBLE / (label + 9) * 16, 0)", "round_even(len(embedding)::DOUBLE / (label + 9) * 16, 0)"))
    + ") b USING (vec_id)",
)
def _(spark, d):
    # rates of 9 to 18 samples a second, to 16
    sr = F.col("label") + 9
    waves = _waves(spark, d)
    plain = _stats(waves.withColumn("out", G.resample_linear(F.col("wav"), sr, SR)))
    grid = _stats(waves.withColumn("out", G.resample_even_grid(F.col("wav"), sr, SR)))
    return plain.join(grid.toDF("vec_id", "grid_n", "grid_weighted"), "vec_id")


@query(
    "normalize_waveform",
    _stats_sql(
        _NORMAL_SQL,
        "(SELECT vec_id, "
        + _resample_sql("i / 2.0::DOUBLE", "len(embedding) * 2")
        + " AS x FROM (SELECT vec_id, list_transform(embedding, lambda v, i: ((v * 4 + embedding[len(embedding) + 1 - i] * 4)::FLOAT / 2)::FLOAT) AS embedding FROM embeddings))",
    ),
)
def _(spark, d):
    loud = F.transform("wav", lambda v: v * F.lit(4.0).cast("float"))
    out = G.normalize_waveform(F.array(loud, F.reverse(loud)), F.lit(8), SR)
    return _stats(_waves(spark, d).withColumn("out", out))


# --- cuts -----------------------------------------------------------------------------------------------------------


@query(
    "quiet_boundary",
    """WITH seg AS (SELECT vec_id, unnest(embedding[17:48]) AS x, unnest(range(0, 32)) AS i FROM embeddings),
    energy AS (SELECT vec_id, i, sum(abs(x::DOUBLE)) OVER f AS e, count(*) OVER f AS n FROM seg
               WINDOW f AS (PARTITION BY vec_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
    best AS (SELECT vec_id, i AS w FROM energy WHERE n = 4 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY e, i) = 1),
    inner_best AS (SELECT vec_id, i FROM seg JOIN best USING (vec_id) WHERE i BETWEEN w AND w + 3
                   QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY abs(x), i) = 1)
    SELECT vec_id, CAST(greatest(16 + i, 1) AS BIGINT) AS boundary FROM inner_best""",
)
def _(spark, d):
    # two seconds at 16 samples a second, one second to either side, windows of four samples
    cuts = W.quiet_boundary(_waves(spark, d), "vec_id", "wav", SR, max_chunk_sec=2.0, expand_sec=1.0)
    return cuts.select("vec_id", F.col("boundary").cast("bigint").alias("boundary"))


def chunk_rows(spark, d):
    return W.split_long_signal(_waves(spark, d), "vec_id", "wav", SR, max_chunk_sec=1.0, expand_sec=0.5)


# every cut is found from the one before: 16 samples on, 8 to either side, windows of four samples
@query(
    "split_long_signal",
    """WITH RECURSIVE cuts AS (
      SELECT vec_id, embedding AS w, 0::BIGINT AS chunk_index, 0::BIGINT AS a FROM embeddings
      UNION ALL
      SELECT vec_id, w, chunk_index + 1, greatest(lo + q + list_position(loud[q + 1 : q + 4], list_min(loud[q + 1 : q + 4])) - 1, a + 1)
      FROM (SELECT *, list_position(e, list_min(e)) - 1 AS q FROM (
        SELECT *, list_transform(range(1, len(loud) - 2), lambda i: loud[i]::DOUBLE + loud[i + 1] + loud[i + 2] + loud[i + 3]) AS e FROM (
          SELECT *, greatest(a, a + 8) AS lo, list_transform(w[a + 9 : a + 24], lambda x: abs(x)) AS loud FROM cuts WHERE len(w) - a > 16)))),
    chunks AS (SELECT vec_id, chunk_index, a, coalesce(lead(a) OVER (PARTITION BY vec_id ORDER BY chunk_index), len(w)) - a AS n FROM cuts)
    SELECT vec_id, chunk_index, n AS n_samples, greatest(n, 8) AS n_padded, a / 16.0::DOUBLE AS offset_sec FROM chunks""",
)
def _(spark, d):
    return chunk_rows(spark, d).select(
        "vec_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), F.col("n_samples").cast("bigint").alias("n_samples"),
        F.size("wav").cast("bigint").alias("n_padded"), "offset_sec",
    )


# signals of 32 vectors, each vector a block of samples; a stretch is as short as the longest chunk allows
@query(
    "split_long_signal_blocks",
    """WITH RECURSIVE signals AS (SELECT vec_id // 32 AS signal, flatten(list(embedding ORDER BY vec_id)) AS w FROM embeddings GROUP BY ALL),
    cuts AS (
      SELECT signal, 0::BIGINT AS chunk_index, 0::BIGINT AS a FROM signals
      UNION ALL
      SELECT signal, chunk_index + 1, greatest(lo + q + list_position(loud[q + 1 : q + 4], list_min(loud[q + 1 : q + 4])) - 1, a + 1)
      FROM (SELECT *, list_position(e, list_min(e)) - 1 AS q FROM (
        SELECT *, list_transform(range(1, len(loud) - 2), lambda i: round(loud[i]::DOUBLE + loud[i + 1] + loud[i + 2] + loud[i + 3], 9)) AS e FROM (
          SELECT signal, chunk_index, a, a + 8 AS lo, list_transform(w[a + 9 : a + 24], lambda x: abs(x)) AS loud
          FROM cuts JOIN signals USING (signal) WHERE len(w) - a > 16)))),
    chunks AS (SELECT signal, chunk_index, a, coalesce(lead(a) OVER (PARTITION BY signal ORDER BY chunk_index), len(w)) - a AS n, w FROM cuts JOIN signals USING (signal))
    SELECT signal, chunk_index, n AS n_samples, greatest(n, 8) AS n_padded, a / 16.0::DOUBLE AS offset_sec,
           md5(array_to_string(list_transform(w[a + 1 : a + n], lambda x: trunc((greatest(least(x, 1), -1) * 32767::FLOAT)::FLOAT)::BIGINT::VARCHAR), ',')) AS pcm_md5
    FROM chunks""",
)
def _(spark, d):
    waves = _waves(spark, d).withColumn("signal", F.floor(F.col("vec_id") / 32))
    size = F.size("wav").cast("bigint")
    blocks = with_running(waves.select("signal", "vec_id", "wav"), ["signal"], ["vec_id"], F.col("signal"), size, "start")
    chunks = split_blocks(blocks, "signal", "start", "wav", SR, max_chunk_sec=1.0, expand_sec=0.5, stretch=1)
    pcm = G.to_pcm16(F.slice("wav", F.lit(1), F.col("n_samples"))).cast("array<string>")
    return chunks.select(
        "signal", F.col("chunk_index").cast("bigint").alias("chunk_index"), F.col("n_samples").cast("bigint").alias("n_samples"),
        F.size("wav").cast("bigint").alias("n_padded"), "offset_sec", F.md5(F.array_join(pcm, ",")).alias("pcm_md5"),
    )


_SPANS_SQL = """WITH s AS (SELECT vec_id, embedding AS w, k, k * 0.7::DOUBLE + label / 7.0::DOUBLE - 0.5 AS a, k * 0.9::DOUBLE + label / 11.0::DOUBLE AS b
                  FROM embeddings, unnest(range(0, 6)) AS t(k) WHERE label <> 5),
    cut AS (SELECT vec_id, k, w[greatest(0, trunc(a * 16)::INT) + 1 : least(len(w), trunc(b * 16)::INT)] AS seg FROM s
            WHERE b > a AND least(len(w), trunc(b * 16)::INT) > greatest(0, trunc(a * 16)::INT))
    SELECT vec_id, k AS word, len(seg) AS n, CAST(list_sum(list_transform(seg, lambda x: trunc((greatest(least(x, 1), -1) * 32767::FLOAT)::FLOAT)::BIGINT)) AS BIGINT) AS pcm_sum FROM cut"""


@query("slice_spans", _SPANS_SQL)
def _(spark, d):
    # six spans per signal, some reversed or outside; one label has no times at all
    k, label = F.col("word"), F.col("label")
    words = _waves(spark, d).withColumn("word", F.explode(F.sequence(F.lit(0), F.lit(5))))
    start = F.when(label != 5, k * 0.7 + label / F.lit(7.0) - 0.5)
    cut = G.slice_span(F.col("wav"), F.lit(SR), start, k * 0.9 + label / F.lit(11.0))
    spans = words.select("vec_id", k.cast("bigint").alias("word"), G.to_pcm16(cut).alias("pcm")).where(F.col("pcm").isNotNull())
    return spans.select(
        "vec_id", "word", F.size("pcm").cast("bigint").alias("n"),
        F.aggregate("pcm", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pcm_sum"),
    )


@query("slice_spans_rows", _SPANS_SQL)
def _(spark, d):
    # the same spans over signals of one row per sample, in blocks of 16 samples
    waves = _waves(spark, d)
    samples = waves.select("vec_id", F.posexplode("wav").alias("pos", "x"))
    words = waves.select("vec_id", "label", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("word"))
    words = words.withColumn("word", F.col("word").cast("bigint"))
    k, label = F.col("word"), F.col("label")
    cut = slice_span_rows(
        samples, words, "vec_id", "pos", "x", "word", F.when(label != 5, k * 0.7 + label / F.lit(7.0) - 0.5),
        k * 0.9 + label / F.lit(11.0), SR, block=16,
    )
    return cut.select(
        "vec_id", "word", F.col("n").cast("bigint").alias("n"),
        F.aggregate(G.to_pcm16(F.col("wav")), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pcm_sum"),
    )
