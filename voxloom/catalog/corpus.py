"""Queries over the corpus job: scans, validation, limits, statistics, shards, splits, exports."""

from pyspark.sql import functions as F

from voxloom.catalog.registry import RUNS, SAMPLES, documents, query, sql_trim, training_samples
from voxloom.catalog.texts import WORDS_SQL
from voxloom.constants import TEXT_TAG
from voxloom.functions.signal import audio_token_length
from voxloom.functions.text import count_tokens, extract_language_tag, format_training_text, preview
from voxloom.operators import aggregates as A
from voxloom.operators import filters as P
from voxloom.operators import ordered as O
from voxloom.operators import sampling as S
from voxloom.operators.joins import map_language_code, missing_from_listing, missing_in_sample
from voxloom.session import scratch_path
from voxloom.sources import readers as R
from voxloom.sources import writers as W
from voxloom.sources.readers import table

TEMPLATE = "<|system|>%s<|end|>\n<|user|><|audio_pad|><|end|>\n<|assistant|>"
TEMPLATE_SQL = TEMPLATE.replace("\n", "' || chr(10) || '")
SHUFFLE_KEY_SQL = "md5('42:' || doc_id)"
DIRECTORY_SQL = "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents"


def _content(df):
    return df.select("doc_id", "lang", F.md5("text").alias("text_md5"))


# --- scans ----------------------------------------------------------------------------------------------------------


@query(
    "scan_parquet_shards",
    "SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY lang",
)
def _(spark, d):
    docs = R.scan_parquet_shards(spark, d, "documents.parquet")
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("bigint")).alias("chars"))


@query("scan_dataset_split", DIRECTORY_SQL + " WHERE lang = 'fr'")
def _(spark, d):
    path = scratch_path(spark, "split")
    table(spark, d, "documents").withColumn("split", F.col("lang")).write.partitionBy("split").parquet(path)
    return _content(R.scan_dataset_split(spark, path, "fr"))


@query(
    "scan_jsonl",
    f"""WITH {SAMPLES} SELECT audio, md5(tagged) AS text_md5, CASE WHEN lang = 'en' THEN 'train' ELSE 'validation' END AS split,
         CASE WHEN lang = 'de' THEN NULL ELSE source END AS prompt FROM samples""",
)
def _(spark, d):
    path = scratch_path(spark, "jsonl")
    docs = training_samples(spark, d)
    rows = docs.select("lang", "audio", F.col("tagged").alias("text"), F.when(F.col("lang") != "de", F.col("source")).alias("prompt"))
    W.write_jsonl(rows.where("lang = 'en'").drop("lang"), f"{path}/train")
    W.write_jsonl(rows.where("lang <> 'en' OR lang IS NULL").drop("lang"), f"{path}/validation")
    back = R.scan_jsonl(spark, {"train": f"{path}/train", "validation": f"{path}/validation"})
    return back.select("audio", F.md5("text").alias("text_md5"), "split", "prompt")


@query("scan_merge_machines", DIRECTORY_SQL)
def _(spark, d):
    path = scratch_path(spark, "machines")
    docs = table(spark, d, "documents")
    for machine in range(4):
        docs.where(F.col("doc_id") % 4 == machine).write.parquet(f"{path}/machine_{machine:02d}")
    return _content(R.scan_merge_machines(spark, path))


@query(
    "union_machine_outputs",
    """SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source""",
)
def _(spark, d):
    docs = table(spark, d, "documents")
    outputs = [docs.where(F.col("doc_id") % 4 == machine) for machine in range(4)]
    merged = R.union_machine_outputs(*outputs)
    return merged.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("bigint")).alias("chars"))


# --- validation -----------------------------------------------------------------------------------------------------


@query(
    "first_assistant_turn",
    f"""SELECT conv_id, {sql_trim("arg_min(text, turn)")} AS transcript FROM conversations WHERE role = 'assistant' GROUP BY conv_id""",
)
def _(spark, d):
    return P.first_assistant_rows(table(spark, d, "conversations"), "conv_id", "turn", "role", "text")


_AUDIOS_SQL = "CASE WHEN n_chars % 7 = 0 THEN NULL ELSE 'clips/' || source || '/' || doc_id || '.wav' END"


@query("first_audio_path", f"SELECT doc_id, {_AUDIOS_SQL} AS audio FROM documents")
def _(spark, d):
    docs = training_samples(spark, d)
    audios = F.when(F.col("n_chars") % 7 == 0, F.array().cast("array<string>")).otherwise(F.array("audio", "source"))
    return docs.select("doc_id", P.first_audio_path(audios).alias("audio"))


@query(
    "join_base_path",
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/abs/' || url ELSE '/data/corpus/' || url END AS path FROM pages""",
)
def _(spark, d):
    url = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/abs/"), "url")).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", P.join_base_path("/data/corpus", url).alias("path"))


@query(
    "valid_samples",
    f"""WITH s AS (SELECT conv_id, {sql_trim("coalesce(arg_min(text, turn) FILTER (role = 'assistant'), '')")} AS transcript,
               CASE WHEN count(*) % 5 = 0 THEN NULL ELSE 'clips/' || conv_id || '.wav' END AS audio
               FROM conversations GROUP BY conv_id)
    SELECT conv_id, audio, md5(transcript) AS transcript_md5 FROM s WHERE transcript <> '' AND audio IS NOT NULL""",
)
def _(spark, d):
    messages = table(spark, d, "conversations")
    # a sample whose message count is a multiple of five stands for one without audio
    sizes = messages.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.col("text"), F.when(F.col("role") == "assistant", F.col("turn"))).alias("content"),
        F.count_if(F.col("role") == "assistant").alias("turns"),
    )
    transcript = P.trim_py(F.when(F.col("turns") > 0, F.col("content")))
    audio = F.when(F.col("n") % 5 != 0, F.concat(F.lit("clips/"), "conv_id", F.lit(".wav")))
    valid = sizes.select("conv_id", transcript.alias("transcript"), audio.alias("audio"))
    valid = valid.where(P.is_valid_sample(F.col("transcript"), F.col("audio")))
    return valid.select("conv_id", "audio", F.md5("transcript").alias("transcript_md5"))


# --- limits ---------------------------------------------------------------------------------------------------------

_SPANS_SQL = "SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 / 86400 AS duration FROM events GROUP BY user_id"


def _spans(spark, d):
    # days between the first and the last event of a user stand in for seconds of audio
    events = table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return events.select(
        "user_id", ((O.micros(F.col("b")) - O.micros(F.col("a"))) / 1000000.0 / 86400).alias("duration")
    )


@query("filter_duration", f"SELECT user_id, round(duration, 6) AS duration FROM ({_SPANS_SQL}) WHERE duration > 0 AND duration <= 29.5")
def _(spark, d):
    kept = _spans(spark, d).where(P.within_duration(F.col("duration"), 29.5))
    return kept.select("user_id", F.round("duration", 6).alias("duration"))


@query(
    "filter_summary",
    f"""WITH s AS (SELECT coalesce(duration > 0 AND duration <= 29.5, false) AS keep FROM ({_SPANS_SQL}))
    SELECT count(*) AS total, count(*) FILTER (keep) AS kept, count(*) FILTER (NOT keep) AS removed,
           round(100.0 * count(*) FILTER (NOT keep) / count(*), 2) AS removed_pct FROM s""",
)
def _(spark, d):
    return A.filter_summary(_spans(spark, d), P.within_duration(F.col("duration"), 29.5))


@query("filter_char_limit", "SELECT doc_id, n_chars FROM documents WHERE length(text) <= 2000")
def _(spark, d):
    docs = table(spark, d, "documents")
    return docs.where(~P.over_char_limit(F.col("text"), 2000)).select("doc_id", "n_chars")


@query("filter_token_limit", f"WITH {WORDS_SQL} SELECT doc_id, len(words) AS tokens FROM words WHERE len(words) <= 256")
def _(spark, d):
    docs = documents(spark, d).select("doc_id", count_tokens(F.col("text")).cast("bigint").alias("tokens"))
    return docs.where(~P.over_token_limit(F.col("tokens"), 256))


REASONS_SQL = f"""{RUNS}, {WORDS_SQL},
longest AS (SELECT doc_id, max(n) FILTER (c <> chr(10)) AS run FROM runs GROUP BY doc_id),
cheap AS (
  SELECT d.doc_id, d.text, length(d.text)::INTEGER AS char_count, len(w.words)::INTEGER AS words,
         CASE WHEN coalesce(run, 0) > 10 THEN 'repetition' WHEN length(d.text) > 4000 THEN 'char_limit' END AS c
  FROM documents d JOIN words w USING (doc_id) LEFT JOIN longest l USING (doc_id)),
checked AS (
  SELECT doc_id, text, char_count, CASE WHEN c IS NULL THEN words END AS token_count,
         coalesce(c, CASE WHEN words > 300 THEN 'token_limit' END) AS reason FROM cheap)"""


def _checked(spark, d):
    docs = documents(spark, d).select("doc_id", "text")
    return P.with_reject_reason(docs, "text", max_chars=4000, max_tokens=300)


@query("reject_reason", f"WITH {REASONS_SQL} SELECT doc_id, char_count, token_count, reason FROM checked")
def _(spark, d):
    return _checked(spark, d).select("doc_id", "char_count", "token_count", "reason")


@query(
    "reject_counts",
    f"""WITH {REASONS_SQL} SELECT count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason IS NOT NULL) AS rejected,
        count(*) FILTER (reason = 'repetition') AS rejected_repetition FROM checked""",
)
def _(spark, d):
    return A.reject_counts(_checked(spark, d))


@query(
    "rejected_range",
    f"WITH {REASONS_SQL} SELECT min(token_count) AS low, max(token_count) AS high FROM checked WHERE reason IS NOT NULL AND token_count > 0",
)
def _(spark, d):
    return A.rejected_range(_checked(spark, d), "token_count", F.col("reason").isNotNull())


@query(
    "transcript_preview",
    "SELECT doc_id, CASE WHEN length(text) > 200 THEN text[:200] || '...' ELSE text END AS preview FROM documents",
)
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", preview(F.col("text")).alias("preview"))


_SEQUENCE_SQL = f"""{WORDS_SQL}, lengths AS (
  SELECT doc_id, 12 + (CAST(ceil(((n_chars * 7) % 100) / 8.0) AS BIGINT) + 13 * ((n_chars * 7) // 100)) + len(words) + 1 AS seq_len
  FROM documents JOIN words USING (doc_id))"""


def _sequence_lengths(spark, d):
    # seven frames per character stand in for the audio of a text; the prefix has twelve tokens
    docs = documents(spark, d)
    length = P.sequence_length(F.lit(12), F.col("n_chars") * 7, count_tokens(F.col("text")))
    return docs.select("doc_id", length.cast("bigint").alias("seq_len"))


@query("filter_sequence_length", f"WITH {_SEQUENCE_SQL} SELECT doc_id, seq_len FROM lengths WHERE seq_len <= 2048")
def _(spark, d):
    return _sequence_lengths(spark, d).where(P.within_sequence(F.col("seq_len")))


def _measure(texts):
    """Stands for a user's processor: refuses texts with a dollar run."""
    if texts.str.contains("$$$", regex=False).any():
        raise ValueError("cannot process " + texts.iloc[0])
    return texts.str.len()


@query(
    "sequence_errors",
    """SELECT doc_id, CAST(CASE WHEN contains(text, '$$$') THEN -1 ELSE length(text) END AS INTEGER) AS seq_len,
              CASE WHEN contains(text, '$$$') THEN ('cannot process ' || text)[:100] END AS error FROM documents""",
)
def _(spark, d):
    return P.sequence_lengths(table(spark, d, "documents"), "doc_id", "text", _measure)


@query(
    "reject_too_short_audio",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) // 2 AS frames,
              CAST(ceil(((CAST(l_quantity AS BIGINT) // 2) % 100) / 8.0) AS BIGINT) AS tokens
       FROM lineitem WHERE CAST(l_quantity AS BIGINT) // 2 > 0""",
)
def _(spark, d):
    items = table(spark, d, "lineitem")
    frames = F.shiftright(F.col("l_quantity").cast("bigint"), 1)
    sized = items.select("l_orderkey", "l_linenumber", frames.alias("frames"), audio_token_length(frames).alias("tokens"))
    return sized.where(F.col("tokens") > 0)


# --- projections ----------------------------------------------------------------------------------------------------


def _prefixed(spark, d):
    docs = training_samples(spark, d)
    rows = docs.select("doc_id", "audio", F.col("tagged").alias("text"), F.when(F.col("lang") != "de", F.col("source")).alias("prompt"))
    return rows


_PREFIX_SQL = f"""{SAMPLES}, p AS (SELECT CASE WHEN lang = 'de' THEN '' ELSE source END AS prompt, audio, tagged AS target FROM samples)
SELECT prompt, audio, md5(target) AS target_md5, '{TEMPLATE_SQL.replace('%s', "' || prompt || '")}' AS prefix_text FROM p"""


@query("build_prefix_rows", f"WITH {_PREFIX_SQL}")
def _(spark, d):
    rows = P.build_prefix_rows(_prefixed(spark, d), TEMPLATE)
    return rows.select("prompt", "audio", F.md5("target").alias("target_md5"), "prefix_text")


@query("project_keep_columns", f"WITH {SAMPLES} SELECT audio, md5(tagged) AS target_md5 FROM samples")
def _(spark, d):
    rows = P.build_prefix_rows(_prefixed(spark, d), TEMPLATE)
    return rows.select("audio", F.md5("target").alias("target_md5"))


@query(
    "build_prompts",
    f"""SELECT conv_id, turn, '{TEMPLATE_SQL.replace('%s', "' || CASE WHEN role = 'system' THEN '' ELSE role END || '")}'
         || CASE WHEN role = 'user' THEN 'language English{TEXT_TAG}' ELSE '' END AS prompt FROM conversations""",
)
def _(spark, d):
    forced = F.when(F.col("role") == "user", "English").when(F.col("role") == "system", " ")
    context = F.when(F.col("role") != "system", F.col("role"))
    return table(spark, d, "conversations").select("conv_id", "turn", P.build_prompt(context, forced, TEMPLATE).alias("prompt"))


@query(
    "expand_audio_tokens",
    """SELECT doc_id, length(r) AS n, md5(r) AS text_md5 FROM (
         SELECT doc_id, lang || repeat('<|audio_pad|>', (n_chars % 5)::INT) || source || repeat('<|audio_pad|>', (n_chars % 3)::INT) AS r FROM documents)""",
)
def _(spark, d):
    text = F.concat("lang", F.lit("<|audio_pad|>"), "source", F.lit("<|audio_pad|>"))
    lengths = F.array(F.col("n_chars") % 5, F.col("n_chars") % 3)
    grown = P.expand_audio_tokens(text, lengths)
    return table(spark, d, "documents").select("doc_id", F.length(grown).cast("bigint").alias("n"), F.md5(grown).alias("text_md5"))


@query(
    "nonempty_text",
    f"""SELECT conv_id, turn FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN ' ' || chr(9) || chr(160) ELSE text END AS t FROM conversations)
        WHERE {sql_trim('t')} <> ''""",
)
def _(spark, d):
    rows = table(spark, d, "conversations").withColumn("t", F.when(F.col("turn") % 3 == 0, F.lit(" \t\xa0")).otherwise(F.col("text")))
    return P.nonempty_text(rows, "t").select("conv_id", "turn")


# --- statistics -----------------------------------------------------------------------------------------------------


@query(
    "language_distribution",
    f"WITH {SAMPLES} SELECT language, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM samples GROUP BY language",
)
def _(spark, d):
    docs = map_language_code(R.scan_parquet_shards(spark, d, "documents.parquet"), "lang")
    tagged = format_training_text(F.col("language"), F.col("text"))
    named = docs.select(extract_language_tag(tagged).alias("language"))
    return A.distribution(named, "language").orderBy(F.desc("n"), "language")


_SPLIT_SQL = f"""split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY {SHUFFLE_KEY_SQL}, doc_id) <= ceil(round(0.003 * count(*) OVER (), 9)) THEN 'eval' ELSE 'train' END AS split
  FROM documents)"""


@query(
    "split_counts",
    f"WITH {_SPLIT_SQL} SELECT split, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM split GROUP BY split",
)
def _(spark, d):
    return A.distribution(S.train_eval_split(table(spark, d, "documents"), "doc_id"), "split")


# --- order, shards, splits ------------------------------------------------------------------------------------------


@query("train_eval_split", f"WITH {_SPLIT_SQL} SELECT doc_id, split FROM split")
def _(spark, d):
    return S.train_eval_split(table(spark, d, "documents"), "doc_id").select("doc_id", "split")


@query("seeded_shuffle", f"SELECT doc_id, row_number() OVER (ORDER BY {SHUFFLE_KEY_SQL}, doc_id) - 1 AS pos FROM documents")
def _(spark, d):
    return S.seeded_shuffle(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("sample_fixed_n", f"SELECT doc_id, lang FROM documents ORDER BY {SHUFFLE_KEY_SQL}, doc_id LIMIT 100")
def _(spark, d):
    return S.sample_fixed(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 100).drop("digest")


@query("assign_contiguous_shards", "SELECT o_orderkey, ntile(16) OVER (ORDER BY o_orderkey) - 1 AS shard FROM orders")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    placed = O.with_position(orders, [], ["o_orderkey"], O.range_block(orders, "o_orderkey"), "pos", "total")
    return placed.select("o_orderkey", O.contiguous_part(F.col("pos"), F.col("total"), 16).alias("shard"))


@query("micro_batches", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 32 AS batch FROM orders")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    placed = O.with_position(orders, [], ["o_orderkey"], O.range_block(orders, "o_orderkey"))
    return placed.select("o_orderkey", O.batch_number(F.col("pos"), 32).alias("batch"))


@query(
    "keep_input_order",
    f"WITH {REASONS_SQL} SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS line FROM checked WHERE reason IS NULL",
)
def _(spark, d):
    kept = _checked(spark, d).where(F.col("reason").isNull()).select("doc_id")
    return O.with_position(kept, [], ["doc_id"], O.range_block(kept, "doc_id"), "line")


@query(
    "write_parquet_shards",
    f"""SELECT shard, count(*) AS n, min(doc_id) AS low, CAST(sum(length(text)) AS BIGINT) AS chars
        FROM (SELECT *, ntile(12) OVER (ORDER BY {SHUFFLE_KEY_SQL}, doc_id) - 1 AS shard FROM documents) GROUP BY shard""",
)
def _(spark, d):
    path = scratch_path(spark, "shards")
    W.write_parquet_shards(table(spark, d, "documents").select("doc_id", "text"), path, "doc_id", 12)
    return spark.read.parquet(path).groupBy(F.col("shard").cast("bigint").alias("shard")).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.sum(F.length("text").cast("bigint")).alias("chars")
    )


@query(
    "write_jsonl",
    f"WITH {SAMPLES} SELECT audio, md5(tagged) AS text_md5, CASE WHEN lang = 'de' THEN NULL ELSE source END AS prompt FROM samples",
)
def _(spark, d):
    path = scratch_path(spark, "jsonl")
    W.write_jsonl(_prefixed(spark, d).select("audio", "text", "prompt"), path)
    return R.scan_jsonl(spark, {"train": path}).select("audio", F.md5("text").alias("text_md5"), "prompt")


_REJECTED_SQL = f"""WITH {REASONS_SQL} SELECT doc_id, char_count, token_count, reason,
  CASE WHEN length(text) > 200 THEN text[:200] || '...' ELSE text END AS transcript_preview FROM checked WHERE reason IS NOT NULL"""
_REJECTED_SCHEMA = "doc_id bigint, char_count int, token_count int, reason string, transcript_preview string"


@query("write_rejected", _REJECTED_SQL)
def _(spark, d):
    path = scratch_path(spark, "rejected")
    W.write_rejected(P.rejected_rows(_checked(spark, d), "text", "doc_id"), path, "char_count", "doc_id")
    return spark.read.schema(_REJECTED_SCHEMA).json(path)


@query("rejected_by_size", _REJECTED_SQL + " ORDER BY char_count DESC, doc_id")
def _(spark, d):
    return P.rejected_rows(_checked(spark, d), "text", "doc_id").orderBy(F.desc("char_count"), "doc_id")


@query(
    "write_undetected",
    f"""SELECT 'clips/' || source || '/' || doc_id || '.wav' AS audio, md5(replace(text, 'language None{TEXT_TAG}', '')) AS text_md5
        FROM documents WHERE lang NOT IN ('en', 'ar', 'ml', 'zh-cn', 'zh-tw', 'hi')""",
)
def _(spark, d):
    from voxloom.constants import DETECTOR_CODES

    # with the five-language code map the other languages are undetected
    docs = map_language_code(table(spark, d, "documents"), "lang", codes=DETECTOR_CODES)
    rows = docs.select(
        F.concat(F.lit("clips/"), "source", F.lit("/"), "doc_id", F.lit(".wav")).alias("audio"),
        format_training_text(F.col("language"), F.col("text")).alias("text"),
    )
    path = scratch_path(spark, "undetected")
    W.write_undetected(rows, path)
    back = spark.read.schema("audio string, text string").json(path)
    return back.select("audio", F.md5("text").alias("text_md5"))


@query(
    "preview_rows",
    """SELECT doc_id, left('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","text":"' || replace(text, chr(10), '\\n') || '"}', 120) AS line
       FROM documents ORDER BY doc_id LIMIT 3""",
)
def _(spark, d):
    return W.preview_rows(table(spark, d, "documents"), "doc_id", 3, 120, ["doc_id", "lang", "source", "text"])


@query(
    "export_splits",
    f"WITH {_SPLIT_SQL} SELECT split, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, min(doc_id) AS low FROM split GROUP BY split",
)
def _(spark, d):
    path = scratch_path(spark, "export")
    docs = S.train_eval_split(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    W.export_splits(docs, path)
    back = R.scan_jsonl(spark, {s: f"{path}/split={s}" for s in ("train", "eval")}, "doc_id bigint, text string")
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("bigint")).alias("chars"), F.min("doc_id").alias("low")
    )


# --- listings -------------------------------------------------------------------------------------------------------


@query(
    "missing_audio",
    f"""WITH s AS (SELECT doc_id, {SHUFFLE_KEY_SQL} AS digest FROM documents ORDER BY digest, doc_id LIMIT 100),
    gone AS (SELECT * FROM s WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    SELECT (SELECT count(*) FROM s) AS sampled, (SELECT count(*) FROM gone) AS missing,
           (SELECT string_agg(doc_id::VARCHAR, ',' ORDER BY digest, doc_id) FROM (SELECT * FROM gone ORDER BY digest, doc_id LIMIT 5)) AS examples""",
)
def _(spark, d):
    sample = S.sample_fixed(table(spark, d, "documents").select("doc_id"), "doc_id", 100)
    return missing_in_sample(sample, table(spark, d, "labels"), "doc_id", "digest")


@query("missing_audio_all", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return missing_from_listing(docs, table(spark, d, "labels").select("doc_id"), "doc_id")
