"""Queries over text functions: tags, repetition, parsing, tokens."""

from pyspark.sql import functions as F

from voxloom.catalog.registry import LANGUAGE_CASE, RUNS, SAMPLES, documents, query, repaired_sql, sql_trim, training_samples
from voxloom.constants import AUDIO_MARKS, CJK_CLASS, TEXT_TAG, WHITESPACE, WHITESPACE_CLASS
from voxloom.functions import text as X
from voxloom.functions.language import language_display, normalize_language_name, parse_model_output

WS = f"[{WHITESPACE_CLASS}]"


@query(
    "format_training_text",
    f"WITH {SAMPLES} SELECT doc_id, md5(tagged) AS text_md5, length(tagged) AS n FROM samples",
)
def _(spark, d):
    docs = training_samples(spark, d)
    return docs.select("doc_id", F.md5("tagged").alias("text_md5"), F.length("tagged").cast("bigint").alias("n"))


@query(
    "normalize_language_name",
    f"""WITH names AS (SELECT ' ' || lower({LANGUAGE_CASE}) || chr(9) AS a, chr(160) || upper({LANGUAGE_CASE}) AS b, source
                      FROM documents),
    shaped AS (SELECT source, {sql_trim('a')} AS a, {sql_trim('b')} AS b, {sql_trim("source || ' eXtra Words '")} AS c FROM names)
    SELECT upper(a[1]) || lower(a[2:]) AS from_lower, upper(b[1]) || lower(b[2:]) AS from_upper,
           upper(c[1]) || lower(c[2:]) AS from_mixed, count(*) AS n
    FROM shaped GROUP BY ALL""",
)
def _(spark, d):
    docs = training_samples(spark, d)
    return docs.groupBy(
        normalize_language_name(F.concat(F.lit(" "), F.lower("language"), F.lit("\t"))).alias("from_lower"),
        normalize_language_name(F.concat(F.lit("\xa0"), F.upper("language"))).alias("from_upper"),
        normalize_language_name(F.concat("source", F.lit(" eXtra Words "))).alias("from_mixed"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "extract_transcript",
    f"""WITH {SAMPLES}, t AS (
      SELECT doc_id, CASE WHEN regexp_matches(tagged, '{TEXT_TAG}([^\\n]*)\\n?\\z')
                          THEN regexp_extract(tagged, '{TEXT_TAG}([^\\n]*)\\n?\\z', 1) ELSE tagged END AS transcript
      FROM samples)
    SELECT doc_id, length(transcript) AS n, md5(transcript) AS transcript_md5 FROM t""",
)
def _(spark, d):
    transcript = X.extract_transcript(F.col("tagged"))
    return training_samples(spark, d).select(
        "doc_id", F.length(transcript).cast("bigint").alias("n"), F.md5(transcript).alias("transcript_md5")
    )


@query(
    "extract_language_tag",
    f"""WITH {SAMPLES} SELECT doc_id, CASE WHEN starts_with(v, 'language ')
          THEN {sql_trim("replace(split_part(v, '" + TEXT_TAG + "', 1), 'language ', '')")} ELSE 'Unknown' END AS tag
        FROM (SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN text WHEN n_chars % 3 = 1 THEN tagged
                             ELSE 'language ' || tagged END AS v FROM samples)""",
)
def _(spark, d):
    # one third of the texts come without a tag and one third with a doubled prefix
    form = F.col("n_chars") % 3
    value = F.when(form == 0, F.col("text")).when(form == 1, F.col("tagged")).otherwise(
        F.concat(F.lit("language "), "tagged")
    )
    return training_samples(spark, d).select("doc_id", X.extract_language_tag(value).alias("tag"))


@query(
    "flag_repetition",
    f"""WITH {RUNS} SELECT d.doc_id, coalesce(max(r.n) FILTER (r.c <> chr(10)), 0) > 10 AS repeated
        FROM documents d LEFT JOIN runs r USING (doc_id) GROUP BY d.doc_id""",
)
def _(spark, d):
    return documents(spark, d).select("doc_id", X.has_long_run(F.col("text")).alias("repeated"))


@query(
    "collapse_char_runs",
    f"""WITH {RUNS}, t AS (
      SELECT doc_id, string_agg(CASE WHEN n > 20 THEN c ELSE repeat(c, n) END, '' ORDER BY first_i) AS fixed FROM runs GROUP BY doc_id)
    SELECT d.doc_id, length(coalesce(fixed, d.text)) AS n, md5(coalesce(fixed, d.text)) AS fixed_md5 FROM documents d LEFT JOIN t USING (doc_id)""",
)
def _(spark, d):
    fixed = X.collapse_char_runs(F.col("text"))
    docs = documents(spark, d)
    return docs.select("doc_id", F.length(fixed).cast("bigint").alias("n"), F.md5(fixed).alias("fixed_md5"))


@query(
    "collapse_pattern_repeats",
    f"""WITH RECURSIVE {repaired_sql('documents', 'text')}
    SELECT d.doc_id, coalesce(length(f), 0) AS n, md5(coalesce(f, '')) AS fixed_md5 FROM documents d LEFT JOIN fixed USING (doc_id)""",
)
def _(spark, d):
    fixed = X.repair_repetitions(F.col("text"))
    return documents(spark, d).select(
        "doc_id", F.length(fixed).cast("bigint").alias("n"), F.md5(fixed).alias("fixed_md5")
    )


# raw outputs of every shape: plain, tagged, tag behind a broken head, unknown language, only blanks

def _raw_outputs(spark, d):
    docs = training_samples(spark, d, shared=True)
    kind = F.col("n_chars") % 6
    raw = (
        F.when(kind == 0, F.col("text"))
        .when(kind == 1, F.concat(F.lit("junk\r\n LANGUAGE "), F.upper("language"), F.lit(f"  \n\n{TEXT_TAG}"), "text"))
        .when(kind == 2, F.concat(F.lit(f"language None{TEXT_TAG} "), "text"))
        .when(kind == 3, F.concat(F.lit(f"no name here{TEXT_TAG}"), "text"))
        .when(kind == 4, F.lit(" \n\t"))
        .otherwise(F.col("tagged"))
    )
    forced = F.when(F.col("source") == "src3", F.lit("English"))
    return docs.select("doc_id", raw.alias("raw"), forced.alias("forced"))


_RAW_SQL = f"""{SAMPLES}, raws AS (
  SELECT doc_id, CASE WHEN source = 'src3' THEN 'English' END AS forced, {sql_trim(f'''CASE n_chars % 6 WHEN 0 THEN text
    WHEN 1 THEN 'junk' || chr(13) || chr(10) || ' LANGUAGE ' || upper(language) || '  ' || chr(10) || chr(10) || '{TEXT_TAG}' || text
    WHEN 2 THEN 'language None{TEXT_TAG} ' || text WHEN 3 THEN 'no name here{TEXT_TAG}' || text
    WHEN 4 THEN ' ' || chr(10) || chr(9) ELSE tagged END''')} AS s FROM samples)"""
_PARSE_SQL = f"""parts AS (
  SELECT *, contains(s, '{TEXT_TAG}') AS tagged, split_part(s, '{TEXT_TAG}', 1) AS head,
         {sql_trim(f"s[instr(s, '{TEXT_TAG}') + {len(TEXT_TAG)}:]")} AS body FROM outputs),
named AS (
  SELECT *, {sql_trim(f"coalesce(list_filter(list_transform(regexp_split_to_array(head, '[{chr(92)}r{chr(92)}n]+'), lambda l: trim(l, '{WHITESPACE}')), lambda l: starts_with(lower(l), 'language '))[1][10:], '')")} AS value
  FROM parts)
"""
_PARSED_SQL = """SELECT doc_id,
      CASE WHEN s = '' THEN '' WHEN forced IS NOT NULL THEN forced WHEN NOT tagged THEN ''
           WHEN contains(lower(head), 'language none') THEN '' ELSE upper(value[1]) || lower(value[2:]) END AS language,
      md5(CASE WHEN s = '' THEN '' WHEN forced IS NOT NULL OR NOT tagged THEN s ELSE body END) AS text_md5
    FROM named"""


@query("parse_model_output_tags", f"WITH {_RAW_SQL}, outputs AS (SELECT * FROM raws), {_PARSE_SQL} {_PARSED_SQL}")
def _(spark, d):
    parsed = parse_model_output(_raw_outputs(spark, d), "raw", "forced", repair=False)
    return parsed.select("doc_id", "language", F.md5("parsed").alias("text_md5"))


@query(
    "parse_model_output",
    f"""WITH RECURSIVE {_RAW_SQL}, {repaired_sql('raws', 's')},
    outputs AS (SELECT r.doc_id, r.forced, coalesce(f, '') AS s FROM raws r LEFT JOIN fixed USING (doc_id)), {_PARSE_SQL} {_PARSED_SQL}""",
)
def _(spark, d):
    parsed = parse_model_output(_raw_outputs(spark, d), "raw", "forced")
    return parsed.select("doc_id", "language", F.md5("parsed").alias("text_md5"))


@query(
    "clean_token",
    r"""SELECT doc_id, length(c) AS n, md5(c) AS cleaned_md5
        FROM (SELECT doc_id, regexp_replace(text, '[^''\p{L}\p{N}]', '', 'g') AS c FROM documents)""",
)
def _(spark, d):
    cleaned = X.clean_token(F.col("text"))
    return documents(spark, d).select(
        "doc_id", F.length(cleaned).cast("bigint").alias("n"), F.md5(cleaned).alias("cleaned_md5")
    )


# independent form: cut first, clean every word, then cut the ideographs out
WORDS_SQL = rf"""words AS (
  SELECT doc_id, lang, list_filter(flatten(list_transform(regexp_split_to_array(text, '{WS}+'),
      lambda w: regexp_extract_all(regexp_replace(w, '[^''\p{{L}}\p{{N}}]', '', 'g'), '[{CJK_CLASS}]|[^{CJK_CLASS}]+'))),
      lambda w: w <> '') AS words
  FROM documents)"""


@query(
    "tokenize_space_lang",
    f"WITH {WORDS_SQL} SELECT doc_id, len(words) AS n, md5(array_to_string(words, '|')) AS words_md5 FROM words",
)
def _(spark, d):
    docs = documents(spark, d).select("doc_id", X.tokenize_space_lang(F.col("text")).alias("words"))
    return docs.select(
        "doc_id", F.size("words").cast("bigint").alias("n"), F.md5(F.array_join("words", "|")).alias("words_md5")
    )


@query(
    "tokenize_chinese_mixed",
    rf"""WITH w AS (SELECT doc_id, regexp_extract_all(text, '[{CJK_CLASS}]|(?:[^\P{{L}}{CJK_CLASS}]|[''\p{{N}}])+') AS words FROM documents)
    SELECT doc_id, len(words) AS n, md5(array_to_string(words, '|')) AS words_md5 FROM w""",
)
def _(spark, d):
    docs = documents(spark, d).select("doc_id", X.tokenize_chinese_mixed(F.col("text")).alias("words"))
    return docs.select(
        "doc_id", F.size("words").cast("bigint").alias("n"), F.md5(F.array_join("words", "|")).alias("words_md5")
    )


@query(
    "token_counts",
    f"""WITH {WORDS_SQL} SELECT lang, count(*) AS docs, CAST(sum(len(words)) AS BIGINT) AS tokens, max(len(words)) AS longest
        FROM words GROUP BY lang""",
)
def _(spark, d):
    docs = training_samples(spark, d, shared=True)
    counted = docs.select("lang", F.size(X.words_by_language(F.col("text"), F.col("language"))).cast("bigint").alias("n"))
    return counted.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens"), F.max("n").alias("longest")
    )


@query(
    "encode_alignment_text",
    f"""WITH {WORDS_SQL}, e AS (SELECT doc_id, '{AUDIO_MARKS}' || array_to_string(words, '<timestamp><timestamp>')
           || '<timestamp><timestamp>' AS encoded FROM words)
    SELECT doc_id, length(encoded) AS n, md5(encoded) AS encoded_md5 FROM e""",
)
def _(spark, d):
    docs = documents(spark, d).select(
        "doc_id", X.encode_alignment_text(X.tokenize_space_lang(F.col("text"))).alias("encoded")
    )
    return docs.select("doc_id", F.length("encoded").cast("bigint").alias("n"), F.md5("encoded").alias("encoded_md5"))


@query(
    "language_display",
    f"""WITH n AS (SELECT '  ' || lower({LANGUAGE_CASE}) || '__' || source || 'ABC' || chr(9) || 'x_yZ ' AS name FROM documents)
    SELECT array_to_string(list_transform(list_filter(regexp_split_to_array(replace(name, '_', ' '), '{WS}+'), lambda w: w <> ''),
             lambda w: upper(w[1]) || w[2:]), ' ') AS shown, count(*) AS n FROM n GROUP BY 1""",
)
def _(spark, d):
    name = F.concat(F.lit("  "), F.lower("language"), F.lit("__"), "source", F.lit("ABC\tx_yZ "))
    return training_samples(spark, d).groupBy(language_display(name).alias("shown")).agg(F.count(F.lit(1)).alias("n"))
