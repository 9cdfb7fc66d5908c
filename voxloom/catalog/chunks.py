"""Queries over samples and chunks: joins, merges, ordered windows. A conversation stands for a recording, a turn for a
chunk of it; a user's events stand for the samples of a signal."""

from pyspark.sql import functions as F

from voxloom.catalog.registry import SAMPLES, documents, query, sql_trim
from voxloom.catalog.texts import WORDS_SQL
from voxloom.constants import ALIGNMENT_LANGUAGES
from voxloom.functions.align import pair_timestamps
from voxloom.functions.signal import max_chunk_seconds, ms_from_token
from voxloom.functions.text import tokenize_space_lang
from voxloom.operators import aggregates as A
from voxloom.operators import joins as J
from voxloom.operators import ordered as O
from voxloom.operators import windows as W
from voxloom.operators.batches import pad_and_mask
from voxloom.operators.hooks import model_languages
from voxloom.sources.readers import table

# turns are numbered, so a block of turns has no more rows than numbers
TURN_BLOCK = 4096


def _turns(spark, d):
    return table(spark, d, "conversations")


# the language of a turn, blank for some: derived from the role and the length of the text
_TURN_LANGUAGE_SQL = "CASE WHEN length(text) % 5 = 0 THEN ' ' WHEN role = 'user' AND length(text) % 2 = 0 THEN 'English' WHEN role = 'user' THEN ' French' WHEN role = 'system' THEN NULL ELSE 'English' END"


def _turn_language():
    size = F.length("text")
    return (
        F.when(size % 5 == 0, " ")
        .when((F.col("role") == "user") & (size % 2 == 0), "English")
        .when(F.col("role") == "user", " French")
        .when(F.col("role") != "system", "English")
    )


# --- joins ----------------------------------------------------------------------------------------------------------


@query("map_language_code", f"WITH {SAMPLES} SELECT doc_id, language FROM samples")
def _(spark, d):
    return J.map_language_code(table(spark, d, "documents").select("doc_id", "lang"), "lang").select("doc_id", "language")


_ALIGNABLE_SQL = ", ".join(f"'{n}'" for n in ("English", "German", "Spanish"))


@query(
    "unsupported_languages",
    f"WITH {SAMPLES} SELECT language, count(*) AS n FROM samples WHERE language NOT IN ({_ALIGNABLE_SQL}) GROUP BY language",
)
def _(spark, d):
    # a list without French
    docs = J.map_language_code(table(spark, d, "documents").select("doc_id", "lang"), "lang")
    supported = tuple(n for n in ALIGNMENT_LANGUAGES if n != "French")
    return J.unsupported_languages(docs, "language", supported).groupBy("language").agg(F.count(F.lit(1)).alias("n"))


_CONTEXT_SQL = "contexts AS (SELECT conv_id, coalesce(max(text) FILTER (role = 'system'), '') AS context FROM conversations GROUP BY conv_id)"


def _contexts(spark, d):
    turns = _turns(spark, d)
    system = F.max(F.when(F.col("role") == "system", F.col("text")))
    return turns.groupBy("conv_id").agg(F.coalesce(system, F.lit("")).alias("context"))


@query(
    "scatter_gather_chunks",
    f"""WITH {_CONTEXT_SQL} SELECT c.conv_id, c.turn, md5(context) AS context_md5,
        CASE WHEN length(text) % 4 <> 0 THEN length(text) + length(context) END AS result
        FROM conversations c JOIN contexts USING (conv_id)""",
)
def _(spark, d):
    chunks = _turns(spark, d).select("conv_id", "turn", "text")
    scattered = J.scatter_to_chunks(chunks, _contexts(spark, d), "conv_id")
    # the stand-in model skips texts whose length is a multiple of four
    run = scattered.where(F.length("text") % 4 != 0).select(
        "conv_id", "turn", (F.length("text") + F.length("context")).cast("bigint").alias("result")
    )
    gathered = J.gather_results(scattered, run, "conv_id", "turn")
    return gathered.select("conv_id", "turn", F.md5("context").alias("context_md5"), "result")


@query(
    "broadcast_batch_args",
    f"""WITH {_CONTEXT_SQL} SELECT conv_id, md5(context) AS own_md5, (SELECT md5(min(text)) FROM conversations WHERE role = 'system') AS shared_md5 FROM contexts""",
)
def _(spark, d):
    samples = _turns(spark, d).select("conv_id").distinct()
    shared = _turns(spark, d).where("role = 'system'").agg(F.min("text").alias("shared"))
    own = _contexts(spark, d)
    both = J.broadcast_argument(J.broadcast_argument(samples, own, "context", "conv_id"), shared, "shared", "conv_id")
    return both.select("conv_id", F.md5("context").alias("own_md5"), F.md5("shared").alias("shared_md5"))


@query(
    "dictionary_left_split",
    """WITH words AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda w: w <> '')) AS w FROM documents),
    counts AS (SELECT w, count(*) AS n FROM words GROUP BY w),
    dict AS (SELECT w AS entry FROM counts WHERE n >= 100),
    best AS (SELECT c.w, max(length(e.entry)) AS k FROM counts c JOIN dict e ON e.entry = ANY (list_transform(range(1, length(c.w) + 1), lambda i: c.w[:i])) GROUP BY c.w),
    parts AS (SELECT doc_id, regexp_replace(CASE WHEN k IS NULL THEN words.w ELSE words.w[:k] END, '[^''\\p{L}\\p{N}]', '', 'g') AS l,
              regexp_replace(CASE WHEN k IS NULL THEN '' ELSE words.w[k + 1:] END, '[^''\\p{L}\\p{N}]', '', 'g') AS r
              FROM words LEFT JOIN best USING (w))
    SELECT doc_id, count(*) AS words, count(*) FILTER (l <> '') + count(*) FILTER (r <> '') AS pieces,
           CAST(sum(length(l)) AS BIGINT) AS left_chars, CAST(sum(length(r)) AS BIGINT) AS right_chars
    FROM parts GROUP BY doc_id""",
)
def _(spark, d):
    docs = documents(spark, d)
    words = docs.select(F.explode(F.split("text", r"[ \t\n\r]+")).alias("word")).where("word <> ''")
    # words seen a hundred times or more make the dictionary
    dictionary = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 100")
    parts = J.dictionary_left_split(docs, "doc_id", "text", dictionary)
    return parts.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"),
        (F.count_if(F.col("left") != "") + F.count_if(F.col("right") != "")).alias("pieces"),
        F.sum(F.length("left").cast("bigint")).alias("left_chars"),
        F.sum(F.length("right").cast("bigint")).alias("right_chars"),
    )


@query(
    "model_languages",
    f"WITH {SAMPLES} SELECT DISTINCT lower(language) AS language FROM samples WHERE language IN ({', '.join(repr(n) for n in ALIGNMENT_LANGUAGES)})",
)
def _(spark, d):
    docs = J.map_language_code(table(spark, d, "documents").select("lang"), "lang")
    return model_languages(docs, "language", ALIGNMENT_LANGUAGES)


# --- merges ---------------------------------------------------------------------------------------------------------


@query(
    "merge_chunk_text",
    """SELECT conv_id, length(t) AS n, md5(t) AS text_md5
       FROM (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS t FROM conversations GROUP BY conv_id)""",
)
def _(spark, d):
    merged = A.merge_chunk_text(_turns(spark, d), "conv_id", "turn", "text")
    return merged.select("conv_id", F.length("merged_text").cast("bigint").alias("n"), F.md5("merged_text").alias("text_md5"))


@query(
    "merge_languages",
    f"""WITH t AS (SELECT conv_id, turn, {sql_trim("coalesce(" + _TURN_LANGUAGE_SQL + ", '')")} AS l FROM conversations),
    seen AS (SELECT *, lag(l) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM t WHERE l <> ''),
    kept AS (SELECT conv_id, string_agg(l, ',' ORDER BY turn) AS s FROM seen WHERE p IS NULL OR p <> l GROUP BY conv_id)
    SELECT conv_id, coalesce(s, '') AS languages FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN kept USING (conv_id)""",
)
def _(spark, d):
    turns = _turns(spark, d).withColumn("language", _turn_language())
    return A.merge_languages(turns, "conv_id", "turn", "language")


@query(
    "merge_alignments",
    """WITH spans AS (
      SELECT conv_id, turn, unnest(CASE WHEN role = 'system' THEN [] ELSE range(0, (length(text) % 4)::BIGINT) END) AS k FROM conversations),
    merged AS (SELECT conv_id, count(*) AS spans, string_agg(turn || ':' || k, ' ' ORDER BY turn, k) AS places,
               CAST(sum(turn * 2000 + k * 80) AS BIGINT) AS start_ms FROM spans GROUP BY conv_id)
    SELECT conv_id, coalesce(spans, 0) AS spans, places, start_ms
    FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN merged USING (conv_id)""",
)
def _(spark, d):
    # as many spans of 80 ms as the length of the text modulo four, on chunks of two seconds; none for system turns
    count = F.length("text") % 4
    slots = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    spans = F.transform(
        slots,
        lambda k: F.struct(
            F.concat("turn", F.lit(":"), k).alias("text"), (F.col("turn") * 2.0 + k * 0.08).alias("start_time"),
            (F.col("turn") * 2.0 + (k + 1) * 0.08).alias("end_time"),
        ),
    )
    turns = _turns(spark, d).withColumn("spans", F.when(F.col("role") != "system", spans))
    merged = A.merge_alignments(turns, "conv_id", "turn", "spans")
    stamps = F.col("time_stamps")
    start_ms = F.aggregate(stamps, F.lit(0).cast("bigint"), lambda a, s: a + F.round(s["start_time"] * 1000).cast("bigint"))
    return merged.select(
        "conv_id",
        F.coalesce(F.size(stamps), F.lit(0)).cast("bigint").alias("spans"),
        F.array_join(F.transform(stamps, lambda s: s["text"]), " ").alias("places"),
        start_ms.alias("start_ms"),
    )


# --- ordered windows ------------------------------------------------------------------------------------------------


def _events(spark, d):
    return table(spark, d, "events")


def _day_or_less(df):
    """Blocks of a day, or shorter ones where a user has too many events in a day for one task."""
    return O.time_block(F.col("ts"), O.fitting_seconds(df, ["user_id"], "ts"))


def _by_user(df, name="pos"):
    return O.with_position(df, ["user_id"], ["ts", "event_id"], _day_or_less(df), name)


@query(
    "collapse_consecutive",
    """SELECT user_id, event_id, event_type FROM (
         SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       WHERE k = 1 OR p IS DISTINCT FROM event_type""",
)
def _(spark, d):
    events = _events(spark, d).select("user_id", "ts", "event_id", "event_type")
    kept = W.collapse_consecutive(events, ["user_id"], ["ts", "event_id"], _day_or_less(events), "event_type")
    return kept.select("user_id", "event_id", "event_type")


@query(
    "chunk_offsets",
    """SELECT conv_id, turn, CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / 16000::DOUBLE AS offset_sec
       FROM conversations""",
)
def _(spark, d):
    turns = _turns(spark, d).select("conv_id", "turn", F.length("text").alias("size"))
    offsets = W.chunk_offsets(turns, "conv_id", "turn", O.value_block(F.col("turn"), TURN_BLOCK), F.col("size"), 16000)
    return offsets.select("conv_id", "turn", "offset_sec")


@query(
    "window_energy",
    """SELECT user_id, pos, round(energy, 6) AS energy FROM (
         SELECT user_id, row_number() OVER w - 1 AS pos, sum(abs(value)) OVER f AS energy, count(*) OVER f AS n FROM events
         WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING))
       WHERE n = 8""",
)
def _(spark, d):
    placed = _by_user(_events(spark, d).select("user_id", "ts", "event_id", "value"))
    energy = W.window_energy(placed.select("user_id", "pos", "value"), "user_id", "pos", "value", 8, block=1024)
    return energy.select("user_id", "pos", F.round("energy", 6).alias("energy"))


@query(
    "value_range_chunks",
    """WITH RECURSIVE o AS (SELECT o_custkey AS k, o_orderkey AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders),
    walk AS (
      SELECT k, pos, CASE WHEN v >= 1000 THEN 1 ELSE 0 END AS c FROM o WHERE pos = 0
      UNION ALL
      SELECT o.k, o.pos, CASE WHEN o.v >= (walk.c + 1) * 1000 THEN walk.c + 1 ELSE walk.c END FROM walk JOIN o ON o.k = walk.k AND o.pos = walk.pos + 1)
    SELECT k AS o_custkey, CAST(c AS BIGINT) AS range_chunk, min(pos) AS start, max(pos) + 1 AS "end" FROM walk GROUP BY ALL""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    block = O.value_block(F.col("o_orderkey"), 1_000_000)
    placed = O.with_position(orders, ["o_custkey"], ["o_orderkey"], block)
    chunks = W.value_range_chunks(placed, "o_custkey", "pos", "o_orderkey", 1000, block)
    return W.range_bounds(chunks, "o_custkey", "pos")


# --- times ----------------------------------------------------------------------------------------------------------


@query("ms_from_token", "SELECT event_id, floor(value) * 80.0 AS ms FROM events")
def _(spark, d):
    return _events(spark, d).select("event_id", ms_from_token(F.floor("value"), 80.0).alias("ms"))


@query(
    "pair_timestamps",
    f"""WITH {WORDS_SQL}, w AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS i FROM words)
    SELECT doc_id, i, word, round(round((i * 137 + 11) / 1000.0, 3) + 180.25, 3) AS start_time,
           round(round((i * 137 + 90) / 1000.0, 3) + 180.25, 3) AS end_time FROM documents LEFT JOIN w USING (doc_id)""",
)
def _(spark, d):
    docs = documents(spark, d).select("doc_id", tokenize_space_lang(F.col("text")).alias("words"))
    # word i lasts from 137 i + 11 to 137 i + 90 milliseconds
    times = F.flatten(F.transform("words", lambda w, i: F.array(i * 137 + 11, i * 137 + 90)))
    spans = docs.select("doc_id", "words", times.alias("ms")).select(
        "doc_id", F.posexplode_outer(pair_timestamps(F.col("words"), F.col("ms"), F.lit(180.25))).alias("i", "s")
    )
    return spans.select("doc_id", F.col("i").cast("bigint").alias("i"), F.col("s.text").alias("word"), "s.start_time", "s.end_time")


@query(
    "alignment_eligible",
    """SELECT aligned, count(*) AS n, count(*) FILTER (secs > longest) AS too_long, max(longest) AS max_chunk_sec
       FROM (SELECT n_chars % 2 = 0 AS aligned, n_chars / 10.0 AS secs, CASE WHEN n_chars % 2 = 0 THEN 180 ELSE 1200 END AS longest FROM documents) GROUP BY aligned""",
)
def _(spark, d):
    docs = table(spark, d, "documents").select((F.col("n_chars") % 2 == 0).alias("aligned"), (F.col("n_chars") / 10.0).alias("secs"))
    docs = docs.withColumn("longest", max_chunk_seconds(F.col("aligned")))
    return docs.groupBy("aligned").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("secs") > F.col("longest")).alias("too_long"), F.max("longest").alias("max_chunk_sec")
    )


@query(
    "batch_pad_and_mask",
    f"""WITH {WORDS_SQL}, ids AS (SELECT doc_id, list_transform(words, lambda w: length(w)) AS ids, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM words),
    sized AS (SELECT doc_id, ids, pos // 8 AS batch, max(len(ids)) OVER (PARTITION BY pos // 8) AS width FROM ids)
    SELECT doc_id, batch, width, width - len(ids) AS pads, CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS id_sum,
           -100 * (width - len(ids) + least(3, len(ids))) + CAST(coalesce(list_sum(ids[4:]), 0) AS BIGINT) AS label_sum
    FROM sized""",
)
def _(spark, d):
    docs = documents(spark, d).select(
        "doc_id", F.transform(tokenize_space_lang(F.col("text")), F.length).alias("ids")
    )
    placed = O.with_position(docs.select("doc_id"), [], ["doc_id"], O.range_block(docs, "doc_id"))
    batches = docs.join(placed, "doc_id").withColumn("batch", O.batch_number(F.col("pos"), 8))
    padded = pad_and_mask(batches.withColumn("prefix_size", F.lit(3)), "batch", "ids", "prefix_size", pad_id=0)

    def total(column):
        return F.aggregate(column, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return padded.select(
        "doc_id", "batch", F.col("width").cast("bigint").alias("width"),
        F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, m: a + (1 - m)).alias("pads"),
        total("input_ids").alias("id_sum"), total("labels").alias("label_sum"),
    )
