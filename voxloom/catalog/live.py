"""Queries over live sessions: each stream operator, run over the stored events, and its batch counterpart in SQL."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.catalog.registry import query
from voxloom.operators.ordered import micros
from voxloom.sources.readers import table
from voxloom.session import materialize, scratch_path
from voxloom.sources.pieces import read_pieces, write_pieces
from voxloom.streaming import sessions as S
from voxloom.streaming import twins as T
from voxloom.streaming.idle import closed_sessions
from voxloom.streaming.replay import numbered_samples, read_table_stream, replay
from voxloom.streaming.upserts import run_upserts

ORDER = ["ts", "event_id"]
CHUNK = 4
SETTINGS = S.StreamSettings(chunk_seconds=CHUNK, sr=1, unfixed_chunks=10**9, ttl_seconds=None)
_STEPS_SQL = f"""placed AS (SELECT user_id, value::FLOAT::DOUBLE AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
steps AS (SELECT user_id, pos // {CHUNK} AS chunk_id, count(*) AS n_new, sum(x) AS sum_new FROM placed GROUP BY ALL)"""


def count_model():
    """Stand-in recogniser: says how many samples it was given, in words that a rollback can cut."""
    return lambda context, prefix, audio: ("" if prefix else "language English<asr_text>") + f"heard {len(audio)} so far "


def _samples(spark, d, end=False):
    return numbered_samples(table(spark, d, "events"), "user_id", "ts", ORDER, "value", end)


def _sample_stream(spark, d, end=False):
    """The samples in files of no order; a small limit of bytes makes a batch of each file or two."""
    path = scratch_path(spark, "samples")
    samples = _samples(spark, d, end)
    samples.repartition(4, F.xxhash64("user_id", "number")).write.parquet(path)
    return read_table_stream(samples, path, batch_bytes=1 << 16)


def _steps(spark, d, settings=SETTINGS, end=False):
    steps = S.stream_steps(_sample_stream(spark, d, end), "user_id", "number", settings, count_model)
    return S.run_available(steps, "steps")


@query(
    "stream_init",
    """SELECT DISTINCT user_id, CAST(greatest(1, round_even((user_id % 4 + 1) * 0.5::DOUBLE * 16000, 0)) AS BIGINT) AS chunk_samples,
       CASE user_id % 3 WHEN 0 THEN 'Chinese' WHEN 1 THEN 'English' END AS force_language FROM events""",
)
def _(spark, d):
    users = table(spark, d, "events").select("user_id").distinct()
    spoken = F.when(F.col("user_id") % 3 == 0, " cHINese").when(F.col("user_id") % 3 == 1, "english").otherwise(" ")
    states = T.initial_states(users, "user_id", (F.col("user_id") % 4 + 1) * 0.5, spoken, F.lit(None).cast("string"))
    return states.select("user_id", F.col("chunk_samples").cast("bigint").alias("chunk_samples"), "force_language")


_BUFFER_SQL = f"WITH {_STEPS_SQL} SELECT user_id, chunk_id, n_new, round(sum_new, 3) AS sum_new FROM steps WHERE n_new = {CHUNK}"


def _buffered(df):
    return df.select(
        "user_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), F.col("n_new").cast("bigint").alias("n_new"),
        F.round("sum_new", 3).alias("sum_new"),
    )


@query("stream_chunk_buffer", _BUFFER_SQL)
def _(spark, d):
    return _buffered(_steps(spark, d))


@query("stream_chunk_buffer_batch", _BUFFER_SQL)
def _(spark, d):
    return _buffered(T.chunk_buffer(table(spark, d, "events"), "user_id", "ts", ORDER, "value", CHUNK))


_CUMULATIVE_SQL = f"""WITH {_STEPS_SQL} SELECT user_id, chunk_id, CAST(sum(n_new) OVER w AS BIGINT) AS n_seen, round(sum(sum_new) OVER w, 3) AS sum_seen
  FROM steps WHERE n_new = {CHUNK} WINDOW w AS (PARTITION BY user_id ORDER BY chunk_id)"""


def _seen(df):
    return df.select("user_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "n_seen", F.round("sum_seen", 3).alias("sum_seen"))


@query("stream_cumulative", _CUMULATIVE_SQL)
def _(spark, d):
    return _seen(_steps(spark, d))


@query("stream_cumulative_batch", _CUMULATIVE_SQL)
def _(spark, d):
    return _seen(T.cumulative(T.chunk_buffer(table(spark, d, "events"), "user_id", "ts", ORDER, "value", CHUNK), "user_id"))


# the stand-in says four words a step and two are rolled back, so "heard n" stays from every step but the latest
@query(
    "stream_prefix_rollback",
    f"""WITH {_STEPS_SQL}, s AS (SELECT user_id, chunk_id, {CHUNK} * (chunk_id + 1) AS n FROM steps WHERE n_new = {CHUNK}),
    kept AS (SELECT a.user_id, a.chunk_id, a.n, string_agg('heard ' || b.n || ' ', '' ORDER BY b.chunk_id) AS before
             FROM s a LEFT JOIN s b ON b.user_id = a.user_id AND a.chunk_id >= 2 AND b.chunk_id BETWEEN 1 AND a.chunk_id - 1 GROUP BY ALL)
    SELECT user_id, chunk_id, coalesce('language English<asr_text>' || before, '') AS prefix, 'English' AS language,
           coalesce(before, '') || 'heard ' || n || ' so far' AS text FROM kept""",
)
def _(spark, d):
    settings = S.StreamSettings(chunk_seconds=CHUNK, sr=1, unfixed_chunks=2, unfixed_tokens=2, ttl_seconds=None, keep_audio=True)
    steps = _steps(spark, d, settings)
    return steps.select("user_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "prefix", "language", "text")


@query(
    "stream_emit_latest",
    f"""WITH {_STEPS_SQL} SELECT user_id, max(chunk_id) AS chunk_id, 'English' AS language, 'heard ' || CAST(sum(n_new) AS BIGINT) || ' so far' AS text
        FROM steps GROUP BY user_id""",
)
def _(spark, d):
    # every batch of the stream, in Update mode, goes into a table of latest rows
    settings = S.StreamSettings(chunk_seconds=CHUNK, sr=1, unfixed_chunks=10**9, ttl_seconds=None, keep_audio=True)
    steps = S.stream_steps(_sample_stream(spark, d, end=True), "user_id", "number", settings, count_model, "Update")
    latest = run_upserts(
        steps.select("user_id", "chunk_id", "language", "text"), scratch_path(spark, "latest"), ["user_id"], ["chunk_id"],
        scratch_path(spark, "latest-checkpoint"), compact_every=3,
    )
    return latest.select("user_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "language", "text")


@query(
    "stream_finish",
    f"""WITH {_STEPS_SQL} SELECT user_id, chunk_id, n_new, CAST(sum(n_new) OVER w AS BIGINT) AS n_seen, n_new < {CHUNK} AS final
        FROM steps WINDOW w AS (PARTITION BY user_id ORDER BY chunk_id)""",
)
def _(spark, d):
    return _steps(spark, d, end=True).select(
        "user_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), F.col("n_new").cast("bigint").alias("n_new"), "n_seen", "final"
    )


@query(
    "stream_session_ttl_batch",
    """WITH g AS (SELECT user_id, ts, event_id, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000, false) AS opens FROM events
                  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT user_id, ts, sum(opens::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
    SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, epoch_us(max(ts)) - epoch_us(min(ts)) AS lasted FROM s GROUP BY user_id, session""",
)
def _(spark, d):
    # events of a user are hours apart, so the limit is six hours here
    sessions = T.idle_sessions(table(spark, d, "events"), "user_id", "ts", ORDER, ttl_seconds=6 * 3600)
    return sessions.select("user_id", "session", "n", (micros(F.col("ended")) - micros(F.col("started"))).alias("lasted"))


# one event in fifty is sent after all others; the stream has dropped those that the watermark had passed by then
_TTL_US, _DELAY_MS = 6 * 3600 * 1_000_000, 2 * 3600 * 1000


@query(
    "stream_session_ttl",
    f"""WITH newest AS (SELECT epoch_ms(max(ts)) - {_DELAY_MS} AS mark FROM events WHERE event_id % 50 <> 0),
    seen AS (SELECT user_id, epoch_us(ts) AS us, event_id FROM events, newest WHERE event_id % 50 <> 0 OR epoch_us(ts) > mark * 1000),
    g AS (SELECT *, coalesce(us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > {_TTL_US}, false) AS opens FROM seen),
    s AS (SELECT *, sum(opens::INT) OVER (PARTITION BY user_id ORDER BY us, event_id) AS session FROM g)
    SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, max(us) - min(us) AS lasted FROM s GROUP BY user_id, session""",
)
def _(spark, d):
    events = table(spark, d, "events").select("user_id", "ts", "event_id")
    at = micros(F.col("ts"))
    late = F.col("event_id") % 50 == 0
    newest = events.agg(F.max(F.when(~late, at)).alias("us"))
    low, high = events.agg(F.min(at)).scalar(), events.agg(F.max(at)).scalar()
    # six slices of time, an event up to an hour behind its slice; a row of no user, after which the watermark of the slices
    # holds for what comes; the late ones; and a row that moves the watermark past all sessions
    jitter = F.col("event_id") % 7 * 600_000_000
    slices = F.floor((at + jitter - low) * 6 / (high + 3_600_000_001 - low))
    dealt = events.select("user_id", "ts", F.when(late, 7).otherwise(slices).cast("bigint").alias("p"))
    past = events.agg((F.max(at) + _TTL_US + _DELAY_MS * 1000 + 1_000_000).alias("us"))
    marks = [
        one.select(
            F.lit(-1).cast("bigint").alias("user_id"), F.timestamp_micros("us").cast(events.schema["ts"].dataType).alias("ts"),
            F.lit(p).cast("bigint").alias("p"),
        )
        for one, p in ((newest, 6), (past, 8))
    ]
    rows = dealt.unionByName(marks[0]).unionByName(marks[1])
    folder = scratch_path(spark, "event-pieces")
    write_pieces(rows, folder, F.col("p"))
    stream = read_pieces(spark, rows.select("user_id", "ts").schema, folder)
    sessions = S.run_available(closed_sessions(stream, "user_id", "ts", "2 hours", _TTL_US / 1e6), "idle", paced=True)
    return sessions.where("user_id >= 0").select("user_id", "session", "n", (F.col("ended_us") - F.col("started_us")).alias("lasted"))


REPLAY_CHUNK = 16


@query(
    "stream_replay_steps",
    f"""WITH placed AS (SELECT user_id, value::FLOAT::DOUBLE AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
    steps AS (SELECT user_id, pos // {REPLAY_CHUNK} AS chunk_id, count(*) AS n_new, sum(x) AS sum_new FROM placed GROUP BY ALL)
    SELECT pieces, user_id, chunk_id, n_new, CAST(sum(n_new) OVER w AS BIGINT) AS n_seen, round(sum(sum_new) OVER w, 3) AS sum_seen,
           n_new < {REPLAY_CHUNK} AS final
    FROM steps, unnest([8, 16, 32, 64]) AS t(pieces) WINDOW w AS (PARTITION BY pieces, user_id ORDER BY chunk_id)""",
)
def _(spark, d):
    # whole sessions with their closing rows, fed by half a chunk, one, two and four chunks a trigger
    settings = S.StreamSettings(chunk_seconds=REPLAY_CHUNK, sr=1, unfixed_chunks=10**9, ttl_seconds=None)
    samples = materialize(_samples(spark, d, end=True), "samples")
    runs = [replay(samples, size, "user_id", settings, count_model).withColumn("pieces", F.lit(size)) for size in (8, 16, 32, 64)]
    return reduce(DataFrame.unionByName, runs).select(
        "pieces", "user_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), F.col("n_new").cast("bigint").alias("n_new"), "n_seen",
        F.round("sum_seen", 3).alias("sum_seen"), "final",
    )
