"""Stream state: settings, rollback, end of a session, idle sessions."""

import time
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from voxloom.session import ROCKSDB, scratch_path
from voxloom.sources.pieces import read_pieces, write_pieces
from voxloom.streaming import idle
from voxloom.streaming import sessions as S
from voxloom.streaming import twins as T
from voxloom.streaming import upserts
from voxloom.streaming.replay import read_table_stream, replay

ORDER = ["ts", "event_id"]


def make_words():
    # made inside a function, so that it travels with the job and not by the name of this module
    def words():
        return lambda context, prefix, audio: f"{context}{len(audio)} two three "

    return words


words = make_words()


def test_settings_are_checked():
    assert S.StreamSettings().chunk_samples == 32000
    assert S.StreamSettings(chunk_seconds=1e-9).chunk_samples == 1
    assert S.StreamSettings(language=" cHINese ").forced_language == "Chinese"
    for bad in ({"chunk_seconds": 0}, {"chunk_seconds": None}, {"language": "klingon"}):
        with pytest.raises(ValueError):
            S.StreamSettings(**bad)


def test_rollback():
    tokens = ["a ", "b ", "� ", "c ", "d"]
    assert S.rollback(tokens, 1) == "a b "
    assert S.rollback(tokens, 9) == ""
    assert S.rollback(tokens, 9, finishing=True) == "a "
    assert S.rollback(tokens, 1, finishing=True) == "a b � c "
    assert S.rollback([], 2) == "" and S.rollback([], 2, finishing=True) == ""
    assert "".join(S.split_tokens("  a b\n c")) == "  a b\n c"


def session_rows(spark, sizes, end=True):
    rows = []
    for session, n in sizes.items():
        rows += [(session, i, float(i), False) for i in range(n)]
        if end:
            rows.append((session, n, None, True))
    return spark.createDataFrame(rows, "user_id bigint, number bigint, value double, end boolean")


def restated(n, size, settings, end):
    """The steps of one session: (samples seen, prefix, raw)."""
    out, raw, heard = [], "", 0
    pieces = [size] * (n // size) + ([n % size] if end and n % size else [])
    for step, piece in enumerate(pieces):
        heard += piece
        tokens = S.split_tokens(raw)
        last = piece < size
        keep = len(tokens) - settings.unfixed_tokens
        keep = max(keep, 1) if last else max(keep, 0)
        prefix = "" if step < settings.unfixed_chunks else "".join(tokens[:keep])
        raw = prefix + words()("", prefix, [0] * heard)
        out.append((heard, prefix, raw))
    return out


@pytest.mark.parametrize("way", ["one piece", "pieces", "files in reverse"])
def test_steps(spark, way):
    settings = S.StreamSettings(
        chunk_seconds=3, sr=1, unfixed_chunks=1, unfixed_tokens=2, ttl_seconds=None, keep_audio=True
    )
    sizes = {1: 10, 2: 3, 3: 2, 4: 0, 5: 12}
    rows = session_rows(spark, sizes)
    if way == "files in reverse":
        # the closing rows and the last samples come first, each file a batch of its own, one file twice
        path = scratch_path(spark, "reverse")
        for low in (8, 4, 0, 4):
            rows.where((F.col("number") >= low) & (F.col("number") < low + (5 if low == 8 else 4))).coalesce(1).write.mode(
                "append"
            ).parquet(path)
        stream = read_table_stream(rows, path, batch_bytes=1)
        steps = S.run_available(S.stream_steps(stream, "user_id", "number", settings, words), "reverse").collect()
        steps = [r for r in steps if r["n_seen"] > 0]
    else:
        steps = replay(rows, {"one piece": 100, "pieces": 5}[way], "user_id", settings, words).collect()
    for session, n in sizes.items():
        mine = sorted((r for r in steps if r["user_id"] == session), key=lambda r: r["chunk_id"])
        assert [(r["n_seen"], r["prefix"], r["raw"]) for r in mine] == restated(n, 3, settings, True)
        assert [r["final"] for r in mine] == [False] * (n // 3) + [True] * (n % 3 > 0)


def test_idle_session_is_finished(spark):
    path = scratch_path(spark, "idle")
    rows = session_rows(spark, {1: 5}, end=False)
    rows.write.parquet(path)
    settings = S.StreamSettings(chunk_seconds=3, sr=1, ttl_seconds=2, keep_audio=False)
    stream = S.stream_steps(spark.readStream.schema(rows.schema).parquet(path), "user_id", "number", settings, words)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    query = stream.writeStream.format("memory").queryName("idle_steps").outputMode("append").start()
    try:
        for _ in range(60):
            done = spark.table("idle_steps").where("final").collect()
            if done:
                break
            time.sleep(1)
    finally:
        query.stop()
    assert [(r["n_new"], r["n_seen"]) for r in done] == [(2, 5)]


def test_idle_gap_rule(spark):
    at = [0, 600, 1201, 1202]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(at)], "user_id int, event_id int, at bigint")
    df = df.withColumn("ts", F.timestamp_seconds("at"))
    got = T.idle_sessions(df, "user_id", "ts", ORDER).orderBy("session").collect()
    assert [(r["session"], r["n"]) for r in got] == [(0, 2), (1, 2)]


def test_stream_equals_batch(spark):
    rows = session_rows(spark, {1: 11, 2: 4}, end=False).withColumn("ts", F.timestamp_seconds("number"))
    settings = S.StreamSettings(chunk_seconds=4, sr=1, ttl_seconds=None)
    live = {(r["user_id"], r["chunk_id"]): (r["n_seen"], r["sum_seen"]) for r in replay(rows.drop("ts"), 3, "user_id", settings, words).collect()}
    stored = T.cumulative(T.chunk_buffer(rows, "user_id", "ts", ["ts", "number"], "value", 4), "user_id").collect()
    assert live == {(r["user_id"], r["chunk_id"]): (r["n_seen"], r["sum_seen"]) for r in stored}


class Store:
    """A state map in memory that counts what is read and written."""

    def __init__(self):
        self.held, self.moved = {}, 0

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        self.moved += len(self.held[key][0])
        return self.held[key]

    def updateValue(self, key, value):
        self.moved += len(value[0])
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]


@pytest.mark.parametrize("size", [10, 997, 4096])
def test_early_samples_cost_their_own_stretches(size):
    # the first sample of a session comes last, in frames of so many samples
    n = 200_000
    processor = S.SessionProcessor(S.StreamSettings(), words, "number", "k")
    processor.early = Store()
    state = {"n_seen": 0, "buffer": np.empty(0, np.float32), "waiting": 0}
    values = np.arange(n, dtype=np.float32)
    got = []
    for low in range(1, n if size > 10 else 3000, size):
        numbers = np.arange(low, min(low + size, n if size > 10 else 3000))
        got.append(processor._due(state, np.append(numbers, numbers[:3]), np.append(values[numbers], [-1, -1, -1])))
    top = n if size > 10 else 3000
    assert not any(len(g) for g in got) and state["waiting"] == top - 1
    first = processor._due(state, np.array([0]), values[:1])
    assert np.array_equal(first, values[:top]) and state["waiting"] == 0 and not processor.early.held
    # every sample is moved as often as its stretch is touched, and not once per frame of the session
    assert processor.early.moved <= 2 * (top + S.STRETCH) * (S.STRETCH // size + 3)


def test_samples_in_any_order():
    import random

    chance = random.Random(2)
    for _ in range(30):
        n = chance.randint(1, 40)
        processor = S.SessionProcessor(S.StreamSettings(), words, "number", "k")
        processor.early = Store()
        state = {"n_seen": 0, "buffer": np.empty(0, np.float32), "waiting": 0}
        rows = [k for k in range(n) for _ in range(chance.randint(1, 2))]
        chance.shuffle(rows)
        out = []
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(S, "STRETCH", chance.choice([1, 3, 8, 100]))
            while rows:
                frame, rows = rows[: 4], rows[4:]
                due = processor._due(state, np.array(frame), np.array(frame, dtype=np.float32))
                state["n_seen"] += len(due)
                out += due.tolist()
        assert out == [float(k) for k in range(n)] and state["waiting"] == 0 and not processor.early.held


def test_pieces_are_read_once_and_in_order(spark):
    rows = spark.range(40).withColumn("ts", F.timestamp_seconds("id"))
    folder, out, checkpoint = (scratch_path(spark, f"pieces-{n}") for n in ("in", "out", "checkpoint"))
    write_pieces(rows.where("id < 20"), folder, F.floor(F.col("id") / 10))
    batches = []

    def run():
        stream = read_pieces(spark, rows.schema, folder)
        keep = lambda df, n: (batches.append(sorted(r["id"] for r in df.select("id").collect())), df.write.mode("append").parquet(out))
        S.run_writer(stream, lambda w: w.foreachBatch(keep), checkpoint, paced=True)

    run()
    assert [b for b in batches if b] == [list(range(10)), list(range(10, 20))]
    # more pieces, and a run that goes on from the checkpoint
    write_pieces(rows.where("id >= 20"), folder + "-more", F.floor(F.col("id") / 10))
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for k in (2, 3):
        source, target = files.Path(f"{folder}-more/piece={k}"), files.Path(f"{folder}/piece={k}")
        files.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
    run()
    assert [b for b in batches if b][2:] == [list(range(20, 30)), list(range(30, 40))]
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(40))


def test_open_stretches_meet():
    of = lambda *points: [list(map(int, x)) for x in idle.merged(*(np.array(p) for p in zip(*points)), 10)]
    assert of((0, 0, 1), (10, 10, 1), (21, 21, 1)) == [[0, 21], [10, 21], [2, 1]]
    assert of((0, 30, 5), (5, 5, 1), (41, 50, 2), (40, 40, 1)) == [[0], [50], [9]]
    assert [len(x) for x in idle.merged(*[np.zeros(0, dtype=np.int64)] * 3, 10)] == [0, 0, 0]


def test_a_replayed_batch_changes_nothing(spark):
    table = upserts.LatestTable(
        spark, scratch_path(spark, "upserts"), spark.createDataFrame([], "k int, step int, v string").schema, ["k"], ["step"], compact_every=3
    )
    want = {}
    for number in range(8):
        rows = [(k, number * 10 + s, f"{k} {number} {s}") for k in range(number % 4, 6) for s in range(3)]
        want |= {k: (step, v) for k, step, v in rows}
        batch = spark.createDataFrame(rows, "k int, step int, v string")
        for _ in range(1 + number % 2):
            table.merge(batch, number)
        assert {r["k"]: (r["step"], r["v"]) for r in table.read().collect()} == want
    # a batch from before the last compaction, replayed once more
    table.merge(spark.createDataFrame([(0, 50, "0 5 0")], "k int, step int, v string"), 5)
    table.merge(batch, 7)
    assert {r["k"]: (r["step"], r["v"]) for r in table.read().collect()} == want
    assert table._folders("base") == [2, 5] and len(table._parts().inputFiles()) < 20


class Handle:
    """State of one group in memory; counts the writes."""

    def __init__(self):
        self.value, self.timers, self.writes = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return Store()

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    def clear(self):
        self.value = None

    def listTimers(self):
        return list(self.timers)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)


def test_sessions_of_a_group_share_calls_and_entries():
    settings = S.StreamSettings(chunk_seconds=3, sr=1, ttl_seconds=None)
    sizes = {k: k % 8 for k in range(500)} | {None: 4}
    rows = pd.DataFrame(
        [(k, i, float(i), False) for k, n in sizes.items() for i in range(n)] + [(k, n, None, True) for k, n in sizes.items()],
        columns=["k", "number", "value", "end"],
    )
    # a whole number comes with a mark instead of a null
    rows["known_key"] = rows["k"].notna()
    rows["k"] = rows["k"].fillna(0).astype("int64")
    handle, got = Handle(), {}
    for frames in ([rows[:900], rows[900:1700]], [rows[1700:]]):
        processor = S.GroupProcessor(settings, words, "number", StructField("k", LongType()))
        processor.init(handle)
        out = list(processor.handleInputRows((0,), iter(frames), None))
        assert len(out) <= len(frames)
        for row in pd.concat(out).itertuples():
            got.setdefault(None if pd.isna(row.k) else row.k, []).append((row.n_seen, row.final))
    want = {k: [(min(i + 3, n), n - i < 3) for i in range(0, n, 3)] for k, n in sizes.items() if n}
    assert got == want and handle.writes == 1 and handle.value is None


def test_null_is_a_session_of_its_own(spark):
    big = 2**60 + 1
    sizes = {big: 9, big + 1: 7, 0: 5, None: 8}
    rows = spark.createDataFrame(
        [(k, i, float(i), False) for k, n in sizes.items() for i in range(n)] + [(k, n, None, True) for k, n in sizes.items()],
        "user_id bigint, number bigint, value double, end boolean",
    )
    path = scratch_path(spark, "nulls")
    # later samples first, so that all sessions wait; all of them in one group
    for low in (6, 0):
        rows.where((F.col("number") >= low) & (F.col("number") < low + 6)).coalesce(1).write.mode("append").parquet(path)
    settings = S.StreamSettings(chunk_seconds=4, sr=1, ttl_seconds=None)
    stream = read_table_stream(rows, path, batch_bytes=1)
    steps = S.run_available(S.stream_steps(stream, "user_id", "number", settings, words, groups=1), "nulls").collect()
    want = {(k, min(i + 4, n), n - i < 4) for k, n in sizes.items() for i in range(0, n, 4)}
    assert sorted(((r["user_id"], r["n_seen"], r["final"]) for r in steps), key=str) == sorted(want, key=str)


def test_keys_of_a_group_share_a_timer():
    minute = 60_000_000
    handle = Handle()
    processor = idle.IdleProcessor(StructField("k", StringType()), 10 * minute)
    processor.init(handle)
    at = {"a": [0, 5, 16, 40], "b": [30], None: [3]}
    frame = pd.DataFrame([(k, t * minute) for k, ts in at.items() for t in ts], columns=["k", "at_us"])
    frame["known_key"] = frame["k"].notna()
    assert not list(processor.handleInputRows((0,), iter([frame[3:], frame[:3]]), None))
    assert handle.writes == 1 and handle.timers == {13 * 60_000 + 1}

    class Now:
        def __init__(self, minutes):
            self.getCurrentWatermarkInMs = lambda: minutes * 60_000

    def over(minutes):
        rows = [r for out in processor.handleExpiredTimer((0,), Now(minutes), None) for r in out.itertuples(index=False)]
        return [(None if pd.isna(r.k) else r.k, r.session, r.started_us // minute, r.ended_us // minute, r.n) for r in rows]

    assert sorted(over(27), key=str) == [("a", 0, 0, 5, 2), ("a", 1, 16, 16, 1), (None, 0, 3, 3, 1)]
    assert handle.timers == {40 * 60_000 + 1}
    assert sorted(over(51)) == [("a", 2, 40, 40, 1), ("b", 0, 30, 30, 1)] and not handle.timers


def test_sessions_over_many_frames_do_not_wait():
    """What comes in one call is handled together: nothing is parked in the state between its frames."""
    rows = pd.DataFrame([(k, i, float(i), False, True) for k in range(20) for i in range(30)], columns=["k", "number", "value", "end", "known_key"])
    rows = rows.sample(frac=1, random_state=3)
    handle = Handle()
    processor = S.GroupProcessor(S.StreamSettings(chunk_seconds=4, sr=1, ttl_seconds=None), words, "number", StructField("k", LongType()))
    processor.init(handle)
    out = pd.concat(processor.handleInputRows((0,), iter([rows[low : low + 25] for low in range(0, 600, 25)]), None))
    assert processor.early.moved == 0 and sorted(zip(out["k"], out["n_seen"])) == [(k, n) for k in range(20) for n in range(4, 29, 4)]


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_rows_are_packed_by_group(spark, most):
    rows = [(k % 3, k if k % 5 else None, f"t{k}" if k % 4 else None) for k in range(100)]
    df = spark.createDataFrame(rows, "g bigint, n bigint, t string").coalesce(1)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(S, "PACKED_ROWS", most)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
        found = S.packed(df, "g").collect()
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert most < 1000 or len(found) == 3
    for group in range(3):
        mine = [list(zip(r["n"], r["t"])) for r in found if r["g"] == group]
        assert sum(mine, []) == [(n, t) for g, n, t in rows if g == group]
    assert S.packed(df.where("false"), "g").collect() == []


def test_replay_opens_few_state_partitions(spark):
    rows = session_rows(spark, {k: 5 for k in range(30)})
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        checkpoint = scratch_path(spark, "few-parts")
        settings = S.StreamSettings(chunk_seconds=2, sr=1, ttl_seconds=None)
        steps = replay(rows, 100, "user_id", settings, words, checkpoint=checkpoint).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    parts = [p for p in Path(checkpoint.split(":", 1)[-1], "state", "0").iterdir() if p.name.isdigit()]
    assert steps == 90 and len(parts) == 2 * spark.sparkContext.defaultParallelism
