"""Live transcription as keyed state: chunk buffer, prefix rollback, finish, idle sessions.

A session is a key, and its samples are numbered from 0 by their sender. Its state holds the samples that do not fill a
chunk yet, samples that came before others that are missing, the raw text decoded so far and, where the model needs it,
the chunks consumed so far. Samples are consumed by number, so the steps do not depend on batches, files or the order
of arrival. The closing row has the number after the last sample: it waits for missing samples like they do. A number
that was consumed already is ignored. State lives in the state store, so sessions survive a restart.

Sessions without timers are handled in groups: a call of Python, a frame and a batch of results are shared by the many sessions
of a group, and so is the entry of the state with their progress. The samples of a group travel packed, many in a row, because
Spark hands rows to a stateful worker one by one. Timers belong to a key, so with them a session is its key.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from voxloom.constants import RECOGNITION_LANGUAGES, SAMPLE_RATE, SESSION_TTL_SECONDS
from voxloom.functions.language import parse_model_output
from voxloom.operators.hooks import loaded
from voxloom.session import ROCKSDB, bound_batches, scratch_path

BROKEN_CHARACTER = "\ufffd"
#: Sample numbers that share one entry of waiting samples.
STRETCH = 4096
#: Groups of sessions that have no timers.
GROUPS = 256
#: Rows of a task that are packed at once, and rows of a group that are handled at once.
PACKED_ROWS, FRAME_ROWS = 1 << 17, 1 << 18
STEP_COLUMNS = ["chunk_id", "n_new", "n_seen", "sum_new", "sum_seen", "prefix", "raw", "final"]


@dataclass(frozen=True)
class StreamSettings:
    """Settings of a stream, checked when they are made.

    Idle sessions are closed by processing-time timers. A run over stored data has no idle time; give it a ``ttl_seconds``
    of None, because with timers a stream never counts as done. ``keep_audio`` hands the model everything heard so far and
    so lets the state grow with the session; without it the model gets the new samples.
    """

    chunk_seconds: float = 2.0
    sr: int = SAMPLE_RATE
    unfixed_chunks: int = 2
    unfixed_tokens: int = 5
    context: str = ""
    language: str | None = None
    ttl_seconds: float | None = SESSION_TTL_SECONDS
    keep_audio: bool = False

    def __post_init__(self):
        if self.chunk_seconds is None or not self.chunk_seconds > 0:
            raise ValueError(f"chunk_seconds must be above 0, got {self.chunk_seconds}")
        if self.forced_language and self.forced_language not in RECOGNITION_LANGUAGES:
            raise ValueError(f"unsupported language: {self.forced_language}")

    @property
    def chunk_samples(self) -> int:
        return max(1, round(self.chunk_seconds * self.sr))

    @property
    def forced_language(self) -> str | None:
        name = (self.language or "").strip()
        return name[:1].upper() + name[1:].lower() if name else None


def in_groups(df: DataFrame, key: str, groups: int) -> DataFrame:
    """With the group of a key, and whether there is a key. A whole number travels without nulls, which would make it a float."""
    out = df.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups))).withColumn("known_key", F.col(key).isNotNull())
    kind = df.schema[key].dataType
    return out.withColumn(key, F.coalesce(key, F.lit(0).cast(kind))) if isinstance(kind, IntegralType) else out


def keys_of(frame: pd.DataFrame, key: str) -> pd.Series:
    return frame[key].astype(object).where(frame["known_key"].astype(bool), None)


def packed(df: DataFrame, group: str) -> DataFrame:
    """(group, lists of the other columns): the rows of a group among ``PACKED_ROWS`` rows of a task are one row, in the order they
    have there."""
    lists = [f for f in df.schema if f.name != group]

    def together(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        groups = rows.column(group).to_numpy()
        order = np.argsort(groups, kind="stable")
        groups = groups[order]
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        ends = pa.array(np.append(starts, len(groups)), type=pa.int32())
        rows = rows.take(pa.array(order))
        columns = [pa.ListArray.from_arrays(ends, rows.column(f.name).combine_chunks()) for f in lists]
        return pa.RecordBatch.from_arrays([pa.array(groups[starts]), *columns], names=[group, *[f.name for f in lists]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= PACKED_ROWS:
                yield together(held)
                held, n = [], 0
        if held:
            yield together(held)

    # a batch is some rows of many samples on its way to the state, so its bytes have to be bounded
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, StructType([df.schema[group], *[StructField(f.name, ArrayType(f.dataType)) for f in lists]]))


def split_tokens(text: str) -> list[str]:
    """Default tokenizer of the rollback: words with the blanks behind them."""
    return re.findall(r"\S+\s*|\s+", text)


def rollback(tokens: list[str], drop: int, finishing: bool = False) -> str:
    """Text without its last ``drop`` tokens.

    A running step goes further back while the rest holds a broken character and may end with nothing; the finishing
    step keeps one token at least and does not look for broken characters.
    """
    kept = len(tokens) - drop
    if finishing:
        return "".join(tokens[: max(kept, 1)])
    while kept > 0 and BROKEN_CHARACTER in "".join(tokens[:kept]):
        kept -= 1
    return "".join(tokens[:kept]) if kept > 0 else ""


def stream_steps_schema(key: StructField) -> StructType:
    return StructType(
        [
            key,
            StructField("chunk_id", IntegerType()),
            StructField("n_new", IntegerType()),
            StructField("n_seen", LongType()),
            StructField("sum_new", DoubleType()),
            StructField("sum_seen", DoubleType()),
            StructField("prefix", StringType()),
            StructField("raw", StringType()),
            StructField("final", BooleanType()),
        ]
    )


class SessionProcessor(StatefulProcessor):
    """Consumes rows (number, value, end) of a session and gives one row per recognition step."""

    def __init__(self, settings: StreamSettings, factory: Callable, number: str, key: str):
        self.settings, self.factory, self.number, self.key = settings, factory, number, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState(
            "progress", "chunk_id int, n_seen bigint, sum_seen double, raw string, buffer array<float>, size bigint, waiting bigint"
        )
        # samples that wait for others, by stretches of numbers: a frame touches only the stretches it belongs to
        self.early = handle.getMapState("early", "stretch bigint", "numbers array<bigint>, samples array<float>")
        self.audio = handle.getListState("audio", "chunk array<float>")
        self.model = loaded("stream", self.factory)

    def _step(self, state: dict, new: np.ndarray, heard: list[np.ndarray], finishing: bool) -> tuple:
        s = self.settings
        prefix = ""
        if state["chunk_id"] >= s.unfixed_chunks:
            prefix = rollback(split_tokens(state["raw"]), s.unfixed_tokens, finishing)
        heard.append(new)
        audio = np.concatenate(heard) if s.keep_audio else new
        state["n_seen"] += len(new)
        state["sum_new"] = float(new.sum(dtype=np.float64))
        state["sum_seen"] += state["sum_new"]
        state["raw"] = prefix + self.model(s.context, prefix, audio)
        row = (
            state["chunk_id"], len(new), state["n_seen"], state["sum_new"], state["sum_seen"], prefix, state["raw"],
            finishing,
        )
        state["chunk_id"] += 1
        return row

    def _new(self) -> dict:
        return {"chunk_id": 0, "n_seen": 0, "sum_seen": 0.0, "raw": "", "buffer": np.empty(0, np.float32), "size": -1, "waiting": 0}

    def _load(self) -> dict:
        if not self.progress.exists():
            return self._new()
        chunk_id, n_seen, sum_seen, raw, buffer, size, waiting = self.progress.get()
        return {
            "chunk_id": chunk_id, "n_seen": n_seen, "sum_seen": sum_seen, "raw": raw,
            "buffer": np.asarray(buffer, dtype=np.float32), "size": size, "waiting": waiting,
        }

    def _waiting(self, stretch: int) -> tuple[np.ndarray, np.ndarray]:
        numbers, samples = self.early.getValue((stretch,)) if self.early.containsKey((stretch,)) else ((), ())
        return np.asarray(numbers, dtype=np.int64), np.asarray(samples, dtype=np.float32)

    def _due(self, state: dict, numbers: np.ndarray, samples: np.ndarray) -> np.ndarray:
        """The samples that follow on those consumed; the others are kept until what lies before them is there."""
        after = state["n_seen"] + len(state["buffer"])
        # the first row of a number counts
        numbers, first = np.unique(numbers, return_index=True)
        ahead = numbers >= after
        return self._placed(state, after, numbers[ahead], samples[first][ahead])

    def _placed(self, state: dict, after: int, numbers: np.ndarray, samples: np.ndarray) -> np.ndarray:
        """The same for samples that have not been consumed, in the order of their numbers and each number once.

        Only the stretches that the frame's own samples belong to and those that become due are read and written, so a
        session whose first sample comes last costs as much as one in order.
        """
        if not state["waiting"] and (not len(numbers) or numbers[-1] - after + 1 == len(numbers)):
            # none is missing and none waits
            return samples
        stretches = numbers // STRETCH
        own = {int(k): (numbers[stretches == k], samples[stretches == k]) for k in np.unique(stretches)}
        due: list[np.ndarray] = []
        at = after // STRETCH
        while at in own or state["waiting"]:
            kept = self._waiting(at) if state["waiting"] else (numbers[:0], samples[:0])
            mine = own.pop(at, (numbers[:0], samples[:0]))
            both = np.concatenate([kept[0], mine[0]])
            both, first = np.unique(both, return_index=True)
            values = np.concatenate([kept[1], mine[1]])[first]
            ready = int((both == after + np.arange(len(both))).sum())
            if ready:
                due.append(values[:ready])
                after += ready
            self._keep(state, at, len(kept[0]), both[ready:], values[ready:])
            if after < (at + 1) * STRETCH:
                break
            at += 1
        for stretch, (more, values) in own.items():
            kept = self._waiting(stretch) if state["waiting"] else (more[:0], values[:0])
            both, first = np.unique(np.concatenate([kept[0], more]), return_index=True)
            self._keep(state, stretch, len(kept[0]), both, np.concatenate([kept[1], values])[first])
        return np.concatenate(due) if due else samples[:0]

    def _keep(self, state: dict, stretch: int, before: int, numbers: np.ndarray, samples: np.ndarray) -> None:
        state["waiting"] += len(numbers) - before
        if len(numbers):
            self.early.updateValue((stretch,), (numbers.tolist(), samples.tolist()))
        elif before:
            self.early.removeKey((stretch,))

    def _heard(self) -> list[np.ndarray]:
        keep = self.settings.keep_audio
        return [np.asarray(c[0], dtype=np.float32) for c in self.audio.get()] if keep and self.audio.exists() else []

    def _steps(self, state: dict, samples: np.ndarray, finish: bool) -> tuple[list[tuple], list[np.ndarray]]:
        """The steps that are due now, and the chunks that they add to what was heard."""
        size = self.settings.chunk_samples
        waiting = np.concatenate([state["buffer"], samples])
        whole = len(waiting) // size
        # the stored chunks are read only when this batch completes a chunk
        heard = self._heard() if whole or (finish and len(waiting)) else []
        known = len(heard)
        rows = [self._step(state, waiting[i * size : (i + 1) * size], heard, False) for i in range(whole)]
        state["buffer"] = waiting[whole * size :]
        if finish and len(state["buffer"]):
            rows.append(self._step(state, state["buffer"], heard, True))
        return rows, heard[known:]

    def _run(self, key, state: dict, samples: np.ndarray, finish: bool) -> pd.DataFrame:
        rows, heard = self._steps(state, samples, finish)
        if finish:
            self.progress.clear()
            self.audio.clear()
            self.early.clear()
        else:
            if self.settings.keep_audio and heard:
                self.audio.appendList([(c.tolist(),) for c in heard])
            self.progress.update(
                (
                    state["chunk_id"], state["n_seen"], state["sum_seen"], state["raw"], state["buffer"].tolist(),
                    state["size"], state["waiting"],
                )
            )
        out = pd.DataFrame(rows, columns=STEP_COLUMNS)
        out.insert(0, self.key, key[0])
        return out

    def _renew(self, timerValues, finish: bool) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not finish:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(now + int(self.settings.ttl_seconds * 1000))

    def _columns(self, frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        closing, numbers = frame["end"].to_numpy(dtype=bool), frame[self.number].to_numpy(dtype=np.int64)
        return closing, numbers, frame["value"].to_numpy(dtype=np.float32)

    def _taken(self, state: dict, closing: np.ndarray, numbers: np.ndarray, samples: np.ndarray) -> tuple[np.ndarray, bool]:
        """The samples that are due with these rows, and whether they are the last ones of the session."""
        if closing.any():
            state["size"] = int(numbers[closing].max())
        due = self._due(state, numbers[~closing], samples[~closing])
        return due, state["size"] >= 0 and state["n_seen"] + len(state["buffer"]) + len(due) >= state["size"]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The frames of a batch are consumed one by one, so no more than one of them is held."""
        finished = False
        for frame in rows:
            state = self._load()
            due, finished = self._taken(state, *self._columns(frame))
            out = self._run(key, state, due, finished)
            if len(out):
                yield out
        if self.settings.ttl_seconds is not None:
            self._renew(timerValues, finished)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """An idle session is finished with the samples that are due, and removed; samples behind a gap are lost."""
        out = self._run(key, self._load(), np.empty(0, np.float32), True)
        if len(out):
            yield out

    def close(self) -> None:
        pass


class GroupProcessor(SessionProcessor):
    """The same steps for groups of sessions without timers.

    The progress of a group's open sessions is one entry of the state, read once and written once a batch; what waits for missing
    samples and the audio that is kept have entries of their own per session.
    """

    def __init__(self, settings: StreamSettings, factory: Callable, number: str, key: StructField, packed: bool = False):
        super().__init__(settings, factory, number, key.name)
        self.kind, self.packed = key.dataType, packed

    def init(self, handle: StatefulProcessorHandle) -> None:
        session = StructField("session", self.kind)
        self.progress = handle.getValueState("progress", "sessions binary")
        self.early = handle.getMapState(
            "early", StructType([session, StructField("stretch", LongType())]), "numbers array<bigint>, samples array<float>"
        )
        self.audio = handle.getMapState("audio", StructType([session]), "heard binary")
        self.model = loaded("stream", self.factory)

    def _new(self) -> dict:
        return super()._new() | {"stretches": set()}

    def _open(self) -> dict:
        """The state of each open session."""
        states = pickle.loads(self.progress.get()[0]) if self.progress.exists() else {}
        for state in states.values():
            state["buffer"] = np.frombuffer(state["buffer"], dtype=np.float32)
        return states

    def _save(self, states: dict) -> None:
        if not states:
            self.progress.clear()
            return
        names = list(self._new())
        plain = {k: {n: s[n] for n in names} | {"buffer": s["buffer"].tobytes()} for k, s in states.items()}
        self.progress.update((pickle.dumps(plain),))

    def _forget(self, state: dict) -> None:
        for stretch in state["stretches"]:
            self.early.removeKey((self.session, stretch))
        if self.settings.keep_audio and self.audio.containsKey((self.session,)):
            self.audio.removeKey((self.session,))

    def _waiting(self, stretch: int) -> tuple[np.ndarray, np.ndarray]:
        place = (self.session, stretch)
        numbers, samples = self.early.getValue(place) if self.early.containsKey(place) else ((), ())
        return np.asarray(numbers, dtype=np.int64), np.asarray(samples, dtype=np.float32)

    def _keep(self, state: dict, stretch: int, before: int, numbers: np.ndarray, samples: np.ndarray) -> None:
        state["waiting"] += len(numbers) - before
        if len(numbers):
            self.early.updateValue((self.session, stretch), (numbers.tolist(), samples.tolist()))
            state["stretches"].add(stretch)
        elif before:
            self.early.removeKey((self.session, stretch))
            state["stretches"].discard(stretch)

    def _heard(self) -> list[np.ndarray]:
        if not self.settings.keep_audio or not self.audio.containsKey((self.session,)):
            return []
        return [np.frombuffer(self.audio.getValue((self.session,))[0], dtype=np.float32)]

    def _frames(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows in frames of ``FRAME_ROWS`` or a little more, so that those of a session lie together, whatever comes at once."""
        held, n = [], 0
        for frame in rows:
            if self.packed:
                columns = (self.key, self.number, "value", "end", "known_key")
                frame = pd.DataFrame({c: np.concatenate(frame[c].tolist()) for c in columns})
            held.append(frame)
            n += len(frame)
            if n >= FRAME_ROWS:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    def _dealt(self, frame: pd.DataFrame, states: dict) -> Iterator[tuple[object, dict, np.ndarray]]:
        """(session, its state, the samples that are due) for the sessions of a frame. What is the same for every session is done
        for all at once; only sessions that wait for samples are looked at one by one."""
        keys = frame[self.key] if frame["known_key"].all() else keys_of(frame, self.key)
        codes, sessions = pd.factorize(keys, use_na_sentinel=False)
        sessions = [None if pd.isna(s) else s for s in sessions.tolist()]
        own = [states.pop(s, None) or self._new() for s in sessions]
        after = np.array([s["n_seen"] + len(s["buffer"]) for s in own], dtype=np.int64)
        closing, numbers, samples = self._columns(frame)
        sizes = np.full(len(own), -1)
        np.maximum.at(sizes, codes[closing], numbers[closing])
        for k in np.unique(codes[closing]).tolist():
            own[k]["size"] = int(sizes[k])
        ahead = ~closing & (numbers >= after[codes])
        codes, numbers, samples = codes[ahead], numbers[ahead], samples[ahead]
        # the first row of a number counts
        order = np.lexsort((numbers, codes))
        codes, numbers, samples = codes[order], numbers[order], samples[order]
        first = np.ones(len(codes), dtype=bool)
        first[1:] = (codes[1:] != codes[:-1]) | (numbers[1:] != numbers[:-1])
        codes, numbers, samples = codes[first], numbers[first], samples[first]
        ends = np.searchsorted(codes, np.arange(len(own) + 1)).tolist()
        for session, state, expected, low, high in zip(sessions, own, after.tolist(), ends, ends[1:]):
            self.session = session
            yield session, state, self._placed(state, expected, numbers[low:high], samples[low:high])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """What is held over the frames of a group is the progress of its open sessions."""
        states = self._open()
        for frame in self._frames(rows):
            out, of = [], []
            for session, state, due in self._dealt(frame, states):
                finished = state["size"] >= 0 and state["n_seen"] + len(state["buffer"]) + len(due) >= state["size"]
                steps, heard = self._steps(state, due, finished)
                out += steps
                of += [session] * len(steps)
                if finished:
                    self._forget(state)
                    continue
                states[session] = state
                if self.settings.keep_audio and heard:
                    self.audio.updateValue((session,), (np.concatenate([*self._heard(), *heard]).tobytes(),))
            if out:
                steps = pd.DataFrame(out, columns=STEP_COLUMNS)
                steps.insert(0, self.key, pd.Series(of, dtype=object))
                yield steps
        self._save(states)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter(())


def stream_steps(
    events: DataFrame, key: str, number: str, settings: StreamSettings, factory: Callable, mode: str = "Append",
    groups: int = GROUPS,
) -> DataFrame:
    """Recognition steps of a stream with columns key, number, value and end (true on the closing row of a session).

    Sessions without timers are dealt to ``groups`` groups, of which a worker holds the buffers and texts of one; a checkpoint keeps
    that number. ``mode`` is the output mode of the stream, Append or Update. It needs the state store of ``ROCKSDB``; ``run_available`` sets it while it starts the stream.
    """
    field, schema = events.schema[key], stream_steps_schema(events.schema[key])
    if settings.ttl_seconds is None:
        # most of a small frame's cost is that of the frame, so sessions share them
        marked = in_groups(events.select(key, number, "value", "end"), key, groups)
        processor = GroupProcessor(settings, factory, number, field, packed=True)
        steps = packed(marked, "_group").groupBy("_group").transformWithStateInPandas(processor, schema, mode, "None")
    else:
        processor = SessionProcessor(settings, factory, number, key)
        steps = events.groupBy(key).transformWithStateInPandas(processor, schema, mode, "ProcessingTime")
    # a step is parsed like any model output, in the JVM and without state
    forced = F.lit(settings.forced_language).cast("string")
    return parse_model_output(steps.withColumn("_forced", forced), "raw", "_forced", "language", "text").drop("_forced")


def run_writer(
    stream: DataFrame, writer: Callable[[DataStreamWriter], DataStreamWriter], checkpoint: str, state_partitions: int | None = None,
    paced: bool = False,
) -> None:
    """Run a stream over what is there now into the sink that ``writer`` sets up.

    ``paced`` is for sources that admit a part of what is there per trigger and decide themselves how much; other sources are
    read to their end. A checkpoint keeps its number of state partitions for ever, so plan it for the stream's full
    size: ``state_partitions``, else the session's setting. Both settings of the session are put back once the query
    has started and read them.
    """
    spark = stream.sparkSession
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    usual = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        ready = writer(stream.writeStream.option("checkpointLocation", checkpoint))
        query = (ready.trigger(processingTime="0 seconds") if paced else ready.trigger(availableNow=True)).start()
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value)
    if not paced:
        query.awaitTermination()
        return
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_available(
    stream: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None, state_partitions: int | None = None,
    paced: bool = False,
) -> DataFrame:
    """Run a stream over what is there now and read the result back; paths are new ones in the shared folder unless given.

    With the paths of an earlier run the stream goes on where that run stopped. The other arguments are those of
    ``run_writer``.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, name)
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")
    run_writer(
        stream, lambda w: w.format("parquet").outputMode("append").option("path", out), checkpoint, state_partitions, paced
    )
    return spark.read.schema(stream.schema).parquet(out)


def latest_step(steps: DataFrame, key: str) -> DataFrame:
    """The last step of each session."""
    return steps.groupBy(key).agg(
        F.max("chunk_id").alias("chunk_id"), F.max_by("language", "chunk_id").alias("language"),
        F.max_by("text", "chunk_id").alias("text"),
    )
