"""Idle sessions of a stream by event time: timers that the watermark fires.

A session ends when the next event of its key comes more than the limit later. Events come in any order within the
watermark's delay, so a key may have several open sessions: stretches of time that grow and meet as events fill in. A
timer stands at the end of the earliest one; when the watermark has passed it by more than the limit no event can
extend that session any more, and it is given out and forgotten. Events at or behind the watermark are late, and the stream
drops them.

Keys are handled in groups: a call of Python and a timer, that of the earliest stretch, are shared by the keys of a group.
What is kept of a key is its open stretches and the number of those that are closed. Results are those of
``twins.idle_sessions`` over the events that are not late.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from voxloom.constants import SESSION_TTL_SECONDS
from voxloom.streaming.sessions import in_groups, keys_of

#: Groups that keys are dealt to.
GROUPS = 128
COLUMNS = ("session", "started_us", "ended_us", "n")


def stretches(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """Stretches of time of several keys, joined where less than or just the limit lies between them, in order of key and time."""
    if not len(starts):
        return codes, starts, ends, counts
    order = np.lexsort((starts, codes))
    codes, starts, ends, counts = codes[order], starts[order], ends[order], counts[order]
    reach = pd.Series(ends).groupby(codes).cummax().to_numpy()
    opens = (codes[1:] != codes[:-1]) | (starts[1:] - reach[:-1] > limit)
    first = np.flatnonzero(np.concatenate([[True], opens]))
    last = np.append(first[1:], len(starts)) - 1
    return codes[first], starts[first], reach[last], np.add.reduceat(counts, first)


def merged(starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of one key."""
    return stretches(np.zeros(len(starts), dtype=np.int64), starts, ends, counts, limit)[1:]


class IdleProcessor(StatefulProcessor):
    """Handles a group of keys at once: its state is a table of all their open stretches and of the numbers of closed ones."""

    def __init__(self, key: StructField, limit_us: int):
        self.key, self.limit = key.name, limit_us
        self.kind = to_arrow_type(key.dataType)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "keys binary, closed binary, stretches binary")

    def _load(self) -> tuple[pd.Series, np.ndarray, tuple[np.ndarray, ...]]:
        """(keys, how many of their sessions are closed, open stretches); a stretch names its key by place."""
        if not self.open.exists():
            none = np.zeros(0, dtype=np.int64)
            return pd.Series(none, dtype=object), none, (none,) * 4
        keys, closed, spans = self.open.get()
        keys = pa.ipc.open_stream(keys).read_all().column(0).to_pandas(integer_object_nulls=True)
        return keys.astype(object), np.frombuffer(closed, dtype=np.int64), tuple(np.frombuffer(spans, dtype=np.int64).reshape(4, -1))

    def _fires(self, end: np.ndarray) -> np.ndarray:
        """The first millisecond at which the watermark has passed an end by more than the limit."""
        return (end + self.limit) // 1000 + 1

    def _store(self, keys: pd.Series, closed: np.ndarray, spans: tuple[np.ndarray, ...]) -> None:
        table = pa.table({"key": pa.Array.from_pandas(keys, type=self.kind)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.open.update((sink.getvalue().to_pybytes(), closed.tobytes(), np.stack(spans).tobytes()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        ends = spans[2]
        if len(ends):
            self.handle.registerTimer(int(self._fires(ends.min())))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        keys, closed, spans = self._load()
        for frame in rows:
            at = frame["at_us"].to_numpy(dtype=np.int64)
            # keys that are known keep their places
            codes, keys = pd.factorize(pd.concat([keys, keys_of(frame, self.key)]), use_na_sentinel=False)
            codes, keys = codes[-len(at) :].astype(np.int64), pd.Series(keys)
            closed = np.append(closed, np.zeros(len(keys) - len(closed), dtype=np.int64))
            new = (codes, at, at, np.ones(len(at), dtype=np.int64))
            spans = stretches(*[np.concatenate(both) for both in zip(spans, new)], self.limit)
        self._store(keys, closed, spans)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        keys, closed, spans = self._load()
        # the stretches of a key are in order of time, so those that are over come first
        over = self._fires(spans[2]) <= timerValues.getCurrentWatermarkInMs()
        codes, starts, ends, counts = (x[over] for x in spans)
        session = closed[codes] + pd.Series(codes).groupby(codes).cumcount().to_numpy()
        out = pd.DataFrame({self.key: keys.to_numpy()[codes], "session": session, "started_us": starts, "ended_us": ends, "n": counts})
        self._store(keys, closed + np.bincount(codes, minlength=len(keys)), tuple(x[~over] for x in spans))
        if len(out):
            yield out

    def close(self) -> None:
        pass


def closed_sessions(
    events: DataFrame, key: str, ts: str, delay: str, ttl_seconds: float = SESSION_TTL_SECONDS, groups: int = GROUPS
) -> DataFrame:
    """(key, session, started_us, ended_us, n) of the sessions of a stream, each as soon as it is over for certain.

    ``delay`` is how much later than the newest event an event may come. Keys are dealt to ``groups`` groups that share calls, timers
    and an entry of the state each; a checkpoint keeps that number. It needs the state store of ``session.ROCKSDB``.
    """
    schema = StructType([events.schema[key], *[StructField(c, LongType()) for c in COLUMNS]])
    at = F.col(ts).cast("timestamp")
    marked = in_groups(events.select(key, at.alias(ts), F.unix_micros(at).alias("at_us")), key, groups).withWatermark(ts, delay)
    processor = IdleProcessor(events.schema[key], int(ttl_seconds * 1_000_000))
    return marked.groupBy("_group").transformWithStateInPandas(processor, schema, "Append", "EventTime")
