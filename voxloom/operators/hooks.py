"""User-function surface: recogniser, aligner, tokenizer and detector hooks.

A hook is a zero-argument factory. It is called once per Python worker and kept there, so a model is loaded once and
not once per batch; only the factory travels with the job. Batches of rows on their way to a worker are bounded in rows and
bytes (``session.bound_batches``), whatever the length of the texts.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterable, Iterator, Mapping

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from voxloom.functions.align import pair_timestamps, repaired_lists
from voxloom.functions.text import is_blank
from voxloom.session import bound_batches

_LOADED: dict = {}


def loaded(name: str, factory: Callable):
    """The object of this worker, made on first use."""
    key = (name, getattr(factory, "__module__", None), getattr(factory, "__qualname__", repr(factory)))
    if key not in _LOADED:
        _LOADED[key] = factory()
    return _LOADED[key]


#: Most bytes of audio that a model is given at once.
BATCH_BYTES = 256 << 20


def _spans(lengths: Iterable[int], size: int, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Start and number of consecutive rows, at most ``size`` of them and at most ``most_bytes`` of audio (4 bytes a sample); a
    signal above that is alone. Padding counts: a batch costs its longest signal times its rows."""
    start, longest, at = 0, 0, -1
    for at, length in enumerate(lengths):
        own = 4 * length
        if at > start and (0 < (size or 0) <= at - start or max(longest, own) * (at - start + 1) > most_bytes):
            yield start, at - start
            start, longest = at, 0
        longest = max(longest, own)
    if at >= start:
        yield start, at + 1 - start


def model_profile(
    task_cpus: int = 1, gpus: float = 0, executor_cores: int | None = None, executor_memory: str | None = None,
    python_memory: str | None = None,
) -> ResourceProfile:
    """What the stage of a model needs, apart from the stages around it: cores and accelerators per task, memory for the
    worker. The cluster manager must be able to give it (it needs dynamic allocation or a standalone, YARN or Kubernetes master)."""
    tasks = TaskResourceRequests().cpus(task_cpus)
    executors = ExecutorResourceRequests()
    if gpus:
        tasks = tasks.resource("gpu", gpus)
        executors = executors.resource("gpu", max(1, math.ceil(gpus)))
    if executor_cores:
        executors = executors.cores(executor_cores)
    if executor_memory:
        executors = executors.memory(executor_memory)
    if python_memory:
        executors = executors.pysparkMemory(python_memory)
    return ResourceProfileBuilder().require(tasks).require(executors).build


def transcribe_batches(
    df: DataFrame, keys: list[str], prompt: str, wav: str, factory: Callable, batch_size: int = 32, batch_bytes: int = BATCH_BYTES,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """(keys, raw). ``factory()`` gives a function (prompts, waveforms) -> raw texts; it sees at most ``batch_size`` rows whose
    padded audio is at most ``batch_bytes``. ``profile`` gives the stage of the model resources of its own (``model_profile``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded("recogniser", factory)
        for batch in batches:
            lengths = [0 if signal is None else len(signal) for signal in batch[wav]]
            for start, count in _spans(lengths, batch_size, batch_bytes):
                part = batch.iloc[start : start + count]
                out = part[keys].copy()
                out["raw"] = list(model(list(part[prompt]), list(part[wav])))
                yield out

    schema = StructType([*[df.schema[k] for k in keys], StructField("raw", StringType())])
    needed = dict.fromkeys([*keys, prompt, wav])
    bound_batches(df.sparkSession)
    return df.select(*needed).mapInPandas(run, schema, profile=profile)


def align_batches(
    df: DataFrame, keys: list[str], wav: str, words: str, text: str, factory: Callable, segment_ms: float = 80.0,
    offset: str | None = None, batch_size: int = 32, batch_bytes: int = BATCH_BYTES, profile: ResourceProfile | None = None,
) -> DataFrame:
    """(keys, time_stamps). ``factory()`` gives a function (encoded texts, waveforms, word counts) -> lists of slot
    numbers, two per word; the slots become milliseconds, are repaired and paired with the words. Batches are bounded as
    those of ``transcribe_batches``; keys and words stay in Arrow, only what the model sees becomes objects.
    The repair is done where the slots are made, so a task has one Python worker."""
    keep = [*keys, words, *([offset] if offset else [])]
    found = StructField("_ms", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded("aligner", factory)
        for batch in batches:
            # kept columns, the signal, the text
            lengths = pc.fill_null(pc.list_value_length(batch.column(len(keep))), 0).to_pylist()
            for start, count in _spans(lengths, batch_size, batch_bytes):
                *kept, signals, texts = batch.slice(start, count).columns
                counts = pc.list_value_length(kept[len(keys)]).to_pylist()
                slots = list(model(texts.to_pylist(), list(signals.to_pandas()), counts))
                made = pa.Array.from_pandas(pd.Series(slots, dtype=object), type=pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept, repaired_lists(made, segment_ms)], names=[*keep, found.name])

    bound_batches(df.sparkSession)
    schema = StructType([*[df.schema[k] for k in keep], found])
    made = df.select(*keep, wav, text).mapInArrow(run, schema, profile=profile)
    spans = pair_timestamps(F.col(words), F.col("_ms"), F.col(offset) if offset else None)
    return made.select(*keys, spans.alias("time_stamps"))


def token_counter(factory: Callable) -> Callable[[Column], Column]:
    """Token counts from a user's tokenizer: ``factory()`` gives a function text -> list of tokens."""
    bound_batches(SparkSession.active())

    @F.pandas_udf(IntegerType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = loaded("tokenizer", factory)
        for batch in texts:
            yield batch.map(lambda t: len(encode(t)) if t is not None else None).astype("Int32")

    return count


def detector(factory: Callable, timed: bool = False) -> Callable[[Column], Column]:
    """(code, confidence, error) from a user's detector: ``factory()`` gives a function text -> (code, confidence).

    ``timed`` adds ``nanos``, how long the call took in its worker, null where there was none. A detector that cannot be set up is reported as unavailable in every row; a text that fails has its message.
    """
    bound_batches(SparkSession.active())
    schema = StructType(
        [StructField("code", StringType()), StructField("confidence", DoubleType()), StructField("error", StringType())]
    )
    if timed:
        schema = schema.add("nanos", LongType())

    @F.pandas_udf(schema)
    def detect(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            find, problem = loaded("detector", factory), None
        except Exception as error:  # the factory belongs to the user
            find, problem = None, f"unavailable: {error}"

        def one(text):
            if find is None:
                return None, None, problem, None
            begun = time.perf_counter_ns()
            try:
                code, confidence = find(text)
                return code, float(confidence), None, time.perf_counter_ns() - begun
            except Exception as error:  # the detector belongs to the user
                return None, 0.0, f"error: {error}", time.perf_counter_ns() - begun

        for batch in texts:
            rows = pd.DataFrame([one(t) for t in batch], columns=["code", "confidence", "error", "nanos"], dtype=object)
            yield rows.astype({"confidence": "Float64", "nanos": "Int64"})[schema.names]

    return detect


def detector_columns(registry: Mapping[str, Callable], text: Column) -> dict[str, Column]:
    """Prediction columns of a registry name -> factory, in the form a detector grid takes."""
    return {name: detector(factory)(text)["code"] for name, factory in registry.items()}


def timed_grid(df: DataFrame, registry: Mapping[str, Callable], text: str, keep: list[str]) -> DataFrame:
    """(keep, detector, predicted, error, nanos): every detector of a registry name -> factory on every text, one row each."""
    answers = [F.struct(F.lit(name).alias("detector"), detector(factory, timed=True)(text).alias("a")) for name, factory in registry.items()]
    # the answers are made before they are unfolded, so each detector runs once a text
    made = df.select(*keep, F.array(*answers).alias("_answers")).select(*keep, F.inline("_answers"))
    return made.select(*keep, "detector", F.col("a.code").alias("predicted"), "a.error", "a.nanos")


def alignable(df: DataFrame, text: str) -> DataFrame:
    """Blank chunks never reach the aligner."""
    return df.where(~is_blank(F.col(text)))


def model_languages(names: DataFrame, name: str, supported: tuple[str, ...] | None) -> DataFrame:
    """Lower-case names of the given rows that the model supports; all of them stay where the model has no list."""
    kept = names if supported is None else names.where(F.col(name).isin(*supported))
    return kept.select(F.lower(name).alias("language")).distinct()
