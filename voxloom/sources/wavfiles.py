"""A data source for folders of WAV files: it reads headers only, and writes files from rows.

``spark.read.format("voxloom_wav").load(folder)`` gives (path, length, sr, channels, duration, header_bytes). The driver lists
the folder and deals the files to partitions by what they cost to look at, not by their length: a header is a few
hundred bytes at the front, wherever its chunks lie, so an hour of audio costs as much as a second. Each task opens its own
files and seeks from chunk to chunk.

``df.write.format("voxloom_wav").mode("append").save(folder)`` writes a table (name, content) as one file per row. A file is
written beside its place and moved there when it is whole, so a task that runs twice leaves the same files.

The store must be one that the Arrow file systems open (local or mounted folders, object stores).
"""

from __future__ import annotations

import fnmatch
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from voxloom.sources.stores import files_below, opened

NAME = "voxloom_wav"
SCHEMA = "path string, length bigint, sr int, channels int, duration double, header_bytes bigint"
#: What opening a file counts for when partitions are planned, and what a partition holds.
OPEN_BYTES, PARTITION_BYTES = 1 << 16, 1 << 25
#: Most chunks that are passed on the way to the samples.
MOST_CHUNKS = 1000
#: A size that says "see the 64-bit chunk" or "not known yet".
UNKNOWN_SIZE = 0xFFFFFFFF


@dataclass(frozen=True)
class Header:
    """Rate, channels, seconds, and the bytes it took to find them; an unreadable file has a duration of -1."""

    sr: int | None
    channels: int | None
    duration: float
    header_bytes: int


def read_header(source: BinaryIO, length: int) -> Header:
    """Walks the chunks of a RIFF or RF64 file up to its samples, reading their heads only. A ``data`` chunk that promises more
    than the file holds counts as what is there."""
    spent = 0

    def take(n: int) -> bytes:
        nonlocal spent
        data = source.read(n)
        spent += len(data)
        return data

    number = lambda data, at, size: int.from_bytes(data[at : at + size], "little")
    head = take(12)
    sr = channels = frame = None
    whole = 0
    if len(head) == 12 and head[:4] in (b"RIFF", b"RF64") and head[8:] == b"WAVE":
        at = 12
        for _ in range(MOST_CHUNKS):
            source.seek(at)
            chunk = take(8)
            if len(chunk) < 8:
                break
            kind, size = chunk[:4], number(chunk, 4, 4)
            if kind == b"fmt ":
                body = take(16)
                if len(body) < 16:
                    break
                channels, sr, frame = number(body, 2, 2), number(body, 4, 4), number(body, 12, 2)
            elif kind == b"ds64":
                whole = number(take(16), 8, 8)
            elif kind == b"data":
                if not sr or not channels or not frame:
                    break
                size = whole if size == UNKNOWN_SIZE and whole else size
                frames = max(0, min(size, length - at - 8)) // frame
                return Header(sr, channels, frames / sr, spent)
            # chunks are padded to an even length
            at += 8 + size + size % 2
            if at >= length:
                break
    return Header(None, None, -1.0, spent)


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, int]]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pattern = options["path"], options.get("pattern", "*.wav")
        self.size = int(options.get("partition_bytes", PARTITION_BYTES))

    def partitions(self) -> list[InputPartition]:
        store, inside, _ = opened(self.folder)
        parts: list[InputPartition] = []
        held: list[tuple[str, int]] = []
        cost = 0
        for file in files_below(store, inside):
            if not fnmatch.fnmatch(file.base_name, self.pattern):
                continue
            held.append((file.path, file.size))
            cost += OPEN_BYTES
            if cost >= self.size:
                parts.append(_Files(held))
                held, cost = [], 0
        return [*parts, _Files(held)] if held or not parts else parts

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, _, front = opened(self.folder)
        for path, length in partition.files:
            try:
                with store.open_input_file(path) as source:
                    header = read_header(source, length)
            except OSError:
                # gone or not to be opened: unreadable like a broken header
                header = Header(None, None, -1.0, 0)
            yield front + path, length, header.sr, header.channels, header.duration, header.header_bytes


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, iterator) -> WriterCommitMessage:
        store, inside, _ = opened(self.folder)
        store.create_dir(inside, recursive=True)
        for name, content in iterator:
            if os.path.basename(name) != name:
                raise ValueError(f"a file name without folders is needed, got {name}")
            # hidden until it is whole
            draft = f"{inside}/.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(content)
            store.move(draft, f"{inside}/{name}")
        return WriterCommitMessage()


class WavFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("files are added to a folder, use mode append")
        return _Writer(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WavFiles)
