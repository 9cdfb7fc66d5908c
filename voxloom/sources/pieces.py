"""A streaming source of numbered pieces, so many of them a trigger.

A stored table is cut into pieces, folders ``piece=0``, ``piece=1`` and so on. The stream's offset is the number of pieces that
have been read; a trigger admits ``per_trigger`` more and reads their files side by side, a task per file. So the order in
which a stream meets its rows is fixed by the table, whatever the files' times, and a run that starts from a checkpoint goes
on behind the last piece it has finished.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voxloom.sources.stores import files_below, opened

NAME = "voxloom_pieces"
BATCH_ROWS = 50_000


def write_pieces(df: DataFrame, path: str, piece: Column, files: int = 4) -> None:
    """The rows of each piece in at most ``files`` files of its folder."""
    dealt = df.select(piece.cast("bigint").alias("piece"), F.pmod(F.xxhash64(*df.columns), F.lit(files)).alias("_file"), *df.columns)
    dealt.repartition("piece", "_file").drop("_file").write.partitionBy("piece").parquet(path)


@dataclass
class _File(InputPartition):
    path: str


class _PieceReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.target = to_arrow_schema(schema)
        self.folder, self.per_trigger = options["path"], int(options.get("per_trigger", 1))
        self.done = 0

    def _files(self) -> dict[int, list[str]]:
        store, inside, _ = opened(self.folder)
        found: dict[int, list[str]] = {}
        for file in files_below(store, inside):
            match = re.search(r"/piece=(\d+)/[^._][^/]*$", file.path)
            if match:
                found.setdefault(int(match[1]), []).append(file.path)
        return found

    def initialOffset(self) -> dict:
        return {"piece": 0}

    def latestOffset(self) -> dict:
        known = self._files()
        last = max(known) + 1 if known else 0
        return {"piece": max(self.done, min(self.done + self.per_trigger, last))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # a restarted stream tells where it stands by a range that starts and ends there
        self.done = end["piece"]
        if start["piece"] >= end["piece"]:
            return []
        known = self._files()
        return [_File(path) for piece in range(start["piece"], end["piece"]) for path in known.get(piece, ())]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, _, _ = opened(self.folder)
        with store.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(BATCH_ROWS, columns=self.target.names):
                yield from pa.Table.from_batches([batch]).select(self.target.names).cast(self.target).to_batches()

    def commit(self, end: dict) -> None:
        pass


class Pieces(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _PieceReader(schema, dict(self.options))


def read_pieces(spark: SparkSession, schema: StructType, path: str, per_trigger: int = 1) -> DataFrame:
    """The pieces of a folder as a stream."""
    spark.dataSource.register(Pieces)
    return spark.readStream.format(NAME).schema(schema).option("per_trigger", str(per_trigger)).load(path)
