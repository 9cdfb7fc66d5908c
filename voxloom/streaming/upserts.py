"""A table that keeps the latest row of each key of a stream in Update mode.

Every batch is written as a folder named by its number (``batch=7``), only its latest row per key, and replaces what an
earlier attempt of that batch has left: a batch that is replayed after a failure changes nothing. Readers take the
newest row per key over the folders. So that they stay few, every ``compact_every`` batches the table so far is written as one
folder (``base=7``) with the number of the last batch in it; it counts once it is whole, and readers then pass the older
folders by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from voxloom.streaming.sessions import run_writer

BATCH = "_batch"


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order``; combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return last.select(*keys, "_row.*").select(*rows.columns)


class LatestTable:
    """The latest row per key, by ``order`` within a batch and by batch number between batches."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], compact_every: int = 20
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.compact_every = list(keys), list(order), compact_every

    def _folders(self, kind: str) -> list[int]:
        """Numbers of the whole folders of a kind; a folder is whole when its job has marked it."""
        files = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        pattern = files.Path(f"{self.path}/{kind}=*/_SUCCESS")
        store = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = store.globStatus(pattern) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _parts(self, upto: int | None = None) -> DataFrame:
        """The newest base and the batches after it, each row with the number of its batch."""
        bases = [n for n in self._folders("base") if upto is None or n <= upto]
        last = bases[-1] if bases else -1
        with_batch = StructType([*self.schema.fields]).add(BATCH, LongType())
        rows = self.spark.createDataFrame([], with_batch)
        if bases:
            rows = rows.unionByName(self.spark.read.schema(with_batch).parquet(f"{self.path}/base={last}"))
        later = [n for n in self._folders("batch") if n > last and (upto is None or n <= upto)]
        if later:
            read = self.spark.read.schema(with_batch).parquet(*[f"{self.path}/batch={n}" for n in later])
            rows = rows.unionByName(read)
        return rows

    def merge(self, batch: DataFrame, number: int) -> None:
        """Takes in a batch; the same batch again leaves the table as it is."""
        rows = newest(batch.select(*self.schema.names), self.keys, self.order).withColumn(BATCH, F.lit(number).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        if (number + 1) % self.compact_every == 0:
            self._newest(self._parts(number)).write.mode("overwrite").parquet(f"{self.path}/base={number}")

    def _newest(self, rows: DataFrame) -> DataFrame:
        return newest(rows, self.keys, [BATCH, *self.order])

    def read(self) -> DataFrame:
        return self._newest(self._parts()).drop(BATCH)


def run_upserts(
    stream: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, compact_every: int = 20, paced: bool = False
) -> DataFrame:
    """Run a stream in Update mode into a ``LatestTable`` over what is there now, and read the table."""
    table = LatestTable(stream.sparkSession, path, stream.schema, keys, order, compact_every)
    run_writer(stream, lambda w: w.outputMode("update").foreachBatch(table.merge), checkpoint, paced=paced)
    return table.read()
