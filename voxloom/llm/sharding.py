"""Contiguous shards of nearly equal bytes from global prefix sums.

The rows are range-partitioned and sorted by key, and each partition sums its sizes as it goes. This table is written
once, in the shared folder, so every later step sees the same partitions whatever executors are lost. The totals of
the partitions, one row each, are summed into the bytes and rows before every partition; a row's global byte position
is that plus its own running sum, and the shard is where the middle of the row falls among equal targets. So neither a
sort nor a running sum spans more than one partition, and a hot key is spread, because the order goes on to the size,
a hash of the text and the place in the input.

Shards are numbered by key. None differs from the target by more than the largest row. Slots count the rows of a shard.

Defined results: a null text has 0 bytes and a row of size 1 like an empty one; null keys come first; repeated rows are
rows of their own. A table without rows gives no shards; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import own_names
from voxloom.session import materialize


def _with_running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds partition number, rows before and bytes before, both inside the partition. ``_size`` is the last column."""
    from pyspark import TaskContext

    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        ends = total + np.cumsum(size, dtype=np.int64)
        columns = [
            *batch.columns,
            pa.array(np.full(len(size), part, dtype=np.int64)),
            pa.array(np.arange(rows, rows + len(size), dtype=np.int64)),
            pa.array(ends - size),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_part", "_row", "_before"])
        rows += len(size)
        total = int(ends[-1]) if len(size) else total


@own_names("key", "text")
def shard_by_bytes(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with ``size`` (UTF-8 bytes of the text plus one), ``shard`` and ``slot``."""
    if shards < 1:
        raise ValueError(f"shards must be positive, got {shards}")
    kept = [c for c in df.columns if c not in {"size", "shard", "slot"}]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    rows = df.select(*kept, F.monotonically_increasing_id().alias("_tie"), size.alias("_size"))
    order = [F.col(key).asc_nulls_first(), F.col("_size"), F.xxhash64(text), F.col("_tie")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["_part bigint, _row bigint, _before bigint"]
    )
    placed = materialize(ranged.mapInArrow(_with_running, schema), "shards")

    totals = placed.groupBy("_part").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row per partition, of which there are spark.sql.shuffle.partitions at most
    bases = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_base"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"),
        F.sum("_bytes").over(whole).alias("_total"),
    )
    middle = ((F.col("_base") + F.col("_before")) * 2 + F.col("_size")).cast("decimal(38,0)")
    shard = F.floor(middle * shards / (F.col("_total") * 2)).cast("int")
    global_row = F.col("_first") + F.col("_row")
    located = placed.join(F.broadcast(bases), "_part").select(
        *kept, F.col("_size").alias("size"), shard.alias("shard"), global_row.alias("_at")
    )
    # a shard's rows are consecutive: its slots count from its smallest global row. One row per shard is broadcast
    firsts = located.groupBy("shard").agg(F.min("_at").alias("_from"))
    return located.join(F.broadcast(firsts), "shard").select(*kept, "size", "shard", (F.col("_at") - F.col("_from")).alias("slot"))


# --- the query -------------------------------------------------------------------------------------------------------

SHARDS = 8


def query(docs: DataFrame) -> DataFrame:
    rows = shard_by_bytes(docs.select("doc_id", "text"), SHARDS)
    return rows.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
