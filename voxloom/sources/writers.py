"""Sinks: parquet shards of exact sizes, JSON lines, side tables, previews. Every sink writes a folder of part files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.constants import SEED
from voxloom.functions.text import is_undetected, strip_undetected_tag
from voxloom.operators.sampling import with_shuffled_shard


def write_parquet_shards(
    df: DataFrame, path: str, key: str, shards: int, seed: int = SEED, max_rows: int = 1_000_000
) -> None:
    """Folders ``shard=n``, filled by the seeded shuffle. The rows are moved once, straight to the task of their shard.

    A shard is written by one task; ``max_rows`` cuts it into several files.
    """
    placed = with_shuffled_shard(df, key, shards, seed).repartitionById(shards, F.col("shard"))
    placed.write.option("maxRecordsPerFile", str(max_rows)).partitionBy("shard").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """UTF-8 JSON lines with nulls written out; an empty table still makes the folder."""
    df.write.option("ignoreNullFields", "false").json(path)


def write_rejected(df: DataFrame, path: str, measure: str, order: str) -> None:
    """Rejected rows, largest measure first, ties in input order. The sort is a range partition, not one task."""
    write_jsonl(df.orderBy(F.desc(measure), F.asc(order)), path)


def undetected_rows(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(is_undetected(F.col(text))).withColumn(text, strip_undetected_tag(F.col(text)))


def write_undetected(df: DataFrame, path: str, text: str = "text") -> None:
    write_jsonl(undetected_rows(df, text), path)


def preview_rows(df: DataFrame, order: str, rows: int, chars: int, columns: list[str | Column]) -> DataFrame:
    """The first rows as JSON text cut to ``chars`` characters."""
    return df.orderBy(order).limit(rows).select(order, F.substring(F.to_json(F.struct(*columns)), 1, chars).alias("line"))


def export_splits(
    df: DataFrame, path: str, split: str = "split", names: tuple[str, ...] = ("train", "eval"), file_rows: int = 100_000
) -> None:
    """JSON lines in one folder per split (``split=train``, ``split=eval``), all written in a single pass over the rows.

    Every split gets as many files as it has ``file_rows`` rows, each written by a task of its own, so neither is a small split
    scattered over tiny files nor a large one the work of one task. The rows per split are counted first; the counts
    read nothing but the split. A split without rows gets an empty folder.
    """
    sizes = df.groupBy(split).agg(F.ceil(F.count(F.lit(1)) / file_rows).alias("_files"))
    # one row per split; which file a row goes to follows from its content
    dealt = df.withColumn("_hash", F.xxhash64(*df.columns)).withColumnRenamed(split, "_split").join(
        F.broadcast(sizes), F.col("_split").eqNullSafe(F.col(split))
    )
    df = dealt.withColumn("_file", F.pmod("_hash", "_files")).drop("_hash", "_files", "_split").select(*df.columns, "_file")
    df = df.repartition(split, "_file").drop("_file")
    df.write.option("ignoreNullFields", "false").partitionBy(split).json(path)
    spark, schema = df.sparkSession, df.drop(split).schema
    for name in names:
        folder = f"{path}/{split}={name}"
        try:
            spark.read.schema(schema).json(folder)
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            write_jsonl(spark.createDataFrame([], schema), folder)
