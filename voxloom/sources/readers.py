"""Readers: parquet shards, dataset splits, JSON lines, outputs of several machines."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RAW_SAMPLE = "messages array<struct<content:string,role:string>>, audios array<string>"
TRAINING_SAMPLE = "audio string, text string, prompt string"

_GLOB = re.compile(r"[\\*?\[\]{}]")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _found(spark: SparkSession, pattern: str) -> tuple[list[str], list[str]]:
    """Names that fit a path pattern, without hidden ones: of files, and of folders and mounts, which are listed as links."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files, others = [], []
    for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or ():
        (others if f.isDirectory() or f.isSymlink() else files).append(f.getPath().getName())
    return tuple([n for n in names if not n.startswith(("_", "."))] for names in (files, others))


def scan_parquet_shards(spark: SparkSession, folder: str, pattern: str = "*.parquet", with_file: bool = False):
    """All shards of a folder as one table: files of a fitting name, and folders of such a name with all files in them. Spark
    lists, splits and prunes the files itself."""
    files, others = _found(spark, f"{folder}/{pattern}")
    others = [n for n in others if "=" not in n]
    if others or (files == [pattern] and not any("=" in n for n in _found(spark, f"{folder}/*=*")[1])):
        # by name: a pattern takes a mounted folder for a file, and a folder read as a whole lists the tables beside its shards
        df = spark.read.parquet(*[f"{folder}/{_GLOB.sub(r'\\\g<0>', n)}" for n in files + others])
    else:
        df = spark.read.option("pathGlobFilter", pattern).parquet(folder)
    return df.withColumn("shard_file", F.col("_metadata.file_name")) if with_file else df


def scan_dataset_split(spark: SparkSession, folder: str, split: str, column: str = "split") -> DataFrame:
    """One split of a folder partitioned by split; the filter prunes the other folders before any file is opened."""
    return spark.read.parquet(folder).where(F.col(column) == split)


def scan_jsonl(spark: SparkSession, files: Mapping[str, str], schema: StructType | str = TRAINING_SAMPLE) -> DataFrame:
    """JSON lines of one or more splits with an explicit schema, so no pass over the data infers one."""
    parts = [spark.read.schema(schema).json(path).withColumn("split", F.lit(split)) for split, path in files.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def scan_merge_machines(spark: SparkSession, folder: str, with_file: bool = True) -> DataFrame:
    """``machine_*/*.parquet``; where there is none, ``*.parquet`` of the folder itself; where there is none, an error."""
    for pattern in (f"{folder}/machine_*/*.parquet", f"{folder}/*.parquet"):
        try:
            df = spark.read.parquet(pattern)
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            continue
        return df.withColumn("file", F.col("_metadata.file_path")) if with_file else df
    raise FileNotFoundError(f"no parquet files under {folder}")


def union_machine_outputs(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
