"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package wants. AQE sizes the shuffles, splits skewed join partitions and picks broadcast
#: joins from measured sizes, so no operator hints a broadcast of data that grows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

#: Rows and bytes of a batch on its way to a Python worker, where the session leaves them unset. Whole texts travel, and a
#: batch stands in the JVM and in the worker several times over. No result depends on them.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4MB"}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("voxloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Where that is unset and the master is local (tests, the bench), a fresh folder is made, which goes when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="voxloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


_written: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete what ``scratch_path`` has handed out so far; call it when the results that read it have been consumed."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _written:
        path = files.Path(_written.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def written() -> int:
    """How many paths ``scratch_path`` has handed out that are not released; a mark for ``release_since``."""
    return len(_written)


def release_since(spark: SparkSession, mark: int, keep: DataFrame | None = None) -> int:
    """Delete what was handed out after a mark, but for the table that ``keep`` reads. Only for tables that nothing reads any
    more: a result that has been written, and not one that is still to be computed from them."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kept = [] if keep is None else keep.inputFiles()
    gone = 0
    for path in _written[mark:]:
        if not any(f"{path.split(':', 1)[-1]}/" in file for file in kept):
            place = files.Path(path)
            gone += bool(place.getFileSystem(conf).delete(place, True))
            _written.remove(path)
    collect_driver(spark)
    return gone


def collect_driver(spark: SparkSession) -> bool:
    """Let the driver drop what finished jobs have left there (broadcasts, plans, the files of their shuffles), where its heap
    takes more than half of what it may; a heap that is not collected only grows."""
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if 2 * heap.totalMemory() <= heap.maxMemory():
        return False
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()
    return True


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a written table in the shared folder. It survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Batches of ``BATCHES`` for this session's Python workers, but for what it has set itself."""
    for name, size in BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, size)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once per application.

    Executors get it as a file of the job. The Python process that sets up stream state runs next to the driver and
    gets no job files, so it finds the package by the folder the driver has it from.
    """
    context = spark.sparkContext
    name = f"voxloom-{context.applicationId}.zip"
    if any(path.endswith(name) for path in context.listFiles):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="voxloom-ship-")) / name
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    paths = [str(root.parent), context.environment.get("PYTHONPATH")]
    context.environment["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)
