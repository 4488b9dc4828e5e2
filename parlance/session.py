"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any scale. Partition counts and memory belong to the
# cluster; AQE sizes the shuffles from what it measures.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the caller of every expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "parlance", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the library's settings; keyword settings use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local session without that setting uses its warehouse folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_parlance"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 512 * 1024 * 1024) -> int:
    """Set the number of shuffle partitions for an input of a known size.

    Adaptive execution merges partitions that turn out small but does not split
    large ones, so the number has to follow the data: 100 TB in partitions of
    512 MB make about 190,000. Never fewer than the cluster has cores.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def input_bytes(df: DataFrame) -> int:
    """Size of the files that a plan reads, as Spark knows it; tables of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < 1 << 60)


@contextmanager
def sized_for(df: DataFrame) -> Iterator[None]:
    """Shuffle partitions that fit the input of ``df``, for the jobs inside the block."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size = input_bytes(df)
    if size:
        size_shuffles(spark, size)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def spread(df: DataFrame, partition_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """All rows of a stored table, dealt evenly to tasks.

    A row group is read by one task, and one holds millions of narrow rows. Where
    each row takes far longer than reading it, that task would do all the work.
    """
    wanted = max(3 * df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // partition_bytes))
    return df.repartition(wanted)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
