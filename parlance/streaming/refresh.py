"""Refresh the typed report as report files arrive.

Every micro-batch becomes a folder of the target, named by its number. Numbers
go on from the largest one that the target has when a checkpoint is new, and
the checkpoint keeps the number it began with. So a batch that runs again after
a failure overwrites its own folder, and a new or lost checkpoint never
overwrites what an earlier one wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parlance import schemas
from parlance.plans.typed_report import typed_report
from parlance.sources.catalog import register_view
from parlance.sources.readers import CSV_OPTIONS

BATCH_COLUMN = "lote"
FILE_COLUMN = "archivo"
ARRIVAL_COLUMN = "llegada"


def report_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Stream of report rows from the CSV files that land in a folder, with the file they came in and its time."""
    reader = spark.readStream.schema(schemas.REPORT_TEXT).options(**CSV_OPTIONS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(landing).select(
        "*", F.col("_metadata.file_path").alias(FILE_COLUMN),
        F.col("_metadata.file_modification_time").alias(ARRIVAL_COLUMN))


def write_batch(target: str, first: int = 0, then: Callable[[], None] | None = None) -> Callable[[DataFrame, int], None]:
    """Sink of one micro-batch: its rows, typed, under a folder named by ``first`` plus the batch number.

    A batch that runs again overwrites its own folder, so a restart never
    doubles rows. ``then`` runs after each batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        typed_report(batch).write.mode("overwrite").parquet(f"{target}/{BATCH_COLUMN}={first + batch_id}")
        if then is not None:
            then()

    return write


def first_batch(spark: SparkSession, target: str, checkpoint: str) -> int:
    """Number of a checkpoint's first batch: beyond all of the target's when the checkpoint is new."""
    kept = f"{checkpoint.rstrip('/')}/first_batch"
    try:
        return spark.read.schema("first bigint").parquet(kept).first()["first"]
    except AnalysisException:  # a new checkpoint
        pass
    try:
        last = read_refreshed(spark, target).agg(F.max(BATCH_COLUMN)).first()[0]
    except AnalysisException:  # a new target
        last = None
    first = 0 if last is None else last + 1
    spark.range(1).select(F.lit(first).cast("bigint").alias("first")).write.parquet(kept)
    return first


def refresh(
    spark: SparkSession, landing: str, target: str, checkpoint: str,
    max_files: int | None = None, then: Callable[[], None] | None = None, view: str | None = None,
) -> None:
    """Process every file that has arrived since the last call, then stop.

    ``view`` names a view over the target that is replaced after each batch.
    """

    def after() -> None:
        if view is not None:
            register_view(spark, view, target)
        if then is not None:
            then()

    query = (
        report_stream(spark, landing, max_files).writeStream
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch(target, first_batch(spark, target, checkpoint), after))
        .start()
    )
    query.awaitTermination()


def read_refreshed(spark: SparkSession, target: str) -> DataFrame:
    """All typed rows refreshed so far, with the file, its arrival, and the batch that brought them."""
    extra = [
        T.StructField(FILE_COLUMN, T.StringType()), T.StructField(ARRIVAL_COLUMN, T.TimestampType()),
        T.StructField(BATCH_COLUMN, T.LongType()),
    ]
    return spark.read.schema(T.StructType([*schemas.TYPED_REPORT, *extra])).parquet(target)


def latest_per_user(refreshed: DataFrame) -> DataFrame:
    """Each user's rows of the file that arrived last, when files replace earlier ones.

    Files of one time go by batch and name; so do rows of before arrivals were
    kept. Only keys are aggregated; the texts take part in the join alone. This
    reads all that was refreshed; :mod:`parlance.streaming.current` keeps the newest
    rows by key instead.
    """
    order = F.struct(*[c for c in (ARRIVAL_COLUMN, BATCH_COLUMN, FILE_COLUMN) if c in refreshed.columns])
    newest = refreshed.groupBy(F.col("usuario_id").alias("_user")).agg(F.max(order).alias("_newest"))
    joined = refreshed.join(newest, F.col("usuario_id").eqNullSafe(F.col("_user")) & order.eqNullSafe(F.col("_newest")))
    return joined.select(*[c for c in refreshed.columns if c not in (ARRIVAL_COLUMN, BATCH_COLUMN, FILE_COLUMN)])
