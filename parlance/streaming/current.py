"""The newest row of every user, kept by key as report files arrive.

The state is a table in buckets of users. A batch reads and rewrites only the
buckets of its own users, into a folder of its number, and then writes the list
of buckets that hold from now on: which number has the rows of which bucket.
So a batch costs what its buckets hold, not what has arrived so far; a reader
sees the list of before or the one of after; and a batch that runs again after a
failure starts from the list before it and overwrites its own folders.

Of two files with rows of one user the one that arrived later counts, by the
time of its file and then by its name, whatever order they are read in. Files
that are read again, as after a lost checkpoint, change nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from parlance import schemas
from parlance.plans.typed_report import typed_report
from parlance.streaming.refresh import ARRIVAL_COLUMN, FILE_COLUMN, report_stream

BUCKETS = 64
BUCKET, VERSION = "cubo", "version"
USER = "usuario_id"

STATE = T.StructType([
    *schemas.TYPED_REPORT,
    T.StructField(FILE_COLUMN, T.StringType()), T.StructField(ARRIVAL_COLUMN, T.TimestampType()),
    T.StructField(BUCKET, T.IntegerType()),
])
BUCKET_LIST = f"{BUCKET} int, {VERSION} long, buckets int"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(USER), F.lit(buckets)).cast("int").alias(BUCKET)


def _newest(rows: DataFrame) -> DataFrame:
    """Each user's rows of the file that arrived last. Only keys are aggregated; the texts take part in the join alone."""
    order = F.struct(ARRIVAL_COLUMN, FILE_COLUMN)
    last = rows.groupBy(F.col(USER).alias("_user")).agg(F.max(order).alias("_last"))
    return rows.join(last, F.col(USER).eqNullSafe(F.col("_user")) & (order == F.col("_last"))).select(*STATE.names)


def bucket_list(spark: SparkSession, state: str, before: int | None = None) -> dict[int, tuple[int, int]]:
    """Bucket -> its version and the number of buckets, as the last list (before a version) says; empty for a new state."""
    try:
        lists = spark.read.schema(f"{BUCKET_LIST}, batch long").parquet(f"{state}/buckets")
    except AnalysisException:  # a new state
        return {}
    if before is not None:
        lists = lists.where(F.col("batch") < before)
    last = lists.agg(F.max("batch")).first()[0]
    return {r[BUCKET]: (r[VERSION], r["buckets"]) for r in lists.where(F.col("batch") == last).collect()} if last is not None else {}


def _read(spark: SparkSession, state: str, held: dict[int, int]) -> DataFrame:
    """Rows of the given buckets in the given versions."""
    if not held:
        return spark.createDataFrame([], STATE)
    paths = [f"{state}/rows/{VERSION}={version}/{BUCKET}={bucket}" for bucket, version in sorted(held.items())]
    found = spark.read.schema(T.StructType([f for f in STATE if f.name != BUCKET])).option(
        "basePath", f"{state}/rows").parquet(*paths)
    return found.select(*STATE.names)


def read_current(spark: SparkSession, state: str) -> DataFrame:
    """The newest rows of every user, typed."""
    held = {bucket: version for bucket, (version, _) in bucket_list(spark, state).items()}
    return _read(spark, state, held).select(*schemas.TYPED_REPORT.names)


def merge_batch(state: str, first: int = 0, buckets: int = BUCKETS, then: Callable[[], None] | None = None):
    """Sink of one micro-batch: its users' buckets, with the newest rows of old and new."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, number = batch.sparkSession, first + batch_id
        held = bucket_list(spark, state, before=number)
        parts = next(iter(held.values()))[1] if held else buckets
        # Written first, so that the batch is read and typed once.
        arrived = f"{state}/arrived/{VERSION}={number}"
        typed_report(batch).withColumn(BUCKET, _bucket(parts)).write.mode("overwrite").parquet(arrived)
        new = spark.read.schema(STATE).parquet(arrived)
        touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())  # no more than there are buckets
        if touched:
            old = _read(spark, state, {b: held[b][0] for b in touched if b in held})
            merged = _newest(new.unionByName(old)).hint("rebalance", F.col(BUCKET))
            merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{state}/rows/{VERSION}={number}")
            rows = {**held, **{b: (number, parts) for b in touched}}
            listed = spark.createDataFrame([(b, v, n) for b, (v, n) in sorted(rows.items())], BUCKET_LIST)
            listed.coalesce(1).write.mode("overwrite").parquet(f"{state}/buckets/batch={number}")
        if then is not None:
            then()

    return write


def first_number(spark: SparkSession, state: str, checkpoint: str) -> int:
    """Number of a checkpoint's first batch: beyond all lists of the state when the checkpoint is new."""
    kept = f"{checkpoint.rstrip('/')}/first_number"
    try:
        return spark.read.schema("first bigint").parquet(kept).first()["first"]
    except AnalysisException:  # a new checkpoint
        pass
    try:
        last = spark.read.schema(f"{BUCKET_LIST}, batch long").parquet(f"{state}/buckets").agg(F.max("batch")).first()[0]
    except AnalysisException:  # a new state
        last = None
    first = 0 if last is None else last + 1
    spark.range(1).select(F.lit(first).cast("bigint").alias("first")).write.parquet(kept)
    return first


def refresh_current(
    spark: SparkSession, landing: str, state: str, checkpoint: str, max_files: int | None = None,
    buckets: int = BUCKETS, then: Callable[[], None] | None = None,
) -> None:
    """Merge every file that has arrived since the last call, then stop.

    ``buckets`` counts for a new state only; a state keeps the number it began with.
    """
    query = (
        report_stream(spark, landing, max_files).writeStream
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge_batch(state, first_number(spark, state, checkpoint), buckets, then))
        .start()
    )
    query.awaitTermination()
