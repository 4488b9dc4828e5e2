"""Tables written to the shared folder, so that later steps do not repeat the work before them."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from parlance.session import new_folder


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = "1000"


def text_batches(spark: SparkSession) -> None:
    """Rows with whole texts go to Python in smaller batches than usual, unless the session says otherwise.

    A batch is held several times, in the executor and in its Python worker, so
    ten thousand texts of a usual length would take hundreds of megabytes.
    """
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, TEXT_ROWS)


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder that all executors share and read it back.

    Unlike a cached table it survives lost executors, and it cuts the lineage.
    """
    folder = new_folder(spark, label)
    text_batches(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Ask the driver to collect garbage, so that Spark removes the shuffle files of finished steps.

    Spark removes the files of a shuffle when the driver has collected the last
    reference to it, which a job of many steps would otherwise wait for.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as keep it apart from the columns, in any case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def one_row(df: DataFrame) -> tuple:
    """The single row of an aggregate without keys."""
    return tuple(df.collect()[0])
