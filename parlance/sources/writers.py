"""Writers. All overwrite, so running a job again gives the same output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def _shaped(df: DataFrame, single_file: bool) -> DataFrame:
    # repartition keeps the work before it parallel; coalesce would not.
    return df.repartition(1) if single_file else df


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with header. Empty text and null are both written as nothing, so both read as null."""
    (
        _shaped(df, single_file).write.mode("overwrite")
        .options(header="true", quote='"', escape='"', encoding="UTF-8", emptyValue="")
        .csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str, single_file: bool = False, partition_by: tuple[str, ...] = ()) -> str:
    writer = _shaped(df, single_file).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_verified_parquet(df: DataFrame, path: str, single_file: bool = False) -> DataFrame:
    """Write, read back, and compare.

    Returns one row per column: name, type, rows written, rows read, and whether
    both agree. The written count is observed during the write.
    """
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, single_file)
    return verify_parquet(df.sparkSession, path, seen.get["rows"], df.schema)


def verify_parquet(spark: SparkSession, path: str, rows_written: int, schema) -> DataFrame:
    """Read-back report of a written folder against the expected rows and schema."""
    back = spark.read.parquet(path)
    expected = {f.name: f.dataType.simpleString() for f in schema}
    lines = [
        F.struct(
            F.lit(i).alias("posicion"), F.lit(name).alias("columna"), F.lit(kind).alias("tipo"),
            F.lit(rows_written).cast("bigint").alias("filas_escritas"), F.col("n").alias("filas_leidas"),
            ((F.col("n") == rows_written) & F.lit(expected.get(name) == kind)).alias("coincide"),
        )
        for i, (name, kind) in enumerate(back.dtypes, 1)
    ]
    return back.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*lines)))
