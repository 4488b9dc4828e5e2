"""Readers. Each takes a path or folder and an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parlance import schemas
from parlance.functions.envelope import open_scalar

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_export(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """Whole export of an item table, JSON lines or Parquet. File splits do the paging."""
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unknown export format {fmt!r}")
    return spark.read.schema(schema).format(fmt).load(path)


def read_items(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_export(spark, path, schemas.ITEMS, fmt)


def read_message_items(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_export(spark, path, schemas.MESSAGE_ITEMS, fmt)


def _enveloped(spark: SparkSession, path: str, cells: tuple[str, ...], root: str) -> DataFrame:
    # The reader gives the text of a nested value where the schema says string.
    members = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    lines = spark.read.schema(T.StructType([T.StructField(root, members)])).json(path)
    return lines.select(*[open_scalar(F.col(f"{root}.{c}")).alias(c) for c in cells])


def read_enveloped_items(spark: SparkSession, path: str, root: str = "Item") -> DataFrame:
    """Items from an export in attribute-value envelopes, one ``{root: {...}}`` per line.

    Scalar envelopes are opened; lists and maps stay as text for the operators.
    """
    return _enveloped(spark, path, tuple(schemas.ITEMS.names), root)


def read_enveloped_message_items(spark: SparkSession, path: str, root: str = "Item") -> DataFrame:
    """Message items from an export in attribute-value envelopes."""
    cells = _enveloped(spark, path, tuple(schemas.MESSAGE_ITEMS.names), root)
    return cells.withColumn("TotalPrice", F.col("TotalPrice").try_cast("double"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header, quoted line breaks and doubled quotes; every column text.

    Without a schema the names come from the header line. A file with quoted
    line breaks cannot be split, so the writers here leave many files.
    """
    reader = spark.read.options(**CSV_OPTIONS)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """User report as text."""
    return read_csv(spark, path, schemas.REPORT_TEXT)


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """Item dump as text."""
    return read_csv(spark, path, schemas.ITEMS)
