"""Catalog tables over written Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted_name(name: str) -> str:
    """A table name, with or without its database, as SQL identifiers."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def quoted_text(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Table over a Parquet folder, with the schema of its files.

    An existing table with the same columns, or with the first of them, is pointed
    at the files as they are now, after the new columns were added at its end: there
    is no moment without a table, and until the files change a new column is null.
    Only where columns are gone or have another type is the table created anew,
    which the catalog cannot do in place; :func:`register_view` can. Only external
    tables are touched: dropping a managed one would delete its data. A temporary
    view of the same name would hide the table, so it goes.
    """
    table, place = quoted_name(name), quoted_text(path)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
        spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is not an external table; its data would be lost")
        old, new = spark.table(name).dtypes, spark.read.parquet(path).dtypes
        if old == new[:len(old)]:
            if added := new[len(old):]:
                columns = ", ".join(f"{quoted_name(column)} {kind}" for column, kind in added)
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
            spark.sql(f"ALTER TABLE {table} SET LOCATION {place}")
        else:
            spark.sql(f"DROP TABLE {table}")  # external: the files stay
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {table} USING PARQUET LOCATION {place}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def register_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """View over a partitioned Parquet folder, replaced in place, that shows every folder there is when it is read."""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted_name(name)} AS SELECT * FROM parquet.`{path.replace('`', '``')}`")
    return spark.table(name)


def column_listing(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``table_name, column_name, data_type, is_nullable, ordinal_position`` of a database."""
    rows = [
        (table.name, column.name, column.dataType, column.nullable, position)
        for table in spark.catalog.listTables(database)
        for position, column in enumerate(
            spark.catalog.listColumns(table.name if table.isTemporary else f"{table.namespace[-1]}.{table.name}"), 1
        )
    ]
    schema = "table_name string, column_name string, data_type string, is_nullable boolean, ordinal_position int"
    return spark.createDataFrame(rows, schema).orderBy("table_name", "ordinal_position")
