"""Adding parsed fields as columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_fields(df: DataFrame, parsed: Column) -> DataFrame:
    """Add the fields of a struct expression as columns.

    The generator keeps the expression in one place: a filter on one of the
    fields is not pushed below it, which would parse the cell a second time.
    """
    return df.select("*", F.inline(F.array(parsed)))
