"""Column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parlance import fixed_values as V


def enforce_columns(df: DataFrame, names=V.REPORT_COLUMNS) -> DataFrame:
    """Exactly the named columns in order; missing ones are empty text, others go."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in names])


def column_differences(df: DataFrame, names=V.REPORT_COLUMNS) -> dict[str, list[str]]:
    """Names missing from the frame, and names it has beyond the contract."""
    return {
        "missing": [c for c in names if c not in df.columns],
        "extra": [c for c in df.columns if c not in names],
    }
