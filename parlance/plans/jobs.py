"""Batch jobs from stored input to stored output.

Each job overwrites its output and takes the date it stands for as an argument,
so running it again gives the same result. Shuffles get as many partitions as
the input asks for, and statistics are observed while the output is written.
"""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from parlance import fixed_values as V, schemas
from parlance.operators import reports as rp
from parlance.operators.reports import RUN_COUNTS, run_counts
from parlance.plans.token_costs import (
    or_placeholder, priced_items, token_totals, token_view_sql,
)
from parlance.plans.typed_report import null_profile, typed_report
from parlance.plans.user_report import user_report
from parlance.session import sized_for
from parlance.sources.catalog import register_table
from parlance.sources.readers import read_report_csv
from parlance.sources.writers import write_csv, write_parquet, write_verified_parquet


def report_job(items: DataFrame, csv_path: str, as_of: str, **options) -> DataFrame:
    """Items -> user report as CSV. Returns the run statistics."""
    spark, seen = items.sparkSession, Observation()
    report = user_report(items, as_of=as_of, **options)
    with sized_for(items):
        write_csv(report.observe(seen, *run_counts()), csv_path)
    found = seen.get
    return spark.range(1).select(*(F.lit(found[name]).cast("bigint").alias(name) for name in RUN_COUNTS))


def typed_job(spark: SparkSession, csv_path: str, parquet_path: str, table: str | None = None) -> DataFrame:
    """Report CSV -> typed Parquet, registered as a table. Returns the read-back check."""
    text = read_report_csv(spark, csv_path)
    with sized_for(text):
        check = write_verified_parquet(typed_report(text), parquet_path)
    if table is not None:
        register_table(spark, table, parquet_path)
    return check


def statistics_job(spark: SparkSession, parquet_path: str, folder: str) -> dict[str, DataFrame]:
    """Stored typed report -> all its statistics as Parquet, by name.

    The counts over all users take one pass over the columns they need. The
    distributions and samples take one narrow pass each. Nothing is computed
    from the items again.
    """
    report = spark.read.schema(schemas.TYPED_REPORT).parquet(parquet_path)
    write_parquet(rp.summary(report), f"{folder}/summary")
    tables = rp.summary_tables(spark.read.parquet(f"{folder}/summary"))
    grouped = {
        "feedback_histogram": rp.feedback_histogram(report),
        "duplicate_check": rp.duplicate_check(report),
        "answer_vocabulary": rp.answer_vocabulary(report),
        "top_answers": rp.top_answers(report),
        "null_profile": null_profile(report),
        "first_examples": rp.first_rows(report.select("usuario_id", "pregunta_conversacion"), 5),
        "examples_per_class": rp.rows_per_class(
            report.where("feedback is not null").select("usuario_id", "feedback", "respuesta_feedback"), "feedback", 3),
    }
    with sized_for(report):
        for name, table in grouped.items():
            write_parquet(table, f"{folder}/{name}")
    return tables | {name: spark.read.parquet(f"{folder}/{name}") for name in grouped}


def day_range_ms(start: str, as_of: str) -> tuple[int, int]:
    """First and last millisecond of the days from ``start`` to ``as_of``, in UTC."""

    def midnight(day: str, plus: int) -> int:
        moment = datetime.combine(date.fromisoformat(day) + timedelta(days=plus), datetime.min.time(), UTC)
        return int(moment.timestamp() * 1000)

    return midnight(start, 0), midnight(as_of, 1) - 1


def token_job(
    items: DataFrame, folder: str, as_of: str, start: str = V.REPORT_START,
    table: str = V.TOKEN_TABLE_NAME, view: str = V.TOKEN_VIEW_NAME, **rates,
) -> DataFrame:
    """Message items -> token table as Parquet and CSV, with its table and view.

    Returns the totals with the counts of processed and failed items. The counts
    are observed while the table is written.
    """
    spark = items.sparkSession
    seen = Observation()
    priced = priced_items(items, *day_range_ms(start, as_of), **rates).observe(
        seen,
        F.count_if(F.col("status") == "processed").alias("processed_count"),
        F.count_if(F.col("status") == "error").alias("error_count"),
    )
    with sized_for(items):
        write_parquet(priced.select(*V.TOKEN_COLUMNS), f"{folder}/table")
    stored = spark.read.schema(schemas.TOKEN_TABLE).parquet(f"{folder}/table")
    write_csv(or_placeholder(stored, f"{as_of} 00:00:00"), f"{folder}/csv")
    register_table(spark, table, f"{folder}/table")
    spark.sql(token_view_sql(view, table))
    counts = {name: F.lit(n).cast("bigint") for name, n in seen.get.items()}
    return token_totals(stored).withColumns(counts)
