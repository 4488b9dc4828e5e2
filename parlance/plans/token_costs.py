"""Message items -> token table, its view and its totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parlance import fixed_values as V
from parlance.functions import convert, tokens as tk
from parlance.functions.literal import as_map, field
from parlance.functions.text import bind, on
from parlance.operators.items import in_epoch_range
from parlance.operators.parsing import with_fields

MONEY = "decimal(24,6)"


def item_status(first_ms: int, last_ms: int) -> Column:
    """``processed``, ``filtered`` (outside the dates) or ``error`` (unusable time)."""
    time = F.col("CreateTime")
    return (
        F.when(~in_epoch_range(time, first_ms, last_ms), "filtered")
        .when(convert.epoch_ms(time).isNull() & (convert.epoch_status(time) == "error"), "error")
        .otherwise("processed")
    )


def read_maps(items: DataFrame) -> DataFrame:
    """Add ``message_map`` (variant), ``map_members`` in place of a value too large for one, and ``parse_status``."""
    read = with_fields(items, on("MessageMap", tk.read_message_map))
    return read.withColumnsRenamed({"value": "message_map", "members": "map_members"})


def count_tokens(value: Column, members: Column | None = None) -> Column:
    """Tokens of a message map, plain or enveloped, as a whole or member by member."""
    opened = field(value, "M")
    is_root = as_map(opened).isNotNull()

    def of_members(entries: Column) -> Column:
        tagged = is_root | F.exists(entries, lambda e: tk.is_tagged_map(e["value"]))
        return F.when(tagged, tk.member_tokens(entries, enveloped=True)).otherwise(tk.member_tokens(entries))

    entries = tk.map_members(F.when(is_root, opened).otherwise(value), members)
    return bind(entries, lambda e: F.when(e.isNotNull(), of_members(e)).otherwise(tk.map_tokens(value)))


def _count_tokens_of_read(value: Column) -> Column:
    return count_tokens(value, F.col("map_members"))


def priced_items(
    items: DataFrame, first_ms: int, last_ms: int, input_rate=V.INPUT_RATE, output_rate=V.OUTPUT_RATE
) -> DataFrame:
    """The token table with ``status`` and ``parse_status``; filtered items are left out.

    A narrow pipeline: one pass, no shuffle. A broken item never fails the job;
    it keeps its keys and counts zero tokens.
    """
    rows = items.withColumn("status", item_status(first_ms, last_ms)).where(F.col("status") != "filtered")
    usable = F.col("status") == "processed"
    none = F.struct(F.lit(0).alias("input_token"), F.lit(0).alias("output_token"))
    rows = with_fields(
        read_maps(rows), F.when(usable, on("message_map", _count_tokens_of_read)).otherwise(none)
    )
    price_in = convert.token_price(F.col("input_token"), input_rate)
    price_out = convert.token_price(F.col("output_token"), output_rate)
    stored = F.coalesce(F.col("TotalPrice").try_cast("double"), F.lit(0.0))
    total = F.when(usable & (F.col("parse_status") == "missing"), stored).otherwise(
        (price_in + price_out).cast("double")
    )
    return rows.select(
        convert.epoch_label(F.col("CreateTime")).alias("create_date"),
        "input_token", "output_token",
        price_in.cast("double").alias("precio_token_input"),
        price_out.cast("double").alias("precio_token_output"),
        total.alias("total_price"),
        F.coalesce("PK", F.lit("")).alias("pk"), F.coalesce("SK", F.lit("")).alias("sk"),
        "status", "parse_status",
    )


def token_table(items: DataFrame, first_ms: int, last_ms: int, **rates) -> DataFrame:
    """The 8-column token table."""
    return priced_items(items, first_ms, last_ms, **rates).select(*V.TOKEN_COLUMNS)


def or_placeholder(tokens: DataFrame, as_of: str) -> DataFrame:
    """The table itself, or one ``sin_datos`` row when it is empty.

    The test for rows ends with the first one; give a written table, so that it
    costs a glance at a file.
    """
    rows = tokens.select(*V.TOKEN_COLUMNS)
    return rows.sparkSession.sql(
        """
        SELECT * FROM {rows}
        UNION ALL
        SELECT :as_of, 0, 0, 0D, 0D, 0D, :no_data, :no_data FROM range(1)
        WHERE NOT EXISTS (SELECT 1 FROM {rows})
        """,
        args={"as_of": as_of, "no_data": V.NO_DATA},
        rows=rows,
    )


def token_view_sql(name: str = V.TOKEN_VIEW_NAME, table: str = V.TOKEN_TABLE_NAME, temporary: bool = False) -> str:
    """Statement that creates or replaces the named view over the token table."""
    columns = ",\n               ".join(f"{value} AS `{shown}`" for value, shown in V.TOKEN_VIEW_COLUMNS.items())
    return f"""
        CREATE OR REPLACE {"TEMPORARY " if temporary else ""}VIEW {name} AS
        SELECT {columns}
        FROM {table}
        WHERE input_token > 0 OR output_token > 0
    """


def token_view(tokens: DataFrame, name: str = V.TOKEN_VIEW_NAME) -> DataFrame:
    """Register the token table and its view for this session and read the view."""
    spark = tokens.sparkSession
    tokens.createOrReplaceTempView(V.TOKEN_TABLE_NAME)
    spark.sql(token_view_sql(name, temporary=True))
    return spark.table(name)


def by_total_tokens(view: DataFrame) -> DataFrame:
    """The view from the largest total down.

    Equal totals are ordered by the other columns, which also spreads a frequent
    total over the sort's partitions; the last key does so for equal rows.
    """
    rest = [c for c in view.columns if c != "total tokens"]
    return view.orderBy(F.desc("total tokens"), *[F.asc(c) for c in rest], F.monotonically_increasing_id())


def _exact_mean(total: Column, count: Column, places: int) -> Column:
    return F.coalesce(F.round(total / F.nullif(count, F.lit(0)), places), F.lit(0)).cast("double")


def token_totals(tokens: DataFrame, input_rate=V.INPUT_RATE, output_rate=V.OUTPUT_RATE) -> DataFrame:
    """One row of totals, costs and means; all zero for an empty table.

    Money is summed as decimal, so the result does not depend on row order.
    """
    sums = tokens.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("input_token"), F.lit(0)).cast("bigint").alias("i"),
        F.coalesce(F.sum("output_token"), F.lit(0)).cast("bigint").alias("o"),
        F.coalesce(F.sum(F.col("total_price").cast(MONEY)), F.lit(0)).cast(MONEY).alias("cost"),
    )
    n, i, o, cost = (F.col(c) for c in ("n", "i", "o", "cost"))
    whole = "decimal(19,0)"
    return sums.select(
        n.alias("total_records"),
        i.alias("total_input_tokens"),
        o.alias("total_output_tokens"),
        (i + o).alias("total_tokens"),
        convert.token_price(i, input_rate).cast("double").alias("total_input_cost"),
        convert.token_price(o, output_rate).cast("double").alias("total_output_cost"),
        cost.cast("double").alias("total_cost"),
        _exact_mean(cost, n.cast(whole), 6).alias("average_cost_per_record"),
        _exact_mean(i.cast(whole), n.cast(whole), 2).alias("average_input_tokens"),
        _exact_mean(o.cast(whole), n.cast(whole), 2).alias("average_output_tokens"),
    )


def run_counters(items: DataFrame, first_ms: int, last_ms: int) -> DataFrame:
    """``processed_count, filtered_count, error_count`` of a run, from the time column alone."""
    statuses = items.select(item_status(first_ms, last_ms).alias("status"))
    return statuses.agg(*[
        F.count_if(F.col("status") == word).alias(f"{word}_count") for word in ("processed", "filtered", "error")
    ])


def daily_costs(tokens: DataFrame, model: str | None = None) -> DataFrame:
    """Count, tokens and cost per day, newest first; rows without a date group under null."""
    extra = [F.lit(model).alias("modelo")] if model is not None else []
    return (
        tokens.groupBy(convert.to_day(F.col("create_date")).alias("dia"))
        .agg(*_cost_columns())
        .select("dia", "n", "tokens", "costo", *extra)
        .orderBy(F.desc("dia"))
    )


def user_costs(tokens: DataFrame, per_day: bool = True) -> DataFrame:
    """Count, tokens and cost per key, and per day unless ``per_day`` is off."""
    keys = [F.col("pk")] + ([convert.to_day(F.col("create_date")).alias("dia")] if per_day else [])
    return tokens.groupBy(*keys).agg(*_cost_columns())


def _cost_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("input_token") + F.col("output_token")).cast("bigint").alias("tokens"),
        F.sum(F.col("total_price").cast(MONEY)).cast("double").alias("costo"),
    ]
