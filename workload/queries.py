"""Registered queries. Each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parlance import fixed_values as V, schemas
from parlance.functions import convert, feedback as fb, literal as lt, text as tx, tokens as tk, transcript as tr
from parlance.functions.envelope import unwrap, unwrap_any
from parlance.functions.literal import read_json
from parlance.functions.profile import parse_profile
from parlance.functions.questions import implied_question, user_questions
from parlance.operators import items as it, reports as rp
from parlance.operators.contract import enforce_columns
from parlance.operators.feedback_join import join_last_feedback
from parlance.operators.rollup import ORDER, first_real, ordered_concat
from parlance.plans import message_report as mr, raw_report as raw, token_costs as tc, typed_report as ty, user_report as ur
from parlance.session import new_folder, spread
from parlance.sources import catalog, readers, writers
from parlance.streaming import current, refresh
from workload import adapters as ad

AS_OF = "2025-09-10"
FIRST_MS = int(datetime(2025, 8, 4, tzinfo=UTC).timestamp() * 1000)
LAST_MS = int(datetime(2025, 9, 11, tzinfo=UTC).timestamp() * 1000) - 1
EVENT_FIRST_MS = int(datetime(2024, 1, 10, tzinfo=UTC).timestamp() * 1000)
EVENT_LAST_MS = int(datetime(2024, 1, 21, tzinfo=UTC).timestamp() * 1000) - 1
MODEL = "modelo"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def _talks(spark, sf):
    return ad.items(spark, sf).where(it.is_conversation())


def _report_rows(spark, sf):
    items = it.drop_register(ad.items(spark, sf))
    return items.where(it.is_conversation() | ~it.is_feedback())


def _feedback_items(spark, sf):
    return it.unwrap_items(ad.items(spark, sf).where(it.is_feedback()), ("Feedback",))


def _report(spark, sf):
    return ur.user_report(ad.items(spark, sf), as_of=AS_OF)


def _transcripts(spark, sf):
    return ad.transcripts(spark, sf)


def _documents(spark, sf):
    return ad.table(spark, sf, "documents")


def _tokens(spark, sf):
    return tc.token_table(ad.message_items(spark, sf), FIRST_MS, LAST_MS)


# --- text ---------------------------------------------------------------------

@query
def transcript(spark, sf):
    return _talks(spark, sf).select("SK", tr.transcript(F.col("Conversation")).alias("conversacion_completa"))


@query
def conversation_messages(spark, sf):
    return mr.conversation_messages(ad.items(spark, sf))


@query
def message_report(spark, sf):
    return mr.message_report(ad.items(spark, sf))


@query
def turn_count(spark, sf):
    return _talks(spark, sf).select("SK", tx.turn_count(tr.transcript(F.col("Conversation"))).alias("turnos"))


@query
def text_normalize(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.normalize_text(F.col("text")).alias("texto"))


@query
def char4_tokens(spark, sf):
    return _documents(spark, sf).select("doc_id", tk.chars4_tokens(F.col("text")).alias("tokens"))


@query
def heuristic_tokens(spark, sf):
    return _documents(spark, sf).select("doc_id", tk.estimated_tokens(F.col("text")).alias("tokens"))


@query
def preview(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.preview(F.col("text"), 200).alias("vista"))


@query
def multi_value_flag(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.has_many(F.col("text")).alias("multiple"))


@query
def blank_values(spark, sf):
    profile = parse_profile(F.col("UserData"))
    return _report_rows(spark, sf).select("PK", "SK", tx.is_blank(profile["nombre"]).alias("sin_nombre"),
                                          tx.is_blank_exact(profile["ciudad"]).alias("sin_ciudad"))


# --- items --------------------------------------------------------------------

@query
def drop_register(spark, sf):
    return it.drop_register(ad.items(spark, sf)).select("PK", "SK")


@query
def row_kinds(spark, sf):
    return it.with_row_kinds(ad.items(spark, sf)).select("PK", "SK", "is_conversation", "is_feedback", "is_other")


@query
def user_ids(spark, sf):
    return it.rename_report_columns(it.with_user_id(ad.items(spark, sf))).select(
        "usuario_id", "SK", "fecha_primera_conversacion"
    )


@query
def feedback_last_wins(spark, sf):
    return join_last_feedback(it.drop_register(ad.items(spark, sf))).select("PK", "SK", "Feedback")


@query
def profile_parse(spark, sf):
    return _report_rows(spark, sf).select("PK", "SK", parse_profile(F.col("UserData")).alias("p")).select("PK", "SK", "p.*")


@query
def profile_parse_raw(spark, sf):
    return _report_rows(spark, sf).select(
        "PK", "SK", parse_profile(F.col("UserData"), clean=False).alias("p")
    ).select("PK", "SK", "p.*")


@query
def city_exclusion(spark, sf):
    rows = ur.profile_and_dates(_report_rows(spark, sf))
    return it.exclude_places(rows).select("PK", "SK", "gerencia")


@query
def default_fill(spark, sf):
    rows = ur.profile_and_dates(_report_rows(spark, sf))
    return rows.select(
        "PK", "SK", tx.fill_blank(F.col("nombre"), V.ANONYMOUS_NAME).alias("nombre"),
        tx.fill_blank(F.col("gerencia"), V.DEFAULT_AREA, words=()).alias("gerencia"),
    )


@query
def permissive_dates(spark, sf):
    rows = _report_rows(spark, sf).withColumn("dia", convert.to_day(F.col("CreatedAt")))
    return rows.where(it.in_day_range(F.col("dia"), V.REPORT_START, AS_OF)).select("PK", "SK", "dia")


@query
def date_label(spark, sf):
    return _report_rows(spark, sf).select("PK", "SK", convert.date_label(convert.to_day(F.col("CreatedAt"))).alias("fecha"))


@query
def envelope_unwrap(spark, sf):
    return it.unwrap_items(ad.items(spark, sf)).where(it.is_feedback()).select("PK", "SK", "Feedback")


@query
def list_collapse(spark, sf):
    return it.unwrap_items(ad.items(spark, sf), list_mode="first").where(it.is_feedback()).select("PK", "SK", "Feedback")


# --- questions and feedback -----------------------------------------------------

@query
def user_questions_of_transcripts(spark, sf):
    talks = _talks(spark, sf).select("SK", tr.transcript(F.col("Conversation")).alias("t"))
    return talks.select("SK", user_questions(F.col("t")).alias("pregunta_conversacion"))


@query
def questions_of_documents(spark, sf):
    text = F.concat(F.lit("user: "), F.translate(F.col("text"), "|", "/"))
    return _documents(spark, sf).select("doc_id", user_questions(text).alias("pregunta"))


@query
def implied_questions(spark, sf):
    return _documents(spark, sf).select("doc_id", implied_question(F.col("text")).alias("pregunta"))


@query
def implied_questions_by_rule(spark, sf):
    return ad.ruled_texts(spark, sf).select("doc_id", implied_question(F.col("text")).alias("pregunta"))


@query
def questions_of_all_forms(spark, sf):
    return ad.dialogue_texts(spark, sf).select("doc_id", user_questions(F.col("text")).alias("pregunta"))


@query
def json_questions(spark, sf):
    turns = ad.grouped_turns(ad.table(spark, sf, "conversations"))
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("from"), t["text"].alias("text")))
    return turns.select("conv_id", tr.json_questions(F.to_json(messages)).alias("pregunta"))


@query
def role_text(spark, sf):
    turns = ad.grouped_turns(ad.table(spark, sf, "conversations"))
    text = ad.literal_conversation(F.col("conv_id"), F.col("turns"), exact=True)
    turns = turns.select("conv_id", text.alias("literal"))
    return turns.select(
        "conv_id",
        tr.role_text(F.col("literal"), "user").alias("texto_user"),
        tr.role_text(F.col("literal"), "bot").alias("texto_bot"),
    )


@query
def feedback_count(spark, sf):
    return _feedback_items(spark, sf).select("PK", "SK", fb.feedback_count(F.col("Feedback")).alias("n"))


@query
def feedback_class(spark, sf):
    return _feedback_items(spark, sf).select("PK", "SK", fb.feedback_class(F.col("Feedback")).alias("feedback"))


@query
def feedback_answers(spark, sf):
    answers = fb.feedback_answers(F.col("Feedback"))
    return _feedback_items(spark, sf).select("PK", "SK", answers.alias("respuestas"), tx.distinct_pieces(answers).alias("distintas"))


@query
def feedback_flatten(spark, sf):
    flat = _feedback_items(spark, sf).select("PK", "SK", fb.flatten_feedback(F.col("Feedback")).alias("f"))
    return flat.select(
        "PK", "SK", "f.feedback_total", "f.tipo", "f.comentario",
        F.try_element_at("f.campos", F.lit("comment")).alias("comment"),
        F.try_element_at("f.campos", F.lit("type")).alias("type"),
    )


# --- rollup and report ------------------------------------------------------------

@query
def conversation_report(spark, sf):
    rows = ur.conversation_report(ad.items(spark, sf), as_of=AS_OF)
    return rows.select("SK", *V.REPORT_COLUMNS)


@query
def user_report(spark, sf):
    return _report(spark, sf)


@query
def user_report_by_rollup(spark, sf):
    rows = ur.conversation_report(ad.items(spark, sf), as_of=AS_OF)
    return ur.rollup_conversations(rows)


@query
def raw_user_report(spark, sf):
    items = it.unwrap_items(ad.items(spark, sf, form=ad.PLAIN), ("Feedback",))
    return raw.raw_user_report(items)


@query
def first_real_value(spark, sf):
    rows = ur.profile_and_dates(_report_rows(spark, sf)).withColumn("is_other", ~it.is_conversation())
    order = F.struct(*ORDER)
    return rows.groupBy(it.user_id(F.col("PK")).alias("usuario_id")).agg(
        first_real(F.col("nombre"), order, V.ANONYMOUS_NAME).alias("nombre"),
        first_real(F.col("gerencia"), order, V.UNSPECIFIED_AREA, also_default=True).alias("gerencia"),
    )


@query
def user_report_in_blocks(spark, sf):
    """Blocks of 500 bytes, so that most users have several."""
    return ur.user_report_in_blocks(ad.items(spark, sf), limits={"as_of": AS_OF}, block_bytes=500)


@query
def ordered_concatenation(spark, sf):
    rows = _talks(spark, sf).select(
        it.user_id(F.col("PK")).alias("usuario_id"), "SK", tr.transcript(F.col("Conversation")).alias("texto"),
    )
    return ordered_concat(rows, "usuario_id", "texto", ["SK"], V.CONVERSATION_SEPARATOR)


@query
def report_contract(spark, sf):
    customers = ad.table(spark, sf, "customer")
    return enforce_columns(customers.select(F.col("c_custkey").cast("string").alias("usuario_id"),
                                            F.col("c_name").alias("nombre"), "c_acctbal"))


@query
def run_stats(spark, sf):
    return rp.run_stats(_report(spark, sf))


# --- files and catalog --------------------------------------------------------------

@query
def export_round_trip(spark, sf):
    path = writers.write_json(ad.items(spark, sf), new_folder(spark, "items"))
    return readers.read_items(spark, path).select(
        "PK", "SK", "CreatedAt", "Feedback", tr.transcript(F.col("Conversation")).alias("conversacion"),
        parse_profile(F.col("UserData")).alias("p"),
    ).select("PK", "SK", "CreatedAt", "Feedback", "conversacion", "p.*")


@query
def enveloped_export(spark, sf):
    items = ad.items(spark, sf, form=ad.ENVELOPE)

    def tagged(name):
        return F.when(F.col(name).isNotNull(), F.struct(F.col(name).alias("S"))).alias(name)

    cells = [tagged("PK"), tagged("SK"), tagged("CreatedAt"), F.parse_json("Conversation").alias("Conversation")]
    path = writers.write_json(items.select(F.struct(*cells).alias("Item")), new_folder(spark, "enveloped"))
    back = readers.read_enveloped_items(spark, path)
    return back.select("PK", "SK", "CreatedAt", tr.transcript(F.col("Conversation")).alias("conversacion_completa"))


@query
def message_export_round_trip(spark, sf):
    path = writers.write_json(ad.message_items(spark, sf), new_folder(spark, "messages"))
    back = tc.read_maps(readers.read_message_items(spark, path))
    return back.select(
        "PK", "SK", "CreateTime", "TotalPrice", tc.count_tokens(F.col("message_map"), F.col("map_members")).alias("t"),
    ).select("PK", "SK", "CreateTime", "TotalPrice", "t.*")


@query
def items_csv_round_trip(spark, sf):
    items = ad.items(spark, sf, form=ad.PLAIN)
    path = writers.write_csv(items, new_folder(spark, "dump"))
    return readers.read_items_csv(spark, path).select("PK", "SK", "CreatedAt", "Conversation", "Feedback")


@query
def items_csv_all_forms(spark, sf):
    path = writers.write_csv(ad.items(spark, sf), new_folder(spark, "dump"))
    return readers.read_items_csv(spark, path).select(
        "PK", "SK", "CreatedAt", "Feedback", tr.transcript(F.col("Conversation")).alias("conversacion"),
        parse_profile(F.col("UserData")).alias("p"),
    ).select("PK", "SK", "CreatedAt", "Feedback", "conversacion", "p.*")


@query
def csv_round_trip(spark, sf):
    path = writers.write_csv(_report(spark, sf), new_folder(spark, "report"))
    return readers.read_report_csv(spark, path)


@query
def token_csv_round_trip(spark, sf):
    path = writers.write_csv(_tokens(spark, sf), new_folder(spark, "tokens"))
    return readers.read_csv(spark, path, schemas.TOKEN_TABLE)


@query
def typed_report(spark, sf):
    path = writers.write_csv(_report(spark, sf), new_folder(spark, "report"))
    return ty.typed_report(readers.read_report_csv(spark, path))


@query
def parquet_check(spark, sf):
    report = ty.typed_report(ty.as_text(_report(spark, sf)))
    return writers.write_verified_parquet(report, new_folder(spark, "typed"))


@query
def catalog_table(spark, sf):
    path = writers.write_parquet(ty.typed_report(ty.as_text(_report(spark, sf))), new_folder(spark, "typed"))
    return catalog.register_table(spark, "parlance_user_report", path)


@query
def catalog_columns(spark, sf):
    path = writers.write_parquet(ty.typed_report(ty.as_text(_report(spark, sf))), new_folder(spark, "typed"))
    catalog.register_table(spark, "parlance_typed_report", path)
    return catalog.column_listing(spark).where(F.col("table_name") == "parlance_typed_report")


@query
def arrival_refresh(spark, sf):
    landing = writers.write_csv(_report(spark, sf), new_folder(spark, "landing"))
    target = new_folder(spark, "refreshed")
    view = "parlance_refreshed_report"
    refresh.refresh(spark, landing, target, new_folder(spark, "progress"), view=view)
    return refresh.latest_per_user(spark.table(view))


@query
def arrival_refresh_by_key(spark, sf):
    """Two dumps arrive, the first with other names; the state keeps the newest rows."""
    report, landing, state = _report(spark, sf), new_folder(spark, "landing"), new_folder(spark, "current")
    progress = new_folder(spark, "progress")
    writers.write_csv(report.withColumn("nombre", F.lit("x")).where(F.crc32("usuario_id") % 4 == 0), f"{landing}/z")
    current.refresh_current(spark, f"{landing}/*", state, progress, buckets=16)
    writers.write_csv(report, f"{landing}/a")
    current.refresh_current(spark, f"{landing}/*", state, progress)
    return current.read_current(spark, state)


# --- typed columns ----------------------------------------------------------------------

@query
def multi_format_date(spark, sf):
    orders = ad.table(spark, sf, "orders")
    day, form = F.to_date("o_orderdate"), F.col("o_orderkey") % 6
    text = (
        F.when(form == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(form == 2, F.date_format(day, "M/d/yyyy"))
        .when(form == 3, F.lit("Sin fecha"))
        .when(form == 4, F.lit(""))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    return orders.select("o_orderkey", convert.parse_date(text).alias("fecha"))


@query
def int_zero_null(spark, sf):
    text = (F.col("l_linenumber") - 1).cast("string")
    lines = ad.table(spark, sf, "lineitem").select(convert.parse_integer(text).alias("valor"))
    return lines.groupBy("valor").agg(F.count(F.lit(1)).alias("n"))


@query
def timestamp_and_double(spark, sf):
    events = ad.table(spark, sf, "events")
    ts_text = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit(""))
    value_text = F.when(F.col("event_type") != "view", F.col("value").cast("string")).otherwise(F.lit(""))
    return events.select(
        "event_id",
        F.date_format(convert.parse_timestamp(ts_text), "yyyy-MM-dd HH:mm:ss").alias("momento"),
        convert.parse_double(value_text).alias("valor"),
    )


@query
def feedback_domain(spark, sf):
    labels = ad.table(spark, sf, "labels")
    feedback = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 1), " Mixed")
        .when(F.col("quality") == 1, " LIKE ").when(F.col("toxic") == 1, "dislike").otherwise("otro")
    )
    answer = F.concat(F.lit("respuesta "), F.col("doc_id").cast("string"))
    return labels.select(
        "doc_id", convert.in_domain(feedback).alias("feedback"),
        convert.only_with(answer, feedback).alias("respuesta_feedback"),
    )


@query
def user_texts(spark, sf):
    texts = _transcripts(spark, sf)
    return texts.select("conv_id", F.array_join(tr.user_texts(F.col("conversacion_completa")), "\n").alias("textos"))


@query
def bot_texts(spark, sf):
    texts = _transcripts(spark, sf)
    return texts.select("conv_id", F.array_join(tr.bot_texts(F.col("conversacion_completa")), "\n").alias("textos"))


@query
def speaker_text(spark, sf):
    texts = _transcripts(spark, sf)
    return texts.select(
        "conv_id",
        tr.user_text(F.col("conversacion_completa")).alias("texto_user"),
        tr.bot_text(F.col("conversacion_completa")).alias("texto_bot"),
    )


@query
def transcript_tokens(spark, sf):
    return ty.token_columns(_transcripts(spark, sf)).drop("conversacion_completa")


@query
def null_profile(spark, sf):
    return ty.null_profile(ty.typed_report(ty.as_text(_report(spark, sf))))


# --- message maps and token costs -----------------------------------------------------------

@query
def message_map_rows(spark, sf):
    maps = tc.read_maps(ad.message_items(spark, sf)).select(
        "SK", F.explode(tk.message_entries(F.col("message_map"), members=F.col("map_members"))).alias("m")
    )
    return maps.select("SK", "m.message_id", "m.role", "m.body")


@query
def transcript_by_elements(spark, sf):
    """Every list cut into its elements first, as cells too large for one value are."""
    return _talks(spark, sf).select("SK", tr.transcript(F.col("Conversation"), 0).alias("conversacion_completa"))


@query
def message_map_tokens_by_members(spark, sf):
    """Every map cut into its members first, as cells too large for one value are."""
    items = ad.message_items(spark, sf).select("SK", tk.read_message_map(F.col("MessageMap"), 0).alias("m"))
    maps = items.where(F.col("m.parse_status") != "missing")
    return maps.select("SK", tc.count_tokens(F.col("m.value"), F.col("m.members")).alias("t")).select("SK", "t.*")


@query
def literal_forms(spark, sf):
    """Texts and numbers written as Python literals of all forms."""
    cells = ad.literal_cells(spark, sf).select("conv_id", "turn", lt.read_literal(F.col("cell")).alias("v"))
    return cells.select(
        "conv_id", F.col("turn").cast("int").alias("turn"), lt.field_text(F.col("v"), "1").alias("texto"),
        F.try_variant_get("v", "$.n[0]", "bigint").alias("numero"), F.to_json(lt.field(F.col("v"), "rest")).alias("resto"),
    )


@query
def mixed_envelope(spark, sf):
    """Tagged values below untagged ones and the other way round, with number sets."""
    parts = spread(ad.table(spark, sf, "part").select("p_partkey", "p_name", "p_size"))
    name = F.to_json(F.struct(F.col("p_name").alias("S")))
    cell = F.concat(
        F.lit('{"M":{"p":{"name":'), name, F.lit(',"in":[{"M":{"S":'), name, F.lit('}}]},"n":{"NS":["'),
        F.col("p_size").cast("string"), F.lit('","'), F.col("p_partkey").cast("string"), F.lit('"]}}}'))
    value = unwrap_any(lt.read_json(cell))
    return parts.select(
        "p_partkey", F.try_variant_get(value, "$.p.name", "string").alias("nombre"),
        F.try_variant_get(value, "$.p.in[0].S", "string").alias("otro"), F.try_variant_get(value, "$.n[0]", "bigint").alias("medida"),
        F.try_variant_get(value, "$.n[1]", "bigint").alias("clave"),
    )


@query
def message_map_tokens(spark, sf):
    maps = tc.read_maps(ad.message_items(spark, sf)).where(F.col("parse_status") != "missing")
    return maps.select("SK", tc.count_tokens(F.col("message_map"), F.col("map_members")).alias("t")).select("SK", "t.*")


@query
def enveloped_map_tokens(spark, sf):
    turns = ad.grouped_turns(ad.table(spark, sf, "conversations"))

    def entry(t):
        return F.struct(
            F.concat(F.lit("t"), t["turn"].cast("string")).alias("key"),
            F.struct(F.struct(
                F.struct(t["role"].alias("S")).alias("role"),
                F.struct(F.array(F.struct(F.struct(F.struct(t["text"].alias("S")).alias("body")).alias("M"))).alias("L")).alias("content"),
            ).alias("M")).alias("value"),
        )

    cell = F.to_json(F.struct(F.map_from_entries(F.transform("turns", entry)).alias("M")))
    maps = turns.select("conv_id", read_json(cell).alias("m"))
    return maps.select("conv_id", tc.count_tokens(F.col("m")).alias("t")).select("conv_id", "t.*")


@query
def typed_envelope(spark, sf):
    turns = ad.grouped_turns(ad.table(spark, sf, "conversations"))
    cell = ad.conversation_cell(F.col("conv_id"), F.col("turns"), F.lit(ad.ENVELOPE))
    message = T.StructType([T.StructField("from", T.StringType()), T.StructField("text", T.StringType())])
    opened = turns.select("conv_id", unwrap(read_json(cell), T.ArrayType(message)).alias("mensajes"))
    return opened.select("conv_id", F.inline("mensajes")).select(
        "conv_id", F.col("from").alias("de"), F.col("text").alias("texto")
    )


@query
def nested_envelope(spark, sf):
    """Lists and maps inside lists and maps, of unknown shape."""
    turns = ad.grouped_turns(ad.table(spark, sf, "conversations"))

    def text(value):
        return F.struct(value.alias("S"))

    def entry(t):
        tags = F.array(
            F.to_json(text(t["role"])), F.lit('{"BOOL":true}'), F.lit('{"NULL":true}'), F.lit('{"SS":["a","b]}"]}'))
        return F.concat(
            F.lit('{"M":{"turn":{"N":"'), t["turn"].cast("string"), F.lit('"},"said":{"M":{"text":'),
            F.to_json(text(t["text"])), F.lit('}},"tags":{"L":['), F.array_join(tags, ","), F.lit("]}}}"),
        )

    cell = F.concat(F.lit('{"M":{"turns":{"L":['), F.array_join(F.transform("turns", entry), ","), F.lit("]}}}"))
    opened = turns.select("conv_id", unwrap(read_json(cell), T.VariantType()).alias("v"))
    entries = opened.select("conv_id", F.explode(F.try_variant_get("v", "$.turns", "array<variant>")).alias("t"))
    return entries.select(
        "conv_id", F.try_variant_get("t", "$.turn", "int").alias("turn"),
        F.try_variant_get("t", "$.said.text", "string").alias("texto"),
        F.to_json(F.try_variant_get("t", "$.tags", "variant")).alias("marcas"),
    )


@query
def token_repair(spark, sf):
    return tc.read_maps(ad.message_items(spark, sf)).groupBy("parse_status").agg(F.count(F.lit(1)).alias("n"))


@query
def token_table(spark, sf):
    return _tokens(spark, sf)


@query
def token_prices(spark, sf):
    docs = _documents(spark, sf).select("doc_id", tk.chars4_tokens(F.col("text")).alias("n"))
    return docs.select(
        "doc_id", convert.token_price(F.col("n"), V.INPUT_RATE).cast("double").alias("precio_token_input"),
        convert.token_price(F.col("n"), V.OUTPUT_RATE).cast("double").alias("precio_token_output"),
    )


def _event_times(spark, sf):
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).cast("string")
    # Among the times: unreadable ones, missing ones, and some beyond any clock.
    time = (
        F.when(F.col("event_type") == "error", F.lit("sin hora"))
        .when(F.col("value") < 1, F.lit(None))
        .when(F.col("value") > 100, F.concat(ms, ms))
        .otherwise(ms)
    )
    return ad.table(spark, sf, "events").select("event_id", time.alias("CreateTime"))


@query
def epoch_filter(spark, sf):
    events = _event_times(spark, sf)
    return events.where(it.in_epoch_range(F.col("CreateTime"), EVENT_FIRST_MS, EVENT_LAST_MS)).select("event_id")


@query
def epoch_label(spark, sf):
    return _event_times(spark, sf).select("event_id", convert.epoch_label(F.col("CreateTime")).alias("create_date"))


@query
def run_counters(spark, sf):
    return tc.run_counters(ad.message_items(spark, sf), FIRST_MS, LAST_MS)


@query
def event_counters(spark, sf):
    return tc.run_counters(_event_times(spark, sf), EVENT_FIRST_MS, EVENT_LAST_MS)


@query
def token_view(spark, sf):
    return tc.by_total_tokens(tc.token_view(_tokens(spark, sf)))


@query
def token_totals(spark, sf):
    return tc.token_totals(_tokens(spark, sf))


@query
def empty_placeholder(spark, sf):
    items = ad.message_items(spark, sf)
    none_left = tc.token_table(items.where(F.col("MessageMap").isNotNull() & (convert.epoch_status(F.col("CreateTime")) == "ok")), 1, 2)
    return tc.or_placeholder(none_left, AS_OF + " 00:00:00")


@query
def filled_placeholder(spark, sf):
    # Written first, as the job does it, so that looking for a first row does not plan the tokens again.
    written = writers.write_parquet(_tokens(spark, sf), new_folder(spark, "tokens"))
    return tc.or_placeholder(spark.read.schema(schemas.TOKEN_TABLE).parquet(written), AS_OF + " 00:00:00")


@query
def daily_cost(spark, sf):
    return tc.daily_costs(_tokens(spark, sf), MODEL)


@query
def user_cost(spark, sf):
    return tc.user_costs(_tokens(spark, sf), per_day=False)


@query
def user_day_cost(spark, sf):
    return tc.user_costs(_tokens(spark, sf))


@query
def event_daily_count(spark, sf):
    labels = _event_times(spark, sf).select(convert.epoch_label(F.col("CreateTime")).alias("create_date"))
    day = convert.to_day(F.col("create_date"))
    return labels.groupBy(day.alias("dia")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("dia"))


# --- reports ------------------------------------------------------------------------------------

@query
def distinct_users_by_stage(spark, sf):
    rows = it.with_user_id(ur.profile_and_dates(_report_rows(spark, sf)))
    inside_places = ~it.is_excluded_place(F.col("gerencia"))
    inside_dates = it.in_day_range(F.col("dia"), V.REPORT_START, AS_OF)
    return rp.distinct_users_by_stage(rows, {
        "inicio": F.lit(True), "ciudad": inside_places, "fecha": inside_places & inside_dates,
    })


@query
def feedback_distribution(spark, sf):
    return rp.feedback_distribution(_report(spark, sf))


@query
def event_distribution(spark, sf):
    return rp.value_distribution(ad.table(spark, sf, "events"), "event_type", places=2)


@query
def feedback_histogram(spark, sf):
    return rp.feedback_histogram(_report(spark, sf))


@query
def conversation_buckets(spark, sf):
    users = ad.table(spark, sf, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("numero_conversaciones"))
    return rp.conversation_buckets(users)


@query
def user_conversation_buckets(spark, sf):
    return rp.conversation_buckets(_report(spark, sf))


@query
def duplicate_users(spark, sf):
    rows = it.with_user_id(_report_rows(spark, sf))
    return rp.duplicate_keys(rows)


@query
def duplicate_check(spark, sf):
    return rp.duplicate_check(_report(spark, sf))


@query
def completeness(spark, sf):
    return rp.completeness(_report(spark, sf))


@query
def answer_vocabulary(spark, sf):
    return rp.answer_vocabulary(_report(spark, sf))


@query
def top_answers(spark, sf):
    return rp.top_answers(_report(spark, sf), 10)


@query
def answer_shape(spark, sf):
    return rp.answer_shape(_report(spark, sf))


@query
def coherence(spark, sf):
    return rp.coherence(_report(spark, sf))


@query
def validation_report(spark, sf):
    return rp.validation_report(ty.convert_columns(ty.as_text(_report(spark, sf))))


@query
def kpis(spark, sf):
    return rp.kpis(_report(spark, sf))


@query
def first_examples(spark, sf):
    report = _report(spark, sf).select("usuario_id", "pregunta_conversacion")
    return rp.first_rows(report, 5, where=F.col("pregunta_conversacion") != "").select(
        "usuario_id", tx.preview(F.col("pregunta_conversacion"), 100).alias("vista")
    )


@query
def answer_examples(spark, sf):
    report = _report(spark, sf).where(F.col("respuesta_feedback") != "")
    kind = F.when(tx.has_many(F.col("respuesta_feedback")), "multiple").otherwise("simple")
    return rp.rows_per_class(report.withColumn("clase", kind), "clase", 3).select("clase", "usuario_id", "respuesta_feedback")


@query
def examples_per_class(spark, sf):
    report = _report(spark, sf).where(F.col("feedback") != "")
    return rp.rows_per_class(report, "feedback", 2).select("feedback", "usuario_id")
