"""Given tables -> inputs of the engine.

Every adapter keeps all rows and whole texts. Keys decide only the *form* of a
cell (envelope, JSON, Python literal), never whether its row or text is used.
A conversation is one item, however many turns it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

USERS_PER = 3  # conversations per user
FIRST_DAY = "2025-07-25"
AREAS = (
    "Bogotá", "Bogotá (Norte)", "Medellín", "POTOSÍ", "Tunja", "", "Calidad", "Chía (Centro)",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _user(conversation_id: Column) -> Column:
    return F.floor(conversation_id / F.lit(USERS_PER)).cast("bigint")


def _user_key(user: Column) -> Column:
    return F.concat(F.lit("USER#"), user.cast("string"))


def _quoted(text: Column) -> Column:
    """Text as a single-quoted Python literal."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("'"), F.lit("\\'"))
    out = F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.concat(F.lit("'"), out, F.lit("'"))


def literal_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a Python dictionary; the form of its text goes by the turn's number."""
    turns = table(spark, sf_dir, "conversations")
    text, role = F.col("text"), F.col("role")
    half = F.floor(F.length(text) / 2).cast("int")
    first, second = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))

    def escaped(t: Column, mark: str) -> Column:
        return F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit(mark), F.lit("\\" + mark))

    double = F.replace(F.replace(escaped(second, '"'), F.lit("\n"), F.lit("\\x0a")), F.lit("\r"), F.lit("\\15"))
    is_plain = ~text.rlike(r"[\\'\n\r]")
    triple = F.concat(F.lit("'" * 3), escaped(text, "'"), F.lit("'" * 3))
    written = (
        F.when(F.col("turn") % 4 == 0, triple)
        .when(F.col("turn") % 4 == 1, F.concat(_quoted(first), F.lit(' u"'), double, F.lit('"')))
        .when((F.col("turn") % 4 == 2) & is_plain, F.concat(F.lit("r'"), text, F.lit("'")))
        .otherwise(F.concat(F.lit("("), _quoted(text), F.lit(")")))
    )
    cell = F.concat(
        F.lit("{1: "), written, F.lit(", 'n': [0x"), F.lower(F.hex(F.col("turn"))), F.lit("f, 1_0,], # numbers\n 'rest': ({1, b'"),
        role, F.lit("'}, ('"), role, F.lit("', "), F.col("turn").cast("string"), F.lit(", .5), '"), role, F.lit("' \""), role,
        F.lit('"'), F.lit(", {True: -1_000})}"),
    )
    return turns.select("conv_id", "turn", cell.alias("cell"))


def _json_string(text: Column) -> Column:
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def _created_at(conversation_id: Column) -> Column:
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (conversation_id % 60).cast("int"))
    return F.when(conversation_id % 11 != 0, F.concat(day.cast("string"), F.lit("T10:00:00.000Z")))


def grouped_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the ordered turns of each conversation."""
    return conversations.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def _speaker(turn: Column, conversation_id: Column) -> Column:
    odd = conversation_id % 2 == 1
    return F.when((turn["role"] == "user") & odd, "USUARIO").when(
        (turn["role"] == "assistant") & odd, "Bot"
    ).otherwise(turn["role"])


def literal_conversation(conversation_id: Column, turns: Column, exact: bool = False) -> Column:
    """Turns as a Python-literal list of messages; ``exact`` names the speakers user and bot."""

    def speaker(turn: Column) -> Column:
        if exact:
            return F.when(turn["role"] == "assistant", "bot").otherwise(turn["role"])
        return _speaker(turn, conversation_id)

    messages = F.transform(turns, lambda t: F.concat(
        F.lit("{'from': '"), speaker(t), F.lit("', 'text': "), _quoted(t["text"]), F.lit(", 'timestamp': None}")
    ))
    return F.concat(F.lit("["), F.array_join(messages, ", "), F.lit("]"))


ENVELOPE, PLAIN, LITERAL, WRAPPED = range(4)


def conversation_cell(conversation_id: Column, turns: Column, form: Column) -> Column:
    """Turns as a conversation cell: tagged list, plain JSON, Python literal, or wrapped messages."""

    def text_struct(t: Column) -> Column:
        return F.struct(
            F.struct(_speaker(t, conversation_id).alias("S")).alias("from"),
            F.struct(t["text"].alias("S")).alias("text"),
        )

    wrapped = F.transform(turns, lambda t: F.struct(text_struct(t).alias("M")))
    plain = F.transform(turns, lambda t: F.struct(
        _speaker(t, conversation_id).alias("from"), t["text"].alias("text")
    ))
    return (
        F.when(form == ENVELOPE, F.to_json(F.struct(wrapped.alias("L"))))
        .when(form == PLAIN, F.to_json(plain))
        .when(form == LITERAL, literal_conversation(conversation_id, turns))
        .otherwise(F.to_json(wrapped))
    )


def _area(user: Column) -> Column:
    return F.element_at(F.array(*[F.lit(a) for a in AREAS]), (user % len(AREAS) + 1).cast("int"))


def _profile_cell(user: Column, name: Column) -> Column:
    shown = F.when(user % 7 == 0, "").otherwise(F.concat(F.lit(" "), F.coalesce(name, F.lit(""))))
    area = _area(user)
    form = user % 3
    return (
        F.when(form == 0, F.to_json(F.struct(shown.alias("nombre"), area.alias("ciudad"))))
        .when(form == 1, F.concat(
            F.lit("{'nombre': "), _quoted(shown), F.lit(", 'gerencia': "), _quoted(area), F.lit(", 'activo': True}")
        ))
        .otherwise(F.to_json(F.struct(F.struct(
            F.struct(shown.alias("S")).alias("nombre"), F.struct(area.alias("S")).alias("ciudad")
        ).alias("M"))))
    )


def _feedback_pairs(doc: Column, kind: Column) -> Column:
    """Key and value of each member of one feedback object."""
    members = F.array(
        F.struct(F.lit("comment").alias("k"), F.concat(F.lit("tema "), (doc % 7).cast("string")).alias("v")),
        F.struct(F.lit("option").alias("k"), F.concat(F.lit("opción "), (doc % 4).cast("string")).alias("v")),
        F.struct(F.lit("type").alias("k"), kind.alias("v")),
    )
    return F.filter(members, lambda m: m["v"].isNotNull())


def feedback_cell(doc: Column, quality: Column, toxic: Column) -> Column:
    """Labels -> feedback: quality is a like, toxic a dislike, neither a comment alone."""
    kinds = F.filter(
        F.array(F.when(quality == 1, "like"), F.when(toxic == 1, "dislike")), lambda k: k.isNotNull()
    )
    kinds = F.when(F.size(kinds) == 0, F.array(F.lit(None).cast("string"))).otherwise(kinds)

    def rendered(quote: str) -> Column:
        objects = F.transform(kinds, lambda k: F.concat(F.lit("{"), F.array_join(F.transform(
            _feedback_pairs(doc, k),
            lambda m: F.concat(F.lit(quote), m["k"], F.lit(f"{quote}: {quote}"), m["v"], F.lit(quote)),
        ), ", "), F.lit("}")))
        return F.when(F.size(objects) == 1, objects[0]).otherwise(
            F.concat(F.lit("["), F.array_join(objects, ", "), F.lit("]"))
        )

    def enveloped() -> Column:
        objects = F.transform(kinds, lambda k: F.concat(F.lit('{"M":{'), F.array_join(F.transform(
            _feedback_pairs(doc, k),
            lambda m: F.concat(F.lit('"'), m["k"], F.lit('":{"S":"'), m["v"], F.lit('"}')),
        ), ","), F.lit("}}")))
        return F.when(F.size(objects) == 1, objects[0]).otherwise(
            F.concat(F.lit('{"L":['), F.array_join(objects, ","), F.lit("]}"))
        )

    return F.when(doc % 5 == 0, enveloped()).when(doc % 2 == 0, rendered("'")).otherwise(rendered('"'))


def items(spark: SparkSession, sf_dir: str, form: int | None = None) -> DataFrame:
    """Item table: conversations, labels as feedback, and profile and registration rows.

    ``form`` gives every conversation cell the same form; otherwise they alternate.
    """
    cell_form = F.col("conv_id") % 4 if form is None else F.lit(form)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user"), "c_name")
    conversations = table(spark, sf_dir, "conversations")
    labels = table(spark, sf_dir, "labels")
    none = F.lit(None).cast("string")

    talks = (
        grouped_turns(conversations)
        .withColumn("user", _user(F.col("conv_id")))
        .join(customers, "user", "left")
        .select(
            _user_key(F.col("user")).alias("PK"),
            F.concat(F.lit("CONVERSATION#"), F.lpad(F.col("conv_id").cast("string"), 10, "0")).alias("SK"),
            _profile_cell(F.col("user"), F.col("c_name")).alias("UserData"),
            _created_at(F.col("conv_id")).alias("CreatedAt"),
            conversation_cell(F.col("conv_id"), F.col("turns"), cell_form).alias("Conversation"),
            none.alias("Feedback"),
        )
    )
    feedback = labels.select(
        _user_key(_user(F.col("doc_id"))).alias("PK"),
        F.concat(F.lit("Feedback#"), F.lpad(F.col("doc_id").cast("string"), 10, "0")).alias("SK"),
        none.alias("UserData"), none.alias("CreatedAt"), none.alias("Conversation"),
        feedback_cell(F.col("doc_id"), F.col("quality"), F.col("toxic")).alias("Feedback"),
    )
    users = conversations.select(_user(F.col("conv_id")).alias("user")).distinct().join(customers, "user", "left")
    register = users.select(
        _user_key(F.col("user")).alias("PK"), F.lit("Register#1").alias("SK"),
        none.alias("UserData"), none.alias("CreatedAt"), none.alias("Conversation"), none.alias("Feedback"),
    )
    # Every user has a profile row; it counts as a row of neither kind.
    profile = users.select(
        _user_key(F.col("user")).alias("PK"), F.lit("PROFILE").alias("SK"),
        _profile_cell(F.col("user"), F.col("c_name")).alias("UserData"),
        F.lit("2025-09-01 08:30:00").alias("CreatedAt"), none.alias("Conversation"),
        F.when(F.col("user") % 5 == 0, F.lit("{'type': 'dislike', 'comment': \"d'accord\"}")).alias("Feedback"),
    )
    return talks.unionByName(feedback).unionByName(register).unionByName(profile)


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, conversacion_completa`` straight from the turns."""
    from parlance.functions.transcript import join_messages

    turns = grouped_turns(table(spark, sf_dir, "conversations"))
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("speaker"), t["text"].alias("text")))
    return turns.select("conv_id", join_messages(messages).alias("conversacion_completa"))


def _map_cell(conversation_id: Column, turns: Column) -> Column:
    """One message map; the key is the turn, or the role for a system turn."""

    def entry(t: Column) -> Column:
        key = F.when(t["role"] == "system", t["role"]).otherwise(F.concat(F.lit("t"), t["turn"].cast("string")))
        text = _json_string(t["text"])
        listed = F.concat(
            F.lit('{"role": "'), t["role"],
            F.lit('", "content": [{"content_type": "text", "media_type": null, "body": '), text, F.lit("}]}"),
        )
        plain = F.concat(F.lit('{"role": "'), t["role"], F.lit('", "content": '), text, F.lit("}"))
        return F.concat(
            F.lit('"'), key, F.lit('": '), F.when(t["turn"] % 2 == 0, listed).otherwise(plain)
        )

    body = F.array_join(F.transform(turns, entry), ", ")
    truncated = F.lit(', "file": {"role": "user", "content": [{"body": ", "file_name": null}]}')
    whole = F.concat(F.lit("{"), body, F.lit("}"))
    return (
        F.when(conversation_id % 17 == 0, F.concat(F.lit("{"), body, truncated, F.lit("}")))
        .when(conversation_id % 17 == 1, F.concat(F.lit("export: "), whole, F.lit(" ;")))
        .when(conversation_id % 17 == 2, F.concat(
            F.lit('"'), F.replace(whole, F.lit('"'), F.lit('""')), F.lit('"')
        ))
        .otherwise(whole)
    )


def epoch_of(conversation_id: Column) -> Column:
    """Epoch milliseconds of a conversation's day."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (conversation_id % 60).cast("int"))
    return F.unix_date(day).cast("bigint") * 86400000 + conversation_id * 1000


def message_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message items: one per conversation, and one without a map per customer who has none."""
    turns = grouped_turns(table(spark, sf_dir, "conversations")).withColumn("user", _user(F.col("conv_id")))
    talks = turns.select(
        F.col("user").cast("string").alias("PK"),
        F.col("conv_id").cast("string").alias("SK"),
        F.when(F.col("conv_id") % 19 == 0, "sin fecha")
        # Some times are beyond any clock; their items are priced as errors.
        .when(F.col("conv_id") % 13 == 5, F.repeat(epoch_of(F.col("conv_id")).cast("string"), F.lit(2)))
        .when(F.col("conv_id") % 23 != 0, epoch_of(F.col("conv_id")).cast("string"))
        .alias("CreateTime"),
        _map_cell(F.col("conv_id"), F.col("turns")).alias("MessageMap"),
        F.lit(None).cast("double").alias("TotalPrice"),
    )
    customers = table(spark, sf_dir, "customer")
    silent = customers.join(turns.select("user"), customers["c_custkey"] == F.col("user"), "left_anti").select(
        F.col("c_custkey").cast("string").alias("PK"), F.lit("silent").alias("SK"),
        F.lit(None).cast("string").alias("CreateTime"), F.lit(None).cast("string").alias("MessageMap"),
        F.col("c_acctbal").alias("TotalPrice"),
    )
    return talks.unionByName(silent)


RULE_PHRASES = (
    "El trámite de registro es", "El certificado catastral incluye", "El CHIP", "Cuesta", "Los requisitos son",
    "Quince días hábiles", "La sede", "Horario y atención", "Nada de eso",
)


def ruled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text``: whole documents after words that one of the question rules looks for, or none."""
    phrase = F.element_at(F.array(*[F.lit(p) for p in RULE_PHRASES]), (F.col("doc_id") % len(RULE_PHRASES) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(phrase, F.lit(" "), F.col("text")).alias("text"))


def dialogue_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text``: whole documents in each of the forms that questions are read from."""
    said = F.translate(F.col("text"), "|", "/")
    form = F.col("doc_id") % 5
    text = (
        F.when(form == 0, F.concat(F.lit("user: "), said, F.lit(" | bot: ok || user: segunda | user: "), said))
        .when(form == 1, F.concat(F.lit("user: "), said, F.lit(" | bot: ok | user: otra")))
        .when(form == 2, F.concat(F.lit("User: "), said))
        .when(form == 3, F.concat(F.lit("bot: "), said))
        .otherwise(F.concat(F.lit("hola user: "), said))
    )
    return ruled_texts(spark, sf_dir).select("doc_id", text.alias("text"))
