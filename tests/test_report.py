import random

import pytest
from pyspark.sql import functions as F

from parlance import fixed_values as V, schemas
from parlance.operators import items as it, reports as rp, rollup as ro
from parlance.operators.contract import column_differences, enforce_columns
from parlance.operators.feedback_join import join_last_feedback
from parlance.plans import message_report as mr, typed_report as ty, user_report as ur


def _items(spark, rows):
    return spark.createDataFrame(rows, schemas.ITEMS)


def test_register_and_kinds(spark):
    items = _items(spark, [(p, s, None, None, None, None) for p, s in [
        ("a", "Register#1"), ("a", None), ("a", "conversation#1"), ("a", "X#FEEDBACK#CONVERSATION"), ("a", "OTHER"),
    ]])
    kept = it.drop_register(items)
    assert [r.SK for r in kept.collect()] == [None, "conversation#1", "X#FEEDBACK#CONVERSATION", "OTHER"]
    kinds = [(r.is_conversation, r.is_feedback, r.is_other) for r in it.with_row_kinds(kept).collect()]
    assert kinds == [(False, False, True), (True, False, False), (True, True, False), (False, False, True)]
    plain = items.drop("SK")
    assert it.drop_register(plain) is plain


def test_last_feedback_wins(spark):
    items = _items(spark, [
        ("USER#A", "CONVERSATION#1", None, None, "c", "old"),
        ("USER#A", "CONVERSATION#2", None, None, "c", None),
        ("USER#A", "FEEDBACK#1", None, None, None, "x"),
        ("USER#A", "FEEDBACK#2", None, None, None, None),
        ("USER#B", "CONVERSATION#1", None, None, "c", "b"),
        ("USER#C", "FEEDBACK#1", None, None, None, "only feedback"),
        ("USER#D", "CONVERSATION#1", None, None, "c", None),
        ("USER#D", "FEEDBACK#2", None, None, None, "second"),
        ("USER#D", "FEEDBACK#1", None, None, None, "first"),
        ("USER#D", "PROFILE", None, None, None, "own"),
        ("D", "CONVERSATION#9", None, None, "c", "same user id, other key"),
    ])
    got = {(r.PK, r.SK): r.Feedback for r in join_last_feedback(items).collect()}
    assert got == {
        ("USER#A", "CONVERSATION#1"): None, ("USER#A", "CONVERSATION#2"): None,
        ("USER#B", "CONVERSATION#1"): "b", ("USER#D", "CONVERSATION#1"): "second",
        ("USER#D", "PROFILE"): "own", ("D", "CONVERSATION#9"): "same user id, other key",
    }


def _random_items(spark, seed, users=6, rows=120, hot=0.4):
    """Items with one user holding a large share of the rows."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        user = 0 if rng.random() < hot else rng.randrange(users)
        kind = rng.choices(["CONVERSATION", "FEEDBACK", "PROFILE"], [6, 2, 1])[0]
        text = "".join(rng.choice("abc xyz") for _ in range(rng.randrange(1, 40)))
        conversation = None
        if kind == "CONVERSATION":
            conversation = f'[{{"from": "user", "text": "{text}"}}, {{"from": "bot", "text": "r{i}"}}]'
        feedback = rng.choice([None, "{'type': 'like', 'comment': 'c%d'}" % (i % 3), '{"type": "dislike", "option": "o"}'])
        profile = rng.choice([None, '{"nombre": "N%d", "ciudad": "C%d"}' % (i, i % 2), "{'nombre': '', 'ciudad': ''}"])
        created = rng.choice([None, "zz", "2025-08-10", "2025-08-20T01:02:03Z", "2024-01-01"])
        prefix = rng.choice(["USER#", "USER#", ""])
        out.append((f"{prefix}u{user}", f"{kind}#{i:05d}", profile, created, conversation, feedback))
    return _items(spark, out)


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_rollup_of_conversations(spark, seed):
    items = _random_items(spark, seed).cache()
    direct = ur.user_report(items, as_of="2025-08-31")
    rolled = ur.rollup_conversations(ur.conversation_report(items, as_of="2025-08-31"))
    assert direct.columns == list(V.REPORT_COLUMNS)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, rolled.collect()))


def test_one_row_per_user_and_counts_preserved(spark):
    items = _random_items(spark, 3).cache()
    rows = ur.conversation_report(items, as_of="2025-08-31")
    report = ur.user_report(items, as_of="2025-08-31")
    assert rp.duplicate_check(report).first().sin_duplicados
    before = rows.agg(F.sum("numero_conversaciones"), F.sum("numero_feedback")).first()
    after = report.agg(F.sum("numero_conversaciones"), F.sum("numero_feedback")).first()
    assert tuple(before) == tuple(after)


def _twin(items):
    """The user report in plain Python, from the rows per conversation."""
    rows = ur.conversation_report(items, as_of="2025-08-31").collect()
    users = {}
    for r in sorted((r for r in rows if r.usuario_id is not None), key=lambda r: (r.is_other, r.SK, r.PK)):
        users.setdefault(r.usuario_id, []).append(r)

    def first(values, default, skip_default):
        real = [v for v in values if v not in (None, "", "nan", "None") and not (skip_default and v == default)]
        return real[0] if real else default

    out = {}
    for user, own in users.items():
        texts = {c: " || ".join(r[c] for r in own if r[c] not in (None, "", "nan", "None"))
                 for c in ("conversacion_completa", "feedback_total", "pregunta_conversacion")}
        area = first([r.gerencia for r in own], V.UNSPECIFIED_AREA, False)
        out[user] = (
            first([r.nombre for r in own], V.ANONYMOUS_NAME, True), area, area, own[0].fecha_primera_conversacion,
            sum(r.numero_conversaciones for r in own), texts["conversacion_completa"], texts["feedback_total"],
            sum(r.numero_feedback for r in own), texts["pregunta_conversacion"],
        )
    return out


def test_one_row_per_user_however_skewed(spark):
    """One user with more than a third of 3000 rows: a row per user, equal to a plain Python twin."""
    items = _random_items(spark, 4, users=300, rows=3000, hot=0.35).cache()
    report = ur.user_report(items, as_of="2025-08-31").cache()
    found = {r.usuario_id: tuple(r)[1:10] for r in report.collect()}
    assert found == _twin(items) and report.count() == len(found)
    assert rp.duplicate_check(report).first().sin_duplicados
    assert [r.usuario_id for r in rp.first_rows(report, 5).collect()] == sorted(found)[:5]
    profile = {r.columna: r.validos for r in ty.null_profile(report).collect()}
    assert profile["usuario_id"] == len(found)
    rolled = ur.rollup_conversations(ur.conversation_report(items, as_of="2025-08-31"))
    assert sorted(map(tuple, rolled.collect())) == sorted(map(tuple, report.collect()))


def test_plan_does_not_depend_on_the_data(spark):
    def exchanges(items):
        plan = ur.user_report(items)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange")

    even, skewed = (_random_items(spark, 5, users=200, rows=400, hot=share).cache() for share in (0.0, 0.9))
    assert exchanges(even) == exchanges(skewed)


def test_text_beyond_a_row_ends_the_job(spark, monkeypatch):
    monkeypatch.setattr(ro, "ROW_BYTES", 50)
    with pytest.raises(Exception, match="a row holds at most 50"):
        ur.user_report(_random_items(spark, 4), as_of="2025-08-31").collect()


def test_ordered_concat(spark):
    rng = random.Random(2)
    data = [("hot" if rng.random() < 0.4 else f"k{i % 5}", i, rng.choice(["", "nan", None, f"t{i}"])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, i int, t string").repartition(5)
    expected = {}
    for k, _, t in sorted(data, key=lambda r: r[1]):
        expected.setdefault(k, []).extend([t] if t not in ("", "nan", None) else [])
    whole = {r.k: r.t for r in ro.ordered_concat(df, "k", "t", ["i"], "|").collect()}
    assert whole == {k: "|".join(v) for k, v in expected.items()}


def test_notebook_rollup_options(spark):
    rows = spark.createDataFrame([
        ("u", False, "1", "u", "Usuario Anónimo", "Bogotá (no especificada)", "20/08/2025", "2025-08-20", 2, "a", "", 0),
        ("u", False, "2", "u", "Ana", "Norte", "10/08/2025", "2025-08-10", 3, "b", "f", 1),
    ], "usuario_id string, is_other boolean, SK string, PK string, nombre string, gerencia string, "
       "fecha_primera_conversacion string, dia string, numero_conversaciones long, conversacion_completa string, "
       "feedback_total string, numero_feedback long").withColumns({
           "ciudad": F.col("gerencia"), "dia": F.col("dia").cast("date"), "pregunta_conversacion": F.lit("q"),
           "feedback": F.lit(""), "respuesta_feedback": F.lit(None).cast("string"),
       })
    row = ro.user_rollup(rows, separator=" | ", notebook_areas=True, earliest=True).first()
    assert (row.nombre, row.gerencia, row.fecha_primera_conversacion) == ("Ana", "Norte", "10/08/2025")
    assert (row.conversacion_completa, row.feedback_total, row.numero_conversaciones) == ("a | b", "f", 5)
    plain = ro.user_rollup(rows).first()
    assert (plain.gerencia, plain.fecha_primera_conversacion) == ("Bogotá (no especificada)", "20/08/2025")


def test_contract(spark):
    df = spark.createDataFrame([("u", "x")], "usuario_id string, extra string")
    assert enforce_columns(df).columns == list(V.REPORT_COLUMNS)
    assert column_differences(df) == {"missing": list(V.REPORT_COLUMNS[1:]), "extra": ["extra"]}


def test_list_mode_first(spark):
    items = _items(spark, [
        ("USER#1", "CONVERSATION#1", None, None, "hola", None),
        ("USER#1", "FEEDBACK#1", None, None, None, '{"L":[{"M":{"type":{"S":"like"}}},{"M":{"type":{"S":"dislike"}}}]}'),
    ])
    assert ur.user_report(items).first().feedback == "mixed"
    assert ur.user_report(items, list_mode="first").first().feedback == "like"


def test_report_moves_the_text_once(spark):
    """One exchange carries the conversation text; the join adds none to it."""
    items = spark.read.schema(schemas.ITEMS).parquet(_written(spark))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ur.user_report(items)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning(usuario_id") == 1
    assert plan.count("Exchange") == 3
    assert "Python" not in plan


def _written(spark):
    from parlance.session import new_folder
    from parlance.sources.writers import write_parquet

    return write_parquet(_random_items(spark, 6), new_folder(spark, "items"))


# --- reports -------------------------------------------------------------------

@pytest.fixture(scope="module")
def report(spark):
    return spark.createDataFrame([
        ("u1", 1, "q", "f", "like", "a | b", 1), ("u2", 4, "", "f", "dislike", "a", 2),
        ("u3", 9, "q | r", "", "", "", 0), ("u4", 6, None, "f", "like", "c | a", 1),
    ], "usuario_id string, numero_conversaciones long, pregunta_conversacion string, feedback_total string, "
       "feedback string, respuesta_feedback string, numero_feedback long").cache()


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_profiles(report):
    assert _rows(rp.run_stats(report)) == [(4, 20, 3, 2, 3)]
    assert sorted(_rows(rp.feedback_distribution(report))) == [("Sin feedback", 1, 25.0), ("dislike", 1, 25.0), ("like", 2, 50.0)]
    assert sorted(_rows(rp.value_distribution(report, "feedback", "Sin feedback"))) == sorted(_rows(rp.feedback_distribution(report)))
    assert _rows(rp.histogram(report, "numero_feedback")) == [(0, 1), (1, 2), (2, 1)]
    assert _rows(rp.conversation_buckets(report)) == [("1", 1, 5.0), ("2-5", 1, 5.0), ("6+", 2, 5.0)]
    assert _rows(rp.completeness(report)) == [("pregunta_conversacion", 2, 50.0), ("feedback", 3, 75.0), ("respuesta_feedback", 3, 75.0)]
    assert _rows(rp.answer_vocabulary(report)) == [(5, 3)]
    assert _rows(rp.top_answers(report, 2)) == [("a", 3), ("b", 1)]
    assert _rows(rp.answer_shape(report)) == [(3, 1, 2)]
    assert _rows(rp.coherence(report)) == [(3, 3)]
    assert _rows(rp.kpis(report)) == [("Total Usuarios", 4), ("Total Conversaciones", 20)]


def test_samples(report):
    assert [r.usuario_id for r in rp.first_rows(report, 2, where=F.col("feedback") != "").collect()] == ["u1", "u2"]
    per_class = rp.rows_per_class(report, "feedback", 1)
    assert sorted(r.usuario_id for r in per_class.collect()) == ["u1", "u2", "u3"]
    assert "WindowGroupLimit" in per_class._jdf.queryExecution().executedPlan().toString()


def test_duplicates_and_stages(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "usuario_id string, x int")
    assert _rows(rp.duplicate_keys(df)) == [("a", 2)]
    assert _rows(rp.duplicate_check(df)) == [(1, False)]
    stages = {"all": F.lit(True), "big": F.col("x") > 1, "none": F.lit(None).cast("boolean")}
    assert _rows(rp.distinct_users_by_stage(df, stages)) == [("all", 2), ("big", 2), ("none", 0)]


def test_empty_report(report):
    empty = report.where("false")
    assert _rows(rp.run_stats(empty)) == [(0, 0, 0, 0, 0)]
    assert _rows(rp.feedback_distribution(empty)) == []
    assert [r.pct for r in rp.completeness(empty).collect()] == [None, None, None]
    assert _rows(rp.answer_vocabulary(empty)) == [(0, 0)]


def test_value_distribution_reads_once_and_has_no_task_of_all_values(spark, tmp_path):
    spark.range(20_000).select((F.col("id") % 7000).cast("string").alias("v")).write.parquet(str(tmp_path / "t"))
    found = rp.value_distribution(spark.read.parquet(str(tmp_path / "t")), "v", places=3)
    assert {(r.n, r.pct) for r in found.collect()} == {(3, 0.015), (2, 0.01)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final or final.count("FileScan") == 1, plan
    assert rp.value_distribution(spark.createDataFrame([], "v string"), "v").collect() == []


def test_report_in_blocks_equals_report(spark):
    items = _random_items(spark, 7, users=30, rows=600, hot=0.4).cache()
    wanted = sorted(map(tuple, ur.user_report(items, as_of="2025-08-31").collect()))
    for block_bytes in (1, 60, 2000, 1 << 30):
        found = ur.user_report_in_blocks(items, limits={"as_of": "2025-08-31"}, block_bytes=block_bytes)
        assert sorted(map(tuple, found.collect())) == wanted


def test_blocks_hold_no_more_than_their_bound(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").alias("i"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("t"))
    rows = rows.withColumn("size", F.octet_length("t").cast("bigint"))
    joined = ro.concat_in_blocks(rows, "k", ("t",), ("i",), "size", "|", block_bytes=100)
    wanted = {}
    for r in sorted(rows.collect(), key=lambda r: r.i):
        wanted.setdefault(r.k, []).extend([r.t] if r.t else [])
    assert {r.k: r.t for r in joined.collect()} == {k: "|".join(v) for k, v in wanted.items()}
    # The step before the last has many blocks of the hot key, each below the bound and one row.
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate") == 2 and "_block" in plan


def test_oversized_user_is_refused_before_text_moves(spark):
    items = _random_items(spark, 4)
    with pytest.raises(ValueError, match="a row holds at most 50"):
        ur.user_report_in_blocks(items, limits={"as_of": "2025-08-31"}, row_bytes=50)


def test_message_report(spark):
    items = _items(spark, [
        ("USER#A", "CONVERSATION#1", None, None, '[{"from":"user","text":"bot bot"},{"from":"bot","text":"x"}]', None),
        ("A", "CONVERSATION#2", None, None, '[{"from":"user","text":"a | b"}]', None),
        ("USER#A", "CONVERSATION#3", None, None, None, None),
        ("USER#A", "FEEDBACK#1", None, None, "[]", "f"), ("USER#A", "Register#1", None, None, "hola", None),
        ("USER#B", "PROFILE", None, None, None, None), (None, "CONVERSATION#4", None, None, "hola", None),
    ])
    got = {r.usuario_id: tuple(r)[1:] for r in mr.message_report(items).collect()}
    assert got == {"A": (3, 3, 2, 1, 0, 2, 0), None: (1, 1, 0, 0, 1, 1, 0)}
    assert mr.message_report(items.limit(0)).count() == 0


def test_the_message_report_shuffles_no_text(spark):
    items = _items(spark, [("USER#A", "CONVERSATION#1", None, None, "hola", None)])
    plan = mr.message_report(items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
