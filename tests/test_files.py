import threading
import pytest
from pyspark.sql import functions as F

from parlance import schemas
from parlance.operators import reports as rp
from parlance.operators.reports import run_stats
from parlance.plans import jobs
from parlance.plans.token_costs import token_table
from parlance.plans.typed_report import null_profile, typed_report
from parlance.plans.user_report import user_report
from parlance.session import new_folder
from parlance.sources import catalog, readers, writers
from parlance.streaming import refresh as rf


def _report(spark, users):
    rows = [
        (u, "Ana \"la\" 1", "Bogotá", "Bogotá", "04/08/2025", n, 'user: a,\n"b" | bot: c', "{'type': 'like'}", 1, "a", "like", "x\ny")
        for n, u in enumerate(users)
    ]
    return spark.createDataFrame(rows, schemas.USER_REPORT)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_round_trip(spark):
    report = _report(spark, ["u1", "u2"]).withColumn("nombre", F.when(F.col("usuario_id") == "u1", F.col("nombre")).otherwise(""))
    path = writers.write_csv(report, new_folder(spark, "csv"))
    back = readers.read_report_csv(spark, path)
    expected = report.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in report.columns])
    assert _sorted(back) == _sorted(expected)
    assert readers.read_csv(spark, path).columns == report.columns


def test_export_formats(spark):
    items = spark.createDataFrame([("USER#1", "CONVERSATION#1", '{"nombre": "a"}', None, '[{"x": "\\n"}]', None)], schemas.ITEMS)
    as_json = readers.read_items(spark, writers.write_json(items, new_folder(spark, "items")))
    as_parquet = readers.read_items(spark, writers.write_parquet(items, new_folder(spark, "items")), "parquet")
    as_csv = readers.read_items_csv(spark, writers.write_csv(items, new_folder(spark, "items")))
    assert _sorted(as_json) == _sorted(as_parquet) == _sorted(as_csv) == _sorted(items)


def test_enveloped_exports(spark, tmp_path):
    items = tmp_path / "items.json"
    items.write_text(
        '{"Item": {"PK": {"S": "USER#1"}, "SK": {"S": "CONVERSATION#1"}, "CreatedAt": {"S": "2025-08-10"}, '
        '"UserData": {"M": {"nombre": {"S": "Ana"}}}, '
        '"Conversation": {"L": [{"M": {"from": {"S": "user"}, "text": {"S": "hola"}}}]}}}\n'
        '{"Item": {"PK": {"S": "USER#1"}, "SK": {"S": "FEEDBACK#1"}, '
        '"Feedback": {"L": [{"M": {"type": {"S": "like"}}}]}}}\n'
        '{"Item": {"PK": {"S": "USER#2"}, "SK": {"S": "CONVERSATION#1"}, "CreatedAt": {"NULL": true}, '
        '"UserData": {"S": "{\\"nombre\\": \\"Eva\\"}"}, "Conversation": {"S": "bot: hola"}}}\n'
    )
    report = user_report(readers.read_enveloped_items(spark, str(items)), as_of="2025-08-31")
    rows = {r.usuario_id: r for r in report.collect()}
    assert (rows["1"].nombre, rows["1"].conversacion_completa, rows["1"].feedback) == ("Ana", "user: hola", "like")
    assert (rows["2"].nombre, rows["2"].conversacion_completa) == ("Eva", "bot: hola")
    assert rows["2"].fecha_primera_conversacion == "Sin fecha"
    messages = tmp_path / "messages.json"
    messages.write_text(
        '{"Item": {"PK": {"S": "a"}, "SK": {"S": "1"}, "CreateTime": {"N": "1754265600000"}, "MessageMap": '
        '{"M": {"x": {"M": {"role": {"S": "user"}, "content": {"S": "abcdefgh"}}}}}}}\n'
        '{"Item": {"PK": {"S": "a"}, "SK": {"S": "2"}, "TotalPrice": {"N": "1.5"}}}\n'
        '{"Item": {"PK": {"S": "a"}, "SK": {"S": "3"}, "MessageMap": {"S": "{\\"x\\": {\\"role\\": \\"bot\\", \\"content\\": \\"abcd\\"}}"}}}\n'
    )
    tokens = token_table(readers.read_enveloped_message_items(spark, str(messages)), 0, 2 * 10**12)
    assert [(r.sk, r.input_token, r.output_token, r.total_price) for r in tokens.orderBy("sk").collect()] == [
        ("1", 2, 0, 0.000006), ("2", 0, 0, 1.5), ("3", 0, 1, 0.000015),
    ]


def test_overwrite_and_single_file(spark):
    path = new_folder(spark, "out")
    writers.write_parquet(spark.range(100).repartition(5), path)
    writers.write_parquet(spark.range(10).repartition(5), path, single_file=True)
    back = spark.read.parquet(path)
    assert back.count() == 10 and len(back.inputFiles()) == 1


def test_partitioned_output_prunes(spark):
    path = writers.write_parquet(
        spark.range(10).withColumn("d", F.col("id") % 2), new_folder(spark, "out"), partition_by=("d",)
    )
    back = spark.read.parquet(path).where("d = 1")
    assert back.count() == 5 and "PartitionFilters: [isnotnull(d" in back._jdf.queryExecution().executedPlan().toString()


def test_verified_write(spark):
    check = writers.write_verified_parquet(typed_report(readers.read_report_csv(
        spark, writers.write_csv(_report(spark, ["u1", "u2", "u3"]), new_folder(spark, "csv"))
    )), new_folder(spark, "typed"))
    rows = check.collect()
    assert [r.columna for r in rows] == schemas.TYPED_REPORT.names
    assert {(r.filas_escritas, r.filas_leidas, r.coincide) for r in rows} == {(3, 3, True)}
    wrong = writers.verify_parquet(spark, writers.write_parquet(spark.range(2), new_folder(spark, "x")), 3, spark.range(1).schema)
    assert [r.coincide for r in wrong.collect()] == [False]


def test_jobs(spark, small):
    from workload import adapters as ad

    csv, typed, tokens = (new_folder(spark, n) for n in ("job-report", "job-typed", "job-tokens"))
    items = ad.items(spark, small)
    stats = jobs.report_job(items, csv, "2025-09-10").first()
    report = user_report(items, as_of="2025-09-10")
    assert stats.usuarios_procesados == report.count() > 0
    assert stats == run_stats(report).first()
    check = jobs.typed_job(spark, csv, typed, "job_report").collect()
    assert all(r.coincide for r in check) and len(check) == 14
    assert spark.table("job_report").count() == stats.usuarios_procesados
    stored = spark.read.parquet(typed)
    statistics = jobs.statistics_job(spark, typed, new_folder(spark, "job-statistics"))
    for name, expected in {
        "run_stats": rp.run_stats(stored), "feedback_distribution": rp.feedback_distribution(stored),
        "conversation_buckets": rp.conversation_buckets(stored), "completeness": rp.completeness(stored),
        "answer_shape": rp.answer_shape(stored), "coherence": rp.coherence(stored),
        "validation_report": rp.validation_report(stored), "kpis": rp.kpis(stored), "top_answers": rp.top_answers(stored),
        "null_profile": null_profile(stored), "feedback_histogram": rp.feedback_histogram(stored),
        "duplicate_check": rp.duplicate_check(stored), "answer_vocabulary": rp.answer_vocabulary(stored),
    }.items():
        assert _sorted(statistics[name]) == _sorted(expected), name
    plan = rp.summary(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "conversacion_completa" not in plan.split("ReadSchema")[1]
    messages = ad.message_items(spark, small)
    totals = jobs.token_job(messages, tokens, "2025-09-10", table="job_tokens", view="job_view").first()
    expected = token_table(messages, *jobs.day_range_ms("2025-08-04", "2025-09-10"))
    assert totals.total_records == totals.processed_count + totals.error_count == expected.count()
    assert totals.error_count == expected.where("create_date = 'Error'").count() > 0
    assert _sorted(spark.table("job_tokens")) == _sorted(expected)
    assert spark.table("job_view").count() == expected.where("input_token + output_token > 0").count()
    empty = jobs.token_job(messages.where("false"), tokens, "2025-09-10", table="job_tokens", view="job_view").first()
    assert empty.total_records == 0
    assert [r.pk for r in readers.read_csv(spark, f"{tokens}/csv", schemas.TOKEN_TABLE).collect()] == ["sin_datos"]
    spark.sql("DROP VIEW job_view")


def test_catalog(spark):
    path = new_folder(spark, "table")
    writers.write_parquet(spark.range(3), path)
    assert catalog.register_table(spark, "parlance_test", path).count() == 3
    writers.write_parquet(spark.range(4).withColumn("x", F.lit("a")), path)
    table = catalog.register_table(spark, "parlance_test", path)
    assert table.columns == ["id", "x"] and table.count() == 4
    listing = [tuple(r) for r in catalog.column_listing(spark).where("table_name = 'parlance_test'").collect()]
    assert listing == [("parlance_test", "id", "bigint", True, 1), ("parlance_test", "x", "string", True, 2)]


def test_a_reader_never_misses_the_table_while_columns_are_added(spark):
    def written(columns):
        return writers.write_parquet(
            spark.range(3).select("id", *[F.lit(i).alias(f"c{i}") for i in range(columns)]), new_folder(spark, "grown"))

    catalog.register_table(spark, "parlance_grown", written(0))
    failures, seen, done = [], set(), threading.Event()

    def read():
        while not done.is_set():
            try:
                table = spark.table("parlance_grown")
                seen.add(len(table.columns))
                assert table.count() == 3
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for columns in range(1, 6):
            assert catalog.register_table(spark, "parlance_grown", written(columns)).columns[1:] == [
                f"c{i}" for i in range(columns)]
    finally:
        done.set()
        reader.join()
    assert not failures and len(seen) > 1
    assert [r["c4"] for r in spark.table("parlance_grown").collect()] == [4, 4, 4]
    # Gone and changed columns: the table has the columns of its files.
    assert catalog.register_table(spark, "parlance_grown", written(1)).columns == ["id", "c0"]
    spark.sql("DROP TABLE parlance_grown")


def test_catalog_replaces_in_place_and_refuses_managed_tables(spark):
    first, second = (writers.write_parquet(spark.range(n), new_folder(spark, "it's a table")) for n in (3, 5))
    assert catalog.register_table(spark, "default.parlance_place", first).count() == 3
    assert catalog.register_table(spark, "default.parlance_place", second).count() == 5
    spark.range(2).write.mode("overwrite").saveAsTable("parlance_managed")
    with pytest.raises(ValueError, match="not an external table"):
        catalog.register_table(spark, "parlance_managed", first)
    assert spark.table("parlance_managed").count() == 2
    spark.sql("DROP TABLE parlance_managed")


def test_stream_equals_batch(spark):
    landing, target, progress = (new_folder(spark, n) for n in ("landing", "target", "progress"))
    writers.write_csv(_report(spark, ["u1", "u2"]).repartition(2), f"{landing}/a")
    calls = []
    rf.refresh(spark, f"{landing}/*", target, progress, max_files=1, then=lambda: calls.append(1))
    batch = typed_report(readers.read_report_csv(spark, f"{landing}/*"))
    assert _sorted(rf.read_refreshed(spark, target).drop("lote", "archivo", "llegada")) == _sorted(batch)
    assert len(calls) >= 1
    # Nothing new: nothing changes. A new file: only its rows are added.
    rf.refresh(spark, f"{landing}/*", target, progress)
    assert rf.read_refreshed(spark, target).count() == 2
    newer = _report(spark, ["u2", "u3"]).withColumn("nombre", F.lit("Eva"))
    writers.write_csv(newer, f"{landing}/b")
    rf.refresh(spark, f"{landing}/*", target, progress)
    assert rf.read_refreshed(spark, target).count() == 4
    latest = {r.usuario_id: r.nombre for r in rf.latest_per_user(rf.read_refreshed(spark, target)).collect()}
    assert latest == {"u1": 'Ana "la" 1', "u2": "Eva", "u3": "Eva"}
    # A lost checkpoint reads all files again, into new folders; the latest rows stay right.
    again = new_folder(spark, "progress")
    rf.refresh(spark, f"{landing}/*", target, again, max_files=1, view="parlance_refresh_test")
    assert rf.first_batch(spark, target, again) > rf.first_batch(spark, target, progress) == 0
    assert rf.read_refreshed(spark, target).count() == 8
    assert rf.latest_per_user(spark.table("parlance_refresh_test")).count() == 3
    last = _report(spark, ["u1"]).withColumn("nombre", F.lit("Sol"))
    writers.write_csv(last, f"{landing}/c")
    rf.refresh(spark, f"{landing}/*", target, again, view="parlance_refresh_test")
    assert spark.table("parlance_refresh_test").count() == 9
    latest = {r.usuario_id: r.nombre for r in rf.latest_per_user(spark.table("parlance_refresh_test")).collect()}
    assert latest["u1"] == "Sol" and len(latest) == 3
    spark.sql("DROP VIEW parlance_refresh_test")


def test_latest_rows_of_a_batch_with_two_files(spark):
    rows = _report(spark, ["u1"])
    landing, target = new_folder(spark, "landing"), new_folder(spark, "target")
    writers.write_csv(rows, f"{landing}/a")
    writers.write_csv(rows.withColumn("nombre", F.lit("Eva")), f"{landing}/b")
    rf.refresh(spark, f"{landing}/*", target, new_folder(spark, "progress"))
    latest = rf.latest_per_user(rf.read_refreshed(spark, target)).collect()
    assert [(r.usuario_id, r.nombre) for r in latest] == [("u1", "Eva")]


def test_batch_rerun_does_not_double(spark):
    target = new_folder(spark, "target")
    batch = _report(spark, ["u1"]).select(*[F.col(c).cast("string") for c in schemas.USER_REPORT.names])
    write = rf.write_batch(target)
    write(batch, 7)
    write(batch, 7)
    assert rf.read_refreshed(spark, target).count() == 1
