from pyspark.sql import functions as F

from parlance import fixed_values as V, schemas
from parlance.functions import convert as cv, tokens as tk
from parlance.operators.items import with_any_tokens
from parlance.plans import token_costs as tc
from parlance.session import new_folder
from parlance.sources import catalog, writers

FIRST, LAST = 1754265600000, 1757548799999  # 2025-08-04 to 2025-09-10


def _tokens(c):
    read = tk.read_message_map(c)
    counted = tc.count_tokens(read["value"])
    return F.concat_ws(" ", read["parse_status"], counted["input_token"], counted["output_token"])


def test_message_maps(evaluate):
    cases = {
        '{"system":{"content":[{"body":"abcdefgh"}]},"m":{"role":"assistant","content":"hello"},"l":[{"role":"user","content":"zzzzzzzzzzzz"}]}': "valid 2 1",
        '{"m":{"content":"x"},"l":[{"role":"user","body":"zzzzzzzzzzzz"}]}': "valid 3 0",
        '{"system":{"content":[]},"l":[{"role":"bot","body":"zzzzzzzzzzzz"}]}': "valid 0 3",
        '{"k":3}': "valid 1 1",
        '{"m": {"role":"user","content":[{"body": ", "file_name": null}]}}': "repaired 1 1",
        "{}": "valid 0 0",
        '"{""m"": {""role"": ""user"", ""content"": ""abcdefgh""}}"': "repaired 2 0",
        '{""""m"""": {""role"": ""user"", ""content"": ""abcdefgh""}}': "repaired 2 0",
        'xx {"m":{"role":"user","content":"abcdefgh"}} yy': "cut 2 0",
        "zzz": "unreadable 0 0",
        '"hello world"': "valid 2 0",
        "[1]": "valid 1 1",
        '{"m":{"role":null,"content":"abcdefgh"}}': "valid 1 1",
        '{"user":{"content":"abcdefgh"},"user":{"content":"abcd"}}': "valid 1 0",
        '{"m":{"role":"user","content":[{"body":5},{"body":"abcd"},"x"]}}': "valid 1 0",
        '{"m":{"role":"used_chunks","content":"abcdefgh"},"n":{"role":"other","content":"abcdefgh"}}': "valid 2 0",
        '{"M":{"a":{"M":{"role":{"S":"user"},"content":{"L":[{"M":{"body":{"S":"abcdefgh"}}}]}}},"b":{"M":{"role":{"S":"bot"},"content":{"S":"abcd"}}}}}': "valid 2 1",
    }
    assert dict(zip(cases, evaluate(_tokens, *cases))) == cases
    assert evaluate(_tokens, None, " ") == ["missing 0 0", "missing 0 0"]


def test_valid_text_is_never_repaired(evaluate):
    # An empty body before a brace, and the word null as text, stay as they are.
    body = lambda c: F.to_json(tk.read_message_map(c)["value"])
    text = '{"m":{"content":[{"body":""}],"role":"user"},"n":{"content":"null","role":"user"}}'
    assert evaluate(body, text) == [text]


def test_epochs(evaluate):
    texts = ["1754265600000", " 1754265600000 ", "0", "x", None, "", "12.5", "99999999999999999", "9" * 22, "9" * 40, "-1"]
    assert evaluate(cv.epoch_label, *texts) == [
        "2025-08-04 00:00:00", "2025-08-04 00:00:00", "", "Fecha inválida", "", "", "Fecha inválida", "Fecha inválida",
        "Error", "Error", "1969-12-31 23:59:59",
    ]
    assert evaluate(cv.epoch_status, *texts) == [
        "ok", "ok", "missing", "invalid", "missing", "missing", "invalid", "invalid", "error", "error", "ok",
    ]


def test_prices(spark):
    rows = spark.range(1, 3000).select("id", *[
        cv.token_price(F.col("id"), r).cast("double").alias(n) for n, r in (("i", V.INPUT_RATE), ("o", V.OUTPUT_RATE))
    ]).collect()
    assert all(r.i == round(r.id * 0.003 / 1000, 6) and r.o == round(r.id * 0.015 / 1000, 6) for r in rows)


def _items(spark):
    message = '{"m":{"role":"user","content":"abcdefgh"},"n":{"role":"bot","content":"abcd"}}'
    return spark.createDataFrame([
        ("a", "1", str(FIRST), message, None),
        ("a", "2", str(FIRST - 1), message, None),
        ("b", "1", None, None, 1.25),
        ("b", "2", "x", "broken", 9.0),
        ("c", None, "9" * 30, message, None),
        (None, "5", str(LAST), '{"k":1}', None),
    ], schemas.MESSAGE_ITEMS)


def test_token_table(spark):
    rows = {(r.pk, r.sk): r for r in tc.priced_items(_items(spark), FIRST, LAST).collect()}
    assert len(rows) == 5 and ("a", "2") not in rows
    ok = rows["a", "1"]
    assert tuple(ok)[:6] == ("2025-08-04 00:00:00", 2, 1, 0.000006, 0.000015, 0.000021)
    assert tuple(rows["b", "1"])[:6] == ("", 0, 0, 0.0, 0.0, 1.25)
    assert tuple(rows["b", "2"])[:6] == ("Fecha inválida", 0, 0, 0.0, 0.0, 0.0)
    failed = rows["c", ""]
    assert tuple(failed)[:6] == ("Error", 0, 0, 0.0, 0.0, 0.0) and failed.status == "error"
    assert rows["", "5"].input_token == rows["", "5"].output_token == 1


def test_counters_add_up(spark):
    items = _items(spark)
    counts = tc.run_counters(items, FIRST, LAST).first().asDict()
    assert counts == {"processed_count": 4, "filtered_count": 1, "error_count": 1}
    assert sum(counts.values()) == items.count()


def test_totals(spark):
    tokens = tc.token_table(_items(spark), FIRST, LAST)
    totals = tc.token_totals(tokens).first()
    assert (totals.total_records, totals.total_input_tokens, totals.total_output_tokens) == (5, 3, 2)
    assert totals.total_tokens == totals.total_input_tokens + totals.total_output_tokens
    assert totals.total_cost == round(1.25 + 0.000021 + 0.000018, 6)
    assert totals.average_input_tokens == 0.6
    empty = tc.token_totals(tokens.where("false")).first()
    assert set(empty.asDict().values()) == {0}


def test_placeholder(spark):
    tokens = tc.token_table(_items(spark), FIRST, LAST)
    assert tc.or_placeholder(tokens, "2025-09-10 00:00:00").count() == 5
    row = tc.or_placeholder(tokens.where("pk = 'zz'"), "2025-09-10 00:00:00").collect()
    assert [tuple(r) for r in row] == [("2025-09-10 00:00:00", 0, 0, 0.0, 0.0, 0.0, "sin_datos", "sin_datos")]


def test_view(spark):
    view = tc.by_total_tokens(tc.token_view(tc.token_table(_items(spark), FIRST, LAST), "test_view"))
    assert view.columns == [
        "create_date", "token pregunta", "token respuesta", "total tokens", "precio total pregunta",
        "precio total respuesta", "precio total",
    ]
    assert [r["total tokens"] for r in view.collect()] == [3, 2]


def test_rows_with_tokens(spark):
    tokens = tc.token_table(_items(spark), FIRST, LAST)
    assert sorted(r.pk for r in with_any_tokens(tokens).collect()) == ["", "a"]


def test_stored_view(spark):
    path = writers.write_parquet(tc.token_table(_items(spark), FIRST, LAST), new_folder(spark, "tokens"))
    catalog.register_table(spark, V.TOKEN_TABLE_NAME, path)
    spark.sql(tc.token_view_sql())
    spark.sql(tc.token_view_sql())  # again: it is replaced
    assert spark.table(V.TOKEN_VIEW_NAME).count() == 2
    spark.sql(f"DROP VIEW {V.TOKEN_VIEW_NAME}")


def test_maps_are_parsed_once(spark):
    # A filter on the counts must not pull the parsing below itself.
    tokens = tc.token_table(_items(spark), FIRST, LAST).where("input_token > 0")
    plan = tokens._jdf.queryExecution().optimizedPlan().toString()
    # One per step of reading a map, and in two of them the keys and values of a map too large to be read whole.
    assert plan.count("parseJson") == 4 + 2 * 2


def test_placeholder_of_a_written_table_reads_the_items_once(spark):
    from workload.queries import REGISTRY

    plan = REGISTRY["filled_placeholder"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "conversations" not in plan and "parseJson" not in plan
