from datetime import date, datetime

from pyspark.sql import functions as F

from parlance.functions import convert as cv
from parlance.operators import items as it
from parlance.plans import typed_report as ty


def test_dates(evaluate):
    assert evaluate(cv.parse_date, "2025-08-04", "04/08/2025", "1/2/2025", "Sin fecha", "", None, "31/02/2025", "2025-08-04 10:00:00") == [
        date(2025, 8, 4), date(2025, 8, 4), date(2025, 1, 2), None, None, None, None, date(2025, 8, 4),
    ]


def test_numbers(evaluate):
    assert evaluate(cv.parse_integer, "0", "", "7", "x", None, "99999999999") == [None, None, 7, None, None, None]
    assert evaluate(cv.parse_double, "", "1.5", "x", None, "0") == [None, 1.5, None, None, 0.0]
    assert evaluate(cv.parse_timestamp, "", "2025-01-02 03:04:05", "x", None) == [None, datetime(2025, 1, 2, 3, 4, 5), None, None]


def test_days_keep_the_written_date(evaluate):
    assert evaluate(cv.to_day, "2025-08-04T23:30:00-05:00", "2025-08-04T10:00:00.123Z", "2025-08-04", "zz", None) == [
        date(2025, 8, 4), date(2025, 8, 4), date(2025, 8, 4), None, None,
    ]
    assert evaluate(lambda c: cv.to_day(c, ("dd/MM/yyyy",)), "04/08/2025") == [date(2025, 8, 4)]


def test_date_label(evaluate):
    assert evaluate(lambda c: cv.date_label(c.cast("date")), "2025-08-04", None) == ["04/08/2025", "Sin fecha"]


def test_domain(evaluate):
    assert evaluate(cv.in_domain, " LIKE ", "zz", None, "mixed") == ["like", None, None, "mixed"]
    assert evaluate(lambda c: cv.only_with(F.lit("r"), c), " LIKE ", "zz") == ["r", None]


def test_places(spark):
    df = spark.createDataFrame([("POTOSÍ",), ("Calidad",), ("Bogotá",), (None,), ("Nuevo México",), ("mexico df",)], "gerencia string")
    assert [r[0] for r in it.exclude_places(df).collect()] == ["Bogotá", None, "Nuevo México"]
    assert [r[0] for r in it.exclude_places(df, whole_words=True).collect()] == ["Calidad", "Bogotá", None, "Nuevo México"]


def test_day_range(spark):
    df = spark.createDataFrame([("2025-08-03",), ("2025-08-04",), ("zz",), (None,), ("2025-09-02",)], "d string")
    kept = df.where(it.in_day_range(cv.to_day(F.col("d")), "2025-08-04", "2025-09-01"))
    assert [r.d for r in kept.collect()] == ["2025-08-04", "zz", None]
    open_end = df.where(it.in_day_range(cv.to_day(F.col("d")), "2025-08-04", None))
    assert [r.d for r in open_end.collect()] == ["2025-08-04", "zz", None, "2025-09-02"]


def test_column_types(spark):
    df = spark.createDataFrame(
        [("0", " Like ", "r", "04/08/2025", "x"), ("3", "no", "s", "Sin fecha", "y")],
        "Numero_Feedback string, feedback string, respuesta_feedback string, fecha_primera_conversacion string, otra string",
    )
    out = ty.convert_columns(df)
    assert out.dtypes == [
        ("Numero_Feedback", "int"), ("feedback", "string"), ("respuesta_feedback", "string"),
        ("fecha_primera_conversacion", "date"), ("otra", "string"),
    ]
    assert [tuple(r) for r in out.collect()] == [(None, "like", "r", date(2025, 8, 4), "x"), (3, None, None, None, "y")]


def test_token_columns(spark):
    df = spark.createDataFrame([("user: hola | bot: adiós",)], "conversacion_completa string")
    assert tuple(ty.token_columns(df).first())[1:] == (1, 1)
    missing = ty.token_columns(df.select(F.lit("x").alias("a")))
    assert missing.dtypes[1:] == [("token_pregunta", "int"), ("token_respuesta", "int")]
    assert tuple(missing.first()) == ("x", None, None)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, `b c` string")
    assert [tuple(r) for r in ty.null_profile(df).collect()] == [("a", "int", 2, 1), ("b c", "string", 1, 2)]
