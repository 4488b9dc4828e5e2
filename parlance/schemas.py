"""Explicit schemas of the inputs and outputs."""

from pyspark.sql import types as T

ITEMS = T.StructType([
    T.StructField("PK", T.StringType()),
    T.StructField("SK", T.StringType()),
    T.StructField("UserData", T.StringType()),
    T.StructField("CreatedAt", T.StringType()),
    T.StructField("Conversation", T.StringType()),
    T.StructField("Feedback", T.StringType()),
])

MESSAGE_ITEMS = T.StructType([
    T.StructField("PK", T.StringType()),
    T.StructField("SK", T.StringType()),
    T.StructField("CreateTime", T.StringType()),
    T.StructField("MessageMap", T.StringType()),
    T.StructField("TotalPrice", T.DoubleType()),
])

USER_REPORT = T.StructType([
    T.StructField("usuario_id", T.StringType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("gerencia", T.StringType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("fecha_primera_conversacion", T.StringType()),
    T.StructField("numero_conversaciones", T.LongType()),
    T.StructField("conversacion_completa", T.StringType()),
    T.StructField("feedback_total", T.StringType()),
    T.StructField("numero_feedback", T.LongType()),
    T.StructField("pregunta_conversacion", T.StringType()),
    T.StructField("feedback", T.StringType()),
    T.StructField("respuesta_feedback", T.StringType()),
])

# Every report column as text, the way a CSV scan sees it.
REPORT_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in USER_REPORT])

TYPED_REPORT = T.StructType([
    T.StructField("usuario_id", T.StringType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("gerencia", T.StringType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("fecha_primera_conversacion", T.DateType()),
    T.StructField("numero_conversaciones", T.IntegerType()),
    T.StructField("conversacion_completa", T.StringType()),
    T.StructField("feedback_total", T.StringType()),
    T.StructField("numero_feedback", T.IntegerType()),
    T.StructField("pregunta_conversacion", T.StringType()),
    T.StructField("feedback", T.StringType()),
    T.StructField("respuesta_feedback", T.StringType()),
    T.StructField("token_pregunta", T.IntegerType()),
    T.StructField("token_respuesta", T.IntegerType()),
])

TOKEN_TABLE = T.StructType([
    T.StructField("create_date", T.StringType()),
    T.StructField("input_token", T.IntegerType()),
    T.StructField("output_token", T.IntegerType()),
    T.StructField("precio_token_input", T.DoubleType()),
    T.StructField("precio_token_output", T.DoubleType()),
    T.StructField("total_price", T.DoubleType()),
    T.StructField("pk", T.StringType()),
    T.StructField("sk", T.StringType()),
])
