"""SQL twins of the registered queries, for DuckDB.

They compute from the long tables (conversations, labels, customer, events,
documents, orders, lineitem), never from the generated cells, so they check the
parsing as well as the arithmetic.
"""

from __future__ import annotations

from parlance import fixed_values as V
from workload.adapters import RULE_PHRASES
from workload.queries import AS_OF, EVENT_FIRST_MS, EVENT_LAST_MS, FIRST_MS, LAST_MS, MODEL

_WS = "'" + V.WHITESPACE + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def _count(x: str, word: str) -> str:
    return f"((length({x}) - length(replace({x}, '{word}', ''))) // {len(word)})"


def _distinct(x: str) -> str:
    return f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"


def _chars4(x: str) -> str:
    return f"(CASE WHEN coalesce(length({x}), 0) = 0 THEN 0 ELSE greatest(1, length({x}) // 4) END)::INTEGER"




def _class(characters: str) -> str:
    return "".join("\\" + c if c.isascii() else c for c in characters).replace("'", "''")


_PUNCT = f"[^{_class(V.PUNCTUATION)}]+"
_SPECIAL = rf"[^\p{{Nd}}{_class(V.SPECIAL)}²³¹⁰⁴-⁹₀-₉①-⑨]+"


def _estimate(x: str) -> str:
    factor = (
        f"(1 + (length({x}) - length(replace({x}, ' ', ''))) / length({x}) * 0.2::DOUBLE"
        f" + length(regexp_replace({x}, '{_PUNCT}', '', 'g')) / length({x}) * 0.15::DOUBLE"
        f" + length(regexp_replace({x}, '{_SPECIAL}', '', 'g')) / length({x}) * 0.1::DOUBLE)"
    )
    return (
        f"(CASE WHEN coalesce(length({x}), 0) = 0 THEN 0 "
        f"ELSE greatest(1, floor(length({x}) / 3.8::DOUBLE * {factor})::INTEGER) END)::INTEGER"
    )


def _half_up(numerator: str, denominator: str, places: int) -> str:
    """Exact half-up rounding of a ratio of non-negative integers."""
    scale = 10**places
    return (
        f"((({numerator})::HUGEINT * {2 * scale} + ({denominator})) // (2 * ({denominator})))::DOUBLE / {scale}"
    )


# --- building blocks ------------------------------------------------------------------------

_LINES = f"""
line AS (
  SELECT conv_id, conv_id // 3 AS u, turn, role, text,
         {_strip(f"replace(replace({_strip('text')}, chr(10) || chr(10), ' '), chr(10), ' ')")} AS clean
  FROM conversations
),
talk AS (
  SELECT conv_id, u,
         'USER#' || u AS PK,
         'CONVERSATION#' || lpad(conv_id::VARCHAR, 10, '0') AS SK,
         string_agg(CASE role WHEN 'assistant' THEN 'bot' ELSE role END || ': ' || clean, ' | ' ORDER BY turn) AS t,
         coalesce(list(clean ORDER BY turn) FILTER (WHERE role = 'user' AND clean <> ''), []::VARCHAR[]) AS qs,
         coalesce(list(clean ORDER BY turn) FILTER (WHERE role = 'assistant' AND clean <> ''), []::VARCHAR[]) AS bs,
         CASE WHEN conv_id % 11 <> 0 THEN DATE '2025-07-25' + (conv_id % 60)::INTEGER END AS dia
  FROM line GROUP BY conv_id, u
),
talked AS (
  SELECT *, greatest({_count('t', 'bot')}, {_count('t', 'user')}, 1) AS n,
         array_to_string({_distinct('qs')}, ' | ') AS q
  FROM talk
)"""

_PROFILES = f"""
profile AS (
  SELECT u, 'USER#' || u AS PK,
         CASE WHEN u % 7 = 0 THEN '' ELSE ' ' || coalesce(c_name, '') END AS raw_name,
         ['Bogotá', 'Bogotá (Norte)', 'Medellín', 'POTOSÍ', 'Tunja', '', 'Calidad', 'Chía (Centro)'][u % 8 + 1] AS raw_area,
         trim(raw_name) AS nombre, trim(split_part(raw_area, '(', 1)) AS ciudad,
         u % 8 IN (2, 3, 6) AS excluded
  FROM (SELECT DISTINCT conv_id // 3 AS u FROM conversations) LEFT JOIN customer ON c_custkey = u
)"""


def _feedback_object(kind: str) -> str:
    return (
        "('{' || q || 'comment' || q || ': ' || q || 'tema ' || (doc_id % 7) || q || ', ' || q || 'option' || q || ': '"
        " || q || 'opción ' || (doc_id % 4) || q || "
        f"CASE WHEN {kind} IS NULL THEN '' ELSE ', ' || q || 'type' || q || ': ' || q || {kind} || q END || '}}')"
    )


def _enveloped_object(kind: str) -> str:
    return (
        """('{"M":{"comment":{"S":"tema ' || (doc_id % 7) || '"},"option":{"S":"opción ' || (doc_id % 4) || '"}' || """
        f"""CASE WHEN {kind} IS NULL THEN '' ELSE ',"type":{{"S":"' || {kind} || '"}}' END || '}}}}')"""
    )


_FEEDBACK = f"""
label AS (
  SELECT doc_id, doc_id // 3 AS u, 'USER#' || (doc_id // 3) AS PK,
         'Feedback#' || lpad(doc_id::VARCHAR, 10, '0') AS SK, quality = 1 AS yes, toxic = 1 AS no,
         CASE WHEN doc_id % 5 <> 0 AND doc_id % 2 = 0 THEN chr(39) ELSE chr(34) END AS q
  FROM labels
),
fb AS (
  SELECT doc_id, u, PK, SK, yes, no,
         CASE WHEN yes AND no THEN '[' || {_feedback_object("'like'")} || ', ' || {_feedback_object("'dislike'")} || ']'
              WHEN yes THEN {_feedback_object("'like'")}
              WHEN no THEN {_feedback_object("'dislike'")}
              ELSE {_feedback_object("NULL")} END AS f,
         CASE WHEN yes AND no THEN {_feedback_object("'like'")} ELSE f END AS first_f,
         CASE WHEN doc_id % 5 <> 0 THEN f
              WHEN yes AND no THEN '{{"L":[' || {_enveloped_object("'like'")} || ',' || {_enveloped_object("'dislike'")} || ']}}'
              WHEN yes THEN {_enveloped_object("'like'")}
              WHEN no THEN {_enveloped_object("'dislike'")}
              ELSE {_enveloped_object("NULL")} END AS raw_f,
         greatest(yes::INTEGER + no::INTEGER, 1) AS n,
         CASE WHEN yes AND no THEN 'mixed' WHEN yes THEN 'like' WHEN no THEN 'dislike' ELSE '' END AS class,
         'tema ' || (doc_id % 7) AS comment, 'opción ' || (doc_id % 4) AS option
  FROM label
),
last_fb AS (
  SELECT u, arg_max(fb, doc_id) AS w FROM fb GROUP BY u
)"""

_OWN = "'{''type'': ''dislike'', ''comment'': \"d''accord\"}'"

_ROWS = f"""
rws AS (
  SELECT u, PK, SK, 0 AS o, t, n, q, dia, CASE WHEN dia IS NOT NULL THEN strftime(dia, '%Y-%m-%d') || 'T10:00:00.000Z' END AS created,
         NULL::VARCHAR AS own FROM talked
  UNION ALL
  SELECT u, PK, 'PROFILE', 1, '', 1, '', DATE '2025-09-01', '2025-09-01 08:30:00',
         CASE WHEN u % 5 = 0 THEN {_OWN} END FROM profile
),
kept AS (
  SELECT rws.*, coalesce(nullif(nombre, ''), '{V.ANONYMOUS_NAME}') AS nombre,
         coalesce(nullif(ciudad, ''), '{V.DEFAULT_AREA}') AS gerencia,
         coalesce(strftime(dia, '%d/%m/%Y'), '{V.NO_DATE}') AS fecha,
         CASE WHEN o = 0 THEN w.f ELSE own END AS f,
         CASE WHEN o = 0 THEN coalesce(w.n, 0) ELSE (own IS NOT NULL)::INTEGER END AS fn,
         CASE WHEN o = 0 THEN w.class WHEN own IS NOT NULL THEN 'dislike' END AS class,
         CASE WHEN o = 0 THEN w.comment END AS comment, CASE WHEN o = 0 THEN w.option END AS option,
         own IS NOT NULL AS has_own
  FROM rws JOIN profile USING (u) LEFT JOIN last_fb USING (u)
  WHERE NOT excluded AND (dia IS NULL OR dia BETWEEN DATE '{V.REPORT_START}' AND DATE '{AS_OF}')
)"""

_USER_REPORT = f"""
report AS (
  SELECT u::VARCHAR AS usuario_id, any_value(nombre) AS nombre, any_value(gerencia) AS gerencia,
         any_value(gerencia) AS ciudad, first(fecha ORDER BY o, SK) AS fecha_primera_conversacion,
         sum(n)::BIGINT AS numero_conversaciones,
         coalesce(string_agg(t, ' || ' ORDER BY o, SK) FILTER (WHERE t <> ''), '') AS conversacion_completa,
         coalesce(string_agg(f, ' || ' ORDER BY o, SK) FILTER (WHERE f <> ''), '') AS feedback_total,
         sum(fn)::BIGINT AS numero_feedback,
         coalesce(string_agg(q, ' || ' ORDER BY o, SK) FILTER (WHERE q <> ''), '') AS pregunta_conversacion,
         CASE WHEN count(DISTINCT nullif(class, '')) > 1 THEN 'mixed' ELSE coalesce(max(nullif(class, '')), '') END AS feedback,
         concat_ws(' | ', max(comment), CASE WHEN bool_or(has_own) THEN 'd''accord' END, max(option)) AS respuesta_feedback
  FROM kept GROUP BY u
)"""

_TYPED = f"""
typed AS (
  SELECT usuario_id, nullif(nombre, '') AS nombre, gerencia, ciudad,
         try_strptime(fecha_primera_conversacion, '%d/%m/%Y')::DATE AS fecha_primera_conversacion,
         numero_conversaciones::INTEGER AS numero_conversaciones,
         nullif(conversacion_completa, '') AS conversacion_completa,
         nullif(feedback_total, '') AS feedback_total, nullif(numero_feedback, 0)::INTEGER AS numero_feedback,
         nullif(pregunta_conversacion, '') AS pregunta_conversacion, nullif(feedback, '') AS feedback,
         CASE WHEN feedback <> '' THEN nullif(respuesta_feedback, '') END AS respuesta_feedback,
         token_pregunta, token_respuesta
  FROM report LEFT JOIN (
    SELECT u::VARCHAR AS usuario_id, sum(CASE WHEN role = 'user' THEN tokens ELSE 0 END)::INTEGER AS token_pregunta,
           sum(CASE WHEN role = 'assistant' THEN tokens ELSE 0 END)::INTEGER AS token_respuesta
    FROM (SELECT kept.u, role, {_estimate('clean')} AS tokens FROM kept
          JOIN line ON kept.o = 0 AND kept.SK = 'CONVERSATION#' || lpad(conv_id::VARCHAR, 10, '0'))
    GROUP BY u
  ) USING (usuario_id)
)"""
# A user without any conversation left has an empty transcript: no tokens.
_TYPED_SELECT = """
SELECT * REPLACE (coalesce(token_pregunta, 0) AS token_pregunta, coalesce(token_respuesta, 0) AS token_respuesta) FROM typed"""

_MESSAGES = f"""
item AS (
  SELECT conv_id, (conv_id // 3)::VARCHAR AS pk, conv_id::VARCHAR AS sk,
         sum(CASE WHEN role IN ('user', 'system') THEN {_chars4('text')} ELSE 0 END)::INTEGER AS i,
         sum(CASE WHEN role = 'assistant' THEN {_chars4('text')} ELSE 0 END)::INTEGER AS o,
         CASE WHEN conv_id % 19 = 0 THEN 'bad' WHEN conv_id % 13 = 5 THEN 'error' WHEN conv_id % 23 = 0 THEN 'none'
              ELSE 'ok' END AS clock,
         epoch_ms((DATE '2025-07-25' + (conv_id % 60)::INTEGER)::TIMESTAMP) + conv_id * 1000 AS ms,
         NULL::DOUBLE AS stored
  FROM conversations GROUP BY conv_id
  UNION ALL
  SELECT NULL, c_custkey::VARCHAR, 'silent', 0, 0, 'none', NULL, c_acctbal
  FROM customer WHERE c_custkey NOT IN (SELECT conv_id // 3 FROM conversations)
),
counted AS (
  SELECT * REPLACE (CASE WHEN clock = 'error' THEN 0 ELSE i END AS i, CASE WHEN clock = 'error' THEN 0 ELSE o END AS o)
  FROM item WHERE clock <> 'ok' OR ms BETWEEN {FIRST_MS} AND {LAST_MS}
),
tokens AS (
  SELECT CASE clock WHEN 'bad' THEN '{V.INVALID_DATE}' WHEN 'none' THEN '' WHEN 'error' THEN '{V.ERROR_DATE}'
              ELSE strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') END AS create_date,
         i AS input_token, o AS output_token,
         (i::BIGINT * 3)::DOUBLE / 1000000 AS precio_token_input, (o::BIGINT * 15)::DOUBLE / 1000000 AS precio_token_output,
         coalesce(stored, (i::BIGINT * 3 + o::BIGINT * 15)::DOUBLE / 1000000) AS total_price, pk, sk
  FROM counted
)"""

_EVENTS = """
event_time AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad' WHEN value < 1 THEN 'none' WHEN value > 100 THEN 'error' ELSE 'ok' END AS clock, epoch_us(ts) // 1000 AS ms
  FROM events
)"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + "\n"


_REPORT = _with(_LINES, _PROFILES, _FEEDBACK, _ROWS, _USER_REPORT)
_TYPED_REPORT = _with(_LINES, _PROFILES, _FEEDBACK, _ROWS, _USER_REPORT, _TYPED)
_TALKS = _with(_LINES)
_MESSAGES = """count(*) AS mensajes, count(*) FILTER (WHERE role = 'user') AS de_usuario,
               count(*) FILTER (WHERE role = 'assistant') AS de_bot,
               count(*) FILTER (WHERE role NOT IN ('user', 'assistant')) AS de_otros"""
# The rows with the stored conversation text, and without an end of the dates.
_RAW_ROWS = _with(_LINES, _PROFILES, _FEEDBACK, _ROWS, _ROWS.replace("kept AS", "kept_open AS").replace(
    f"BETWEEN DATE '{V.REPORT_START}' AND DATE '{AS_OF}'", f">= DATE '{V.REPORT_START}'"
).split("),\n", 1)[1], f"""
raw_talk AS (
  SELECT SK, to_json(list(struct_pack("from" := speaker, "text" := text) ORDER BY turn))::VARCHAR AS raw,
         coalesce(string_agg(trim(text, {_WS}), ' | ' ORDER BY turn) FILTER (WHERE speaker = 'user' AND trim(text, {_WS}) <> ''), '') AS raw_q
  FROM (SELECT *, 'CONVERSATION#' || lpad(conv_id::VARCHAR, 10, '0') AS SK,
               CASE WHEN role = 'user' AND conv_id % 2 = 1 THEN 'USUARIO'
                    WHEN role = 'assistant' AND conv_id % 2 = 1 THEN 'Bot' ELSE role END AS speaker FROM line)
  GROUP BY SK
)""")
_ALL_ROWS = _with(_LINES, _PROFILES, _FEEDBACK, _ROWS)
_TOKENS = _with(_MESSAGES)
_SPLIT_ANSWERS = "SELECT unnest(string_split(respuesta_feedback, ' | ')) AS respuesta FROM report WHERE respuesta_feedback <> ''"
_REPORT_COLUMNS = ", ".join(V.REPORT_COLUMNS)
_TOKEN_SUMS = "count(*) AS n, sum(input_token + output_token)::BIGINT AS tokens, sum(total_price::DECIMAL(24, 6))::DOUBLE AS costo"
_ALL_KEYS = """
keys AS (
  SELECT PK, SK FROM talk UNION ALL SELECT PK, SK FROM fb UNION ALL SELECT PK, 'PROFILE' FROM profile
)"""
_IMPLIED = "CASE WHEN length(" + _strip("text") + ") < 10 THEN '' " + " ".join(
    f"WHEN regexp_matches(lower(text), '{p.replace(chr(92) + 'w', chr(92) + 'p{L}' + chr(92) + 'p{N}_')}') THEN '{q.replace('{}', '')}'"
    for p, q in V.IMPLIED_QUESTIONS
) + " ELSE '' END"


def _distribution(source: str, value: str, places: int) -> str:
    return (
        f"SELECT valor, n, {_half_up('100 * n', 'total', places)} AS pct FROM "
        f"(SELECT {value} AS valor, count(*) AS n, (SELECT count(*) FROM {source}) AS total FROM {source} GROUP BY 1)"
    )


def _columns_as_rows(columns: list[tuple[str, str]], select: str) -> str:
    return " UNION ALL ".join(select.format(i=i, name=name, kind=kind) for i, (name, kind) in enumerate(columns, 1))


_TYPED_COLUMNS = [(c, {"date": "date", "integer": "int", "string": "string"}[V.REPORT_TYPES[c]])
                  for c in (*V.REPORT_COLUMNS, "token_pregunta", "token_respuesta")]

ORACLES: dict[str, str] = {
    # text
    "transcript": _TALKS + "SELECT SK, t AS conversacion_completa FROM talked",
    "conversation_messages": f"""
        SELECT (conv_id // 3)::VARCHAR AS usuario_id, 'CONVERSATION#' || lpad(conv_id::VARCHAR, 10, '0') AS SK, {_MESSAGES}
        FROM conversations GROUP BY conv_id""",
    "message_report": f"""
        SELECT usuario_id, count(*) AS conversaciones, sum(mensajes)::BIGINT AS mensajes, sum(de_usuario)::BIGINT AS de_usuario,
               sum(de_bot)::BIGINT AS de_bot, sum(de_otros)::BIGINT AS de_otros, max(mensajes) AS maximo, 0::BIGINT AS sin_leer
        FROM (SELECT (conv_id // 3)::VARCHAR AS usuario_id, {_MESSAGES} FROM conversations GROUP BY conv_id)
        GROUP BY usuario_id""",
    "turn_count": _TALKS + "SELECT SK, n::INTEGER AS turnos FROM talked",
    "text_normalize": f"""
        SELECT doc_id, {_strip(r"regexp_replace(replace(regexp_replace(translate(" + _strip('text') + r", chr(10) || chr(13) || chr(9), '   '), ' {2,}', ' ', 'g'), '|', ' | '), ' \|(?:  \|)+ ', ' | ', 'g')")} AS texto
        FROM documents""",
    "char4_tokens": f"SELECT doc_id, {_chars4('text')} AS tokens FROM documents",
    "heuristic_tokens": f"SELECT doc_id, {_estimate('text')} AS tokens FROM documents",
    "preview": "SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS vista FROM documents",
    "multi_value_flag": "SELECT doc_id, contains(text, '|') AS multiple FROM documents",
    "blank_values": _ALL_ROWS + """
        SELECT rws.PK, rws.SK, nombre = '' AS sin_nombre, ciudad = '' AS sin_ciudad FROM rws JOIN profile USING (u)""",
    # items
    "drop_register": _with(_LINES, _PROFILES, _FEEDBACK, _ALL_KEYS) + "SELECT PK, SK FROM keys",
    "row_kinds": _with(_LINES, _PROFILES, _FEEDBACK, _ALL_KEYS) + """
        SELECT PK, SK, SK LIKE 'CONVERSATION%' AS is_conversation, SK LIKE 'Feedback%' AS is_feedback,
               SK IN ('PROFILE', 'Register#1') AS is_other
        FROM (SELECT * FROM keys UNION ALL SELECT PK, 'Register#1' FROM profile)""",
    "user_ids": _ALL_ROWS + """
        SELECT u::VARCHAR AS usuario_id, SK, created AS fecha_primera_conversacion FROM rws
        UNION ALL SELECT u::VARCHAR, SK, NULL FROM fb
        UNION ALL SELECT u::VARCHAR, 'Register#1', NULL FROM profile""",
    "feedback_last_wins": _ALL_ROWS + """
        SELECT rws.PK, rws.SK, CASE WHEN o = 0 THEN w.raw_f ELSE own END AS Feedback FROM rws LEFT JOIN last_fb USING (u)""",
    "profile_parse": _ALL_ROWS + "SELECT rws.PK, rws.SK, nombre, ciudad FROM rws JOIN profile USING (u)",
    "profile_parse_raw": _ALL_ROWS + """
        SELECT rws.PK, rws.SK, raw_name AS nombre, raw_area AS ciudad FROM rws JOIN profile USING (u)""",
    "city_exclusion": _ALL_ROWS + """
        SELECT rws.PK, rws.SK, ciudad AS gerencia FROM rws JOIN profile USING (u) WHERE NOT excluded""",
    "default_fill": _ALL_ROWS + f"""
        SELECT rws.PK, rws.SK, coalesce(nullif(nombre, ''), '{V.ANONYMOUS_NAME}') AS nombre,
               coalesce(nullif(ciudad, ''), '{V.DEFAULT_AREA}') AS gerencia FROM rws JOIN profile USING (u)""",
    "permissive_dates": _ALL_ROWS + f"""
        SELECT PK, SK, dia FROM rws WHERE dia IS NULL OR dia BETWEEN DATE '{V.REPORT_START}' AND DATE '{AS_OF}'""",
    "date_label": _ALL_ROWS + f"SELECT PK, SK, coalesce(strftime(dia, '%d/%m/%Y'), '{V.NO_DATE}') AS fecha FROM rws",
    "envelope_unwrap": _with(_FEEDBACK) + "SELECT PK, SK, f AS Feedback FROM fb",
    "list_collapse": _with(_FEEDBACK) + "SELECT PK, SK, CASE WHEN doc_id % 5 = 0 OR doc_id % 2 = 1 THEN first_f ELSE f END AS Feedback FROM fb",
    # questions and feedback
    "user_questions_of_transcripts": _TALKS + "SELECT SK, q AS pregunta_conversacion FROM talked",
    "questions_of_documents": f"""
        SELECT doc_id, {_strip("replace(text, '|', '/')")} AS pregunta FROM documents""",
    "implied_questions": f"SELECT doc_id, {_IMPLIED} AS pregunta FROM documents",
    "implied_questions_by_rule": "WITH said AS (SELECT doc_id, [" + ", ".join(f"'{p}'" for p in RULE_PHRASES)
        + f"][doc_id % {len(RULE_PHRASES)} + 1] || ' ' || text AS text FROM documents) SELECT doc_id, {_IMPLIED} AS pregunta FROM said",
    "questions_of_all_forms": f"""
        WITH said AS (
          SELECT doc_id, {_strip("replace(text, '|', '/')")} AS t, 'bot: ' || replace(text, '|', '/') AS text FROM (
            SELECT doc_id, [{", ".join(f"'{p}'" for p in RULE_PHRASES)}][doc_id % {len(RULE_PHRASES)} + 1] || ' ' || text AS text
            FROM documents))
        SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN t || ' | segunda' WHEN 1 THEN t || ' | otra' WHEN 3 THEN {_IMPLIED} ELSE t END AS pregunta
        FROM said""",
    "json_questions": f"""
        SELECT conv_id,
               coalesce(string_agg({_strip('text')}, ' | ' ORDER BY turn) FILTER (WHERE role = 'user' AND {_strip('text')} <> ''), '') AS pregunta
        FROM conversations GROUP BY conv_id""",
    "role_text": f"""
        SELECT conv_id,
               coalesce(string_agg({_strip('text')}, ' ' ORDER BY turn) FILTER (WHERE role = 'user' AND {_strip('text')} <> ''), '') AS texto_user,
               coalesce(string_agg({_strip('text')}, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant' AND {_strip('text')} <> ''), '') AS texto_bot
        FROM conversations GROUP BY conv_id""",
    "feedback_count": _with(_FEEDBACK) + "SELECT PK, SK, n::INTEGER AS n FROM fb",
    "feedback_class": _with(_FEEDBACK) + "SELECT PK, SK, class AS feedback FROM fb",
    "feedback_answers": _with(_FEEDBACK) + """
        SELECT PK, SK, CASE WHEN yes AND no THEN concat_ws(' | ', comment, comment, option, option)
                            ELSE concat_ws(' | ', comment, option) END AS respuestas,
               concat_ws(' | ', comment, option) AS distintas FROM fb""",
    "feedback_flatten": _with(_FEEDBACK) + """
        SELECT PK, SK, f AS feedback_total, '' AS tipo, '' AS comentario,
               CASE WHEN readable THEN comment END AS comment, CASE WHEN readable THEN nullif(class, '') END AS type
        FROM (SELECT *, NOT (yes AND no) AND (doc_id % 5 = 0 OR doc_id % 2 = 1) AS readable FROM fb)""",
    # rollup and report
    "conversation_report": _ALL_ROWS + """
        SELECT SK, u::VARCHAR AS usuario_id, nombre, gerencia, gerencia AS ciudad, fecha AS fecha_primera_conversacion,
               n::BIGINT AS numero_conversaciones, t AS conversacion_completa, coalesce(f, '') AS feedback_total,
               fn::BIGINT AS numero_feedback, q AS pregunta_conversacion, '' AS feedback, '' AS respuesta_feedback
        FROM kept""",
    "user_report": _REPORT + f"SELECT {_REPORT_COLUMNS} FROM report",
    "user_report_in_blocks": _REPORT + f"SELECT {_REPORT_COLUMNS} FROM report",
    "user_report_by_rollup": _REPORT + f"SELECT {_REPORT_COLUMNS} FROM report",
    "raw_user_report": _RAW_ROWS + f"""
        SELECT u::VARCHAR AS usuario_id, any_value(coalesce(nullif(raw_name, ''), '{V.ANONYMOUS_NAME}')) AS nombre,
               any_value(area) AS gerencia, any_value(area) AS ciudad, first(fecha ORDER BY o, SK) AS fecha_primera_conversacion,
               sum(CASE WHEN raw IS NULL THEN 1 ELSE greatest({_count('raw', 'bot')}, {_count('raw', 'user')}) END)::BIGINT AS numero_conversaciones,
               coalesce(string_agg(raw, ' | ' ORDER BY o, SK), '') AS conversacion_completa,
               coalesce(string_agg(f, ' | ' ORDER BY o, SK) FILTER (WHERE f <> ''), '') AS feedback_total,
               sum(fn)::BIGINT AS numero_feedback,
               coalesce(string_agg(raw_q, ' | ' ORDER BY o, SK) FILTER (WHERE raw_q <> ''), '') AS pregunta_conversacion,
               CASE WHEN count(DISTINCT nullif(class, '')) > 1 THEN 'mixed' ELSE coalesce(max(nullif(class, '')), '') END AS feedback,
               concat_ws(' | ', max(comment), CASE WHEN bool_or(has_own) THEN 'd''accord' END, max(option)) AS respuesta_feedback
        FROM (SELECT k.*, raw, raw_q, raw_name, coalesce(nullif(raw_area, ''), '{V.UNSPECIFIED_AREA}') AS area
              FROM kept_open AS k JOIN (SELECT u, raw_name, raw_area FROM profile) USING (u) LEFT JOIN raw_talk USING (SK)) GROUP BY u""",
    "first_real_value": _with(_PROFILES) + f"""
        SELECT u::VARCHAR AS usuario_id, coalesce(nullif(nombre, ''), '{V.ANONYMOUS_NAME}') AS nombre,
               coalesce(nullif(ciudad, ''), '{V.UNSPECIFIED_AREA}') AS gerencia FROM profile""",
    "ordered_concatenation": _TALKS + """
        SELECT u::VARCHAR AS usuario_id, string_agg(t, ' || ' ORDER BY SK) AS texto FROM talked GROUP BY u""",
    "report_contract": "SELECT " + ", ".join(
        {"usuario_id": "c_custkey::VARCHAR AS usuario_id", "nombre": "c_name AS nombre"}.get(c, f"'' AS {c}")
        for c in V.REPORT_COLUMNS
    ) + " FROM customer",
    "run_stats": _REPORT + """
        SELECT count(*) AS usuarios_procesados, sum(numero_conversaciones)::BIGINT AS total_conversaciones,
               count(*) FILTER (WHERE feedback <> '') AS usuarios_con_feedback,
               count(*) FILTER (WHERE pregunta_conversacion <> '') AS usuarios_con_preguntas,
               count(*) FILTER (WHERE respuesta_feedback <> '') AS usuarios_con_respuestas FROM report""",
    # files and catalog
    "export_round_trip": _ALL_ROWS + """
        SELECT rws.PK, SK, created AS CreatedAt, own AS Feedback, t AS conversacion, nombre, ciudad
        FROM rws JOIN profile USING (u)
        UNION ALL SELECT PK, SK, NULL, raw_f, '', '', '' FROM fb
        UNION ALL SELECT PK, 'Register#1', NULL, NULL, '', '', '' FROM profile""",
    "enveloped_export": _ALL_ROWS + """
        SELECT PK, SK, created AS CreatedAt, t AS conversacion_completa FROM rws
        UNION ALL SELECT PK, SK, NULL, '' FROM fb
        UNION ALL SELECT PK, 'Register#1', NULL, '' FROM profile""",
    "message_export_round_trip": _TOKENS + """
        SELECT pk AS PK, sk AS SK, CASE clock WHEN 'bad' THEN 'sin fecha' WHEN 'ok' THEN ms::VARCHAR WHEN 'error' THEN repeat(ms::VARCHAR, 2) END AS CreateTime,
               stored AS TotalPrice, i AS input_token, o AS output_token FROM item""",
    "items_csv_round_trip": _RAW_ROWS + """
        SELECT rws.PK, rws.SK, created AS CreatedAt, raw AS Conversation, own AS Feedback FROM rws LEFT JOIN raw_talk USING (SK)
        UNION ALL SELECT PK, SK, NULL, NULL, raw_f FROM fb
        UNION ALL SELECT PK, 'Register#1', NULL, NULL, NULL FROM profile""",
    "items_csv_all_forms": _ALL_ROWS + """
        SELECT rws.PK, SK, created AS CreatedAt, own AS Feedback, t AS conversacion, nombre, ciudad
        FROM rws JOIN profile USING (u)
        UNION ALL SELECT PK, SK, NULL, raw_f, '', '', '' FROM fb
        UNION ALL SELECT PK, 'Register#1', NULL, NULL, '', '', '' FROM profile""",
    "csv_round_trip": _REPORT + "SELECT " + ", ".join(
        f"nullif({c}::VARCHAR, '') AS {c}" for c in V.REPORT_COLUMNS
    ) + " FROM report",
    "token_csv_round_trip": _TOKENS + "SELECT * REPLACE (nullif(create_date, '') AS create_date) FROM tokens",
    "typed_report": _TYPED_REPORT + _TYPED_SELECT,
    "catalog_table": _TYPED_REPORT + _TYPED_SELECT,
    "catalog_columns": _columns_as_rows(
        _TYPED_COLUMNS,
        "SELECT 'parlance_typed_report' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, "
        "true AS is_nullable, {i} AS ordinal_position",
    ),
    "arrival_refresh": _TYPED_REPORT + _TYPED_SELECT,
    "arrival_refresh_by_key": _TYPED_REPORT + _TYPED_SELECT,
    "parquet_check": _REPORT + _columns_as_rows(
        _TYPED_COLUMNS,
        "SELECT {i} AS posicion, '{name}' AS columna, '{kind}' AS tipo, count(*) AS filas_escritas, "
        "count(*) AS filas_leidas, true AS coincide FROM report",
    ),
    # typed columns
    "multi_format_date": r"""
        SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN d WHEN 1 THEN d WHEN 5 THEN d
            WHEN 2 THEN CASE WHEN month(d) >= 10 AND day(d) >= 10
                             THEN try_strptime(strftime(d, '%m/%d/%Y'), '%d/%m/%Y')::DATE ELSE d END END AS fecha
        FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""",
    "int_zero_null": "SELECT nullif(l_linenumber - 1, 0)::INTEGER AS valor, count(*) AS n FROM lineitem GROUP BY 1",
    "timestamp_and_double": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS momento,
               CASE WHEN event_type <> 'view' THEN value END AS valor FROM events""",
    "feedback_domain": """
        SELECT doc_id, class AS feedback, CASE WHEN class IS NOT NULL THEN 'respuesta ' || doc_id END AS respuesta_feedback
        FROM (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'mixed' WHEN quality = 1 THEN 'like'
                                  WHEN toxic = 1 THEN 'dislike' END AS class FROM labels)""",
    "user_texts": _TALKS + "SELECT conv_id, array_to_string(qs, chr(10)) AS textos FROM talked",
    "bot_texts": _TALKS + "SELECT conv_id, array_to_string(bs, chr(10)) AS textos FROM talked",
    "speaker_text": _TALKS + f"""
        SELECT conv_id, {_strip("regexp_replace(array_to_string(qs, ' '), ' {2,}', ' ', 'g')")} AS texto_user,
               {_strip("regexp_replace(array_to_string(bs, ' '), ' {2,}', ' ', 'g')")} AS texto_bot FROM talked""",
    "transcript_tokens": _TALKS + f"""
        SELECT conv_id, sum(CASE WHEN role = 'user' THEN {_estimate('clean')} ELSE 0 END)::INTEGER AS token_pregunta,
               sum(CASE WHEN role = 'assistant' THEN {_estimate('clean')} ELSE 0 END)::INTEGER AS token_respuesta
        FROM line GROUP BY conv_id""",
    "null_profile": _TYPED_REPORT + ", typed_all AS (" + _TYPED_SELECT + ") " + _columns_as_rows(
        _TYPED_COLUMNS,
        "SELECT '{name}' AS columna, '{kind}' AS tipo, count({name}) AS validos, count(*) - count({name}) AS nulos FROM typed_all",
    ),
    # message maps and token costs
    "message_map_rows": """
        SELECT conv_id::VARCHAR AS SK, CASE role WHEN 'system' THEN role ELSE 't' || turn END AS message_id,
               role, text AS body FROM conversations
        UNION ALL
        SELECT DISTINCT conv_id::VARCHAR, 'file', 'user', '' FROM conversations WHERE conv_id % 17 = 0""",
    "message_map_tokens": _TOKENS + "SELECT sk AS SK, i AS input_token, o AS output_token FROM item WHERE conv_id IS NOT NULL",
    "message_map_tokens_by_members": _TOKENS + "SELECT sk AS SK, i AS input_token, o AS output_token FROM item WHERE conv_id IS NOT NULL",
    "transcript_by_elements": _TALKS + "SELECT SK, t AS conversacion_completa FROM talked",
    "literal_forms": """
        SELECT conv_id, turn::INTEGER AS turn, text AS texto, turn * 16 + 15 AS numero,
               '[[1,"' || role || '"],["' || role || '",' || turn || ',0.5],"' || role || role || '",{"true":-1000}]' AS resto
        FROM conversations""",
    "mixed_envelope": """
        SELECT p_partkey, p_name AS nombre, p_name AS otro, p_size::BIGINT AS medida, p_partkey::BIGINT AS clave FROM part""",
    "enveloped_map_tokens": _TOKENS + """
        SELECT conv_id, i AS input_token, o AS output_token FROM item WHERE conv_id IS NOT NULL""",
    "typed_envelope": """
        SELECT conv_id, CASE WHEN role = 'user' AND conv_id % 2 = 1 THEN 'USUARIO'
               WHEN role = 'assistant' AND conv_id % 2 = 1 THEN 'Bot' ELSE role END AS de, text AS texto FROM conversations""",
    "nested_envelope": """
        SELECT conv_id, turn::INTEGER AS turn, text AS texto, '["' || role || '",true,null,["a","b]}"]]' AS marcas
        FROM conversations""",
    "token_repair": _TOKENS + """
        SELECT CASE WHEN conv_id IS NULL THEN 'missing' WHEN conv_id % 17 IN (0, 2) THEN 'repaired'
                    WHEN conv_id % 17 = 1 THEN 'cut' ELSE 'valid' END AS parse_status, count(*) AS n FROM item GROUP BY 1""",
    "token_table": _TOKENS + "SELECT * FROM tokens",
    "token_prices": f"""
        SELECT doc_id, (n::BIGINT * 3)::DOUBLE / 1000000 AS precio_token_input, (n::BIGINT * 15)::DOUBLE / 1000000 AS precio_token_output
        FROM (SELECT doc_id, {_chars4('text')} AS n FROM documents)""",
    "epoch_filter": _with(_EVENTS) + f"""
        SELECT event_id FROM event_time WHERE clock <> 'ok' OR ms BETWEEN {EVENT_FIRST_MS} AND {EVENT_LAST_MS}""",
    "epoch_label": _with(_EVENTS) + f"""
        SELECT event_id, CASE clock WHEN 'bad' THEN '{V.INVALID_DATE}' WHEN 'none' THEN '' WHEN 'error' THEN '{V.ERROR_DATE}'
               ELSE strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') END AS create_date FROM event_time""",
    "run_counters": _TOKENS + f"""
        SELECT count(*) FILTER (WHERE clock IN ('bad', 'none') OR clock = 'ok' AND ms BETWEEN {FIRST_MS} AND {LAST_MS}) AS processed_count,
               count(*) FILTER (WHERE clock = 'ok' AND ms NOT BETWEEN {FIRST_MS} AND {LAST_MS}) AS filtered_count,
               count(*) FILTER (WHERE clock = 'error') AS error_count FROM item""",
    "event_counters": _with(_EVENTS) + f"""
        SELECT count(*) FILTER (WHERE clock IN ('bad', 'none') OR clock = 'ok' AND ms BETWEEN {EVENT_FIRST_MS} AND {EVENT_LAST_MS}) AS processed_count,
               count(*) FILTER (WHERE clock = 'ok' AND ms NOT BETWEEN {EVENT_FIRST_MS} AND {EVENT_LAST_MS}) AS filtered_count,
               count(*) FILTER (WHERE clock = 'error') AS error_count FROM event_time""",
    "token_view": _TOKENS + """
        SELECT create_date, input_token AS "token pregunta", output_token AS "token respuesta",
               input_token + output_token AS "total tokens", precio_token_input AS "precio total pregunta",
               precio_token_output AS "precio total respuesta", total_price AS "precio total"
        FROM tokens WHERE input_token > 0 OR output_token > 0""",
    "token_totals": _TOKENS + f"""
        SELECT n AS total_records, i AS total_input_tokens, o AS total_output_tokens, i + o AS total_tokens,
               (i * 3)::DOUBLE / 1000000 AS total_input_cost, (o * 15)::DOUBLE / 1000000 AS total_output_cost,
               cost::DOUBLE / 1000000 AS total_cost,
               {_half_up("cost", "n * 1000000", 6)} AS average_cost_per_record,
               {_half_up("i", "n", 2)} AS average_input_tokens, {_half_up("o", "n", 2)} AS average_output_tokens
        FROM (SELECT count(*) AS n, sum(input_token)::BIGINT AS i, sum(output_token)::BIGINT AS o,
                     (sum(total_price::DECIMAL(24, 6)) * 1000000)::HUGEINT AS cost FROM tokens)""",
    "empty_placeholder": f"""
        SELECT '{AS_OF} 00:00:00' AS create_date, 0 AS input_token, 0 AS output_token, 0::DOUBLE AS precio_token_input,
               0::DOUBLE AS precio_token_output, 0::DOUBLE AS total_price, '{V.NO_DATA}' AS pk, '{V.NO_DATA}' AS sk""",
    "filled_placeholder": _TOKENS + "SELECT * FROM tokens",
    "daily_cost": _TOKENS + f"""
        SELECT try_cast(create_date AS DATE) AS dia, {_TOKEN_SUMS}, '{MODEL}' AS modelo FROM tokens GROUP BY 1""",
    "user_cost": _TOKENS + f"SELECT pk, {_TOKEN_SUMS} FROM tokens GROUP BY 1",
    "user_day_cost": _TOKENS + f"SELECT pk, try_cast(create_date AS DATE) AS dia, {_TOKEN_SUMS} FROM tokens GROUP BY 1, 2",
    "event_daily_count": _with(_EVENTS) + """
        SELECT CASE WHEN clock = 'ok' THEN make_timestamp(ms * 1000)::DATE END AS dia, count(*) AS n FROM event_time GROUP BY 1""",
    # reports
    "distinct_users_by_stage": _ALL_ROWS + f"""
        SELECT 'inicio' AS etapa, count(DISTINCT u) AS usuarios FROM rws
        UNION ALL SELECT 'ciudad', count(DISTINCT u) FROM rws JOIN profile USING (u) WHERE NOT excluded
        UNION ALL SELECT 'fecha', count(DISTINCT u) FROM kept""",
    "feedback_distribution": _REPORT + _distribution(
        "report", f"CASE WHEN feedback = '' THEN '{V.NO_FEEDBACK}' ELSE feedback END", 1
    ),
    "event_distribution": _distribution("events", "event_type", 2),
    "feedback_histogram": _REPORT + "SELECT numero_feedback AS valor, count(*) AS n FROM report GROUP BY 1",
    "conversation_buckets": f"""
        WITH turns AS (SELECT conv_id, count(*) AS c FROM conversations GROUP BY 1),
        mean AS (SELECT {_half_up("sum(c)", "count(*)", 2)} AS promedio FROM turns)
        SELECT '1' AS grupo, count(*) FILTER (WHERE c = 1) AS n, any_value(promedio) AS promedio FROM turns, mean
        UNION ALL SELECT '2-5', count(*) FILTER (WHERE c BETWEEN 2 AND 5), any_value(promedio) FROM turns, mean
        UNION ALL SELECT '6+', count(*) FILTER (WHERE c > 5), any_value(promedio) FROM turns, mean""",
    "user_conversation_buckets": _REPORT + f"""
        , mean AS (SELECT {_half_up("sum(numero_conversaciones)", "count(*)", 2)} AS promedio FROM report)
        SELECT '1' AS grupo, count(*) FILTER (WHERE numero_conversaciones = 1) AS n, any_value(promedio) AS promedio FROM report, mean
        UNION ALL SELECT '2-5', count(*) FILTER (WHERE numero_conversaciones BETWEEN 2 AND 5), any_value(promedio) FROM report, mean
        UNION ALL SELECT '6+', count(*) FILTER (WHERE numero_conversaciones > 5), any_value(promedio) FROM report, mean""",
    "duplicate_users": _ALL_ROWS + """
        SELECT u::VARCHAR AS usuario_id, count(*) AS n FROM rws GROUP BY 1 HAVING count(*) > 1""",
    "duplicate_check": "SELECT 0::BIGINT AS repetidos, true AS sin_duplicados",
    "completeness": _REPORT + " UNION ALL ".join(
        f"SELECT '{c}' AS columna, k AS llenos, {_half_up('100 * k', 'n', 1)} AS pct FROM "
        f"(SELECT count(*) AS n, count(*) FILTER (WHERE {c} <> '') AS k FROM report)"
        for c in ("pregunta_conversacion", "feedback", "respuesta_feedback")
    ),
    "answer_vocabulary": _REPORT + f"""
        SELECT count(*) AS total, count(DISTINCT respuesta) AS distintas FROM ({_SPLIT_ANSWERS})""",
    "top_answers": _REPORT + f"""
        SELECT respuesta, count(*) AS n FROM ({_SPLIT_ANSWERS}) GROUP BY 1 ORDER BY n DESC, respuesta LIMIT 10""",
    "answer_shape": _REPORT + """
        SELECT count(*) FILTER (WHERE respuesta_feedback <> '') AS con_respuesta,
               count(*) FILTER (WHERE respuesta_feedback = '') AS sin_respuesta,
               count(*) FILTER (WHERE contains(respuesta_feedback, '|')) AS con_multiples FROM report""",
    "coherence": _REPORT + """
        SELECT count(*) FILTER (WHERE respuesta_feedback <> '') AS con_respuesta,
               count(*) FILTER (WHERE feedback_total <> '') AS con_feedback FROM report""",
    "validation_report": _TYPED_REPORT + """
        SELECT count(*) AS total_usuarios, min(fecha_primera_conversacion) AS fecha_min,
               max(fecha_primera_conversacion) AS fecha_max, avg(numero_conversaciones) AS promedio_conversaciones FROM typed""",
    "kpis": _REPORT + """
        SELECT 'Total Usuarios' AS metrica, count(DISTINCT usuario_id) AS valor FROM report
        UNION ALL SELECT 'Total Conversaciones', sum(numero_conversaciones)::BIGINT FROM report""",
    "first_examples": _REPORT + """
        SELECT usuario_id, CASE WHEN length(pregunta_conversacion) > 100 THEN left(pregunta_conversacion, 100) || '...'
                                ELSE pregunta_conversacion END AS vista
        FROM report WHERE pregunta_conversacion <> '' ORDER BY usuario_id LIMIT 5""",
    "answer_examples": _REPORT + """
        SELECT clase, usuario_id, respuesta_feedback
        FROM (SELECT *, CASE WHEN contains(respuesta_feedback, '|') THEN 'multiple' ELSE 'simple' END AS clase
              FROM report WHERE respuesta_feedback <> '')
        QUALIFY row_number() OVER (PARTITION BY clase ORDER BY usuario_id) <= 3""",
    "examples_per_class": _REPORT + """
        SELECT feedback, usuario_id FROM report WHERE feedback <> ''
        QUALIFY row_number() OVER (PARTITION BY feedback ORDER BY usuario_id) <= 2""",
}
