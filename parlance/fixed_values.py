"""Fixed values of the data contract.

Everything in this module is a constant that results depend on: column names,
default texts, word lists, patterns and prices. The functions that use them
take them as default arguments, so a deployment can pass its own.
"""

# --- Fixed values: column contracts (order matters) -------------------------
REPORT_COLUMNS = (
    "usuario_id", "nombre", "gerencia", "ciudad", "fecha_primera_conversacion",
    "numero_conversaciones", "conversacion_completa", "feedback_total",
    "numero_feedback", "pregunta_conversacion", "feedback", "respuesta_feedback",
)
REPORT_TYPES = {
    "fecha_primera_conversacion": "date",
    "numero_conversaciones": "integer",
    "numero_feedback": "integer",
    "token_pregunta": "integer",
    "token_respuesta": "integer",
    "usuario_id": "string",
    "nombre": "string",
    "gerencia": "string",
    "ciudad": "string",
    "conversacion_completa": "string",
    "feedback_total": "string",
    "pregunta_conversacion": "string",
    "feedback": "string",
    "respuesta_feedback": "string",
}
TOKEN_COLUMNS = (
    "create_date", "input_token", "output_token", "precio_token_input",
    "precio_token_output", "total_price", "pk", "sk",
)
TOKEN_VIEW_NAME = "token_usage_analysis"
TOKEN_TABLE_NAME = "tokens_table"

# --- Fixed values: item keys ------------------------------------------------
USER_KEY_PREFIX = "USER#"
REGISTER_MARK = "REGISTER"
CONVERSATION_MARK = "CONVERSATION"
FEEDBACK_MARK = "FEEDBACK"

# --- Fixed values: default and marker texts ---------------------------------
ANONYMOUS_NAME = "Usuario Anónimo"
DEFAULT_AREA = "Bogotá"
UNSPECIFIED_AREA = "Bogotá (no especificada)"
NO_DATE = "Sin fecha"
INVALID_DATE = "Fecha inválida"
ERROR_DATE = "Error"
NO_DATA = "sin_datos"
NO_FEEDBACK = "Sin feedback"
BLANK_WORDS = ("nan", "none", "null")      # compared in lower case
BLANK_WORDS_EXACT = ("nan", "None", "null")  # compared as written
PART_SEPARATOR = " | "
CONVERSATION_SEPARATOR = " || "
REPORT_START = "2025-08-04"
REPORT_DATE_FORMAT = "dd/MM/yyyy"

# --- Fixed values: places left out of the report ----------------------------
EXCLUDED_PLACES = (
    "mexico", "medell", "cali", "barranquilla", "cartagena", "potosí", "valle",
    "antioquia",
)

# --- Fixed values: speaker names --------------------------------------------
USER_SPEAKERS = ("user", "usuario")
BOT_SPEAKERS = ("bot", "assistant", "catia")
USER_PREFIXES = ("user:", "usuario:", "usr:", "u:")
BOT_PREFIXES = ("bot:", "assistant:", "asistente:", "b:")

# --- Fixed values: question implied by a bot answer (first match wins) -------
IMPLIED_QUESTIONS = (
    (r"el trámite de ([\w\s]+?) (?:es|se realiza|consiste)", "¿Cómo hago el trámite de {}?"),
    (r"el certificado ([\w\s]+?) (?:es|incluye|contiene)", "¿Qué es el certificado {}?"),
    (r"el chip", "¿Qué es el CHIP?"),
    (r"(?:cuesta|valor|costo)", "¿Cuál es el costo del trámite?"),
    (r"(?:documentos? necesarios?|requisitos?)", "¿Qué documentos necesito?"),
    (r"(?:tiempo de respuesta|duración|días hábiles)", "¿Cuánto tiempo tarda el trámite?"),
    (r"(?:ubicad|direcci[oó]n|sede)", "¿Dónde queda ubicado catastro?"),
    (r"horario.*atenci[oó]n", "¿Cuál es el horario de atención?"),
)

# --- Fixed values: a question inside free text --------------------------------
# After "user:", up to the next bot message or the end; {S} is white space.
INLINE_QUESTION = r"(?iu)user:{S}*([^|]+?)(?:{S}*\|{S}*bot:|$)"

# --- Fixed values: date texts and their formats, tried in this order ------------
DATE_FORMATS = (
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
)

# --- Fixed values: columns of the token view -----------------------------------
TOKEN_VIEW_COLUMNS = {
    "create_date": "create_date",
    "input_token": "token pregunta",
    "output_token": "token respuesta",
    "input_token + output_token": "total tokens",
    "precio_token_input": "precio total pregunta",
    "precio_token_output": "precio total respuesta",
    "total_price": "precio total",
}

# --- Fixed values: feedback classes and the texts that mark them ------------
FEEDBACK_CLASSES = ("like", "dislike", "mixed")
FEEDBACK_MARKS = (
    "'type': 'like'", '"type": "like"', "'type': 'dislike'", '"type": "dislike"',
)

# --- Fixed values: message maps ---------------------------------------------
INPUT_ROLES = ("user", "system", "instruction", "used_chunks")
OUTPUT_ROLES = ("assistant", "bot")
MAP_KEYS = ("system", "instruction", "user", "assistant")

# --- Fixed values: repairs of damaged message maps --------------------------
# A body cut off before its text, under any key that ends like this.
TRUNCATED_BODY = ('ody": ",', 'ody": "",')
# Doubled quotes of a CSV export, then constants written as texts.
MAP_REPAIRS = (
    ('""""', '"'), ('""', '"'), ('"null"', "null"), ('"true"', "true"), ('"false"', "false"),
)

# --- Fixed values: prices in USD per 1000 tokens ----------------------------
INPUT_RATE = "0.003"
OUTPUT_RATE = "0.015"

# --- Fixed values: token estimate -------------------------------------------
CHARS_PER_TOKEN = 3.8
SPACE_WEIGHT = 0.2
PUNCTUATION_WEIGHT = 0.15
SPECIAL_WEIGHT = 0.1
PUNCTUATION = ".,;:!?¡¿()[]{}\"'-"
SPECIAL = "@#$%&*+=/<>"

# --- Fixed values: characters that count as white space ----------------------
# Tab to carriage return, the four separators 1C-1F, space, next line,
# no-break space and the Unicode space separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The same characters as a regular-expression class body.
WHITESPACE_CLASS = (
    r"\t-\r\x1c-\x20\x85\xa0  -     　"
)
# Characters allowed before a speaker prefix besides white space.
ZERO_WIDTH_CLASS = r"​﻿"
# Digits beyond the decimal ones: superscripts, subscripts and circled forms.
EXTRA_DIGITS_CLASS = (
    r"\xb2\xb3\xb9፩-፱᧚⁰⁴-⁹₀-₉"
    r"①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿"
    r"❶-❾➀-➈➊-➒"
    r"\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)
