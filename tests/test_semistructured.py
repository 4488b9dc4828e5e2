import ast
import json
import random

import pytest

from pyspark.sql import functions as F, types as T

from parlance import fixed_values as V
from parlance.functions import envelope as ev, feedback as fb, literal as lt, questions as qs, transcript as tr
from parlance.functions.profile import parse_profile


def test_literal_values(evaluate):
    values = [
        {"a": None, "b": True, "c": [False, 1, 2.5], "d": "it's None, True"},
        [{"from": "user", "text": 'say "hi" \\ there\nnew'}, {"x": "\xa0\x1b", "y": "ñ€😀"}],
        {"k": "None", "None": "x"},
    ]
    found = evaluate(lambda c: F.to_json(lt.read_literal(c)), *[repr(v) for v in values])
    assert [json.loads(f) for f in found] == values


def test_random_literals(evaluate):
    rng = random.Random(11)

    def value(depth):
        kind = rng.randrange(7 if depth else 5)
        if kind == 5:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        if kind == 6:
            return {"".join(rng.choice("kNT'") for _ in range(3)) + str(i): value(depth - 1) for i in range(rng.randrange(3))}
        return [None, True, False, rng.randrange(9), "".join(rng.choice("aNone'\"\\ ,:{}[]\nTrue") for _ in range(8))][kind]

    values = [[value(3)] for _ in range(200)]
    texts = [repr(v) for v in values]
    assert [ast.literal_eval(t) for t in texts] == values
    assert [json.loads(f) for f in evaluate(lambda c: F.to_json(lt.read_literal(c)), *texts)] == values


def test_literal_forms_beyond_json(evaluate):
    texts = [
        "[1, 2,]", "{'a': 1,}", "{'a': [1,], }", "(1, 'x', None)", "[(1, 2), (3,)]", "{'a': 1, 'a': 2, 'b': 3, 'a': 4}",
        "[{'from': 'u', 'text': 'x', 'text': 'y'}, {'from': 'b', 'text': 'z'}]", "['a' 'b', 'c'  'd' 'e']", '["a" "b"]',
        "['it,] (really)', \"a' 'b\"]", "{'a': 'x' 'y', 'k': ('p', 'q',)}", "['a', 'b']", "[',]', ',)']",
    ]
    found = evaluate(lambda c: F.to_json(lt.read_literal(c)), *texts)
    as_json = [json.loads(json.dumps(ast.literal_eval(t))) for t in texts]
    assert [f and json.loads(f) for f in found] == as_json


def test_random_literals_with_loose_commas_and_repeats(evaluate):
    rng = random.Random(12)

    def text_of(depth):
        kind = rng.randrange(8 if depth else 5)
        comma = rng.choice(["", ",", " , "])
        if kind == 5:
            items = [text_of(depth - 1) for _ in range(rng.randrange(1, 4))]
            return "[" + ", ".join(items) + comma + "]"
        if kind == 6:
            items = [text_of(depth - 1) for _ in range(rng.randrange(2, 4))]
            return "(" + ", ".join(items) + comma + ")"
        if kind == 7:
            return "[" + " ".join(repr(rng.choice(["a'", 'b', ",]", "(x)", "None"])) for _ in range(1)) + comma + "]"
        return repr([None, True, 3, 2.5, "".join(rng.choice("aN'\"\\ ,:()[]{}") for _ in range(8))][kind])

    texts = ["[" + text_of(3) + "]" for _ in range(200)]
    found = evaluate(lambda c: F.to_json(lt.read_literal(c)), *texts)
    assert [json.loads(f) for f in found] == [json.loads(json.dumps(ast.literal_eval(t))) for t in texts]


def test_map_with_many_repeated_keys(evaluate):
    """The last value of every key, in time that grows with the keys and not with their square."""
    n = 10_000
    text = "{" + ", ".join(f'"k{i % (n // 2)}": {i}' for i in range(n)) + "}"
    found = json.loads(evaluate(lambda c: F.to_json(lt.read_json_object(c)), text)[0])
    assert found == {f"k{i}": i + n // 2 for i in range(n // 2)}


def test_trailing_text_is_an_error(evaluate):
    assert evaluate(lambda c: F.to_json(lt.read_json(c)), '{"a":1} x', '[1] [2]', "1, 2", "", None, " [1] ") == [
        None, None, None, None, None, "[1]"
    ]


def test_profile(evaluate):
    def pair(c):
        p = parse_profile(c)
        return F.concat(p["nombre"], F.lit("/"), p["ciudad"])

    assert evaluate(
        pair, '{"ciudad": "Gerencia (Norte)", "nombre": " Ana "}', '{"nombre": null}', "[1]", "nan", None,
        '{"nombre":"x","ciudad":"","gerencia":"G"}', "{'nombre': 'Jo', 'gerencia': 'Z'}", '{"nombre": 3, "ciudad": "C"}',
        '{"M":{"nombre":{"S":"E"},"ciudad":{"S":"C (x)"}}}', '{"nombre":"a"} junk',
    ) == ["Ana/Gerencia", "/", "/", "/", "/", "x/", "Jo/Z", "/", "E/C", "/"]
    raw = lambda c: parse_profile(c, clean=False)["ciudad"]
    assert evaluate(raw, '{"ciudad": " Gerencia (Norte)"}') == [" Gerencia (Norte)"]


def test_transcript(evaluate):
    cases = {
        '[{"from":"USUARIO","text":"a\\n\\nb"},{"from":"Assistant ","text":" c "},{"from":"Sys","text":"d"}]': "user: a b | bot: c | sys: d",
        "hola": "hola", " hola ": "hola", "[]": "", "None": "", "[broken": "[broken", "[1] [2]": "[1] [2]",
        '{"L":[{"M":{"from":{"S":"user"},"text":{"S":"hey"}}}]}': "user: hey",
        '[{"M":{"from":{"S":"bot"},"text":{"S":"x"}}}, 3]': "bot: x",
        '{"from":"user","text":"solo"}': "user: solo",
        """[{'from': 'user', 'text': "it's None", 'x': None}]""": "user: it's None",
    }
    assert evaluate(tr.transcript, *cases) == list(cases.values())
    assert evaluate(tr.transcript, None) == [""]


def test_speaker_labels(evaluate):
    speakers = [*V.USER_SPEAKERS, *V.BOT_SPEAKERS, "Sys "]
    assert evaluate(tr.speaker_label, *speakers) == ["user"] * 2 + ["bot"] * 3 + ["sys"]


def test_long_literal_conversation(evaluate):
    messages = [{"from": "user", "text": f"message {i} it's\n" + "x" * 40, "at": None} for i in range(20000)]
    expected = " | ".join("user: " + m["text"].replace("\n", " ") for m in messages)
    assert evaluate(tr.transcript, repr(messages)) == [expected]


def test_questions_from_messages(evaluate):
    assert evaluate(
        tr.json_questions, '[{"from":"user","text":" a "},{"from":"bot","text":"b"},{"from":"user","text":"a"},{"from":"User","text":"z"}]',
        '{"from":"user","text":"a"}', "[{'from': 'user', 'text': 'x', 'y': None}]", "[", None,
    ) == ["a | a", "", "x", "", ""]


def test_message_counts(evaluate):
    cases = {
        '[{"from":"user","text":"bot: a | user: b"},{"from":"Bot","text":"user user"},{"from":"Sys","text":"x"}]': (3, 1, 1, 1),
        "[{'from': 'USUARIO', 'text': 'it\\'s'}, 3, {'text': 'no speaker'}]": (2, 1, 0, 1),
        '{"L":[{"M":{"from":{"S":"user"},"text":{"S":"hey"}}}]}': (1, 1, 0, 0), '{"from":"bot","text":"solo"}': (1, 0, 1, 0),
        "[]": (0, 0, 0, 0), "": (0, 0, 0, 0), "None": (0, 0, 0, 0), "hola": (1, 0, 0, 1), "[broken": (1, 0, 0, 1),
        "user: a | more of a | bot: b || usuario: c": (3, 2, 1, 0),
    }
    got = evaluate(tr.message_counts, *cases)
    assert [tuple(r) for r in got] == list(cases.values())
    assert tuple(evaluate(tr.message_counts, None)[0]) == (0, 0, 0, 0)
    # Cut into elements first, as large cells are; a large list that cannot be read is not counted as text.
    cut = evaluate(lambda c: tr.message_counts(c, 0), *[c for c in cases if c.startswith("[{")])
    assert [tuple(r) for r in cut] == [n for c, n in cases.items() if c.startswith("[{")]
    assert tuple(evaluate(lambda c: tr.message_counts(c, 0), "[{'from': 'user', 'text': }]")[0]) == (None,) * 4


def test_role_text(evaluate):
    text = "[{'from': 'user', 'text': 'x', 'timestamp': '2'}, {'from': 'bot', 'text': ' y\\n\\nz '}, {'from': 'user', 'text': 'w'}]"
    assert evaluate(lambda c: tr.role_text(c, "user"), text, "", "{}") == ["x w", "", ""]
    assert evaluate(lambda c: tr.role_text(c, "bot"), text) == ["y\n\nz"]


def test_user_questions(evaluate):
    cases = {
        "user: a | bot: b | user: a | user: c": "a | c",
        "user: a | bot: b || USER: c | user:  || user: a": "a | c",
        "user: x | || y": "x |",
        "User: solo": "solo",
        "bot: El CHIP es un código": "¿Qué es el CHIP?",
        "bot: ok": "",
        "bot: el trámite de venta de casa se realiza aquí": "¿Cómo hago el trámite de ?",
        "bot: nada que ver con esto": "",
        "x user: q| bot: z": "q",
        "user:a|bot: z": "a|bot: z",
        "nan": "",
    }
    assert evaluate(qs.user_questions, *cases) == list(cases.values())
    assert evaluate(qs.user_questions, None) == [""]


def test_dialogue_questions(evaluate):
    assert evaluate(qs.dialogue_questions, "user: a | bot: b | User: a | user: ") == [["a"]]


def test_implied_topic(evaluate):
    filled = lambda c: qs.implied_question(c, fill_topic=True)
    assert evaluate(filled, "El trámite de englobe es gratis", None) == ["¿Cómo hago el trámite de englobe?", ""]


def test_feedback_count(evaluate):
    assert evaluate(
        fb.feedback_count, "{'type': 'like'}", '{"type":"like"}', "abc", None, "x 'type': 'LIKE' 'type': 'dislike'", "null"
    ) == [1, 1, 0, 0, 2, 0]


def test_feedback_class(evaluate):
    assert evaluate(
        fb.feedback_class, "{'type': 'like'} || {'type': 'dislike'}", '{"type" : "like"}', '[{"type" : " Dislike "}, {"type" : 3}]',
        "{'type' : 'like', 'x': None}", "zz", None, "{'type': 'other'}",
    ) == ["mixed", "like", "dislike", "like", "", "", ""]


def test_feedback_answers(evaluate):
    cases = {
        "{'comment': 'x', 'option': 'y'} || {'comment': 'x'}": "x | x | y",
        """{'comment': "it's"}""": "it's",
        '{"comment" : "a", "option": 5}': "a | 5",
        "{'comment': None, 'option': 'null'}": "",
        '{"option": "o", "comment": "c"}': "c | o",
        "abc": "",
    }
    assert evaluate(fb.feedback_answers, *cases) == list(cases.values())


def test_feedback_flatten(evaluate):
    flat = evaluate(fb.flatten_feedback, '{"tipo":{"S":"like"},"comentario":"c","n":3}', "abc", None, '{"x":')
    assert [(f["feedback_total"], f["tipo"], f["comentario"], f["campos"]) for f in flat] == [
        ('{"tipo":{"S":"like"},"comentario":"c","n":3}', "like", "c", {"tipo": "like", "comentario": "c", "n": "3"}),
        ("abc", "", "", None), ("", "", "", None), ('{"x":', "", "", None),
    ]


def test_unwrap_feedback(evaluate):
    listed = '{"L":[{"M":{"type":{"S":"like"}}},{"M":{"type":{"S":"dislike"},"k":{"NULL":true},"n":{"N":"3"}}}]}'
    assert evaluate(fb.unwrap_feedback, listed, '{"S":"x"}', "abc", None, "{'type': 'like'}") == [
        '[{"type": "like"}, {"k": null, "n": 3, "type": "dislike"}]', "x", "abc", None, "{'type': 'like'}",
    ]
    first = lambda c: fb.unwrap_feedback(c, "first")
    assert evaluate(first, listed, '{"L":[]}') == ['{"type": "like"}', None]


def test_envelopes(evaluate):
    shape = T.StructType([
        T.StructField("s", T.StringType()), T.StructField("n", T.DoubleType()), T.StructField("i", T.LongType()),
        T.StructField("l", T.ArrayType(T.StringType())), T.StructField("ns", T.ArrayType(T.DoubleType())),
        T.StructField("m", T.MapType(T.StringType(), T.StringType())), T.StructField("b", T.BooleanType()),
        T.StructField("z", T.StringType()), T.StructField("deep", T.ArrayType(T.StructType([T.StructField("k", T.StringType())]))),
    ])
    cell = json.dumps({"M": {
        "s": {"S": "x"}, "n": {"N": "12.5"}, "i": {"N": "7"}, "l": {"L": [{"S": "a"}, {"N": "3"}]},
        "ns": {"NS": ["1", "2.5"]}, "m": {"M": {"k": {"S": "v"}}}, "b": {"BOOL": True}, "z": {"NULL": True},
        "deep": {"L": [{"M": {"k": {"S": "v1"}}}, {"M": {"k": {"S": "v2"}}}]},
    }})
    row = evaluate(lambda c: ev.unwrap(lt.read_json(c), shape), cell)[0].asDict(recursive=True)
    assert row == {
        "s": "x", "n": 12.5, "i": 7, "l": ["a", "3"], "ns": [1.0, 2.5], "m": {"k": "v"}, "b": True, "z": None,
        "deep": [{"k": "v1"}, {"k": "v2"}],
    }
    # Untagged data reads the same.
    plain = evaluate(lambda c: ev.unwrap(lt.read_json(c), shape), '{"s": "x", "deep": [{"k": "v"}]}')[0]
    assert (plain["s"], plain["deep"][0]["k"]) == ("x", "v")


def test_scalar_envelopes(evaluate):
    scalar = lambda c: F.to_json(ev.unwrap_scalar(lt.read_json(c)))
    assert evaluate(
        scalar, '{"S":"x"}', '{"N":"3"}', '{"N":"2.5"}', '{"N":"abc"}', '{"N":"1e5"}', '{"N":"007"}',
        '{"N":"123456789012345678901234567890"}', '{"BOOL":false}', '{"NULL":true}', '{"other":1}',
    ) == ['"x"', "3", "2.5", '"abc"', '"1e5"', "7", "123456789012345678901234567890", "false", None, '{"other":1}']


def test_collapse_list(evaluate):
    split = lambda mode: lambda c: F.to_json(F.struct(ev.collapse_list(F.split(c, ","), mode).alias("v")))
    assert evaluate(split("all"), "a,b") == ['{"v":["a","b"]}']
    assert evaluate(split("first"), "a,b") == ['{"v":"a"}']
    assert evaluate(lambda c: ev.collapse_list(F.filter(F.split(c, ","), lambda v: v == "z"), "first"), "a") == [None]
    with pytest.raises(ValueError):
        ev.collapse_list(F.col("c"), "last")


def test_envelopes_of_unknown_shape(evaluate):
    def opened(c):
        return F.to_json(ev.unwrap(lt.read_json(c), T.VariantType()))

    cases = {
        '{"M":{"option":{"L":[{"S":"a"},{"S":"b"}]}}}': {"option": ["a", "b"]},
        '{"L":[{"M":{"a":{"M":{"b":{"M":{}}}}}},{"L":[]},{"N":"1"},{"N":"2.5"},{"N":"x"},{"BOOL":false},{"NULL":true}]}':
            [{"a": {"b": {}}}, [], 1, 2.5, "x", False, None],
        '{"M":{"M":{"S":"x"},"S":{"S":"{\\"S\\": \\"y\\"}}]"},"L":{"SS":["p","q"]}}}': {"M": "x", "S": '{"S": "y"}}]', "L": ["p", "q"]},
        '{"S":"plain"}': "plain", '{"N":"7"}': 7, '{"a":1}': {"a": 1}, "[1]": [1],
    }
    found = evaluate(opened, *cases)
    assert [json.loads(f) for f in found] == list(cases.values())
    deep = '{"L":[' * 200 + '{"S":"x"}' + "]}" * 200
    assert json.loads(evaluate(opened, deep)[0]) == json.loads("[" * 200 + '"x"' + "]" * 200)


def test_nested_tags_leave_the_feedback_text(evaluate):
    cell = '{"M":{"type":{"S":"like"},"option":{"L":[{"S":"a"},{"M":{"k":{"N":"1"}}}]}}}'
    assert evaluate(fb.unwrap_feedback, cell) == ['{"option": ["a",{"k":1}], "type": "like"}']


_FORMS = [
    """['a' "b"]""", "{'k': {1, 2}}", "[b'x', 1]", "['''t''']", r"[r'a\d']", "{'a': 1_000}", "[0x1F]", "{1: 'a'}",
    "['it''s']", "[u'x']", '["""a "quoted"\nline"""]', "[-0x1f, 0o17, 0b101, +3, - 4, 1., .5, 1e5, 1.5E-3, -2.0]",
    "{None: 1, True: 2, 3.5: 4, -1: 5}", "[('a'), ('b',), (), (('c'))]", "('x')", "([1, 2])", "{'a'}", "{(1, 2), (3,),}",
    r"['\a\v\x41\101\0é\U0001F600\'\"\\\q\d']", r"[b'\x00\xffAA']", r"['😀']", "['a\\\nb']",
    "[rb'a\\b', bR'c', Br'd', U'e']", "[1, # one\n 2]", "{'a': [{'b': (1, {2, 3})}], 'c': {}}", "['\t tab']", "[[], {}, ()]",
    "[None, True, False]", "{'x': 'a' 'b', 'y': ('p' 'q')}", "['{', \"}\", '(', ':,']", "[1,\n 2,\n]", "{'a': -1, 'a': 2}",
    "['', \"\", '''''' , r'']", "[r'\\'']", "1", "'s'", "-5", "None", "['a', ['b', ('c', {'d': {'e'}})]]",
]
_NO_LITERALS = [
    "[1 2]", "['a' 1]", "[x]", "{'a' 1}", "[1,,2]", "[,]", "{,}", "(1", "['a\nb']", "[1}", "xb'a'", "['a'x]", "[1__0]", "{1: }",
    "[0x]", "[1.2.3]", "lambda: 1", "[*a]", "", "[f'x']",
]


def _as_json(value):
    """What a literal comes out as: sets and tuples as lists, bytes as text, keys as text."""
    if isinstance(value, dict):
        return {k if isinstance(k, str) else json.dumps(k): _as_json(v) for k, v in value.items()}
    if isinstance(value, set):
        return sorted((_as_json(v) for v in value), key=repr)
    if isinstance(value, (list, tuple)):
        return [_as_json(v) for v in value]
    return value.decode("latin-1") if isinstance(value, bytes) else value


def _sorted_sets(found, value):
    """The lists that stand for sets, in the order of the twin."""
    if isinstance(value, set):
        return sorted(found, key=repr)
    if isinstance(value, (list, tuple)):
        return [_sorted_sets(f, v) for f, v in zip(found, value, strict=True)]
    if isinstance(value, dict):
        return {k: _sorted_sets(f, v) for (k, f), v in zip(sorted(found.items()), (
            v for _, v in sorted((_as_json({k: 0}).popitem()[0], v) for k, v in value.items())), strict=True)}
    return found


def test_all_forms_of_literals(evaluate):
    found = evaluate(lambda c: F.to_json(lt.read_literal(c)), *_FORMS)
    for text, got in zip(_FORMS, found, strict=True):
        value = ast.literal_eval(text)
        wanted = json.loads(json.dumps(_as_json(value)))
        assert got is not None or wanted is None, text
        assert wanted is None or _sorted_sets(json.loads(got), value) == wanted, text


def test_what_is_no_literal_is_not_read(evaluate):
    for text in _NO_LITERALS:
        with pytest.raises((SyntaxError, ValueError)):
            ast.literal_eval(text)
    assert evaluate(lambda c: F.to_json(lt.read_literal(c)), *_NO_LITERALS) == [None] * len(_NO_LITERALS)


def test_random_literals_of_all_forms(evaluate):
    rng = random.Random(13)

    def string():
        body = "".join(rng.choice(["a", "'", '"', "\\", "{", ",", ":", "#", "ñ", "😀", " ", "None", "1"]) for _ in range(6))
        kind = rng.randrange(4)
        if kind == 0:
            return repr(body)
        if kind == 1:
            return '"""' + body.replace("\\", "\\\\").replace('"', '\\"') + '"""'
        if kind == 2:
            return "r" + repr(body.replace("\\", "").replace("'", ""))
        return repr(body.encode("latin-1", "ignore")) if rng.random() < 0.3 else repr(body) + rng.choice([" ", "", "\n"]) + repr(body)

    def scalar():
        return rng.choice([string, lambda: rng.choice(["0x1f", "-1_000", ".5", "2.", "1e3", "+7", "0b11", "None", "True"])])()

    def text_of(depth):
        kind = rng.randrange(8) if depth else 7
        comma, space = rng.choice(["", ","]), rng.choice(["", " ", "\n"])
        if kind < 2:
            return "[" + space + ", ".join(text_of(depth - 1) for _ in range(rng.randrange(1, 4))) + comma + "]"
        if kind == 2:
            return "(" + ", ".join(text_of(depth - 1) for _ in range(rng.randrange(2, 4))) + comma + space + ")"
        if kind < 5:
            return "{" + ", ".join(f"{k!r}:{space}{text_of(depth - 1)}" for k in rng.sample(["a", "b'", 'c"', 1, 2.5], 2)) + comma + "}"
        if kind == 5:
            return "{" + ", ".join(rng.sample(["1", "'x'", '"y"', "(1, 'z')", "2.5"], 3)) + comma + "}"
        return scalar()

    texts = ["[" + text_of(3) + "]" for _ in range(400)]
    found = evaluate(lambda c: F.to_json(lt.read_literal(c)), *texts)
    for text, got in zip(texts, found, strict=True):
        value = ast.literal_eval(text)
        assert got is not None, text
        assert _sorted_sets(json.loads(got), value) == json.loads(json.dumps(_as_json(value))), text


def _unwrapped(value):
    """The envelope rules, one value at a time."""
    if isinstance(value, list):
        return [_unwrapped(v) for v in value]
    if not isinstance(value, dict):
        return value
    if len(value) == 1:
        (tag, inner), = value.items()
        if tag in ("S", "BOOL") and not isinstance(inner, (dict, list)):
            return inner
        if tag == "N":
            return float(inner) if "." in inner else int(inner)
        if tag == "NULL":
            return None
        if tag == "L" and isinstance(inner, list):
            return [_unwrapped(v) for v in inner]
        if tag == "M" and isinstance(inner, dict):
            return {k: _unwrapped(v) for k, v in inner.items()}
        if tag in ("SS", "BS"):
            return list(inner)
        if tag == "NS":
            return [float(n) if "." in n else int(n) for n in inner]
    return {k: _unwrapped(v) for k, v in value.items()}


def test_random_trees_of_mixed_shapes(evaluate):
    rng = random.Random(14)
    keys = ["a", "b\"", "S", "M", "x{", "NS", "ñ]"]

    def tree(depth):
        kind = rng.randrange(10 if depth else 6)
        text = "".join(rng.choice('a"\\{}[]:,ñ😀\n') for _ in range(4))
        if kind < 6:
            return [{"S": text}, {"N": str(rng.randrange(-50, 50))}, {"N": "2.5"}, {"BOOL": True}, {"NULL": True},
                    {"NS": ["1", "-2.5", "30"]}][kind]
        # Only below a tag may a key be named like one.
        named = keys if kind == 6 else [k for k in keys if not k.isupper()]
        members = {k: tree(depth - 1) for k in rng.sample(named, rng.randrange(2, 4))}
        items = [tree(depth - 1) for _ in range(rng.randrange(3))]
        return [{"M": members}, {"L": items}, members, items][kind - 6]

    trees = [tree(5) for _ in range(300)] + [
        {"a": {"M": {"b": {"S": "z"}}}}, {"M": {"a": {"x": {"S": "t"}}}}, {"NS": ["1", "2"]}, {"M": {"S": {"S": "x"}}},
        {"M": {"M": {"M": {"M": {"N": "1"}}}}}, {"SS": ["{", "}"]}, {"L": []}, {"M": {}}, [], {}, {"k": [{"L": [{"k": {"S": "v"}}]}]},
    ]
    deep = {"S": "end"}
    for level in range(30):
        deep = {"M": {f"k{level}": {"L": [deep]}}} if level % 2 else {"plain": deep, "n": {"N": "1"}}
    trees.append(deep)
    found = evaluate(lambda c: F.to_json(ev.unwrap_any(lt.read_json(c))), *map(json.dumps, trees))
    for text, got in zip(trees, found, strict=True):
        assert (got and json.loads(got)) == _unwrapped(text), text


def test_values_that_hold_nothing_stay(evaluate):
    cells = {'"{x"': '"{x"', '"[S]"': '"[S]"', "7": "7", "true": "true", "null": "null", '""': '""', None: None, "{": None, "": None,
             '{"N":"x"}': '"x"', '{"NULL":true}': None, " [ ] ": "[]", "{}": "{}"}
    assert evaluate(lambda c: F.to_json(ev.unwrap_any(lt.read_json(c))), *cells) == [*cells.values()]


def test_wide_and_deep_cells_are_opened(evaluate):
    """As many passes as levels, however many brackets a level has, and 64 levels at most."""
    wide = '{"L":[' + ",".join(f'{{"M":{{"k":{{"N":"{i}"}},"NULL":{{"x":[{{"S":"a]"}}]}}}}}}' for i in range(300)) + "]}"
    mixed = lambda n: '[{"L":' * n + '[{"NS":["1"]}]' + "}]" * n
    found = evaluate(lambda c: F.to_json(ev.unwrap_any(lt.read_json(c))), wide, mixed(10), mixed(30))
    assert json.loads(found[0]) == [{"k": i, "NULL": {"x": ["a]"]}} for i in range(300)]
    assert found[1:] == ["[" * 12 + "1" + "]" * 12, "[" * 32 + "1" + "]" * 32]


def test_mixed_envelopes_of_one_row_group_are_opened_by_many_tasks(spark, tmp_path):
    from workload.queries import mixed_envelope

    rows = [(i if i % 10 else 7, [f'n"{i}', "M", "", "{[S"][i % 4], i % 3 if i % 5 else None) for i in range(2000)]
    rows.append((None, None, None))
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = mixed_envelope(spark, str(tmp_path))
    assert found.withColumn("task", F.spark_partition_id()).select("task").distinct().count() >= 3 * 4
    wanted = [(k, *([None] * 4 if k is None or size is None else [name, name, size, k])) for k, name, size in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)


def test_feedback_of_mixed_shapes(evaluate):
    cells = ['{"M":{"a":{"x":{"S":"t"}}}}', '{"M":{"type":{"S":"like"},"n":{"NS":["1","2.5"]}}}']
    assert evaluate(fb.unwrap_feedback, *cells) == ['{"a": {"x":"t"}}', '{"type": "like", "n": [1,2.5]}'][:1] + [
        '{"n": [1,2.5], "type": "like"}']
