"""Cells of any size: what is cut into elements equals what is read whole."""

import json
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from parlance.functions import cells as ce, literal as lt, tokens as tk, transcript as tr
from parlance.plans import token_costs as tc

TEXTS = ["a", "it's", 'say "x", ok', "{[(", "]})", "a\\b", "ñ😀", "", " , ", "x: y", "'", "['a', 1]", "line\nbreak"]


def messages(rng, n):
    return [{"from": rng.choice(["user", "bot", "Sys"]), "text": rng.choice(TEXTS), "n": [1, {"k": None}]} for _ in range(n)]


def conversations():
    rng = random.Random(5)
    out = ["", "plain text", "[]", "[ ]", "[broken", "[1] [2]", "{}", '{"from":"user","text":"solo, {x}"}', "[1, 2,]", "None", None]
    for _ in range(60):
        plain = messages(rng, rng.randrange(5))
        tagged = [{"M": {k: {"S": v} for k, v in m.items() if k != "n"}} for m in plain]
        out += [json.dumps(plain), repr(plain), json.dumps(tagged), json.dumps({"L": tagged}), json.dumps(plain, indent=1)]
    return out


def test_cut_conversations_equal_whole_ones(evaluate):
    cases = conversations()
    for function in (tr.transcript, tr.json_questions, lambda c, **k: tr.role_text(c, "user", **k)):
        assert evaluate(lambda c: function(c, whole_bytes=0), *cases) == evaluate(function, *cases)


def test_elements(evaluate):
    cases = {
        "[1, 'a, b', {'x': [1, 2]}, (3, 4)]": ["1", "'a, b'", "{'x': [1, 2]}", "(3, 4)"],
        '[{"a": "]}"}, "\\"", [[[]]]]': ['{"a": "]}"}', '"\\""', "[[[]]]"], "[]": [], "[ ]": [], "[1,]": ["1"],
        "[1, ]": ["1"], "[1}": None, "[(1]": None, "x": None, None: None, "['''a'b''', 2]": ["'''a'b'''", "2"],
        "[" * 10 + "1" + "]" * 10: ["[" * 9 + "1" + "]" * 9], "[" * 20 + "1" + "]" * 20: None,
    }
    assert evaluate(ce.split_list, *cases) == list(cases.values())
    members = {
        '{"a": 1, "b:": {"c": [1, 2]}, "d": "x, y"}': [("\"a\"", "1"), ("\"b:\"", '{"c": [1, 2]}'), ("\"d\"", '"x, y"')],
        "{}": [], "{ }": [], "{1: 2}": None, '{"a" 1}': None, "[1]": None, '{"a": 1,}': [("\"a\"", "1")],
    }
    found = evaluate(ce.split_members, *members)
    assert [f and [tuple(m) for m in f] for f in found] == [m or (None if m is None else []) for m in members.values()]


def test_a_list_that_cannot_be_read_is_never_plain_text(evaluate):
    # An element that no reader takes, as one beyond the limit of a VARIANT would be.
    cell = '[{"from": "user", "text": "a"}, {"from": "user" "text": "b"}]'
    assert evaluate(lambda c: tr.transcript(c, whole_bytes=10), cell) == [None]
    status = evaluate(lambda c: tr.cell_status(c, whole_bytes=10), cell, "plain text of some length", "", "[{'from': 'user', 'text': 'x'}]")
    assert status == ["too_large", "text", "blank", "messages"]


def test_message_maps_cut_into_members(evaluate):
    rng = random.Random(6)
    maps = ["{}", '{"a": 1}', '{"a": {"role": "user", "content": "x"}, "a": {"role": "user", "content": "abcdefgh"}}', "[1]", "x"]
    for _ in range(60):
        entries = {f"id{i}": {"role": rng.choice(["user", "assistant"]), "content": [{"body": rng.choice(TEXTS) * 3}]} for i in range(4)}
        entries["list"] = [{"role": "user", "content": rng.choice(TEXTS)}]
        tagged = {"M": {k: {"M": {"role": {"S": v["role"]}, "content": {"S": v["content"][0]["body"]}}}
                        for k, v in entries.items() if k != "list"}}
        maps += [json.dumps(entries), json.dumps(tagged), json.dumps(tagged["M"])]

    def counted(whole_bytes):
        def of(c):
            read = tk.read_message_map(c, whole_bytes)
            return F.concat_ws(",", tc.count_tokens(read["value"], read["members"])["input_token"].cast("string"),
                               tc.count_tokens(read["value"], read["members"])["output_token"].cast("string"), read["parse_status"])
        return of

    assert evaluate(counted(0), *maps) == evaluate(counted(ce.WHOLE_BYTES), *maps)


def test_members_below_an_untagged_root_are_opened(evaluate):
    cell = json.dumps({"t1": {"M": {"role": {"S": "user"}, "content": {"L": [{"M": {"body": {"S": "x" * 400}}}]}}}})
    assert evaluate(lambda c: tc.count_tokens(lt.read_json(c))["input_token"], cell) == [100]


LARGE = """
import sys
from parlance.session import build_session
from parlance.functions.transcript import cell_status, transcript
from pyspark.sql import functions as F
spark = build_session("large", "local[1]", spark_ui_enabled="false", spark_driver_memory="14g")
spark.sparkContext.setLogLevel("ERROR")
for size, quote in ((int(sys.argv[1]), '"'), (int(sys.argv[2]), "'")):
    body = "abcdefghi " * 100
    n = size // (len(body) + 30)
    one = f"{{'from': 'user', 'text': '{body}x'}}".replace("'", quote)
    cell = F.concat(F.lit("["), F.repeat(F.lit(one + ", "), n - 1), F.lit(one + "]"))
    wanted = F.concat(F.repeat(F.lit(f"user: {body}x | "), n - 1), F.lit(f"user: {body}x"))
    row = spark.range(1).select(cell.alias("c")).select(
        F.octet_length("c").alias("n"), F.md5(transcript(F.col("c"))).alias("got"), F.md5(wanted).alias("wanted")).first()
    assert row.n > size * 0.9 and row.got == row.wanted, (row, quote)
    print("equal", row.n)
"""


@pytest.mark.parametrize(("json_bytes", "literal_bytes"), [(200_000_000, 140_000_000)])
def test_cells_beyond_the_limit_of_one_value(json_bytes, literal_bytes):
    done = subprocess.run(
        [sys.executable, "-c", LARGE, str(json_bytes), str(literal_bytes)], capture_output=True, text=True, timeout=600)
    assert done.stdout.count("equal") == 2, done.stderr[-2000:]
