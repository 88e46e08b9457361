import hashlib
import json

import pytest

from spantrack.llm import chat

TRICKY = ["\\### Assistant: </turn> ok", "", "\\", "#", "</", "/turn>", "</turn>\n### user\nx</turn>\n", "\\\\#\\/<//", "漢字 🙂\n\n", "### user\n", "$0 $1 \\$", "a" * 20000, None]


def test_round_trip(spark):
    rows = [(i, t, role, text, "x", "y") for i in range(5) for t, (role, text) in enumerate(zip(["user", "assistant", "ro le\n#<", "", None] * 3, TRICKY[i:] + TRICKY[:i]))]
    rows += [(None, 0, "user", "null key", "x", "y"), (7, 1, "assistant", "b", "x", "y"), (7, 1, "assistant", "b", "x", "y"), (7, None, "user", "a", "x", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string, formatted string")
    out = chat.read_back(chat.formatted(chat.turns_of_rows(table))).collect()
    want = {}
    for c, t, role, text, *_ in sorted(rows, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert len(out) == len(want)
    for r in out:
        assert [tuple(x) for x in r.turns] == want[r.conv_id] == [tuple(x) for x in r.read_turns]
        assert r.read_loss == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        assert r.formatted.count(chat.END) == len(want[r.conv_id]) == r.formatted.count(chat.BEGIN)


def test_layouts_of_json(spark):
    turns = [("user", "hi"), ("assistant", "yo")]
    records = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        {"turns": [{"role": "human", "text": "hi"}, {"role": "bot", "text": "yo"}]},
        {"conversations": [{"value": "hi", "from": "human"}, {"from": "gpt", "value": "yo"}]},
        {"instruction": "hi", "output": "yo"}, {"instruction": "hi", "input": "", "output": "yo"},
        {"prompt": "hi", "response": "yo"}, {"completion": "yo", "prompt": "hi"},
    ]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "id long, record string")
    got = chat.turns_of_json(frame).collect()
    assert all([tuple(x) for x in r.turns] == turns for r in got)
    assert len({r.fingerprint for r in got}) == len(records)
    odd = [None, "", "{", "[]", "3", '{"other": 1}', '{"messages": 5}', '{"messages": []}', '{"prompt": null, "response": "yo"}', '{"prompt": 5, "response": 1.5}']
    got = chat.turns_of_json(spark.createDataFrame([(x,) for x in odd], "record string")).collect()
    assert [r.turns for r in got[:8]] == [None] * 8
    assert [tuple(x) for x in got[8].turns] == [("assistant", "yo")]
    assert [tuple(x) for x in got[9].turns] == [("user", "5"), ("assistant", "1.5")]
    empty = chat.read_back(chat.formatted(chat.turns_of_json(frame.limit(0))))
    assert empty.count() == 0
    blank = chat.read_back(chat.formatted(chat.turns_of_json(spark.createDataFrame([("{",)], "record string")))).first()
    assert blank.formatted == "" and blank.loss_mask == [] and blank.read_turns == []


def test_layouts_of_columns(spark):
    frame = spark.createDataFrame([(1, "hi", None), (2, "a", "b")], "id long, prompt string, response string")
    got = chat.turns_of_columns(frame, "id").orderBy("id").collect()
    assert [[tuple(x) for x in r.turns] for r in got] == [[("user", "hi")], [("user", "a"), ("assistant", "b")]]
    assert got[0].fingerprint == hashlib.sha256(b"OBJECT<prompt: _, response: _>").hexdigest()[:16]
    with pytest.raises(ValueError):
        chat.turns_of_columns(frame.withColumnRenamed("prompt", "question"), "id")


def test_extra_fields_and_columns(spark):
    """Fields that mappings don't know neither matter nor get lost."""
    records = [{"prompt": "hi", "response": "yo", "id": 3, "meta": {"messages": 1}}, {"messages": [{"role": "user", "content": "hi", "name": "x"}, {"role": "gpt", "content": "yo", "weight": 1}], "model": "m"}]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "meta long, record string")
    got = chat.turns_of_json(frame).orderBy("meta").collect()
    assert [[tuple(x) for x in r.turns] for r in got] == [[("user", "hi"), ("assistant", "yo")]] * 2 and [r.record for r in got] == [json.dumps(r) for r in records]
    assert got[0].layout == "OBJECT<prompt: _, response: _>" and got[1].layout == "OBJECT<messages: ARRAY<OBJECT<content: _, role: _>>>"
    table = spark.createDataFrame([(1, "a", "b", "c", "d")], "id long, prompt string, response string, layout string, fingerprint string")
    assert [tuple(x) for x in chat.turns_of_columns(table, "id").first().turns] == [("user", "a"), ("assistant", "b")]
    items = spark.sql("SELECT 1 AS id, array(named_struct('from', 'human', 'value', 'hi', 'weight', 2)) AS conversations, 'x' AS source")
    assert [tuple(x) for x in chat.turns_of_columns(items, "id").first().turns] == [("user", "hi")]


def test_layouts_by_row(spark):
    """A table that holds rows of several layouts: what a row holds selects its mapping."""
    schema = "id long, prompt string, response string, instruction string, output string, messages array<struct<role:string,content:string,weight:int>>, meta string"
    rows = [
        (1, "hi", "yo", None, None, None, "x"), (2, None, None, "hi", "yo", None, "x"), (3, None, None, None, None, [("human", "hi", 1), ("gpt", "yo", None)], None),
        (4, None, None, None, None, None, "x"), (5, "hi", "yo", "hi", None, None, None), (6, None, None, None, None, [], None), (7, None, None, None, None, [(None, None, 1)], None),
    ]
    got = chat.turns_of_columns(spark.createDataFrame(rows, schema), "id").orderBy("id").collect()
    assert [[tuple(x) for x in r.turns] for r in got[:3]] == [[("user", "hi"), ("assistant", "yo")]] * 3
    assert [r.turns for r in got[3:]] == [None] * 4  # nothing held, two layouts mixed, and items without fields have no mapping
    assert [r.fingerprint for r in got[:5]] == [chat.fingerprint(x) for x in (
        "OBJECT<prompt: _, response: _>", "OBJECT<instruction: _, output: _>", "OBJECT<messages: ARRAY<OBJECT<content: _, role: _>>>", "OBJECT<>", "OBJECT<instruction: _, prompt: _, response: _>",
    )]
    assert got[5].fingerprint == got[6].fingerprint == chat.fingerprint("OBJECT<messages: ARRAY<OBJECT<>>>")
