"""Chat records of odd shapes: none ends the job, none loses text without saying so."""

import json

import pytest

from ledgerline.llm import chat

NAMED = chat.by_fingerprint(chat.LAYOUTS)
TURN = {"role": "user", "content": "hi"}

ODD = [
    (json.dumps({"messages": ["hello"]}), "unknown"),
    (json.dumps({"messages": [None]}), "unknown"),
    (json.dumps({"conversations": [1]}), "unknown"),
    (json.dumps({"messages": [TURN, "hello"]}), "unknown"),
    (json.dumps({"messages": [TURN, []]}), "unknown"),
    (json.dumps({"messages": [TURN, {}]}), "unknown"),
    (json.dumps({"messages": [[TURN]]}), "unknown"),
    (json.dumps({"messages": {}}), "unknown"),
    (json.dumps({"messages[]": {"role": "a", "content": "b"}}), "unknown"),
    (json.dumps({"messages[0]": "x"}), "unknown"),
    (json.dumps({"data.question": "q", "data.answer.text": "a"}), "unknown"),
    (json.dumps({"data": {"question": "q", "answer.text": "a"}}), "unknown"),
    (json.dumps({"prompt\\": "q", "response": "a"}), "unknown"),
    (json.dumps({"": "q"}), "unknown"),
    ("[" * 100_000, "broken"),
    ('{"messages": ' + "[" * 100_000 + "]" * 100_000 + "}", "broken"),
    ('{"a":' * 50_000 + "1" + "}" * 50_000, "broken"),
    ('{"prompt": "a", "prompt": "b", "response": "c"}', "broken"),
    ('{"messages": [{"role": "user", "content": "a", "content": "b"}]}', "broken"),
    ('{"prompt": "\\ud800", "response": "c"}', "broken"),
    ('{"\\ud800": "c"}', "unknown"),
    ('{"prompt": "a"', "broken"),
    ("[]", "broken"),
    ("null", "broken"),
    ("", "broken"),
    (None, "broken"),
]
GOOD = [
    ({"messages": []}, "messages", []),
    ({"messages": [TURN, {"role": None, "content": 5}]}, "messages", [("user", "hi"), ("", "5")]),
    ({"conversations": [{"from": "gpt", "value": "x"}], "id": 1}, "shares", [("assistant", "x")]),
    ({"prompt": {}, "response": None}, "prompt", [("user", "{}"), ("assistant", "")]),
    ({"data": {"question": "q", "answer": {"text": "a"}}}, "nested", [("user", "q"), ("assistant", "a")]),
]


@pytest.mark.parametrize("k", range(len(ODD)))
def test_no_record_ends_the_job(k):
    record, layout = ODD[k]
    assert chat.canonical(record, NAMED) == (layout, None)


@pytest.mark.parametrize("k", range(len(GOOD)))
def test_declared_shapes(k):
    record, layout, turns = GOOD[k]
    assert chat.canonical(json.dumps(record), NAMED) == (layout, turns)


def test_odd_records_as_a_table(spark):
    rows = [(r, k) for k, (r, _) in enumerate(ODD)] + [(json.dumps(r), 100 + k) for k, (r, _, _) in enumerate(GOOD)]
    records = spark.createDataFrame(rows, "record string, chat int")
    out = {r["input_chat"]: r["chat"] for r in chat.format_records(records).collect()}
    assert [out[k]["layout"] for k in range(len(ODD))] == [layout for _, layout in ODD]
    assert all(out[k]["formatted"] is None and out[k]["loss_spans"] is None for k in range(len(ODD)))
    assert [chat.parse(out[100 + k]["formatted"]) for k in range(len(GOOD))] == [turns for _, _, turns in GOOD]
    both = records.withColumnRenamed("record", "input_chat")
    assert chat.format_records(both, "input_chat").columns == ["input_chat", "input_input_chat", "chat"]
    from_chat = records.drop("chat").withColumnRenamed("record", "chat")
    assert {r["chat"]["layout"] for r in chat.format_records(from_chat, "chat").collect()} >= {"messages", "broken", "unknown"}
