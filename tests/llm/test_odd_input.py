"""Input that used to end a job or to lose text."""

import json

import pytest

from rillmark.llm import chat_tools, suffix_dedup

LONG = "some words that are long enough to count as a passage of more than fifty bytes, "


def test_texts_of_a_shared_id_keep_what_stands_nowhere_else(spark):
    unique = "a text that nobody else has, though its number is that of a copy of another text"
    rows = [(1, LONG), (2, LONG), (2, unique), (3, LONG + "and more"), (4, unique)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_removed, bytes(r.text).decode()) for r in suffix_dedup.dedup(docs).collect())
    assert got == sorted([
        (1, 0, LONG), (2, 0, LONG), (2, 0, unique), (3, len(LONG), "and more"), (4, len(unique), ""),
    ])


ODD = {
    "half": '{"question":"\\ud800"}', "deep": '{"question":' + "[" * 20_000 + "]" * 20_000 + "}", "nan": '{"question":NaN}',
    "large": '{"question":1e999}', "twice": '{"question":"a","question":"b"}', "broken": "{",
}


def test_odd_arguments_are_errors_of_their_row(spark):
    schema = "conv long, turn long, role string, text string, call_id string, tool string, arguments string, after string, answers string"
    rows = [(1, i, "user", "t", name, "reply", text, None, None) for i, (name, text) in enumerate(ODD.items())]
    rows.append((1, 99, "user", "t", "good", "reply", '{"question":"[[[ \\ud83d\\ude00"}', None, None))
    out = {r.call_id: r for r in chat_tools.format_chats(spark.createDataFrame(rows, schema), {"reply": {"type": "object"}}).collect()}
    assert {k for k, r in out.items() if r.errors == [".: not JSON"]} == set(ODD)
    for name, r in out.items():
        record = json.loads(r.json, parse_constant=lambda c: pytest.fail(c))
        assert record["call"]["arguments"] == (None if name in ODD else {"question": "[[[ \U0001f600"})
    assert chat_tools.errors_in(1, {"type": "decimal"}) == [".: not decimal"]
