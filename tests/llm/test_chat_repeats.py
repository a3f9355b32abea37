"""Calls with one identifier in one turn."""

from rillmark.llm import chat_tools

MESSAGES = "conv string, turn int, role string, text string, call_id string, tool string, arguments string, after string, answers string"


def test_calls_that_differ_in_arguments_or_need_are_repeats(spark):
    call = lambda conv, arguments, after=None: (conv, 1, "assistant", None, "c", "sum", arguments, after, None)
    rows = [call("a", '{"x": 1}'), call("a", '{"x": 2}'), call("a", None, "d"), call("b", "{}"), call("b", "{}", "d")]
    out = chat_tools.format_chats(spark.createDataFrame(rows, MESSAGES), {"sum": {}}).collect()
    assert sorted((r.conv, r.repeated) for r in out) == [("a", False), ("a", True), ("a", True), ("b", False), ("b", True)]
