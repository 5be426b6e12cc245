"""Record normalisation: answer normalisation, extraction from text, the
conversation fold (table of turns and results, one property), nested = long form, flat rows and quarantine."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from callframe.operators import normalize as N
from tests.conftest import SF0001, rows


TEXT_CASES = [
    ("", "[]"),
    ('[{"name":"f","arguments":{"n":1}}]', '[{"name":"f","arguments":{"n":1}}]'),
    ('  {"name":"f","arguments":{}}  ', '[{"name":"f","arguments":{}}]'),
    ("{'name':'f','arguments':{}}", '[{"name":"f","arguments":{}}]'),
    ('{"arguments":{}}', "[]"),
    ("not json", "[]"),
    ("5", "[]"),
]


def test_normalize_answers(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(TEXT_CASES)], "i int, c string")
    got = {r["i"]: r["x"] for r in rows(N.with_normalized_answers(df, "c", "x").select("i", "x"))}
    for i, (_, expected) in enumerate(TEXT_CASES):
        assert got[i] == expected


EXTRACT_CASES = [
    ('ok <tool_call>{"name":"g","arguments":{}}</tool_call>', '[{"name":"g","arguments":{}}]'),
    ('<tool_call>```json\n[{"name":"g"}]\n```</tool_call>', '[{"name":"g"}]'),
    ('<tool_call>{"name": broken</tool_call> later [{"name":"h"}]', "[]"),
    ('<TOOL_CALL>[{"name":"g"}]</TOOL_CALL>', '[{"name":"g"}]'),
    ('calls [{"name":"h","arguments":{"n":1}}] done', '[{"name":"h","arguments":{"n":1}}]'),
    ('a [1] b [2]', "[]"),
    ('[{"x":1}]', "[]"),
    ("I'm sorry, no matching tool", "[]"),
]


def test_extract_answers(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(EXTRACT_CASES)], "i int, c string")
    got = {r["i"]: r["x"] for r in rows(N.with_extracted_answers(df, "c", "x").select("i", "x"))}
    for i, (text, expected) in enumerate(EXTRACT_CASES):
        assert got[i] == expected, text


U1, U2 = ("user", "q1"), ("user", "q2")
CALL, BAD, NONE = ("function_call", '[{"name":"a"}]'), ("function_call", "oops"), ("function_call", "[]")
PLAIN, TAG_B, TAG_C = ("assistant", "plain"), ("assistant", '<tool_call>[{"name":"b"}]</tool_call>'), (
    "assistant", '<tool_call>[{"name":"c"}]</tool_call>')
A, B, C = '[{"name":"a"}]', '[{"name":"b"}]', '[{"name":"c"}]'

# turns of a conversation -> (query, answers)
FOLD_CASES = [
    ([("system", "sys")], ("", "[]")),
    ([U1], ("q1", "[]")),
    ([U1, U2], ("q2", "[]")),
    ([U1, PLAIN], ("q1", "[]")),
    ([U1, CALL], ("q1", A)),
    ([CALL, U1], ("q1", A)),
    ([U1, TAG_B], ("q1", B)),
    ([U1, TAG_B, TAG_C], ("q1", B)),            # the first text with calls counts
    ([U1, PLAIN, TAG_C, TAG_B], ("q1", C)),
    ([U1, CALL, TAG_B], ("q1", A)),             # a call outweighs a later text
    ([U1, TAG_B, CALL], ("q1", A)),             # and an earlier one
    ([U1, TAG_B, BAD], ("q1", "[]")),           # an unreadable call clears
    ([U1, TAG_B, BAD, TAG_C], ("q1", C)),       # and a later text fills again
    ([U1, CALL, NONE], ("q1", "[]")),
    ([U1, CALL, NONE, PLAIN, TAG_B, U2], ("q2", B)),
    ([U1, BAD, CALL, TAG_C], ("q1", A)),
]


def test_fold_by_table(spark):
    data = [(cid, t, role, content) for cid, (turns, _) in enumerate(FOLD_CASES)
            for t, (role, content) in enumerate(turns)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, content string")
    got = {r["record_id"]: (r["query"], r["answers"]) for r in rows(N.normalize_turns(df))}
    for cid, (turns, expected) in enumerate(FOLD_CASES):
        assert got[cid] == expected, turns


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from([U1, U2, CALL, BAD, NONE, PLAIN, TAG_B, TAG_C]), min_size=1, max_size=7),
       st.lists(st.sampled_from([CALL, BAD, NONE, PLAIN, TAG_B, TAG_C]), max_size=4))
def test_a_last_readable_call_decides(spark, before, after):
    """Whatever came before, a readable call followed only by texts wins."""
    turns = [*before, *after, CALL, TAG_B, PLAIN]
    df = spark.createDataFrame([(1, t, r, c) for t, (r, c) in enumerate(turns)],
                               "conv_id long, turn long, role string, content string")
    assert rows(N.normalize_turns(df))[0]["answers"] == A


def test_nested_equals_long(spark):
    import __spark_entry__ as E
    from pyspark.sql import functions as F
    from callframe.sources.fixtures import fixture
    turns = fixture(spark, SF0001, "turns")
    nested = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", "role", F.lit(None).cast("string").alias("from"), "content",
        F.lit(None).cast("string").alias("value")))).alias("m"))
    nested = nested.select("conv_id", F.transform("m", lambda x: x.dropFields("turn")).alias("conversations"))
    got = {r["record_id"]: (r["query"], r["answers"]) for r in rows(N.normalize_conversations(nested, id_col="conv_id"))}
    want = {r["record_id"]: (r["query"], r["answers"]) for r in rows(E.queries()["normalize_conversations"](spark, SF0001))}
    assert got == want


def test_nested_string_messages(spark):
    df = spark.createDataFrame([
        (1, "[{'from': 'human', 'value': 'hi'}, {'from': 'function_call', 'value': 'oops'}]",
         '[{"type":"function","function":{"name":"f"}}, 3]'),
        (2, "[{'from': 'human', 'value': 'it's'}]", "[]"),
    ], "record_id long, conversations string, tools string")
    got = {r["record_id"]: r for r in rows(N.normalize_conversations(df))}
    assert got[1]["query"] == "hi" and got[1]["error"] is None and got[1]["answers"] == "[]"
    assert json.loads(got[1]["tools"]) == [{"name": "f"}]
    assert got[2]["error"] == "messages_not_json"  # an apostrophe breaks the quote swap


def test_flat_quarantine_reasons(spark):
    import __spark_entry__ as E
    reasons = {r["error"] for r in rows(E.queries()["quarantine_records"](spark, SF0001))}
    assert reasons == {"tools_not_list", "tools_not_json", "tool_not_object", "query_not_string"}


def test_format_by_name():
    assert N.format_for("Org/xlam-function-calling-60k-ShareGPT") == "sharegpt"
    assert N.format_for("Salesforce/xlam-function-calling-60k") == "xlam"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


MESSAGES = [("user", "q1"), ("assistant", 'ok <tool_call>{"name":"g","arguments":{}}</tool_call>')]


def test_messages_may_have_any_of_the_four_fields(spark):
    for role, text in (("role", "content"), ("from", "value"), ("role", "value")):
        df = spark.createDataFrame([(1, MESSAGES, "x"), (2, [], "y"), (3, None, "z")],
                                   f"record_id long, messages array<struct<`{role}`:string,`{text}`:string>>, extra string")
        out = N.normalize_conversations(df, messages="messages", fallback=None, keep=["messages", "extra"])
        got = {r["record_id"]: (r["query"], r["answers"], r["extra"]) for r in rows(out)}
        assert got == {1: ("q1", '[{"name":"g","arguments":{}}]', "x"), 2: ("", "[]", "y"), 3: ("", "[]", "z")}
    only = spark.createDataFrame([(1, [("user",)])], "record_id long, messages array<struct<role:string>>")
    assert rows(N.normalize_conversations(only, messages="messages"))[0]["query"] == ""


def test_nested_fold_moves_no_row(spark):
    df = spark.createDataFrame([(1, MESSAGES, "[]")], "record_id long, conversations array<struct<role:string,content:string>>, tools string")
    plan = _plan(N.normalize_conversations(df))
    assert "Exchange" not in plan and "Generate" not in plan and "Python" not in plan


def test_nested_fold_by_table(spark):
    data = [(cid, turns, None) for cid, (turns, _) in enumerate(FOLD_CASES)]
    df = spark.createDataFrame(data, "record_id long, conversations array<struct<role:string,content:string>>, tools string")
    got = {r["record_id"]: (r["query"], r["answers"]) for r in rows(N.normalize_conversations(df))}
    for cid, (turns, expected) in enumerate(FOLD_CASES):
        assert got[cid] == expected, turns


def test_expression_forms_equal_the_staged_ones(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(TEXT_CASES + EXTRACT_CASES)], "i int, c string")
    staged = N.with_extracted_answers(N.with_normalized_answers(df, "c", "n"), "c", "e")
    for r in rows(staged.select("n", "e", N.normalized_answers(F.col("c")).alias("n2"), N.extracted_answers(F.col("c")).alias("e2"))):
        assert (r["n"], r["e"]) == (r["n2"], r["e2"])


def test_long_form_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "q", "a", 1), (1, 1, "assistant", "x", "b", 2), (2, 0, "user", "r", None, 3)],
                               "conv_id long, turn long, role string, content string, source string, n int")
    got = {r["record_id"]: (r["query"], r["source"], r["n"]) for r in rows(N.normalize_turns(df, carry=["source", "n"]))}
    assert got == {1: ("q", "b", 2), 2: ("r", None, 3)}
