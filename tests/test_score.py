"""Decision table: one hand-written row per line plus the
fixture's expected counts."""

import pytest

import __spark_entry__ as E
from callframe.functions import json_ops as J
from callframe.operators import metrics as M
from callframe.operators import score as S
from tests.conftest import SF0001, rows

TOOLS = '[{"name":"f"},{"name":"g"},{"type":"function","function":{"name":"h"}}]'
CALL = '[{"name":"f","arguments":{"a":1}}]'

# (truth answers, model output, expected outcome, expected category)
CASES = [
    ("[]", "I'm sorry [ABORT: no tool]", "True Negative", None),
    ("[]", "<tool_call>" + CALL + "</tool_call>", "False Positive", "error_hallucinated_tool"),
    (CALL, "<tool_call>{\"name\": </tool_call>", "False Negative", "error_syntax"),
    (CALL, "no call at all", "False Negative", "error_missing_tool"),
    (CALL, "[ABORT: x] <tool_call>" + CALL + "</tool_call>", "False Negative", "error_missing_tool"),
    (CALL, "<tool_call>{}</tool_call>", "False Negative", "error_missing_tool"),
    (CALL, "<tool_call>[]</tool_call>", "False Negative", "error_missing_tool"),
    (CALL, "<tool_call>[5]</tool_call>", "False Negative", "error_syntax"),
    (CALL, '<tool_call>[{"name":"zz","arguments":{"a":1}}]</tool_call>', "False Negative", "error_hallucinated_tool"),
    (CALL, '<tool_call>[{"name":"g","arguments":{"a":1}}]</tool_call>', "False Negative", "error_hallucinated_tool"),
    # the predicted name is stripped before the membership test
    (CALL, '<tool_call>[{"name":" f ","arguments":{"a":1}}]</tool_call>', "True Positive", None),
    (CALL, '<TOOL_CALL>```json\n[{"name":"f","arguments":{"a":1.0}}]\n```</TOOL_CALL>', "True Positive", None),
    (CALL, '<tool_call>{"name":"f","arguments":"{\\"a\\": 1}"}</tool_call>', "True Positive", None),
    ('[{"name":"f","arguments":{"a":100}}]', '<tool_call>[{"name":"f","arguments":{"a":1e2}}]</tool_call>', "True Positive", None),
    (CALL, '<tool_call>[{"name":"f","arguments":{"a":true}}]</tool_call>', "True Positive", None),
    (CALL, '<tool_call>[{"name":"f","arguments":{"a":1,"b":2}}]</tool_call>', "False Negative", "error_hallucinated_param"),
    (CALL, '<tool_call>[{"name":"f","arguments":{}}]</tool_call>', "False Negative", "error_missing_param"),
    (CALL, '<tool_call>[{"name":"f","arguments":{"a":"1"}}]</tool_call>', "False Negative", "error_type_mismatch"),
    (CALL, '<tool_call>[{"name":"f","arguments":{"a":null}}]</tool_call>', "False Negative", "error_type_mismatch"),
    (CALL, '<tool_call>[{"name":"f","arguments":{"a":2}}]</tool_call>', "False Negative", "error_value_mismatch"),
    ('[{"name":"f","arguments":{"a":[1,2]}}]', '<tool_call>[{"name":"f","arguments":{"a":[1]}}]</tool_call>', "False Negative", "error_value_mismatch"),
    ('[{"name":"f","arguments":{"a":{"x":1}}}]', '<tool_call>[{"name":"f","arguments":{"a":{"x":1,"y":2}}}]</tool_call>', "False Negative", "error_value_mismatch"),
    (CALL, "<tool_call>{'name':'f','arguments':{'a':1}}</tool_call>", "False Negative", "error_syntax"),
    (CALL, "<tool_call>[1] x</tool_call>", "False Negative", "error_syntax"),
    ('{"name":"f","arguments":{"a":1}}', '<tool_call>' + CALL + '</tool_call>', "Invalid", "invalid_truth_not_a_list"),
    ('[{"name":"h","arguments":{}}]', '<tool_call>[{"name":"h"}]</tool_call>', "True Positive", None),
]


@pytest.fixture(scope="module")
def decided(spark):
    data = [(i, "q", TOOLS, t, o, 1.0, 1) for i, (t, o, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(data, "record_id long, query string, tools string, answers string, "
                                     "raw_response string, latency_ms double, generated_tokens long")
    scored = S.score(df.select("record_id", "query", "tools", "answers"),
                     df.select("record_id", "raw_response", "latency_ms", "generated_tokens"))
    return {r["record_id"]: r for r in rows(scored.select("record_id", "outcome", "error_category"))}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_decision_row(decided, i):
    truth, output, outcome, category = CASES[i]
    got = decided[i]
    assert (got["outcome"], got["error_category"]) == (outcome, category), (truth, output)


def test_fixture_counts_sf0001(spark):
    import __spark_entry__ as E
    got = rows(E.entry(spark))[0]
    assert got == {"total_samples": 1000, "true_positives": 334, "false_positives": 170,
                   "true_negatives": 34, "false_negatives": 462, "invalid": 0, "no_output": 0}


def test_error_distribution_sf0001(spark):
    import __spark_entry__ as E
    got = {r["category"]: r["n"] for r in rows(E.queries()["error_distribution"](spark, SF0001))}
    assert got["hallucinated_tool"] == 236
    for c in ("syntax", "hallucinated_param", "missing_param", "type_mismatch", "value_mismatch", "missing_tool"):
        assert got[c] == 66


def test_perf_guards_zero_latency(spark):
    df = spark.createDataFrame([(1, 0.0, 5)], "record_id long, latency_ms double, generated_tokens long")
    got = rows(M.perf(df))[0]
    assert got["tokens_per_second"] == 0.0 and got["avg_latency_ms"] == 0.0


# -- property: argument equality is reflexive and blind to key order ---------

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_SCALARS = st.one_of(st.integers(-5, 5), st.booleans(), st.none(), st.text("ab", max_size=2),
                     st.sampled_from([1.5, 100.0, 0.0]))
_VALUES = st.recursive(_SCALARS, lambda inner: st.one_of(
    st.lists(inner, max_size=2), st.dictionaries(st.sampled_from("xyz"), inner, max_size=2)), max_leaves=4)
_ARGS = st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), _VALUES, min_size=1, max_size=4)


@settings(max_examples=8, deadline=None)
@given(st.lists(_ARGS, min_size=1, max_size=8))
def test_equal_arguments_in_any_key_order_are_true_positives(spark, args_list):
    import json
    data = []
    for i, args in enumerate(args_list):
        truth = json.dumps([{"name": "f", "arguments": args}])
        reordered = dict(reversed(list(args.items())))
        out = "<tool_call>" + json.dumps([{"arguments": reordered, "name": "f"}]) + "</tool_call>"
        data.append((i, "q", TOOLS, truth, out, 1.0, 1))
    df = spark.createDataFrame(data, "record_id long, query string, tools string, answers string, "
                                     "raw_response string, latency_ms double, generated_tokens long")
    scored = S.score(df.select("record_id", "query", "tools", "answers"),
                     df.select("record_id", "raw_response", "latency_ms", "generated_tokens"))
    outcomes = {r["outcome"] for r in scored.select("outcome").collect()}
    assert outcomes == {"True Positive"}


def test_json_equal_helper(spark):
    df = spark.createDataFrame([
        (1, '{"a":1,"b":[1,2]}', '{"b":[1,2],"a":1.0}'),
        (2, '{"a":1e2}', '{"a":100}'),
        (3, '{"a":"1"}', '{"a":1}'),
        (4, '[1,2]', '[1]'),
        (5, 'true', '1'),
    ], "i int, x string, y string")
    got = {r["i"]: (r["eq"], r["eq_same_type"]) for r in S.with_json_equal(df, "x", "y", "eq").collect()}
    assert got[1] == (True, True) and got[2] == (True, True)
    assert got[3] == (False, False)
    assert got[4] == (False, True)      # lists zip to the shorter
    assert got[5] == (True, True)       # bool counts as a number


def test_rows_without_an_output_count_beside_the_samples(spark):
    from callframe.operators import metrics as M
    from callframe.plans.jobs import report_frame
    call = '[{"name":"f","arguments":{"n":1}}]'
    truth = spark.createDataFrame([(i, "q", '[{"name":"f"}]', call) for i in (1, 2)], "record_id long, query string, tools string, answers string")
    outputs = spark.createDataFrame([(1, f"<tool_call>{call}</tool_call>", 100.0, 10)],
                                    "record_id long, raw_response string, latency_ms double, generated_tokens long")
    scored = S.score(truth, outputs)
    c = M.confusion(scored).first()
    assert (c.total_samples, c.true_positives, c.no_output) == (1, 1, 1)
    assert M.perf(scored).first().avg_latency_ms == 100.0
    r = report_frame(scored).first()
    assert (r.total_samples, r.no_output, r.performance.avg_latency_ms) == (1, 1, 100.0)


def test_cube_has_every_subtotal_in_one_exchange(spark):
    from callframe.operators import metrics as M
    from pyspark.sql import functions as F
    scored = spark.createDataFrame([("a", 1, S.TP), ("a", 2, S.FN), ("b", 1, S.TP), (None, 1, S.NO_OUTPUT)], "tool string, day int, outcome string")
    cube = M.by_dimensions(scored, {"tool": F.col("tool"), "day": F.col("day")})
    assert cube._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r.level, r.tool, r.day): (r.total_samples, r.no_output) for r in cube.collect()}
    assert got[3, None, None] == (3, 1) and got[1, "a", None] == (2, 0) and got[2, None, 1] == (2, 1)
    assert got[1, None, None] == (0, 1) and got[0, "b", 1] == (1, 0) and len(got) == 4 + 3 + 2 + 1


def _python_kinds(p, g) -> bool:
    number = (bool, int, float)
    if isinstance(p, number) and isinstance(g, number):
        return True
    if type(p) is not type(g):
        return False
    if isinstance(p, dict):
        return all(_python_kinds(p[k], g[k]) for k in p.keys() & g.keys())
    return all(map(_python_kinds, p, g)) if isinstance(p, list) else True


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(_VALUES, _VALUES), min_size=20, max_size=60))
def test_equality_and_kinds_are_pythons(spark, pairs):
    import json
    pairs = pairs + [(p, p) for p, _ in pairs[:5]] + [(1e16, 10 ** 16), (True, 1.0), (0.1, 0.1), (2 ** 53 + 1, 2 ** 53), (1e300, 1e300),
                                                      ([1, 2], [1.0, True]), ({"a": "\\\"{"}, {"a": "\\\"{"}), (-5, -5.0), (1e2, 100)]
    df = spark.createDataFrame([(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    for r in S.with_json_equal(df, "a", "b").collect():
        a, b = pairs[r.i]
        assert (r.json_equal, r.json_equal_same_type) == (a == b, a == b or _python_kinds(a, b)), (a, b)


def test_the_jvm_compiles_every_stage_of_scoring(spark):
    # a method of 8,000 bytes or more is interpreted, row for row
    df = E.queries()["confusion"](spark, SF0001)
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 4 and max(sizes) < 8000


def test_kinds_of_both_sides_are_worked_out_once(spark):
    plan = S.with_json_equal(spark.createDataFrame([("{}", "{}")], "a string, b string"), "a", "b")._jdf \
        .queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 2
    assert "exists(" not in plan  # its lambda held the other side's fold


def test_shapes_and_strings_of_json_values(spark):
    texts = ['{}', '{"a":{"b":1}}', '[]', '[1,[2]]', 'null', '"x"', '"12"', '""', '12', '1.5', '1e300', 'true', '1],[2', '{} x', None]
    df = J.with_json(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", "v")
    got = {r["i"]: tuple(r)[1:] for r in df.select(
        "i", J.is_object("v"), J.is_array("v"), J.length("v"), J.keys("v"), J.string_of("v"), J.as_string("v")).collect()}
    want = [(True, False, None, [], None), (True, False, None, ["a"], None), (False, True, 0, None, None),
            (False, True, 2, None, None), *[(False, False, None, None, s) for s in (
                None, "x", "12", "", None, None, None, None, None, None, None)]]
    assert [got[i][:5] for i in range(len(texts))] == want
    assert all(g[4] == g[5] for g in got.values())
