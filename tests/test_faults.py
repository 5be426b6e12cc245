"""Cases that earlier versions answered wrongly."""

from callframe.operators import corpus as T
from callframe.operators import score as S
from callframe.operators import toolexec as C
from callframe.plans import jobs as P
from tests.conftest import rows

CALL = '[{"name":"f","arguments":{"n":1}}]'


def _scored(spark, truth, outputs):
    t = spark.createDataFrame(truth, "record_id long, query string, tools string, answers string")
    o = spark.createDataFrame(outputs, "record_id long, raw_response string, latency_ms double, generated_tokens long")
    return {r["record_id"]: (r["outcome"], r["error_category"]) for r in rows(S.score(t, o))}


def test_missing_tools_make_a_call_hallucinated(spark):
    answer = f"<tool_call>{CALL}</tool_call>"
    got = _scored(spark, [(1, "q", None, CALL), (2, "q", '{"name":"f"}', CALL), (3, "q", '[{"name":"f"}]', CALL)],
                  [(i, answer, 1.0, 1) for i in (1, 2, 3)])
    assert got[1] == got[2] == (S.FN, "error_hallucinated_tool") and got[3] == (S.TP, None)


def test_records_without_an_output_are_listed(spark):
    got = _scored(spark, [(1, "q", '[{"name":"f"}]', CALL), (2, "q", "[]", "[]")], [(2, "no", 1.0, 1), (9, "no", 1.0, 1)])
    assert got == {1: (S.NO_OUTPUT, "no_output"), 2: (S.TN, None)}
    t = spark.createDataFrame([(1,), (2,)], "record_id long")
    o = spark.createDataFrame([(2,), (9,)], "record_id long")
    assert [r["record_id"] for r in rows(S.orphan_outputs(t, o))] == [9]


def test_kinds_are_compared_on_common_paths(spark):
    cases = [('{"a":1,"b":[1,"x"]}', '{"a":true,"b":[2.5,"y",null],"c":3}', True), ('{"a":{"b":1}}', '{"a":{"b":"1"}}', False),
             ('{"a":[]}', '{"a":{}}', False), ('{"a":null}', '{"a":0}', False), ('[[1],[2,"x"]]', '[["1"]]', False),
             ('{"a.b":1,"c":{"d":"}"}}', '{"a":{"b":"1"},"c":{"d":"{,"}}', True), ('{"a":{"x":[{"k":1}]}}', '{"a":{"x":[{"k":{}}]}}', False)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = {r.i: r.json_equal_same_type for r in S.with_json_equal(df, "a", "b").collect()}
    assert [got[i] for i in range(len(cases))] == [want for *_, want in cases]


def test_a_tool_with_an_empty_name_is_not_none(spark):
    df = spark.createDataFrame([(1, "q", '[{"name":""}]', "[]"), (2, "q", "[]", "[]")],
                               "record_id long, query string, tools string, answers string")
    got = {r["record_id"]: r["text"] for r in rows(T.training_text(df))}
    assert "The available tools are: ." in got[1] and "The available tools are: None." in got[2]


def test_malformed_calls_are_quarantined(spark, tmp_path):
    df = spark.createDataFrame([(1, "q", '[{"name":"f"}]', CALL), (2, "q", '[{"name":"f"}]', '[{"nam":"f"}]')],
                               "record_id long, query string, tools string, answers string")
    checked = {r["record_id"]: r for r in rows(T.corpus_check(T.training_text(df)))}
    assert checked[2]["status"] == "ERROR" and not checked[2]["is_positive_case"]
    df.write.parquet(str(tmp_path / "in"))
    counts = P.build_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), fmt="xlam")
    assert counts == {"written": 1, "dropped": 1, "reasons": {"answer_call_malformed": 1}}
    assert P.read_corpus(spark, str(tmp_path / "out"), valid=False).first()["error"] == "answer_call_malformed"


def test_rates_keep_their_digits_and_must_be_there(spark):
    items = spark.createDataFrame([("A", "n", 4e6, 1000, 1)], "item_code string, name string, cost double, quantity int, item_order int")
    calls = spark.createDataFrame([
        (1, '[{"name":"inventory_check","arguments":{"item_codes":null,"conversion_rate":4e-7}}]'),
        (2, '[{"name":"inventory_check","arguments":{"item_codes":null}}]')], "call_id long, calls string")
    got = {r["call_id"]: (r["status"], r["value"]) for r in rows(C.inventory_value(C.explode_calls(calls), items))}
    assert got == {1: ("ok", 1600.0), 2: ("bad_arguments", None)}


def test_transcripts_of_all_records(spark):
    items = spark.createDataFrame([("A", "n", 1.0, 1, 1)], "item_code string, name string, cost double, quantity int, item_order int")
    calls = spark.createDataFrame([(1, "[]"), (2, "not json"), (3, '[{"name":"a\\"b","arguments":{}}]')], "call_id long, calls string")
    questions = calls.selectExpr("call_id", "'why?' AS question")
    got = {r["call_id"]: r["transcript"] for r in rows(C.transcripts(C.executed_calls(calls, items), questions))}
    assert set(got) == {1, 2, 3} and got[1] == got[2] and got[1].endswith("<|im_start|>assistant\nAnswer:\n")
    assert '"type":"function","function":{"name":"a\\"b","arguments":{}}}' in got[3]


def test_evaluate_by_group_and_first_rows(spark, tmp_path):
    truth = [(i, f"q{i}", '[{"name":"f"}]', CALL) for i in range(6)]
    spark.createDataFrame(truth, "record_id long, query string, tools string, answers string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(i, f"<tool_call>{CALL}</tool_call>", 1.0, 1) for i in range(6)],
                          "record_id long, raw_response string, latency_ms double, generated_tokens long").write.parquet(str(tmp_path / "o"))
    assert P.evaluate(spark, str(tmp_path / "t"), str(tmp_path / "o"), str(tmp_path / "r"), by=["query"]) == {"groups": 6}
    first = P.evaluate(spark, str(tmp_path / "t"), str(tmp_path / "o"), str(tmp_path / "f"), num_samples=2, test_split=True)
    assert first["total_samples"] == 2
    assert sorted(r["sample_id"] for r in spark.read.json(str(tmp_path / "f/trace")).collect()) == [0, 1]


def test_a_registered_format_is_used(spark):
    from callframe.operators import normalize as N
    N.register_format("pairs", lambda rows, id_col, **kw: N.normalize_flat(
        rows.selectExpr(f"{id_col} AS record_id", "q AS query", "'[]' AS tools", "'[]' AS answers")))
    try:
        raw = spark.createDataFrame([(1, "hi")], "record_id long, q string")
        got = rows(P.normalized_rows(raw, "org/my-pairs-1"))
        assert got[0]["query"] == "hi" and got[0]["error"] is None
    finally:
        N.FORMATS.pop("pairs")


def test_no_tool_schema_crosses_the_join(spark):
    truth = spark.createDataFrame([(1, "q", '[{"name":"f","parameters":{}},{"function":{"name":"g"}}]', CALL)],
                                  "record_id long, query string, tools string, answers string")
    prepared = S.prepare_truth(truth)
    assert not {"tools", "tools_v"} & set(prepared.columns)
    assert rows(prepared.select("available_str", "flat_names")) == [
        {"available_str": ["f", "g"], "flat_names": '["f",null]'}]
