"""End-to-end jobs with sinks, on derived fixture tables."""

import json
import os
import tempfile

import pytest

from callframe.plans import jobs as P
from callframe.plans.errors import DivergenceError, SchemaValidationError
from callframe.sources.fixtures import fixture
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def tmp():
    return tempfile.mkdtemp(prefix="callframe-jobs-")


def test_build_corpus_and_evaluate(spark, tmp):
    records = fixture(spark, SF0001, "records")
    records.select("record_id", "query", "tools", "answers").write.parquet(f"{tmp}/train")
    records.select("record_id", "raw_response", "latency_ms", "generated_tokens").write.parquet(f"{tmp}/outputs")
    counts = P.build_corpus(spark, f"{tmp}/train", f"{tmp}/corpus", dataset_name="x/xlam-60k")
    assert counts == {"written": 1000, "dropped": 0, "reasons": {}}
    corpus = P.read_corpus(spark, f"{tmp}/corpus")
    assert {"record_id", "query", "tools", "answers", "text"} <= set(corpus.columns)
    report = P.evaluate(spark, f"{tmp}/train", f"{tmp}/outputs", f"{tmp}/reports")
    assert report["confusion_matrix"]["true_positives"] == 334
    assert report["error_distribution"]["hallucinated_tool"] == 236
    assert (report["skipped"], report["orphan_outputs"], report["no_output"]) == (0, 0, 0)
    assert os.path.isdir(f"{tmp}/reports/trace") and os.path.isdir(f"{tmp}/reports/metrics")
    tail = P.evaluate(spark, f"{tmp}/train", f"{tmp}/outputs", f"{tmp}/reports_tail", num_samples=100)
    assert tail["total_samples"] == 100


def test_precheck_stops_on_the_first_row(spark, tmp):
    rows = fixture(spark, SF0001, "flat_rows").withColumnRenamed("row_id", "record_id")
    rows.write.parquet(f"{tmp}/flat")
    # row 0 has tools as an object: the first-row precheck stops the job
    with pytest.raises(SchemaValidationError):
        P.build_corpus(spark, f"{tmp}/flat", f"{tmp}/c2", fmt="xlam")


GOOD_TOOLS, CALL = '[{"name":"f"}]', '[{"name":"f","arguments":{}}]'


@pytest.mark.parametrize("mode", ["quarantine", "skip", "fail"])
def test_rows_are_routed_and_counted_in_every_mode(spark, tmp_path, mode):
    rows = [(1, "q", GOOD_TOOLS, CALL, "a"), (2, "q", "no json", "[]", "b"), (3, None, GOOD_TOOLS, "[]", "c"),
            (4, "q", GOOD_TOOLS, '[{"nam":"f"}]', "d"), (5, "q", GOOD_TOOLS, "[]", None)]
    spark.createDataFrame(rows, "record_id long, query string, tools string, answers string, origin string").write.parquet(f"{tmp_path}/in")
    if mode == "fail":
        with pytest.raises(SchemaValidationError, match="not a record: row [234]"):
            P.build_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out", fmt="xlam", on_error=mode)
        assert not [f for _, _, files in os.walk(f"{tmp_path}/out") for f in files if f.endswith(".parquet")]
        return
    told = P.build_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out", fmt="xlam", on_error=mode)
    assert told == {"written": 2, "dropped": 3,
                    "reasons": {"tools_not_json": 1, "query_not_string": 1, "answer_call_malformed": 1}}
    good = {r["record_id"]: r for r in P.read_corpus(spark, f"{tmp_path}/out").collect()}
    assert {i: r["origin"] for i, r in good.items()} == {1: "a", 5: None} and all(r["text"] for r in good.values())
    if mode == "quarantine":
        bad = P.read_corpus(spark, f"{tmp_path}/out", valid=False).collect()
        assert {(r["record_id"], r["error"], r["origin"]) for r in bad} == {
            (2, "tools_not_json", "b"), (3, "query_not_string", "c"), (4, "answer_call_malformed", "d")}


def test_the_corpus_job_normalises_each_row_once(spark, tmp_path):
    """One scan, one parse, one write: a format that counts its rows."""
    from callframe.operators import normalize as N
    seen = spark.sparkContext.accumulator(0)
    rows = [(i, "q", GOOD_TOOLS, "[]") for i in range(50)]
    spark.createDataFrame(rows, "record_id long, query string, tools string, answers string").write.parquet(f"{tmp_path}/in")

    def counted(raw, id_col, **_):
        def look(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return N.normalize_flat(raw.mapInArrow(look, raw.schema), id_col=id_col)

    N.register_format("counted", counted)
    try:
        told = P.build_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out", dataset_name="my/counted-set")
    finally:
        N.FORMATS.clear()
    assert told["written"] == 50 and seen.value == 50 + 1  # and the first row, for the precheck


def test_every_format_keeps_its_columns(spark, tmp_path):
    chat = [("user", "q"), ("assistant", f"<tool_call>{CALL}</tool_call>")]
    spark.createDataFrame([(1, chat, GOOD_TOOLS, "x")], "record_id long, conversations array<struct<role:string,content:string>>, tools string, origin string") \
        .write.parquet(f"{tmp_path}/nested")
    P.build_corpus(spark, f"{tmp_path}/nested", f"{tmp_path}/c1", fmt="sharegpt", messages=True)
    r = P.read_corpus(spark, f"{tmp_path}/c1").first()
    assert r["origin"] == "x" and r["conversations"][0]["content"] == "q" and "<tool_call>" in r["text"]
    assert [m["role"] for m in r["chat_messages"]] == ["system", "user", "assistant"]
    assert all(m["content"] in r["text"] for m in r["chat_messages"])
    turns = [(c, t, role, text, f"o{c}") for c in (7, 8, 9) for t, (role, text) in enumerate(chat)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, content string, origin string").write.parquet(f"{tmp_path}/turns")
    told = P.build_corpus(spark, f"{tmp_path}/turns", f"{tmp_path}/c2", fmt="turns", limit=2)
    assert told["written"] == 2
    assert {(r["record_id"], r["origin"]) for r in P.read_corpus(spark, f"{tmp_path}/c2").collect()} == {(7, "o7"), (8, "o8")}


def test_json_lines_with_broken_ones(spark, tmp_path):
    from callframe.sources.tables import BROKEN, read_json_lines
    lines = ['{"record_id":1,"query":"q","tools":"[]","answers":"[]"}', '{"record_id":2,"query":', "words",
             '{"record_id":"x","query":"q"}', '{"record_id":3,"query":"q","tools":"[]","more":1}', ""]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    schema = "record_id bigint, query string, tools string, answers string"
    got = {r[BROKEN] or r["record_id"] for r in read_json_lines(spark, str(tmp_path / "in"), schema).collect()}
    assert got == {1, 3, lines[1], lines[2], lines[3]}
    told = P.build_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), fmt="xlam", input_format="json", schema=schema)
    assert told == {"written": 2, "dropped": 3, "reasons": {"line_not_json": 3}}
    assert {r[BROKEN] for r in P.read_corpus(spark, str(tmp_path / "out"), valid=False).collect()} == set(lines[1:4])


def test_skipped_rows_and_orphans_are_reported(spark, tmp_path):
    truth = [(1, "q", GOOD_TOOLS, CALL), (2, "q", "no json", CALL), (3, "q", GOOD_TOOLS, "[]")]
    spark.createDataFrame(truth, "record_id long, query string, tools string, answers string").write.parquet(f"{tmp_path}/truth")
    outputs = [(1, f"<tool_call>{CALL}</tool_call>", 10.0, 5), (9, "no", 1.0, 1)]
    spark.createDataFrame(outputs, "record_id long, raw_response string, latency_ms double, generated_tokens long").write.parquet(f"{tmp_path}/outputs")
    r = P.evaluate(spark, f"{tmp_path}/truth", f"{tmp_path}/outputs", f"{tmp_path}/reports")
    assert (r["total_samples"], r["no_output"], r["skipped"], r["orphan_outputs"]) == (1, 1, 1, 1)
    assert r["performance"]["avg_latency_ms"] == 10.0


def test_smoke_check_gate(spark, tmp):
    records = fixture(spark, SF0001, "records")
    records.write.parquet(f"{tmp}/smoke_in")
    ok = P.smoke_check(spark, f"{tmp}/smoke_in", f"{tmp}/smoke_report", evaluation={"total_samples": 7})
    assert ok is True
    report = json.loads(spark.read.text(f"{tmp}/smoke_report").first()[0])
    told = report["data_pipeline_validation"]
    assert told["samples_checked"] == 1000 and [r["record_id"] for r in told["details"]] == [0, 1, 2, 3, 4]
    assert [r["record_id"] for r in told["formatted_prompt_samples"]] == [0, 1, 2]
    assert told["formatted_prompt_samples"][1]["prompt_preview"].startswith("<|im_start|>system")
    assert report["evaluation_summary"] == {"total_samples": 7} and report["formatted_prompts"]["errors"] == 0


def test_divergence_guard(spark):
    with pytest.raises(DivergenceError):
        P.check_divergence(fixture(spark, SF0001, "loss_log"))
