"""Batch = stream: the streaming jobs give the batch results."""

from tests.conftest import SF0001, rows


def _key(rs, k):
    return sorted(rs, key=lambda r: r[k])


def test_stream_divergence_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    assert _key(rows(q["stream_divergence"](spark, SF0001)), "run_id") == _key(rows(q["divergence"](spark, SF0001)), "run_id")


def test_stream_score_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    cols = ["sample_id", "outcome", "error_category", "parsed_answers"]
    s = _key(rows(q["stream_score"](spark, SF0001).select(*cols)), "sample_id")
    b = _key(rows(q["score_trace"](spark, SF0001).select(*cols)), "sample_id")
    assert s == b


def _at(minute):
    import datetime
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


def test_windows_close_under_the_watermark_and_late_rows_are_counted(spark, tmp_path):
    """Three runs on one checkpoint; the last one brings rows of a closed window."""
    from callframe.streaming import jobs as W
    schema = "event_time timestamp, outcome string"
    base = str(tmp_path)
    windows = W.outcome_windows(W.read_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema))
    arrivals = [[(_at(5), "a"), (_at(20), "a"), (_at(70), "b")], [(_at(65), "a"), (_at(300), "a")], [(_at(30), "a"), (_at(31), "c"), (_at(250), "b")]]
    seen = []
    for some in arrivals:
        spark.createDataFrame(some, schema).write.mode("append").parquet(f"{base}/in")
        W.run_append(windows, f"{base}/out", f"{base}/ckpt")
        seen.append(sorted((r.window_start.hour, r.outcome, r.n) for r in spark.read.schema(windows.schema).parquet(f"{base}/out").collect()))
    # the watermark stands at 10 minutes, then at 240: the hours 0 and 1 close, each once; 250 is in time, its hour open
    assert seen == [[], [(0, "a", 2), (1, "a", 1), (1, "b", 1)], [(0, "a", 2), (1, "a", 1), (1, "b", 1)]]
    late = W.late_counts(spark.read.schema(schema).parquet(f"{base}/in"), spark.read.schema(windows.schema).parquet(f"{base}/out"))
    assert sorted((r.window_start.hour, r.outcome, r.n_late) for r in late.collect()) == [(0, "a", 1), (0, "c", 1)]


def test_one_alert_per_run_and_span(spark, tmp_path):
    from callframe.streaming import jobs as W
    schema = "run_id long, step long, loss double, ts timestamp"
    base, nan = str(tmp_path), float("nan")
    alerts = W.divergence_alerts(W.read_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema), span="1 hour")

    def arrive(some):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        W.run_append(alerts, f"{base}/out", f"{base}/ckpt")
        return sorted((r.run_id, r.step) for r in spark.read.schema(alerts.schema).parquet(f"{base}/out").collect())

    first = [(1, 1, 0.5, _at(0)), (1, 2, nan, _at(1)), (2, 1, float("-inf"), _at(2)), (3, 1, 1.0, _at(3))]
    assert arrive(first) == [(1, 2), (2, 1)]
    assert arrive(first + [(1, 9, nan, _at(30))]) == [(1, 2), (2, 1)]  # sent again: nothing
    # the span is over (state ended): a run that still diverges is told once more
    assert arrive([(4, 1, nan, _at(400))]) == [(1, 2), (2, 1), (4, 1)]
    assert arrive([(1, 50, nan, _at(401)), (1, 51, nan, _at(402))]) in ([(1, 2), (1, n), (2, 1), (4, 1)] for n in (50, 51))


def test_outputs_without_a_record_are_listed(spark, tmp_path):
    from callframe.operators import score as S
    from callframe.streaming import jobs as W
    outputs = spark.createDataFrame([(1, "no", 1.0, 1), (7, "no", 1.0, 1)], "record_id long, raw_response string, latency_ms double, generated_tokens long")
    truth = spark.createDataFrame([(1, "q", "[]", "[]"), (2, "q", "[]", "[]")], "record_id long, query string, tools string, answers string")
    outputs.write.parquet(f"{tmp_path}/in")
    W.run_append(W.score_stream(W.read_stream(spark, f"{tmp_path}/in", outputs.schema), truth), f"{tmp_path}/out", f"{tmp_path}/ckpt")
    got = {r.sample_id: r.outcome for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: S.TN, 7: S.NO_TRUTH}
