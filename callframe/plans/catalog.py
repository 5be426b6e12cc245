"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query derives its inputs from the driver's tables (fixtures) and runs
one job of the package over all rows. Result columns are plain scalars or
text so the DuckDB oracle (``callframe.plans.oracle``) can match them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callframe.functions import json_ops as J
from callframe.operators import corpus as T
from callframe.operators import metrics as M
from callframe.operators import normalize as N
from callframe.operators import outputs as O
from callframe.operators import quality as V
from callframe.operators import score as S
from callframe.operators import toolexec as C
from callframe.plans import jobs as P
from callframe.session import configure, drop_scratch, scratch_path
from callframe.sources.fixtures import fixture
from callframe.sources.tables import BROKEN, read_json_lines, read_table
from callframe.streaming import jobs as W

Query = Callable[[SparkSession, str], DataFrame]


def _truth_and_outputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    records = fixture(configure(spark), sf_dir, "records")
    truth = records.select("record_id", "query", "tools", "answers")
    outputs = records.select("record_id", "raw_response", "latency_ms", "generated_tokens")
    return truth, outputs


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, outputs = _truth_and_outputs(spark, sf_dir)
    return S.score(truth, outputs)


# -- O: output parsing -------------------------------------------------------

def q_parse_outputs(spark, sf_dir):
    _, outputs = _truth_and_outputs(spark, sf_dir)
    p = O.parse_outputs(outputs)
    first = F.try_element_at("predicted_calls", F.lit(1))
    return p.select(
        "record_id", "has_thought", "has_tool_call", "is_valid_json", "is_abort",
        F.size("predicted_calls").alias("n_calls"),
        J.as_string(J.get(first, "name")).alias("first_call_name"),
    )


def q_conformance_rate(spark, sf_dir):
    return O.conformance_rate(fixture(configure(spark), sf_dir, "array_outputs"), ["tool"])


# -- E/A: scoring and metrics -----------------------------------------------

def q_score_trace(spark, sf_dir):
    return S.trace(scored(spark, sf_dir))


def q_confusion(spark, sf_dir):
    return M.confusion(scored(spark, sf_dir))


def q_error_distribution(spark, sf_dir):
    return M.error_distribution(scored(spark, sf_dir))


def q_perf(spark, sf_dir):
    return M.perf(scored(spark, sf_dir))


def q_confusion_table(spark, sf_dir):
    return M.confusion_table(scored(spark, sf_dir))


def q_failure_table(spark, sf_dir):
    return M.failure_table(scored(spark, sf_dir))


def q_score_by_tool(spark, sf_dir):
    s = scored(spark, sf_dir)
    tool = F.when(F.col("truth_truthy"), F.col("g_name")).otherwise(F.lit("(none)"))
    return M.by_dimension(s, tool, "tool")


QUERIES: dict[str, Query] = {
    "parse_outputs": q_parse_outputs,
    "conformance_rate": q_conformance_rate,
    "score_trace": q_score_trace,
    "confusion": q_confusion,
    "error_distribution": q_error_distribution,
    "perf": q_perf,
    "confusion_table": q_confusion_table,
    "failure_table": q_failure_table,
    "score_by_tool": q_score_by_tool,
}


# -- N: record normalisation ----------------------------------------------


def q_normalize_conversations(spark, sf_dir):
    turns = fixture(configure(spark), sf_dir, "turns")
    records, _ = N.split(N.normalize_turns(turns))
    return records


def q_normalize_nested(spark, sf_dir):
    """Conversations as strings, nested tools flattened."""
    n = N.normalize_conversations(fixture(configure(spark), sf_dir, "nested_rows"))
    valid = F.col("error").isNull()
    return n.select("record_id", "error", *[F.when(valid, F.col(c)).alias(c) for c in ("query", "tools", "answers")])


def _flat(spark, sf_dir):
    rows = fixture(configure(spark), sf_dir, "flat_rows")
    return N.split(N.normalize_flat(rows, id_col="row_id"))


def q_normalize_flat(spark, sf_dir):
    return _flat(spark, sf_dir)[0]


def q_quarantine_records(spark, sf_dir):
    return _flat(spark, sf_dir)[1].select("record_id", "error")


QUERIES.update({
    "normalize_conversations": q_normalize_conversations,
    "normalize_nested": q_normalize_nested,
    "normalize_flat": q_normalize_flat,
    "quarantine_records": q_quarantine_records,
})


# -- T / V4: training corpus --------------------------------------------------


def _unified_records(spark, sf_dir):
    """The `records` fixture read as flat rows and normalised."""
    truth, _ = _truth_and_outputs(spark, sf_dir)
    records, _ = N.split(N.normalize_flat(truth))
    return records


def _corpus(spark, sf_dir):
    return T.training_text(_unified_records(spark, sf_dir))


def q_sft_corpus(spark, sf_dir):
    return _corpus(spark, sf_dir).select("record_id", "text")


def q_sft_corpus_indent2(spark, sf_dir):
    """T1 in the layout of Python's printer (no SQL can print it)."""
    return T.training_text(_unified_records(spark, sf_dir), style="indent2").select("record_id", "text")


def q_corpus_profile(spark, sf_dir):
    checked = T.corpus_check(_corpus(spark, sf_dir))
    return checked.select("record_id", "is_positive_case", "has_thought_tags", "has_tool_call_tags",
                          "has_abort", "has_unknown_token", "prompt_length_chars", "status")


def q_corpus_summary(spark, sf_dir):
    return T.corpus_summary(T.corpus_check(_corpus(spark, sf_dir)))


def q_rejected_counts(spark, sf_dir):
    """How many rows each reason keeps out of the records."""
    return _flat(spark, sf_dir)[1].groupBy("error").agg(F.count(F.lit(1)).alias("n"))


QUERIES.update({
    "rejected_counts": q_rejected_counts,
    "sft_corpus": q_sft_corpus,
    "sft_corpus_indent2": q_sft_corpus_indent2,
    "corpus_profile": q_corpus_profile,
    "corpus_summary": q_corpus_summary,
})


# -- V / P / D: checks, selection, derived jobs -----------------------------


DATASET_LIMIT = 2000       # first rows used for training (a profile's setting)
EVAL_SAMPLES = 100         # evaluation rows taken from the end of the split


def q_dataset_profile(spark, sf_dir):
    return V.dataset_profile(fixture(configure(spark), sf_dir, "records"))


def q_dataset_examples(spark, sf_dir):
    return V.head_examples(fixture(configure(spark), sf_dir, "records"), 3)


def _flat_checked(spark, sf_dir):
    rows = fixture(configure(spark), sf_dir, "flat_rows")
    return V.adapter_check(N.normalize_flat(rows, id_col="row_id"))


def q_adapter_check(spark, sf_dir):
    return _flat_checked(spark, sf_dir)


def q_adapter_summary(spark, sf_dir):
    return V.adapter_summary(_flat_checked(spark, sf_dir))


def q_divergence(spark, sf_dir):
    return V.divergence(fixture(configure(spark), sf_dir, "loss_log"))


def q_item_rules(spark, sf_dir):
    return V.item_rules(fixture(configure(spark), sf_dir, "items"))


def q_train_limit(spark, sf_dir):
    truth, _ = _truth_and_outputs(spark, sf_dir)
    records, _ = N.split(N.normalize_flat(V.first_rows(truth, DATASET_LIMIT)))
    return records.select("record_id", "query")


def q_eval_tail(spark, sf_dir):
    truth, _ = _truth_and_outputs(spark, sf_dir)
    records, _ = N.split(N.normalize_flat(V.last_rows(truth, EVAL_SAMPLES)))
    return records.select("record_id", "query")


def q_overlap(spark, sf_dir):
    """Rows of one whole table whose query also occurs in another."""
    train, _ = _truth_and_outputs(spark, sf_dir)
    evaluation = fixture(spark, sf_dir, "flat_rows").select(F.col("row_id").alias("record_id"), "query")
    return V.overlap(train.select("query"), evaluation)


def q_tool_catalogue(spark, sf_dir):
    rows = fixture(configure(spark), sf_dir, "flat_rows")
    records, _ = N.split(N.normalize_flat(rows, id_col="row_id"))
    return V.tool_catalogue(records)


# -- C / A6: tool execution ---------------------------------------------------

def _calls_items(spark, sf_dir):
    spark = configure(spark)
    return fixture(spark, sf_dir, "inventory_calls"), fixture(spark, sf_dir, "items")


def q_inventory_value(spark, sf_dir):
    calls, items = _calls_items(spark, sf_dir)
    return C.inventory_value(C.explode_calls(calls), items)


def q_item_by_name(spark, sf_dir):
    calls, items = _calls_items(spark, sf_dir)
    return C.item_by_name(C.explode_calls(calls), items)


def q_chained_calls(spark, sf_dir):
    calls, items = _calls_items(spark, sf_dir)
    return C.chained_calls(calls, items)


def q_inventory_total(spark, sf_dir):
    _, items = _calls_items(spark, sf_dir)
    return C.inventory_total(items, 1.0)


def q_vector_sum(spark, sf_dir):
    pairs = C.vector_sum(fixture(configure(spark), sf_dir, "vector_pairs"))
    return pairs.select("vec_id", "error", F.posexplode_outer("vsum").alias("pos", "value")).select(
        "vec_id", "pos", F.round("value", 6).alias("value"), "error")


def q_dot_product(spark, sf_dir):
    pairs = C.dot_product(fixture(configure(spark), sf_dir, "vector_pairs"))
    return pairs.select("vec_id", F.round("dot", 6).alias("dot"), "error")


QUERIES.update({
    "dataset_profile": q_dataset_profile,
    "dataset_examples": q_dataset_examples,
    "adapter_check": q_adapter_check,
    "adapter_summary": q_adapter_summary,
    "divergence": q_divergence,
    "item_rules": q_item_rules,
    "train_limit": q_train_limit,
    "eval_tail": q_eval_tail,
    "overlap": q_overlap,
    "tool_catalogue": q_tool_catalogue,
    "inventory_value": q_inventory_value,
    "item_by_name": q_item_by_name,
    "chained_calls": q_chained_calls,
    "inventory_total": q_inventory_total,
    "vector_sum": q_vector_sum,
    "dot_product": q_dot_product,
})


# Fixed value: the question of the notebook's second round trip.
TRANSCRIPT_QUESTION = "How much is the total inventory cost of the items in this request?"


def q_transcripts(spark, sf_dir):
    calls, items = _calls_items(spark, sf_dir)
    executed = C.executed_calls(calls, items)
    questions = calls.select("call_id", F.lit(TRANSCRIPT_QUESTION).alias("question"))
    return C.transcripts(executed, questions)


# -- W: streaming -------------------------------------------------------------


def _table_name(base: str) -> str:
    """A session table name for a scratch folder."""
    return "cf_" + base.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")


def q_stream_score(spark, sf_dir):
    """W1 driven to completion (AvailableNow); returns the trace sink."""
    spark = configure(spark)
    truth, outputs = _truth_and_outputs(spark, sf_dir)
    base = scratch_path(spark, "stream-score")
    outputs.write.mode("overwrite").parquet(f"{base}/outputs")
    static = W.write_prepared_truth(truth, f"{base}/truth", table=_table_name(base))
    stream = W.read_stream(spark, f"{base}/outputs", outputs.schema)
    scored = W.score_stream(stream, static, prepared=True)
    W.run_append(scored, f"{base}/trace", f"{base}/_checkpoint")
    spark.sql(f"DROP TABLE {_table_name(base)}")
    drop_scratch(spark, f"{base}/outputs", f"{base}/truth", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/trace")


def q_stream_divergence(spark, sf_dir):
    """W2 driven to completion (AvailableNow); returns the result table."""
    spark = configure(spark)
    logs = fixture(spark, sf_dir, "loss_log").withColumn("ts", F.col("ts").cast("timestamp"))
    base = scratch_path(spark, "stream-divergence")
    logs.write.mode("overwrite").parquet(f"{base}/logs")
    stream = W.read_stream(spark, f"{base}/logs", logs.schema)
    W.run_complete(W.divergence_stream(stream), f"{base}/result", f"{base}/_checkpoint")
    drop_scratch(spark, f"{base}/logs", f"{base}/_checkpoint")
    return W.read_complete(spark, f"{base}/result")


def q_stream_alerts(spark, sf_dir):
    """W2 alerts: the log arrives twice, over two runs of the query (the second
    is a restart); every diverged run still gives one alert in the span."""
    spark = configure(spark)
    logs = fixture(spark, sf_dir, "loss_log").withColumn("ts", F.col("ts").cast("timestamp"))
    base = scratch_path(spark, "stream-alerts")
    alerts = W.divergence_alerts(W.read_stream(spark, f"{base}/logs", logs.schema), span="60 days")
    for _ in range(2):
        logs.write.mode("append").parquet(f"{base}/logs")
        W.run_append(alerts, f"{base}/alerts", f"{base}/_checkpoint")
    drop_scratch(spark, f"{base}/logs", f"{base}/_checkpoint")
    return spark.read.schema(alerts.schema).parquet(f"{base}/alerts").groupBy("run_id").agg(F.count("step").alias("alerts"))


QUERIES.update({
    "transcripts": q_transcripts,
    "stream_score": q_stream_score,
    "stream_divergence": q_stream_divergence,
    "stream_alerts": q_stream_alerts,
})


def _streamed_windows(spark, sf_dir, base):
    """W1 over three arrivals of outputs, each a run of its own (so two
    restarts from the checkpoint); the last one brings rows that are weeks
    late. Returns (trace, windows)."""
    outputs = fixture(spark, sf_dir, "arrivals").withColumn("event_time", F.col("event_time").cast("timestamp"))
    schema = outputs.drop("arrival").schema
    truth, _ = _truth_and_outputs(spark, sf_dir)
    static = W.write_prepared_truth(truth, f"{base}/truth", table=_table_name(base))
    trace = W.score_stream(W.read_stream(spark, f"{base}/outputs", schema), static, prepared=True, keep=("event_time",))
    windows = W.outcome_windows(W.read_stream(spark, f"{base}/trace", trace.schema))
    for arrival in range(3):
        outputs.filter(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(f"{base}/outputs")
        W.run_append(trace, f"{base}/trace", f"{base}/_trace_checkpoint")
        W.run_append(windows, f"{base}/windows", f"{base}/_windows_checkpoint")
    spark.sql(f"DROP TABLE {_table_name(base)}")
    drop_scratch(spark, *[f"{base}/{x}" for x in ("outputs", "truth", "_trace_checkpoint", "_windows_checkpoint")])
    return (spark.read.schema(trace.schema).parquet(f"{base}/trace"),
            spark.read.schema(windows.schema).parquet(f"{base}/windows"))


def q_stream_outcome_windows(spark, sf_dir):
    """W1 windows: outcome counts per hour of the outputs' event time, under a
    watermark, from the scored stream's own trace."""
    spark = configure(spark)
    _, windows = _streamed_windows(spark, sf_dir, scratch_path(spark, "stream-windows"))
    return windows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "outcome", "n")


def q_stream_late_rows(spark, sf_dir):
    """The rows that came after their window was closed."""
    spark = configure(spark)
    late = W.late_counts(*_streamed_windows(spark, sf_dir, scratch_path(spark, "stream-late")))
    return late.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "outcome", "n_late")


QUERIES["stream_outcome_windows"] = q_stream_outcome_windows
QUERIES["stream_late_rows"] = q_stream_late_rows


def q_score_by_day(spark, sf_dir):
    """A5 by day: confusion counts per event date with a grand total
    (rollup). The date comes from the events behind each record."""
    s = scored(spark, sf_dir)
    days = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"), F.date_format("ts", "yyyy-MM-dd").alias("_day"))
    return M.by_dimension(s.join(days, "record_id"), F.col("_day"), "day")


QUERIES["score_by_day"] = q_score_by_day


def q_score_cube(spark, sf_dir):
    """A5 over tool and event date: every combination and subtotal."""
    s = scored(spark, sf_dir)
    days = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"), F.date_format("ts", "yyyy-MM-dd").alias("_day"))
    tool = F.when(F.col("truth_truthy"), F.col("g_name")).otherwise(F.lit("(none)"))
    return M.by_dimensions(s.join(days, "record_id"), {"tool": tool, "day": F.col("_day")})


QUERIES["score_cube"] = q_score_cube


# -- faults off the beaten track --------------------------------------------------

def _odd(spark, sf_dir):
    """(truth, outputs) of the odd records; some have no output, some outputs
    no record."""
    rows = fixture(configure(spark), sf_dir, "odd_records")
    truth = rows.select("record_id", "query", "tools", "answers")
    outputs = rows.filter("raw_response IS NOT NULL").select(
        F.when(F.col("record_id") % 59 == 4, -1 - F.col("record_id")).otherwise(F.col("record_id")).alias("record_id"),
        "raw_response", "latency_ms", "generated_tokens")
    return truth, outputs


def q_score_odd(spark, sf_dir):
    """E1-E6 on truth and outputs with every other fault."""
    return S.score(*_odd(spark, sf_dir)).select("record_id", "ground_truth_parsing_error", "outcome", "error_category")


def q_evaluation_report(spark, sf_dir):
    """The evaluate job on stored truth and outputs; its report. The
    truth also has the flat rows' broken ones, which are skipped."""
    spark = configure(spark)
    truth, outputs = _odd(spark, sf_dir)
    base = scratch_path(spark, "evaluate")
    broken = N.split(N.normalize_flat(fixture(spark, sf_dir, "flat_rows"), id_col="row_id"))[1]
    truth.unionByName(broken.select((-F.col("record_id") - 10 ** 9).alias("record_id"), "query", F.lit("no list").alias("tools"),
                                    "answers")).write.parquet(f"{base}/truth")
    outputs.write.parquet(f"{base}/outputs")
    P.evaluate(spark, f"{base}/truth", f"{base}/outputs", f"{base}/reports")
    report = spark.read.json(f"{base}/reports/metrics")
    return report.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("total_samples", "no_output", "skipped", "orphan_outputs")],
        *[F.col(f"confusion_matrix.{c}").cast("bigint").alias(c) for c in (
            "true_positives", "false_positives", "true_negatives", "false_negatives", "invalid")],
        F.round("performance.avg_latency_ms", 6).alias("avg_latency_ms"))


# -- S1, S3, P5, T1, T8: reading broken input, one routed write ----------------------

LINE_SCHEMA = "record_id bigint, query string, tools string, answers string, source string"


def _json_lines(spark, sf_dir):
    spark = configure(spark)
    path = scratch_path(spark, "json-lines")
    fixture(spark, sf_dir, "json_lines").select("line").write.text(path)
    return path


def q_json_lines(spark, sf_dir):
    """Every line with its fate: a record, or quarantined with a reason and
    its text."""
    rows = read_json_lines(spark, _json_lines(spark, sf_dir), LINE_SCHEMA)
    out = P.normalized_rows(rows, fmt="xlam")
    return out.select(F.when(F.col(BROKEN).isNull(), F.col("record_id")).alias("record_id"), "error", F.col(BROKEN).alias("line"))


def q_routed_corpus(spark, sf_dir):
    """The corpus job on JSON lines; rows read back from both
    partitions, with the reason counts it returned."""
    spark = configure(spark)
    base = scratch_path(spark, "corpus")
    told = P.build_corpus(spark, _json_lines(spark, sf_dir), base, fmt="xlam", input_format="json", schema=LINE_SCHEMA)
    good, bad = P.read_corpus(spark, base), P.read_corpus(spark, base, valid=False)
    counted = spark.createDataFrame(list({**told["reasons"], "": told["written"]}.items()), "error string, counted bigint")
    rows = (good.select(F.lit("").alias("error"), "source", F.length("text").alias("chars"))
            .unionByName(bad.select("error", "source", F.lit(0).alias("chars"))))
    return (rows.groupBy("error").agg(F.count(F.lit(1)).alias("n"), F.count("source").alias("with_source"),
                                      F.sum("chars").cast("bigint").alias("chars"))
            .join(F.broadcast(counted), "error", "left"))  # one row per reason


def q_sft_messages(spark, sf_dir):
    """The messages behind each text, one row per message. (The outer form
    infers no filter on the list, which would be pushed below every step that
    derives it.)"""
    corpus = T.training_text(_unified_records(spark, sf_dir), messages=True)
    said = corpus.select("record_id", F.posexplode_outer("chat_messages").alias("pos", "m"))
    return said.select("record_id", "pos", "m.role", "m.content").filter("pos IS NOT NULL")


def q_normalize_chat(spark, sf_dir):
    """N1b on arrays of messages with the plain chat fields, folded in the row."""
    turns = fixture(configure(spark), sf_dir, "turns")
    nested = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "content"))).alias("messages"))
    nested = nested.withColumn("messages", F.transform("messages", lambda m: m.dropFields("turn")))
    records, _ = N.split(N.normalize_conversations(nested, id_col="conv_id", messages="messages", fallback=None))
    return records


# -- P1, P2 on other keys, V6 quarantine, D2 conflicts ---------------------------------

def q_train_limit_by_time(spark, sf_dir):
    """P1 by a timestamp: the earliest log rows."""
    return V.first_rows(fixture(configure(spark), sf_dir, "loss_log"), DATASET_LIMIT, "ts").select("run_id", "step")


def q_eval_tail_by_name(spark, sf_dir):
    """P2 by a string."""
    truth, _ = _truth_and_outputs(spark, sf_dir)
    named = truth.select("record_id", F.concat("query", F.lit(" "), F.col("record_id").cast("string")).alias("name"))
    return V.last_rows(named, EVAL_SAMPLES, "name")


def q_item_quarantine(spark, sf_dir):
    return V.item_quarantine(fixture(configure(spark), sf_dir, "items"))


def q_tool_conflicts(spark, sf_dir):
    rows = fixture(configure(spark), sf_dir, "flat_rows")
    records, _ = N.split(N.normalize_flat(rows, id_col="row_id"))
    return V.tool_conflicts(records)


QUERIES.update({
    "score_odd": q_score_odd,
    "evaluation_report": q_evaluation_report,
    "json_lines": q_json_lines,
    "routed_corpus": q_routed_corpus,
    "sft_messages": q_sft_messages,
    "normalize_chat": q_normalize_chat,
    "train_limit_by_time": q_train_limit_by_time,
    "eval_tail_by_name": q_eval_tail_by_name,
    "item_quarantine": q_item_quarantine,
    "tool_conflicts": q_tool_conflicts,
})
