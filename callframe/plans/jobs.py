"""End-to-end jobs: the reference's phases as Spark jobs with sinks.

* ``build_corpus``  S1, P1, P4, P5, N*, N10, N9, T*, S3: read a split, take the
  first N rows, precheck the first row, normalise and build the text, and
  write rows and rejected rows in one routed pass: every input column is kept,
  and both kinds are counted by reason while they are written.
* ``evaluate``      S2, P2, P5, E*, S5, A*, S6: score outputs against truth,
  write the trace, then compute the report from the written trace (the
  trace is the lineage cut: metrics never recompute the scoring). Records that
  are skipped and outputs without a record are counted.
* ``smoke_check``   V1-V5, S7: profile, adapter check, text check and gate
  over the whole split, with the first rows' details; the report is JSON.
* ``check_divergence`` V7: raise on a diverged run (the trainer's guard).

Actions happen only here. Paths are on shared storage (the caller's).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callframe.operators import corpus as T
from callframe.operators import metrics as M
from callframe.operators import normalize as N
from callframe.operators import quality as V
from callframe.operators import score as S
from callframe.plans.errors import DivergenceError, PipelineError, SchemaValidationError
from callframe.session import configure
from callframe.sources.tables import BROKEN, read_json_lines, read_records, write_table


#: partition column of a routed corpus: rows with a text, rows without
VALID = "valid"


def _read(spark: SparkSession, path: str, fmt: str, schema: str | None = None) -> DataFrame:
    try:
        return read_json_lines(spark, path, schema) if fmt == "json" and schema else read_records(spark, path, fmt, schema)
    except Exception as e:  # noqa: BLE001 - surfaced as the reference's error kind
        raise PipelineError(f"cannot read {path}: {e}") from e


def normalized_rows(raw: DataFrame, dataset_name: str = "", fmt: str | None = None, order_col: str = "record_id",
                    **normalize_kw) -> DataFrame:
    """The input's rows as records, by format or dataset name. All other
    columns of the input travel with the record (for rows of turns, see
    ``normalize_turns``). Lines that were no rows get the reason
    ``line_not_json``."""
    fmt = fmt or N.format_for(dataset_name)
    if fmt in N.FORMATS:
        out = N.FORMATS[fmt](raw, id_col=order_col, **normalize_kw)
    elif fmt == "xlam":
        out = N.normalize_flat(raw, id_col=order_col, keep=raw.columns, **normalize_kw)
    elif fmt == "sharegpt":
        out = N.normalize_conversations(raw, id_col=order_col, keep=raw.columns, **normalize_kw)
    else:
        out = N.normalize_turns(raw, carry=raw.columns, **normalize_kw)
    if BROKEN in out.columns:
        out = out.withColumn("error", F.when(F.col(BROKEN).isNotNull(), F.lit("line_not_json")).otherwise(F.col("error")))
    return out


def precheck_first_row(raw: DataFrame, normalize, order_col: str = "record_id", whole_key: bool = False) -> None:
    """The first row (with ``whole_key``, all rows with the first key) must
    form a record before the job runs. Only that row is normalised. Lines
    that are no rows have no key and are left to the quarantine."""
    rows = raw.filter(F.col(BROKEN).isNull()) if BROKEN in raw.columns else raw
    rows = (rows.filter(F.col(order_col) == rows.agg(F.min(order_col)).scalar()) if whole_key
            else rows.orderBy(order_col).limit(1))
    first = normalize(rows).select("error").collect()
    if first and first[0]["error"] is not None:
        raise SchemaValidationError(f"first row is not a record: {first[0]['error']}")


def corpus_rows(normalized: DataFrame, template: T.ChatTemplate = T.CHATML, style: str = "compact",
                messages: bool = False) -> DataFrame:
    """T1 over all normalised rows: ``error`` is the reason why a row has no
    text (no record, or no text can be built), ``valid`` whether it has one."""
    out = T.training_text(normalized, template, style, messages)
    error = F.coalesce("error", "corpus_error")
    return out.withColumns({"text": F.when(error.isNull(), F.col("text")), "error": error}).withColumn(
        VALID, F.col("error").isNull()).drop("corpus_error")


def read_corpus(spark: SparkSession, path: str, valid: bool = True) -> DataFrame:
    """The rows of a routed corpus that have a text, or the rejected ones
    with their reason. Only that partition is read."""
    try:
        return spark.read.parquet(path).filter(F.col(VALID) == valid).drop(VALID, *(["error"] if valid else []))
    except Exception as e:  # noqa: BLE001
        raise PipelineError(f"cannot read {path}: {e}") from e


#: reasons why a row is rejected, as counted by ``build_corpus``
REASONS = ("line_not_json", "tools_missing", "tools_not_json", "query_not_string", "tools_not_list", "tool_not_object",
           "messages_not_json", "role_missing", "tool_name_not_string", "answer_call_malformed", "text_not_built")


def build_corpus(spark: SparkSession, input_path: str, output_path: str, dataset_name: str = "", fmt: str | None = None,
                 input_format: str = "parquet", schema: str | None = None, limit: int | None = None,
                 order_col: str = "record_id", on_error: str = "quarantine", template: T.ChatTemplate = T.CHATML,
                 style: str = "compact", messages: bool = False, **normalize_kw) -> dict:
    """Process phase, in one pass: rows are written to ``output_path``
    partitioned by ``valid`` (see ``read_corpus``), with all input columns.

    Returns ``written``, ``dropped`` and ``reasons`` (rejected rows by reason),
    counted while the rows are written, in every mode. ``on_error``:
    ``quarantine`` writes rejected rows beside the corpus, ``skip`` only counts
    them, ``fail`` raises at the first one and leaves nothing behind."""
    spark = configure(spark)
    raw = _read(spark, input_path, input_format, schema)
    turns = (fmt or N.format_for(dataset_name)) == "turns"

    def normalize(rows: DataFrame) -> DataFrame:
        return normalized_rows(rows, dataset_name, fmt, order_col, **normalize_kw)

    # a limit counts records: rows of the input, or conversations of turns
    if turns:
        precheck_first_row(raw, normalize, normalize_kw.get("id_col", "conv_id"), whole_key=True)
        normalized = V.first_rows(normalize(raw), limit, "record_id")
    else:
        raw = V.first_rows(raw, limit, order_col)
        precheck_first_row(raw, normalize, order_col)
        normalized = normalize(raw)
    rows = N.keep_filters_above(corpus_rows(normalized, template, style, messages))
    seen = Observation()
    known = F.col("error").isin(*REASONS)
    rows = rows.observe(seen, F.count_if(VALID).alias("written"), F.count_if(F.col("error").isNotNull()).alias("dropped"),
                        *[F.count_if(F.col("error") == r).alias(r) for r in REASONS],
                        F.count_if(F.col("error").isNotNull() & ~known).alias("other"))
    if on_error == "fail":
        rows = rows.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(
            F.concat(F.lit(f"{_REJECTED} "), F.coalesce(F.col("record_id").cast("string"), F.lit("null")), F.lit(": "), "error"))))
    elif on_error == "skip":
        rows = rows.filter(F.col("error").isNull() & (F.col("_pid") >= 0))
    try:
        write_table(rows.drop("_pid"), output_path, partition_by=[VALID])
    except Exception as e:
        if _REJECTED in str(e):
            raise SchemaValidationError(str(e)[str(e).index(_REJECTED):].splitlines()[0]) from e
        raise
    counts = seen.get
    return {"written": counts["written"], "dropped": counts["dropped"],
            "reasons": {r: counts[r] for r in (*REASONS, "other") if counts[r]}}


_REJECTED = "not a record: row"


def evaluate(spark: SparkSession, truth_path: str, outputs_path: str, reports_dir: str,
             num_samples: int | None = None, order_col: str = "record_id", fmt: str = "parquet",
             by: list[str] | None = None, dataset_name: str = "xlam", record_format: str | None = None,
             test_split: bool = False) -> dict:
    """Evaluate phase: trace (JSON lines) and the metrics report (JSON).
    ``num_samples`` takes the first rows of a test split, else the last rows
    of the training split. With ``by`` the report has one row per group and
    the number of groups is returned. The report tells how many rows were no
    records and were ``skipped`` (P5), and how many outputs no record asked
    for (``orphan_outputs``, only without ``num_samples``)."""
    spark = configure(spark)
    truth = _read(spark, truth_path, fmt)
    if num_samples:
        truth = V.first_rows(truth, num_samples, order_col) if test_split else V.last_rows(truth, num_samples, order_col)
    seen = Observation()
    rows = normalized_rows(truth, dataset_name, record_format, order_col).observe(
        seen, F.count_if(F.col("error").isNotNull()).alias("skipped"))
    records, _ = N.split(rows)
    records = records.select("record_id", "query", "tools", "answers")
    outputs = _read(spark, outputs_path, fmt).withColumnRenamed(order_col, "record_id")
    scored = S.score(records, outputs)
    trace_path = f"{reports_dir.rstrip('/')}/trace"
    write_table(S.trace(scored), trace_path, fmt="json")             # S5
    trace = spark.read.schema(_TRACE_SCHEMA).json(trace_path)
    metrics_path = f"{reports_dir.rstrip('/')}/metrics"
    orphans = None if num_samples else S.orphan_outputs(trace.select(F.col("sample_id").alias("record_id")),
                                                        outputs.select("record_id")).count()
    report = report_frame(trace, by).withColumns({
        "skipped": F.lit(seen.get["skipped"]).cast("bigint"), "orphan_outputs": F.lit(orphans).cast("bigint")})
    if by:
        write_table(report, metrics_path, fmt="json")
        return {"groups": spark.read.json(metrics_path).count()}
    row = report.first()                                              # one row
    write_table(spark.createDataFrame([row], report.schema), metrics_path, fmt="json")  # S6
    return row.asDict(recursive=True)


_TRACE_SCHEMA = ("sample_id bigint, query string, available_tools string, answers_str_raw string, "
                 "ground_truth_parsing_error boolean, parsed_answers string, raw_response string, "
                 "has_thought boolean, has_tool_call boolean, is_valid_json boolean, is_abort boolean, "
                 "parsed_json string, outcome string, error_category string, latency_ms double, "
                 "generated_tokens bigint")


def report_frame(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The report's shape: total, confusion matrix, error distribution,
    performance, as one row of structs (one row per group with ``by``). The
    total and the mean count rows with an output; ``no_output`` the others."""
    o, c = F.col("outcome"), F.col("error_category")
    aggs = [
        F.count_if(M.answered()).alias("total_samples"),
        F.count_if(o == S.NO_OUTPUT).alias("no_output"),
        F.struct(*[F.count_if(o == v).alias(k) for k, v in (
            ("true_positives", S.TP), ("false_positives", S.FP),
            ("true_negatives", S.TN), ("false_negatives", S.FN), ("invalid", S.INVALID))]).alias("confusion_matrix"),
        F.struct(*[F.count_if(c == f"error_{k}").alias(k) for k in S.CATEGORIES]).alias("error_distribution"),
        F.sum("latency_ms").alias("_ms"), F.sum("generated_tokens").alias("_tok"),
    ]
    agg = scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)
    ms = F.coalesce(F.col("_ms"), F.lit(0.0))
    return agg.withColumn("performance", F.struct(
        (ms / F.greatest(F.lit(1), F.col("total_samples"))).alias("avg_latency_ms"),
        F.when(ms > 0, F.col("_tok") / (ms / 1000)).otherwise(F.lit(0.0)).alias("tokens_per_second"),
    )).drop("_ms", "_tok")


def smoke_check(spark: SparkSession, input_path: str, report_path: str, input_format: str = "parquet",
                order_col: str = "record_id", examples: int = 3, details: int = 5, dataset_name: str = "xlam",
                fmt: str | None = None, training: dict | None = None, evaluation: dict | None = None,
                **normalize_kw) -> bool:
    """Smoke phase over the whole split; returns the gate (V5). The report has
    the summaries over all rows, the first ``details`` rows of the adapter check
    and the first ``examples`` texts, and the ``training`` and ``evaluation``
    results that earlier phases handed over."""
    spark = configure(spark)
    raw = _read(spark, input_path, input_format)
    normalized = normalized_rows(raw, dataset_name, fmt, order_col, **normalize_kw)
    summary = V.adapter_summary(V.adapter_check(normalized)).first().asDict()
    checked = T.corpus_check(T.training_text(N.split(normalized)[0]))
    corpus_summary = T.corpus_summary(checked).first().asDict()
    profile = [r.asDict() for r in V.dataset_profile(raw).collect()]          # one row per column
    head = [r.asDict() for r in V.head_examples(raw, examples, order_col).collect()]  # k rows
    few = normalized_rows(raw.orderBy(order_col).limit(max(details, examples)), dataset_name, fmt, order_col, **normalize_kw)
    entries = [r.asDict() for r in V.adapter_check(few).orderBy("record_id").limit(details).collect()]
    samples = [r.asDict() for r in T.corpus_check(T.training_text(few.filter("error IS NULL"))).select(
        "record_id", "status", "is_positive_case", "has_thought_tags", "has_tool_call_tags", "has_abort",
        "has_unknown_token", "prompt_length_chars", "prompt_preview").orderBy("record_id").limit(examples).collect()]
    report = {"dataset_analysis": {"columns": profile, "raw_examples": [str(h) for h in head]},
              "data_pipeline_validation": {**summary, "details": entries, "formatted_prompt_samples": samples},
              "formatted_prompts": corpus_summary, "training_summary": training,
              "evaluation_summary": evaluation or {"status": "skipped_or_failed"}}
    import json
    spark.createDataFrame([(json.dumps(report, default=str),)], "report string").coalesce(1) \
        .write.mode("overwrite").text(report_path)                                 # S7
    return bool(summary["all_passed"])


def check_divergence(logs: DataFrame) -> None:
    """V7 as a guard: raise when any run has a non-finite loss."""
    first = V.divergence(logs).orderBy("first_bad_step").limit(1).collect()
    if first:
        r = first[0]
        raise DivergenceError(f"run {r['run_id']} diverged at step {r['first_bad_step']}: {r['first_bad_loss']}")
