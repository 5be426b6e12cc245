"""The scoring and divergence jobs on Structured Streaming.

Both read an append-only folder of Parquet files (``readStream``), apply the
same functions as the batch jobs, and write through a checkpointed sink, so
a restarted or partly failed run resumes where it stopped. Folders live
under the session's ``spark.checkpoint.dir`` (the cluster's shared
storage); only a local-mode session without that setting, as in tests, gets a
temporary one.

* W1 ``score_stream``: outputs stream, left-joined with the static truth
  (re-read per micro-batch), scored by ``score.decide``; an output without a
  truth record is listed as ``No Truth``. The trace goes to a Parquet file
  sink in append mode. ``outcome_windows`` counts outcomes per window of the
  outputs' own event time under a watermark: a window is written once, when
  the watermark passes its end, and its state is dropped. Rows that come after
  that are not counted in it; ``late_counts`` tells how many, per window, from
  the trace, which has every row.
* W2 ``divergence_alerts``: one alert per run and watermark span, whatever
  repeats; the state of a run ends with the span. ``divergence_stream`` keeps
  the first step per run as a streaming aggregate (one row of state per run);
  each micro-batch writes that small table anew (complete mode).

``run_*`` helpers drive a query to completion with ``Trigger.AvailableNow``
(tests and the registered queries); on a cluster pass another trigger. Running
one again on the same checkpoint goes on with the files that came since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callframe.operators import quality as V
from callframe.operators import score as S
from callframe.session import make_folder


def score_stream(outputs_stream: DataFrame, truth: DataFrame, on: str = "record_id",
                 prepared: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """A streaming frame of scored rows (same columns as the batch
    trace, then ``keep`` of the stream's own). ``truth`` is static; pass
    ``prepared=True`` when it already went through ``score.prepare_truth``
    (e.g. written once with ``write_prepared_truth``) so micro-batches do not
    re-parse it."""
    truth = truth if prepared else S.prepare_truth(truth)
    parsed = S.prepare_outputs(outputs_stream)
    return S.trace(S.decide(parsed.join(truth.withColumn("_has_truth", F.lit(True)), on, "left")), keep)


def write_prepared_truth(truth: DataFrame, path: str, table: str | None = None,
                         buckets: int | None = None, key: str = "record_id") -> DataFrame:
    """Parse the static truth once into Parquet (VARIANT columns included)
    and return it as a table for the stream-static join.

    With ``table`` the data is bucketed (and sorted) by ``key``: streaming
    micro-batches run without AQE, and a plain static side would be
    re-shuffled in every batch; a bucketed side is read in place and only
    the new stream rows are shuffled to match it."""
    spark = truth.sparkSession
    prepared = S.prepare_truth(truth)
    if not table:
        prepared.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one task per bucket writes it, so a bucket is one file
    (prepared.repartition(n, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def _windowed(ts_col: str, window: str) -> list:
    return [F.window(ts_col, window).alias("w"), F.col("outcome")]


def _window_rows(counted: DataFrame) -> DataFrame:
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "outcome", "n")


def outcome_windows(scored_stream: DataFrame, ts_col: str = "event_time", window: str = "1 hour",
                    watermark: str = "1 hour") -> DataFrame:
    """Outcome counts per window of the stream's event time. In append
    mode a window is emitted once, when the watermark (the latest event time
    less ``watermark``) passes its end."""
    return _window_rows(scored_stream.withWatermark(ts_col, watermark).groupBy(*_windowed(ts_col, window))
                        .agg(F.count(F.lit(1)).alias("n")))


def late_counts(trace: DataFrame, windows: DataFrame, ts_col: str = "event_time", window: str = "1 hour",
                watermark: str = "1 hour") -> DataFrame:
    """Rows that came after their window was closed: ``window_start,
    window_end, outcome, n_late``. The trace has every row; what a closed
    window of ``outcome_windows`` does not count was late."""
    closed = trace.agg(F.max(ts_col) - F.expr(f"INTERVAL {watermark}")).scalar()
    seen = _window_rows(trace.groupBy(*_windowed(ts_col, window)).agg(F.count(F.lit(1)).alias("n")))
    keys = ["window_start", "window_end", "outcome"]
    both = seen.filter(F.col("window_end") <= closed).join(windows.withColumnRenamed("n", "counted"), keys, "left")
    return both.select(*keys, (F.col("n") - F.coalesce("counted", F.lit(0))).alias("n_late")).filter("n_late > 0")


def divergence_alerts(logs_stream: DataFrame, ts_col: str = "ts", span: str = "1 day", run_col: str = "run_id",
                      step_col: str = "step", loss_col: str = "loss") -> DataFrame:
    """The first non-finite step that arrives of each run, once per
    watermark span: later ones, and the same rows sent again, give nothing
    while the span lasts. State is one key per alerted run and span."""
    bad = logs_stream.filter(V.non_finite(F.col(loss_col))).withColumnRenamed(run_col, "run_id")
    once = bad.withWatermark(ts_col, span).dropDuplicatesWithinWatermark(["run_id"])
    return once.select("run_id", F.col(step_col).alias("step"), F.col(loss_col).cast("string").alias("loss"), ts_col)


def divergence_stream(logs_stream: DataFrame, run_col: str = "run_id", step_col: str = "step",
                      loss_col: str = "loss") -> DataFrame:
    """First non-finite step per run, as a streaming aggregate."""
    return V.divergence(logs_stream, run_col, step_col, loss_col)


def read_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files of ``path`` as they come; the folder is made if nothing came yet."""
    make_folder(spark, path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def run_append(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet file sink (exactly-once via its log)."""
    writer = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    q = writer.trigger(availableNow=True).start() if available_now else writer.start()
    if available_now:
        q.awaitTermination()
    return q


def run_complete(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Complete-mode aggregate, written as a whole table per micro-batch (the
    table is small: one row per group). Each batch has a folder of its own, so
    a crash never leaves readers without the last whole result
    (``read_complete``); a repeated batch replaces only its own folder."""

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    writer = (stream.writeStream.outputMode("complete").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    q = writer.trigger(availableNow=True).start() if available_now else writer.start()
    if available_now:
        q.awaitTermination()
    return q


def read_complete(spark: SparkSession, sink: str) -> DataFrame:
    """The newest whole result of ``run_complete``."""
    every = spark.read.parquet(sink)
    last = every.agg(F.max("epoch")).first()[0]
    return every.filter(F.col("epoch") == last).drop("epoch")
