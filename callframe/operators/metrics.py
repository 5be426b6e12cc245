"""A1-A5: counters over a scored frame, as partial + final aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callframe.operators.score import CATEGORIES, FN, FP, INVALID, NO_OUTPUT, NO_TRUTH, TN, TP


def _n(cond: Column) -> Column:
    return F.count_if(cond)


def answered() -> Column:
    """The row pairs a record with an output: what the samples count."""
    return ~F.col("outcome").isin(NO_OUTPUT, NO_TRUTH)


def confusion_aggs() -> list[Column]:
    """Samples are rows with an output; the four counts and ``invalid`` add up
    to them. Records without an output are counted beside them."""
    o = F.col("outcome")
    return [
        _n(answered()).alias("total_samples"),
        _n(o == TP).alias("true_positives"),
        _n(o == FP).alias("false_positives"),
        _n(o == TN).alias("true_negatives"),
        _n(o == FN).alias("false_negatives"),
        _n(o == INVALID).alias("invalid"),
        _n(o == NO_OUTPUT).alias("no_output"),
    ]


def confusion(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A1 (A5 with ``by``): one row per group."""
    if by:
        return scored.groupBy(*by).agg(*confusion_aggs())
    return scored.agg(*confusion_aggs())


def error_distribution(scored: DataFrame) -> DataFrame:
    """A2, long form: every category with its count, zeros included.

    ``missing_tool`` is counted (the reference assigns it but never adds
    it up; settled deviation)."""
    cat = F.col("error_category")
    wide = scored.agg(*[_n(cat == f"error_{c}").alias(c) for c in CATEGORIES])
    pairs = ", ".join(f"'{c}', `{c}`" for c in CATEGORIES)
    return wide.selectExpr(f"stack({len(CATEGORIES)}, {pairs}) AS (category, n)")


def perf(scored: DataFrame) -> DataFrame:
    """A3: mean latency = total / max(1, n) over rows with an output (all rows
    of a frame without outcomes); tokens per second = tokens / (ms / 1000), 0
    without latency."""
    samples = _n(answered()) if "outcome" in scored.columns else F.count(F.lit(1))
    agg = scored.agg(
        samples.alias("total_samples"),
        F.sum("latency_ms").alias("total_latency_ms"),
        F.sum("generated_tokens").alias("total_generated_tokens"),
    )
    ms = F.coalesce(F.col("total_latency_ms"), F.lit(0.0))
    return agg.select(
        "total_samples",
        F.round(ms / F.greatest(F.lit(1), F.col("total_samples")), 6).alias("avg_latency_ms"),
        F.round(F.when(ms > 0, F.col("total_generated_tokens") / (ms / 1000)).otherwise(F.lit(0.0)), 6)
        .alias("tokens_per_second"),
    )


def confusion_table(scored: DataFrame) -> DataFrame:
    """A4: the 2x2 behind the confusion chart, long form (actual,
    predicted, n), zeros included; ``Invalid`` rows stay out."""
    wide = scored.agg(*confusion_aggs())
    return wide.selectExpr(
        "stack(4, 'Positive', 'Positive', true_positives, 'Negative', 'Positive', false_positives,"
        " 'Positive', 'Negative', false_negatives, 'Negative', 'Negative', true_negatives)"
        " AS (actual, predicted, n)"
    )


def failure_table(scored: DataFrame) -> DataFrame:
    """A4: the failure chart's rows (it leaves out missing_tool)."""
    return error_distribution(scored).filter(F.col("category") != "missing_tool")


def by_dimension(scored: DataFrame, dim: Column, name: str = "dim") -> DataFrame:
    """A5 with subtotals: ``rollup`` over one dimension; the grand total has
    ``level = 1`` and a NULL key."""
    return (
        scored.withColumn(name, dim)
        .rollup(name)
        .agg(*confusion_aggs(), F.grouping_id().alias("level"))
    )


def by_dimensions(scored: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """A5 over several dimensions: the counts of every combination of the
    dimensions and of every subtotal (``cube``), in one aggregate with one
    exchange. ``level`` is the grouping id: bit i (from the last dimension)
    is set where that dimension is summed over, so a NULL key of the data
    and a subtotal stay apart."""
    return (scored.select("outcome", *[c.alias(n) for n, c in dims.items()])
            .cube(*dims).agg(*confusion_aggs(), F.grouping_id().alias("level")))
