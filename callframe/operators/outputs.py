"""Parse a table of model outputs into flags and calls.

All narrow: one projection, no shuffle, no Python. The call's tag is searched
once, and the JSON payload is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callframe.functions import json_ops as J
from callframe.functions import text as X


def parse_outputs(outputs: DataFrame, text_col: str = "raw_response") -> DataFrame:
    """Adds ``has_thought, has_tool_call, tool_call_body, is_valid_json,
    parsed_json (VARIANT), is_abort, predicted_calls (ARRAY<VARIANT>)``.

    * tags: first match, case-insensitive, dot matches newline (O2);
    * the body is stripped of a code fence and whitespace (O3);
    * ``is_valid_json`` is a strict parse of that body (O4);
    * ``is_abort``: ``[ABORT:`` anywhere in the upper-cased text (O5);
    * predicted calls: a list as it is, an object wrapped, anything falsy or
      scalar gives none (O6).
    """
    text = F.col(text_col)
    df = outputs.select(
        "*",
        X.has_tag(text, "thought", ignore_case=True).alias("has_thought"),
        X.whole_tag(text, "tool_call", ignore_case=True).alias("_whole"),
        F.coalesce(F.upper(text).contains("[ABORT:"), F.lit(False)).alias("is_abort"),
    )
    df = df.withColumn("_b1", X.py_strip(X.tag_inner("_whole", "tool_call")))
    df = df.withColumn("tool_call_body", X.strip_fence("_b1"))
    df = J.with_json(df, "tool_call_body", "parsed_json")
    return df.withColumns({
        "has_tool_call": F.col("_whole").isNotNull(),
        "is_valid_json": F.col("parsed_json").isNotNull(),
        "predicted_calls": predicted_calls(F.col("parsed_json")),
    }).drop("_whole", "_b1")


def predicted_calls(parsed: Column) -> Column:
    """List kept, non-empty object wrapped, everything else none."""
    arr = J.as_array(parsed)
    obj = J.as_object(parsed)
    empty = F.array().cast("array<variant>")
    return (
        F.when(arr.isNotNull(), arr)
        .when(obj.isNotNull() & (F.size(obj) > 0), F.array(parsed))
        .otherwise(empty)
    )


def separators_conform(text: Column) -> Column:
    """Every comma between the elements of the outermost array is followed
    by a newline. String literals are emptied first; of the rest only brackets
    and commas stay (``;`` for a comma with its newline), which a fold reads
    with the depth as its state (-1 once a bare comma was met at depth 1)."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', '""')
    marks = F.regexp_replace(F.replace(bare, F.lit(",\n"), F.lit(";")), r"[^\[\]{},;]", "")
    depth = F.aggregate(F.split(marks, ""), F.lit(0), lambda d, c: (
        F.when(d < 0, d).when(c.isin("[", "{"), d + 1).when(c.isin("]", "}"), d - 1)
        .when((c == ",") & (d == 1), F.lit(-1)).otherwise(d)))
    return (depth == 0) & ~bare.contains("\r")


def conformance(outputs: DataFrame, text_col: str = "raw_response") -> DataFrame:
    """O7 per row: the whole output is an array in the notebook's grammar:
    it opens with ``[`` and a newline, its elements are separated by a comma
    and a newline, it closes on the final ``]`` with nothing after it, holds
    neither carriage returns between tokens nor the DEL character, and parses
    as a JSON array."""
    text = F.col(text_col)
    shaped = text.startswith("[\n") & text.endswith("]") & ~text.contains("\x7f")
    df = J.with_json(outputs, F.when(shaped, text), "_conf_v")
    ok = shaped & J.is_array("_conf_v")
    return df.withColumn("is_conformant", F.coalesce(ok & separators_conform(text), F.lit(False))).drop("_conf_v")


def conformance_rate(outputs: DataFrame, by: list[str], text_col: str = "raw_response") -> DataFrame:
    """O7 per group: share of conforming outputs (partial + final aggregate)."""
    return (
        conformance(outputs, text_col)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("is_conformant")).alias("n_conformant"),
            F.round(F.avg(F.col("is_conformant").cast("double")), 6).alias("conformance_rate"),
        )
    )
