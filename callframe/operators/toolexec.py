"""Tool calls executed as joins over data tables.

The notebook runs one call at a time against a Python list of items. Here
calls are a table: they are exploded with their position, and each tool is
an equi-join against a table that was first aggregated down to one row per
join key (items per code, first item per name), so a hot code or name
never moves more than one row per map task. The "all items" branch reads a
scalar subquery (exactly one row) instead of joining every item.

Money is summed in DECIMAL so totals do not depend on partitioning or
order; a sum is multiplied by its rate last, in double, so the rate keeps its
digits. Results are rounded to 2 places (Spark rounds half up on the decimal
text, Python's ``round`` works on the binary float: settled deviation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callframe.functions import json_ops as J
from callframe.operators.normalize import keep_filters_above

MONEY = "decimal(20,6)"


def explode_calls(df: DataFrame, id_col: str = "call_id", calls_col: str = "calls") -> DataFrame:
    """One row per call with its position: ``call_id, pos, name,
    args (VARIANT), args_text`` (compact, key order kept). Rows whose calls
    are not a JSON list give none. Each element's text comes from the same
    row (``from_json`` to ``array<string>``, zipped with the parsed array),
    so no join is needed to print a call as it was written."""
    base = df.select(F.col(id_col).alias("call_id"), F.col(calls_col).alias("_calls"))
    base = J.with_json(base, "_calls", "_cv")
    texts = F.from_json(F.col("_calls"), "array<string>")
    zipped = F.arrays_zip(J.as_array("_cv").alias("call"), texts.alias("text"))
    ex = base.select("call_id", F.posexplode(zipped).alias("pos", "z"))
    return ex.select("call_id", "pos", J.as_string(J.get("z.call", "name")).alias("name"),
                     J.get("z.call", "arguments").alias("args"),
                     F.get_json_object(F.col("z.text"), "$.arguments").alias("args_text"))


def _item_value(items: DataFrame) -> Column:
    return F.col("cost").cast(MONEY) * F.col("quantity")


def value_by_code(items: DataFrame) -> DataFrame:
    """Items aggregated to one row per code: ``item_code, value``."""
    return items.groupBy("item_code").agg(F.sum(_item_value(items)).alias("value"))


def first_item_by_name(items: DataFrame) -> DataFrame:
    """C3 lookup table: per name, the first item in item order."""
    first = F.min(F.struct("item_order", "item_code", "cost", "quantity"))
    return items.groupBy("name").agg(first.alias("_first")).select(
        F.col("name").alias("item_name"),
        F.col("_first.item_code").alias("item_code"),
        F.col("_first.cost").alias("cost"),
        F.col("_first.quantity").alias("quantity"),
    )


def _money(v: Column) -> Column:
    return F.round(v, 2).cast("double")


def _times_rate(v: Column, rate: Column) -> Column:
    """A decimal sum times a rate that keeps all its digits (double),
    rounded last."""
    return _money(v.cast("double") * rate)


def inventory_value(calls: DataFrame, items: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """C2 on exploded calls named ``inventory_check``: value of the items
    whose code is listed, times the rate; codes NULL or empty mean all
    items. ``status``: ok, or bad_arguments (no ``item_codes`` key, codes
    not a list, or a rate that is missing or not a number)."""
    inv = calls.filter(F.col("name") == "inventory_check")
    inv = inv.withColumns({"_codes": J.get("args", "item_codes"), "_rate_v": J.get("args", "conversion_rate")})
    inv = inv.withColumns({"_codes_k": J.kind("_codes"), "_rate_k": J.kind("_rate_v")})
    inv = inv.withColumns({
        "_codes_arr": J.as_array("_codes"),
        "rate": F.when(F.col("_rate_k") == "number", F.col("_rate_v").try_cast("double")),
        "status": F.when(F.col("_codes").isNull() | ~F.col("_codes_k").isin("null", "array")
                         | ~F.coalesce(F.col("_rate_k") == "number", F.lit(False)), F.lit("bad_arguments")).otherwise(F.lit("ok")),
    })
    inv = inv.withColumn("all_items", (F.col("_codes_k") == "null") | (F.size("_codes_arr") == 0))
    listed = ~F.col("all_items") & (F.col("status") == "ok")
    codes = F.when(listed, F.array_distinct(F.transform("_codes_arr", J.as_string)))
    # one row per listed code; calls without one stay, each under a key of its own
    rows = inv.select("call_id", "pos", "status", "all_items", "rate", *(keep or []), F.explode_outer(codes).alias("_code"))
    rows = rows.withColumn("item_code", _own_key("_code"))
    # the group is one call: its columns are the same on all rows
    same = ["status", "all_items", "rate", *(keep or [])]
    out = (rows.join(value_by_code(items), "item_code", "left").groupBy("call_id", "pos")
           .agg(F.sum("value").alias("listed_value"), *[F.any_value(c).alias(c) for c in same]))
    total = items.agg(F.sum(_item_value(items))).scalar()
    value = F.when(F.col("all_items"), total).otherwise(F.coalesce(F.col("listed_value"), F.lit(0)))
    return out.select(
        "call_id", "pos", "status", "all_items",
        F.when(F.col("status") == "ok", _times_rate(value, F.col("rate"))).alias("value"),
        *(keep or []),
    )


def _own_key(key: str) -> Column:
    """The join key, or for rows without one a key that nothing else has, so
    that such rows are spread instead of meeting under NULL."""
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col("call_id").cast("string"), F.lit(":"), F.col("pos").cast("string")))


def item_by_name(calls: DataFrame, items: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """C3 on exploded calls named ``fetch_item_by_name``: the first item
    with that name, or none (``status = not_found``)."""
    fetch = calls.filter(F.col("name") == "fetch_item_by_name").select(
        "call_id", "pos", J.as_string(J.get("args", "item_name")).alias("item_name"), *(keep or []))
    found = fetch.join(first_item_by_name(items), "item_name", "left")
    return found.select(
        "call_id", "pos", "item_name", "item_code",
        F.when(F.col("item_code").isNull(), F.lit("not_found")).otherwise(F.lit("found")).alias("status"),
        *(keep or []),
    )


def chained_calls(calls: DataFrame, items: DataFrame, id_col: str = "call_id", calls_col: str = "calls") -> DataFrame:
    """C4: rows whose first call is ``fetch_item_by_name`` and second
    ``inventory_check``: the item found by name feeds the check with its
    code (the notebook's round trip). Read in-row, no self-join; each
    lookup joins a one-row-per-key table."""
    base = calls.select(F.col(id_col).alias("call_id"), F.col(calls_col).alias("_c"))
    base = J.with_json(base, "_c", "_cv")
    base = base.withColumns({"_c0": J.at("_cv", 0), "_c1": J.at("_cv", 1)})
    # the filter reads the parsed calls; keep it from being pushed below
    # (and re-parsing) the JSON projection
    base = keep_filters_above(base)
    chained = base.filter(
        (J.as_string(J.get("_c0", "name")) == "fetch_item_by_name")
        & (J.as_string(J.get("_c1", "name")) == "inventory_check")
        & (F.col("_pid") >= 0)
    ).select(
        "call_id",
        J.as_string(J.get(J.get("_c0", "arguments"), "item_name")).alias("item_name"),
        J.get(J.get("_c1", "arguments"), "conversion_rate").try_cast("double").alias("rate"),
    )
    # name -> code -> value meet on the items' side, so the calls are joined once
    # and the rows without an item never share a null key
    priced = (first_item_by_name(items).select("item_name", "item_code")
              .join(value_by_code(items), "item_code", "left"))
    valued = chained.join(priced, "item_name", "left")
    return valued.select(
        "call_id", "item_name", "item_code",
        F.when(F.col("item_code").isNull(), F.lit("not_found")).otherwise(F.lit("ok")).alias("status"),
        F.when(F.col("item_code").isNotNull(), _times_rate(F.coalesce(F.col("value"), F.lit(0)), F.col("rate")))
        .alias("value"),
    )


def inventory_total(items: DataFrame, rate: float = 1.0) -> DataFrame:
    """``round(sum(cost * quantity * rate), 2)`` over all items."""
    return items.agg(_times_rate(F.sum(_item_value(items)), F.lit(float(rate))).alias("total_value"),
                     F.count(F.lit(1)).alias("items"))


# -- C5/C6: vectors ------------------------------------------------------------------


def vector_sum(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Element-wise sum; vectors of unequal length give NULL and an
    error (Spark's ``zip_with`` would pad with NULL instead)."""
    x, y = F.col(a).cast("array<double>"), F.col(b).cast("array<double>")
    same = F.size(x) == F.size(y)
    return pairs.withColumns({
        "vsum": F.when(same, F.zip_with(x, y, lambda p, q: p + q)),
        "error": F.when(~same, F.lit("Vectors must be of the same length")),
    })


def dot_product(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Sum of element-wise products, left to right."""
    x, y = F.col(a).cast("array<double>"), F.col(b).cast("array<double>")
    same = F.size(x) == F.size(y)
    prod = F.zip_with(x, y, lambda p, q: p * q)
    return pairs.withColumns({
        "dot": F.when(same, F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)),
        "error": F.when(~same, F.lit("Vectors must be of the same length")),
    })


# -- C7: round-trip transcripts -------------------------------------------------------

# The notebook's context prompt and final assistant turn.
CONTEXT_PROMPT = ("You are a super helpful AI assistant.\n"
                  "You are asked to answer a question based on the following context information.\n"
                  "Question:\n{question}")
ANSWER_PREFIX = "Answer:\n"


def call_id(record_id: Column, pos: Column) -> Column:
    """Deterministic 9-character call id (the notebook draws random ones)."""
    return F.substring(F.sha2(F.concat_ws(":", record_id.cast("string"), pos.cast("string")), 256), 1, 9)


def executed_calls(calls: DataFrame, items: DataFrame, id_col: str = "call_id",
                   calls_col: str = "calls") -> DataFrame:
    """Each call of each record with its result text, for C7: ``call_id,
    pos, name, args_text, result``. ``inventory_check`` gives its value
    (2 decimals), ``fetch_item_by_name`` the item code or ``null``."""
    ex = explode_calls(calls, id_col, calls_col)
    keep = ["name", "args_text"]
    cols = ["call_id", "pos", *keep]
    # each tool's results carry the call's own columns: a union of two branches, no join back
    checks = inventory_value(ex, items, keep).select(
        *cols, F.when(F.col("value").isNotNull(), F.format_string("%.2f", F.col("value"))).alias("result"))
    rest = ex.filter(~F.coalesce(F.col("name") == "inventory_check", F.lit(False))).select(
        *cols, F.when(F.col("name") == "fetch_item_by_name", J.as_string(J.get("args", "item_name"))).alias("_wanted"))
    rest = rest.withColumn("item_name", _own_key("_wanted")).join(
        first_item_by_name(items).select("item_name", F.col("item_code").alias("result")), "item_name", "left")
    return checks.unionByName(rest.select(*cols, "result"))


def transcripts(executed: DataFrame, questions: DataFrame) -> DataFrame:
    """Per record, user turn with context, then per executed call an
    assistant turn with the call (id, type, function name and arguments) and a
    tool turn with the tool's name and result, then ``Answer:``. A record
    without calls has only the first and the last turn. ``executed``:
    ``call_id, pos, name, args_text, result``; ``questions``: ``call_id,
    question``. Messages are rendered with ChatML markers; the per-record
    group is bounded by the number of calls in that record (one row's
    array)."""
    name = F.coalesce(F.col("name"), F.lit(""))
    # JSON text of the name alone, quotes and escapes included
    quoted = F.regexp_extract(F.to_json(F.struct(name.alias("n"))), r'(?s)^\{"n":(.*)\}$', 1)
    turns = executed.select(
        "call_id", "pos",
        F.concat(
            F.lit('<|im_start|>assistant\n<tool_call>\n{"id":"'), call_id(F.col("call_id"), F.col("pos")),
            F.lit('","type":"function","function":{"name":'), quoted, F.lit(',"arguments":'),
            F.coalesce(F.col("args_text"), F.lit("null")),
            F.lit("}}\n</tool_call><|im_end|>\n<|im_start|>tool\n"), name, F.lit("\n"),
            F.coalesce(F.col("result"), F.lit("null")), F.lit("<|im_end|>\n"),
        ).alias("turn_text"),
    )
    grouped = turns.groupBy("call_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_text"))).alias("_turns"))
    joined = questions.join(grouped, "call_id", "left")
    prompt = F.concat(F.lit(CONTEXT_PROMPT.split("{question}")[0]), F.coalesce(F.col("question"), F.lit("")))
    return joined.select(
        "call_id",
        F.concat(
            F.lit("<|im_start|>user\n"), prompt, F.lit("<|im_end|>\n"),
            F.coalesce(F.array_join(F.transform("_turns", lambda t: t["turn_text"]), ""), F.lit("")),
            F.lit("<|im_start|>assistant\n" + ANSWER_PREFIX),
        ).alias("transcript"),
    )
