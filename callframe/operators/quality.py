"""Profiles, checks, selection, derived jobs.

All checks run over the whole table in one pass (projection + partial /
final aggregate); nothing is collected. Limits appear only where the
limit is the feature (first N rows of a split, last N for evaluation,
the head examples of a profile) and always with an explicit order column of
any orderable type; only the counted range that holds the cut is sorted
(``_cut``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callframe.functions import json_ops as J

# -- P1-P3: selection --------------------------------------------------------


#: keys sampled to find a limit's cut, and ranges between them that are counted
SAMPLE, RANGES = 4096, 64


def first_rows(df: DataFrame, limit: int | None, order_col: str = "record_id") -> DataFrame:
    """``dataset_limit`` first rows; a falsy limit keeps everything."""
    return _cut(df, int(limit), order_col, ascending=True) if limit else df


def last_rows(df: DataFrame, n: int, order_col: str = "record_id") -> DataFrame:
    """The last ``n`` rows in order (the evaluation fallback split)."""
    return _cut(df, max(int(n), 0), order_col, ascending=False)


def splitters(df: DataFrame, order_col: str, ranges: int = RANGES, sample: int = SAMPLE) -> list[str]:
    """At most ``ranges - 1`` keys, as text and in their own order, that cut the
    rows into ranges of about equal size: quantiles of the ``sample`` keys with
    the smallest hashes, which is the same bounded sample on every run."""
    key = F.col(order_col)
    some = df.select(key.alias("k")).filter("k IS NOT NULL").orderBy(F.xxhash64("k", F.lit(1))).limit(sample)
    found = some.orderBy("k").select(F.col("k").cast("string")).collect()  # at most ``sample`` keys
    return list(dict.fromkeys(found[i * len(found) // ranges][0] for i in range(1, ranges) if found))


def _cut(df: DataFrame, n: int, order_col: str, ascending: bool) -> DataFrame:
    """The ``n`` rows at one end of any orderable column (nulls are lowest).

    Splitters from the key itself bound ranges whose rows are counted in one
    pass over the key. The ranges inside the cut are kept by a plain comparison
    of the raw column, which a Parquet scan can skip by; only the range that
    holds the cut is sorted, for what is still missing from it."""
    if n == 0:
        return df.limit(0)
    key, kind = F.col(order_col), df.schema[order_col].dataType
    bounds = splitters(df, order_col)
    edges = [F.lit(b).cast(kind) for b in bounds]
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count(order_col).alias("keys"),
                 *[F.count_if(key < e).alias(f"below{i}") for i, e in enumerate(edges)]).first()
    if n >= row["rows"]:
        return df
    nulls = row["rows"] - row["keys"]
    # rows before each splitter; the first range starts with the nulls
    before = [0, *[nulls + row[f"below{i}"] for i in range(len(bounds))], row["rows"]]
    cut = n if ascending else row["rows"] - n          # rows before the cut
    at = max(i for i in range(len(before) - 1) if before[i] <= cut)
    low, high = (edges[at - 1] if at else None), (edges[at] if at < len(edges) else None)
    inside = key.isNull() if low is None else key >= low
    if low is None:
        inside = F.lit(True) if high is None else key.isNull() | (key < high)
    elif high is not None:
        inside = inside & (key < high)
    order = key.asc_nulls_first() if ascending else key.desc_nulls_last()
    wanted = cut - before[at] if ascending else before[at + 1] - cut
    whole = (None if low is None else key.isNull() | (key < low)) if ascending else (None if high is None else key >= high)
    rest = df.filter(inside).orderBy(order).limit(wanted) if wanted else None
    if rest is None:
        return df.filter(whole)
    return rest if whole is None else df.filter(whole).unionByName(rest)


def head_examples(df: DataFrame, k: int = 3, order_col: str = "record_id", cut: int = 500) -> DataFrame:
    """The first ``k`` rows; nested values as text cut to ``cut`` chars,
    scalars kept whole."""
    cols = []
    for name, dtype in df.dtypes:
        if dtype.startswith(("array", "map", "struct", "variant")):
            cols.append(F.substring(F.to_json(F.col(name)), 1, cut).alias(name))
        else:
            cols.append(F.col(name))
    return df.orderBy(F.col(order_col).asc()).limit(int(k)).select(*cols)  # a few rows per task


# -- V1: dataset profile -----------------------------------------------------


def dataset_profile(df: DataFrame) -> DataFrame:
    """V1, long form: one row per column with its position, Spark type,
    NULL count and the table's row count. One scan, one partial aggregate;
    types come from the schema (not from the first row)."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(f.name).isNull()).alias(f"__n{i}") for i, f in enumerate(fields)]
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{f.name}', {i + 1}, '{f.dataType.simpleString()}', `__n{i}`" for i, f in enumerate(fields))
    return wide.selectExpr(
        f"stack({len(fields)}, {stack_args}) AS (column_name, position, data_type, null_count)",
        "__rows AS total_rows",
    ).withColumn("position", F.col("position").cast("int"))


# -- V2/V3: adapter check ------------------------------------------------------


def adapter_check(normalized: DataFrame, sample: int | None = None) -> DataFrame:
    """V2 per row over a normalised frame (with its ``error`` column):
    OK / WARNING (a tool name null or ``unknown``, answers not parseable)
    / ERROR (the row is not a record). ``sample`` checks only the first
    rows by ``record_id`` (the reference looks at 5); default: all."""
    df = J.with_json(first_rows(normalized, sample), "tools", "_tv")
    a = F.col("answers")
    df = df.withColumn("_needs", a.isNotNull() & (a != "") & (a != "[]"))
    df = J.with_json(df, F.when(F.col("_needs"), a), "_av")
    df = df.withColumns({
        "_tools": F.coalesce(J.as_array("_tv"), F.array().cast("array<variant>")),
        "_alist": F.coalesce(J.as_array("_av"), F.array().cast("array<variant>")),
    })
    names = F.transform(F.filter("_tools", lambda t: J.is_object(t)), lambda t: J.get(t, "name"))
    df = df.withColumn("_names", names)
    ans_names = F.transform(F.filter("_alist", lambda t: J.is_object(t)), lambda t: J.as_string(J.get(t, "name")))
    df = df.withColumns({
        "has_null_tools": F.exists("_names", lambda n: n.isNull() | J.is_variant_null(n)
                                   | (F.coalesce(J.as_string(n), F.lit("")) == "unknown")),
        "answers_parse_error": F.col("_needs") & F.col("_av").isNull(),
        "tool_count": F.size("_tools"),
        "tool_names": F.to_json(F.transform("_names", lambda n: J.as_string(n))),
        "answers_parsed_count": F.size("_alist"),
        "answer_tool_names": F.to_json(ans_names),
    })
    ok = ~F.col("has_null_tools") & ~F.col("answers_parse_error")
    status = (F.when(F.col("error").isNotNull(), F.lit("ERROR"))
              .when(ok, F.lit("OK")).otherwise(F.lit("WARNING")))
    error_row = F.col("error").isNotNull()

    def unless_error(c: Column) -> Column:
        return F.when(~error_row, c)

    return df.select(
        "record_id",
        status.alias("status"),
        unless_error(F.substring("query", 1, 200)).alias("query"),
        unless_error(F.col("tool_count")).alias("tool_count"),
        unless_error(F.col("tool_names")).alias("tool_names"),
        unless_error(F.col("has_null_tools")).alias("has_null_tools"),
        unless_error(F.coalesce(F.substring("answers", 1, 300), F.lit(""))).alias("answers_raw"),
        unless_error(F.col("answers_parsed_count")).alias("answers_parsed_count"),
        unless_error(F.col("answer_tool_names")).alias("answer_tool_names"),
        unless_error(F.col("answers_parse_error")).alias("answers_parse_error"),
        F.col("error"),
    )


def adapter_summary(checked: DataFrame) -> DataFrame:
    """V3: one row. An empty input passes (``all([])``)."""
    return checked.agg(
        F.count(F.lit(1)).alias("samples_checked"),
        F.coalesce(F.bool_and(F.col("status") == "OK"), F.lit(True)).alias("all_passed"),
        F.count_if(F.coalesce(F.col("has_null_tools"), F.lit(False))).alias("null_tool_name_count"),
        F.count_if(F.coalesce(F.col("answers_parse_error"), F.lit(False))).alias("answer_parse_error_count"),
    )


def gate(summary: DataFrame) -> bool:
    """V5: stop before the expensive step when the adapter check fails.
    Reads the one-row summary (an action on one row)."""
    row = summary.select("all_passed").first()
    return bool(row and row[0])


# -- V6: item rules ------------------------------------------------------------

# The item schema's bounds.
ITEM_RULES = {
    "item_code_length": "length(item_code) BETWEEN 3 AND 20",
    "name_length": "length(name) BETWEEN 2 AND 50",
    "cost_positive": "cost > 0",
    "quantity_non_negative": "quantity >= 0",
}


def item_checks(items: DataFrame) -> DataFrame:
    """V6 per item: one boolean per rule (NULL fields fail) and ``valid``."""
    checks = {f"ok_{k}": F.coalesce(F.expr(v), F.lit(False)) for k, v in ITEM_RULES.items()}
    df = items.withColumns(checks)
    valid = F.lit(True)
    for k in checks:
        valid = valid & F.col(k)
    return df.withColumn("valid", valid)


def item_quarantine(items: DataFrame) -> DataFrame:
    """V6: the items that break a rule, all columns kept, with the names of
    the broken rules in rule order. Every other item is valid."""
    broken = F.array_compact(F.array(*[F.when(~F.col(f"ok_{k}"), F.lit(k)) for k in ITEM_RULES]))
    checked = item_checks(items)
    return checked.filter(~F.col("valid")).select(*items.columns, F.array_join(broken, ",").alias("broken_rules"))


def item_rules(items: DataFrame) -> DataFrame:
    """V6 summary, long form: violations per rule over all items."""
    checked = item_checks(items)
    wide = checked.agg(*[F.count_if(~F.col(f"ok_{k}")).alias(k) for k in ITEM_RULES],
                       F.count(F.lit(1)).alias("__n"))
    pairs = ", ".join(f"'{k}', `{k}`" for k in ITEM_RULES)
    return wide.selectExpr(f"stack({len(ITEM_RULES)}, {pairs}) AS (rule, violations)", "__n AS items")


# -- V7: divergence ------------------------------------------------------------


def non_finite(loss: Column) -> Column:
    return F.isnan(loss) | (F.abs(loss) == F.lit(float("inf")))


def divergence(logs: DataFrame, run_col: str = "run_id", step_col: str = "step",
               loss_col: str = "loss") -> DataFrame:
    """V7: per run, the first step whose loss is NaN or infinite, the loss
    there, and how many such steps. Filter before the shuffle; partial
    aggregation keeps one row per run per map task."""
    bad = logs.filter(non_finite(F.col(loss_col)))
    first = F.min(F.struct(F.col(step_col).alias("step"), F.col(loss_col).alias("loss")))
    return bad.groupBy(F.col(run_col).alias("run_id")).agg(
        first.alias("_first"), F.count(F.lit(1)).alias("n_bad_steps")
    ).select(
        "run_id",
        F.col("_first.step").alias("first_bad_step"),
        F.col("_first.loss").cast("string").alias("first_bad_loss"),
        "n_bad_steps",
    )


# -- D1/D2: derived jobs ---------------------------------------------------------


def overlap(train: DataFrame, evaluation: DataFrame, key: str = "query") -> DataFrame:
    """Evaluation rows whose ``key`` also occurs in the training rows.

    Both sides first meet by a 64-bit digest of the key, numbers only; the
    texts of the digests that both have are then compared. So no key text moves
    for rows that match nothing, beyond a scan's runtime filter on the digest
    (Bloom filter), and an equal digest alone is never a match."""
    digest = F.xxhash64(key)
    mine, other = (df.filter(F.col(key).isNotNull()).select(digest.alias("_digest")).distinct() for df in (evaluation, train))
    both = mine.join(other, "_digest")
    texts = train.select(key, digest.alias("_digest")).join(both, "_digest", "left_semi").select(key).distinct()
    rows = evaluation.withColumn("_digest", digest).join(both, "_digest", "left_semi").drop("_digest")
    return rows.join(texts, key, "left_semi")


def _tool_schemas(records: DataFrame) -> DataFrame:
    """(name, t): every tool of every record, flattened (a nested ``function``
    object replaces its wrapper)."""
    df = J.with_json(records.select("tools"), "tools", "_tv")
    tools = df.select(F.explode(J.as_array("_tv")).alias("t"))
    tools = tools.withColumn("_fn", J.get("t", "function"))
    tools = tools.filter(J.is_object("t")).select(
        F.when(J.is_object("_fn"), F.col("_fn")).otherwise(F.col("t")).alias("t"))
    return tools.select(J.as_string(J.get("t", "name")).alias("name"), "t")


def tool_catalogue(records: DataFrame) -> DataFrame:
    """Per tool name across all records: uses and distinct schemas (by
    128 bits of the canonical text's SHA-256, so no schema text moves);
    partial aggregation keeps a hot name to one row per map task and schema."""
    digest = F.substring(F.unhex(F.sha2(J.canon("t"), 256)), 1, 16)
    tools = _tool_schemas(records).select("name", digest.alias("schema"))
    return tools.groupBy("name").agg(
        F.count(F.lit(1)).alias("uses"),
        F.count_distinct("schema").alias("n_schemas"),
    )


def tool_conflicts(records: DataFrame) -> DataFrame:
    """The names whose schemas differ, and where: per name and top-level
    key of the schema (``parameters.x`` for the keys of an object under
    ``parameters``), how many different values it has over the name's
    schemas, absent counted as one. Keys on which all schemas of a name agree
    are left out. Distinct schemas are few beside their uses, so they are
    reduced before their keys are listed."""
    tools = _tool_schemas(records)
    tools = tools.select("name", J.canon("t").alias("schema")).filter("name IS NOT NULL").distinct()
    parsed = J.with_json(tools, "schema", "_v")
    top, inner = J.as_object("_v"), J.as_object(J.get("_v", "parameters"))
    empty = F.create_map().cast("map<string,variant>")

    def listed(m: Column, prefix: str) -> Column:
        return F.transform(F.map_entries(F.coalesce(m, empty)), lambda e: F.struct(
            F.concat(F.lit(prefix), e["key"]).alias("key"), F.xxhash64(J.canon(e["value"])).alias("value")))

    keys = parsed.select("name", F.explode(F.concat(listed(top, ""), listed(inner, "parameters."))).alias("e"))
    keys = keys.filter(F.col("e.key") != "name").groupBy("name", F.col("e.key").alias("key")).agg(
        F.count(F.lit(1)).alias("present"), F.count_distinct("e.value").alias("n_values"))
    total = tools.groupBy("name").agg(F.count(F.lit(1)).alias("n_schemas")).filter("n_schemas > 1")
    out = keys.join(total, "name").withColumn("n_values", F.col("n_values") + (F.col("present") < F.col("n_schemas")).cast("int"))
    return out.filter("n_values > 1").select("name", "n_schemas", "key", "n_values")
