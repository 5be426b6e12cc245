"""Raw rows into unified records ``(record_id, query, tools, answers)``.

``tools`` and ``answers`` are JSON text: compact, and for rows whose
tools are taken as they came (flat rows) in their original key order.
Rows that break the record contract get an ``error`` reason instead of
failing the job; ``split`` separates them into a quarantine frame.

Nested conversations (one row with an array of messages) are folded in the
row: one ``aggregate`` over the messages whose state is the record so far. No
row moves, and every other column of the row stays.

Conversations in long form (one row per turn) are folded without an ordered
loop and without collecting a conversation into one row (SURVEY §2.3.1):

* stage A, one aggregate per conversation and range of ``RANGE_TURNS`` turns:
  last user turn, last call turn and the first answers at or after it. Only a
  range's deciding turns are listed, so the list is bounded, and a huge
  conversation is spread over its ranges;
* stage B merges neighbouring ranges, ``RANGE_TURNS`` at a time: the last one
  with a call, then the first from there on that has answers. No list holds
  more than that, up to RANGE_TURNS ** (LEVELS + 2) turns (6.9e10).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callframe.functions import json_ops as J
from callframe.functions import text as X

# Role names of the conversation format.
QUERY_ROLES = ("user", "human")
CALL_ROLES = ("function_call", "tool_call", "tool")
ASSISTANT_ROLES = ("assistant", "gpt", "model")

EMPTY = "[]"
#: turns of one conversation, or ranges of turns, that one group of a fold stage may hold
RANGE_TURNS = 512
#: merges of RANGE_TURNS neighbouring ranges before the last one
LEVELS = 2


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _stage(df: DataFrame, **cols: Column) -> DataFrame:
    """One projection step. Later steps refer to these columns by name, so
    expression trees stay small (each helper would otherwise copy its input
    subtree several times) and whole-stage codegen stays within limits."""
    return df.withColumns(cols)


def with_normalized_answers(df: DataFrame, src: str, out: str) -> DataFrame:
    """Text of a call turn into a JSON list of calls, as column ``out``.

    Empty → ``[]``; strip; a list is kept, an object with ``name`` wrapped;
    else retry with every ``'`` replaced by ``"``; else ``[]``."""
    p = f"_{out}_"
    df = _stage(df, **{p + "c": X.py_strip(src)})
    df = _stage(df, **{p + "f": F.replace(F.col(p + "c"), F.lit("'"), F.lit('"'))})
    df = J.with_json(df, p + "c", p + "v1")
    df = J.with_json(df, p + "f", p + "v2")
    df = _stage(df, **{
        p + "a1": J.is_array(p + "v1"), p + "o1": J.has_key(p + "v1", "name"),
        p + "a2": J.is_array(p + "v2"), p + "o2": J.has_key(p + "v2", "name"),
    })
    content, c, f = F.col(src), F.col(p + "c"), F.col(p + "f")
    result = (
        F.when(content.isNull() | (content == ""), F.lit(EMPTY))
        .when(F.col(p + "a1"), J.compact(c))
        .when(F.col(p + "o1"), F.concat(F.lit("["), J.compact(c), F.lit("]")))
        .when(F.col(p + "a2"), J.compact(f))
        .when(F.col(p + "o2"), F.concat(F.lit("["), J.compact(f), F.lit("]")))
        .otherwise(F.lit(EMPTY))
    )
    df = _stage(df, **{out: result})
    return df.drop(*[p + x for x in ("c", "f", "v1", "v2", "a1", "o1", "a2", "o2")])


def normalized_answers(content: Column) -> Column:
    """N4 as one expression. The text with swapped quotes is parsed only where
    the text itself gives no calls."""
    def calls(text: Column, other: Column) -> Column:
        return J.let(J.parsed(text), lambda v: F.when(J.is_array(v), J.compact(text))
                     .when(J.has_key(v, "name"), F.concat(F.lit("["), J.compact(text), F.lit("]"))).otherwise(other))

    return F.when(content.isNull() | (content == ""), F.lit(EMPTY)).otherwise(J.let(X.py_strip(content), lambda c: calls(
        c, J.let(F.replace(c, F.lit("'"), F.lit('"')), lambda f: calls(f, F.lit(EMPTY))))))


def extracted_answers(text: Column) -> Column:
    """N5 as one expression."""
    def listed(t: Column) -> Column:
        first, last = F.instr(t, "["), F.length(t) - F.instr(F.reverse(t), "]") + 1
        g = F.when((first > 0) & (F.instr(t, "]") > 0) & (last > first), F.substring(t, first, last - first + 1))
        return J.let(g, lambda g: F.when(F.coalesce(J.let(J.parsed(g), lambda v: J.has_key(J.at(v, 0), "name")), F.lit(False)),
                                         J.compact(g)).otherwise(F.lit(EMPTY)))

    return F.when(text.isNull() | (text == ""), F.lit(EMPTY)).otherwise(J.let(
        X.tag_body(text, "tool_call", ignore_case=False),
        lambda body: F.when(body.isNotNull(), normalized_answers(X.strip_fence(X.py_strip(body)))).otherwise(listed(text))))


def with_extracted_answers(df: DataFrame, src: str, out: str) -> DataFrame:
    """Calls from free assistant text, as column ``out``.

    The first ``<tool_call>…</tool_call>`` (case-sensitive) decides, even
    when it yields ``[]``; otherwise the greedy first ``[`` to last ``]``
    counts only as a non-empty list whose first element is an object with
    ``name``."""
    df = df.withColumn(f"_{out}_is_call", F.lit(False))
    return with_turn_answers(df, f"_{out}_is_call", src, out).drop(f"_{out}_is_call")


def with_turn_answers(df: DataFrame, is_call: str, src: str, out: str) -> DataFrame:
    """Normalised calls of a turn: N4 on call turns, N5 on the others.

    One N4 pass serves both: its input is the content of a call turn, or
    the fence-stripped tag body of an assistant turn."""
    p = f"_{out}_"
    text, call = F.col(src), F.col(is_call)
    df = _stage(df, **{p + "body": F.when(~call, X.tag_body(text, "tool_call", ignore_case=False))})
    df = _stage(df, **{p + "b1": X.py_strip(p + "body")})
    df = _stage(df, **{p + "b2": X.strip_fence(p + "b1")})
    df = _stage(df, **{p + "src": F.when(call, text).otherwise(F.col(p + "b2"))})
    df = with_normalized_answers(df, p + "src", p + "norm")
    # The greedy ``\[.*\]`` search matches from the first ``[`` to the last
    # ``]`` when one follows it; found by position, linear in the text.
    plain = ~call & F.col(p + "body").isNull()
    df = _stage(df, **{
        p + "open": F.when(plain, F.instr(text, "[")),
        p + "close": F.length(text) - F.instr(F.reverse(text), "]") + 1,
        p + "any_close": F.instr(text, "]") > 0,
    })
    o, cl = F.col(p + "open"), F.col(p + "close")
    df = _stage(df, **{p + "g": F.when((o > 0) & F.col(p + "any_close") & (cl > o),
                                        F.substring(text, o, cl - o + 1))})
    df = J.with_json(df, p + "g", p + "gv")
    df = _stage(df, **{p + "first": J.at(p + "gv", 0), p + "garr": J.as_array(p + "gv")})
    greedy_ok = (F.size(F.col(p + "garr")) > 0) & J.has_key(p + "first", "name")
    result = (
        F.when(call, F.col(p + "norm"))
        .when(text.isNull() | (text == ""), F.lit(EMPTY))
        .when(F.col(p + "body").isNotNull(), F.col(p + "norm"))
        .when(F.coalesce(greedy_ok, F.lit(False)), J.compact(p + "g"))
        .otherwise(F.lit(EMPTY))
    )
    df = _stage(df, **{out: result})
    return df.drop(*[p + x for x in ("body", "b1", "b2", "src", "norm", "open", "close", "any_close",
                                      "g", "gv", "first", "garr")])


# Lower-cased refusal phrases; they do not change the result.
REFUSAL_PHRASES = ("i'm sorry", "i cannot", "i don't have", "no matching tool", "[abort")


def is_refusal_text(text: Column | str) -> Column:
    """N6 as a profiling flag."""
    low = F.lower(_c(text))
    cond = F.lit(False)
    for p in REFUSAL_PHRASES:
        cond = cond | low.contains(p)
    return F.coalesce(cond, F.lit(False))


def flatten_tools(tools_v: Column) -> Column:
    """ARRAY<VARIANT> of tool schemas; a nested ``function`` object
    replaces its wrapper, non-objects are dropped, a non-list gives []."""
    arr = F.coalesce(J.as_array(tools_v), F.array().cast("array<variant>"))
    return F.transform(
        F.filter(arr, lambda t: J.is_object(t)),
        lambda t: F.when(J.is_object(J.get(t, "function")), J.get(t, "function")).otherwise(t),
    )


def normalize_flat(df: DataFrame, id_col: str = "record_id", query: str = "query",
                   tools: str = "tools", answers: str = "answers",
                   keep: list[str] | None = None) -> DataFrame:
    """N8 (+N9): flat rows. ``tools`` JSON text is parsed and must be a list
    of objects (not flattened); ``answers`` NULL gives ``[]``, text is kept
    unchanged. Adds ``error`` (NULL when the row is a valid record)."""
    dtypes = dict(df.dtypes)
    t = F.col(tools) if dtypes[tools] == "string" else F.to_json(F.col(tools))
    a = F.col(answers) if dtypes[answers] == "string" else F.to_json(F.col(answers))
    keep = [c for c in (keep or []) if c not in (id_col, query, tools, answers)]
    base = df.select(F.col(id_col).alias("record_id"), F.col(query).alias("query"),
                     t.alias("_t"), a.alias("_a"), *keep)
    base = J.with_json(base, "_t", "_tv")
    base = _stage(base, _arr=J.as_array("_tv"), _objs=J.as_array_of_objects("_tv"))
    # every element an object: the typed cast succeeds and holds no NULL
    base = _stage(base, _all_obj=F.coalesce(F.size(F.array_compact("_objs")) == F.size("_objs"), F.lit(False)))
    arr = F.col("_arr")
    error = (
        F.when(F.col("_t").isNull(), F.lit("tools_missing"))
        .when(F.col("_tv").isNull(), F.lit("tools_not_json"))
        .when(F.col("query").isNull(), F.lit("query_not_string"))
        .when(arr.isNull(), F.lit("tools_not_list"))
        .when(~F.col("_all_obj"), F.lit("tool_not_object"))
    )
    return base.select(
        "record_id", "query",
        J.compact("_t").alias("tools"),
        F.coalesce(F.col("_a"), F.lit(EMPTY)).alias("answers"),
        *keep,
        error.alias("error"),
    )


def normalize_turns(turns: DataFrame, tools: DataFrame | None = None, id_col: str = "conv_id",
                    turn_col: str = "turn", role_col: str = "role", content_col: str = "content",
                    call_roles: tuple[str, ...] = CALL_ROLES, carry: list[str] | None = None) -> DataFrame:
    """N1 (long form): one record per conversation.

    ``tools``: optional ``(id_col, tools)`` frame with JSON text per
    conversation; flattened (N7). Without it every record has ``[]``.
    ``carry``: further columns to keep; of a column that differs between a
    conversation's turns, the last turn's value stays."""
    carry = [c for c in carry or [] if c not in (id_col, turn_col, role_col, content_col)]
    role = F.lower(F.col(role_col))
    kind = (
        F.when(role.isin(*QUERY_ROLES), F.lit("query"))
        .when(role.isin(*call_roles), F.lit("call"))
        .when(role.isin(*ASSISTANT_ROLES), F.lit("assistant"))
    )
    t = turns.select(
        F.col(id_col).alias("record_id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).isNull().alias("role_missing"),
        kind.alias("kind"),
        F.col(content_col).alias("content"),
        *carry,
    )
    t = t.withColumns({
        "_is_call": F.coalesce(F.col("kind") == "call", F.lit(False)),
        "_said": F.when(F.col("kind").isin("call", "assistant"), F.col("content")),
    })
    t = with_turn_answers(t, "_is_call", "_said", "norm")
    # Stage A, one row per range of RANGE_TURNS turns: the last user turn and
    # the few turns that can decide the answers (calls, texts holding some).
    decides = F.col("_is_call") | (F.col("kind").isin("assistant") & (F.col("norm") != EMPTY))
    ranges = t.groupBy("record_id", F.floor(F.col("turn") / RANGE_TURNS).alias("range")).agg(
        F.max(F.when(F.col("kind") == "query", F.struct("turn", "content"))).alias("user"),
        F.array_sort(F.collect_list(F.when(decides, F.struct("turn", "_is_call", "norm")))).alias("turns"),
        F.count_if(F.col("role_missing")).alias("missing"),
        *[F.max(F.struct("turn", c)).alias(c) for c in carry],
    )
    ranges = _first_answers(ranges, "turns", "turn", lambda x: x["_is_call"], lambda x: x["norm"] != EMPTY, "norm")
    # Stage B merges neighbouring ranges in order, RANGE_TURNS at a time, then
    # all that are left of a conversation. One exchange serves every level.
    rec = ranges.repartition("record_id")
    for level in range(LEVELS + 1):
        keys = [F.floor(F.col("range") / RANGE_TURNS).alias("range")] if level < LEVELS else []
        rec = rec.groupBy("record_id", *keys).agg(
            F.max("user").alias("user"),
            F.array_sort(F.collect_list(F.struct("range", "call", "first"))).alias("parts"),
            F.sum("missing").alias("missing"),
            *[F.max(c).alias(c) for c in carry],
        )
        rec = _first_answers(rec, "parts", "range", lambda x: x["call"].isNotNull(), lambda x: x["first"].isNotNull(), "first")
    query = F.when(F.col("user").isNull(), F.lit("")).otherwise(F.col("user.content"))
    out = rec.select(
        "record_id",
        query.alias("query"),
        F.coalesce("first", F.lit(EMPTY)).alias("answers"),
        F.when(F.col("missing") > 0, F.lit("role_missing"))
        .when(query.isNull(), F.lit("query_not_string")).alias("error"),
        *[F.col(c)[c].alias(c) for c in carry],
    )
    return _attach_tools(out, tools, id_col, carry)


def _first_answers(rows: DataFrame, parts: str, place: str, is_call, has_answers, answers: str) -> DataFrame:
    """Replaces the ordered list ``parts`` by ``call`` (the place of its last
    call) and ``first`` (the first answers from there on)."""
    call = F.array_max(F.transform(F.filter(parts, is_call), lambda x: x[place]))
    rows = rows.withColumn("call", call)
    since = F.filter(parts, lambda x: (F.col("call").isNull() | (x[place] >= F.col("call"))) & has_answers(x))
    return rows.withColumn("first", F.get(since, 0)[answers]).drop(parts)


def _attach_tools(records: DataFrame, tools: DataFrame | None, id_col: str, carry: list[str]) -> DataFrame:
    if tools is None:
        rec = records.withColumn("tools", F.lit(EMPTY))
    else:
        tt = J.with_json(tools.select(F.col(id_col).alias("record_id"), "tools"), "tools", "_tv")
        tt = tt.select(
            "record_id",
            F.to_json(flatten_tools(F.col("_tv"))).alias("_tools"),
            F.when(F.col("tools").isNotNull() & F.col("_tv").isNull(), F.lit("tools_not_json")).alias("_terr"),
        )
        rec = (
            records.join(tt, "record_id", "left")
            .withColumn("tools", F.coalesce(F.col("_tools"), F.lit(EMPTY)))
            .withColumn("error", F.coalesce(F.col("_terr"), F.col("error")))
            .drop("_tools", "_terr")
        )
    return rec.select("record_id", "query", "tools", "answers", "error", *carry)


MESSAGE_SCHEMA = "array<struct<role:string,from:string,content:string,value:string>>"


#: either name of a message's two fields
ROLE_FIELDS, TEXT_FIELDS = ("role", "from"), ("content", "value")


def _message_fields(dtype) -> set[str]:
    """Field names of an array of message structs."""
    element = getattr(dtype, "elementType", None)
    return set(element.fieldNames()) if hasattr(element, "fieldNames") else set()


def folded(messages: Column, fields: set[str], call_roles: tuple[str, ...] = CALL_ROLES) -> Column:
    """struct(query, answers) of an array of message structs that have
    any of the ``fields``. The messages are read in order: a user turn sets the
    query, a call turn sets the answers, an assistant turn sets them while
    they are empty."""
    def field(m: Column, names: tuple[str, ...]) -> Column:
        return F.coalesce(*[m[n] for n in names if n in fields], F.lit(""))

    def step(state: Column, m: Column) -> Column:
        role, text = F.lower(field(m, ROLE_FIELDS)), field(m, TEXT_FIELDS)
        answers = (F.when(role.isin(*call_roles), normalized_answers(text))
                   .when(role.isin(*ASSISTANT_ROLES) & (state["answers"] == EMPTY), extracted_answers(text))
                   .otherwise(state["answers"]))
        return F.struct(F.when(role.isin(*QUERY_ROLES), text).otherwise(state["query"]).alias("query"),
                        F.coalesce(answers, F.lit(EMPTY)).alias("answers"))

    start = F.struct(F.lit("").alias("query"), F.lit(EMPTY).alias("answers"))
    return F.aggregate(messages, start, step)


def normalize_conversations(df: DataFrame, id_col: str = "record_id", messages: str = "conversations",
                            fallback: str | None = "messages", tools: str | None = "tools",
                            call_roles: tuple[str, ...] = CALL_ROLES, keep: list[str] | None = None) -> DataFrame:
    """Nested form (one row per conversation, an array of messages).

    The messages are folded in the row (``folded``); nothing moves and the
    columns ``keep`` stay. Messages are structs with any of ``role``, ``from``,
    ``content`` and ``value``. A message list given as a string has every ``'``
    replaced by ``"`` and is parsed (N2); rows where that fails, or whose tools
    are not JSON, are quarantined."""
    cols, types = dict(df.dtypes), {f.name: f.dataType for f in df.schema}
    keep = [c for c in keep or [] if c not in (id_col, "record_id", "query", "tools", "answers", "error")]
    work = df

    def as_messages(name: str) -> tuple[Column, Column, Column]:
        """(state after the fold, number of messages, not readable)"""
        nonlocal work
        c = F.col(name)
        if cols[name] == "string":
            fixed, value, msgs = f"_{name}_fixed", f"_{name}_v", f"_{name}_m"
            work = work.withColumn(fixed, F.replace(c, F.lit("'"), F.lit('"')))
            work = J.with_json(work, fixed, value)
            work = work.withColumn(msgs, F.when(J.is_array(value), F.from_json(F.col(fixed), MESSAGE_SCHEMA)))
            found = F.col(msgs)
            return folded(found, set(ROLE_FIELDS + TEXT_FIELDS), call_roles), F.size(found), c.isNotNull() & found.isNull()
        return folded(c, _message_fields(types[name]), call_roles), F.size(c), F.lit(False)

    state, n, bad = as_messages(messages)
    if fallback and fallback in cols:
        other, _, other_bad = as_messages(fallback)
        use = F.coalesce(n, F.lit(0)) <= 0
        state, bad = F.when(use, other).otherwise(state), F.when(use, other_bad).otherwise(bad)
    has_tools = bool(tools and tools in cols)
    rec = work.withColumns({"_state": state, "_bad": bad})
    if has_tools:
        t = F.col(tools) if cols[tools] == "string" else F.to_json(F.col(tools))
        rec = J.with_json(rec.withColumn("_traw", t), "_traw", "_tv")
        rec = _stage(rec, _tools_text=F.to_json(flatten_tools(F.col("_tv"))),
                     _terr=F.col("_traw").isNotNull() & F.col("_tv").isNull())
    else:
        rec = _stage(rec, _tools_text=F.lit(EMPTY), _terr=F.lit(False))
    return rec.select(
        F.col(id_col).alias("record_id"),
        F.coalesce(F.col("_state.query"), F.lit("")).alias("query"),
        F.coalesce(F.col("_tools_text"), F.lit(EMPTY)).alias("tools"),
        F.coalesce(F.col("_state.answers"), F.lit(EMPTY)).alias("answers"),
        F.when(F.col("_bad"), F.lit("messages_not_json"))
        .when(F.col("_terr"), F.lit("tools_not_json")).alias("error"),
        *[F.col(f"`{c}`") for c in keep],
    )


def keep_filters_above(df: DataFrame) -> DataFrame:
    """Adds ``_pid`` (the partition id). A projection holding a
    non-deterministic column is a boundary predicate pushdown does not
    cross, so a filter on a derived column (``error``) is evaluated on
    that column instead of re-deriving it (JSON parse and all) inside the
    scan's filter."""
    return df.withColumn("_pid", F.spark_partition_id())


def split(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records and quarantined rows (with ``error`` reasons).
    To write both in one pass, write ``normalized`` partitioned by
    ``error IS NULL`` instead."""
    df = keep_filters_above(normalized)
    live = F.col("_pid") >= 0
    records = df.filter(F.col("error").isNull() & live).drop("error", "_pid")
    quarantine = df.filter(F.col("error").isNotNull() & live).drop("_pid")
    return records, quarantine


#: further input formats by name: (rows, id_col=..., **options) -> records with ``error``
FORMATS: dict[str, Callable[..., DataFrame]] = {}


def register_format(name: str, normalizer: Callable[..., DataFrame]) -> None:
    """add an input format; datasets whose name holds ``name`` use it."""
    FORMATS[name.lower()] = normalizer


def format_for(dataset_name: str) -> str:
    """The parser is chosen by the dataset's name."""
    low = dataset_name.lower()
    for name in FORMATS:
        if name in low:
            return name
    return "sharegpt" if "sharegpt" in low else "xlam"
