"""Plan shape: no Python in the native jobs, pruned scans, one exchange
per key where the design says so."""

from tests.conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_jobs_have_no_python(spark):
    import __spark_entry__ as E
    for name in ("parse_outputs", "normalize_flat", "normalize_conversations", "sft_corpus", "divergence",
                 "inventory_value", "adapter_check"):
        plan = _plan(E.queries()[name](spark, SF0001))
        assert "EvalPython" not in plan, name


def test_scan_is_pruned(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["divergence"](spark, SF0001))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan  # ts, event_type, props pruned


def test_scoring_has_no_python(spark):
    import __spark_entry__ as E
    for name in ("confusion", "score_trace", "score_odd"):
        plan = _plan(E.queries()[name](spark, SF0001))
        assert "Python" not in plan and "Arrow" not in plan, name


def test_conversation_fold_holds_no_conversation(spark):
    """Turns are scanned once and never joined; a conversation is folded per
    range of turns, then range by range, with one more exchange for all levels."""
    import __spark_entry__ as E
    plan = _plan(E.queries()["normalize_conversations"](spark, SF0001))
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_giant_conversation_is_split_by_range(spark):
    from callframe.operators import normalize as N
    from pyspark.sql import functions as F
    n = 5000
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 700, "function_call").when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") == 700, "oops").when(F.col("id") % 1500 == 1, F.concat(
            F.lit('<tool_call>[{"name":"f'), F.col("id").cast("string"), F.lit('"}]</tool_call>')))
        .otherwise(F.col("id").cast("string")).alias("content"))
    got = N.normalize_turns(turns).collect()
    assert _plan(N.normalize_turns(turns)).count("collect_list") >= N.LEVELS + 2
    # the unreadable call at 700 clears what came before; 1501 is the first text with calls after it
    assert len(got) == 1 and got[0]["query"] == str(n - 2) and got[0]["answers"] == '[{"name":"f1501"}]'


def test_levels_of_the_fold_agree(spark, monkeypatch):
    """Tiny ranges, so that every level merges: the result is the fold's."""
    from callframe.operators import normalize as N
    from tests.test_normalize import FOLD_CASES
    monkeypatch.setattr(N, "RANGE_TURNS", 2)
    data = [(cid, t, role, content) for cid, (turns, _) in enumerate(FOLD_CASES) for t, (role, content) in enumerate(turns)]
    data += [(100 + k, 10 * t, *FOLD_CASES[-2][0][t]) for k in range(2) for t in range(len(FOLD_CASES[-2][0]))]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, content string")
    got = {r.record_id: (r.query, r.answers) for r in N.normalize_turns(df).collect()}
    assert [got[cid] for cid in range(len(FOLD_CASES))] == [want for _, want in FOLD_CASES]
    assert got[100] == got[101] == FOLD_CASES[-2][1]


def test_tool_calls_are_parsed_once_per_branch(spark):
    """C2 reads the calls once; C7 twice (checks, and all other calls)."""
    import __spark_entry__ as E

    def scans(name):
        return _plan(E.queries()[name](spark, SF0001)).count("events.parquet") or _plan(
            E.queries()[name](spark, SF0001)).count("ReadSchema: struct<event_id:bigint,user_id:bigint")

    # transcripts also read the ids of all records for the questions
    assert scans("inventory_value") == 1 and scans("transcripts") <= 3


def test_scoring_parses_after_its_rows_are_dealt(spark, tmp_path):
    """Tables of one row group each: one task reads them, but parsing them is
    the work of all."""
    from callframe.operators import score as S
    spark.range(8, numPartitions=1).selectExpr(
        "id as record_id", "'q' as query", """'[{"name":"f"}]' as tools""", """'[{"name":"f","arguments":{}}]' as answers""",
        """'<tool_call>[{"name":"f","arguments":{}}]</tool_call>' as raw_response""").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.debug.maxToStringFields")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        scored = S.score(rows.select("record_id", "query", "tools", "answers"), rows.select("record_id", "raw_response"))
        plan = _plan(scored.select("outcome"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    sides = plan.split("Exchange hashpartitioning(record_id")
    # before the first and between the two: the join's and the sides' work; after an exchange, up to the file, no parsing
    assert len(sides) == 3 and "FileScan" in sides[1] and "FileScan" in sides[2]
    assert "parseJson" in sides[0] and "parseJson" not in sides[2] and "parseJson" not in sides[1][:sides[1].index("FileScan")]
    assert {r.outcome for r in scored.collect()} == {S.TP}


def test_records_are_built_by_all_tasks(spark):
    from callframe.sources.fixtures import fixture
    plan = _plan(fixture(spark, SF0001, "records"))
    assert plan.index("Project") < plan.index("Exchange hashpartitioning(xxhash64(event_id") < plan.index("FileScan")
