"""Profiles, checks, divergence, selection, derived jobs."""

from callframe.operators import quality as V
from tests.conftest import SF0001, rows


def test_divergence_fixture(spark):
    import __spark_entry__ as E
    got = rows(E.queries()["divergence"](spark, SF0001))
    assert len(got) == 12 and sum(r["n_bad_steps"] for r in got) == 20


def test_item_rules_fixture(spark):
    import __spark_entry__ as E
    got = {r["rule"]: r["violations"] for r in rows(E.queries()["item_rules"](spark, SF0001))}
    assert got == {"item_code_length": 4, "name_length": 4, "cost_positive": 4, "quantity_non_negative": 4}


def test_adapter_summary_and_gate(spark):
    import __spark_entry__ as E
    summary = E.queries()["adapter_summary"](spark, SF0001)
    assert V.gate(summary) is False
    empty = spark.createDataFrame([], "status string, has_null_tools boolean, answers_parse_error boolean")
    assert rows(V.adapter_summary(empty))[0]["all_passed"] is True


def test_profile_types_from_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    got = {r["column_name"]: r for r in rows(V.dataset_profile(df))}
    assert got["a"]["data_type"] == "bigint" and got["b"]["null_count"] == 1 and got["a"]["total_rows"] == 2


def test_limits_and_overlap(spark):
    df = spark.createDataFrame([(i, f"q{i % 3}") for i in range(10)], "record_id long, query string")
    assert sorted(r["record_id"] for r in rows(V.first_rows(df, 3))) == [0, 1, 2]
    assert V.first_rows(df, 0).count() == 10
    assert sorted(r["record_id"] for r in rows(V.last_rows(df, 2))) == [8, 9]
    big = spark.range(5000).selectExpr("pmod(id * 7919, 5000) AS record_id", "id")
    for n in (1, 777, 4999, 5000, 6000):
        assert sorted(r["record_id"] for r in rows(V.first_rows(big, n))) == list(range(min(n, 5000)))
        assert sorted(r["record_id"] for r in rows(V.last_rows(big, n))) == list(range(max(0, 5000 - n), 5000))
    ties = spark.createDataFrame([(i // 4, i) for i in range(40)], "record_id long, id long")
    assert sorted(r["record_id"] for r in rows(V.last_rows(ties, 6))) == [8, 8, 9, 9, 9, 9]
    ov = V.overlap(V.first_rows(df, 3), V.last_rows(df, 2))
    assert sorted(r["record_id"] for r in rows(ov)) == [8, 9]


def test_tool_catalogue_flattens(spark):
    df = spark.createDataFrame([('[{"name":"a"},{"type":"function","function":{"name":"b"}}]',),
                                ('[{"name":"a","description":"other"}]',)], "tools string")
    got = {r["name"]: r for r in rows(V.tool_catalogue(df))}
    assert got["a"]["uses"] == 2 and got["a"]["n_schemas"] == 2 and got["b"]["uses"] == 1


def test_adapter_check_sample(spark):
    import __spark_entry__ as E
    from callframe.operators import normalize as N
    from callframe.sources.fixtures import fixture
    rows_ = fixture(spark, SF0001, "flat_rows")
    checked = V.adapter_check(N.normalize_flat(rows_, id_col="row_id"), sample=5)
    assert sorted(r["record_id"] for r in rows(checked)) == [0, 1, 2, 3, 4]
    assert E.queries()["adapter_check"](spark, SF0001).count() == 1000


def _pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(line for line in plan.splitlines() if "PushedFilters" in line)


def test_limits_on_strings_timestamps_and_nulls(spark, tmp_path):
    import datetime
    from pyspark.sql import functions as F
    n = 3000
    data = spark.range(n).selectExpr(
        "id", "concat('k', lpad(cast(pmod(id * 7919, 3000) as string), 5, '0')) AS name",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(pmod(id * 17, 3000) as int)) AS ts",
        "CASE WHEN id % 10 = 0 THEN NULL ELSE id END AS maybe").repartition(5)
    data.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    for k in (1, 700, 2999):
        assert sorted(r.name for r in V.first_rows(df, k, "name").collect()) == [f"k{i:05d}" for i in range(k)]
        assert sorted(r.name for r in V.last_rows(df, k, "name").collect()) == [f"k{i:05d}" for i in range(n - k, n)]
    start = datetime.datetime(2024, 1, 1)
    assert sorted(r.ts for r in V.first_rows(df, 500, "ts").collect()) == [start + datetime.timedelta(minutes=i) for i in range(500)]
    # nulls are the lowest
    first = [r.maybe for r in V.first_rows(df, 400, "maybe").collect()]
    assert first.count(None) == 300 and sorted(x for x in first if x) == [i for i in range(n) if i % 10][:100]
    assert sorted(r.maybe for r in V.last_rows(df, 5, "maybe").collect()) == [2995, 2996, 2997, 2998, 2999]
    assert V.first_rows(df.limit(0), 5, "name").count() == 0
    # the raw column is compared, so the scan can skip by it
    assert "LessThan(name" in _pushed(V.first_rows(df, 2000, "name"))
    assert V.first_rows(df.select(F.lit("same").alias("name"), "id"), 7, "name").count() == 7


def test_overlap_compares_texts_not_only_digests(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "query string")
    rows_ = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "b"), (5, "a")], "id long, query string")
    found = V.overlap(train, rows_)
    assert sorted(r.id for r in found.collect()) == [1, 4, 5] and found.columns[0] == "query"


def test_overlap_moves_digests_first(spark):
    plan = V.overlap(spark.range(9).selectExpr("cast(id as string) AS query"), spark.range(5).selectExpr("id", "cast(id as string) AS query"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_digest" in text


def test_conflicting_tool_schemas_name_their_keys(spark):
    df = spark.createDataFrame([('[{"name":"a","parameters":{"type":"object","required":["x"]}},{"name":"b","x":1}]',),
                                ('[{"name":"a","parameters":{"type":"object","required":["y"]},"description":"d"}]',),
                                ('[{"type":"function","function":{"name":"b","x":1}},{"name":null}]',)], "tools string")
    got = {(r.name, r.key): (r.n_schemas, r.n_values) for r in V.tool_conflicts(df).collect()}
    assert got == {("a", "parameters"): (2, 2), ("a", "parameters.required"): (2, 2), ("a", "description"): (2, 2)}


def test_broken_items_name_their_rules(spark):
    items = spark.createDataFrame([("ABC", "nn", 1.0, 0), ("A", None, 0.0, 5), ("ABC", "nn", 1.0, -1)],
                                  "item_code string, name string, cost double, quantity int")
    assert sorted(r.broken_rules for r in V.item_quarantine(items).collect()) == [
        "item_code_length,name_length,cost_positive", "quantity_non_negative"]


CONFORMING = ["[\n]", "[\n1]", "[\n 1 ,\n[2,3]]", '[\n{"a":"x,y]"},\n"\\"],"]', '[\n{"a":{"b":[1,{"c":2,"d":3}]}},\n\n\nnull]']
OTHERS = ["[]", "[1]", "[\n1, 2]", "[\n1,\n2,3]", "[\n1]\n", "[\n1\r]", '{"a":1}', "[\n1,\n]", '[\n"\x7f"]', "[\n{]}]", None, ""]


def test_array_grammar(spark):
    from callframe.operators import outputs as O
    df = spark.createDataFrame([(t,) for t in CONFORMING + OTHERS], "raw_response string")
    got = [r.is_conformant for r in O.conformance(df).collect()]
    assert got == [True] * len(CONFORMING) + [False] * len(OTHERS)
