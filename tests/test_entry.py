"""Driver contract: entry runs, every query has a runnable oracle, and the
Spark results agree with DuckDB on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from callframe.sources.tables import TABLES
from tests.conftest import SF0001


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["total_samples", "true_positives", "false_positives", "true_negatives",
                          "false_negatives", "invalid", "no_output"]


def test_every_query_has_oracle():
    from callframe.plans.catalog import QUERIES
    rows_only = {"sft_corpus_indent2"}
    assert set(QUERIES) - rows_only <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rs), key=repr)


FAST = ["parse_outputs", "confusion", "error_distribution", "normalize_conversations", "normalize_flat",
        "sft_corpus", "adapter_check", "divergence", "inventory_value", "chained_calls", "vector_sum",
        "transcripts", "tool_catalogue", "dataset_profile"]


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, s_rows) == _canon(d_cols, res.fetchall())
