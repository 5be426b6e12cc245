"""Strict JSON parsing and JSON kind helpers."""

import pytest
from pyspark.sql import functions as F

from callframe.functions import json_ops as J

CASES = [
    ('{"a":1}', True), ("{'a':1}", False), ("[1] x", False), ("[1,]", False), ("[01]", False),
    ('{"a":1,"a":2}', True), ("NaN", False), ('{"a":NaN}', False), ("", False), ("  [1]  ", True),
    ("null", True), ('"s"', True), ("1,2", False), ("1] x,[2", False), ("[1]]", False), ("{}", True),
    ('[{"name":"f","arguments":{}}]', True), ("tru", False), ("1e2", True),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    df = J.with_json(df, "s", "v")
    df = df.withColumn("k", J.kind("v"))
    df = df.select("i", (F.col("v").isNotNull()).alias("ok"), "k",
                   J.truthy("v", "k").alias("truthy"), J.canon("v").alias("canon"))
    return {r["i"]: r for r in df.collect()}


def test_strict_json_matches_python_loads(parsed):
    for i, (text, expected) in enumerate(CASES):
        assert parsed[i]["ok"] == expected, text


def test_duplicate_keys_last_wins(parsed):
    i = [s for s, _ in CASES].index('{"a":1,"a":2}')
    assert parsed[i]["canon"] == '{"a":2}'


def test_kinds_and_truthiness(parsed):
    by_text = {s: parsed[i] for i, (s, _) in enumerate(CASES)}
    assert by_text["null"]["k"] == "null" and by_text["null"]["truthy"] is False
    assert by_text['"s"']["k"] == "string" and by_text['"s"']["truthy"] is True
    assert by_text["{}"]["k"] == "object" and by_text["{}"]["truthy"] is False
    assert by_text["1e2"]["k"] == "number" and by_text["1e2"]["truthy"] is True
    assert by_text['[{"name":"f","arguments":{}}]']["k"] == "array"


def test_py_str(spark):
    df = spark.createDataFrame([("5",), ('"x"',), ("true",), ("null",), ("1.5",)], "s string")
    df = J.with_json(df, "s", "v").withColumn("k", J.kind("v"))
    got = [r[0] for r in df.select(J.py_str("v", "k")).collect()]
    assert got[:4] == ["5", "x", "True", "None"]
    assert got[4].startswith("\u0000")
