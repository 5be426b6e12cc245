"""Refusal phrases are exposed as a profiling flag (no effect on answers)."""

from callframe.operators import normalize as N


def test_refusal_flag(spark):
    df = spark.createDataFrame([(1, "I'm sorry, I cannot help"), (2, "Sure: [ABORT: x]"), (3, "calling f"), (4, None)],
                               "i int, t string")
    got = {r["i"]: r["f"] for r in df.select("i", N.is_refusal_text("t").alias("f")).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False}
