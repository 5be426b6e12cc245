"""Tool execution goldens from the notebook's worked inputs."""

import pytest

from callframe.operators import toolexec as C
from tests.conftest import SF0001, rows

# The notebook's three items.
ITEMS = [("ITEM-001", "Apple", 1.13, 4, 1), ("ITEM-002", "Bottled Water", 1.04, 20, 2),
         ("ITEM-003", "Instant Ramen", 10.13, 4, 3)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_code string, name string, cost double, quantity int, item_order long")


def test_vector_sum_goldens(spark):
    pairs = spark.createDataFrame([(1, [1.0, -1.0, 2.0], [3.0, 0.0, -4.0]), (2, [1.0, 2.0], [3.0, 4.0]),
                                   (3, [1.0], [1.0, 2.0])], "vec_id int, a array<double>, b array<double>")
    got = {r["vec_id"]: r for r in rows(C.vector_sum(pairs))}
    assert got[1]["vsum"] == [4.0, -1.0, -2.0]
    assert got[2]["vsum"] == [4.0, 6.0]
    assert got[3]["vsum"] is None and got[3]["error"] == "Vectors must be of the same length"
    dots = {r["vec_id"]: r["dot"] for r in rows(C.dot_product(pairs))}
    assert dots[2] == 11.0


def test_inventory_all_items_and_by_name(spark, items):
    calls = spark.createDataFrame([
        (1, '[{"name":"inventory_check","arguments":{"item_codes":null,"conversion_rate":1}}]'),
        (2, '[{"name":"inventory_check","arguments":{"item_codes":[],"conversion_rate":1}}]'),
        (3, '[{"name":"fetch_item_by_name","arguments":{"item_name":"Bottled Water"}},'
            '{"name":"inventory_check","arguments":{"item_codes":null,"conversion_rate":1}}]'),
        (4, '[{"name":"inventory_check","arguments":{"item_codes":["ITEM-002","ITEM-002"],"conversion_rate":1}}]'),
        (5, '[{"name":"fetch_item_by_name","arguments":{"item_name":"Nothing"}},'
            '{"name":"inventory_check","arguments":{"item_codes":null,"conversion_rate":1}}]'),
    ], "call_id long, calls string")
    ex = C.explode_calls(calls)
    values = {(r["call_id"], r["pos"]): r["value"] for r in rows(C.inventory_value(ex, items))}
    assert values[(1, 0)] == 65.84 and values[(2, 0)] == 65.84
    assert values[(4, 0)] == 20.80
    chained = {r["call_id"]: r for r in rows(C.chained_calls(calls, items))}
    assert chained[3]["value"] == 20.80 and chained[3]["item_code"] == "ITEM-002"
    assert chained[5]["status"] == "not_found" and chained[5]["value"] is None
    found = {r["call_id"]: r["item_code"] for r in rows(C.item_by_name(ex, items))}
    assert found == {3: "ITEM-002", 5: None}


def test_inventory_total_fixture(spark):
    import __spark_entry__ as E
    got = rows(E.queries()["inventory_total"](spark, SF0001))[0]
    assert got["total_value"] == 4162792.60


def test_first_blue_bolt(spark):
    import __spark_entry__ as E
    codes = {r["item_code"] for r in rows(E.queries()["item_by_name"](spark, SF0001)) if r["item_name"] == "blue bolt"}
    assert codes == {"ITEM-0000074"}
