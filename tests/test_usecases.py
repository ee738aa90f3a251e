import pytest
from pyspark.sql import functions as F

from gridloom.usecases import Grid


@pytest.fixture
def grid(spark):
    return Grid(
        spark.createDataFrame([("S", "substation", None), ("B1", "bay", "S"), ("B2", "bay", "nowhere"), ("B3", "bay", None), ("K", "acline", "S"), ("L", "acline", None), ("D", "distribution-box", None), ("BD", "bay", "D"), ("B4", "bay", "K")], "id string, type string, parent_id string"),
        spark.createDataFrame([("f1", "B1"), ("f2", "B1"), ("k", "K"), ("l", "L"), ("t", "BD"), ("x", None)], "id string, container_id string"),
        spark.createDataFrame([(n, "real") for n in ("a", "b", "c", "d", "e", "q")] + [("GND", "virtual")], "id string, kind string"),
        spark.createDataFrame([("f1", "a", "b", "Fuse", False), ("f2", "c", "GND", "Fuse", True), ("k", "b", "d", "ACLineSegment", None), ("l", "b", "e", "ACLineSegment", None), ("t", "d", "e", "PowerTransformer", None), ("x", "e", "GND", "Load", None)], "equipment_id string, t1 string, t2 string, class string, is_open boolean"),
        spark.createDataFrame([("S", "container", 52.5, 13.4), ("f1", "equipment", 48.0, 11.0)], "owner_id string, owner_kind string, lat double, lon double"),
    )


def test_questions(grid, spark):
    s = grid.station_subgraph("S")
    assert {r.id for r in s["container"].collect()} == {"B1", "K", "B4"} and {r.equipment_id for r in s["edge"].collect()} == {"f1", "f2", "k"} and {r.id for r in s["node"].collect()} == {"a", "b", "c", "d", "GND"}
    assert all(v.count() == 0 for v in grid.station_subgraph("?").values())
    assert grid.electrically_connected("a", "b") and not grid.electrically_connected("a", "d")
    assert not grid.electrically_connected("a", "b", spark.createDataFrame([("f1", True)], "equipment_id string, is_open boolean"))
    assert [r.owner_id for r in grid.in_box(52.5, 13.4, 52.5, 13.4).collect()] == ["S"]
    assert {r.node for r in grid.reachable(spark.createDataFrame([("c",)], "node string"), False).collect()} == {"c", "GND"}
    n = {}
    for r in grid.what_if(spark.createDataFrame([("now", None, None), ("cut", "f1", True)], "scenario string, equipment_id string, is_open boolean")).collect():
        n[r.scenario] = n.get(r.scenario, 0) + 1
    assert n == {"now": 2, "cut": 3}


def test_more_than_a_thousand_scenarios(grid, spark):
    many = spark.range(1005).selectExpr("concat('s', id) AS scenario", "'f1' AS equipment_id", "true AS is_open")
    got = {r.scenario: r.n for r in grid.what_if(many).groupBy("scenario").agg(F.count("*").alias("n")).collect()}
    assert got == {f"s{i}": 3 for i in range(1005)}


def test_rules(grid):
    got = {(r.object_id, r.rule, r.message) for r in grid.violations().collect()}
    assert got == {
        ("B2", "container-path", "parent unknown"), ("B3", "container-path", "has no parent"), ("K", "container-path", "must be top level"), ("B4", "container-path", "parent must be a station"), ("D", "kvs-no-transformer", "distribution box holds a transformer"),
        ("B1", "bay-cable-count", "2 cables at one bay"), ("BD", "bay-cable-count", "2 cables at one bay"), ("q", "unreferenced-node", "no terminal uses it"), ("x", "equipment-without-container", "installed but in no container"), ("S", "station-connectivity", "separate part at c with 1 nodes"),
    }
