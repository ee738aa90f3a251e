import random

import pytest

from gridloom.operators import components as c
from gridloom.operators import topology as t


def truth(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        for x in (a, b):
            if x is not None:
                find(x)
        if a is not None and b is not None:
            p, q = sorted((find(a), find(b)))
            up[q] = p
    return {x: find(x) for x in up}


@pytest.mark.parametrize("one_task", [10**6, 0])
def test_components(spark, one_task):
    rnd = random.Random(4)
    edges = [(f"n{rnd.randint(0, 120)}", f"n{rnd.randint(0, 120)}") for _ in range(90)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)] + [("hub", f"s{i}") for i in range(60)] + [("x", None), ("y", "y"), (None, "z")] + [("x1", "x2")] * 3
    df = spark.createDataFrame([(s, *e) for s in ("p", "q", None) for e in edges] + [("q", "c000", "hub")], "scope string, a string, b string")
    got = {(r.scope, r.node): r.component for r in c.components(df, "a", "b", ["scope"], one_task).collect()}
    want = {(s, k): v for s in ("p", None) for k, v in truth(edges).items()} | {("q", k): v for k, v in truth([*edges, ("c000", "hub")]).items()}
    assert got == want


def test_no_edges(spark):
    none = spark.createDataFrame([], "a string, b string")
    assert c.components(none, "a", "b").count() == 0
    seeds = spark.createDataFrame([("s",), (None,)], "node string")
    assert [r.node for r in c.reachable(none, seeds, "a", "b").collect()] == ["s"]
    assert c.descendants(none, seeds, "a", "b").count() == 0


def test_roots_with_cycles_and_unknown_parents(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone"), ("e", ""), ("x", "y"), ("y", "x")], "id string, up string")
    assert {tuple(r) for r in c.roots(df, "id", "up").collect()} == {("a", "a", 0), ("b", "a", 1), ("c", "a", 2), ("d", "d", 0), ("e", "e", 0)}
    below = c.descendants(df, spark.createDataFrame([("a",), ("x",)], "node string"), "id", "up")
    assert {r.node for r in below.collect()} == {"b", "c", "x", "y"}


EDGE = "equipment_id string, t1 string, t2 string, class string, is_open boolean"
GRID = [("F1", "A", "B", "Fuse", False), ("F2", "B", "C", "Fuse", True), ("L1", "C", "D", "ACLineSegment", None), ("T1", "D", "E", "PowerTransformer", None), ("S1", "E", "GND", "Switch", False), ("P", "A", "B", "Breaker", True)]


def test_groups_and_circuits(spark):
    e = spark.createDataFrame(GRID, EDGE)
    assert {tuple(r) for r in t.electrical_groups(e).collect()} == {("A", "A"), ("B", "A"), ("C", "C"), ("D", "D"), ("E", "E"), ("GND", "E")}
    assert {tuple(r) for r in t.circuits(e).collect()} == {("A", "A"), ("B", "A"), ("C", "C"), ("D", "C"), ("E", "E")}
    assert {tuple(r) for r in t.circuit_summary(e).collect()} == {("A", 2, 3, 1), ("C", 2, 3, 2), ("E", 1, 2, 2)}
    closed = t.with_overrides(e, spark.createDataFrame([("F2", False), ("L1", True)], "equipment_id string, is_open boolean"))
    assert {r.circuit_id for r in t.circuits(closed).collect()} == {"A", "E"}
    assert {r.equipment_id for r in t.circuit_elements(e, "L1").collect()} == {"F2", "L1", "T1"}
    with pytest.raises(ValueError):
        t.circuit_elements(e, "none")
    with pytest.raises(ValueError):
        t.circuit_elements(spark.createDataFrame([("G", "GND", "GND", "Switch", False)], EDGE), "G")


def test_connection_over_a_shared_node(spark):
    groups = spark.createDataFrame([("a", "g1"), ("s", "g1"), ("s", "g2"), ("b", "g2"), ("c", "g3")], "node string, group_id string")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "?")], "a string, b string")
    assert {tuple(r) for r in t.electrically_connected(groups, pairs).collect()} == {("a", "b", True), ("a", "c", False), ("a", "?", False)}


def test_reach_through_ground(spark):
    e = spark.createDataFrame([("1", "a", "GND"), ("2", "b", "GND"), ("3", "b", "c")], "equipment_id string, t1 string, t2 string")
    seed = spark.createDataFrame([("a",)], "node string")
    assert {r.node for r in t.reachable_nodes(e, seed).collect()} == {"a", "GND", "b", "c"}
    assert {r.node for r in t.reachable_nodes(e, seed, through_ground=False).collect()} == {"a", "GND"}


def test_chains_end_at_splices(spark):
    s = spark.createDataFrame([("s1", "a", "b"), ("s2", "b", "c"), ("s3", "c", "d"), ("s4", "c", "e"), ("s5", "x", "x"), ("s6", "r", "q"), ("s7", "q", "r")], "equipment_id string, t1 string, t2 string")
    got = {r.equipment_id: r.chain_id for r in t.cable_chains(s).collect()}
    assert got == {"s1": "acline:s1:s2", "s2": "acline:s1:s2", "s3": "acline:s3:s3", "s4": "acline:s4:s4", "s5": "acline:s5:s5", "s6": "acline:s6:s7", "s7": "acline:s6:s7"}


def test_islands_of_a_station(spark):
    e = spark.createDataFrame([("1", "A", "B", "Fuse", False), ("2", "C", "D", "Fuse", False), ("3", "D", "GND", "Fuse", False), ("4", "Q", "R", "Fuse", False)], EDGE)
    owners = spark.createDataFrame([(i, "S1") for i in "123"] + [("4", "S2")], "equipment_id string, owner_id string")
    assert [tuple(r) for r in t.islands(e, owners).collect()] == [("S1", "C", 2)]


def test_circuits_and_groups_of_all_order_lines(spark, small):
    from gridloom.plans import fixtures as fx
    from gridloom.plans.graph import QUERIES

    edges = fx.edges(spark, small, whole=True).collect()
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    assert len(edges) == lines.select("l_orderkey", "l_partkey").distinct().count()

    def least(links):
        root = {n: n for e in edges for n in (e.t1, e.t2)}

        def find(n):
            while root[n] != n:
                n = root[n]
            return n

        for a, b in links:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {n: find(n) for n in root}

    closed = least([(e.t1, e.t2) for e in edges if e.is_open is False])
    assert {r.node: r.group_id for r in QUERIES["electrical_groups_whole"](spark, small).collect()} == closed
    of = least([(e.t1, e.t2) for e in edges if e["class"] != "PowerTransformer" and e.is_open is not True and e.t2 != "GND"])
    of.pop("GND")
    want = {c: [0, 0, 0] for c in of.values()}
    for c in of.values():
        want[c][0] += 1
    for e in edges:
        touched = {of[n] for n in (e.t1, e.t2) if n != "GND"}
        for c in touched:
            want[c][1] += 1
            want[c][2] += len(touched) > 1 or e.t2 == "GND"
    got = {r.circuit_id: [r.n_nodes, r.n_edges, r.n_boundary] for r in QUERIES["circuits_whole"](spark, small).collect()}
    assert got == want and max(n for n, _, _ in want.values()) > 100
