"""Terminals, merges, walks, chains and rules on unit facts."""

import pytest

from gridloom.operators import chains
from gridloom.operators import staging as st
from gridloom.operators import terminals as tm

FACT = "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"


def terminal(i, eq, node, seq):
    rows = [(1, i, "EQ", "Terminal", "Terminal.ConductingEquipment", eq, True, 0), (1, i, "EQ", "Terminal", "ACDCTerminal.sequenceNumber", seq, False, 0)]
    return rows + ([(1, i, "EQ", "Terminal", "Terminal.ConnectivityNode", node, True, 0)] if node else [])


def of_class(i, c, container=None):
    rows = [(1, i, "EQ", c, "IdentifiedObject.name", i, False, 0)]
    return rows + ([(1, i, "EQ", c, "Equipment.EquipmentContainer", container, True, 0)] if container else [])


def test_terminals_are_classified(spark):
    f = [*of_class("ok", "Fuse", "s"), *terminal("t1", "ok", "a", "1"), *terminal("t2", "ok", "b", "2"), *of_class("one", "Load", "s"), *terminal("t3", "one", "b", "1"), *of_class("dup", "Fuse"), *terminal("t4", "dup", "a", "1"), *terminal("t5", "dup", "b", "1"),
         *of_class("three", "Fuse"), *terminal("t6", "three", "a", "1"), *terminal("t7", "three", "a", "2"), *terminal("t8", "three", "a", "3"), *of_class("open", "Fuse"), *terminal("t9", "open", None, "1"), *of_class("bad", "Fuse"), *terminal("u1", "bad", "a", "2"),
         *of_class("bus", "BusbarSection", "s"), *terminal("u2", "bus", "z", "7"), *terminal("u3", "bus", "a", None)]
    facts = st.distinct_facts(spark.createDataFrame(f + f, FACT))
    t = tm.terminal_table(facts)
    w = {r.equipment_id: r for r in tm.classify(t, tm.class_of(facts)).collect()}
    assert (w["ok"].node1, w["ok"].node2, w["one"].node1, w["one"].node2, w["bus"].node1, w["bus"].n_nodes) == ("a", "b", "b", None, "a", 2)
    assert {k: r.anomaly for k, r in w.items() if r.anomaly} == {"dup": "sequence given twice", "three": "more than two terminals", "open": "terminal without node", "bad": "single terminal not numbered 1"}
    wiring = tm.classify(t, tm.class_of(facts))
    assert {tuple(r)[1:4] for r in tm.model_edges(wiring).collect()} == {("ok", "a", "b"), ("one", "b", "GND")}
    assert {(r.id, r.kind) for r in tm.model_nodes(t, wiring).collect()} == {("a", "real"), ("b", "real"), ("z", "real"), ("GND", "virtual")}


def test_dialect_fixes(spark):
    t = spark.createDataFrame([(1, "t1", "e", "a", "0"), (1, "t2", "e", "b", "1"), (1, "t3", "f", "a", "1"), (1, "t4", "g", "a", "0"), (1, "t5", "h", "a", "0"), (1, "t6", "h", "b", "2")], "version long, terminal_id string, equipment_id string, node string, seq string")
    assert {r.terminal_id: r.seq for r in tm.zero_based(t).collect()} == {"t1": "1", "t2": "2", "t3": "1", "t4": "1", "t5": "0", "t6": "2"}
    split = {r.terminal_id: (r.equipment_id, r.seq) for r in tm.split_busbars(t, spark.createDataFrame([(1, "h")], "version long, id string")).collect()}
    assert split["t5"] == ("h", "1") and split["t6"] == ("h#2", "1") and split["t1"] == ("e", "0")


def test_merges(spark):
    t = spark.createDataFrame([(1, "t1", "J", "c"), (1, "t2", "J", "b"), (1, "t3", "K", "c"), (1, "t4", "K", "a"), (1, "t5", "E", "q")], "version long, terminal_id string, equipment_id string, node string")
    classes = spark.createDataFrame([(1, "J", "Junction"), (1, "K", "Junction"), (1, "E", "Fuse")], "version long, id string, class string")
    assert {(r.node, r.merged) for r in tm.junction_merge(t, classes).collect()} == {("b", "a"), ("c", "a")}
    edges = spark.createDataFrame([(1, "e1", "n1", "x"), (1, "e2", "n2", "y"), (1, "e3", "m1", "m2")], "version long, equipment_id string, t1 string, t2 string")
    owners = spark.createDataFrame([(1, e, "S") for e in ("e1", "e2", "e3")], "version long, equipment_id string, owner_id string")
    sections = spark.createDataFrame([(1, "S", "B1", "n1"), (1, "S", "B1", "n2"), (1, "S", "B2", "m1"), (1, "S", "B2", "m2")], "version long, owner_id string, busbar_id string, node string")
    assert [(r.node, r.merged) for r in tm.busbar_merge(edges, sections, owners).collect()] == [("n2", "n1")]


def test_walk_keeps_units_apart_and_never_expands_a_hub(spark):
    f = [*of_class("P1", "PowerElectronicsConnection", "H"), *of_class("P2", "PowerElectronicsConnection", "H"), (1, "W", "EQ", "Wallbox", "Unit.Connection", "P1", True, 0), (1, "V", "EQ", "PhotoVoltaicUnit", "Unit.Connection", "P2", True, 0),
         (1, "C", "EQ", "Curve", "Curve.Unit", "W", True, 0), (1, "C", "EQ", "Curve", "Curve.y", "5", False, 0), (1, "C", "EQ", "Curve", "Curve.y", "6", False, 1)]
    hub = [(1, i, "EQ", c, "X.CoordinateSystem", "CRS", True, 0) for i, c in (("W", "Wallbox"), ("V", "PhotoVoltaicUnit"))] + [(1, f"o{i}", "EQ", "Other", "X.CoordinateSystem", "CRS", True, 0) for i in range(2000)] + of_class("CRS", "CoordinateSystem")
    facts = spark.createDataFrame(f + hub, FACT)
    owners = facts.filter("class = 'PowerElectronicsConnection'").select("version", "id").distinct()
    walk = st.attribute_walk(facts, owners, ("CoordinateSystem",))
    assert {(r.owner_id, r.id) for r in walk.collect()} == {("P1", "W"), ("P1", "C"), ("P2", "V")}
    rows = {(r.owner_id, r.key): (r.n_values, r.first) for r in st.satellite_rows(facts, walk).collect()}
    assert rows[("P1", "Curve.y")] == (2, "5")


def test_walk_goes_to_the_end_and_passes_contained_units(spark):
    chain = [(1, f"s{i}", "EQ", "Part", "Part.Of", f"s{i - 1}" if i else "P", True, 0) for i in range(9)]
    unit = [*of_class("W", "Wallbox", "H"), (1, "W", "EQ", "Wallbox", "PowerElectronicsUnit.PowerElectronicsConnection", "P", True, 0), (1, "C", "EQ", "Curve", "Curve.Unit", "W", True, 0)]
    other = [*of_class("E", "EnergyConsumer", "H"), (1, "E", "EQ", "EnergyConsumer", "X.Of", "P", True, 0)]
    facts = spark.createDataFrame([*of_class("P", "PowerElectronicsConnection", "H"), *chain, *unit, *other], FACT)
    walk = st.attribute_walk(facts, spark.createDataFrame([(1, "P")], "version long, id string"), ())
    assert {r.id for r in walk.collect()} == {f"s{i}" for i in range(9)} | {"W", "C"}


TERMINAL = "terminal_id string, equipment_id string, node_id string, sequence int"


def grid(spark, wiring, kinds):
    t = [(f"{e}-{i}", e, n, i) for e, ns in wiring.items() for i, n in enumerate(ns, 1)]
    return spark.createDataFrame(t, TERMINAL), spark.createDataFrame([(e, *k) for e, k in kinds.items()], "equipment_id string, class string, stop string")


BUS, CABLE, HOUSE = ("BusbarSection", "busbar"), ("ACLineSegment", None), ("Load", "house")


def test_chain_with_tap_and_dead_end(spark):
    t, k = grid(spark, {"B": ["n0"], "C1": ["n0", "n1"], "C2": ["n1", "n2"], "H": ["n2"], "C3": ["n1", "n3"]}, {"B": BUS, "C1": CABLE, "C2": CABLE, "C3": CABLE, "H": HOUSE})
    con, terms, segs = chains.collapse(t, k)
    assert {tuple(r)[1:] for r in con.collect()} == {("B-1", "H-1", "house"), ("B-1", "C3-2", "dead_end")}
    by = {}
    for r in sorted(terms.collect(), key=lambda r: r.sequence_number):
        by.setdefault(r.connection_id, []).append(r.terminal_id)
    assert by == {"B-1~H-1": ["B-1", "C1-2", "H-1"], "B-1~C3-2": ["B-1", "C1-2", "C3-2"]}
    assert {(r.connection_id, r.equipment_id, r.sequence_number) for r in segs.collect()} == {("B-1~H-1", "C1", 1), ("B-1~H-1", "C2", 2), ("B-1~C3-2", "C1", 1), ("B-1~C3-2", "C3", 2)}


def test_chain_between_busbars_once_and_rings_end(spark):
    t, k = grid(spark, {"B1": ["n0"], "S": ["n0", "n1"], "C": ["n1", "n2"], "B2": ["n2"], "R1": ["n0", "m1"], "R2": ["m1", "n0"]}, {"B1": BUS, "B2": BUS, "S": ("Switch", None), "C": CABLE, "R1": CABLE, "R2": CABLE})
    con, terms, segs = chains.collapse(t, k)
    assert [r.connection_id for r in con.collect() if r.target_kind == "busbar"] == ["B1-1~B2-1"]
    assert sorted((r.sequence_number, r.terminal_id) for r in terms.collect() if r.connection_id == "B1-1~B2-1") == [(1, "B1-1"), (2, "S-1"), (3, "B2-1")]


def test_no_busbars(spark):
    t, k = grid(spark, {"C": ["a", "b"]}, {"C": CABLE})
    assert [x.count() for x in chains.collapse(t, k)] == [0, 0, 0]


@pytest.mark.parametrize("size", [1, 2, 50])
def test_class_pages_cover_a_class(spark, size):
    facts = spark.createDataFrame([x for i in range(7) for x in of_class(f"e{i}", "Fuse")], FACT)
    seen, after = [], ""
    while got := sorted({r.id for r in st.class_page(facts, "Fuse", after, size).collect()}):
        seen += got
        after = got[-1]
    assert seen == [f"e{i}" for i in range(7)]
