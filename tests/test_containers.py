"""Containers from facts."""

import random

from gridloom.operators import containers as ct
from gridloom.operators import staging as st

SCHEMA = "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"


def facts(spark, rows):
    """rows: (id, class, attribute, value[, version]); attributes with a class name in front refer."""
    ref = lambda a: a.split(".")[-1][0].isupper()
    out = [((r[4] if len(r) > 4 else 1), r[0], None, r[1], r[2], r[3], ref(r[2]), 0) for r in rows]
    return spark.createDataFrame(out, SCHEMA)


def terminal(id_, equipment, node, seq="1", version=1):
    return [(id_, "Terminal", "Terminal.ConductingEquipment", equipment, version), (id_, "Terminal", "Terminal.ConnectivityNode", node, version), (id_, "Terminal", "ACDCTerminal.sequenceNumber", seq, version)]


IN = "Equipment.EquipmentContainer"
ROWS = [
    ("S", "Substation", "IdentifiedObject.name", "Main"), ("K", "Substation", "PowerSystemResource.PSRType", "P"), ("P", "PSRType", "IdentifiedObject.name", "Distribution  Box"), ("H", "Building", "IdentifiedObject.name", "Home"),
    ("V", "VoltageLevel", "VoltageLevel.Substation", "S"), ("V", "VoltageLevel", "IdentifiedObject.name", "20 kV"), ("V2", "VoltageLevel", "VoltageLevel.Substation", "gone"), ("B", "Bay", "Bay.VoltageLevel", "V"), ("B2", "Bay", "Bay.VoltageLevel", "V2"),
    ("F", "Feeder", "Feeder.NormalEnergizingSubstation", "K"), ("F2", "Feeder", "Feeder.NormalEnergizingSubstation", "V"),
    ("bb1", "BusbarSection", IN, "V"), ("bb2", "BusbarSection", IN, "V"), ("bb3", "BusbarSection", IN, "K"), ("bb3#2", "BusbarSection", IN, "K"), ("bb4", "BusbarSection", IN, "nowhere"),
    ("in_bay", "Breaker", IN, "B"), ("in_feeder", "Breaker", IN, "F"), ("in_level", "Breaker", IN, "V"), ("in_station", "PowerTransformer", IN, "S"), ("in_house", "Meter", IN, "H"), ("astray", "Breaker", IN, "B2"), ("astray", "Breaker", "IdentifiedObject.name", "x"),
    ("gen", "ThermalGeneratingUnit", IN, "S"), ("pec", "PowerElectronicsConnection", "IdentifiedObject.name", "pec"), ("pv", "PhotoVoltaicUnit", "PowerElectronicsUnit.PowerElectronicsConnection", "pec"), ("pv", "PhotoVoltaicUnit", IN, "H"),
    ("bat", "BatteryUnit", "PowerElectronicsUnit.PowerElectronicsConnection", "pec"), ("bat", "BatteryUnit", IN, "unknown"),
    ("n1", "ConnectivityNode", "ConnectivityNode.ConnectivityNodeContainer", "F"), ("n2", "ConnectivityNode", "ConnectivityNode.ConnectivityNodeContainer", "lost"),
    ("by_node", "Breaker", IN, ""), *terminal("t1", "by_node", "n0"), *terminal("t2", "by_node", "n1", "2"),
    ("no_node", "Breaker", IN, ""), *terminal("t3", "no_node", "n2"), ("no_terminal", "Breaker", IN, ""),
    ("c1", "ACLineSegment", IN, "L"), ("L", "Line", "IdentifiedObject.name", "line"), *terminal("t4", "c1", "a"), *terminal("t5", "c1", "b", "2"), ("c2", "ACLineSegment", IN, ""), *terminal("t6", "c2", "b"), *terminal("t7", "c2", "c", "2"), ("c3", "ACLineSegment", IN, "gone"), *terminal("t8", "c3", "c", "5"),
    ("j1", "Junction", "IdentifiedObject.name", "j"), *terminal("t9", "j1", "b"), ("j2", "Junction", "IdentifiedObject.name", "j"), *terminal("t10", "j2", "zz"), ("j3", "Junction", IN, "S"),
]


def test_every_rule(spark):
    h = ct.resolve(facts(spark, ROWS + ROWS[:5]))
    assert {(r.id, r.type, r.parent_id, r.name) for r in h.container.collect()} == {
        ("S", "substation", None, "Main"), ("K", "distribution-box", None, "(unnamed)"), ("H", "house", None, "Home"), ("B", "bay", "S", "(unnamed)"), ("F", "bay", "K", "(unnamed)"), ("V", "busbar", "S", "20 kV"), ("busbar:bb3", "busbar", "K", "(unnamed)"),
        ("acline:c1:c2", "acline", None, "ACLine c1"),
    }
    members = [(r.equipment_id, r.container_id, r.rule) for r in h.member.collect()]
    assert len(members) == len({m[0] for m in members})
    assert set(members) == {
        ("bb1", "V", "busbar"), ("bb2", "V", "busbar"), ("bb3", "busbar:bb3", "busbar"), ("bb3#2", "busbar:bb3", "busbar"), ("in_bay", "B", "reference"), ("in_feeder", "F", "reference"), ("in_level", "S", "reference"), ("in_station", "S", "reference"),
        ("in_house", "H", "reference"), ("j3", "S", "reference"), ("pec", "H", "unit"), ("by_node", "F", "node"), ("c1", "acline:c1:c2", "chain"), ("c2", "acline:c1:c2", "chain"), ("j1", "acline:c1:c2", "node chain"),
    }
    assert {r.object_id for r in h.anomaly.collect()} == {"V2", "B2", "F2", "bb4", "astray", "no_node", "no_terminal", "c3", "j2"}
    assert h.anomaly.count() == 9


def test_versions_are_apart_and_nothing_is_nothing(spark):
    rows = [("S", "Substation", "IdentifiedObject.name", "a", 1), ("e", "Fuse", IN, "S", 1), ("e", "Fuse", IN, "S", 2), (None, "Fuse", IN, "S", 1), ("x", None, IN, "S", 1)]
    h = ct.resolve(facts(spark, rows))
    assert [(r.version, r.equipment_id) for r in h.member.collect()] == [(1, "e")] and [(r.version, r.object_id) for r in h.anomaly.collect()] == [(2, "e")]
    none = ct.resolve(facts(spark, []))
    assert none.container.count() == none.member.count() == none.anomaly.count() == 0


def test_line_references(spark):
    got = {(r.owner_id, r.key, r.value) for r in ct.line_references(facts(spark, ROWS)).collect()}
    assert got == {("c1", "cim:ACLineSegment.Line", "L"), ("c1", "cim:Line.IdentifiedObject.name", "line"), ("c3", "cim:ACLineSegment.Line", "gone")}


def test_a_station_with_very_many_things(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [("S", "Substation", "IdentifiedObject.name", "a")] + [(f"e{i}", "Fuse", IN, rnd.choice(["S", "S", "S", "X"])) for i in range(3000)]
    h = ct.resolve(facts(spark, rows))
    assert h.member.count() == sum(r[3] == "S" for r in rows) and h.member.count() + h.anomaly.count() == 3000


def test_build(spark):
    m = ct.build(facts(spark, [*ROWS, ("by_node", "Breaker", "Switch.open", "true")]), st.switch_states)
    assert {(r.equipment_id, r.t1, r.t2, r.is_open) for r in m["edge"].collect()} == {("by_node", "n0", "n1", True), ("no_node", "n2", "GND", None), ("c1", "a", "b", None), ("c2", "b", "c", None)}
    assert m["equipment"].count() == 15 and m["container"].count() == 8 and {"GND", "n0", "zz"} <= {r.id for r in m["node"].collect()}
