"""Scalar functions, geodesic, class registry, register extract, rules with switches, upserts."""

import datetime as dt
import json
import xml.dom.minidom
from collections import Counter

import numpy as np
import pytest
from helpers import bag
from pyspark.sql import functions as F

from gridloom.functions import geodesic, scalar
from gridloom.operators import projection as pj
from gridloom.operators import register as rg
from gridloom.operators import staging as st
from gridloom.sources import classes, rdfxml, sinks
from gridloom.usecases import Grid, voltage_levels

FACTS = "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_scalar_functions(spark):
    name = F.lit("Gesamtdatenexport_20240131_23.2.zip")
    assert one(spark, scalar.dump_date(name), scalar.dump_version(name), scalar.dump_date(F.lit("Gesamtdatenexport_20241331_1.zip")), scalar.dump_version(F.lit("x_20240131_1.zip"))) == (dt.date(2024, 1, 31), "23.2", None, None)
    at = F.lit("2024-01-31T12:00:00Z")
    assert one(spark, scalar.rfc3339(scalar.from_rfc3339(at)), scalar.rfc3339(scalar.from_rfc3339(F.lit("2024-01-31T13:30:00+01:30"))), scalar.from_rfc3339(F.lit("2024-01-31"))) == ("2024-01-31T12:00:00Z", "2024-01-31T12:00:00Z", None)
    assert one(spark, *(scalar.truthy(F.lit(x)) for x in (" TRUE", "1", "yes", "no", None))) == (True, True, True, False, False)
    assert one(spark, *(scalar.number_or(F.lit(x), 7.0) for x in (" 1.5", "1.", "1d", "", None, "-2e3", "NaN"))) == (1.5, 1.0, 7.0, 7.0, 7.0, -2000.0, 7.0)


@pytest.mark.parametrize(("a", "b", "metres", "within"), [
    ((0, 0), (0, 1), 111319.4908, 1e-3), ((0, 0), (90, 0), 10001965.7293, 1e-3), ((-90, 10), (90, 50), 20003931.4586, 1e-3), ((52.5, 13.4), (52.5, 13.4), 0, 1e-6),
    ((-37.95103341666667, 144.42486788888888), (-37.65282113888889, 143.92649552777777), 54972.271, 2e-3), ((0, 179), (0, -179), 2 * 111319.4908, 2e-3), ((-30, 0), (29.9, 179.8), 19989832.8276, 1e-2), ((0, 0), (0.5, 179.5), 19936288.579, 1e-2),
    ((0, 0), (0.5, 179.7), 19944127.421, 1e-2), ((0, 0), (0, 180), 20003931.4586, 1e-2),
])
def test_geodesic(a, b, metres, within):
    """Values of Vincenty (1975), of GeographicLib's published examples, and quarter meridians."""
    assert abs(geodesic.distance_m(*map(np.array, (a[0], a[1], b[0], b[1])))[0] - metres) <= within
    assert abs(geodesic.distance_m(*map(np.array, (b[0], b[1], a[0], a[1])))[0] - metres) <= within


def test_geodesic_in_sql(spark):
    geodesic.register(spark)
    r = spark.sql("SELECT geodesic_m(0, 0, 0, 1) AS a, geodesic_m(0, 0, null, 1) AS b, geodesic_m(91, 0, 0, 1) AS c").first()
    assert abs(r.a - 111319.4908) < 1e-3 and r.b is None and r.c is None
    rng = np.random.default_rng(1)
    p = [rng.uniform(-90, 90, 500), rng.uniform(-180, 180, 500), rng.uniform(-90, 90, 500), rng.uniform(-180, 180, 500)]
    d = geodesic.distance_m(*p)
    sphere = 6371008.8 * 2 * np.arcsin(np.sqrt(np.sin(np.radians(p[2] - p[0]) / 2) ** 2 + np.cos(np.radians(p[0])) * np.cos(np.radians(p[2])) * np.sin(np.radians(p[3] - p[1]) / 2) ** 2))
    assert np.isfinite(d).all() and (np.abs(d - sphere) / sphere < 0.006).all()


def test_class_registry(spark, tmp_path):
    (tmp_path / "a.hjson").write_text("{\n classes: {\n Fuse: {\n group: switch\n terminals: two\n description: a fuse\n attributes: [{key: 'Fuse.x', type: 'double', required: true, description: 'size'}]\n }\n Line: {group: 'box'}\n }\n}")
    c = classes.load(spark, str(tmp_path))
    assert {r.name: r.group for r in c.collect()} == {"Fuse": "switch", "Line": "box"} and [(r.group, r.names) for r in classes.by_group(c).orderBy("group").collect()] == [("box", ["Line"]), ("switch", ["Fuse"])]
    text = {r.name: r.text for r in classes.templates(c).collect()}
    assert "TODO_NODE_2" in text["Fuse"] and "// Fuse.x (double, required): size" in text["Fuse"] and "attributes: {}" in text["Line"]
    (tmp_path / "b.hjson").write_text('{"classes": {"Fuse": {}}}')
    with pytest.raises(ValueError, match="Fuse"):
        classes.load(spark, str(tmp_path))


def test_regional_extract(spark, tmp_path):
    units = [("EinheitenWind", [("w1", "Leer", None, "L1", "a1"), ("w2", "Berlin", "N-1", "L2", "a2"), ("w3", "Berlin", "", "L3", "a3")]), ("EinheitenSolar", [("s1", "Leer", None, "L1", "a4"), ("s2", None, None, "L9", "a9")])]
    t = {n: spark.createDataFrame(r, "id string, Landkreis string, GebietNachDemFlaechenentwicklungsplanNordsee string, LokationMaStRNummer string, AnlagenbetreiberMastrNummer string") for n, r in units}
    for s in rg.register_stages(["Leer"]):
        if s.table not in t:
            t[s.table] = spark.createDataFrame([], "Landkreis string, EegMaStRNummer string, KwkMastrNummer string, MaStRNummer string")
    t["Lokationen"] = spark.createDataFrame([("L1",), ("L2",), ("L3",), ("L9",)], "MastrNummer string")
    t["Netzanschlusspunkte"] = spark.createDataFrame([("L1", "n1"), ("L3", "n3")], "LokationMaStRNummer string, NetzbetreiberMaStRNummer string")
    t["Marktakteure"] = spark.createDataFrame([(x,) for x in ("a1", "a2", "a3", "a4", "n1", "n3")], "MastrNummer string")
    t["MarktakteureUndRollen"] = spark.createDataFrame([("a1", "r"), ("a3", "r")], "MarktakteurMastrNummer string, rolle string")
    t["Katalogwerte"] = spark.createDataFrame([(1,), (2,)], "Id int")
    out = rg.extract(t, rg.register_stages(["Leer"]))
    ids = lambda n, c: sorted(r[c] for r in out[n].collect())
    assert ids("EinheitenWind", "id") == ["w1", "w2"] and ids("EinheitenSolar", "id") == ["s1"] and ids("Lokationen", "MastrNummer") == ["L1", "L2"]
    assert ids("Marktakteure", "MastrNummer") == ["a1", "a2", "a4", "n1"] and out["MarktakteureUndRollen"].count() == 1 and out["Katalogwerte"].count() == 2
    meta = rg.metadata(spark, "Gesamtdatenexport_20240131_23.2.zip", "2024-02-01T00:00:00Z")
    assert meta.first().source_date == "2024-01-31T00:00:00Z"
    for _ in range(2):
        rg.publish({k: out[k] for k in ("EinheitenWind", "Lokationen")}, str(tmp_path / "db"), meta)
    assert sorted(p.name for p in (tmp_path / "db").iterdir()) == ["EinheitenWind", "Lokationen", "meta"] and spark.read.parquet(str(tmp_path / "db" / "Lokationen")).count() == 2
    with pytest.raises(ValueError, match="name"):
        rg.metadata(spark, "x.zip", "2024-02-01T00:00:00Z")
    for bad in ("1a", "a-b", "", "ä", "a\n"):
        with pytest.raises(ValueError, match="identifier"):
            rg.columns_of(t, bad)
    with pytest.raises(ValueError, match="no table"):
        rg.columns_of(t, "nix")
    assert rg.columns_of(t, "Lokationen") == ["MastrNummer"]


def test_geocode(spark):
    a = spark.createDataFrame([(1, " Main  Street 1", "X"), (2, None, "X"), (3, "else", "X")], "n int, street string, city string")
    p = spark.createDataFrame([("main street 1", "x", 2.0, 5.0), ("main street 1", "x", 1.0, 9.0), (None, "x", 0.0, 0.0)], "street string, city string, lat double, lon double")
    assert {(r.n, r.lat, r.lon) for r in rg.geocode(a, p, ["street", "city"]).collect()} == {(1, 1.0, 9.0), (2, None, None), (3, None, None)}


def test_facts_are_those_of_a_dom_parser(spark, tmp_path):
    """The streaming reader beside a reader that holds the whole document."""
    text = (
        '<?xml version="1.0" encoding="UTF-8"?><r:RDF xmlns:r="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:c="http://x#"><c:Fuse r:ID="_a"><c:I.name> A &amp; <![CDATA[<B>]]> </c:I.name><c:E.c r:resource="#_s"/><c:X.v>1</c:X.v><c:X.v>1</c:X.v><c:X.e/></c:Fuse>'
        '<c:Fuse><c:I.name>no id</c:I.name></c:Fuse><c:Line r:about="http://y#_b"><c:I.name>ö<!-- note --> 2</c:I.name></c:Line></r:RDF>'
    )
    (tmp_path / "m_EQ.xml").write_text(text)
    rdf = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
    want = []
    for o in xml.dom.minidom.parseString(text.encode()).documentElement.childNodes:
        id_ = o.getAttributeNS(rdf, "ID") or o.getAttributeNS(rdf, "about")
        for a in o.childNodes if id_ else ():
            ref = a.getAttributeNS(rdf, "resource")
            value = ref.rsplit("#", 1)[-1].removeprefix("_") if ref else "".join(n.data for n in a.childNodes if n.nodeType in (n.TEXT_NODE, n.CDATA_SECTION_NODE)).strip()
            want.append((id_.rsplit("#", 1)[-1].removeprefix("_"), o.localName, a.localName, value, bool(ref)))
    spark.dataSource.register(rdfxml.GridXmlSource)
    facts, errors = rdfxml.split(spark.read.format("gridxml").option("version", 1).load(str(tmp_path)))
    assert Counter((r.id, r["class"], r.attribute, r.value, r.is_reference) for r in facts.collect()) == Counter(want) and errors.count() == 0


def test_rules_with_switches(spark):
    c = spark.createDataFrame([("S", "substation", None), ("B", "bay", "S"), ("K1", "acline", None), ("K2", "acline", None)], "id string, type string, parent_id string")
    e = spark.createDataFrame([("f", "B"), ("k1", "K1"), ("k2", "K2"), ("far", "S")], "id string, container_id string")
    n = spark.createDataFrame([(x, "real") for x in "abcdxy"], "id string, kind string")
    g = spark.createDataFrame([("f", "a", "b", "Fuse", False), ("k1", "b", "c", "ACLineSegment", None), ("k2", "b", "d", "ACLineSegment", None), ("far", "x", "y", "Fuse", False)], "equipment_id string, t1 string, t2 string, class string, is_open boolean")
    grid = Grid(c, e, n, g, None)
    found = lambda **k: {(r.object_id, r.rule) for r in grid.violations(**k).collect()}
    assert ("B", "bay-cable-count") in found() and ("B", "bay-cable-count") not in found(nsc=True)
    assert ("x", "connectivity") in found(connectivity=True) and ("x", "connectivity") not in found()
    assert {o for o, _ in found(flagged=spark.createDataFrame([("B",)], "id string"))} == {"B"}


def test_voltage_levels(spark):
    r = lambda i, c, a, v: (1, i, None, c, a, v, True, 0)
    base, box = "ConductingEquipment.BaseVoltage", "Equipment.EquipmentContainer"
    rows = [
        r("one", "Fuse", base, "20"), r("two", "Fuse", base, "20"), r("two", "Fuse", base, "110"), r("box", "Fuse", box, "B"), r("none", "Fuse", box, "S"), r("lvl", "Fuse", box, "V"), r("B", "Bay", "Bay.VoltageLevel", "V"), r("V", "VoltageLevel", "VoltageLevel.BaseVoltage", "20"),
        r("t", "PowerTransformer", box, "S"), r("e1", "PowerTransformerEnd", "PowerTransformerEnd.PowerTransformer", "t"), r("e1", "PowerTransformerEnd", "TransformerEnd.BaseVoltage", "20"), r("t0", "PowerTransformer", box, "B"),
    ]
    f = spark.createDataFrame(rows, FACTS)
    e = spark.createDataFrame([(1, x, "c") for x in ("one", "two", "box", "none", "lvl", "t", "t0", "dangling")], "version long, id string, container_id string")
    assert {(x.object_id, x.message) for x in voltage_levels(f, e).collect()} == {("two", "2 voltage levels, at most 1"), ("none", "no voltage level"), ("t0", "no voltage level")}


def test_attribute_upsert(spark):
    old = spark.createDataFrame([("o", "a", 0, '"x"'), ("o", "a", 1, '"y"'), ("o", "b", 0, "1")], "owner_id string, key string, seq int, value string")
    new = spark.createDataFrame([("o", "a", 'say "z"', 5), ("p", "a", "q", 2), ("o", "a", None, 3)], "owner_id string, key string, value string, n int")
    got = {(r.owner_id, r.key, r.seq): r.value for r in sinks.upsert_attributes(old, new, "n").collect()}
    assert got == {("o", "b", 0): "1", ("o", "a", 0): "null", ("o", "a", 1): json.dumps('say "z"'), ("p", "a", 0): '"q"'}


def test_groups_and_marks_of_facts(spark):
    rows = [(1, "a", "EQ", "Fuse", "k", str(i), False, 9 - i) for i in range(10)] + [(1, "b", None, "PhotoVoltaicUnit", st.UNIT_OF, "x", True, 0), (1, "b", None, "PhotoVoltaicUnit", "Equipment.EquipmentContainer", "y", True, 0), (1, "c", None, "X", None, None, None, None)]
    f = spark.createDataFrame(rows, FACTS)
    got = st.fact_groups(f, 3).select("id", "seq", F.spark_partition_id().alias("p")).collect()
    assert [r.seq for r in got if r.id == "a"] == list(range(10)) and len({r.p for r in got if r.id == "a"}) == 1 and len(got) == len(rows)
    assert {(r.id, r.is_unit, r.has_container) for r in st.object_marks(f).collect()} == {("a", False, False), ("b", True, True), ("c", False, False)}


def test_bridged_circuits(spark):
    nodes = spark.createDataFrame([("n1", "c1"), ("n2", "c2"), ("n3", "c3"), ("n4", "c4")], "node string, circuit_id string")
    bridges = spark.createDataFrame([("g", "n4"), ("g", "n2"), ("h", "n2"), ("h", "n3"), ("h", "lost"), ("i", "n1")], "group_id string, node string")
    assert bag(pj.bridged_circuits(nodes, bridges)) == bag(spark.createDataFrame([("n1", "c1"), ("n2", "c2"), ("n3", "c2"), ("n4", "c2")], "node string, circuit_id string"))


def test_collapsed_views(spark):
    from gridloom.operators import chains

    c = spark.createDataFrame([("bb", "busbar", "S"), ("bay", "bay", "S"), ("H", "house", None), ("K", "acline", None)], "id string, type string, parent_id string")
    e = spark.createDataFrame([("sec", "bb"), ("sw", "bay"), ("k", "K"), ("m", "H")], "id string, container_id string")
    g = spark.createDataFrame([("sw", "n1", "n2"), ("k", "n2", "n3"), ("m", "n3", "GND")], "equipment_id string, t1 string, t2 string")
    a = [(o, "cim_class", 0, f'"{x}"') for o, x in (("sec", "BusbarSection"), ("sw", "Switch"), ("k", "ACLineSegment"), ("m", "Meter"))] + [("sec", "busbar_node_id", 0, '"n1"'), ("k", "Conductor.length", 0, '"12.5"')]
    m = pj.Model(c, e, g, spark.createDataFrame([], "owner_id string, owner_kind string, lat double, lon double"), spark.createDataFrame(a, "owner_id string, key string, seq int, value string"))
    v = pj.collapsed_views(m, chains.collapse(*pj.collapse_inputs(m)))
    ext = lambda x: spark.range(1).select(scalar.ext_id(F.lit(x))).first()[0]
    one_ = v["connection"].collect()
    assert [(r.source_id, r.source_device_type, r.target_id, r.target_device_type) for r in one_] == [(ext("sec#T1"), "BUSBAR", ext("m#T1"), "HOUSE_CONNECTION")]
    line = v["line_segment"].collect()
    assert [(r.external_id, r.connection_id, r.length) for r in line] == [("k", one_[0].id, 12.5)]
    assert {r.connection_id for r in v["connection_terminal_map"].collect()} == {one_[0].id} and {"sec#T1", "m#T1"} <= {r.external_id for r in v["terminal"].collect()}
