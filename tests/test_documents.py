"""Documents: their text form, facts of both dialects, export and the way back."""

import json

import pytest
from helpers import bag
from pyspark.sql import functions as F

from gridloom.operators import housing
from gridloom.operators import terminals as tm
from gridloom.sources import docexport, documents
from gridloom.sources import doctext as dt


@pytest.mark.parametrize(("text", "value"), [
    ('{"a": 1}', {"a": 1}), ("{\n  # note\n  a: 1 // x\n  b: free text, with # all\n  'c d': \"q\"\n  e: [1, 2\n 3]\n}", {"a": 1, "b": "free text, with # all", "c d": "q", "e": [1, 2, 3]}),
    ("a: true\nb: null\nc: -1.5e3\nd: 5 kV\n", {"a": True, "b": None, "c": -1500.0, "d": "5 kV"}), ("{ geometry: { lat: 1.5, lon: 2 } }", {"geometry": {"lat": 1.5, "lon": 2}}),
    ("{\n  t:\n  '''\n  one\n    two\n  '''\n}", {"t": "one\n  two"}), ("/* x */ []", []), ("", {}), ('{a: ["x" # -> ../Kabel/k.hjson\n "y"]}', {"a": ["x", "y"]}), ("{a: {b: [{c: 1}, {}]}, d: 'it\\'s'}", {"a": {"b": [{"c": 1}, {}]}, "d": "it's"}),
])
def test_text_form(text, value):
    assert dt.read(text) == value


@pytest.mark.parametrize("text", ["{a: 1", "{a 1}", '{a: "x}', "[1, 2", "{a: }", "{a: 1}}", "{'''x: 1}", "{:1}"])
def test_text_that_cannot_be_read(text):
    with pytest.raises(ValueError):
        dt.read(text)


def test_deep_text():
    assert dt.read("{a: " * 5000 + "1" + "}" * 5000)["a"] is not None


@pytest.mark.parametrize(("x", "text"), [(0.0, "0"), (5.0, "5"), (0.1, "0.1"), (-2.5, "-2.5"), (100000.0, "100000"), (1e6, "1e+06"), (1234567.5, "1.2345675e+06"), (1e-4, "0.0001"), (1.5e-5, "1.5e-05"), (1e100, "1e+100")])
def test_numbers(x, text):
    assert dt.number(x) == text and float(text) == x


def test_keys():
    assert [documents.full_key(k, c) for k, c in (("name", "SvSwitch"), ("open", "Fuse"), ("open", "SvSwitch"), ("r", "ACLineSegment"), ("X.y", "Z"), ("normallyInService", "Fuse"))] == ["IdentifiedObject.name", "Switch.open", "SvSwitch.open", "ACLineSegment.r", "X.y", "Equipment.normallyInService"]
    assert docexport.short_keys(["A.x", "B.x", "C.y", "IdentifiedObject.name", "cim:q.z", "D.name", "bare", "E.a.b", "Z.q"], "C") == {"Z.q": "Z.q", "A.x": "A.x", "B.x": "B.x", "C.y": "y", "IdentifiedObject.name": "name", "cim:q.z": "cim:q.z", "D.name": "D.name", "bare": "bare", "E.a.b": "E.a.b"}


def files(spark, rows):
    return spark.createDataFrame([(p, p, b if b is None or isinstance(b, str) else json.dumps(b)) for p, b in rows], "file_id string, path string, body string")


def found(facts, id_):
    return {(r.attribute, r.value, r.is_reference, r.seq) for r in facts.filter(F.col("id") == id_).collect()}


def test_station_of_dialect_2(spark):
    body = {
        "attributes": {"region": "north", "name": "Main"}, "geometry": {"lat": 52.5, "lon": 13.4},
        "busbars": [{"id": "@BB", "attributes": {"name": "bar"}, "sections": [{"id": "1", "attributes": {"ipMax": 5}}, {"id": 2, "attributes": {"name": "own"}, "satellites": [{"class": "X", "attributes": {"k": [1, 2]}}]}]}],
        "bays": [{"id": "@F1", "attributes": {"name": "feeder"}, "equipments": [
            {"id": "@m", "class": "Meter", "connects": ["@BB"], "attributes": {"name": "M"}, "measuring": {"disabled": False}, "transmission": {"name": "T"}, "satellites": [{"class": "Y"}]},
            {"id": "@s", "class": "Fuse", "connects": ["@BB", "GND"], "steps": [0.5, 1], "attributes": {"open": True, "x": None}},
            {"id": "@bad", "connects": ["a"]}, {"id": "@three", "class": "Fuse", "connects": ["a", "b", "c"]},
            {"id": "@load", "class": "EnergyConsumer", "connects": "@BB", "attributes": {"p": 5, "q": "5"}},
        ]}],
        "equipments": [{"id": "free", "class": "Breaker", "connects": []}],
        "segments": [{"id": "@c", "from": "@BB", "to": "n9", "geometry": [{"lat": 1, "lon": 2}, {"lat": 3}, {"lat": 4, "lon": 5}], "attributes": {"length": 7}}],
    }
    facts, errors = documents.facts_and_errors(files(spark, [("r/ONS/S.hjson", body), ("r/Kabel/K.hjson", "{segments: [{id: 'x'}]"), ("r/Nix/q.hjson", "{}"), ("r/Grenzknoten/Boundary.hjson", {"equipments": [{"id": "inj", "class": "EquivalentInjection", "connects": ["n9"]}]})]), 4)
    assert {("region", "north", False, 0), ("name", "Main", False, 0), ("IdentifiedObject.name", "S", False, 0), ("PowerSystemResource.Location", "S-LOC", True, 0)} == found(facts, "S")
    assert found(facts, "S-LOC-PP1") == {("PositionPoint.Location", "S-LOC", True, 0), ("PositionPoint.sequenceNumber", "1", False, 0), ("PositionPoint.xPosition", "13.4", False, 0), ("PositionPoint.yPosition", "52.5", False, 0)}
    assert found(facts, "S-BB-VL") == {("VoltageLevel.Substation", "S", True, 0), ("IdentifiedObject.name", "@BB", False, 0)}
    assert found(facts, "S-BB-1") == {("Equipment.EquipmentContainer", "S-BB-VL", True, 0), ("IdentifiedObject.name", "bar", False, 0), ("BusbarSection.ipMax", "5", False, 0)}
    assert ("IdentifiedObject.name", "own", False, 0) in found(facts, "S-BB-2") and found(facts, "S-BB-2-SAT0") == {("Satellite.Of", "S-BB-2", True, 0), ("X.k", "1", False, 0), ("X.k", "2", False, 1)}
    assert found(facts, "S-F1") == {("Feeder.NormalEnergizingSubstation", "S", True, 0), ("IdentifiedObject.name", "feeder", False, 0)}
    assert [found(facts, f"S-m-SAT{i}") for i in range(3)] == [
        {("Satellite.Of", "S-m", True, 0)}, {("Satellite.Of", "S-m", True, 0), ("TimeSchedule.disabled", "false", False, 0), ("IdentifiedObject.name", "M", False, 0)}, {("Satellite.Of", "S-m", True, 0), ("IdentifiedObject.name", "T", False, 0)},
    ]
    assert found(facts, "S-s") == {("Equipment.EquipmentContainer", "S-F1", True, 0), ("Switch.open", "true", False, 0)}
    assert found(facts, "S-s-SAT1") == {("Satellite.Of", "S-s", True, 0), ("IdentifiedObject.name", "S-s-2", False, 0), ("DiscreteControlLimit.sequenceNumber", "2", False, 0), ("DiscreteControlLimit.value", "1", False, 0)}
    assert {("EnergyConsumer.p", "0.005", False, 0), ("EnergyConsumer.q", "5", False, 0)} <= found(facts, "S-load")
    assert found(facts, "free") == {("Equipment.EquipmentContainer", "S", True, 0)} and found(facts, "inj-T1") and not found(facts, "inj")
    assert ("Conductor.length", "7", False, 0) in found(facts, "S-c") and found(facts, "S-c-LOC-PP2") and not found(facts, "S-c-LOC-PP3")
    assert sorted((r.source_file, r.message) for r in errors.collect()) == [
        ("r/Kabel/K.hjson", "text ends too early in line 1"), ("r/Nix/q.hjson", "unknown kind Nix"), ("r/ONS/S.hjson", "S-three: connects must name 1 or 2 nodes, not 3"), ("r/ONS/S.hjson", "equipment @bad: no class"),
    ]


def test_names_of_dialect_1(spark):
    rows = [
        ("r/ONS/S.hjson", {"busbars": [{"id": "bb", "sections": [{"id": "s1"}]}], "bays": [{"id": "f", "equipment": [{"id": "e", "class": "Fuse", "connects": ["s1", "S-2-x"], "attributes": {"open": "true"}}]}], "equipments": [{"id": "no", "class": "Fuse"}]}),
        ("r/ONS/S-2.hjson", {"equipment": []}), ("r/Kabel/K.hjson", {"segments": [{"id": "k", "from": "S-s1", "to": "GND"}]}), ("r/Haushalte/H.hjson", {"equipment": [{"id": "m", "class": "Meter"}]}),
    ]
    good, _ = documents.classify(files(spark, rows))
    facts, errors = documents.split_facts(good, 1, dialect=1)
    assert {("Terminal.ConnectivityNode", "S-s1", True, 0)} <= found(facts, "S-e-T1") and {("Terminal.ConnectivityNode", "S-2-x", True, 0)} <= found(facts, "S-e-T2")
    assert ("open", "true", False, 0) in found(facts, "S-e") and ("Equipment.EquipmentContainer", "S-f", True, 0) in found(facts, "S-e")
    assert ("Terminal.ConnectivityNode", "S-s1", True, 0) in found(facts, "S-s1-T1") and ("Equipment.EquipmentContainer", "S-bb", True, 0) in found(facts, "S-s1")
    assert ("Terminal.ConnectivityNode", "GND", True, 0) in found(facts, "K-k-T2") and not found(facts, "S-no")
    assert [r.message for r in errors.collect()] == ["H-m: connects must name 1 or 2 nodes, not 0"]


def model(spark):
    container = spark.createDataFrame([("S1", "substation", None), ("S1-F1", "bay", "S1"), ("S1-B", "busbar", "S1"), ("acline:a:b", "acline", None), ("acline:in", "acline", None), ("H1", "house", None)], "id string, type string, parent_id string")
    equipment = spark.createDataFrame([
        ("S1-e1", "S1", "PowerTransformer"), ("S1-e2", "S1-F1", "Fuse"), ("S1-sec", "S1-B", "BusbarSection"), ("S1-sec2", "S1-B", "BusbarSection"), ("S1-sec3", "S1-B", "BusbarSection"), ("c1", "acline:a:b", "ACLineSegment"), ("S1-ci", "acline:in", "ACLineSegment"), ("H1-m", "H1", "Meter"), ("b1", None, "Inj"), ("b2", None, "Inj"),
    ], "id string, container_id string, class string")
    edges = spark.createDataFrame([("S1-e1", "n0", "S1-n1"), ("S1-e2", "S1-n1", "n2"), ("c1", "n2", "n3"), ("S1-ci", "S1-n1", "n0"), ("H1-m", "n3", "GND"), ("b1", "n8", "n9"), ("b2", "n9", "GND")], "equipment_id string, t1 string, t2 string")
    attributes = spark.createDataFrame([
        ("S1-e2", "Switch.normalOpen", "false"), ("S1-e2", "Fuse.r", "1"), ("S1-e2", "Fuse.r", "2"), ("S1-e2", "Equipment.normallyInService", "true"), ("c1", "IdentifiedObject.name", 'say "x"'), ("c1", "Conductor.length", "12.50"), ("S1-sec", "busbar_node", "S1-n1"),
        ("S1-sec", "IdentifiedObject.name", "bar"), ("S1-sec2", "IdentifiedObject.name", "bar"), ("S1-sec3", "IdentifiedObject.name", "bar"), ("S1", "region", "north"), ("b2", "region", "south"), ("H1-m", "IdentifiedObject.name", "meter"), ("H1-m", "EnergyConsumer.p", "0.005"),
    ], "owner_id string, key string, value string")
    satellites = spark.createDataFrame([
        ("H1-m", 0, "UsagePoint", {"UsagePoint.ratedPower": "5"}), ("H1-m", 1, "TimeSchedule", {"IdentifiedObject.name": "meter", "TimeSchedule.disabled": "false"}), ("H1-m", 2, "TimeSchedule", {"TimeSchedule.recurrencePeriod": "900"}),
        ("c1", 0, "PositionPoint", {"PositionPoint.sequenceNumber": "2", "PositionPoint.xPosition": "13.5", "PositionPoint.yPosition": "52.5"}), ("c1", 1, "PositionPoint", {"PositionPoint.sequenceNumber": "1", "PositionPoint.xPosition": "13.4", "PositionPoint.yPosition": "52.4"}),
        ("c1", 2, "PositionPoint", {"PositionPoint.sequenceNumber": "3"}), ("c1", 3, "Location", {"x": "y"}),
        ("S1-e2", 0, "DiscreteControlLimit", {"DiscreteControlLimit.sequenceNumber": "2", "DiscreteControlLimit.value": "1"}), ("S1-e2", 1, "DiscreteControlLimit", {"DiscreteControlLimit.sequenceNumber": "1", "DiscreteControlLimit.value": "0.5"}),
    ], "owner_id string, seq int, class string, attributes map<string,string>")
    return container, equipment, edges, attributes, satellites, spark.createDataFrame([("S1", 52.5, 13.4)], "owner_id string, lat double, lon double")


def test_roots_and_internal_cables(spark):
    container, equipment, edges, *_ = model(spark)
    tops = housing.root_containers(container)
    assert {(r.container_id, r.root) for r in tops.collect()} >= {("S1-F1", "S1"), ("S1-B", "S1"), ("acline:in", "acline:in"), ("H1", "H1")}
    assert [(r.root, r.station) for r in housing.internal_cables(equipment, edges, tops).collect()] == [("acline:in", "S1")]
    odd = spark.createDataFrame([("a", "bay", "b"), ("b", "bay", "a"), ("c", "bay", "nowhere"), ("d", None, None)], "id string, type string, parent_id string")
    assert housing.root_containers(odd).count() == 0


def test_export_of_dialect_2_and_the_way_back(spark, tmp_path):
    docs = docexport.export(*model(spark)).cache()
    text = {r.path: r.body for r in docs.collect()}
    assert set(text) == {"north/ONS/S1.hjson", "default/Kabel/a_b.hjson", "default/Haushalte/H1.hjson", "default/Grenzknoten/Boundary.hjson", "south/Grenzknoten/Boundary.hjson"}
    station, cable, house = text["north/ONS/S1.hjson"], text["default/Kabel/a_b.hjson"], text["default/Haushalte/H1.hjson"]
    assert "normallyInService: " not in station.split("\n", 2)[2] and "steps: [0.5, 1]" in station and "geometry: { lat: 52.5, lon: 13.4 }" in station and "r: [\"1\", \"2\"]" in station
    assert '"n2" # -> ../../default/Kabel/a_b.hjson' in station and 'id: "@ci"' in station and station.count('name: "bar"') == 1
    assert 'from: "n2" # -> ../../north/ONS/S1.hjson' in cable and "length: 12.5 # m" in cable and cable.index("lat: 52.4") < cable.index("lat: 52.5") and "Location" not in cable
    assert "measuring: {}" in house and "recurrencePeriod: 900 # s" in house and "p: 5 # kW" in house and "UsagePoint" in house
    docexport.write_tree(docs, str(tmp_path / "tree"))
    again = docexport.read_tree(spark, str(tmp_path / "tree"))
    assert bag(again.select("path", "body")) == bag(docs.select("path", "body"))
    # A region's boundary document names no container, so several of one name are no duplicates of a container.
    good, bad = documents.classify(again.filter("path NOT LIKE 'south%'"))
    facts, errors = documents.split_facts(good, 3)
    assert bad.count() == 0 and errors.count() == 0
    back = tm.model_edges(tm.classify(tm.terminal_table(facts), tm.class_of(facts)))
    want = model(spark)[2].filter("equipment_id <> 'b2'")
    assert bag(back.select("equipment_id", "t1", "t2")) == bag(want)
    assert {("Switch.normalOpen", "false", False, 0), ("Fuse.r", "1", False, 0), ("Fuse.r", "2", False, 1), ("Equipment.EquipmentContainer", "S1-F1", True, 0)} == found(facts, "S1-e2")
    assert ("EnergyConsumer.p", "0.005", False, 0) in found(facts, "H1-m") and ("IdentifiedObject.name", "meter", False, 0) in found(facts, "H1-m-SAT1")
    assert found(facts, "S1-n1-1") >= {("IdentifiedObject.name", "bar", False, 0), ("Equipment.EquipmentContainer", "S1-n1-VL", True, 0)}


def test_export_of_dialect_1_and_the_way_back(spark):
    docs = docexport.export(*model(spark), dialect=1).withColumn("file_id", F.col("path"))
    text = {r.path: r.body for r in docs.collect()}
    assert set(text) == {"north/ONS/S1.hjson", "default/Kabel/a_b.hjson", "default/Kabel/in.hjson", "default/Haushalte/H1.hjson"}
    assert "equipment: [" in text["north/ONS/S1.hjson"] and "Switch.normalOpen: false" in text["north/ONS/S1.hjson"] and "PositionPoint" in text["default/Kabel/a_b.hjson"]
    good, _ = documents.classify(docs)
    facts, errors = documents.split_facts(good, 1, dialect=1)
    assert errors.count() == 0 and ("Equipment.EquipmentContainer", "S1-B", True, 0) in found(facts, "S1-sec")


def test_boundary_documents_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(docexport, "BOUNDARY_ITEMS", 10)
    container = spark.createDataFrame([], "id string, type string, parent_id string")
    equipment = spark.createDataFrame([(f"b{i}", None, "Inj") for i in range(25)], "id string, container_id string, class string")
    edges = spark.createDataFrame([(f"b{i}", f"n{i}", None) for i in range(25)], "equipment_id string, t1 string, t2 string")
    none = spark.createDataFrame([], "owner_id string, key string, value string")
    sats = spark.createDataFrame([], "owner_id string, seq int, class string, attributes map<string,string>")
    docs = docexport.export(container, equipment, edges, none, sats).collect()
    assert sorted(r.path for r in docs) == [f"default/Grenzknoten/Boundary{x}.hjson" for x in ("-2", "-3", "")] and sum(r.body.count("class:") for r in docs) == 25
