"""Store and import runs."""

import pytest
from helpers import bag
from pyspark.sql import functions as F

from gridloom import runs
from gridloom.operators import terminals as tm
from gridloom.sources import store as st

HEAD = '<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:cim="http://iec.ch/TC57/CIM100#">'


def obj(class_, id_, **entries):
    inner = "".join(f'<cim:{k.rstrip("_").replace("__", ".")} rdf:resource="#{v}"/>' if k.endswith("_") else f"<cim:{k.replace('__', '.')}>{v}</cim:{k.replace('__', '.')}>" for k, v in entries.items())
    return f'<cim:{class_} rdf:ID="_{id_}">{inner}</cim:{class_}>'


def terminal(id_, equipment, node, seq):
    return obj("Terminal", id_, Terminal__ConductingEquipment_=equipment, Terminal__ConnectivityNode_=node, ACDCTerminal__sequenceNumber=seq)


@pytest.fixture
def store(spark, tmp_path):
    return st.Store(spark, str(tmp_path / "store"))


def test_cim_run_keeps_good_files(store, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a_EQ.xml").write_text(HEAD + obj("Substation", "S", IdentifiedObject__name="s") + obj("Fuse", "e", Equipment__EquipmentContainer_="S") + terminal("t", "e", "n", 1) + "</rdf:RDF>")
    (d / "b_EQ.xml").write_text(HEAD + obj("Substation", "T", IdentifiedObject__name="t") + "<cim:Open>")
    r = runs.run_cim(store, str(d))
    assert (r.version, r.n_facts, r.n_errors) == (1, 6, 1) and store.errors().first().line == 1
    runs.build_model(store, r.version)
    assert store.current() == 1 and store.model_tables() == ["anomaly", "container", "edge", "equipment", "node"]
    assert [(e.equipment_id, e.t1, e.t2) for e in store.model("edge").collect()] == [("e", "n", "GND")] and store.model("container").count() == 2
    assert runs.run_cim(store, str(d)).version == 2 and store.versions() == [1, 2]
    runs.build_model(store, 2)
    assert store.current() == 2
    store.delete_version(1)
    assert {x.version for x in store.facts().select("version").distinct().collect()} == {2} and store.reserve_version() == 3
    with pytest.raises(ValueError, match="current"):
        store.delete_version(2)


def test_nsc_run(store, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.xml").write_text(HEAD + obj("BusbarSection", "bb", Equipment__EquipmentContainer_="S", IdentifiedObject__name="bar") + terminal("b1", "bb", "n1", 0) + terminal("b2", "bb", "n2", 5) + terminal("b3", "bb", "n3", 0)
        + obj("Fuse", "f") + terminal("f1", "f", "n1", 0) + terminal("f2", "f", "n2", 1) + terminal("g1", "g", "n1", 0) + terminal("h1", "h", "n1", 1) + terminal("h2", "h", "n2", 2) + terminal("k1", "k", "x", 0) + terminal("k2", "k", "y", 2) + "</rdf:RDF>")
    r = runs.run_nsc(store, str(d))
    t = {(x.terminal_id, x.equipment_id, x.seq) for x in tm.terminal_table(store.facts()).collect()}
    assert t == {("b1", "bb", "1"), ("b2", "bb#2", "1"), ("b3", "bb#3", "1"), ("f1", "f", "1"), ("f2", "f", "2"), ("g1", "g", "1"), ("h1", "h", "1"), ("h2", "h", "2"), ("k1", "k", "0"), ("k2", "k", "2")}
    assert {(x.id, x.attribute, x.value) for x in store.facts().filter("class = 'BusbarSection'").collect()} == {(i, a, v) for i in ("bb", "bb#2", "bb#3") for a, v in (("Equipment.EquipmentContainer", "S"), ("IdentifiedObject.name", "bar"))}
    (d / "b.xml").write_text(HEAD + obj("Fuse", "f", IdentifiedObject__name="again") + "</rdf:RDF>")
    (d / "c.xml").write_text(HEAD + obj("Fuse", "f", IdentifiedObject__name="again") + "</rdf:RDF>")
    with pytest.raises(runs.DuplicateIds, match="f in"):
        runs.run_nsc(store, str(d))
    assert {x.version for x in store.facts().select("version").distinct().collect()} == {r.version}


def test_document_run(store, tmp_path):
    for path, text in {"r/ONS/S.hjson": "{equipments: [{id: 'e'\n class: Fuse\n connects: [n1\n n2\n]}]}", "r/ONS/T.hjson": "{", "r/Kabel/K.hjson": '{"segments": [{"id": "k", "from": "a", "to": "b"}]}'}.items():
        f = tmp_path / "tree" / path
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text)
    r = runs.run_documents(store, str(tmp_path / "tree"))
    assert r.n_errors == 1 and store.errors().first().source_file == "r/ONS/T.hjson"
    runs.build_model(store, r.version)
    assert {e.equipment_id for e in store.model("edge").collect()} >= {"k"}


def test_flags(store, spark):
    ids = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    store.mark(1, "done", ids)
    store.mark(1, "done", ids.filter("id = 'b'"))
    store.mark(2, "done", ids)
    ask = spark.createDataFrame([("b",), ("c",)], "id string")
    assert [r.id for r in store.unmarked(1, "done", ask).collect()] == ["c"] and store.unmarked(1, "other", ask).count() == 2
    assert [r.id for r in store.flag_page(1, "done", "a", 5).collect()] == ["b"] and store.flags(1, "done").count() == 2
    store.clear_flags(1)
    assert store.flags(1, "done").count() == 0 and store.flags(2, "done").count() == 2


def test_versions_of_two_runs_differ(store, spark):
    other = st.Store(spark, store.path)
    assert [store.reserve_version(), other.reserve_version(), store.reserve_version()] == [1, 2, 3]


def test_lookups_and_attached_folders(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, n int")
    assert bag(st.by_ids(df, "id", ["a", "zz", "a"])) == bag(df.filter("id = 'a'")) == bag(st.by_ids(df, "id", spark.createDataFrame([("a",), ("a",)], "x string"))) and st.by_ids(df, "id", []).count() == 0
    df.write.parquet(str(tmp_path / "src" / "things.parquet"))
    assert st.attach(spark, "src", str(tmp_path / "src")) == ["src_things"] and spark.sql("SELECT count(*) AS n FROM src_things").first().n == 3


def test_resolution_for_some_ids(spark):
    rows = []
    for t, e, n, s in (("t1", "e", "n1", "1"), ("t2", "e", "n2", "2"), ("t3", "x", "n1", "1"), ("t4", "j", "n2", "1"), ("t5", "j", "n1", "2"), ("t6", "j", "n1", "3")):
        rows += [(1, t, None, "Terminal", "Terminal.ConductingEquipment", e, True, 0), (1, t, None, "Terminal", "Terminal.ConnectivityNode", n, True, 0), (1, t, None, "Terminal", "ACDCTerminal.sequenceNumber", s, False, 0)]
    rows += [(1, i, None, c, "IdentifiedObject.name", "x", False, 0) for i, c in (("e", "Fuse"), ("x", "Fuse"), ("j", "Junction"), ("lone", "Fuse"))]
    f = spark.createDataFrame(rows, "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int")
    got = {(r.equipment_id, r.node1, r.node2, r.anomaly) for r in tm.resolve_for(f, spark.createDataFrame([(1, "e"), (1, "lone"), (1, "nowhere")], "version long, id string")).collect()}
    assert got == {("e", "n1", "n2", None), ("lone", None, None, "no terminal"), ("nowhere", None, None, "no terminal")}
    t = tm.terminal_table(f)
    assert [(r.equipment_id, r.no, r.node) for r in tm.role_nodes(t, tm.classify(t, tm.class_of(f))).orderBy("no").collect()] == [("j", 1, "n1"), ("j", 2, "n2")]
    assert tm.nsc_facts(f.limit(0)).count() == 0 and tm.nsc_facts(f.unionByName(f)).count() == f.count()
    assert tm.nsc_facts(f).filter(F.col("id") == "t4").count() == 3
