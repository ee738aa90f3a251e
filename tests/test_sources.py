import zipfile

import pytest
from helpers import bag
from pyspark.sql import functions as F

from gridloom.operators import terminals as tm
from gridloom.operators.register import page, search, search_all
from gridloom.sources import catalog, documents, rdfxml, registerzip, sinks
from gridloom.streaming import incremental

RDF = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:cim="http://iec.ch/TC57/CIM100#">
  <!-- note --><cim:Fuse rdf:ID="_f1"><cim:IdentifiedObject.name> A &amp; B </cim:IdentifiedObject.name><cim:Equipment.EquipmentContainer rdf:resource="#_s1"/>
    <cim:X.v>1</cim:X.v><cim:X.v>2</cim:X.v></cim:Fuse>
  <cim:Note>skipped</cim:Note><cim:Substation rdf:about="#_s1"><cim:IdentifiedObject.name>S</cim:IdentifiedObject.name></cim:Substation>
"""


def test_rdf_xml_and_a_broken_file(spark, tmp_path):
    (tmp_path / "a_EQ.xml").write_text(RDF + "</rdf:RDF>")
    (tmp_path / "b_SSH.xml").write_text(RDF + "<cim:Open>")
    (tmp_path / "c_TP.xml").write_text("")
    spark.dataSource.register(rdfxml.GridXmlSource)
    raw = spark.read.format("gridxml").option("version", 4).load(str(tmp_path))
    facts, errors = rdfxml.split(raw)
    rows = {(r["class"], r.id, r.attribute, r.value, r.is_reference, r.seq) for r in facts.filter("profile = 'EQ'").collect()}
    assert rows == {("Fuse", "f1", "IdentifiedObject.name", "A & B", False, 0), ("Fuse", "f1", "Equipment.EquipmentContainer", "s1", True, 0), ("Fuse", "f1", "X.v", "1", False, 0), ("Fuse", "f1", "X.v", "2", False, 1), ("Substation", "s1", "IdentifiedObject.name", "S", False, 0)}
    assert facts.filter("profile = 'SSH'").count() == 5 and {r.version for r in facts.select("version").distinct().collect()} == {4}
    found = {r.source_file.rsplit("/", 1)[-1]: r.line for r in errors.collect()}
    assert set(found) == {"b_SSH.xml", "c_TP.xml"} and found["b_SSH.xml"] > 0
    assert rdfxml.duplicate_ids(facts).count() == 0 and rdfxml.duplicate_ids(facts, by_profile=False).count() == 2


@pytest.mark.parametrize(("name", "profile"), [("x_EQ.xml", "EQ"), ("20240101_SSH_1.xml", "SSH"), ("x.xml", None), ("SEQ.xml", None)])
def test_profiles(name, profile):
    assert rdfxml.profile_of(name) == profile


def test_register_zip(spark, tmp_path):
    part = lambda rows: "<?xml version='1.0' encoding='UTF-16'?><T>" + "".join("<R>" + "".join(f"<{k}>{v}</{k}>" for k, v in r.items()) + "</R>" for r in rows) + "</T>"
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("Units_2.xml", part([{"Id": "2", "Ort": "Köln 😀"}]).encode("utf-16"))
        z.writestr("Units_10.xml", part([{"ID": "3", "Extra": "e"}]).encode("utf-16-be").join([b"\xfe\xff", b""]))
        z.writestr("Other.xml", part([{"a": "1"}])[:-6].encode("utf-16"))
        z.writestr("readme.txt", "x")
    spark.dataSource.register(registerzip.RegisterZipSource)
    rows = spark.read.format("registerzip").load(str(tmp_path / "d.zip")).cache()
    units = registerzip.table_of(rows, "Units")
    assert bag(units.select("chunk", F.col("ID").alias("i"), "Ort", "Extra")) == bag(spark.createDataFrame([(2, "2", "Köln 😀", None), (10, "3", None, "e")], "chunk int, i string, Ort string, Extra string"))
    assert rows.filter("dataset = 'Other' AND error IS NOT NULL").count() == 1


def test_document_paths(spark):
    rows = [("a", "r/ONS/x.hjson"), ("b", "r/ONS"), ("c", "r/Nix/y.hjson"), ("d", "interregional/ONS/z.hjson"), ("e", "interregional/Kabel/k.hjson"), ("f", "r/KVS/d.hjson"), ("g", "q/KVS/d.hjson"), ("h", None)]
    good, bad = documents.classify(spark.createDataFrame([(*r, "{}") for r in rows], "file_id string, path string, body string"))
    assert {r.file_id for r in good.collect()} == {"a", "e"} and bad.count() == 6


def test_documents_of_the_test_table(spark, small):
    from gridloom.session import table

    good, bad = documents.classify(table(spark, small, "model_file"))
    facts = documents.facts(good, 1)
    assert facts.count() > 100 and facts.filter("id IS NULL OR class IS NULL OR attribute IS NULL").count() == 0
    assert tm.model_edges(tm.classify(tm.terminal_table(facts), tm.class_of(facts))).count() > 10


def test_catalog_and_network_tables(spark, tmp_path):
    (tmp_path / "c1.json").write_text('[{"id": "k1", "attributes": {"catalog_kind": "cable", "r": 0.1, "curve": [1, 2]}}]')
    (tmp_path / "c2.json").write_text('[{"id": "k2", "attributes": {"catalog_kind": "fuse"}}]')
    entries = catalog.catalog(spark, str(tmp_path))
    assert {tuple(r) for r in catalog.catalog_kinds(entries).collect()} == {("cable", 1), ("fuse", 1)}
    (tmp_path / "c3.json").write_text('[{"id": "k2", "attributes": {}}]')
    with pytest.raises(ValueError):
        catalog.catalog(spark, str(tmp_path))
    buses = spark.createDataFrame([("b", "n", 0.4)], catalog.TABLES["buses"])
    catalog.write_network_table(buses, str(tmp_path), "buses")
    assert bag(catalog.network_table(spark, str(tmp_path), "buses")) == bag(buses)


def test_upserts_and_versions(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), (None, 1, "n")], "k string, at int, v string")
    new = spark.createDataFrame([("a", 2, "z"), ("b", 0, "late"), ("c", 1, None), (None, 1, "m")], "k string, at int, v string")
    assert {tuple(r) for r in sinks.last_per_key(old, new, ["k"], "at").collect()} == {("a", 2, "z"), ("b", 1, "y"), ("c", 1, None), (None, 1, "m")}
    facts = lambda v, i: spark.createDataFrame([(v, i, "EQ", "C", "a", "1", False, 0)], "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int")
    p = str(tmp_path / "facts")
    sinks.write_facts(facts(1, "a"), p)
    sinks.write_facts(facts(2, "b"), p)
    sinks.replace_partitions(facts(2, "c"), p, "version")
    assert {(r.version, r.id) for r in spark.read.parquet(p).collect()} == {(1, "a"), (2, "c")}


def test_streams(spark, tmp_path, small):
    src, out = tmp_path / "in", str(tmp_path / "out")
    facts = spark.createDataFrame([(1, "a", "EQ", "C", "x", "1", False, 0), (1, "a", "EQ", "C", "x", "1", False, 0), (2, "b", "EQ", "C", "x", "1", False, 0)], "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int")
    facts.write.parquet(str(src))
    stream = spark.readStream.schema(facts.schema).parquet(str(src))
    q = incremental.import_versions(stream, out, str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    events = spark.read.parquet(f"{small}/events.parquet")
    ev = tmp_path / "ev"
    events.write.parquet(str(ev))
    counts = incremental.event_counts(spark.readStream.schema(events.schema).parquet(str(ev)), "ts", "event_type")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("SELECT sum(n) AS n FROM counted").first().n == events.count()


def test_version_in_several_batches(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"
    for i in "abc":
        spark.createDataFrame([(1, i, "EQ", "C", "x", "1", False, 0)], schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    incremental.import_versions(stream, out, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted(r.id for r in got.collect()) == ["a", "b", "c"] and got.select("batch").distinct().count() > 1


def test_register_errors(spark):
    df = spark.createDataFrame([("a%b", 1), (None, 2), ("AXB", 3)], "t string, n int")
    assert [r.n for r in search(df, "A%B").collect()] == [1] and search(df, "axb").count() == 1
    for wrong in (lambda: search(df, ""), lambda: page(df, {"gone": 1}, "n", 5), lambda: search_all({}, "x")):
        with pytest.raises(ValueError):
            wrong()
    assert [r.n for r in page(df, {"t": None}, "n", 5).collect()] == [2]
    assert {r.table for r in search_all({"one": df, "two": df.filter("n = 2")}, "3").collect()} == {"one"}
