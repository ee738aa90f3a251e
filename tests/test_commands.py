"""Commands, from files to documents."""

import zipfile

from gridloom.__main__ import main

HEAD = '<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:cim="http://iec.ch/TC57/CIM100#">'


def test_import_build_check_and_export(spark, tmp_path, capsys):
    text = HEAD
    for i, c, rest in (("S", "Substation", ""), ("F", "Feeder", '<cim:Feeder.NormalEnergizingSubstation rdf:resource="#S"/>'), ("e", "Fuse", '<cim:Equipment.EquipmentContainer rdf:resource="#F"/><cim:Switch.normalOpen>false</cim:Switch.normalOpen>')):
        text += f'<cim:{c} rdf:ID="{i}"><cim:IdentifiedObject.name>{i}</cim:IdentifiedObject.name>{rest}</cim:{c}>'
    for n in (1, 2):
        text += f'<cim:Terminal rdf:ID="t{n}"><cim:Terminal.ConductingEquipment rdf:resource="#e"/><cim:Terminal.ConnectivityNode rdf:resource="#n{n}"/><cim:ACDCTerminal.sequenceNumber>{n}</cim:ACDCTerminal.sequenceNumber></cim:Terminal>'
    (tmp_path / "m_EQ.xml").write_text(text + "</rdf:RDF>")
    store = str(tmp_path / "store")
    run = lambda *a: (main([str(x) for x in a], spark), capsys.readouterr().out)[1]
    assert "version=1" in run("import", store, "cim", tmp_path / "m_EQ.xml")
    assert "anomalies of version 1: 0 rows" in run("build", store)
    assert run("connected", store, "n1", "n2").strip() == "True"
    assert "circuits: 1 rows" in run("circuits", store) and "violations: 0 rows" in run("check", store, "--connectivity") and "Fuse" in run("report", store)
    assert "1 documents" in run("export", store, tmp_path / "out")
    assert "class: \"Fuse\"" in (tmp_path / "out" / "default" / "ONS" / "S.hjson").read_text()
    assert "version=2" in run("import", store, "documents2", tmp_path / "out")


def test_register_commands(spark, tmp_path, capsys):
    name = tmp_path / "Gesamtdatenexport_20240131_23.2.zip"
    with zipfile.ZipFile(name, "w") as z:
        z.writestr("EinheitenWind.xml", "<EinheitenWind><E><Id>w</Id><Landkreis>Leer</Landkreis><LokationMaStRNummer>L</LokationMaStRNummer></E><E><Id>v</Id><Landkreis>Ulm</Landkreis></E></EinheitenWind>")
        z.writestr("Lokationen.xml", "<Lokationen><L><MastrNummer>L</MastrNummer></L><L><MastrNummer>M</MastrNummer></L></Lokationen>")
    for args in (["register-import", name, tmp_path / "db"], ["register-extract", tmp_path / "db", tmp_path / "part", "Leer"], ["register-search", tmp_path / "part", "leer"]):
        main([str(a) for a in args], spark)
    out = capsys.readouterr().out
    assert "hits: 1 rows" in out and spark.read.parquet(str(tmp_path / "part" / "Lokationen")).count() == 1
