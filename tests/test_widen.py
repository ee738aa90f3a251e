import datetime

import pytest
from pyspark.sql import functions as F

from gridloom.operators import widen as w
from gridloom.session import table

SCHEMA = "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"
TYPES = [("A.n", "long"), ("A.x", "double"), ("A.on", "boolean"), ("A.day", "date"), ("A.s", "string"), (None, "long")]


def facts(spark, rows):
    return spark.createDataFrame([(v, i, None, c, a, x, False, s) for v, i, c, a, x, s in rows], SCHEMA)


def types(spark, rows=TYPES):
    return spark.createDataFrame(rows, "attribute string, value_type string")


def test_cells_types_and_choices(spark):
    rows = [
        (1, "a", "Equipment", "A.n", "x", 0), (1, "a", "Fuse", "A.n", " 7 ", 1), (1, "a", "Fuse", "A.n", "8", 2), (1, "a", "Fuse", "A.x", "1e999", 0), (1, "a", "Fuse", "A.on", "TRUE", 0),
        (1, "a", "Fuse", "A.day", "2024-02-30", 0), (1, "a", "Fuse", "A.s", " keep ", 0), (1, "a", "Fuse", "ext.q", "5", 0), (1, "a", "Fuse", "ext.q", "5", 0), (2, "a", "Equipment", "A.day", "2024-02-29", 0),
        (2, "a", "Equipment", "A.x", "", 0), (2, "a", "Equipment", "A.n", None, 0), (3, "b", None, None, "z", 0), (None, "c", "X", "A.n", "9223372036854775808", None), (1, None, "X", "A.x", "-1.5e-3", 0), (1, "a", "Fuse", "class", "odd", 0),
    ]
    out = {(r.version, r.id): r for r in w.widen(facts(spark, rows), types(spark)).collect()}
    a = out[(1, "a")]
    assert (a["A.n"], a["A.x"], a["A.on"], a["A.day"], a["A.s"], a["ext.q"], a["class_value"], a["class"]) == (7, None, True, None, " keep ", "5", "odd", "Fuse")
    assert a["bad_attributes"] == ["A.day", "A.x"]
    b = out[(2, "a")]
    assert (b["A.day"], b["A.x"], b["bad_attributes"], b["class"]) == (datetime.date(2024, 2, 29), None, [], "Equipment")
    assert out[(3, "b")]["bad_attributes"] == [] and out[(None, "c")]["bad_attributes"] == ["A.n"] and out[(1, None)]["A.x"] == -1.5e-3
    assert len(out) == 5


@pytest.mark.parametrize(("text", "kind", "good"), [
    ("1", "long", True), ("007", "long", True), ("-1", "long", True), ("+1", "long", False), ("1.0", "long", False), ("9223372036854775807", "long", True), ("9223372036854775808", "long", False), ("３", "long", False), ("1L", "long", False), ("12_000", "long", False),
    ("1.", "double", False), ("1.5E+3", "double", True), ("1d", "double", False), ("NaN", "double", False), ("1e309", "double", False), ("tru", "boolean", False), ("T", "boolean", False), ("False", "boolean", True),
    ("2024-2-01", "date", False), ("2023-02-29", "date", False), ("2024-02-29", "date", True), ("0000-01-01", "date", False), ("20240229", "date", False), (" 2 ", "long", True),
])
def test_literals(spark, text, kind, good):
    v = w.blank_trimmed(F.lit(text))
    assert spark.range(1).select(F.coalesce(w.fits(v, F.lit(kind)), F.lit(False)).alias("g")).first().g is good


@pytest.mark.parametrize("values", [1, 3000])
def test_blocks_do_not_change_the_table(spark, small, monkeypatch, values):
    f, t = table(spark, small, "staging_records"), table(spark, small, "attribute_types")
    rows = lambda: [tuple(r) for r in w.widen(f, t).select("version", "id", "class", "`Conductor.length`", F.array_join("bad_attributes", ",")).collect()]
    one = rows()
    monkeypatch.setattr(w, "BLOCK_VALUES", values)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        two = rows()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(one, key=str) == sorted(two, key=str)
    assert len(one) == f.select("version", "id").distinct().count()


def test_one_entity_with_very_many_facts(spark):
    many = spark.range(30_000).select(F.lit(1).cast("long").alias("version"), F.lit("hub").alias("id"), F.lit(None).cast("string").alias("profile"), F.lit("K").alias("class"), F.lit("A.n").alias("attribute"), F.col("id").cast("string").alias("value"), F.lit(False).alias("is_reference"), F.lit(0).alias("seq"))
    r = w.widen(many, types(spark)).collect()
    assert len(r) == 1 and r[0]["A.n"] == 0


def test_empty_and_named_attributes(spark):
    assert w.widen(facts(spark, []), types(spark)).count() == 0
    out = w.widen(facts(spark, [(1, "a", "F", "A.n", "5", 0), (1, "a", "F", "other", "5", 0)]), types(spark), attributes=["A.n", "A.x"])
    assert out.columns == ["version", "id", "class", "bad_attributes", "A.n", "A.x"] and out.first()["A.n"] == 5


def test_long_values(spark):
    out = w.widen(facts(spark, [(1, "a", "F", "A.s", "y" * 300_000, 0), (1, "a", "F", "A.n", "9" * 300_000, 0)]), types(spark)).first()
    assert len(out["A.s"]) == 300_000 and out["bad_attributes"] == ["A.n"]


def test_literals_at_the_edges_are_read(spark):
    rows = [(1, str(k), "F", a, x, 0) for k, (a, x) in enumerate([("A.n", "-007"), ("A.n", "-9223372036854775808"), ("A.x", "00.50"), ("A.x", "-1E-320"), ("A.x", "5e0"), ("A.on", "FALSE"), ("A.day", "9999-12-31"), ("A.day", "0001-01-01"), ("A.x", "123456789012345678901234567890")])]
    out = {int(r.id): r for r in w.widen(facts(spark, rows), types(spark), attributes=["A.n", "A.x", "A.on", "A.day"]).collect()}
    assert [out[0]["A.n"], out[1]["A.n"], out[2]["A.x"], out[4]["A.x"], out[5]["A.on"], out[8]["A.x"]] == [-7, -(2**63), 0.5, 5.0, False, 123456789012345678901234567890.0]
    assert abs(out[3]["A.x"] + 1e-320) < 1e-322 and out[6]["A.day"] == datetime.date(9999, 12, 31) and out[7]["A.day"] == datetime.date(1, 1, 1)
