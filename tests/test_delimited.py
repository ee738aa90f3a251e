import math
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import delimited as d
from gridloom.session import table

COLUMNS = [
    d.Column("n", "long", True, 0, 100, None), d.Column("x", "double", False, None, 10, None), d.Column("ok", "boolean", False, None, None, None),
    d.Column("kind", "string", True, None, None, frozenset({"a", "b"})), d.Column("text", "string", False, None, None, None),
]
G = d.Grammar(COLUMNS, ";")


def parses(text, g=G):
    try:
        return g.record(text, 0)[1] == len(text)
    except d.Broken:
        return False


def plain(text, columns=COLUMNS, delimiter=";"):
    """Another way: walk over the characters with one state, then judge the fields."""
    fields, field, state = [], "", "start"
    for i, c in enumerate(text):
        at_delimiter = text.startswith(delimiter, i)
        if state == "quoted":
            if c == '"':
                state = "closing"
            else:
                field += c
        elif state == "closing":
            if c == '"':
                field += c
                state = "quoted"
            elif at_delimiter:
                fields.append(field)
                field, state = "", "start"
            else:
                return False
        elif at_delimiter:
            fields.append(field)
            field, state = "", "start"
        elif c == '"':
            if state != "start":
                return False
            state = "quoted"
        elif c in "\r\n":
            return False
        else:
            field, state = field + c, "bare"
    if state == "quoted":
        return False
    fields.append(field)
    if len(fields) != len(columns):
        return False
    for f, c in zip(fields, columns, strict=True):
        if f == "":
            if c.required:
                return False
            continue
        number = None
        if c.kind == "long":
            if not re.fullmatch("-?[0-9]+", f) or not -(2**63) <= int(f) < 2**63:
                return False
            number = int(f)
        elif c.kind == "double":
            if not re.fullmatch(r"-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?", f) or math.isinf(float(f)):
                return False
            number = float(f)
        elif c.kind == "boolean" and f not in [a + b for a in ("",) for b in ("true", "false", "True", "False", "TRUE", "FALSE")] and f.lower() not in ("true", "false"):
            return False
        elif c.allowed is not None and f not in c.allowed:
            return False
        if number is not None and (c.least is not None and number < c.least or c.most is not None and number > c.most):
            return False
    return True


VALUE = st.sampled_from(["1", "-1", "7", "100", "101", "1.5", "1e3", "1e999", ".5", "true", "FALSE", "yes", "a", "b", "c", "", '"a"', '"1"', '""', '"x""y"', '"x"y', 'x"', '"', '"p;q"', '"l\nm"', "l\nm", " 1", "１"])


@settings(max_examples=600, deadline=None)
@given(st.lists(VALUE, min_size=3, max_size=7))
def test_agrees_with_a_plain_automaton(values):
    text = ";".join(values)
    assert parses(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='1a;"\nb', max_size=25))
def test_agrees_on_any_text(text):
    assert parses(text) == plain(text)


@pytest.mark.parametrize(
    ("text", "message", "position"),
    [
        ("1;2;true;a", "4 fields instead of 5", 10), ('1;2;true;a;"x', "quote never closed", 11), ('1;2;true;a;"x"y', "text after the closing quote", 14), ("1;2;true;z;", "not allowed", 9),
        ("999;2;true;a;", "out of range", 0), ("99999999999999999999;;;a;", "not a long", 0), (";;;a;", "value missing", 0), ('1;2;true;a;x"', "quote inside", 12),
    ],
)
def test_errors_are_located(text, message, position):
    with pytest.raises(d.Broken) as e:
        G.record(text, 0)
    assert message in e.value.message and e.value.position == position


def test_parser_resumes_at_the_next_whole_record():
    text = '1;2;true;a;"never closed\n2;3;false;b;fine\nrubbish\n3;4;;a;"two\nlines"\n'
    got = list(G.text(text))
    assert [v[0] if v else None for _, v, _ in got] == [None, "2", None, "3"]
    assert got[3][1][4] == "two\nlines"


def rows(spark, data):
    return spark.createDataFrame(data, "source_file string, line bigint, byte_offset bigint, layout string, raw string, message string, values string")


def layouts(spark):
    return spark.createDataFrame(
        [("p", 1, "line", "long", True, 0.0, 10.0, None, ","), ("p", 2, "name", "string", False, None, float("nan"), None, ","), ("p", 2, "name", "string", False, None, float("nan"), None, ",")],
        "layout string, column_no int, column_name string, column_type string, required boolean, min_value double, max_value double, allowed string, delimiter string",
    )


def test_rows_nulls_repeats_and_clashing_columns(spark):
    long_text = "x" * 200_000
    data = [("f", 2, 0, "p", "1,a", "m", "v"), ("f", 2, 0, "p", "1,a", "m", "v"), ("f", 3, 5, "p", "99,b", "m", "v"), ("f", 3, 5, "p", "99,b", "m", "v"), ("f", 4, None, None, "1,a", None, None), ("f", 5, 9, "q", "1,a", None, None), ("f", 6, 9, "p", None, None, None),
            ("f", None, 9, "p", "", None, None), (None, 7, 9, "p", f"2,{long_text}", None, None), ("g", 8, 20, "p", '3,"open\n4,next', None, None)]
    parsed = d.parse_rows(rows(spark, data), layouts(spark))
    errors = {(r.source_file, r.line): r.message for r in d.errors(parsed, 9).collect()}
    assert set(errors) == {("f", 3), ("f", 4), ("f", 5), ("f", 6), ("f", None), ("g", 8)}
    assert "out of range" in errors[("f", 3)] and "unknown layout q" in errors[("f", 5)] and errors[("f", 6)] == "no text"
    good = d.records(parsed, layouts(spark), "p")
    assert good.columns == ["source_file", "line", "line_value", "name"]
    assert sorted((r.line, r.line_value, len(r.name)) for r in good.collect()) == [(2, 1, 1), (7, 2, 200_000)]
    more = d.records(parsed, layouts(spark), "p", recovered=True)
    assert ("g", 9, 4, "next") in {tuple(r) for r in more.collect()}


def test_no_rows(spark):
    parsed = d.parse_rows(rows(spark, []), layouts(spark))
    assert d.errors(parsed).count() == 0 and d.records(parsed, layouts(spark), "p").count() == 0


def test_whole_table_against_the_automaton(spark, small):
    lay = table(spark, small, "raw_layouts")
    g = d.grammars(lay)
    found = {(r.source_file, r.line) for r in d.errors(d.parse_rows(table(spark, small, "raw_rows"), lay)).collect()}
    want = {(r.source_file, r.line) for r in table(spark, small, "raw_rows").collect() if not plain(r.raw, g[r.layout].columns, g[r.layout].delimiter)}
    assert found == want and want


def test_every_layout_is_loaded(spark, small):
    from gridloom.plans.problems import QUERIES

    lay = table(spark, small, "raw_layouts")
    g = d.grammars(lay)
    got = QUERIES["p1_records"](spark, small).collect()
    raw = {(r.source_file, r.line, r.layout) for r in table(spark, small, "raw_rows").collect() if plain(r.raw, g[r.layout].columns, g[r.layout].delimiter)}
    assert {(r.source_file, r.line, r.layout) for r in got if not r.recovered} == raw and {x[2] for x in raw} == set(g)
    assert len(raw) == sum(not r.recovered for r in got)
    for r in got:
        assert [n for n in g if r[f"{n}_record"] is not None] == [r.layout] and len(r[f"{r.layout}_record"]) == len(g[r.layout].columns)


def test_recovered_records_and_later_errors(spark):
    text = '1,"open\n2,good\nrubbish\n3,also'
    data = [("g", 8, 20, "p", text, None, None)] * 2 + [("g", 20, 90, "p", "4,a\n5,b", None, None)]
    parsed = d.parse_rows(rows(spark, data), layouts(spark))
    got = {(r.source_file, r.line, r.recovered, *r.p_record) for r in d.all_records(parsed, layouts(spark)).collect()}
    assert got == {("g", 9, True, 2, "good"), ("g", 11, True, 3, "also"), ("g", 20, True, 4, "a"), ("g", 21, True, 5, "b")}
    assert {(r.source_file, r.line) for r in d.errors(parsed).collect()} == {("g", 8), ("g", 20)}
    every = {(r.line, r.byte_offset): r.message for r in d.every_error(parsed).collect()}
    assert set(every) == {(8, 20), (10, 35), (20, 90)} and "quote never closed" in every[(8, 20)] and "fields instead of" in every[(10, 35)]


def test_broken_layout_is_refused(spark):
    with pytest.raises(ValueError):
        d.grammars(layouts(spark).filter(F.col("column_no") == 2))


def test_resuming_in_a_large_broken_text_is_linear():
    g = d.Grammar([d.Column("a", "long", True, None, None, None), d.Column("b", "string", False, None, None, None)], ",")
    text = '1,"open' + "\n" + "\n".join(f'x{k},"swallowed' if k % 2 else f'"""{k}' for k in range(60_000)) + "\n7,good\n"
    start = time.time()
    got = [(values, e is None) for _, values, e in g.text(text)]
    assert time.time() - start < 10 and got[0][1] is False and got[-1][0] == ["7", "good"]


@pytest.mark.parametrize("text", ['"a"', '"a""b",c', '""', '"""', '"a"b"c"', '"x\ny""",""', '""""', 'a"b"""'])
def test_closing_quotes_are_those_of_the_grammar(text):
    g = d.Grammar([], ",")
    closings = g.closings(text)
    for at, c in enumerate(text):
        if c == '"':
            m = g.quoted.match(text, at)
            by_pattern = m.end() if m and g.ends(text, m.end()) else None
            by_pass = closings[at] + 1 if at in closings and g.ends(text, closings[at] + 1) else None
            assert by_pattern == by_pass


def test_broken_rows_without_line_stay_apart(spark):
    rows = spark.createDataFrame([("f", None, 5, "l", "x,y"), ("f", None, 9, "l", "z,y"), ("f", None, 9, "l", "z,y")], "source_file string, line long, byte_offset long, layout string, raw string")
    layouts = spark.createDataFrame([("l", 1, "a", "long", True, None, None, None, ","), ("l", 2, "b", "string", False, None, None, None, ",")], "layout string, column_no int, column_name string, column_type string, required boolean, min_value double, max_value double, allowed string, delimiter string")
    assert d.errors(d.parse_rows(rows, layouts)).count() == 2


def test_rows_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(d, "ROWS_PER_BATCH", 2)
    (tmp_path / "a.csv").write_bytes('n,t\n1,"two\nlines"\r\n\n2,"open\n3,ä\n'.encode() + b"4,\xff")
    (tmp_path / "b.csv").write_text("n,t\n5,x\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "_skip.csv").write_text("n,t\n9,x\n")
    got = {(r.source_file.rsplit("/", 1)[-1], r.line, r.byte_offset, r.raw) for r in d.file_rows(spark, str(tmp_path), "l").collect()}
    assert got == {("a.csv", 2, 4, '1,"two\nlines"'), ("a.csv", 4, 19, ""), ("a.csv", 5, 20, '2,"open'), ("a.csv", 6, 28, "3,ä"), ("a.csv", 7, 33, "4,\ufffd"), ("b.csv", 2, 4, "5,x")}
    layouts = spark.createDataFrame([("l", 1, "n", "long", True, None, None, None, ","), ("l", 2, "t", "string", False, None, None, None, ",")], "layout string, column_no int, column_name string, column_type string, required boolean, min_value double, max_value double, allowed string, delimiter string")
    parsed = d.parse_rows(d.file_rows(spark, str(tmp_path), "l"), layouts)
    assert {(r.n, r.t) for r in d.records(parsed, layouts, "l").collect()} == {(1, "two\nlines"), (3, "ä"), (4, "\ufffd"), (5, "x")} and {r.line for r in d.errors(parsed).collect()} == {4, 5}
    assert d.file_rows(spark, str(tmp_path / "b.csv"), "l", header=False).count() == 2


def test_a_quote_that_stays_open_in_a_long_file(spark, tmp_path, monkeypatch):
    (tmp_path / "x.csv").write_text('1,"never\n' + "2,b\n" * 30_000)
    start = time.time()
    assert d.file_rows(spark, str(tmp_path / "x.csv"), "l", header=False).count() == 30_001 and time.time() - start < 30
