import json

import pytest

from gridloom.operators import nested as n
from gridloom.session import table

LISTS = {"": ["busbars", "bays", "equipments", "segments"], "busbars": ["sections"], "bays": ["equipments"], "sections": ["satellites"], "equipments": ["satellites"], "segments": ["satellites"]}


def brute(body):
    """Another way: recursion over names."""
    out = []

    def walk(x, name, path):
        for f in LISTS.get(name, []):
            v = x.get(f)
            if v is None and f == "equipments":
                v = x.get("equipment")
            for i, e in enumerate(v if isinstance(v, list) else [v] if isinstance(v, dict) else []):
                if isinstance(e, dict):
                    own = f"{path}.{f}[{i}]"
                    out.append((path, own))
                    if f == "satellites":
                        out.extend((own, f"{own}.attributes.{k}") for k, y in (e.get("attributes") or {}).items() if y is not None)
                    walk(e, f, own)

    try:
        root = json.loads(body)
    except (ValueError, TypeError):
        return []
    if isinstance(root, dict):
        walk(root, "", "$")
    return out


def files(spark, bodies):
    return spark.createDataFrame([(f"f{i}", b, "k", "p") for i, b in enumerate(bodies)], "file_id string, body string, kind string, path string")


def test_shapes(spark):
    body = {
        "busbars": {"id": "B", "sections": [None, {"id": "S", "satellites": {"class": "X", "attributes": {"a.b": 1, "n": None, "": [1, 2]}}}]},
        "bays": [None, {"id": "Y", "equipment": [{"id": "E", "class": "Fuse", "connects": ["@1"], "satellites": [None, {"attributes": None}, {"class": "Z"}]}]}],
        "segments": [], "equipments": None, "attributes": {"q": 1},
    }
    rows = n.nodes(files(spark, [json.dumps(body)])).collect()
    assert sorted((r.parent_path, r.path) for r in rows) == sorted(brute(json.dumps(body)))
    by = {r.path: r for r in rows}
    assert by["$.busbars[0].sections[1].satellites[0].attributes.a.b"].parent_path == "$.busbars[0].sections[1].satellites[0]"
    assert by["$.bays[1].equipments[0].satellites[2]"].parent_label == by["$.bays[1].equipments[0]"].label
    assert by["$.bays[1].equipments[0]"].fields["connects"] == '["@1"]' and by["$.bays[1].equipments[0]"]["class"] == "Fuse"
    assert {r.kind for r in rows} == set(n.KINDS) - {"segment"}
    for r in rows:
        assert r.label[: len(r.parent_label)] == r.parent_label and len(r.label) == len(r.parent_label) + 2


def test_unreadable_bodies_and_repeats(spark):
    bodies = [None, "", "{", "[1]", '{"a": NaN}', '{"busbars": [{"id": "x"}]} x', '{"busbars": "text", "bays": 5}', '{"busbars": [1, "s", {"id": "\\ud800"}]}', '{"n": ' + "9" * 5000 + ', "segments": [{}]}']
    df = files(spark, bodies)
    rows = n.nodes(df.union(df)).collect()
    assert sorted(r.file_id for r in rows if r.kind == "unreadable") == ["f0", "f1", "f2", "f3", "f4", "f5"]
    assert sorted((r.file_id, r.path) for r in rows if r.kind != "unreadable") == [("f7", "$.busbars[2]"), ("f8", "$.segments[0]")]


def test_very_large_body(spark):
    body = json.dumps({"bays": [{"id": str(i), "equipments": [{"id": "e", "satellites": [{"class": "c", "attributes": {"k": "v" * 50}}]}]} for i in range(8000)]})
    assert n.nodes(files(spark, [body])).count() == 8000 * 4


@pytest.mark.parametrize("kind", n.KINDS)
def test_tables_link_to_their_parents(spark, small, kind):
    nodes = n.nodes(table(spark, small, "model_file"))
    t = n.flat_table(nodes, kind)
    paths = nodes.select("file_id", "path").union(nodes.select("file_id", nodes.schema["path"].name).limit(0)).withColumnRenamed("path", "parent_path")
    roots = t.filter("parent_path = '$'").count()
    assert t.join(paths, ["file_id", "parent_path"], "left_semi").count() + roots == t.count()


def test_whole_table_as_brute_force(spark, small):
    rows = table(spark, small, "model_file").collect()
    want = {(r.file_id, *x) for r in rows for x in brute(r.body)}
    got = [(r.file_id, r.parent_path, r.path) for r in n.nodes(table(spark, small, "model_file")).collect() if r.kind != "unreadable"]
    assert set(got) == want and len(got) == len(want)


def test_no_files(spark):
    assert n.nodes(files(spark, [])).count() == 0
    with pytest.raises(ValueError):
        n.flat_table(n.nodes(files(spark, [])), "file")


def test_bodies_nested_beyond_the_interpreters_stack(spark):
    deep = "[" * 200_000 + "1" + "]" * 200_000
    body = '{"busbars": [{"id": "b", "attributes": {"k": ' + deep + ', "n": 1}, "sections": [{"id": "s"}]}]}'
    rows = n.nodes(spark.createDataFrame([("f", body), ("g", '{"busbars": ' + "[" * 200_000), ("h", '{"a": ' + '{"b":' * 50_000 + "null" + "}" * 50_000 + "}")], "file_id string, body string")).collect()
    assert [(r.file_id, r.path, r.id) for r in rows if r.kind != "unreadable"] == [("f", "$.busbars[0]", "b"), ("f", "$.busbars[0].sections[0]", "s")]
    assert [r.file_id for r in rows if r.kind == "unreadable"] == ["g"]
    assert len(next(r for r in rows if r.id == "b").fields["attributes"]) > 400_000


@pytest.mark.parametrize("text", ['{"a": [1, 2.5e3, "x\\u0041", null, true, {}, []], "b": {"c": [[{}]]}}', " [ ] ", "3", '"x"', '{"a":1,}', "[1 2]", "[1,]", "", "{", '{"a"}', "[1]]", '{"a": NaN}', "[01]", "nul", '{"a":1 "b":2}'])
def test_the_deep_reader_reads_as_the_json_module(text):
    def out(f):
        try:
            return f(text)
        except ValueError:
            return "error"

    want = out(lambda t: json.loads(t, parse_constant=n._refuse))
    assert out(n.deep_json) == want
    if want != "error":
        assert n.deep_dumps(want) == json.dumps(want, ensure_ascii=False)
