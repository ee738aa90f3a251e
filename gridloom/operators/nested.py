"""Nested File bodies (JSON text) into related flat tables, by Dewey labels."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import spread

#: The lists of each node kind, by the field's place in the model; a place is the field's ordinal in a label.
FIELDS = {
    "file": ["busbars", "bays", "equipments", "segments"],
    "busbar": ["sections"],
    "bay": ["equipments"],
    "section": ["satellites"],
    "equipment": ["satellites"],
    "segment": ["satellites"],
    "satellite": [],
}
KIND_OF = {"busbars": "busbar", "sections": "section", "bays": "bay", "equipments": "equipment", "segments": "segment", "satellites": "satellite"}
#: Other spellings of a field.
ALSO = {"equipments": "equipment"}
KINDS = ["busbar", "section", "bay", "equipment", "segment", "satellite", "satellite_attribute"]
#: Nodes handed on at once by the parser, so that a very large body needs little memory besides itself.
NODES_PER_BATCH = 5_000

NODE = "file_id string, kind string, schema_path string, label array<int>, parent_label array<int>, path string, parent_path string, id string, class string, key string, value string, fields map<string,string>"
_TYPES = [pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string())]
_ARROW = pa.schema(list(zip([f.split()[0] for f in NODE.split(", ")], _TYPES, strict=True)))


def _refuse(text: str) -> None:
    raise ValueError(f"{text} is no JSON value")


def _load(body: str) -> object:
    try:
        return json.loads(body, parse_constant=_refuse)
    except RecursionError:
        return deep_json(body)
    except ValueError as e:
        if "integer string conversion" not in str(e):
            raise
        return json.loads(body, parse_constant=_refuse, parse_int=str)  # a number of thousands of digits is valid JSON


_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")


def deep_json(text: str) -> object:
    """JSON of any depth, read with a stack of its own; scalars are left to the json module. Raises ValueError like it."""
    scan = json.JSONDecoder(parse_constant=_refuse).scan_once
    holders: list[dict | list] = []
    names: list[str | None] = []
    at, root, want = _SPACE.match(text).end(), None, "value"

    def fail() -> None:
        raise ValueError(f"no JSON at character {at}")

    def skip(n: int) -> int:
        return _SPACE.match(text, n).end()

    def name(n: int) -> tuple[str, int]:
        if text[n : n + 1] != '"':
            fail()
        key, n = json.decoder.scanstring(text, n + 1)
        n = skip(n)
        if text[n : n + 1] != ":":
            fail()
        return key, skip(n + 1)

    while True:
        c = text[at : at + 1]
        if want == "value" and c and c in "[{":
            new: dict | list = [] if c == "[" else {}
            at = skip(at + 1)
            holders.append(new)
            names.append(None)
            if text[at : at + 1] == ("]" if c == "[" else "}"):
                want = "end"
            elif c == "{":
                names[-1], at = name(at)
            continue
        if want == "value":
            number = _NUMBER.match(text, at)
            try:
                value, at = (number.group(), number.end()) if number and number.end() - at > 4000 else scan(text, at)
            except StopIteration:
                fail()
        else:  # a holder ends
            value, at = holders.pop(), at + 1
            names.pop()
        at = skip(at)
        if not holders:
            root = value
            break
        top = holders[-1]
        if isinstance(top, list):
            top.append(value)
        else:
            top[names[-1]] = value
        c = text[at : at + 1]
        if c == ",":
            at, want = skip(at + 1), "value"
            if isinstance(top, dict):
                names[-1], at = name(at)
        elif c == ("]" if isinstance(top, list) else "}"):
            want = "end"
        else:
            fail()
    if at != len(text):
        fail()
    return root


def _dumps(x: object) -> str:
    try:
        return json.dumps(x, ensure_ascii=False)
    except RecursionError:
        return deep_dumps(x)


def deep_dumps(x: object) -> str:
    """json.dumps for any depth."""
    out: list[str] = []
    todo: list[object] = [(x,)]  # a 1-tuple is a value to write, a string is text
    while todo:
        t = todo.pop()
        if isinstance(t, str):
            out.append(t)
            continue
        v = t[0]
        if isinstance(v, list):
            parts = [p for e in v for p in (", ", (e,))][1:]
            todo += ["]", *reversed(parts), "["]
        elif isinstance(v, dict):
            parts = [p for k, e in v.items() for p in (", ", json.dumps(k, ensure_ascii=False) + ": ", (e,))][1:]
            todo += ["}", *reversed(parts), "{"]
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)


def _scalar(x: object) -> str | None:
    """A text for a flat column: a string as it is, anything else as JSON."""
    return None if x is None else x if isinstance(x, str) else _dumps(x)


def _clean(x: str | None) -> str | None:
    """JSON may escape half a surrogate pair, which no UTF-8 text can hold."""
    return x if x is None or x.isascii() else x.encode("utf-8", "replace").decode()


def dewey(node: dict) -> Iterator[tuple]:
    """Label every node of one body, parents first.

    A label is the list (field place, position) of every step from the root; a satellite attribute's last step is (0, place
    of the entry in its object). Truncating a label by its last step gives the parent's label; the path is the same label in
    names. An object in place of a list is its element 0; null elements keep their position and give no row; elements that
    are neither null nor objects give none either. If a field occurs in both spellings, the elements of the second follow.
    """
    stack: list[tuple[dict, str, str, list[int], str]] = [(node, "file", "$", [], "$")]
    while stack:
        x, kind, schema, label, path = stack.pop()
        below = []
        for place, field in enumerate(FIELDS[kind]):
            elements: list = []
            for name in (field, ALSO.get(field)):
                v = x.get(name) if name else None
                elements += v if isinstance(v, list) else [v] if isinstance(v, dict) else []
            for i, e in enumerate(elements):
                if isinstance(e, dict):
                    below.append((e, KIND_OF[field], f"{schema}.{field}", [*label, place, i], f"{path}.{field}[{i}]"))
        for e, k, s, own, at in below:
            flat = {n: _scalar(v) for n, v in e.items() if v is not None and n not in FIELDS[k] and n not in ALSO.values() and n not in ("id", "class")}
            yield k, s, own, at, _scalar(e.get("id")), _scalar(e.get("class")), None, None, flat
            entries = e.get("attributes") if k == "satellite" else None
            if isinstance(entries, dict):
                for i, (n, v) in enumerate(entries.items()):
                    if v is not None:
                        yield "satellite_attribute", f"{s}.attributes", [*own, 0, i], f"{at}.attributes.{n}", None, None, n, _scalar(v), None
        stack.extend(reversed(below))


def _parent(label: list[int], path: str, key: str | None) -> tuple[list[int], str]:
    """Label and path cut by one step."""
    if key is not None:
        return label[:-2], path[: len(path) - len(f".attributes.{key}")]
    return label[:-2], path[: path.rindex(".")]


def nodes(files: DataFrame, once: bool = True) -> DataFrame:
    """All nodes of all bodies: one row per busbar, section, bay, equipment, segment, satellite and satellite attribute.

    files: file_id, body; other columns are ignored, repeated rows count once. A body that is null, no valid JSON (RFC 8259;
    NaN and Infinity are none; any depth) or no object gives one row of kind `unreadable` with the reason in `value`. Scalar
    and other fields of a node are in `fields` as text or JSON. once=False leaves repeated rows to a caller that removes
    repeated nodes anyway, and so spares the shuffle of the bodies.
    """
    bodies = files.select("file_id", "body")
    if once:
        bodies = bodies.groupBy("file_id", F.sha2("body", 256).alias("_h")).agg(F.first("body").alias("body")).select("file_id", "body")
    else:
        bodies = spread(bodies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for file_id, body in zip(batch.column(0), batch.column(1), strict=True):
                file_id, why = file_id.as_py(), None
                try:
                    root = _load(body.as_py())
                    if not isinstance(root, dict):
                        why = "not an object"
                except (ValueError, TypeError) as e:
                    why = f"{type(e).__name__}: {e}"
                if why:
                    yield file_id, "unreadable", "$", [], None, "$", None, None, None, None, _clean(why), None
                    continue
                for kind, schema, label, path, id_, class_, key, value, flat in dewey(root):
                    up, above = _parent(label, path, key)
                    yield file_id, kind, schema, label, up, _clean(path), _clean(above), _clean(id_), _clean(class_), _clean(key), _clean(value), None if flat is None else [(_clean(a), _clean(b)) for a, b in flat.items()]

        def table(part: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), _TYPES, strict=True)], schema=_ARROW)

        for batch in batches:
            part: list[tuple] = []
            for r in rows(batch):
                part.append(r)
                if len(part) >= NODES_PER_BATCH:
                    yield table(part)
                    part = []
            if part:
                yield table(part)

    return bodies.mapInArrow(run, NODE)


def flat_table(all_nodes: DataFrame, kind: str) -> DataFrame:
    """The table of one kind, linked to its parent by (file_id, parent_path); nodes of one kind share few schema paths."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    own = all_nodes.filter(F.col("kind") == kind)
    if kind == "satellite_attribute":
        return own.select("file_id", "schema_path", "path", "parent_path", "key", "value")
    extra = {"segment": ["from", "to"], "equipment": ["connects", "measuring", "transmission", "steps"]}.get(kind, [])
    columns = [*extra, "attributes", "geometry"] if kind != "satellite" else []
    return own.select("file_id", "schema_path", "path", "parent_path", "id", "class", *(F.col("fields")[c].alias(c) for c in columns))
