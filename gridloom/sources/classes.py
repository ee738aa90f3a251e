"""Registry of CIM classes: what a class is, which attributes it has, and a template of it for documents."""

from __future__ import annotations

import textwrap
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.doctext import key_text, read

SCHEMA = "name string, group string, description string, terminals string, attributes array<struct<key:string,type:string,required:boolean,description:string>>"
#: Connections by the number of terminals that a class has.
CONNECTS = {
    "one": ["// One node; the other side is ground and is not written.", "connects: [", "  TODO_NODE_1", "]"],
    "two": ["// Two nodes: the side of the higher voltage first.", "connects: [", "  TODO_NODE_1", "  TODO_NODE_2", "]"],
    "many": ["// One node or more, all of which name the same place.", "connects: [", "  TODO_NODE_1", "]"],
}
WIDTH = 90


def load(spark: SparkSession, folder: str) -> DataFrame:
    """The classes of all files of a folder, `{classes: {<name>: {group, description, terminals, attributes: [...]}}}` each; a class given twice is an error."""
    files = spark.read.format("binaryFile").load(folder).select("path", F.col("content").cast("string").alias("text"))
    kind = pa.schema([("name", pa.string()), ("group", pa.string()), ("description", pa.string()), ("terminals", pa.string()), ("attributes", pa.list_(pa.struct([("key", pa.string()), ("type", pa.string()), ("required", pa.bool_()), ("description", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                for name, c in read(r["text"]).get("classes", {}).items():
                    rows.append({"name": name, "group": c.get("group"), "description": c.get("description"), "terminals": c.get("terminals"), "attributes": [{k: a.get(k) for k in ("key", "type", "description")} | {"required": bool(a.get("required"))} for a in c.get("attributes", [])]})
            yield pa.RecordBatch.from_pylist(rows, kind)

    out = files.mapInArrow(run, SCHEMA)
    twice = out.groupBy("name").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"classes given more than once: {', '.join(sorted(r.name for r in twice))}")
    return out


def by_group(classes: DataFrame) -> DataFrame:
    """(group, names): the classes of each group in order."""
    return classes.groupBy("group").agg(F.sort_array(F.collect_list("name")).alias("names"))


def template(name: str, group: str | None, description: str | None, terminals: str | None, attributes: list[dict]) -> str:
    """A document entry of a class to fill in."""
    lines = [f"// CIM class {name}" + (f" (group {group})" if group else ""), *(f"// {x}" for x in textwrap.wrap(description or "", WIDTH)), "{", f'  id: "{name}-1" // TODO: an id of its own in the region', f"  class: {name}"]
    lines += [f"  {x}" for x in CONNECTS.get(terminals or "", ["// This class has no terminals and needs no connects."])]
    if attributes:
        lines.append("  attributes: {")
        for a in attributes:
            lines += [f"    // {a['key']} ({a['type']}, {'required' if a['required'] else 'optional'}): {a['description'] or ''}".rstrip(), f"    {key_text(a['key'])}: null"]
        lines.append("  }")
    else:
        lines += ["  // No attributes are registered for this class.", "  attributes: {}"]
    return "\n".join([*lines, "}", ""])


def templates(classes: DataFrame) -> DataFrame:
    """(name, text): the template of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([r["name"] for r in rows], pa.string()), pa.array([template(r["name"], r["group"], r["description"], r["terminals"], r["attributes"] or []) for r in rows], pa.string())], names=["name", "text"])

    return classes.mapInArrow(run, "name string, text string")
