"""Data source `gridxml`: CIM RDF/XML files as facts, and what could not be read as errors.

    spark.dataSource.register(rdfxml.GridXmlSource)
    spark.read.format("gridxml").option("version", 7).load("/data/model/*.xml")

One partition per file; a file is parsed as a stream of blocks, so its size doesn't matter to memory. A syntax error ends
its file only: the facts before it are kept and one error row says where it happened (class `!error`, see split()).
"""

from __future__ import annotations

import glob
import os
import re
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "version bigint, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int, source_file string, line bigint, byte_offset bigint"
_ARROW = pa.schema(
    [("version", pa.int64()), ("id", pa.string()), ("profile", pa.string()), ("class", pa.string()), ("attribute", pa.string()), ("value", pa.string()), ("is_reference", pa.bool_()), ("seq", pa.int32()),
     ("source_file", pa.string()), ("line", pa.int64()), ("byte_offset", pa.int64())]
)
PROFILE = re.compile(r"_(EQBD|TPBD|EQ|SSH|TP|SV|GL|DL|DY|SC)(?:[_.]|$)", re.IGNORECASE)
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
ERROR = "!error"
BLOCK, ROWS = 1 << 20, 20_000


def profile_of(path: str) -> str | None:
    """The profile in a file name, as in `grid_EQ.xml`."""
    m = PROFILE.search(os.path.basename(path))
    return m[1].upper() if m else None


def reference(value: str) -> str:
    """The id in a reference: what follows the last `#`, without one leading `_`."""
    return value.rsplit("#", 1)[-1].removeprefix("_")


def parse(path: str, version: int, profile: str | None) -> Iterator[tuple]:
    """The facts of a file: an element at depth 2 is an object, one at depth 3 an attribute of it.

    The id comes from rdf:ID or rdf:about; objects without one are skipped. An attribute with rdf:resource is a reference,
    any other has its trimmed text. seq counts an attribute's repetitions in its object.
    """
    rows: list[tuple] = []
    depth, obj, cls, attr, ref, text, seen = 0, None, "", None, None, [], {}
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True

    def start(name: str, attrs: dict) -> None:
        nonlocal depth, obj, cls, attr, ref, text, seen
        depth += 1
        local = name.rsplit("}", 1)[-1]
        if depth == 2:
            named = attrs.get(f"{RDF}}}ID") or attrs.get(f"{RDF}}}about")
            obj, cls, seen = (reference(named) if named else None), local, {}
        elif depth == 3:
            attr, ref, text = local, attrs.get(f"{RDF}}}resource"), []

    def end(_: str) -> None:
        nonlocal depth
        if depth == 3 and obj is not None:
            seq = seen[attr] = seen.get(attr, -1) + 1
            value = reference(ref) if ref is not None else "".join(text).strip()
            rows.append((version, obj, profile, cls, attr, value, ref is not None, seq, path, parser.CurrentLineNumber, parser.CurrentByteIndex))
        depth -= 1

    def data(s: str) -> None:
        if depth == 3 and ref is None:
            text.append(s)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
    try:
        with open(path, "rb") as f:
            while block := f.read(BLOCK):
                parser.Parse(block, False)
                yield from rows
                rows.clear()
            parser.Parse(b"", True)
        yield from rows
    except expat.ExpatError as e:
        yield from rows
        yield version, None, profile, ERROR, None, expat.ErrorString(e.code), False, 0, path, e.lineno, parser.ErrorByteIndex
    except OSError as e:
        yield version, None, profile, ERROR, None, str(e), False, 0, path, None, None


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.version = int(options.get("version", 1))
        self.paths = options.get("path", "")

    def partitions(self) -> list[InputPartition]:
        found = sorted({f for p in self.paths.split(",") for f in (glob.glob(p.strip().removeprefix("file://")) or [p.strip()]) if f})
        files = [os.path.join(f, x) for f in found if os.path.isdir(f) for x in sorted(os.listdir(f))] + [f for f in found if not os.path.isdir(f)]
        return [InputPartition(f) for f in files]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        for row in parse(partition.value, self.version, profile_of(partition.value)):
            part.append(row)
            if len(part) >= ROWS:
                yield _batch(part)
                part = []
        if part:
            yield _batch(part)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


class GridXmlSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gridxml"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def split(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts and errors (version, source_file, line, byte_offset, message) of what the source read."""
    facts = raw.filter(F.col("class") != ERROR)
    return facts, raw.filter(F.col("class") == ERROR).select("version", "source_file", "line", "byte_offset", F.col("value").alias("message"))


def duplicate_ids(facts: DataFrame, by_profile: bool = True) -> DataFrame:
    """(id, n_files) of objects that several files define; by_profile: files of different profiles may describe the same object."""
    key = ["id", "profile"] if by_profile else ["id"]
    return facts.groupBy(*key).agg(F.countDistinct("source_file").alias("n_files")).filter("n_files > 1").groupBy("id").agg(F.max("n_files").alias("n_files"))
