"""Data source `registerzip`: a zip of flat XML tables, one partition per member.

A member `<Dataset>[_<n>].xml` has records of fields: `<Dataset><Record><Field>text</Field>...`. Encodings follow the byte
order mark (UTF-16 of either order, UTF-8) or the declaration. Rows are (dataset, chunk, row_no, fields map, error); the
columns of a table are found by register.map_to_columns. A broken member keeps the records before the break and adds one
row with the error.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.parsers import expat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "dataset string, chunk int, row_no bigint, fields map<string,string>, error string"
MEMBER = re.compile(r"^(?:.*/)?(.+?)(?:_(\d+))?\.xml$", re.IGNORECASE)
BLOCK = 1 << 20


class _Member(InputPartition):
    def __init__(self, path: str, name: str, dataset: str, chunk: int):
        self.path, self.name, self.dataset, self.chunk = path, name, dataset, chunk


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        with zipfile.ZipFile(self.path) as z:
            found = [(m, n) for n in z.namelist() if (m := MEMBER.match(n))]
        return [_Member(self.path, n, m[1], int(m[2] or 0)) for m, n in sorted(found, key=lambda x: (x[0][1], int(x[0][2] or 0)))]

    def read(self, partition: _Member) -> Iterator[tuple]:
        rows: list[dict] = []
        depth, field, text, record = 0, "", [], {}
        parser = expat.ParserCreate()
        parser.buffer_text = True

        def start(name: str, _: dict) -> None:
            nonlocal depth, field, text, record
            depth += 1
            if depth == 2:
                record = {}
            elif depth == 3:
                field, text = name, []

        def end(_: str) -> None:
            nonlocal depth
            if depth == 3:
                record[field] = "".join(text)
            elif depth == 2:
                rows.append(record)
            depth -= 1

        parser.StartElementHandler, parser.EndElementHandler = start, end
        parser.CharacterDataHandler = lambda s: text.append(s) if depth == 3 else None
        n, error = 0, None
        with zipfile.ZipFile(partition.path) as z, z.open(partition.name) as f:
            try:
                while block := f.read(BLOCK):
                    parser.Parse(block, False)
                    for r in rows:
                        yield partition.dataset, partition.chunk, n, r, None
                        n += 1
                    rows.clear()
                parser.Parse(b"", True)
            except expat.ExpatError as e:
                error = f"line {e.lineno}: {expat.ErrorString(e.code)}"
        for r in rows:
            yield partition.dataset, partition.chunk, n, r, None
            n += 1
        if error:
            yield partition.dataset, partition.chunk, n, None, error


class RegisterZipSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "registerzip"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def table_of(rows: DataFrame, dataset: str) -> DataFrame:
    """One dataset as a wide table of texts, with chunk and row_no as its surrogate key."""
    from gridloom.operators.register import map_to_columns

    return map_to_columns(rows.filter((F.col("dataset") == dataset) & F.col("error").isNull()).select("chunk", "row_no", "fields"))
