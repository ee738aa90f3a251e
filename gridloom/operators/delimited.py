"""Delimited rows: load those that fit their layout, log the others with the place and the reason.

The grammar is parsed by recursive descent, one function for each rule:

    text    := record (NEWLINE record)*
    record  := field (DELIMITER field)*          as many as the layout has columns, each value fitting its column
    field   := '"' ([^"] | '""')* '"'  |  [^" DELIMITER NEWLINE]*

A rule that fails raises a located error. After an error the parser looks for the next record-start anchor, the start of a
line from which a whole valid record can be parsed, logs the error and goes on there; so a quote that is never closed costs
only the lines up to the next anchor.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column as SqlColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A layout table is a schema, not data; more rows than this are a mistake and not taken to the driver.
MAX_LAYOUT_ROWS = 100_000
#: Lines over which a quote may stay open when files are read, and rows handed on at once.
MAX_ROW_LINES, ROWS_PER_BATCH = 10_000, 5_000

LONG = re.compile(r"-?[0-9]+")
DOUBLE = re.compile(r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")

PARSED = "source_file string, line bigint, byte_offset bigint, layout string, ok boolean, recovered boolean, values array<string>, column_no int, position int, message string"
_ARROW = pa.schema(
    [
        ("source_file", pa.string()), ("line", pa.int64()), ("byte_offset", pa.int64()), ("layout", pa.string()), ("ok", pa.bool_()),
        ("recovered", pa.bool_()), ("values", pa.list_(pa.string())), ("column_no", pa.int32()), ("position", pa.int32()), ("message", pa.string()),
    ]
)


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    required: bool
    least: float | None
    most: float | None
    allowed: frozenset[str] | None


class Broken(Exception):
    def __init__(self, position: int, column_no: int, message: str):
        super().__init__(message)
        self.position, self.column_no, self.message = position, column_no, message


def _number(x: float | None) -> float | None:
    return None if x is None or math.isnan(x) else float(x)


class Grammar:
    """The grammar of one layout."""

    def __init__(self, columns: list[Column], delimiter: str):
        d = re.escape(delimiter)
        self.columns, self.delimiter = columns, delimiter
        self.bare = re.compile(rf'(?:(?!{d})[^"\r\n])*')
        self.quoted = re.compile(r'"([^"]*(?:""[^"]*)*)"')

    def value(self, text: str, column: Column, no: int, at: int) -> str | None:
        """The typed terminal: None for an empty value, an error where the text doesn't fit the column."""
        if text == "":
            if column.required:
                raise Broken(at, no, f"column {no} ({column.name}): value missing")
            return None
        if column.kind == "string":
            if column.allowed is not None and text not in column.allowed:
                raise Broken(at, no, f"column {no} ({column.name}): value not allowed")
            return text
        if column.kind == "boolean":
            if text.lower() not in ("true", "false") or not text.isascii():
                raise Broken(at, no, f"column {no} ({column.name}): not a boolean")
            return text
        if column.kind == "long":
            if not LONG.fullmatch(text) or len(text.lstrip("-").lstrip("0")) > 19 or not -(2**63) <= (number := int(text)) < 2**63:
                raise Broken(at, no, f"column {no} ({column.name}): not a long")
        elif column.kind == "double":
            if not DOUBLE.fullmatch(text) or not math.isfinite(number := float(text)):
                raise Broken(at, no, f"column {no} ({column.name}): not a double")
        else:
            raise Broken(at, no, f"column {no} ({column.name}): unknown type {column.kind}")
        if column.least is not None and number < column.least or column.most is not None and number > column.most:
            raise Broken(at, no, f"column {no} ({column.name}): out of range")
        return text

    def field(self, text: str, at: int, no: int) -> tuple[str, int]:
        if text.startswith('"', at):
            m = self.quoted.match(text, at)
            if not m:
                raise Broken(at, no, f"field {no}: quote never closed")
            if not self.ends(text, m.end()):
                raise Broken(m.end(), no, f"field {no}: text after the closing quote")
            return m[1].replace('""', '"'), m.end()
        end = self.bare.match(text, at).end()
        if text.startswith('"', end):
            raise Broken(end, no, f"field {no}: quote inside an unquoted value")
        return text[at:end], end

    def ends(self, text: str, at: int) -> bool:
        return at == len(text) or text[at] in "\r\n" or text.startswith(self.delimiter, at)

    def record(self, text: str, at: int) -> tuple[list[str | None], int]:
        """The record that starts at `at`, and where it ends (at a line break or the text's end)."""
        values: list[str | None] = []
        no, late = 0, None
        while True:
            no += 1
            value, end = self.field(text, at, no)
            if no <= len(self.columns) and late is None:
                try:
                    values.append(self.value(value, self.columns[no - 1], no, at))
                except Broken as e:  # a wrong number of fields is the better reason; it is known at the record's end
                    late = e
            if not text.startswith(self.delimiter, end):
                break
            at = end + len(self.delimiter)
        if no != len(self.columns):
            raise Broken(end, min(no, len(self.columns)), f"{no} fields instead of {len(self.columns)}")
        if late:
            raise late
        return values, end

    @staticmethod
    def next_line(text: str, at: int) -> int | None:
        m = re.compile(r"\r\n|\r|\n").search(text, at)
        return m.end() if m else None

    def text(self, text: str) -> Iterator[tuple[int, list[str | None] | None, Broken | None]]:
        """(start, values, error) of every record of a text; one of the two is None."""
        at: int | None = 0
        closings: dict[int, int] | None = None  # only broken texts need them
        while at is not None and (at < len(text) or at == 0):
            try:
                values, end = self.record(text, at)
                yield at, values, None
                at = self.next_line(text, end)
            except Broken as e:
                yield at, None, e
                closings = self.closings(text) if closings is None else closings
                at = self.anchor(text, at, closings)

    def closings(self, text: str) -> dict[int, int]:
        """Position of the quote that closes a field, by the position of the one that opens it, for every quote of a text; one pass from the right."""
        at = [m.start() for m in re.finditer('"', text)]
        out: dict[int, int] = {}
        for k in range(len(at) - 2, -1, -1):
            doubled = k + 2 < len(at) and at[k + 2] == at[k + 1] + 1
            close = out.get(at[k + 2]) if doubled else at[k + 1]
            if close is not None:
                out[at[k]] = close
        return out

    def stands(self, text: str, at: int, closings: dict[int, int]) -> bool:
        """Whether a whole valid record stands at `at`; looks at no more fields than the layout has columns."""
        for no, column in enumerate(self.columns, 1):
            if text.startswith('"', at):
                close = closings.get(at)
                if close is None or not self.ends(text, close + 1):
                    return False
                value, end = text[at + 1 : close].replace('""', '"'), close + 1
            else:
                end = self.bare.match(text, at).end()
                if text.startswith('"', end):
                    return False
                value = text[at:end]
            try:
                self.value(value, column, no, at)
            except Broken:
                return False
            more = text.startswith(self.delimiter, end)
            if more != (no < len(self.columns)):
                return False
            at = end + len(self.delimiter)
        return True

    def anchor(self, text: str, at: int, closings: dict[int, int]) -> int | None:
        """The next line start after `at` where a whole valid record stands."""
        while (at := self.next_line(text, at)) is not None and at < len(text):
            if self.stands(text, at, closings):
                return at
        return None


def grammars(layouts: DataFrame) -> dict[str, Grammar]:
    """The layout table as grammars. Repeated rows count once; a layout without delimiter or with gaps in column_no is refused."""
    rows = layouts.select("layout", "column_no", "column_name", "column_type", "required", "min_value", "max_value", "allowed", "delimiter").distinct().limit(MAX_LAYOUT_ROWS + 1).collect()
    if len(rows) > MAX_LAYOUT_ROWS:
        raise ValueError(f"more than {MAX_LAYOUT_ROWS} layout rows")
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r.layout, []).append(r)
    out = {}
    for name, cols in by.items():
        cols.sort(key=lambda r: r.column_no)
        if [r.column_no for r in cols] != list(range(1, len(cols) + 1)) or not cols[0].delimiter:
            raise ValueError(f"layout {name!r}: columns must be numbered from 1 and have a delimiter")
        out[name] = Grammar(
            [Column(r.column_name, r.column_type, bool(r.required), _number(r.min_value), _number(r.max_value), None if r.allowed is None else frozenset(r.allowed.split("|"))) for r in cols],
            cols[0].delimiter,
        )
    return out


def parse_rows(rows: DataFrame, layouts: DataFrame) -> DataFrame:
    """Every row of `rows` (source_file, line, byte_offset, layout, raw) as one result row, without a shuffle.

    ok: the text is exactly one record of its layout, whose `values` are texts that fit their columns (null if empty).
    Otherwise `message` says why, with the column and the position in the text. A broken text may hold whole records beside
    the broken part (a quote that swallowed the lines after it) and further errors behind them: they come out in addition,
    `recovered`, with the line they stand on. A null text, a null layout or an unknown one is an error. Other columns of
    `rows` are not carried along; rows delivered twice come out twice (records() and errors() remove that).
    """
    known = grammars(layouts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for source, line, offset, layout, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                g = known.get(layout)
                if g is None or raw is None:
                    why = "no layout" if layout is None else f"unknown layout {layout}" if g is None else "no text"
                    out.append((source, line, offset, layout, False, False, None, None, None, why))
                    continue
                try:
                    values, end = g.record(raw, 0)
                    if end == len(raw):
                        out.append((source, line, offset, layout, True, False, values, None, None, None))
                        continue
                    broken = Broken(end, len(g.columns), "text after the record's end")
                except Broken as e:
                    broken = e
                out.append((source, line, offset, layout, False, False, None, broken.column_no, broken.position, broken.message))
                for at, values, e in g.text(raw):
                    if e is not None and at == 0:  # the row's own error
                        continue
                    below = len(re.findall(r"\r\n|\r|\n", raw[:at]))
                    place = (source, None if line is None else line + below, None if offset is None else offset + len(raw[:at].encode()), layout)
                    out.append((*place, True, True, values, None, None, None) if e is None else (*place, False, True, None, e.column_no, e.position, e.message))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW.types, strict=True)] if out else [pa.array([], t) for t in _ARROW.types], schema=_ARROW)

    return rows.select("source_file", "line", "byte_offset", "layout", "raw").mapInArrow(run, PARSED)


def errors(parsed: DataFrame, version: int | None = None) -> DataFrame:
    """The rows that are not valid, as staging_errors rows, each once however often it was delivered; rows without line number are told apart by offset and reason."""
    return every_error(parsed.filter(~F.col("recovered")), version)


def every_error(parsed: DataFrame, version: int | None = None) -> DataFrame:
    """All located errors as staging_errors rows: those of errors(), and those found in a broken text after a resume.

    The latter have the line they stand on, which may be the number of a row of its own.
    """
    return (
        parsed.filter(~F.col("ok"))
        .groupBy("source_file", "line", F.when(F.col("recovered") | F.col("line").isNull(), F.struct("byte_offset", _reason())).alias("later"))
        .agg(F.min("byte_offset").alias("byte_offset"), F.min(_reason()).alias("message"))
        .select(F.lit(version).cast("long").alias("version"), "source_file", "line", "byte_offset", "message")
    )


def _reason() -> SqlColumn:
    return F.concat("message", F.when(F.col("position").isNotNull(), F.concat(F.lit(" at character "), F.col("position"))).otherwise(F.lit("")))


def records(parsed: DataFrame, layouts: DataFrame, layout: str, recovered: bool = False) -> DataFrame:
    """The valid rows of one layout with typed columns, besides source_file and line, each once.

    A layout column named source_file or line comes out as `<name>_value`. recovered=True adds the records found behind
    broken quotes.
    """
    g = grammars(layouts.filter(F.col("layout") == layout))[layout]
    rows = parsed.filter(F.col("ok") & (F.col("layout") == layout))
    if not recovered:
        rows = rows.filter(~F.col("recovered"))
    return rows.select("source_file", "line", "values").distinct().select("source_file", "line", *_typed(g))


def all_records(parsed: DataFrame, layouts: DataFrame) -> DataFrame:
    """(source_file, line, layout, recovered, <layout>_record...): the valid rows of every layout and the records recovered
    from broken texts, each once, in one parse.

    `<layout>_record` is a struct of the layout's typed columns, null in the rows of other layouts.
    """
    rows = parsed.filter("ok").select("source_file", "line", "layout", "recovered", "values").distinct()
    each = (F.when(F.col("layout") == name, F.struct(*_typed(g))).alias(f"{name}_record") for name, g in sorted(grammars(layouts).items()))
    return rows.select("source_file", "line", "layout", "recovered", *each)


def _typed(g: Grammar) -> list[SqlColumn]:
    kinds = {"long": "bigint", "double": "double", "boolean": "boolean", "string": "string"}
    names = [f"{c.name}_value" if c.name in ("source_file", "line") else c.name for c in g.columns]
    return [F.col("values")[i].cast(kinds[c.kind]).alias(n) for i, (c, n) in enumerate(zip(g.columns, names, strict=True))]


def file_rows(spark: SparkSession, path: str, layout: str, header: bool = True, encoding: str = "utf-8") -> DataFrame:
    """(source_file, line, byte_offset, layout, raw) of delimited files, as parse_rows takes them: a file or all files of a folder.

    A file is read as a stream of lines by one task. A line whose quotes are open goes on with the lines after it until they
    close; if they do not within MAX_ROW_LINES lines, the line stands alone (parse_rows names the error) and the next line
    begins anew. Line breaks at the end of a row do not belong to it; a blank line is a row of empty text.
    Bytes that the encoding does not know become replacement characters. path: a path or URI that all executors share.
    """
    uri = path if "://" in path else f"file://{path}"
    files, base = fs.FileSystem.from_uri(uri)
    found = files.get_file_info(base)
    names = [f.path for f in files.get_file_info(fs.FileSelector(base, recursive=True)) if f.is_file] if found.type == fs.FileType.Directory else [base]
    names = sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))
    parts = max(1, min(len(names), 10_000))

    def rows(name: str) -> Iterator[tuple]:
        system, _ = fs.FileSystem.from_uri(uri)
        waiting: deque[tuple[int, int, bytes]] = deque()
        with system.open_input_stream(name) as f:
            lines = enumerate(_lines(f), 1)
            at, ended = 0, False

            def more() -> bool:
                nonlocal at, ended
                got = None if ended else next(lines, None)
                ended = got is None
                if got:
                    waiting.append((got[0], at, got[1]))
                    at += len(got[1])
                return not ended

            if header:
                more()
                waiting.clear()
            while waiting or more():
                n, quotes = 1, waiting[0][2].count(b'"')
                while quotes % 2 and n < MAX_ROW_LINES and (n < len(waiting) or more()):
                    quotes += waiting[n][2].count(b'"')
                    n += 1
                n = 1 if quotes % 2 else n
                taken = [waiting.popleft() for _ in range(n)]
                raw = b"".join(t[2] for t in taken).decode(encoding, "replace").rstrip("\r\n")
                yield name, taken[0][0], taken[0][1], layout, raw

    schema = pa.schema([("source_file", pa.string()), ("line", pa.int64()), ("byte_offset", pa.int64()), ("layout", pa.string()), ("raw", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                it = rows(name)
                while part := list(itertools.islice(it, ROWS_PER_BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)

    listed = spark.createDataFrame([(n,) for n in names], "name string").repartition(parts)
    return listed.mapInArrow(run, "source_file string, line bigint, byte_offset bigint, layout string, raw string")


def _lines(f: pa.NativeFile) -> Iterator[bytes]:
    """The lines of a stream with their ends; a very long line is held, nothing else."""
    rest: list[bytes] = []
    while block := f.read(1 << 20):
        *whole, last = block.split(b"\n")
        for w in whole:
            rest.append(w + b"\n")
            yield b"".join(rest)
            rest.clear()
        if last:
            rest.append(last)
    if rest:
        yield b"".join(rest)
