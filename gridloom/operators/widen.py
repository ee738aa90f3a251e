"""Entity-attribute-value rows into wide tables with typed columns."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.skew import hot_keys

#: Values, filled or not, that one block of entities by columns holds: about 8 MB for a table of numbers.
BLOCK_VALUES = 1_000_000
#: More attributes than this make no table; the caller has to name those it wants.
MAX_COLUMNS = 5_000

LONG, DOUBLE = r"^-?[0-9]+$", r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
KINDS = {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "string": T.StringType()}
_NUMPY = {"long": (np.int64, pa.int64()), "double": (np.float64, pa.float64()), "boolean": (np.bool_, pa.bool_()), "date": (np.int32, pa.date32()), "string": (object, pa.string())}


def fits(value: Column, kind: Column) -> Column:
    """Whether a trimmed text is a literal of the type named in `kind`."""
    day = value.try_cast("date")
    return (
        F.when(kind == "long", value.rlike(LONG) & value.try_cast("bigint").isNotNull())
        .when(kind == "double", value.rlike(DOUBLE) & (F.abs(value.try_cast("double")) < F.lit(math.inf)))
        .when(kind == "boolean", F.lower(value).isin("true", "false"))
        .when(kind == "date", value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & ~value.startswith("0000") & day.isNotNull())
        .otherwise(F.lit(True))
    )


def blank_trimmed(value: Column) -> Column:
    return F.regexp_replace(value, r"^[\s\x{00A0}]+|[\s\x{00A0}]+$", "")


def _judged(facts: DataFrame, types: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Every fact as a state of its cell (see cells): first, any, own, some."""
    kinds = types.filter(F.col("attribute").isNotNull()).groupBy("attribute").agg(F.min("value_type").alias("kind"))
    rows = facts.join(kinds, "attribute", "left").withColumn("kind", F.coalesce("kind", F.lit("string")))
    typed = F.col("kind") != "string"
    text = F.when(typed, blank_trimmed(F.col("value"))).otherwise(F.col("value"))
    rows = rows.select(*entity, "attribute", "class", "kind", "seq", text.alias("text"))
    there = F.col("text").isNotNull() & (F.col("text") != "")
    good = there & fits(F.col("text"), F.col("kind"))
    own = F.when(F.col("class") != "Equipment", F.col("class"))
    return rows.select(*entity, "attribute", "kind", F.when(good, F.struct("seq", "text")).alias("first"), F.coalesce(there, F.lit(False)).alias("any"), own.alias("own"), F.col("class").alias("some"))


def _merged(states: DataFrame, by: Sequence[str]) -> DataFrame:
    return states.groupBy(*by, "attribute", "kind").agg(F.min("first").alias("first"), F.bool_or("any").alias("any"), F.min("own").alias("own"), F.min("some").alias("some"))


def cells(facts: DataFrame, types: DataFrame, entity: Sequence[str] = ("version", "id"), partitions: int | None = None) -> DataFrame:
    """One row per (entity, attribute): the value that goes into the table and whether every value was badly typed.

    Of the values that fit the attribute's type the one of the least (seq, value) is taken; a null seq comes first, null
    and empty values are no values (a string attribute's empty value neither). `bad` says that there are values and none of
    them fits. Attributes not in `types` are strings; of an attribute listed twice the least type counts.

    The facts are shuffled once, to hash buckets of entities, and merged there. The facts of an entity with very many of
    them (repeated rows, many values of a key) are merged before, by cell and on the map side, so that what reaches its
    bucket are at most its cells.
    """
    entity = list(entity)
    states = _judged(facts, types, entity)
    hot = hot_keys(facts, entity).select(*(F.col(k).alias(f"_h_{k}") for k in entity), F.lit(True).alias("_hot"))
    same = F.lit(True)
    for k in entity:
        same = same & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    marked = states.join(F.broadcast(hot), same, "left").drop(*(f"_h_{k}" for k in entity))
    few = marked.filter(F.col("_hot").isNull()).drop("_hot")
    many = _merged(marked.filter("_hot").drop("_hot"), entity).select(*few.columns)
    parts = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = _merged(few.unionByName(many).repartition(parts, *entity), entity)
    return merged.select(*entity, "attribute", "kind", F.col("first.text").alias("value"), (F.col("any") & F.col("first").isNull()).alias("bad"), F.coalesce("own", "some").alias("class"))


def widen(facts: DataFrame, types: DataFrame, entity: Sequence[str] = ("version", "id"), attributes: Sequence[str] | None = None) -> DataFrame:
    """One row per entity: its keys, `class`, `bad_attributes` and one typed column per attribute.

    facts: entity keys, class, attribute, value, seq; other columns may be there and are ignored. The attributes are those
    that occur, in name order, or the given ones. A column whose name is taken (class, version, ...) gets the suffix
    `_value`. An entity all of whose values are null has a row of nulls; a fact with a null attribute makes its entity known
    but fills no column; null keys form an entity of their own. `class` is the least class other than Equipment.
    `bad_attributes` names, sorted, the typed attributes that have values of which none fits.

    Method: the cells (see cells) come hash-bucketed by entity and are sorted by it within their bucket. Block by block of
    entities, so many that entities times columns stay under BLOCK_VALUES, entities and attributes are dictionary-encoded,
    the values scattered by (row, column) into one numpy array per type, and Arrow tables emitted.
    """
    entity = list(entity)
    one = cells(facts, types, entity)
    if attributes is None:
        found = facts.select("attribute").filter(F.col("attribute").isNotNull()).distinct().limit(MAX_COLUMNS + 1).collect()
        if len(found) > MAX_COLUMNS:
            raise ValueError(f"more than {MAX_COLUMNS} attributes: name those wanted")
        attributes = sorted(r.attribute for r in found)
    attributes = list(attributes)
    types_rows = types.filter(F.col("attribute").isin(attributes)).groupBy("attribute").agg(F.min("value_type").alias("kind")).collect()
    kind_of = {a: "string" for a in attributes} | {r.attribute: r.kind for r in types_rows}
    schema = facts.schema
    taken = {*entity, "class", "bad_attributes"}
    names = [f"{a}_value" if a in taken else a for a in attributes]
    out = T.StructType(
        [schema[k] for k in entity] + [T.StructField("class", T.StringType()), T.StructField("bad_attributes", T.ArrayType(T.StringType()))] + [T.StructField(n, KINDS[kind_of[a]]) for a, n in zip(attributes, names, strict=True)]
    )
    rows_at_once = max(1, BLOCK_VALUES // max(1, len(attributes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, entity, rows_at_once):
            yield from _scatter(block, entity, attributes, names, kind_of).to_batches()

    return one.sortWithinPartitions(*entity).mapInArrow(run, out)


def _starts(t: pa.Table, entity: list[str]) -> np.ndarray:
    """Whether a row's entity differs from that of the row before; the first row's does."""
    new = np.zeros(t.num_rows, dtype=bool)
    new[:1] = True
    for k in entity:
        code = _one(t.column(k)).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return new


def _blocks(batches: Iterator[pa.RecordBatch], entity: list[str], rows_at_once: int) -> Iterator[pa.Table]:
    """Tables of whole entities, at most rows_at_once of them, from batches sorted by entity."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        first = np.flatnonzero(_starts(held, entity))
        at = 0
        # The last entity may go on in the next batch.
        while at + rows_at_once < len(first):
            yield held.slice(first[at], first[at + rows_at_once] - first[at])
            at += rows_at_once
        held = held.slice(first[at]) if at else held
    if held is not None and held.num_rows:
        first = np.flatnonzero(_starts(held, entity))
        for at in range(0, len(first), rows_at_once):
            end = first[at + rows_at_once] if at + rows_at_once < len(first) else held.num_rows
            yield held.slice(first[at], end - first[at])


def _scatter(t: pa.Table, entity: list[str], attributes: list[str], names: list[str], kind_of: dict[str, str]) -> pa.Table:
    """One block of cells, sorted by entity, as a wide table."""
    new = _starts(t, entity)
    first = np.flatnonzero(new)
    row, n = np.cumsum(new) - 1, len(first)
    no_of = {a: i for i, a in enumerate(attributes)}
    attribute = _one(t.column("attribute")).dictionary_encode()
    to_column = np.array([no_of.get(a, -1) for a in attribute.dictionary.to_pylist()] + [-1], dtype=np.int64)
    column = to_column[attribute.indices.fill_null(len(to_column) - 1).to_numpy(zero_copy_only=False)]
    value = _one(t.column("value"))
    filled = value.is_valid().to_numpy(zero_copy_only=False) & (column >= 0)

    by_type: dict[str, list[int]] = {}
    for a in attributes:
        by_type.setdefault(kind_of[a], []).append(no_of[a])
    arrays: list[pa.Array | None] = [None] * len(attributes)
    for kind, members in by_type.items():
        slot = np.full(len(attributes) + 1, -1)
        slot[members] = np.arange(len(members))
        mine = np.flatnonzero(filled & (slot[column] >= 0))
        at = (slot[column[mine]], row[mine])
        dtype, arrow = _NUMPY[kind]
        present = np.zeros((len(members), n), dtype=bool)
        data = np.zeros((len(members), n), dtype=dtype)
        present[at] = True
        data[at] = _parse(value.take(pa.array(mine)), kind)
        for i, m in enumerate(members):
            if not present[i].any():
                arrays[m] = pa.nulls(n, arrow)
            elif kind == "string":
                arrays[m] = pa.array(np.where(present[i], data[i], None), arrow)
            else:
                arrays[m] = pa.array(data[i], mask=~present[i]).cast(arrow)

    # The least class that is not Equipment, else the least: classes are ranked, Equipment behind all others.
    classes = _one(t.column("class")).dictionary_encode()
    ranked = sorted(classes.dictionary.to_pylist(), key=lambda c: (c == "Equipment", c))
    none = len(ranked)
    rank = np.array([ranked.index(c) for c in classes.dictionary.to_pylist()] + [none], dtype=np.int64)[classes.indices.fill_null(none).to_numpy(zero_copy_only=False)]
    least = np.minimum.reduceat(rank, first) if n else rank
    bad_rows = np.flatnonzero(_one(t.column("bad")).to_numpy(zero_copy_only=False).astype(bool) & (column >= 0))
    order = np.array(sorted(range(len(attributes)), key=lambda i: attributes[i]), dtype=np.int64)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    bad_rows = bad_rows[np.lexsort((place[column[bad_rows]], row[bad_rows]))]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row[bad_rows], minlength=n))]).astype(np.int32)
    bad = pa.ListArray.from_arrays(pa.array(offsets), pa.array(attributes, pa.string()).take(pa.array(column[bad_rows])))
    keys = [_one(t.column(k)).take(pa.array(first)) for k in entity]
    cols = [*keys, pa.array([*ranked, None], pa.string()).take(pa.array(least)), bad]
    return pa.Table.from_arrays(cols + arrays, names=[*entity, "class", "bad_attributes", *names])


def _one(c: pa.ChunkedArray) -> pa.Array:
    c = c.combine_chunks()
    return c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type)


def _parse(texts: pa.Array, kind: str) -> np.ndarray:
    """Literals that are known to fit, as numpy values; Arrow casts them all at once."""
    if kind == "string":
        return texts.to_numpy(zero_copy_only=False)
    arrow = _NUMPY[kind][1]
    values = texts.cast(arrow)
    return (values.cast(pa.int32()) if kind == "date" else values).to_numpy(zero_copy_only=False)
