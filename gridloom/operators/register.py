"""Questions on register tables: paged reads, free-text search, regional extract, wide rows from maps."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.scalar import dump_date, dump_version, from_rfc3339, like_text, rfc3339
from gridloom.operators.skew import salted_join

#: Tables of the market register: units with a region, kinds of supported plants, catalogs; and the column of areas at sea.
UNIT_TABLES = tuple(f"Einheiten{k}" for k in "Wind Solar Biomasse Wasser Verbrennung StromSpeicher StromVerbraucher GasErzeuger Gasverbraucher GasSpeicher Kernkraft GeothermieGrubengasDruckentspannung".split())
PLANT_KINDS = ("Wind", "Solar", "Biomasse", "Wasser", "GeothermieGrubengasDruckentspannung")
CATALOG_TABLES = ("Katalogkategorien", "Katalogwerte", "Lokationstypen", "Marktfunktionen", "Marktrollen", "Einheitentypen", "Bilanzierungsgebiete", "Netze")
SEA_AREA = "GebietNachDemFlaechenentwicklungsplanNordsee"
#: Columns that a table made from maps may have; the key set is schema, not data.
MAX_COLUMNS = 10_000


def _known(df: DataFrame, columns: Sequence[str]) -> None:
    lower = {c.lower() for c in df.columns}
    for c in columns:
        if c.lower() not in lower:
            raise ValueError(f"no column {c}")


def identifier(name: str) -> str:
    """The name, if it is made of ASCII letters, digits and underscores and begins with no digit."""
    if not re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"{name!r} is no identifier")
    return name


def table_of(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    if identifier(name) not in tables:
        raise ValueError(f"no table {name}")
    return tables[name]


def columns_of(tables: Mapping[str, DataFrame], name: str) -> list[str]:
    return table_of(tables, name).columns


def page(df: DataFrame, equal: Mapping[str, object], order: str, limit: int, offset: int = 0) -> DataFrame:
    """Rows in which every named column has its value, in `order`, a page of them."""
    _known(df, [*equal, order])
    for c, v in equal.items():
        df = df.filter(F.col(f"`{c}`") == F.lit(v)) if v is not None else df.filter(F.col(f"`{c}`").isNull())
    return df.orderBy(order).offset(offset).limit(limit)


def matches(df: DataFrame, term: str) -> Column:
    """Whether any column's text contains the term in any letter case; `%`, `_` and `\\` are ordinary characters."""
    found = F.lit(False)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        found = found | F.coalesce(like_text(c if isinstance(f.dataType, T.StringType) else F.to_json(c) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string"), term), F.lit(False))
    return found


def search(df: DataFrame, term: str) -> DataFrame:
    """All rows of a table that contain the term in some column. An empty term is refused."""
    if not term:
        raise ValueError("empty search term")
    return df.filter(matches(df, term))


def search_all(tables: Mapping[str, DataFrame], term: str) -> DataFrame:
    """(table, row): the hits of every table, a row as JSON without its null fields; tables without hits give no rows."""
    out = None
    for name, df in sorted(tables.items()):
        one = search(df, term).select(F.lit(name).alias("table"), F.to_json(F.struct(*(f"`{c}`" for c in df.columns))).alias("row"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no tables")
    return out


def referenced(sources: Sequence[tuple[DataFrame, str]], as_: str) -> DataFrame:
    """The different non-empty keys that any of the columns holds: the next stage of a cascade."""
    out = None
    for df, c in sources:
        one = df.select(F.col(c).alias(as_)).filter(F.col(as_).isNotNull() & (F.col(as_).cast("string") != ""))
        out = one if out is None else out.union(one)
    return out.distinct()


def kept(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is among `keys` (one column)."""
    k = keys.columns[0]
    return salted_join(df.withColumnRenamed(column, "_k") if column != "_k" else df, keys.select(F.col(k).alias("_k")), ["_k"], "left_semi").withColumnRenamed("_k", column)


@dataclass(frozen=True)
class Stage:
    """A table of an extract: whose `column` is among the values of (table, column) sources, or `where`, or whole if neither is given."""

    table: str
    column: str | None = None
    sources: tuple[tuple[str, str], ...] = ()
    where: Callable[[DataFrame], Column] | None = None


def in_regions(column: str, regions: Sequence[str], also: str | None = None) -> Callable[[DataFrame], Column]:
    """Rows of the regions, or with any text in the column `also` (units at sea have an area there instead of a region); an absent column holds nothing."""

    def where(df: DataFrame) -> Column:
        found = F.coalesce(F.col(column).isin(*regions), F.lit(False)) if column in df.columns else F.lit(False)
        return found | F.coalesce(F.col(also) != "", F.lit(False)) if also and also in df.columns else found

    return where


def extract(tables: Mapping[str, DataFrame], stages: Sequence[Stage]) -> dict[str, DataFrame]:
    """The tables of an extract, stage by stage; a stage may ask for tables of the ones before it.

    A source that is not there, or whose column a table does not have, counts as empty (register tables differ from dump to dump). Keys are
    removed of repetitions before they are joined; empty keys refer to nothing.
    """
    out: dict[str, DataFrame] = {}
    for s in stages:
        df = table_of(tables, s.table)
        if s.where is not None:
            df = df.filter(s.where(df))
        elif s.column is not None:
            found = [(out[t], c) for t, c in s.sources if t in out and c in out[t].columns]
            df = kept(df, s.column, referenced(found, "k")) if found and s.column in df.columns else df.limit(0)
        out[s.table] = df
    return out


def register_stages(regions: Sequence[str]) -> list[Stage]:
    """The stages of the market register's regional extract: units by region, then their plants, places, actors and roles; catalogs whole."""
    units, plants = UNIT_TABLES, [Stage(f"AnlagenEeg{k}", "EegMaStRNummer", ((f"Einheiten{k}", "EegMaStRNummer"),)) for k in PLANT_KINDS]
    every = lambda c: tuple((t, c) for t in units)
    return [
        *(Stage(t, where=in_regions("Landkreis", regions, SEA_AREA if t == "EinheitenWind" else None)) for t in units),
        *plants,
        Stage("AnlagenKwk", "KwkMastrNummer", tuple((f"Einheiten{k}", "KwkMaStRNummer") for k in ("Biomasse", "Verbrennung", "GeothermieGrubengasDruckentspannung"))),
        Stage("AnlagenGasSpeicher", "MaStRNummer", (("EinheitenGasSpeicher", "SpeicherMaStRNummer"), ("EinheitenGasErzeuger", "SpeicherMaStRNummer"))),
        Stage("AnlagenStromSpeicher", "MaStRNummer", (("EinheitenStromSpeicher", "SpeMastrNummer"),)),
        Stage("Lokationen", "MastrNummer", every("LokationMaStRNummer")),
        Stage("Netzanschlusspunkte", "LokationMaStRNummer", (("Lokationen", "MastrNummer"),)),
        Stage("Marktakteure", "MastrNummer", (*every("AnlagenbetreiberMastrNummer"), *every("AltAnlagenbetreiberMastrNummer"), ("Netzanschlusspunkte", "NetzbetreiberMaStRNummer"))),
        Stage("MarktakteureUndRollen", "MarktakteurMastrNummer", (("Marktakteure", "MastrNummer"),)),
        *map(Stage, CATALOG_TABLES),
    ]


def metadata(spark: SparkSession, file_name: str, imported_at: str) -> DataFrame:
    """(source_file, source_date, source_version, imported_at): the one row that says what a register was imported from; times as RFC 3339 texts.

    Raises if the file name is none of a register dump or imported_at none such time.
    """
    row = spark.createDataFrame([(file_name, imported_at)], "source_file string, at string")
    out = row.select("source_file", rfc3339(dump_date(F.col("source_file")).cast("timestamp")).alias("source_date"), dump_version(F.col("source_file")).alias("source_version"), rfc3339(from_rfc3339(F.col("at"))).alias("imported_at"))
    got = out.first()
    if got.source_date is None or got.imported_at is None:
        raise ValueError(f"{file_name}: no name of a register dump, or {imported_at}: no time")
    return out


def publish(tables: Mapping[str, DataFrame], path: str, meta: DataFrame) -> None:
    """Write an extract or import with its metadata beside its place, then move it there; a folder of that name is replaced."""
    spark = meta.sparkSession
    new = f"{path}.new"
    for name, df in {**tables, "meta": meta}.items():
        df.write.mode("overwrite").parquet(f"{new}/{identifier(name)}")
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at(path), True)
    if not fs.rename(at(new), at(path)):
        raise OSError(f"could not move {new} to {path}")


def geocode(addresses: DataFrame, places: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Addresses with lat and lon of the place (keys, lat, lon) that has the same keys, whatever case and blanks; the least of several, null if none.

    A look-up table takes the place of a search service; a key that is null or blank matches nothing.
    """
    plain = lambda c: F.nullif(F.lower(F.regexp_replace(F.trim(c), r"\s+", " ")), F.lit(""))
    marks = {f"_k{i}": plain(F.col(k)) for i, k in enumerate(keys)}
    known = places.withColumns(marks).dropna(subset=list(marks)).groupBy(*marks).agg(F.min(F.struct("lat", "lon")).alias("_p"))
    return salted_join(addresses.withColumns(marks), known, list(marks), "left").select(*addresses.columns, F.col("_p.lat").alias("lat"), F.col("_p.lon").alias("lon"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n_rows) of every table and of all together (`total`)."""
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        out = one if out is None else out.union(one)
    return out.union(out.agg(F.sum("n_rows").alias("n_rows")).select(F.lit("total").alias("table"), "n_rows"))


def map_to_columns(df: DataFrame, column: str = "fields") -> DataFrame:
    """A map column as columns, one per key whatever its letter case; of keys that differ in case the first in order fills it."""
    keys = df.select(F.explode(F.map_keys(column)).alias("k")).groupBy(F.lower("k").alias("low")).agg(F.min("k").alias("name"), F.sort_array(F.collect_set("k")).alias("all")).limit(MAX_COLUMNS + 1).collect()
    if len(keys) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    rest = [c for c in df.columns if c != column]
    cols = [F.coalesce(*(F.col(column)[k] for k in r["all"])).alias(r["name"]) for r in sorted(keys, key=lambda r: r.low)]
    return df.select(*rest, *cols)


def union_wide(frames: Sequence[DataFrame]) -> DataFrame:
    """Tables with different columns one below the other, absent columns null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())
