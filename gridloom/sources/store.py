"""A store of imports and models in one folder: versions, facts, errors, flags, published models.

    <path>/versions/<n>             reserved version numbers
    <path>/facts|errors|flags/version=<n>/...
    <path>/model/<n>/<table>        a published model, all tables of it
    <path>/CURRENT                  the version whose model is the current one

A version number is reserved by creating its file, which only one of several runs can do. A model becomes current by one
rename of the pointer when all of its tables are written, so that readers see the old or the new one, never a mixture.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACTS = "id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"
ERRORS = "source_file string, line bigint, byte_offset bigint, message string"
FLAGS = "kind string, id string"


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Files

    def _at(self, name: str):  # noqa: ANN202
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _remove(self, name: str) -> None:
        fs, p = self._at(name)
        fs.delete(p, True)

    # Versions

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._names("versions") if n.isdigit())

    def reserve_version(self) -> int:
        """A version number that no other run has or ever had, deleted ones included."""
        n = max(self.versions(), default=0)
        while True:
            n += 1
            fs, p = self._at(f"versions/{n}")
            fs.mkdirs(p.getParent())
            try:
                if fs.createNewFile(p):
                    return n
            except Exception as e:  # another run was first
                if not fs.exists(p):
                    raise e

    def delete_version(self, version: int) -> None:
        """Facts, errors, flags and model of a version; the number stays taken. The current model cannot be deleted."""
        if self.current() == version:
            raise ValueError(f"version {version} is the current model")
        for name in (f"facts/version={version}", f"errors/version={version}", f"flags/version={version}", f"model/{version}"):
            self._remove(name)

    # Facts, errors and flags

    def _write(self, df: DataFrame, table: str, version: int, mode: str) -> None:
        df.write.mode(mode).parquet(f"{self.path}/{table}/version={version}")

    def _read(self, table: str, columns: str) -> DataFrame:
        if not self._names(table):
            return self.spark.createDataFrame([], f"version bigint, {columns}")
        df = self.spark.read.schema(f"{columns}, version bigint").parquet(f"{self.path}/{table}")
        return df.select("version", *(c.split()[0] for c in columns.split(", ")))

    def write_facts(self, facts: DataFrame, version: int) -> None:
        """All facts of a version, clustered by class so that a class is read from few files; written again they replace the old ones."""
        cols = [c.split()[0] for c in FACTS.split(", ")]
        self._write(facts.select(*cols).sortWithinPartitions("class", "id"), "facts", version, "overwrite")

    def facts(self) -> DataFrame:
        return self._read("facts", FACTS)

    def write_errors(self, errors: DataFrame, version: int) -> None:
        """Errors of a version; columns that they do not have are null."""
        kinds = dict(c.split() for c in ERRORS.split(", "))
        cols = [F.col(c).cast(t).alias(c) if c in errors.columns else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
        self._write(errors.select(*cols), "errors", version, "append")

    def errors(self) -> DataFrame:
        return self._read("errors", ERRORS)

    def mark(self, version: int, kind: str, ids: DataFrame) -> None:
        """Set a flag on ids (column id); set again it stays set."""
        self._write(ids.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id")).dropna().distinct(), "flags", version, "append")

    def flags(self, version: int, kind: str) -> DataFrame:
        return self._read("flags", FLAGS).filter((F.col("version") == version) & (F.col("kind") == kind)).select("id").distinct()

    def unmarked(self, version: int, kind: str, ids: DataFrame) -> DataFrame:
        """Those of ids (column id) without the flag."""
        return ids.join(self.flags(version, kind), "id", "left_anti")

    def flag_page(self, version: int, kind: str, after: str, size: int) -> DataFrame:
        """The next `size` flagged ids after an id, in order."""
        return self.flags(version, kind).filter(F.col("id") > after).orderBy("id").limit(size)

    def clear_flags(self, version: int) -> None:
        self._remove(f"flags/version={version}")

    # Models

    def publish(self, version: int, tables: Mapping[str, DataFrame]) -> None:
        """Write all tables of a model, then make it the current one."""
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/model/{version}/{name}")
        self._swap(str(version))

    def _swap(self, text: str) -> None:
        fs, new = self._at("CURRENT.new")
        out = fs.create(new, True)
        out.write(bytearray(text.encode()))
        out.close()
        _, now = self._at("CURRENT")
        # FileContext renames over an existing file in one step; FileSystem.rename refuses to.
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(new), fs.makeQualified(now), options)

    def current(self) -> int | None:
        fs, p = self._at("CURRENT")
        if not fs.exists(p):
            return None
        return int(self.spark.read.text(f"{self.path}/CURRENT", wholetext=True).first().value.strip())

    def model(self, name: str, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        if version is None:
            raise ValueError("no model is published")
        return self.spark.read.parquet(f"{self.path}/model/{version}/{name}")

    def model_tables(self, version: int | None = None) -> list[str]:
        version = self.current() if version is None else version
        return sorted(self._names(f"model/{version}"))


def read_jdbc(spark: SparkSession, url: str, name: str, key: str | None = None, parts: int = 1, **options: str) -> DataFrame:
    """A table of a database; with a numeric key in `parts` ranges of it, read side by side."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if key:
        lo, hi = spark.read.format("jdbc").option("url", url).option("query", f"SELECT min({key}) AS lo, max({key}) AS hi FROM {name}").options(**options).load().first()
        if lo is not None:
            r = r.option("partitionColumn", key).option("lowerBound", lo).option("upperBound", hi + 1).option("numPartitions", parts)
    return r.load()


def attach(spark: SparkSession, namespace: str, path: str) -> list[str]:
    """Make the Parquet tables of a folder views `<namespace>_<table>`, beside those of other folders; their names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", ".")))
    names = []
    for f in found:
        name = f"{namespace}_{f.removesuffix('.parquet')}"
        spark.read.parquet(f"{path}/{f}").createOrReplaceTempView(name)
        names.append(name)
    return names


def by_ids(df: DataFrame, column: str, ids: Sequence[object] | DataFrame) -> DataFrame:
    """Rows whose column is one of the ids; unknown ids are silently absent, repeated ones count once.

    Ids as a list go into the scan as a pushed filter; ids as a frame (one column) are joined.
    """
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column, "left_semi").select(*df.columns)
    return df.filter(F.col(column).isin(*ids)) if ids else df.limit(0)
