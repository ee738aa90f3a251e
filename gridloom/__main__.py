"""python -m gridloom COMMAND ...: the engine's tasks from a shell. Settings of the session come from Spark's own configuration."""

from __future__ import annotations

import argparse
import datetime
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import runs
from gridloom.operators import register as rg
from gridloom.operators import staging
from gridloom.operators import topology as top
from gridloom.sources import catalog, classes, docexport, registerzip
from gridloom.sources.store import Store
from gridloom.usecases import Grid

#: Rows that a command prints at most; it says how many there are.
SHOWN = 50


def _show(df: DataFrame, title: str) -> None:
    print(f"{title}: {df.count()} rows")
    df.show(SHOWN, truncate=False)


def import_(spark: SparkSession, a: argparse.Namespace) -> None:
    store = Store(spark, a.store)
    run = {"cim": runs.run_cim, "nsc": runs.run_nsc, "documents1": lambda s, p: runs.run_documents(s, p, 1), "documents2": runs.run_documents}[a.kind]
    print(r := run(store, a.files))
    _show(store.errors().filter(F.col("version") == r.version).drop("version"), "errors")


def build(spark: SparkSession, a: argparse.Namespace) -> None:
    store = Store(spark, a.store)
    version = a.version or max(store.versions())
    runs.build_model(store, version)
    _show(store.model("anomaly").groupBy("message").count().orderBy(F.desc("count"), "message"), f"anomalies of version {version}")


def _grid(store: Store) -> Grid:
    points = staging.first_points(store.facts().filter(F.col("version") == store.current())).select("owner_id", F.lit("equipment").alias("owner_kind"), "lat", "lon")
    return Grid(store.model("container"), store.model("equipment"), store.model("node"), store.model("edge"), points)


def check(spark: SparkSession, a: argparse.Namespace) -> None:
    found = _grid(Store(spark, a.store)).violations(nsc=a.nsc, connectivity=a.connectivity)
    _show(found.groupBy("rule").count().orderBy("rule"), "rules")
    _show(found.orderBy("rule", "object_id"), "violations")


def circuits(spark: SparkSession, a: argparse.Namespace) -> None:
    _show(top.circuit_summary(Store(spark, a.store).model("edge")).orderBy(F.desc("n_nodes"), "circuit_id"), "circuits")


def connected(spark: SparkSession, a: argparse.Namespace) -> None:
    print(_grid(Store(spark, a.store)).electrically_connected(a.first, a.second))


def report(spark: SparkSession, a: argparse.Namespace) -> None:
    f = Store(spark, a.store).facts()
    _show(f.groupBy("version", "profile", "class").agg(F.countDistinct("id").alias("n_objects"), F.count(F.lit(1)).alias("n_facts")).orderBy("version", "profile", "class"), "facts")


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    store = Store(spark, a.store)
    facts = store.facts().filter(F.col("version") == store.current())
    walk = staging.attribute_walk(facts, store.model("equipment").select(F.lit(store.current()).cast("bigint").alias("version"), "id"))
    literals = facts.filter(~F.col("is_reference") & F.col("value").isNotNull())
    own = literals.select(F.col("id").alias("owner_id"), F.col("attribute").alias("key"), "value")
    one = literals.groupBy("id", "attribute").agg(F.min(F.struct("seq", "value"))["value"].alias("value")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("attribute", "value"))).alias("attributes"))
    kinds = facts.groupBy("id").agg(staging.object_class().alias("class"))
    sats = walk.select("owner_id", "id").join(kinds, "id").join(one, "id", "left").select("owner_id", F.xxhash64("id").alias("seq"), "class", F.coalesce("attributes", F.create_map().cast("map<string,string>")).alias("attributes"))
    docs = docexport.export(store.model("container"), store.model("equipment"), store.model("edge"), own, sats, dialect=a.dialect)
    docexport.write_tree(docs, a.folder)
    print(f"{docs.count()} documents")


def register_import(spark: SparkSession, a: argparse.Namespace) -> None:
    spark.dataSource.register(registerzip.RegisterZipSource)
    rows = spark.read.format("registerzip").load(a.zip)
    names = sorted(r.dataset for r in rows.select("dataset").distinct().collect())
    now = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rg.publish({n: registerzip.table_of(rows, n) for n in names}, a.folder, rg.metadata(spark, a.zip.rsplit("/", 1)[-1], now))
    _show(rows.filter("error IS NOT NULL").select("dataset", "chunk", "error"), "broken members")


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName(): spark.read.parquet(s.getPath().toString()) for s in fs.listStatus(p)}


def register_extract(spark: SparkSession, a: argparse.Namespace) -> None:
    tables = _tables(spark, a.folder)
    out = rg.extract(tables, [s for s in rg.register_stages(a.region) if s.table in tables])
    rg.publish(out, a.out, tables["meta"])
    _show(rg.row_counts(out), "tables")


def register_search(spark: SparkSession, a: argparse.Namespace) -> None:
    _show(rg.search_all({n: t for n, t in _tables(spark, a.folder).items() if n != "meta"}, a.term), "hits")


def scaffold(spark: SparkSession, a: argparse.Namespace) -> None:
    for r in classes.templates(classes.load(spark, a.folder)).filter(F.col("name").isin(*a.names)).orderBy("name").collect():
        print(r.text)


def catalog_import(spark: SparkSession, a: argparse.Namespace) -> None:
    entries = catalog.catalog(spark, a.folder)
    entries.write.mode("overwrite").parquet(a.out)
    _show(catalog.catalog_kinds(entries), "kinds")


def parser() -> argparse.ArgumentParser:
    top_ = argparse.ArgumentParser(prog="gridloom", description=__doc__)
    sub = top_.add_subparsers(required=True)

    def add(f, *args: str, name: str | None = None) -> argparse.ArgumentParser:
        p = sub.add_parser(name or f.__name__.rstrip("_").replace("_", "-"))
        p.set_defaults(run=f)
        for x in args:
            p.add_argument(x)
        return p

    add(import_, "store").add_argument("kind", choices=["cim", "nsc", "documents1", "documents2"])
    sub.choices["import"].add_argument("files")
    add(build, "store").add_argument("--version", type=int)
    c = add(check, "store")
    c.add_argument("--nsc", action="store_true")
    c.add_argument("--connectivity", action="store_true")
    add(circuits, "store")
    add(connected, "store", "first", "second")
    add(report, "store")
    add(export, "store", "folder").add_argument("--dialect", type=int, choices=[1, 2], default=2)
    add(register_import, "zip", "folder")
    add(register_extract, "folder", "out").add_argument("region", nargs="+")
    add(register_search, "folder", "term")
    add(scaffold, "folder").add_argument("names", nargs="+")
    add(catalog_import, "folder", "out")
    return top_


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    a.run(spark or SparkSession.builder.appName("gridloom").config("spark.sql.session.timeZone", "UTC").getOrCreate(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
