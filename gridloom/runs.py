"""Import runs: files of a kind into a store, under a version of their own, with the errors of each file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import containers, staging
from gridloom.operators.terminals import nsc_facts
from gridloom.session import cut
from gridloom.sources import docexport, documents, rdfxml
from gridloom.sources.store import Store


@dataclass(frozen=True)
class Result:
    version: int
    n_facts: int
    n_errors: int


class DuplicateIds(ValueError):
    """The same object is defined by several files; example ids and their number of files."""


def _stored(store: Store, version: int, facts: DataFrame, errors: DataFrame) -> Result:
    store.write_facts(facts, version)
    store.write_errors(errors, version)
    mine = lambda df: df.filter(F.col("version") == version).count()
    return Result(version, mine(store.facts()), mine(store.errors()))


def _parsed(spark: SparkSession, paths: str, version: int) -> tuple[DataFrame, DataFrame]:
    spark.dataSource.register(rdfxml.GridXmlSource)
    return rdfxml.split(cut(spark.read.format("gridxml").option("version", version).load(paths)))


def run_cim(store: Store, paths: str) -> Result:
    """CIM RDF/XML files: a file that breaks off keeps the facts before the error and is named in the errors; the others go on."""
    version = store.reserve_version()
    facts, errors = _parsed(store.spark, paths, version)
    return _stored(store, version, facts, errors)


def run_nsc(store: Store, paths: str) -> Result:
    """Files of the second dialect: like run_cim, with terminals counted from 1 and busbars split by terminal.

    An object that two files define ends the run before anything is stored, whatever the files' profiles.
    """
    version = store.reserve_version()
    facts, errors = _parsed(store.spark, paths, version)
    twice = rdfxml.duplicate_ids(facts, by_profile=False).orderBy("id").limit(5).collect()
    if twice:
        raise DuplicateIds(", ".join(f"{r.id} in {r.n_files} files" for r in twice))
    return _stored(store, version, nsc_facts(facts), errors)


def run_documents(store: Store, tree: str | DataFrame, dialect: int = 2) -> Result:
    """A tree of documents (a folder, or a frame of file_id, path and body)."""
    version = store.reserve_version()
    files = tree if isinstance(tree, DataFrame) else docexport.read_tree(store.spark, tree)
    return _stored(store, version, *documents.facts_and_errors(files, version, dialect))


def build_model(store: Store, version: int) -> None:
    """Build the model of an imported version and make it the current one; anomalies are a table of it."""
    facts = store.facts().filter(F.col("version") == version)
    store.publish(version, {k: v.drop("version") for k, v in containers.build(facts, staging.switch_states).items()})
