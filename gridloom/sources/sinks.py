"""Versioned writing: facts by version, last value per key, whole owners replaced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def write_facts(facts: DataFrame, path: str, mode: str = "append") -> None:
    """Facts as Parquet, a folder per version; clustered by class so that a class is read from few files."""
    facts.sortWithinPartitions("class", "id").write.partitionBy("version").mode(mode).parquet(path)


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace just those partitions of a table that df has rows of (a version, an owner)."""
    df.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def last_per_key(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Upsert: of old and new rows the one of the greatest `order` per key, new before old if equal; keys compare null-safe.

    The aggregate is partial on the map side: a key delivered very often is no hot group.
    """
    rest = [c for c in old.columns if c not in keys]
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    top = both.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("_o"), F.col("_new"), *(F.col(c).alias(f"v_{c}") for c in rest))).alias("t"))
    return top.select(*keys, *(F.col(f"t.v_{c}").alias(c) for c in rest)).select(*old.columns)


def upsert_attributes(old: DataFrame, new: DataFrame, arrival: str) -> DataFrame:
    """(owner_id, key, seq, value): what a call gives replaces all that its (owner_id, key) had; seq is the arrival index in the call.

    old: owner_id, key, seq, value; new: owner_id, key, value and the column `arrival`, their order. Values are stored as
    JSON. Keys that the call does not name stay.
    """
    by = Window.partitionBy("owner_id", "key").orderBy(arrival, "value")
    fresh = new.select("owner_id", "key", (F.row_number().over(by) - 1).cast("int").alias("seq"), F.when(F.col("value").isNull(), F.lit("null")).otherwise(F.expr("substring(to_json(named_struct('v', value)), 6, length(to_json(named_struct('v', value))) - 6)")).alias("value"))
    kept = old.join(new.select("owner_id", "key").distinct(), ["owner_id", "key"], "left_anti")
    return kept.select("owner_id", "key", F.col("seq").cast("int").alias("seq"), "value").unionByName(fresh)
