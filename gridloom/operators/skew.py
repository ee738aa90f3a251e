"""Joins and running totals that stay balanced when a few keys hold most rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import cut

#: Keys that are taken for hot at most (about 10 MB to broadcast); every key with more than 1 / HOT_KEYS of all rows is one of them.
HOT_KEYS = 100_000
#: Rows of a key that one task should get: never fewer than the first number, never more than the second.
TASK_ROWS, TASK_ROWS_MOST = 10_000, 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], most: int = HOT_KEYS, least: int = TASK_ROWS) -> DataFrame:
    """The keys whose rows should not meet in one task: keys, their number of rows (`_n`) and over how many tasks to spread them (`_salts`).

    A salt should get a quarter of a task's even share of the frequent keys' rows, so that salts which meet in a task do no harm,
    within TASK_ROWS and TASK_ROWS_MOST; a key with more
    is hot and has as many salts as that takes, so a key's salts grow with its rows. Every key that holds more than 1/most
    of all rows is looked at, and there are never more than `most`: the result may be broadcast at any size of df. Counting
    is partial on the map side, so a hot key costs one row per task. Nothing runs before the plan that uses it does.
    """
    return hot_of(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, most, least)


def hot_of(counts: DataFrame, keys: Sequence[str], most: int = HOT_KEYS, least: int | None = None) -> DataFrame:
    """hot_keys from counts that are there already: keys and `_n`."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = hot_keys.__defaults__[1] if least is None else least
    top = counts.filter(F.col("_n") >= least).orderBy(F.desc("_n"), *keys).limit(most)
    frequent = F.sum("_n").over(Window.partitionBy(F.lit(1)))  # over `most` rows
    share = F.greatest(F.lit(least), F.least(F.lit(max(least, TASK_ROWS_MOST)), F.ceil(frequent / (4 * parts))))
    return top.withColumn("_salts", F.ceil(F.col("_n") / share).cast("int")).filter(F.col("_salts") > 1)


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", extra: Column | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join in which the left rows of hot keys are spread over tasks, the more the more rows a key has.

    Left rows with a hot key get a salt from a hash of the whole row; right rows with a hot key are repeated once per salt.
    Right should have few rows per key. how: inner, left, left_semi or left_anti. Null keys match nothing. `extra` may
    name columns of both sides; the key columns come out once, from the left. hot: the result of hot_keys, where the caller
    has it already. With no hot key it is a plain join.
    """
    on = list(on)
    hot = hot if hot is not None else hot_keys(left.filter(F.col(on[0]).isNotNull()), on)
    marks = hot.select(*on, "_salts")
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*left.columns), F.col("_salts"))).otherwise(F.lit(0)).cast("int")
    copies = F.when(F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    a = left.join(F.broadcast(marks), on, "left").withColumn("_salt", salt).select(*left.columns, "_salt")
    b = right.join(F.broadcast(marks), on, "left").withColumn("_salt", F.explode(copies)).select(*right.columns, "_salt")
    b = b.withColumnsRenamed({k: f"_r_{k}" for k in [*on, "_salt"]})
    same = a["_salt"] == b["_r__salt"]
    for k in on:
        same = same & (a[k] == b[f"_r_{k}"])
    if extra is not None:
        same = same & extra
    return a.join(b, same, how).drop("_salt", "_r__salt", *(f"_r_{k}" for k in on))


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str | None = None, rows_per_bucket: int = 50_000, total: int | None = None) -> DataFrame:
    """Add `_rank` (from 0) and, with a weight, `_before` (weight of the earlier rows) within each group, in a fixed mixed order.

    The order is that of a hash bucket and then of `order` in the bucket, so that no group is sorted in one task: a task
    sees one (group, bucket) of about rows_per_bucket rows, and the offsets of the buckets come from a small table of
    bucket sums. Rows that are equal in all of `order` share a bucket and come in no fixed order.
    """
    total = df.count() if total is None else total
    buckets = max(1, math.ceil(total / rows_per_bucket))
    group, order = list(group), list(order)
    d = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    w = F.col(weight).cast("long") if weight else F.lit(0).cast("long")
    sums = d.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_bn"), F.sum(w).alias("_bw"))
    earlier = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *(F.col(g).alias(f"_g_{g}") for g in group),
        F.col("_b").alias("_g__b"),
        F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_on"),
        F.coalesce(F.sum("_bw").over(earlier), F.lit(0)).alias("_ow"),
    )
    own = Window.partitionBy(*group, "_b").orderBy(*order)
    d = d.withColumn("_i", F.row_number().over(own) - 1)
    if weight:
        d = d.withColumn("_w", F.coalesce(F.sum(w).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    match = d["_b"] == sums["_g__b"]
    for g in group:
        match = match & d[g].eqNullSafe(sums[f"_g_{g}"])
    d = d.join(sums, match)
    d = d.withColumn("_rank", F.col("_on") + F.col("_i"))
    if weight:
        d = d.withColumn("_before", F.col("_ow") + F.col("_w"))
    return d.select(*df.columns, "_rank", *(["_before"] if weight else []))


def ordered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "_rank") -> DataFrame:
    """df with each row's rank from 0 in its group, in the given total order, however many rows a group has.

    The rows are sorted by ranges of (group, order), so that a large group lies in several partitions, one behind the other;
    a task ranks what a partition has of a group, and the offsets come from a small table of counts.
    """
    group, order = list(group), list(order)
    # Written, because the number of a row's partition has to stay as it is for the counts and the ranks.
    d = cut(df.repartitionByRange(*group, *order).withColumn("_p", F.spark_partition_id()))
    earlier = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = d.groupBy(*group, "_p").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(*(F.col(g).alias(f"_g_{g}") for g in group), F.col("_p").alias("_g__p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*group, "_p").orderBy(*order)
    match = F.col("_p") == F.col("_g__p")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    d = d.withColumn("_i", F.row_number().over(own) - 1).join(counts, match)
    return d.withColumn(name, F.col("_before") + F.col("_i")).select(*df.columns, name)
