"""Aggregates over joins, computed from pre-aggregated inputs, so that no key's rows meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.skew import hot_keys, salted_join


def eager_join_aggregate(left: DataFrame, right: DataFrame, on: Sequence[str], group: Sequence[str], total: str | None = None, outer: bool = False) -> DataFrame:
    """group, n_left, n_rows, n_keys[, sum_<total>] of `left JOIN right USING (on) GROUP BY group`, without building that join.

    n_left counts the left rows that take part, n_rows the joined rows, n_keys the different join keys, sum_<total> adds up
    a column of the left input over the joined rows. group are columns of the left input. outer: left rows without partner
    take part too and join no row. Method: both inputs are pre-aggregated by join key (the left one by group as well), the
    compact states are joined, counts multiply and sums scale with the other side's count, and the products roll up by
    group. Every shuffle carries states that were combined on the map side: a hot group arrives as one row per task and
    distinct key; a key that many groups share is spread by salted_join. Null keys join nothing, null groups form a group.
    """
    on, group = list(on), list(group)
    sums = [F.sum(total).alias("_sum")] if total else []
    a = left.groupBy(*on, *group).agg(F.count(F.lit(1)).alias("_n"), *sums)
    b = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_m"))
    return _roll_up(salted_join(a, b, on, "left" if outer else "inner"), group, total)


def _roll_up(states: DataFrame, group: list[str], total: str | None) -> DataFrame:
    m = F.coalesce("_m", F.lit(0))
    out = [F.sum("_n").alias("n_left"), F.sum(F.col("_n") * m).alias("n_rows"), F.count(F.lit(1)).alias("n_keys")]
    if total:
        out.append(F.sum(F.col("_sum") * m).alias(f"sum_{total}"))
    return states.groupBy(*group).agg(*out)


def eager_counts(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(dimension, key, n_left, n_rows, n_keys): eager_join_aggregate with outer=True by each of several string columns, in one pass.

    Repeated left rows (equal in all columns) count once. The left rows are shuffled once, by join key: the removal of
    repeated rows, the pre-aggregation by each column and the join with the right states all work on that partitioning. Rows
    of a hot join key go another way: they are spread by the whole row and then by (join key, group), combined on the map
    side, so that they never meet in one task.
    """
    on, columns = list(on), list(columns)
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, on).select(*on))
    each = F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).alias("key")) for c in columns))
    b = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_m"))

    def states(rows: DataFrame) -> DataFrame:
        return rows.distinct().select(*on, F.inline(each)).groupBy(*on, "dimension", "key").agg(F.count(F.lit(1)).alias("_n"))

    cold = states(left.join(hot, on, "left_anti").repartition(parts, *on)).join(b, on, "left")
    warm = salted_join(states(left.join(hot, on, "left_semi")), b.join(hot, on, "left_semi"), on, "left")
    group = ["dimension", "key"]
    counts = _roll_up(cold, group, None).unionByName(_roll_up(warm, group, None))
    return counts.groupBy(*group).agg(*(F.sum(c).alias(c) for c in ("n_left", "n_rows", "n_keys")))
