"""Hot keys: salted joins, running totals, eager aggregation, orphan references."""

import datetime as dt
import random

import pytest
from helpers import bag
from pyspark.sql import functions as F

from gridloom.operators import eager, orphans, skew


@pytest.fixture
def hot(monkeypatch):
    """Keys of five rows are hot already."""
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (skew.HOT_KEYS, 5))
    monkeypatch.setattr(skew, "TASK_ROWS_MOST", 5)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(spark, hot, how):
    left = spark.createDataFrame([("h", i) for i in range(60)] + [("a", 1), ("a", 1), (None, 3), ("z", 4)], "k string, v int")
    right = spark.createDataFrame([("h", 7), ("a", 8), ("a", 9), (None, 1)], "k string, w int")
    assert bag(skew.salted_join(left, right, ["k"], how)) == bag(left.join(right, "k", how))
    wide = skew.salted_join(left, right, ["k"], how, extra=F.col("v") > F.col("w"))
    l2, r2 = left.alias("l"), right.alias("r")
    plain = l2.join(r2, (F.col("l.k") == F.col("r.k")) & (F.col("v") > F.col("w")), how)
    assert wide.count() == plain.count()


def test_running_totals_of_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, F.lit(None).cast("string")).otherwise(F.lit("hot")).alias("g"), F.col("id").alias("d"), (F.col("id") % 7).alias("w"))
    rows = skew.running(df, ["g"], ["d"], "w", rows_per_bucket=300).collect()
    assert len(rows) == 5000
    for g in ("hot", None):
        own = sorted((r for r in rows if r.g == g), key=lambda r: r._rank)
        assert [r._rank for r in own] == list(range(len(own)))
        total = 0
        for r in own:
            assert r._before == total
            total += r.w
    assert skew.running(df.limit(0), ["g"], ["d"]).count() == 0


def test_eager_aggregate_is_the_join_aggregate(spark, hot):
    rnd = random.Random(1)
    left = spark.createDataFrame([(rnd.choice([1, 1, 1, 1, 2, 3, None]), rnd.choice(["a", "a", "b", None]), rnd.randint(0, 9)) for _ in range(400)], "k int, g string, v int")
    right = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k int")
    got = eager.eager_join_aggregate(left, right, ["k"], ["g"], "v")
    want = left.join(right, "k").groupBy("g").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("k").alias("n_keys"), F.sum("v").alias("sum_v"))
    assert bag(got.drop("n_left")) == bag(want)
    assert eager.eager_join_aggregate(left.limit(0), right, ["k"], ["g"]).count() == 0


def test_eager_counts_in_one_pass_with_a_hot_key(spark, hot):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3]), rnd.choice(["a", "a", "b", None]), rnd.choice(["x", "", None]), rnd.randint(0, 40)) for _ in range(500)]
    left = spark.createDataFrame(rows + rows[:20], "k int, g string, h string, v int")
    right = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k int")
    got = {(r.dimension, r.key): (r.n_left, r.n_rows, r.n_keys) for r in eager.eager_counts(left, right, ["k"], ["g", "h"]).collect()}
    times = {1: 2, 2: 1}
    want = {}
    for at, name in ((1, "g"), (2, "h")):
        for key in {r[at] for r in rows}:
            own = [r for r in set(rows) if r[at] == key]
            want[name, key] = (len(own), sum(times.get(r[0], 0) for r in own), len({r[0] for r in own}))
    assert got == want
    assert eager.eager_counts(left.limit(0), right, ["k"], ["g"]).count() == 0


def test_salts_follow_the_rows_of_a_key(spark):
    """One key with 90 % of a million rows: no task of the join gets three times the median."""
    left = spark.range(1_000_000).select(F.when(F.col("id") % 10 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    hot = skew.hot_keys(left, ["k"]).collect()
    assert [(r.k, r._n) for r in hot] == [(-1, 900_000)] and hot[0]._salts == 16
    right = spark.range(0, 1_000_000, 10).select(F.col("id").alias("k"), F.lit(1).alias("w")).union(spark.sql("SELECT -1L, 2"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = skew.salted_join(left, right, ["k"]).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sizes.sum() == 1_000_000 and sizes.max() < 3 * sizes.median()


def at(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_orphans_as_brute_force(spark, hot):
    rnd = random.Random(2)
    targets = [(rnd.choice(["a", "b", "c", None]), at(s := rnd.randint(0, 20)), at(rnd.choice([None, s + 3]))) for _ in range(40)] + [("d", at(5), at(9))] * 2 + [("e", None, None)]
    refs = [(i, rnd.choice(["a", "b", "c", "d", "e", "nowhere", "", None]), at(rnd.choice([*range(-2, 25), None]))) for i in range(300)] + [(1000 + i, "d", at(5 + i % 5)) for i in range(100)]
    got = orphans.orphan_references(spark.createDataFrame(refs, "record_id int, key string, at timestamp"), spark.createDataFrame(targets, "key string, loaded_at timestamp, deleted_at timestamp"))
    live = lambda k, t: any(x == k and t is not None and a is not None and a <= t and (b is None or t < b) for x, a, b in targets)
    want = {i for i, k, t in refs if k and not live(k, t)}
    assert {r.record_id for r in got.collect()} == want and got.count() == len(want)


def test_orphans_of_empty_tables(spark):
    refs = spark.createDataFrame([(1, "a", at(1))], "record_id int, key string, at timestamp")
    none = spark.createDataFrame([], "key string, loaded_at timestamp, deleted_at timestamp")
    assert orphans.orphan_references(refs, none).count() == 1 and orphans.orphan_references(refs.limit(0), none).count() == 0


def test_bloom_filter_misses_no_key_and_is_bounded(spark, monkeypatch):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    other = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    for words in (1 << 20, 1 << 10):
        monkeypatch.setattr(orphans, "MAX_WORDS", words)
        made, n = orphans.bloom_filter(keys, ["key"], 20_000)
        assert n <= words and made.count() == n // orphans.ROW_WORDS
        assert orphans.passed(keys, ["key"], made, n).filter("_maybe").count() == 20_000
        if words > 1 << 10:
            assert orphans.passed(other, ["key"], made, n).filter("_maybe").count() < 600


def test_filter_report(spark):
    refs = spark.createDataFrame([(i, f"k{i}", at(1)) for i in range(200)] + [(999, None, at(1)), (998, "", at(1))], "record_id int, key string, at timestamp")
    targets = spark.createDataFrame([(f"k{i}", at(0), None) for i in range(50)] * 2, "key string, loaded_at timestamp, deleted_at timestamp")
    r = orphans.filter_report(refs, targets).first()
    assert (r.n_references, r.n_unknown) == (200, 150) and r.n_passed < 15


def test_ranks_in_order_of_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 10 == 0, F.lit(None).cast("string")).when(F.col("id") % 10 == 1, "b").otherwise("hot").alias("g"), F.format_string("%05d", (F.col("id") * 7919) % 3000).alias("k"))
    rows = skew.ordered(df, ["g"], ["k"]).collect()
    for g in ("hot", "b", None):
        own = sorted(r.k for r in rows if r.g == g)
        assert [r._rank for r in sorted((r for r in rows if r.g == g), key=lambda r: r.k)] == list(range(len(own))) and own
    assert len(rows) == 3000 and skew.ordered(df.limit(0), ["g"], ["k"]).count() == 0
