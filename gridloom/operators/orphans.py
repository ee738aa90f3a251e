"""References whose target was not live: a broadcast Bloom filter proves most orphans, an exact join settles the rest."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.skew import salted_join

#: Words of the filter at most (64 bits each) and words in a row of the broadcast table: 64 MB in 8,192 rows. At
#: BITS_PER_KEY that serves 22 million keys; with more the filter gets denser, and from some 100 million keys on it proves
#: little and the exact join does the work. filter_report tells the share that passes.
MAX_WORDS, ROW_WORDS = 1 << 23, 1 << 10
#: Bits of the filter for a key, and bits that a key sets in its word.
BITS_PER_KEY, BITS_SET = 24, 5


def _word(keys: Sequence[Column], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words))


def _mask(keys: Sequence[Column]) -> Column:
    """BITS_SET bits in a word of 64, from a second hash; 6 bits of it choose each place."""
    h = F.xxhash64(*keys, F.lit("mask"))
    mask = F.lit(0).cast("long")
    for i in range(BITS_SET):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_filter(keys: DataFrame, on: Sequence[str], n: int) -> tuple[DataFrame, int]:
    """(part, words) of a word-blocked Bloom filter over the columns `on`, and its number of words; n: keys, or a bound of them.

    Each key sets a few bits in one word (Putze, Sanders and Singler: Cache-, hash- and space-efficient Bloom filters). A
    row holds ROW_WORDS successive words as an array, so a look-up is one equi-join and one access by position. Words are
    or-ed in a partial aggregate; there are at most MAX_WORDS of them at any number of keys.
    """
    words = min(MAX_WORDS, max(ROW_WORDS, 1 << max(0, math.ceil(math.log2(max(1, n) * BITS_PER_KEY / 64)))))
    cols = [F.col(k) for k in on]
    made = keys.dropna(subset=list(on)).select(_word(cols, words).alias("word"), _mask(cols).alias("bits"))
    made = made.union(keys.sparkSession.range(words).select("id", F.lit(0).cast("long"))).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    part = F.expr(f"word div {ROW_WORDS}").alias("part")
    rows = made.groupBy(part).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))  # ROW_WORDS entries each
    return rows.select("part", F.col("w.bits").alias("words")), words


def passed(refs: DataFrame, on: Sequence[str], made: DataFrame, words: int) -> DataFrame:
    """refs with `_maybe`: whether the filter holds the key; false means that no target has it."""
    cols = [F.col(k) for k in on]
    word = _word(cols, words)
    asked = refs.withColumn("part", F.floor(word / ROW_WORDS)).join(F.broadcast(made), "part", "left")
    bits, mask = F.get("words", (word % ROW_WORDS).cast("int")), _mask(cols)
    return asked.select(*refs.columns, F.coalesce(bits.bitwiseAND(mask) == mask, F.lit(False)).alias("_maybe"))


def _asked(refs: DataFrame, targets: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    refs = refs.dropna(subset=on).filter(F.col(on[-1]) != "")
    made, words = bloom_filter(targets, on, targets.count())
    targets = targets.select(*on, "loaded_at", "deleted_at").dropna(subset=on).distinct()
    return passed(refs, on, made, words), targets


def orphan_references(refs: DataFrame, targets: DataFrame, on: Sequence[str] = ("key",)) -> DataFrame:
    """Of refs (on, at, record columns) those whose key is live in no row of targets (on, loaded_at, deleted_at) at `at`.

    on: the columns of a key, the name last, before it such as the target table. A target row is live from loaded_at
    (inclusive, a null one: never) to deleted_at (exclusive, null: still live). A key that is null or whose name is empty
    refers to nothing and never comes out; with a null `at` every reference comes out, no target being live at an unknown
    time. Repeated rows stay repeated. Keys outside the Bloom filter of the target keys are orphans for sure; the others
    are verified by an anti-join in which hot keys are spread over salts.
    """
    asked, targets = _asked(refs, targets, list(on))
    sure = asked.filter(~F.col("_maybe")).drop("_maybe")
    unsure = asked.filter("_maybe").drop("_maybe")
    live = (F.col("at") >= F.col("loaded_at")) & (F.col("deleted_at").isNull() | (F.col("at") < F.col("deleted_at")))
    return sure.unionByName(salted_join(unsure, targets, list(on), "left_anti", extra=live))


def filter_report(refs: DataFrame, targets: DataFrame, on: Sequence[str] = ("key",)) -> DataFrame:
    """(n_references, n_unknown, n_passed): references, those whose key no target has, and those of them that the filter lets pass."""
    asked, targets = _asked(refs, targets, list(on))
    known = targets.select(*on).distinct().withColumn("_known", F.lit(True))
    both = asked.join(known, list(on), "left")
    unknown = F.col("_known").isNull()
    return both.agg(F.count(F.lit(1)).alias("n_references"), F.count_if(unknown).alias("n_unknown"), F.count_if(unknown & F.col("_maybe")).alias("n_passed"))


def model_references(edges: DataFrame, terminals: DataFrame) -> DataFrame:
    """All references of the two tables as (target, ref_table, ref_column, record_id, key, at); rows repeated once."""
    parts = [
        (edges, "model_edge", "terminal1_node_id", "equipment_id", "node"),
        (edges, "model_edge", "terminal2_node_id", "equipment_id", "node"),
        (terminals, "jag2nsc_raw_terminal", "equipment_id", "terminal_id", "equipment"),
        (terminals, "jag2nsc_raw_terminal", "node_id", "terminal_id", "node"),
    ]
    out = None
    for df, table, column, record, target in parts:
        one = df.select(F.lit(target).alias("target"), F.lit(table).alias("ref_table"), F.lit(column).alias("ref_column"), F.col(record).alias("record_id"), F.col(column).alias("key"), F.col("loaded_at").alias("at"))
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def model_targets(nodes: DataFrame, equipment: DataFrame) -> DataFrame:
    """(target, key, loaded_at, deleted_at): the rows that model_references point to."""
    of = lambda target, df: df.select(F.lit(target).alias("target"), F.col("id").alias("key"), "loaded_at", "deleted_at")
    return of("node", nodes).unionByName(of("equipment", equipment))


def model_orphans(edges: DataFrame, terminals: DataFrame, nodes: DataFrame, equipment: DataFrame) -> DataFrame:
    """The orphan references of model_edge and jag2nsc_raw_terminal, each once."""
    return orphan_references(model_references(edges, terminals), model_targets(nodes, equipment), ["target", "key"])
