"""Queries of the language-model data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import groups, mixing, packing, spam, tokens
from gridloom.session import cut, table

VIRTUAL = ("GND",)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = groups.group_pairs(table(spark, d, "model_edge"), "terminal1_node_id", "terminal2_node_id", VIRTUAL)
    return found.withColumnRenamed("node", "node_id")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokens.token_counts(table(spark, d, "documents")), table(spark, d, "pack_capacity"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_packed(spark, d), table(spark, d, "pack_capacity"))


def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(tokens.token_counts(table(spark, d, "documents"), ("source",)), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(p9_mixed(spark, d), table(spark, d, "mix_target"))


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """(pack_name, n_documents, overfull, cut_short, unused): documents placed, containers over capacity, documents cut that need not be, numbers without container."""
    packs = table(spark, d, "pack_capacity").select("pack_name", F.col("capacity_tokens").alias("capacity")).distinct()
    placed = cut(p8_packed(spark, d).join(packs, "pack_name"))
    boxes = placed.groupBy("pack_name", "container_no", "capacity").agg(F.sum("n_tokens").alias("t"))
    by_box = boxes.groupBy("pack_name").agg(F.count_if(F.col("t") > F.col("capacity")).alias("overfull"), (F.max("container_no") + 1 - F.count(F.lit(1))).alias("unused"))
    docs = placed.groupBy("pack_name", "doc_id", "capacity").agg(F.count(F.lit(1)).alias("k"), F.sum("n_tokens").alias("t"))
    by_doc = docs.groupBy("pack_name").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if((F.col("k") > 1) & (F.col("t") <= F.col("capacity"))).alias("cut_short"))
    return by_doc.join(by_box, "pack_name").select("pack_name", "n_documents", "overfull", "cut_short", "unused")


def p9_check(spark: SparkSession, d: str) -> DataFrame:
    """(source, off, overused): whether a source misses its share of all tokens by more than its longest document, or a document is used too often."""
    mixed = cut(p9_mixed(spark, d))
    by = mixed.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.max("n_tokens").alias("longest"), F.max("use_no").alias("most"))
    whole = mixed.agg(F.sum("n_tokens").alias("whole")).first().whole or 0
    t = table(spark, d, "mix_target").distinct().join(by, "source", "left")
    return t.select("source", (F.abs(F.coalesce("t", F.lit(0)) - F.col("target_share") * F.lit(whole)) > F.coalesce("longest", F.lit(0))).alias("off"), F.coalesce(F.col("most") > F.col("max_repeats"), F.lit(False)).alias("overused"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_pages(table(spark, d, "documents"))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return spam.page_scores(table(spark, d, "documents"))


QUERIES = {
    "p6_found": p6_found,
    "p8_packed": p8_packed,
    "p8_fill": p8_fill,
    "p8_check": p8_check,
    "p9_mixed": p9_mixed,
    "p9_shares": p9_shares,
    "p9_check": p9_check,
    "p10_found": p10_found,
    "p10_scores": p10_scores,
}

ORACLES = {
    "p8_check": "SELECT pack_name, (SELECT count(DISTINCT doc_id) FROM documents) AS n_documents, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS cut_short, CAST(0 AS BIGINT) AS unused FROM (SELECT DISTINCT pack_name FROM pack_capacity)",
    "p9_check": "SELECT source, false AS off, false AS overused FROM mix_target",
    "p6_found": """
WITH RECURSIVE e AS (
  SELECT DISTINCT terminal1_node_id AS a, terminal2_node_id AS b FROM model_edge
  WHERE terminal1_node_id NOT IN ('', 'GND') AND terminal2_node_id NOT IN ('', 'GND')),
links AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
nodes AS (
  SELECT terminal1_node_id AS n FROM model_edge WHERE terminal1_node_id NOT IN ('', 'GND')
  UNION SELECT terminal2_node_id FROM model_edge WHERE terminal2_node_id NOT IN ('', 'GND')),
reach AS (
  SELECT n, n AS r FROM nodes
  UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.n WHERE reach.r < l.b)
SELECT n AS node_id, min(r) AS group_id FROM reach GROUP BY n
""",
}
