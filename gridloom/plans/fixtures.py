"""A small grid projected from the star schema, in DataFrames and, word for word, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import table


def edges(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    """(equipment_id, t1, t2, class, is_open): order lines of great quantity, or all of them, as two-terminal equipment."""
    lines = table(spark, d, "lineitem")
    g = (lines if whole else lines.filter(F.col("l_quantity") >= 49)).groupBy("l_orderkey", "l_partkey")
    g = g.agg(F.max("l_tax").alias("tax"), F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status"))
    kind = F.when(F.col("flag") == "A", "ACLineSegment").when(F.col("flag") == "N", "Switch").otherwise("PowerTransformer")
    order, part = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    return g.select(
        F.concat(F.lit("E-"), order, F.lit("-"), part).alias("equipment_id"), F.concat(F.lit("P-"), part).alias("t1"),
        F.when(F.col("tax") >= 0.08, "GND").otherwise(F.concat(F.lit("O-"), order)).alias("t2"), kind.alias("class"),
        F.when(F.col("flag") == "N", F.col("status") == "O").alias("is_open"), F.col("l_partkey").alias("part"),
    )


def tree(spark: SparkSession, d: str) -> DataFrame:
    """(id, type, parent_id): regions, nations, suppliers and customers as containers; every tenth supplier is misplaced."""
    t = lambda n: table(spark, d, n)
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation = t("nation").select("n_nationkey", "n_regionkey")
    out = t("region").select(name("R-", "r_regionkey").alias("id"), F.lit("substation").alias("type"), F.lit(None).cast("string").alias("parent_id"))
    out = out.union(nation.select(name("N-", "n_nationkey"), F.lit("bay"), name("R-", "n_regionkey")))
    s = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    out = out.union(s.select(name("S-", "s_suppkey"), F.lit("busbar"), F.when(F.col("s_suppkey") % 10 == 0, name("N-", "s_nationkey")).otherwise(name("R-", "n_regionkey"))))
    return out.union(t("customer").select(name("C-", "c_custkey"), F.lit("house"), name("N-", "c_nationkey")))


def geometry(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("owner_id"), F.lit("container").alias("owner_kind"),
        (47 + (F.col("c_custkey") % 800) / 100.0).cast("double").alias("lat"), (6 + (F.col("c_custkey") % 900) / 100.0).cast("double").alias("lon"),
    )


def equipment(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "Fuse").when(F.col("o_orderstatus") == "O", "Switch").otherwise("PowerTransformer")
    return o.select(F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("id"), F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("container_id"), kind.alias("class"))


def segments(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d).filter((F.col("class") == "ACLineSegment") & (F.col("t2") != "GND")).select("equipment_id", "t1", "t2")


def overrides(spark: SparkSession, d: str) -> DataFrame:
    """(equipment_id, is_open): every fifth part's switches, state inverted."""
    return edges(spark, d).filter((F.col("class") == "Switch") & (F.col("part") % 5 == 0)).select("equipment_id", (~F.col("is_open")).alias("is_open"))


def satellites(spark: SparkSession, d: str) -> DataFrame:
    """(owner_id, event_id, value): one JSON satellite per event."""
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("owner_id"), "event_id",
        F.concat(F.lit('{"class": "'), F.col("event_type"), F.lit('", "attributes": '), F.col("props"), F.lit("}")).alias("value"),
    )


EDGES = """
fx_edge AS (
  SELECT 'E-' || l_orderkey || '-' || l_partkey AS equipment_id, 'P-' || l_partkey AS t1,
    CASE WHEN max(l_tax) >= 0.08 THEN 'GND' ELSE 'O-' || l_orderkey END AS t2,
    CASE min(l_returnflag) WHEN 'A' THEN 'ACLineSegment' WHEN 'N' THEN 'Switch' ELSE 'PowerTransformer' END AS class,
    CASE WHEN min(l_returnflag) = 'N' THEN min(l_linestatus) = 'O' END AS is_open, l_partkey AS part
  FROM lineitem WHERE l_quantity >= 49 GROUP BY l_orderkey, l_partkey)
"""
TREE = """
fx_tree AS (
  SELECT 'R-' || r_regionkey AS id, 'substation' AS type, CAST(NULL AS VARCHAR) AS parent_id FROM region
  UNION ALL SELECT 'N-' || n_nationkey, 'bay', 'R-' || n_regionkey FROM nation
  UNION ALL SELECT 'S-' || s_suppkey, 'busbar', CASE WHEN s_suppkey % 10 = 0 THEN 'N-' || s_nationkey ELSE 'R-' || n_regionkey END FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'C-' || c_custkey, 'house', 'N-' || c_nationkey FROM customer)
"""
GEOMETRY = "fx_geometry AS (SELECT 'C-' || c_custkey AS owner_id, 'container' AS owner_kind, 47 + (c_custkey % 800) / 100.0::DOUBLE AS lat, 6 + (c_custkey % 900) / 100.0::DOUBLE AS lon FROM customer)"
EQUIPMENT = "fx_equipment AS (SELECT 'O-' || o_orderkey AS id, 'C-' || o_custkey AS container_id, CASE o_orderstatus WHEN 'F' THEN 'Fuse' WHEN 'O' THEN 'Switch' ELSE 'PowerTransformer' END AS class FROM orders)"
SEGMENTS = "fx_segment AS (SELECT equipment_id, t1, t2 FROM fx_edge WHERE class = 'ACLineSegment' AND t2 <> 'GND')"
SATELLITES = """fx_satellite AS (SELECT 'U-' || user_id AS owner_id, event_id, '{"class": "' || event_type || '", "attributes": ' || props || '}' AS value FROM events)"""


def labels(links: str, name: str = "label") -> str:
    """SQL of the least node of each component: `links` has (a, b) in both directions and a loop for every node."""
    return f"""
{name}_reach(n, r) AS (
  SELECT DISTINCT a, a FROM {links}
  UNION SELECT l.b, x.r FROM {name}_reach x JOIN {links} l ON l.a = x.n WHERE x.r < l.b),
{name} AS (SELECT n AS node, min(r) AS root FROM {name}_reach GROUP BY n)
"""
