"""Register queries on the star schema and the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import register as rg
from gridloom.session import table

TERM = "GND_1%"


def register_query(spark: SparkSession, d: str) -> DataFrame:
    """The third page of 50 urgent orders (a page is the feature here)."""
    return rg.page(table(spark, d, "orders"), {"o_orderstatus": "O", "o_orderpriority": "1-URGENT"}, "o_orderkey", 50, 100).select("o_orderkey", "o_custkey", "o_totalprice")


def register_search(spark: SparkSession, d: str) -> DataFrame:
    return rg.search(table(spark, d, "documents").select("doc_id", "text", "lang", "source"), "DISCOUNT").select("doc_id", "source")


def register_search_escaped(spark: SparkSession, d: str) -> DataFrame:
    """`%` in a term is a percent sign."""
    return rg.search(table(spark, d, "documents").select("doc_id", "text"), "%").select("doc_id")


def register_search_all(spark: SparkSession, d: str) -> DataFrame:
    t = {n: table(spark, d, n) for n in ("region", "nation", "supplier", "customer", "part")}
    return rg.search_all(t, "an").groupBy("table").agg(F.count(F.lit(1)).alias("n"))


def _cascade(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """One region's nations, their customers and suppliers, the orders and lines of these, and the parts in them."""
    t = lambda n: table(spark, d, n)
    nation = t("nation").filter("n_regionkey = 1")
    keys = rg.referenced([(nation, "n_nationkey")], "k")
    customer, supplier = rg.kept(t("customer"), "c_nationkey", keys), rg.kept(t("supplier"), "s_nationkey", keys)
    orders = rg.kept(t("orders"), "o_custkey", rg.referenced([(customer, "c_custkey")], "k"))
    lines = rg.kept(t("lineitem"), "l_orderkey", rg.referenced([(orders, "o_orderkey")], "k"))
    part = rg.kept(t("part"), "p_partkey", rg.referenced([(lines, "l_partkey")], "k"))
    return {"nation": nation, "customer": customer, "supplier": supplier, "orders": orders, "lineitem": lines, "part": part}


def regional_extract_counts(spark: SparkSession, d: str) -> DataFrame:
    return rg.row_counts(_cascade(spark, d))


def wide_union(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers as one table of maps, then as columns."""
    c = table(spark, d, "customer").select(F.create_map(F.lit("Id"), F.col("c_custkey").cast("string"), F.lit("Segment"), F.col("c_mktsegment")).alias("fields"))
    s = table(spark, d, "supplier").select(F.create_map(F.lit("ID"), F.col("s_suppkey").cast("string"), F.lit("Name"), F.col("s_name")).alias("fields"))
    return rg.map_to_columns(c.union(s)).withColumnRenamed("ID", "id_text").select("id_text", "Name", "Segment")


QUERIES = {f.__name__: f for f in (register_query, register_search, register_search_escaped, register_search_all, regional_extract_counts, wide_union)}

_CASCADE = """
WITH n AS (SELECT * FROM nation WHERE n_regionkey = 1),
c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)), s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)), l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)),
p AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM l)),
k AS (SELECT 'nation' AS t, count(*) AS r FROM n UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'supplier', count(*) FROM s
  UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM l UNION ALL SELECT 'part', count(*) FROM p)
"""

ORACLES = {
    "register_query": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' ORDER BY o_orderkey LIMIT 50 OFFSET 100",
    "register_search": "SELECT doc_id, source FROM documents WHERE contains(lower(text), 'discount') OR contains(lower(lang), 'discount') OR contains(lower(source), 'discount') OR contains(CAST(doc_id AS VARCHAR), 'discount')",
    "register_search_escaped": "SELECT doc_id FROM documents WHERE contains(text, '%')",
    "register_search_all": """SELECT "table", count(*) AS n FROM (SELECT 'region' AS "table" FROM region WHERE contains(lower(r_name), 'an') UNION ALL SELECT 'nation' FROM nation WHERE contains(lower(n_name), 'an')
UNION ALL SELECT 'supplier' FROM supplier WHERE contains(lower(s_name), 'an') UNION ALL SELECT 'customer' FROM customer WHERE contains(lower(c_name || ' ' || c_mktsegment), 'an')
UNION ALL SELECT 'part' FROM part WHERE contains(lower(p_name || ' | ' || p_brand || ' | ' || p_type), 'an')) GROUP BY 1""",
    "regional_extract_counts": f"""{_CASCADE} SELECT t AS "table", r AS n_rows FROM k UNION ALL SELECT 'total', CAST(sum(r) AS BIGINT) FROM k""",
    "wide_union": """SELECT CAST(c_custkey AS VARCHAR) AS id_text, CAST(NULL AS VARCHAR) AS "Name", c_mktsegment AS "Segment" FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier""",
}
