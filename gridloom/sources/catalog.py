"""Catalog files (JSON lists of entries with attributes) and network tables (CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of the network tables.
TABLES = {
    "buses": "bus_id string, name string, vn_kv double",
    "lines": "line_id string, name string, from_bus string, to_bus string, length_km double, r_ohm_per_km double, x_ohm_per_km double, c_nf_per_km double, g_us_per_km double, max_i_ka double, in_service boolean",
    "trafos": "trafo_id string, name string, hv_bus string, lv_bus string, sn_mva double, vn_hv_kv double, vn_lv_kv double, vk_percent double, vkr_percent double, in_service boolean",
    "loads": "load_id string, name string, bus string, p_mw double, q_mvar double, in_service boolean",
    "gens": "gen_id string, name string, bus string, p_mw double, vm_pu double, min_q_mvar double, max_q_mvar double, in_service boolean",
    "ext_grid": "ext_grid_id string, name string, bus string, vm_pu double, in_service boolean",
}


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """(entry_id, key, value): all *.json of a folder, values as JSON. An empty id, or one that stands twice, is an error."""
    raw = spark.read.schema("id string, attributes map<string, string>").option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    wrong = raw.groupBy("id").count().filter("count > 1 OR id IS NULL OR id = ''").limit(5).collect()
    if wrong:
        raise ValueError(f"catalog ids empty or given twice: {', '.join(str(r.id) for r in wrong)}")
    return raw.select(F.col("id").alias("entry_id"), F.explode("attributes").alias("key", "value"))


def catalog_kinds(entries: DataFrame) -> DataFrame:
    return entries.filter("key = 'catalog_kind'").groupBy(F.col("value").alias("kind")).agg(F.countDistinct("entry_id").alias("n"))


def network_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One network table; a value that doesn't fit its column is null."""
    return spark.read.schema(TABLES[name]).option("header", True).csv(f"{folder}/{name}.csv")


def write_network_table(df: DataFrame, folder: str, name: str) -> None:
    df.select(*(c.split()[0] for c in TABLES[name].split(", "))).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
