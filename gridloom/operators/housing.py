"""Which document a thing of the model belongs to: exportable roots, cables inside a station, files that share a node."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.components import roots
from gridloom.operators.skew import salted_join

#: Container types that have a document of their own, and its folder.
FOLDERS = {"substation": "ONS", "distribution-box": "KVS", "acline": "Kabel", "house": "Haushalte"}
STATIONS = ("substation", "distribution-box")
BOUNDARY = "Grenzknoten"
CABLE = "acline:"
GROUND = "GND"
#: References to other files that a node lists by name; of more it says how many.
MOST_REFS = 100


def root_containers(container: DataFrame) -> DataFrame:
    """(container_id, root, root_type): the nearest container, itself or above, that has a document; none, no row.

    container: id, type, parent_id. Parents that are unknown and cycles of parents lead nowhere.
    """
    own = F.col("type").isin(*FOLDERS)
    up = roots(container.select("id", F.when(~F.coalesce(own, F.lit(False)), F.col("parent_id")).alias("parent_id")), "id", "parent_id")
    tops = container.filter(own).select(F.col("id").alias("root"), F.col("type").alias("root_type")).distinct()
    return up.select(F.col("node").alias("container_id"), "root").join(tops, "root").select("container_id", "root", "root_type")


def _owned(equipment: DataFrame, tops: DataFrame) -> DataFrame:
    return equipment.select(F.col("id").alias("equipment_id"), "container_id").join(tops, "container_id").select("equipment_id", "root", "root_type").distinct()


def _ends(edges: DataFrame) -> DataFrame:
    ends = edges.select("equipment_id", F.explode(F.array_distinct(F.array("t1", "t2"))).alias("node"))
    return ends.filter(F.col("node").isNotNull() & (F.col("node") != "") & (F.col("node") != GROUND))


def internal_cables(equipment: DataFrame, edges: DataFrame, tops: DataFrame) -> DataFrame:
    """(root, station): cables all of whose touching foreign equipment lies in one and the same station.

    equipment: id, container_id; edges: equipment_id, t1, t2; tops: root_containers. A cable that touches nothing foreign, a
    second cable, a house or equipment without document stands for itself. Nodes are judged by the number of documents at
    them and the least and greatest one, so that a node with very many edges is one row.
    """
    of = _owned(equipment, tops)
    at = _ends(edges).join(of, "equipment_id", "left").select("node", F.coalesce("root", F.lit("")).alias("root"), "root_type").distinct()
    per_node = at.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    own = salted_join(at.filter("root_type = 'acline'").select("node", "root"), per_node, ["node"])
    other = F.when(F.col("n") == 2, F.when(F.col("lo") == F.col("root"), F.col("hi")).otherwise(F.col("lo")))
    judged = own.groupBy("root").agg(F.bool_and(F.col("n") <= 2).alias("ok"), F.countDistinct(other).alias("k"), F.min(other).alias("station"))
    stations = tops.filter(F.col("root_type").isin(*STATIONS)).select(F.col("root").alias("station")).distinct()
    return judged.filter("ok AND k = 1").select("root", "station").join(stations, "station", "left_semi").select("root", "station")


def node_files(equipment: DataFrame, edges: DataFrame, tops: DataFrame, inside: DataFrame, regions: DataFrame) -> DataFrame:
    """(node, cable, refs, more): the documents with equipment at a node, cables' and others apart.

    inside: internal_cables, counted to their station; regions: root, region. refs: region, folder and file of the first
    MOST_REFS in this order, more: how many there are beyond.
    """
    of = _owned(equipment, tops).join(inside, "root", "left")
    of = of.select("equipment_id", F.coalesce("station", "root").alias("root")).join(tops.select("root", "root_type").distinct(), "root")
    folder = F.create_map(*(F.lit(x) for kv in FOLDERS.items() for x in kv))
    at = _ends(edges).join(of, "equipment_id").select("node", "root", "root_type").distinct().join(regions, "root", "left")
    at = at.select("node", (F.col("root_type") == "acline").alias("cable"), F.struct("region", folder[F.col("root_type")].alias("folder"), F.regexp_replace("root", f"^{CABLE}", "").alias("file")).alias("ref"))
    counts = at.groupBy("node", "cable").agg(F.count(F.lit(1)).alias("n"))
    first = at.withColumn("_i", F.row_number().over(Window.partitionBy("node", "cable").orderBy("ref"))).filter(F.col("_i") <= MOST_REFS)
    listed = first.groupBy("node", "cable").agg(F.sort_array(F.collect_list("ref")).alias("refs"))
    return listed.join(counts, ["node", "cable"]).select("node", "cable", "refs", F.greatest(F.col("n") - MOST_REFS, F.lit(0)).cast("int").alias("more"))
