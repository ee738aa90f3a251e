"""Queries on containers built from facts, and graph queries on the whole of model_edge.

The facts of the test table name containers but do not describe them, so their descriptions are added by the form of the
name: `ST-n` is a station, `ST-n-B-m` a feeder and `ST-n-BB-m` a voltage level of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import components as comp
from gridloom.operators import containers as ct
from gridloom.operators import staging as st
from gridloom.operators import topology as top
from gridloom.plans import graph
from gridloom.plans import staging as ps
from gridloom.session import cut, table

STATION = "^(ST-[0-9]+)"


def described(spark: SparkSession, d: str) -> DataFrame:
    """The facts with those of the containers that they name."""
    f = st.distinct_facts(table(spark, d, "staging_records"))
    named = f.filter(F.col("attribute") == ct.HOLDER).select("version", F.trim("value").alias("c")).filter("c <> ''").distinct().withColumn("s", F.regexp_extract("c", STATION, 1))
    station = named.filter("s <> ''").select("version", F.col("s").alias("id"), F.lit("Substation").alias("class"), F.lit("IdentifiedObject.name").alias("attribute"), F.col("s").alias("value"), F.lit(False).alias("is_reference"))
    kind = F.when(F.col("c").rlike(STATION + "-B-[0-9]+$"), "Feeder").when(F.col("c").rlike(STATION + "-BB-[0-9]+$"), "VoltageLevel")
    below = named.withColumn("class", kind).filter("class IS NOT NULL")
    below = below.select("version", F.col("c").alias("id"), "class", F.when(F.col("class") == "Feeder", ct.FEEDER).otherwise(ct.LEVEL).alias("attribute"), F.col("s").alias("value"), F.lit(True).alias("is_reference"))
    more = station.unionByName(below).distinct()
    return f.unionByName(more.select("version", "id", F.lit(None).cast("string").alias("profile"), "class", "attribute", "value", "is_reference", F.lit(0).alias("seq")))


def model_containers(spark: SparkSession, d: str) -> DataFrame:
    return ct.resolve(cut(described(spark, d))).container


def container_of_equipment(spark: SparkSession, d: str) -> DataFrame:
    return ct.resolve(cut(described(spark, d))).member


def container_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return ct.resolve(cut(described(spark, d))).anomaly


def document_containers(spark: SparkSession, d: str) -> DataFrame:
    """(type, rule, n): the containers of the documents in model_file by type, and what they hold by rule."""
    from gridloom.sources import documents

    h = ct.resolve(documents.facts(documents.classify(table(spark, d, "model_file"))[0], 1))
    member = h.member.join(h.container.select("version", F.col("id").alias("container_id"), "type"), ["version", "container_id"])
    none = F.lit(None).cast("string").alias("rule")
    return h.container.groupBy("type", none).agg(F.count(F.lit(1)).alias("n")).unionByName(member.groupBy("type", "rule").agg(F.count(F.lit(1)).alias("n")))


def edges(spark: SparkSession, d: str) -> DataFrame:
    """(equipment_id, t1, t2, class, is_open): all of model_edge, each once, with class and switch state of the latest version that has one."""
    e = table(spark, d, "model_edge").select("equipment_id", F.col("terminal1_node_id").alias("t1"), F.coalesce("terminal2_node_id", F.lit("")).alias("t2")).distinct()
    f = st.distinct_facts(table(spark, d, "staging_records"))
    last = lambda c: F.max(F.struct("version", c))[c].alias(c)
    kind = f.groupBy("version", "id").agg(st.object_class().alias("class")).groupBy(F.col("id").alias("equipment_id")).agg(last("class"))
    state = st.switch_states(f).groupBy(F.col("id").alias("equipment_id")).agg(last("is_open"))
    return e.join(kind, "equipment_id", "left").join(state, "equipment_id", "left").withColumn("class", F.coalesce("class", F.lit("Equipment")))


def model_circuits(spark: SparkSession, d: str) -> DataFrame:
    return top.circuit_summary(cut(edges(spark, d)))


def model_groups(spark: SparkSession, d: str) -> DataFrame:
    return top.electrical_groups(edges(spark, d))


def model_reachable(spark: SparkSession, d: str) -> DataFrame:
    """What can be reached from the first node of every open switch without passing GND."""
    e = cut(edges(spark, d))
    return top.reachable_nodes(e, e.filter("is_open").select(F.col("t1").alias("node")), through_ground=False)


def model_chains(spark: SparkSession, d: str) -> DataFrame:
    """Cable chains over the edges that are cable segments."""
    e = edges(spark, d).filter("class = 'ACLineSegment' AND t1 <> 'GND' AND t2 <> 'GND'").select("equipment_id", "t1", "t2")
    return top.cable_chains(e)


def model_node_degree(spark: SparkSession, d: str) -> DataFrame:
    """(degree, n_nodes): how many nodes have how many edges; GND is no node."""
    ends = top.endpoints(edges(spark, d), keep_ground=False)
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).groupBy("degree").agg(F.count(F.lit(1)).alias("n_nodes"))


def _spread(query):
    """A query of which no graph is solved in one task, however small; its SQL is that of the query."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        with comp.distributed():
            return query(spark, d)

    return run


SPREAD = {"model_circuits": model_circuits, "model_groups": model_groups, "model_reachable": model_reachable, "model_chains": model_chains, "circuits": graph.circuits, "electrical_groups": graph.electrical_groups, "station_islands": graph.station_islands}
QUERIES = {f.__name__: f for f in (model_containers, container_of_equipment, container_anomalies, document_containers, model_circuits, model_groups, model_reachable, model_chains, model_node_degree)}

QUERIES |= {f"{n}_spread": _spread(q) for n, q in SPREAD.items()}

_HOLD = "nullif(trim({}), '')".format(ps._first_sql(ct.HOLDER))
_DESCRIBED = f"""
named AS (SELECT DISTINCT version, trim(value) AS c, regexp_extract(trim(value), '{STATION}', 1) AS s FROM staging_records WHERE attribute = '{ct.HOLDER}' AND trim(value) <> ''),
f AS (SELECT DISTINCT version, id, profile, class, attribute, value, is_reference, seq FROM staging_records
  UNION ALL (SELECT DISTINCT version, s, NULL, 'Substation', 'IdentifiedObject.name', s, false, 0 FROM named WHERE s <> ''
  UNION SELECT version, c, NULL, 'Feeder', '{ct.FEEDER}', s, true, 0 FROM named WHERE regexp_full_match(c, 'ST-[0-9]+-B-[0-9]+')
  UNION SELECT version, c, NULL, 'VoltageLevel', '{ct.LEVEL}', s, true, 0 FROM named WHERE regexp_full_match(c, 'ST-[0-9]+-BB-[0-9]+'))),
{ps._CLASSES}, {ps._TERMINALS}, {ps._WIRING},
place AS (SELECT DISTINCT version, s AS id, s AS home FROM named WHERE s <> ''
  UNION SELECT version, c, c FROM named WHERE regexp_full_match(c, 'ST-[0-9]+-B-[0-9]+') UNION SELECT version, c, s FROM named WHERE regexp_full_match(c, 'ST-[0-9]+-BB-[0-9]+')),
obj AS (SELECT version, id, {ps._CLASS} AS class, coalesce({ps._first_sql('IdentifiedObject.name', False)}, '(unnamed)') AS name, {_HOLD} AS holder, count(*) FILTER (WHERE attribute = '{ct.HOLDER}') > 0 AS has_holder FROM f GROUP BY version, id),
sec AS (SELECT o.*, p.home, CASE WHEN regexp_full_match(holder, 'ST-[0-9]+-BB-[0-9]+') THEN holder WHEN regexp_full_match(holder, 'ST-[0-9]+') THEN 'busbar:' || regexp_replace(o.id, '#[0-9]+$', '') END AS busbar
  FROM obj o LEFT JOIN place p ON p.version = o.version AND p.id = o.holder WHERE class = 'BusbarSection'),
dev AS (SELECT o.*, p.home FROM obj o LEFT JOIN place p ON p.version = o.version AND p.id = o.holder
  WHERE class NOT IN ({', '.join(f"'{c}'" for c in ct.NO_EQUIPMENT)}) AND NOT class LIKE '%GeneratingUnit' AND (has_holder OR class = 'Junction')),
seg AS (SELECT version, equipment_id, node1 AS t1, node2 AS t2 FROM wiring WHERE class = 'ACLineSegment' AND anomaly IS NULL),
ends AS (SELECT version, equipment_id, t1 AS node FROM seg WHERE t1 <> '' UNION ALL SELECT version, equipment_id, t2 FROM seg WHERE t2 <> ''),
joint AS (SELECT version, node, min(equipment_id) AS a, max(equipment_id) AS b FROM ends GROUP BY ALL HAVING count(*) = 2 AND min(equipment_id) <> max(equipment_id)),
links AS (SELECT version, a, b FROM joint UNION SELECT version, b, a FROM joint UNION SELECT version, equipment_id, equipment_id FROM seg),
reach(version, n, r) AS (SELECT DISTINCT version, a, a FROM links UNION SELECT l.version, l.b, x.r FROM reach x JOIN links l ON l.version = x.version AND l.a = x.n WHERE x.r < l.b),
root AS (SELECT version, n, min(r) AS r FROM reach GROUP BY ALL),
chain AS (SELECT version, n AS equipment_id, 'acline:' || min(n) OVER w || ':' || max(n) OVER w AS chain_id, 'ACLine ' || substr(min(n) OVER w, 1, 8) AS name FROM root WINDOW w AS (PARTITION BY version, r))
"""
_EDGES = f"""
f AS (SELECT DISTINCT version, id, profile, class, attribute, value, is_reference, seq FROM staging_records), {ps._STATE},
kind AS (SELECT id, max({{'v': version, 'c': class}}).c AS class FROM (SELECT version, id, {ps._CLASS} AS class FROM f GROUP BY version, id) GROUP BY id),
last AS (SELECT id, max({{'v': version, 'o': is_open}}).o AS is_open FROM state GROUP BY id),
edge AS (SELECT e.*, coalesce(k.class, 'Equipment') AS class, l.is_open FROM (SELECT DISTINCT equipment_id, terminal1_node_id AS t1, coalesce(terminal2_node_id, '') AS t2 FROM model_edge) e LEFT JOIN kind k ON k.id = e.equipment_id LEFT JOIN last l ON l.id = e.equipment_id)
"""


def _labels(connects: str) -> str:
    """SQL of label(node, root): t1 and t2 joined where `connects` holds, every named end a node."""
    return f"""
links AS (SELECT t1 AS a, t2 AS b FROM edge WHERE {connects} AND t1 <> '' AND t2 <> '' UNION SELECT t2, t1 FROM edge WHERE {connects} AND t1 <> '' AND t2 <> '' UNION SELECT t1, t1 FROM edge WHERE t1 <> '' UNION SELECT t2, t2 FROM edge WHERE t2 <> ''),
reach(n, r) AS (SELECT DISTINCT a, a FROM links UNION SELECT l.b, x.r FROM reach x JOIN links l ON l.a = x.n WHERE x.r < l.b),
label AS (SELECT n AS node, min(r) AS root FROM reach GROUP BY n)"""


_WIRED = "class <> 'PowerTransformer' AND NOT coalesce(is_open, false) AND t1 <> 'GND' AND t2 <> 'GND'"
ORACLES = {
    "model_containers": f"""WITH RECURSIVE {_DESCRIBED}
SELECT version, s AS id, 'substation' AS type, NULL::VARCHAR AS parent_id, s AS name FROM (SELECT DISTINCT version, s FROM named WHERE s <> '')
UNION ALL SELECT version, c, 'bay', s, '(unnamed)' FROM named WHERE regexp_full_match(c, 'ST-[0-9]+-B-[0-9]+')
UNION ALL SELECT version, busbar, 'busbar', min(home), CASE WHEN busbar LIKE 'busbar:%' THEN min({{'i': id, 'n': name}}).n ELSE '(unnamed)' END FROM sec WHERE busbar IS NOT NULL GROUP BY version, busbar
UNION ALL SELECT DISTINCT version, chain_id, 'acline', NULL, name FROM chain""",
    "container_of_equipment": f"""WITH RECURSIVE {_DESCRIBED}
SELECT version, id AS equipment_id, class, busbar AS container_id, 'busbar' AS rule FROM sec WHERE busbar IS NOT NULL
UNION ALL SELECT version, id, class, home, 'reference' FROM dev WHERE home IS NOT NULL
UNION ALL SELECT version, equipment_id, 'ACLineSegment', chain_id, 'chain' FROM chain""",
    "container_anomalies": f"""WITH RECURSIVE {_DESCRIBED},
lone AS (SELECT d.version, d.id, d.class, EXISTS (SELECT 1 FROM wiring w WHERE w.version = d.version AND w.equipment_id = d.id AND w.anomaly IS NULL AND w.n_nodes > 0) AS wired FROM dev d WHERE holder IS NULL)
SELECT version, id AS object_id, 'busbar section in no known level or station' AS message FROM sec WHERE busbar IS NULL
UNION ALL SELECT version, id, 'container ' || holder || ' is no bay, level, station or house' FROM dev WHERE home IS NULL AND holder IS NOT NULL
UNION ALL SELECT version, equipment_id, 'cable segment: ' || anomaly FROM wiring WHERE class = 'ACLineSegment' AND anomaly IS NOT NULL
UNION ALL SELECT version, id, CASE WHEN wired THEN 'no container, and none of its nodes has one' ELSE 'no container, and no sound terminal with a node' END FROM lone""",
    "model_circuits": f"""WITH RECURSIVE {_EDGES}, {_labels(_WIRED)},
circ AS (SELECT node, root AS circuit_id FROM label WHERE node <> 'GND'), touched AS (SELECT DISTINCT e.equipment_id, c.circuit_id FROM edge e JOIN circ c ON c.node = e.t1 OR c.node = e.t2),
many AS (SELECT equipment_id, count(*) AS k FROM touched GROUP BY 1),
per AS (SELECT t.circuit_id, count(*) AS n_edges, CAST(sum(CASE WHEN m.k > 1 OR e.t1 = 'GND' OR e.t2 = 'GND' THEN 1 ELSE 0 END) AS BIGINT) AS n_boundary FROM touched t JOIN many m USING (equipment_id) JOIN edge e USING (equipment_id) GROUP BY 1)
SELECT c.circuit_id, count(*) AS n_nodes, coalesce(any_value(n_edges), 0) AS n_edges, coalesce(any_value(n_boundary), 0) AS n_boundary FROM circ c LEFT JOIN per USING (circuit_id) GROUP BY 1""",
    "model_groups": f"WITH RECURSIVE {_EDGES}, {_labels('NOT is_open')} SELECT node, root AS group_id FROM label",
    "model_reachable": f"""WITH RECURSIVE {_EDGES}, way AS (SELECT t1 AS a, t2 AS b FROM edge WHERE t1 <> '' AND t2 <> '' UNION SELECT t2, t1 FROM edge WHERE t1 <> '' AND t2 <> ''),
seen(node) AS (SELECT DISTINCT t1 FROM edge WHERE is_open AND t1 IS NOT NULL UNION SELECT w.b FROM seen s JOIN way w ON w.a = s.node WHERE s.node <> 'GND') SELECT node FROM seen""",
    "model_chains": f"""WITH RECURSIVE {_EDGES}, seg AS (SELECT * FROM edge WHERE class = 'ACLineSegment' AND t1 <> 'GND' AND t2 <> 'GND'),
ends AS (SELECT equipment_id, t1 AS node FROM seg WHERE t1 <> '' UNION ALL SELECT equipment_id, t2 FROM seg WHERE t2 <> ''),
joint AS (SELECT node, min(equipment_id) AS a, max(equipment_id) AS b FROM ends GROUP BY node HAVING count(*) = 2 AND min(equipment_id) <> max(equipment_id)),
links AS (SELECT a, b FROM joint UNION SELECT b, a FROM joint UNION SELECT equipment_id, equipment_id FROM seg),
reach(n, r) AS (SELECT DISTINCT a, a FROM links UNION SELECT l.b, x.r FROM reach x JOIN links l ON l.a = x.n WHERE x.r < l.b), root AS (SELECT n, min(r) AS r FROM reach GROUP BY n)
SELECT n AS equipment_id, 'acline:' || min(n) OVER w || ':' || max(n) OVER w AS chain_id, 'ACLine ' || substr(min(n) OVER w, 1, 8) AS chain_name FROM root WINDOW w AS (PARTITION BY r)""",
    "model_node_degree": f"WITH {_EDGES}, ends AS (SELECT equipment_id, t1 AS node FROM edge UNION SELECT equipment_id, t2 FROM edge) SELECT degree, count(*) AS n_nodes FROM (SELECT node, count(*) AS degree FROM ends WHERE node IS NOT NULL AND node NOT IN ('', 'GND') GROUP BY node) GROUP BY degree",
}
ORACLES |= {f"{n}_spread": (ORACLES | graph.ORACLES)[n] for n in SPREAD}
