"""Graph and hierarchy queries on the fixture grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import chains
from gridloom.operators import components as comp
from gridloom.operators import terminals as tm
from gridloom.operators import topology as top
from gridloom.plans import fixtures as fx


def circuits(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: circuits with their nodes, edges and boundary edges."""
    return top.circuit_summary(fx.edges(spark, d))


def circuits_whole(spark: SparkSession, d: str) -> DataFrame:
    """circuits over all order lines, with a giant component; no SQL."""
    return top.circuit_summary(fx.edges(spark, d, whole=True))


def electrical_groups_whole(spark: SparkSession, d: str) -> DataFrame:
    """electrical_groups over all order lines; no SQL."""
    return top.electrical_groups(fx.edges(spark, d, whole=True))


def circuit_nodes(spark: SparkSession, d: str) -> DataFrame:
    return top.circuits(fx.edges(spark, d))


def circuit_sizes(spark: SparkSession, d: str) -> DataFrame:
    return top.circuits(fx.edges(spark, d)).groupBy("circuit_id").count().groupBy(F.col("count").alias("n_nodes")).agg(F.count(F.lit(1)).alias("n_circuits"))


def edge_circuits(spark: SparkSession, d: str) -> DataFrame:
    e = fx.edges(spark, d)
    return top.edge_circuits(e, top.circuits(e))


def electrical_groups(spark: SparkSession, d: str) -> DataFrame:
    return top.electrical_groups(fx.edges(spark, d))


def group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return top.electrical_groups(fx.edges(spark, d)).groupBy("group_id").agg(F.countDistinct("node").alias("n_nodes"))


def connected_pairs(spark: SparkSession, d: str) -> DataFrame:
    """For every edge: are its two ends electrically connected?"""
    e = fx.edges(spark, d)
    return top.electrically_connected(top.electrical_groups(e), e.select(F.col("t1").alias("a"), F.col("t2").alias("b")).distinct())


def whatif_circuits(spark: SparkSession, d: str) -> DataFrame:
    """(scenario, n_circuits, largest): as it is, and with some switches turned, in one run."""
    e = fx.edges(spark, d)
    both = e.withColumn("scenario", F.lit("base")).unionByName(top.with_overrides(e, fx.overrides(spark, d)).withColumn("scenario", F.lit("turned")))
    sizes = top.circuits(both, ["scenario"]).groupBy("scenario", "circuit_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("scenario").agg(F.count(F.lit(1)).alias("n_circuits"), F.max("n").alias("largest"))


def circuit_elements(spark: SparkSession, d: str) -> DataFrame:
    """The circuits that the least edge that is off GND touches."""
    e = fx.edges(spark, d)
    return top.circuit_elements(e, e.filter("t2 <> 'GND'").agg(F.min("equipment_id").alias("e")).first().e)


def reachable_nodes(spark: SparkSession, d: str) -> DataFrame:
    return top.reachable_nodes(fx.edges(spark, d), _seeds(spark, d))


def reachable_not_through_ground(spark: SparkSession, d: str) -> DataFrame:
    return top.reachable_nodes(fx.edges(spark, d), _seeds(spark, d), through_ground=False)


def _seeds(spark: SparkSession, d: str) -> DataFrame:
    """Parts of which the key is divisible by 50, as nodes."""
    return fx.edges(spark, d).filter("part % 50 = 0").select(F.col("t1").alias("node")).distinct()


def descendants(spark: SparkSession, d: str) -> DataFrame:
    return comp.descendants(fx.tree(spark, d), spark.createDataFrame([("R-0",), ("R-3",)], "node string"), "id", "parent_id")


def station_owner(spark: SparkSession, d: str) -> DataFrame:
    return comp.roots(fx.tree(spark, d), "id", "parent_id").select(F.col("node").alias("id"), "root", "depth")


def station_subgraph(spark: SparkSession, d: str) -> DataFrame:
    """(role, id): containers below one region, their equipment, and nodes and edges of that equipment."""
    below = descendants_of(spark, d, "R-1")
    inside = fx.equipment(spark, d).join(below.withColumnRenamed("node", "container_id"), "container_id", "left_semi")
    e = fx.edges(spark, d).join(inside.select(F.col("id").alias("t2")), "t2", "left_semi")
    role = lambda df, r, c: df.select(F.lit(r).alias("role"), F.col(c).alias("id"))
    return role(below, "container", "node").union(role(inside, "equipment", "id")).union(role(e, "edge", "equipment_id")).union(role(top.endpoints(e), "node", "node").distinct())


def descendants_of(spark: SparkSession, d: str, root: str) -> DataFrame:
    return comp.descendants(fx.tree(spark, d), spark.createDataFrame([(root,)], "node string"), "id", "parent_id")


def container_counts(spark: SparkSession, d: str) -> DataFrame:
    return fx.tree(spark, d).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def geometry_in_box(spark: SparkSession, d: str) -> DataFrame:
    g = fx.geometry(spark, d)
    return g.filter(F.col("lat").between(48.0, 50.5) & F.col("lon").between(7.0, 9.25))


def cable_chains(spark: SparkSession, d: str) -> DataFrame:
    return top.cable_chains(fx.segments(spark, d))


def node_chains(spark: SparkSession, d: str) -> DataFrame:
    s = fx.segments(spark, d)
    return top.node_chains(s, top.cable_chains(s))


def station_islands(spark: SparkSession, d: str) -> DataFrame:
    """Islands among the edges of each order's customer nation."""
    return top.islands(fx.edges(spark, d), _owners(spark, d))


def _owners(spark: SparkSession, d: str) -> DataFrame:
    from gridloom.session import table

    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    own = o.select(F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("t2"), F.concat(F.lit("N-"), F.col("c_nationkey").cast("string")).alias("owner_id"))
    return fx.edges(spark, d).join(own, "t2").select("equipment_id", "owner_id")


def busbar_merge(spark: SparkSession, d: str) -> DataFrame:
    """Every fourth part's node is a section of one of ten busbars of its nation."""
    e, own = fx.edges(spark, d), _owners(spark, d)
    sections = e.join(own, "equipment_id").filter("part % 4 = 0").select("owner_id", F.concat(F.lit("B-"), (F.col("part") % 10).cast("string")).alias("busbar_id"), F.col("t1").alias("node")).distinct()
    return tm.busbar_merge(e, sections, own, [])


def _collapsed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts divisible by 3 have a busbar at their node; transformers stop a walk."""
    e = fx.edges(spark, d)
    bars = e.filter("part % 3 = 0").select(F.concat(F.lit("BB-"), "t1").alias("equipment_id"), F.col("t1").alias("node_id")).distinct()
    end = lambda no: e.filter("t2 <> 'GND'").select(F.concat("equipment_id", F.lit(f"#T{no}")).alias("terminal_id"), "equipment_id", F.col(f"t{no}").alias("node_id"))
    terminals = end(1).union(end(2)).union(bars.select(F.concat("equipment_id", F.lit("#T1")), "equipment_id", "node_id"))
    kinds = e.select("equipment_id", "class", F.when(F.col("class") == "PowerTransformer", "transformer").alias("stop")).union(bars.select("equipment_id", F.lit("BusbarSection"), F.lit("busbar")))
    return chains.collapse(terminals, kinds)


def collapsed_connections(spark: SparkSession, d: str) -> DataFrame:
    return _collapsed(spark, d)[0].select("source_terminal", "target_terminal", "target_kind")


def collapsed_segments(spark: SparkSession, d: str) -> DataFrame:
    return _collapsed(spark, d)[2].select(F.substring_index("connection_id", "~", 2).alias("connection"), "equipment_id", "sequence_number")


def collapsed_terminals(spark: SparkSession, d: str) -> DataFrame:
    return _collapsed(spark, d)[1]


def topology_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Groups against supplied topological nodes: the part number in tens."""
    e = fx.edges(spark, d)
    supplied = e.select(F.col("t1").alias("node"), F.concat(F.lit("T-"), F.floor(F.col("part") / 2).cast("string")).alias("topological_node")).distinct()
    return top.topology_mismatch(top.electrical_groups(e), supplied)


QUERIES = {f.__name__: f for f in (
    circuits, circuits_whole, electrical_groups_whole, circuit_nodes, circuit_sizes, edge_circuits, electrical_groups, group_sizes, connected_pairs, whatif_circuits, circuit_elements, reachable_nodes,
    reachable_not_through_ground, descendants, station_owner, station_subgraph, container_counts, geometry_in_box, cable_chains, node_chains, station_islands, busbar_merge,
    collapsed_connections, collapsed_segments, collapsed_terminals, topology_mismatch,
)}

_CONNECTS = "class <> 'PowerTransformer' AND NOT coalesce(is_open, false) AND t2 <> 'GND'"


def _links(where: str, source: str = "fx_edge", name: str = "links") -> str:
    return f"{name} AS (SELECT t1 AS a, t2 AS b FROM {source} WHERE {where} UNION SELECT t2, t1 FROM {source} WHERE {where} UNION SELECT t1, t1 FROM {source} UNION SELECT t2, t2 FROM {source})"


_CIRCUITS = f"WITH RECURSIVE {fx.EDGES}, {_links(_CONNECTS)}, {fx.labels('links')}, circ AS (SELECT node, root AS circuit_id FROM label WHERE node <> 'GND'), touched AS (SELECT DISTINCT e.equipment_id, c.circuit_id FROM fx_edge e JOIN circ c ON c.node = e.t1 OR c.node = e.t2)"
_GROUPS = f"WITH RECURSIVE {fx.EDGES}, {_links('NOT is_open')}, {fx.labels('links')}"
_TURNED = "turned AS (SELECT equipment_id, t1, t2, class, CASE WHEN class = 'Switch' AND part % 5 = 0 THEN NOT is_open ELSE is_open END AS is_open FROM fx_edge)"
_WALK = "walk(node) AS (SELECT DISTINCT t1 FROM fx_edge WHERE part % 50 = 0 UNION SELECT CASE WHEN e.t1 = w.node THEN e.t2 ELSE e.t1 END FROM walk w JOIN fx_edge e ON (e.t1 = w.node OR e.t2 = w.node){})"
_CHAINS = f"""WITH RECURSIVE {fx.EDGES}, {fx.SEGMENTS},
ends AS (SELECT equipment_id, t1 AS node FROM fx_segment UNION ALL SELECT equipment_id, t2 FROM fx_segment),
joint AS (SELECT min(equipment_id) AS a, max(equipment_id) AS b FROM ends GROUP BY node HAVING count(*) = 2 AND min(equipment_id) <> max(equipment_id)),
links AS (SELECT a, b FROM joint UNION SELECT b, a FROM joint UNION SELECT equipment_id, equipment_id FROM fx_segment),
{fx.labels('links')},
chain AS (SELECT node AS equipment_id, 'acline:' || min(node) OVER w || ':' || max(node) OVER w AS chain_id, 'ACLine ' || left(min(node) OVER w, 8) AS chain_name FROM label WINDOW w AS (PARTITION BY root))"""

_COLLAPSED = f"""WITH RECURSIVE {fx.EDGES},
bar AS (SELECT DISTINCT 'BB-' || t1 AS eq, t1 AS node FROM fx_edge WHERE part % 3 = 0),
term AS (SELECT equipment_id || '#T1' AS k, equipment_id AS eq, t1 AS node, class, CASE WHEN class = 'PowerTransformer' THEN 'transformer' END AS stop FROM fx_edge WHERE t2 <> 'GND'
  UNION ALL SELECT equipment_id || '#T2', equipment_id, t2, class, CASE WHEN class = 'PowerTransformer' THEN 'transformer' END FROM fx_edge WHERE t2 <> 'GND'
  UNION ALL SELECT eq || '#T1', eq, node, 'BusbarSection', 'busbar' FROM bar),
deg AS (SELECT node, count(DISTINCT eq) AS n FROM term GROUP BY node),
walk(src, src_eq, node, eqs, nodes, segs, here, stop, done) AS (
  SELECT t.k, t.eq, t.node, [t.eq], [t.node], CAST([] AS VARCHAR[]), t.k, CAST(NULL AS VARCHAR), false FROM term t JOIN deg USING (node) WHERE t.stop = 'busbar' AND n > 1
  UNION ALL
  SELECT w.src, w.src_eq, coalesce(f.node, t.node), list_append(w.eqs, t.eq), CASE WHEN f.node IS NULL THEN w.nodes ELSE list_append(w.nodes, f.node) END,
    CASE WHEN t.class = 'ACLineSegment' AND t.stop IS NULL THEN list_append(w.segs, t.eq) ELSE w.segs END, coalesce(f.k, t.k), CASE WHEN t.stop IS NOT NULL THEN t.stop WHEN g.n = 1 THEN 'dead_end' END, t.stop IS NOT NULL OR g.n = 1
  FROM walk w JOIN term t ON t.node = w.node AND NOT list_contains(w.eqs, t.eq)
  LEFT JOIN term f ON t.stop IS NULL AND f.eq = t.eq AND f.k <> t.k
  LEFT JOIN deg g ON g.node = f.node
  WHERE NOT w.done AND (t.stop IS NOT NULL OR (f.k IS NOT NULL AND NOT list_contains(w.nodes, f.node)))),
con AS (SELECT DISTINCT * FROM walk WHERE done AND (stop <> 'busbar' OR src_eq < list_last(eqs)))"""

ORACLES = {
    "busbar_merge": f"""WITH RECURSIVE {fx.EDGES},
own AS (SELECT 'N-' || c_nationkey AS o, e.* FROM fx_edge e JOIN orders ON e.t2 = 'O-' || o_orderkey JOIN customer ON o_custkey = c_custkey),
links AS (SELECT o || '/' || t1 AS a, o || '/' || t2 AS b FROM own UNION SELECT o || '/' || t2, o || '/' || t1 FROM own), {fx.labels('links')},
sec AS (SELECT DISTINCT o, 'B-' || (part % 10) AS bb, t1 AS node FROM own WHERE part % 4 = 0),
split AS (SELECT o, bb, min(s.node) AS merged FROM sec s JOIN label l ON l.node = o || '/' || s.node GROUP BY o, bb HAVING count(DISTINCT root) > 1)
SELECT s.o AS owner_id, s.node, min(merged) AS merged FROM sec s JOIN split p ON p.o = s.o AND p.bb = s.bb GROUP BY ALL HAVING min(merged) <> s.node""",
    "collapsed_connections": f"{_COLLAPSED} SELECT src AS source_terminal, here AS target_terminal, stop AS target_kind FROM con",
    "collapsed_segments": f"{_COLLAPSED} SELECT src || '~' || here AS connection, unnest(segs) AS equipment_id, CAST(unnest(range(1, len(segs) + 1)) AS INT) AS sequence_number FROM con",
    "circuits": f"""{_CIRCUITS},
per AS (SELECT equipment_id, count(*) AS k FROM touched GROUP BY 1),
edg AS (SELECT t.circuit_id, count(*) AS n_edges, CAST(sum(CASE WHEN p.k > 1 OR e.t2 = 'GND' THEN 1 ELSE 0 END) AS BIGINT) AS n_boundary FROM touched t JOIN per p USING (equipment_id) JOIN fx_edge e USING (equipment_id) GROUP BY 1)
SELECT c.circuit_id, c.n_nodes, coalesce(n_edges, 0) AS n_edges, coalesce(n_boundary, 0) AS n_boundary FROM (SELECT circuit_id, count(*) AS n_nodes FROM circ GROUP BY 1) c LEFT JOIN edg USING (circuit_id)""",
    "circuit_nodes": f"{_CIRCUITS} SELECT node, circuit_id FROM circ",
    "circuit_sizes": f"{_CIRCUITS} SELECT n_nodes, count(*) AS n_circuits FROM (SELECT count(*) AS n_nodes FROM circ GROUP BY circuit_id) GROUP BY 1",
    "edge_circuits": f"{_CIRCUITS} SELECT equipment_id, circuit_id FROM touched",
    "electrical_groups": f"{_GROUPS} SELECT node, root AS group_id FROM label",
    "group_sizes": f"{_GROUPS} SELECT root AS group_id, count(DISTINCT node) AS n_nodes FROM label GROUP BY 1",
    "connected_pairs": f"{_GROUPS} SELECT DISTINCT e.t1 AS a, e.t2 AS b, x.root = y.root AS connected FROM fx_edge e JOIN label x ON x.node = e.t1 JOIN label y ON y.node = e.t2",
    "whatif_circuits": f"""WITH RECURSIVE {fx.EDGES}, {_TURNED}, {_links(_CONNECTS)}, {_links(_CONNECTS, 'turned', 'links2')}, {fx.labels('links')}, {fx.labels('links2', 'label2')}
SELECT 'base' AS scenario, count(*) AS n_circuits, max(n) AS largest FROM (SELECT count(*) AS n FROM label WHERE node <> 'GND' GROUP BY root)
UNION ALL SELECT 'turned', count(*), max(n) FROM (SELECT count(*) AS n FROM label2 WHERE node <> 'GND' GROUP BY root)""",
    "circuit_elements": f"{_CIRCUITS} SELECT circuit_id, equipment_id FROM touched WHERE circuit_id IN (SELECT circuit_id FROM touched WHERE equipment_id = (SELECT min(equipment_id) FROM fx_edge WHERE t2 <> 'GND'))",
    "reachable_nodes": f"WITH RECURSIVE {fx.EDGES}, {_WALK.format('')} SELECT node FROM walk",
    "reachable_not_through_ground": f"WITH RECURSIVE {fx.EDGES}, {_WALK.format(chr(32) + 'WHERE w.node <> ' + chr(39) + 'GND' + chr(39))} SELECT node FROM walk",
    "descendants": f"WITH RECURSIVE {fx.TREE}, below(node) AS (SELECT id FROM fx_tree WHERE parent_id IN ('R-0', 'R-3') UNION SELECT t.id FROM below b JOIN fx_tree t ON t.parent_id = b.node) SELECT node FROM below",
    "station_owner": f"WITH RECURSIVE {fx.TREE}, up(id, here, depth) AS (SELECT id, id, 0 FROM fx_tree UNION ALL SELECT u.id, t.parent_id, u.depth + 1 FROM up u JOIN fx_tree t ON t.id = u.here WHERE t.parent_id IS NOT NULL) SELECT id, arg_max(here, depth) AS root, max(depth) AS depth FROM up GROUP BY id",
    "station_subgraph": f"""WITH RECURSIVE {fx.TREE}, {fx.EDGES}, {fx.EQUIPMENT}, below(node) AS (SELECT id FROM fx_tree WHERE parent_id = 'R-1' UNION SELECT t.id FROM below b JOIN fx_tree t ON t.parent_id = b.node),
inside AS (SELECT id FROM fx_equipment WHERE container_id IN (SELECT node FROM below)), e AS (SELECT * FROM fx_edge WHERE t2 IN (SELECT id FROM inside))
SELECT 'container' AS role, node AS id FROM below UNION ALL SELECT 'equipment', id FROM inside UNION ALL SELECT 'edge', equipment_id FROM e UNION ALL (SELECT 'node', t1 FROM e UNION SELECT 'node', t2 FROM e)""",
    "container_counts": f"WITH {fx.TREE} SELECT type, count(*) AS n FROM fx_tree GROUP BY type",
    "geometry_in_box": f"WITH {fx.GEOMETRY} SELECT * FROM fx_geometry WHERE lat BETWEEN 48.0 AND 50.5 AND lon BETWEEN 7.0 AND 9.25",
    "cable_chains": f"{_CHAINS} SELECT * FROM chain",
    "node_chains": f"{_CHAINS} SELECT node, min(chain_id) AS chain_id FROM ends JOIN chain USING (equipment_id) GROUP BY node",
    "station_islands": f"""WITH RECURSIVE {fx.EDGES},
own AS (SELECT 'N-' || c_nationkey AS owner_id, e.t1, e.t2 FROM fx_edge e JOIN orders o ON e.t2 = 'O-' || o.o_orderkey JOIN customer ON o_custkey = c_custkey),
links AS (SELECT owner_id || '/' || t1 AS a, owner_id || '/' || t2 AS b FROM own UNION SELECT owner_id || '/' || t2, owner_id || '/' || t1 FROM own),
{fx.labels('links')},
sizes AS (SELECT split_part(root, '/', 1) AS owner_id, split_part(root, '/', 2) AS component, count(*) AS n_nodes FROM label GROUP BY root)
SELECT * FROM sizes QUALIFY row_number() OVER (PARTITION BY owner_id ORDER BY n_nodes DESC, component) > 1""",
    "topology_mismatch": f"""{_GROUPS}, supplied AS (SELECT DISTINCT t1 AS node, 'T-' || CAST(part // 2 AS VARCHAR) AS tn FROM fx_edge),
pair AS (SELECT DISTINCT tn, root FROM supplied JOIN label USING (node))
SELECT 'topological_node' AS side, tn AS id, count(*) AS n FROM pair GROUP BY tn HAVING count(*) > 1 UNION ALL SELECT 'group', root, count(*) FROM pair GROUP BY root HAVING count(*) > 1""",
}
