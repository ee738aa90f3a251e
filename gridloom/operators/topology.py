"""Electrical groups, circuits, what-if switching, cable chains, and questions on them.

Edges are (equipment_id, t1, t2, class, is_open); is_open is null for anything that is no switch. GND is the one virtual
node. Ids of groups and circuits are their least node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.components import components, reachable
from gridloom.session import cut

GROUND = "GND"
TRANSFORMER = "PowerTransformer"


def endpoints(edges: DataFrame, keep_ground: bool = True) -> DataFrame:
    """(node, equipment_id): both ends of every edge, without empty ones."""
    ends = edges.select(F.explode(F.array_distinct(F.array("t1", "t2"))).alias("node"), "equipment_id").filter(F.col("node").isNotNull() & (F.col("node") != ""))
    return ends if keep_ground else ends.filter(F.col("node") != GROUND)


def with_overrides(edges: DataFrame, overrides: DataFrame, scenario: Sequence[str] = ()) -> DataFrame:
    """Edges with the switch states of `overrides` (equipment_id, is_open[, scenario]); other equipment has no state to set."""
    new = overrides.select(*scenario, "equipment_id", F.col("is_open").alias("_new")).dropDuplicates([*scenario, "equipment_id"])
    state = F.when(F.col("is_open").isNotNull(), F.coalesce("_new", "is_open"))
    return edges.join(new, [*scenario, "equipment_id"], "left").withColumn("is_open", state).drop("_new")


def _joined(edges: DataFrame, connects: Column, scope: Sequence[str]) -> DataFrame:
    """Components over the connecting edges; the ends of the others are nodes of their own."""
    t2 = F.when(connects & (F.col("t2") != ""), F.col("t2"))
    ends = edges.select(*scope, F.col("t1").alias("a"), t2.alias("b")).union(edges.select(*scope, F.col("t2"), F.lit(None).cast("string")))
    return components(ends.filter(F.col("a") != ""), "a", "b", scope)


def electrical_groups(edges: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(*scope, node, group_id): nodes that closed switches connect; GND is a node like any other."""
    return _joined(edges, F.coalesce(~F.col("is_open"), F.lit(False)), scope).withColumnRenamed("component", "group_id")


def circuits(edges: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(*scope, node, circuit_id): nodes that anything but transformers, open switches and GND connects."""
    connects = (F.col("class") != TRANSFORMER) & ~F.coalesce("is_open", F.lit(False)) & (F.col("t1") != GROUND) & (F.col("t2") != GROUND)
    found = _joined(edges, F.coalesce(connects, F.lit(False)), scope).withColumnRenamed("component", "circuit_id")
    return found.filter(F.col("node") != GROUND)


def edge_circuits(edges: DataFrame, circuit_nodes: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(*scope, equipment_id, circuit_id): the one or two circuits an edge touches; edges at GND only touch none."""
    ends = edges.select(*scope, "equipment_id", F.explode(F.array_distinct(F.array("t1", "t2"))).alias("node"))
    # GND, the greatest hub, is in no circuit; its edges need not travel to it.
    ends = ends.filter(F.col("node").isNotNull() & (F.col("node") != GROUND) & (F.col("node") != ""))
    return ends.join(circuit_nodes, [*scope, "node"]).select(*scope, "equipment_id", "circuit_id").distinct()


def circuit_summary(edges: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(*scope, circuit_id, n_nodes, n_edges, n_boundary): boundary edges touch another circuit or GND."""
    nodes = cut(circuits(edges, scope))
    touched = cut(edge_circuits(edges, nodes, scope))
    per_edge = touched.groupBy(*scope, "equipment_id").agg(F.count(F.lit(1)).alias("k"))
    ground = edges.select(*scope, "equipment_id", ((F.col("t1") == GROUND) | (F.col("t2") == GROUND)).alias("ground"))
    by_edge = touched.join(per_edge, [*scope, "equipment_id"]).join(ground, [*scope, "equipment_id"]).groupBy(*scope, "circuit_id")
    counts = by_edge.agg(F.count(F.lit(1)).alias("n_edges"), F.sum(((F.col("k") > 1) | F.col("ground")).cast("long")).alias("n_boundary"))
    sizes = nodes.groupBy(*scope, "circuit_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    return sizes.join(counts, [*scope, "circuit_id"], "left").na.fill(0, ["n_edges", "n_boundary"])


def circuit_elements(edges: DataFrame, equipment_id: str) -> DataFrame:
    """(circuit_id, equipment_id) of all equipment in the circuits that one edge touches.

    Raises if there is no such edge, or if it touches GND only.
    """
    one = edges.filter(F.col("equipment_id") == equipment_id).select("t1", "t2").first()
    if one is None:
        raise ValueError(f"no edge {equipment_id}")
    if {one.t1, one.t2} <= {GROUND, None, ""}:
        raise ValueError(f"edge {equipment_id} touches no circuit")
    touched = edge_circuits(edges, circuits(edges))
    return touched.join(touched.filter(F.col("equipment_id") == equipment_id).select("circuit_id"), "circuit_id", "left_semi")


def electrically_connected(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, connected): whether groups lead from a to b, going over nodes that belong to several groups.

    groups: (node, group_id), a node possibly in several. Unknown nodes are connected to nothing, not even to themselves.
    """
    linked = components(groups.select(F.concat(F.lit("n:"), "node").alias("n"), F.concat(F.lit("g:"), "group_id").alias("g")), "n", "g")
    of = linked.filter(F.col("node").startswith("n:")).select(F.expr("substring(node, 3)").alias("node"), "component")
    a, b = of.select(F.col("node").alias("a"), F.col("component").alias("ca")), of.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return pairs.select("a", "b").join(a, "a", "left").join(b, "b", "left").select("a", "b", F.coalesce(F.col("ca") == F.col("cb"), F.lit(False)).alias("connected"))


def reachable_nodes(edges: DataFrame, seeds: DataFrame, through_ground: bool = True) -> DataFrame:
    """(node): physically reachable, whatever the switches; through_ground=False doesn't pass GND."""
    return reachable(edges.filter("t1 <> '' AND t2 <> ''"), seeds, "t1", "t2", () if through_ground else (GROUND,))


def cable_chains(segments: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(*scope, equipment_id, chain_id, chain_name): cable segments (*scope, equipment_id, t1, t2) joined where exactly two ends meet.

    One end or three end a chain. A segment with both ends on one node counts twice there and joins nothing. The id names
    the least and the greatest segment of the chain.
    """
    scope = list(scope)
    ends = segments.select(*scope, "equipment_id", F.posexplode(F.array("t1", "t2")).alias("side", "node")).filter(F.col("node").isNotNull() & (F.col("node") != ""))
    joints = ends.groupBy(*scope, "node").agg(F.count(F.lit(1)).alias("n"), F.min("equipment_id").alias("a"), F.max("equipment_id").alias("b")).filter("n = 2 AND a <> b")
    links = segments.select(*scope, F.col("equipment_id").alias("a"), F.lit(None).cast("string").alias("b")).union(joints.select(*scope, "a", "b"))
    of = components(links, "a", "b", scope).withColumnRenamed("node", "equipment_id")
    spans = of.groupBy(*scope, "component").agg(F.min("equipment_id").alias("lo"), F.max("equipment_id").alias("hi"))
    chain = F.concat(F.lit("acline:"), "lo", F.lit(":"), "hi")
    return of.join(spans, [*scope, "component"]).select(*scope, "equipment_id", chain.alias("chain_id"), F.concat(F.lit("ACLine "), F.substring("lo", 1, 8)).alias("chain_name"))


def node_chains(segments: DataFrame, chains: DataFrame) -> DataFrame:
    """(node, chain_id): the least chain that touches a node."""
    ends = segments.select("equipment_id", F.explode(F.array("t1", "t2")).alias("node")).filter(F.col("node").isNotNull() & (F.col("node") != GROUND))
    return ends.join(chains, "equipment_id").groupBy("node").agg(F.min("chain_id").alias("chain_id"))


def islands(edges: DataFrame, owners: DataFrame) -> DataFrame:
    """(owner_id, component, n_nodes): within each owner's equipment every component but the largest (the least id of equals).

    owners: (equipment_id, owner_id). GND joins nothing. Edges without owner are left out.
    """
    own = edges.join(owners, "equipment_id").select("owner_id", F.when(F.col("t1") != GROUND, F.col("t1")).alias("a"), F.when(F.col("t2") != GROUND, F.col("t2")).alias("b"))
    found = components(own, "a", "b", ["owner_id"])
    sizes = found.groupBy("owner_id", "component").agg(F.count(F.lit(1)).alias("n_nodes"))
    largest = sizes.groupBy("owner_id").agg(F.max(F.struct("n_nodes", F.lit(1).alias("_x"))).alias("m"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    top = sizes.join(largest, "owner_id").filter(F.col("n_nodes") == F.col("m.n_nodes")).groupBy("owner_id").agg(F.min("component").alias("component"))
    return sizes.join(largest.select("owner_id"), "owner_id", "left_semi").join(top, ["owner_id", "component"], "left_anti")


def topology_mismatch(groups: DataFrame, supplied: DataFrame) -> DataFrame:
    """(side, id, n): supplied nodes (node, topological_node) spread over several groups, and groups over several supplied nodes."""
    both = supplied.join(groups, "node").select("topological_node", "group_id").distinct()
    one = both.groupBy(F.col("topological_node").alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("topological_node").alias("side"), "id", "n")
    return one.union(both.groupBy(F.col("group_id").alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("group").alias("side"), "id", "n"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in a total order (DISTINCT ON)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")
