"""Terminals to wiring: classification with anomalies, merges, nodes and edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.components import components
from gridloom.operators.staging import FACT, OBJECT, first_value, object_class

GROUND = "GND"
#: Classes whose terminals only name nodes; any number of terminals is right for them.
NODE_ROLE = ("Junction", "BusbarSection")
#: A device with more terminals than this is no two-terminal device anyway; no list of its terminals is kept.
MAX_LISTED = 2


def terminal_table(facts: DataFrame) -> DataFrame:
    """(version, terminal_id, equipment_id, node, seq): terminals with their connectivity node, else topological node."""
    t = facts.filter(F.col("class") == "Terminal").groupBy(*OBJECT)
    filled = lambda a: F.nullif(first_value(a), F.lit(""))
    return t.agg(
        filled("Terminal.ConductingEquipment").alias("equipment_id"), F.coalesce(filled("Terminal.ConnectivityNode"), filled("Terminal.TopologicalNode")).alias("node"),
        F.trim(first_value("ACDCTerminal.sequenceNumber")).alias("seq"),
    ).withColumnRenamed("id", "terminal_id")


def classify(terminals: DataFrame, classes: DataFrame, node_role: Sequence[str] = NODE_ROLE) -> DataFrame:
    """(version, equipment_id, class, role, node1, node2, n_nodes, anomaly): the wiring of every device with terminals.

    classes: (version, id, class). Two-terminal devices: node1 and node2 in order of their sequence, or an anomaly, the
    first that holds: number of terminals, terminal without node, sequence given twice, sequences other than 1 or 1 and 2.
    Node-role devices: node1 is the least of their different nodes. Only counts and extremes are aggregated, so a device
    with a million terminals is one row.
    """
    of = terminals.filter(F.col("equipment_id").isNotNull()).join(classes.select("version", F.col("id").alias("equipment_id"), "class"), ["version", "equipment_id"], "left")
    g = of.groupBy("version", "equipment_id", "class").agg(
        F.count(F.lit(1)).alias("n"), F.count("node").alias("with_node"), F.min("seq").alias("lo"), F.max("seq").alias("hi"),
        F.count("seq").alias("with_seq"), F.min(F.when(F.col("seq") == "1", F.col("node"))).alias("at1"), F.min(F.when(F.col("seq") == "2", F.col("node"))).alias("at2"),
        F.min("node").alias("least"), F.countDistinct("node").alias("n_nodes"),
    )
    role = F.when(F.col("class").isin(*node_role), "node").otherwise("edge")
    anomaly = (
        F.when((role == "node") & (F.col("with_node") < F.col("n")), "terminal without node")
        .when(role == "node", F.lit(None))
        .when(F.col("n") > MAX_LISTED, "more than two terminals")
        .when(F.col("with_node") < F.col("n"), "terminal without node")
        .when((F.col("n") == 2) & (F.col("with_seq") == 2) & (F.col("lo") == F.col("hi")), "sequence given twice")
        .when((F.col("n") == 1) & ~F.coalesce(F.col("lo") == "1", F.lit(False)), "single terminal not numbered 1")
        .when((F.col("n") == 2) & ~F.coalesce((F.col("lo") == "1") & (F.col("hi") == "2"), F.lit(False)), "terminals not numbered 1 and 2")
    )
    return g.select(
        "version", "equipment_id", "class", role.alias("role"), F.when(anomaly.isNull(), F.when(role == "node", F.col("least")).otherwise(F.col("at1"))).alias("node1"),
        F.when(anomaly.isNull() & (role == "edge") & (F.col("n") == 2), F.col("at2")).alias("node2"), "n_nodes", anomaly.alias("anomaly"),
    )


def without_terminals(terminals: DataFrame, equipment: DataFrame) -> DataFrame:
    """(version, equipment_id): equipment (version, id) that no terminal names."""
    used = terminals.select("version", F.col("equipment_id").alias("id")).distinct()
    return equipment.select("version", "id").distinct().join(used, ["version", "id"], "left_anti").withColumnRenamed("id", "equipment_id")


def model_edges(wiring: DataFrame) -> DataFrame:
    """(version, equipment_id, t1, t2, class): one edge per sound two-terminal device, GND for a missing second side."""
    sound = wiring.filter((F.col("role") == "edge") & F.col("anomaly").isNull() & F.col("node1").isNotNull())
    return sound.select("version", "equipment_id", F.col("node1").alias("t1"), F.coalesce("node2", F.lit(GROUND)).alias("t2"), "class")


def model_nodes(terminals: DataFrame, wiring: DataFrame) -> DataFrame:
    """(version, id, kind): every node of sound wiring, and GND where an edge uses it."""
    sound = wiring.filter(F.col("anomaly").isNull()).select("version", "equipment_id")
    real = terminals.join(sound, ["version", "equipment_id"], "left_semi").filter(F.col("node").isNotNull()).select("version", F.col("node").alias("id")).distinct()
    ground = model_edges(wiring).filter(F.col("t2") == GROUND).select("version").distinct()
    return real.filter(F.col("id") != GROUND).withColumn("kind", F.lit("real")).union(ground.select("version", F.lit(GROUND), F.lit("virtual")))


def junction_merge(terminals: DataFrame, classes: DataFrame, junction: str = "Junction") -> DataFrame:
    """(version, node, merged): all nodes of a junction are one, and so on over shared nodes; merged is the least of them."""
    own = terminals.join(classes.filter(F.col("class") == junction).select("version", F.col("id").alias("equipment_id")), ["version", "equipment_id"], "left_semi").filter(F.col("node").isNotNull())
    least = own.groupBy("version", "equipment_id").agg(F.min("node").alias("least"))
    return components(own.join(least, ["version", "equipment_id"]), "node", "least", ["version"]).withColumnRenamed("component", "merged").filter(F.col("node") != F.col("merged"))


def busbar_merge(edges: DataFrame, sections: DataFrame, owners: DataFrame, scope: Sequence[str] = ("version",)) -> DataFrame:
    """(*scope, owner_id, node, merged): where a busbar's sections lie in separate parts of its station, they become one node.

    sections: (*scope, owner_id, busbar_id, node); owners: (*scope, equipment_id, owner_id). The station's graph joins the
    ends of all its devices whatever their switch state, one-sided ones to GND. A busbar whose sections are joined already
    is left alone, otherwise all its sections' nodes become the least of them.
    """
    scope = list(scope)
    ends = edges.join(owners, [*scope, "equipment_id"]).select(*scope, "owner_id", F.col("t1").alias("a"), F.col("t2").alias("b"))
    at = sections.select(*scope, "owner_id", F.col("node").alias("a"), F.lit(None).cast("string").alias("b"))
    part = components(ends.union(at), "a", "b", [*scope, "owner_id"])
    found = sections.select(*scope, "owner_id", "busbar_id", "node").distinct().join(part, [*scope, "owner_id", "node"])
    split = found.groupBy(*scope, "owner_id", "busbar_id").agg(F.countDistinct("component").alias("k"), F.min("node").alias("merged")).filter("k > 1")
    return found.join(split, [*scope, "owner_id", "busbar_id"]).groupBy(*scope, "owner_id", "node").agg(F.min("merged").alias("merged")).filter(F.col("node") != F.col("merged"))


def zero_based(terminals: DataFrame) -> DataFrame:
    """Terminals with sequences from 1: a device whose sequences are just {0} or {0, 1} is counted up."""
    kinds = terminals.groupBy("version", "equipment_id").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.countDistinct("seq").alias("k")).filter("lo = '0' AND (hi = '0' OR (hi = '1' AND k = 2))")
    up = kinds.select("version", "equipment_id", F.lit(1).alias("_up"))
    return terminals.join(up, ["version", "equipment_id"], "left").withColumn("seq", F.when(F.col("_up") == 1, (F.col("seq").cast("int") + 1).cast("string")).otherwise(F.col("seq"))).drop("_up")


def split_busbars(terminals: DataFrame, busbars: DataFrame) -> DataFrame:
    """Terminals in which the n-th terminal of a busbar belongs to its copy `id#n` (the first to `id`), each numbered 1.

    busbars: (version, id). Terminals of a busbar are taken in id order.
    """
    from pyspark.sql import Window

    own = terminals.join(busbars.select("version", F.col("id").alias("equipment_id"), F.lit(True).alias("_b")).distinct(), ["version", "equipment_id"], "left")
    no = F.row_number().over(Window.partitionBy("version", "equipment_id").orderBy("terminal_id"))
    rest = own.filter(F.col("_b").isNull()).drop("_b")
    parts = own.filter(F.col("_b")).withColumn("_n", no)
    parts = parts.withColumn("equipment_id", F.when(F.col("_n") > 1, F.concat("equipment_id", F.lit("#"), F.col("_n").cast("string"))).otherwise(F.col("equipment_id"))).withColumn("seq", F.lit("1"))
    return rest.unionByName(parts.select(*rest.columns))


def nsc_facts(facts: DataFrame) -> DataFrame:
    """Facts of the second dialect as facts of the first: terminals counted from 1, busbars split into single-terminal copies.

    The n-th terminal of a busbar section, in id order, belongs to its copy `id#n` (the first to `id` itself), is numbered 1,
    and each copy has all facts of the section. A device with one terminal numbered 0 gets 1; with two numbered 0 and 1, 1
    and 2; anything else stays as it is. Repeated facts count once.
    """
    from pyspark.sql import Window

    facts = facts.select(*FACT).distinct()
    is_terminal = F.col("class") == "Terminal"
    t = terminal_table(facts).filter(F.col("equipment_id").isNotNull())
    busbars = facts.filter("class = 'BusbarSection'").select("version", F.col("id").alias("equipment_id")).distinct()
    of_bar = t.join(busbars, ["version", "equipment_id"], "left_semi").withColumn("_n", F.row_number().over(Window.partitionBy("version", "equipment_id").orderBy("terminal_id")))
    copy = F.when(F.col("_n") > 1, F.concat("equipment_id", F.lit("#"), F.col("_n").cast("string"))).otherwise(F.col("equipment_id"))
    bar = of_bar.select("version", F.col("terminal_id").alias("id"), copy.alias("_copy"), F.lit("1").alias("_seq"))
    other = t.join(busbars, ["version", "equipment_id"], "left_anti")
    kind = other.groupBy("version", "equipment_id").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).filter("lo = '0' AND (n = 1 OR n = 2 AND hi = '1')").select("version", "equipment_id")
    up = other.join(kind, ["version", "equipment_id"], "left_semi").select("version", F.col("terminal_id").alias("id"), F.lit(None).cast("string").alias("_copy"), (F.col("seq").cast("int") + 1).cast("string").alias("_seq"))
    mine = facts.filter(is_terminal).join(bar.unionByName(up), OBJECT, "left")
    value = F.when((F.col("attribute") == "Terminal.ConductingEquipment") & F.col("_copy").isNotNull(), F.col("_copy")).when((F.col("attribute") == "ACDCTerminal.sequenceNumber") & F.col("_seq").isNotNull(), F.col("_seq"))
    mine = mine.withColumn("value", F.coalesce(value, "value")).select(*FACT)
    copies = of_bar.filter("_n > 1").select("version", F.col("equipment_id").alias("id"), copy.alias("_copy"))
    more = facts.filter("class = 'BusbarSection'").join(copies, OBJECT).withColumn("id", F.col("_copy")).select(*FACT)
    return mine.unionByName(facts.filter(~F.coalesce(is_terminal, F.lit(False)))).unionByName(more)


def resolve_for(facts: DataFrame, ids: DataFrame) -> DataFrame:
    """classify for some equipment only (version, id): the facts are filtered to their terminals and to them before anything else.

    Equipment without any terminal comes out with the anomaly `no terminal`.
    """
    ids = ids.select(*OBJECT).distinct()
    own = facts.filter((F.col("attribute") == "Terminal.ConductingEquipment") & (F.col("class") == "Terminal")).select("version", F.col("value").alias("_e"), "id")
    terminals = own.join(ids.select("version", F.col("id").alias("_e")), ["version", "_e"], "left_semi").select(*OBJECT).distinct()
    some = facts.join(terminals, OBJECT, "left_semi")
    classes = class_of(facts.join(ids, OBJECT, "left_semi"))
    wiring = classify(terminal_table(some), classes)
    lost = ids.select("version", F.col("id").alias("equipment_id")).join(wiring.select("version", "equipment_id"), ["version", "equipment_id"], "left_anti")
    lost = lost.join(classes.withColumnRenamed("id", "equipment_id"), ["version", "equipment_id"], "left").withColumn("anomaly", F.lit("no terminal"))
    return wiring.unionByName(lost, allowMissingColumns=True)


def role_nodes(terminals: DataFrame, wiring: DataFrame) -> DataFrame:
    """(version, equipment_id, no, node): all different nodes of sound node-role devices in order, no from 1; 1 is node1, the others are further nodes."""
    from pyspark.sql import Window

    sound = wiring.filter("role = 'node' AND anomaly IS NULL").select("version", "equipment_id")
    nodes = terminals.filter("node IS NOT NULL").join(sound, ["version", "equipment_id"], "left_semi").select("version", "equipment_id", "node").distinct()
    return nodes.withColumn("no", F.row_number().over(Window.partitionBy("version", "equipment_id").orderBy("node"))).select("version", "equipment_id", "no", "node")


def class_of(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*OBJECT).agg(object_class().alias("class"))
