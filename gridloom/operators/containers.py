"""Containers from facts: stations, bays, busbars, houses and cables, which equipment they hold, and what could not be resolved.

Every frame is scoped by version. References are resolved by joins from the object that refers, each on a key that has one
row per object, so that a container with very many things in it is no hot group of the unique side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalar import bare_id, station_kind
from gridloom.operators import terminals as tm
from gridloom.operators.skew import salted_join
from gridloom.operators.staging import OBJECT, UNIT_OF, first_value, object_class
from gridloom.operators.topology import cable_chains
from gridloom.session import cut

#: Classes that are no equipment of a container by their own container reference.
NO_EQUIPMENT = ("Terminal", "ConnectivityNode", "Substation", "VoltageLevel", "Bay", "Feeder", "BusbarSection", "ACLineSegment", "Building")
CABLE, JUNCTION = "ACLineSegment", "Junction"
LEVEL, BAY, FEEDER, HOLDER, NODE_HOLDER = "VoltageLevel.Substation", "Bay.VoltageLevel", "Feeder.NormalEnergizingSubstation", "Equipment.EquipmentContainer", "ConnectivityNode.ConnectivityNodeContainer"


@dataclass
class Housing:
    """container(version, id, type, parent_id, name), member(version, equipment_id, class, container_id, rule), anomaly(version, object_id, message)."""

    container: DataFrame
    member: DataFrame
    anomaly: DataFrame


def is_generating_unit(class_: Column) -> Column:
    """Generating units are described by their machine and stand in no container of their own."""
    return F.coalesce(F.endswith(class_, F.lit("GeneratingUnit")), F.lit(False))


def _objects(facts: DataFrame) -> DataFrame:
    """One row per object with the references that say where it is; `has_holder`: it has a container reference, maybe empty."""
    filled = lambda a: F.nullif(F.trim(first_value(a)), F.lit(""))
    return facts.filter(F.col("id").isNotNull()).groupBy(*OBJECT).agg(
        object_class().alias("class"), F.coalesce(first_value("IdentifiedObject.name", False), F.lit("(unnamed)")).alias("name"), filled(LEVEL).alias("level_of"), filled(BAY).alias("bay_of"), filled(FEEDER).alias("feeder_of"),
        filled(HOLDER).alias("holder"), F.max((F.col("attribute") == HOLDER).cast("int")).alias("has_holder"), filled(UNIT_OF).alias("unit_of"), filled("PowerSystemResource.PSRType").alias("category"), filled(NODE_HOLDER).alias("node_holder"),
    )


def _found(df: DataFrame, ref: str, targets: DataFrame, out: str) -> DataFrame:
    """df with `out`: the column `home` of the target (version, id, home) that `ref` names, null if there is none."""
    t = targets.select(F.col("version").alias("_v"), F.col("id").alias("_i"), F.col("home").alias(out))
    return salted_join(df.withColumns({"_v": F.col("version"), "_i": F.col(ref)}), t, ["_v", "_i"], "left").drop("_v", "_i")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def resolve(facts: DataFrame, wiring: DataFrame | None = None) -> Housing:
    """The containers of a model, by these rules, of which the first that gives a container holds:

    * stations, bays (by level or feeder reference) and houses are containers; busbar sections are grouped to one busbar by
      voltage level, or by their id without copy number where they refer to the station;
    * a power-electronics connection takes the container of its unit (of several the least class and id that has one);
    * other equipment is in the bay, the station of the level, the station or the house that it names; a name that resolves
      to none of them is an anomaly;
    * cable segments belong to the chain of segments that meet in pairs (see topology.cable_chains);
    * equipment with an empty container reference is where its first node is, junctions without one likewise; a junction
      whose nodes are in no container belongs to the least cable chain at its first node that has one.

    facts repeated in all columns count once; wiring: terminals.classify of the facts, if there already. Anomalies are
    collected, none stops the others.
    """
    facts = facts.filter(F.col("class").isNotNull())
    o = cut(_objects(facts))
    of = lambda *classes: o.filter(F.col("class").isin(*classes))
    terminals = cut(tm.terminal_table(facts))
    wiring = wiring if wiring is not None else cut(tm.classify(terminals, o.select("version", "id", "class")))

    station = of("Substation").select("version", "id", F.col("id").alias("home"))
    house = of("Building").select("version", "id", F.col("id").alias("home"))
    level = cut(_found(of("VoltageLevel"), "level_of", station, "home"))
    good_level = level.filter("home IS NOT NULL").select("version", "id", "home")
    bay = cut(_found(of("Bay"), "bay_of", good_level, "home").unionByName(_found(of("Feeder"), "feeder_of", station, "home")))
    good_bay = bay.filter("home IS NOT NULL")
    category = of("PSRType").select("version", "id", F.col("name").alias("home"))
    named = _found(of("Substation"), "category", category, "category_name")

    # Where a thing is that names one of these: a bay counts itself, a level its station. Looked up once for all objects.
    kinds = {"station": station, "house": house, "level": good_level, "bay": good_bay.select("version", "id", F.col("id").alias("home"))}
    places = cut(_union([df.withColumn("kind", F.lit(k)) for k, df in kinds.items()]).groupBy("version", "id").agg(F.min(F.struct("home", "kind")).alias("home")))
    named_holder = cut(_found(o.filter("holder IS NOT NULL"), "holder", places, "place").select("version", "id", "class", "name", "holder", "unit_of", F.col("place.home").alias("home"), F.col("place.kind").alias("kind")))
    places = places.select("version", "id", "home.home")

    # Busbars.
    section = of("BusbarSection").select("version", "id", "class", "name").join(named_holder.select("version", "id", "holder", "home", "kind"), OBJECT, "left")
    busbar_id = F.when(F.col("kind") == "level", F.col("holder")).when(F.col("kind") == "station", F.concat(F.lit("busbar:"), bare_id(F.col("id"))))
    section = cut(section.withColumn("busbar", busbar_id).withColumnRenamed("home", "parent_id"))
    level_name = level.select("version", F.col("id").alias("busbar"), F.col("name").alias("level_name"))
    busbar = section.filter("busbar IS NOT NULL").groupBy("version", "busbar").agg(F.min("parent_id").alias("parent_id"), F.min(F.struct("id", "name"))["name"].alias("own_name"))
    busbar = busbar.join(level_name, ["version", "busbar"], "left")

    # Cables.
    segments = wiring.filter((F.col("class") == CABLE) & F.col("anomaly").isNull()).select("version", "equipment_id", F.col("node1").alias("t1"), F.col("node2").alias("t2"))
    chains = cut(cable_chains(segments, ["version"]))
    ends = segments.select("version", "equipment_id", F.explode(F.array("t1", "t2")).alias("node")).filter("node IS NOT NULL AND node <> ''")
    node_chain = ends.join(chains, ["version", "equipment_id"]).groupBy("version", F.col("node").alias("id")).agg(F.min("chain_id").alias("home"))

    # Equipment by its own reference, and connections by their units'.
    lent = named_holder.filter("unit_of IS NOT NULL AND home IS NOT NULL").groupBy("version", F.col("unit_of").alias("id")).agg(F.min(F.struct("class", "id", "home"))["home"].alias("lent"))
    devices = o.filter(~F.col("class").isin(*NO_EQUIPMENT) & ~is_generating_unit(F.col("class")) & F.col("unit_of").isNull())
    devices = devices.filter((F.col("has_holder") == 1) | (F.col("class") == JUNCTION)).select("version", "id", "class", "holder")
    devices = cut(devices.join(named_holder.select("version", "id", "home"), OBJECT, "left").join(lent, OBJECT, "left"))
    lone = devices.filter("lent IS NULL AND holder IS NULL").select("version", F.col("id").alias("equipment_id"), "class")

    # The rest by their nodes: of the nodes in order the first that names a container.
    sound = wiring.filter(F.col("anomaly").isNull()).select("version", "equipment_id")
    at = terminals.filter("node IS NOT NULL").join(lone.join(sound, ["version", "equipment_id"], "left_semi"), ["version", "equipment_id"])
    at = at.withColumn("no", F.when(F.col("class").isin(*tm.NODE_ROLE), F.lit("")).otherwise(F.coalesce("seq", F.lit(""))))
    holder_of_node = of("ConnectivityNode").filter("node_holder IS NOT NULL").select("version", "id", F.col("node_holder").alias("home"))
    at = _found(_found(at.withColumnRenamed("node", "n"), "n", holder_of_node, "node_holder"), "n", node_chain, "chain")
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("no", "n", c)))[c].alias(c)
    by_node = at.groupBy("version", "equipment_id", "class").agg(first("node_holder"), first("chain"))
    by_node = cut(_found(by_node, "node_holder", places, "home"))

    units = lent.join(o.select("version", "id", "class"), OBJECT, "left").join(section.filter("busbar IS NOT NULL").select("version", "id"), OBJECT, "left_anti")
    member = _union([
        section.filter("busbar IS NOT NULL").select("version", F.col("id").alias("equipment_id"), "class", F.col("busbar").alias("container_id"), F.lit("busbar").alias("rule")),
        units.select("version", F.col("id").alias("equipment_id"), "class", F.col("lent").alias("container_id"), F.lit("unit").alias("rule")),
        devices.filter("lent IS NULL AND home IS NOT NULL").select("version", F.col("id").alias("equipment_id"), "class", F.col("home").alias("container_id"), F.lit("reference").alias("rule")),
        chains.select("version", "equipment_id", F.lit(CABLE).alias("class"), F.col("chain_id").alias("container_id"), F.lit("chain").alias("rule")),
        by_node.filter("home IS NOT NULL").select("version", "equipment_id", "class", F.col("home").alias("container_id"), F.lit("node").alias("rule")),
        by_node.filter(F.col("home").isNull() & (F.col("class") == JUNCTION) & F.col("chain").isNotNull()).select("version", "equipment_id", "class", F.col("chain").alias("container_id"), F.lit("node chain").alias("rule")),
    ])
    none = F.lit(None).cast("string")
    container = _union([
        named.select("version", "id", station_kind(F.col("category_name")).alias("type"), none.alias("parent_id"), "name"),
        of("Building").select("version", "id", F.lit("house").alias("type"), none.alias("parent_id"), "name"),
        good_bay.select("version", "id", F.lit("bay").alias("type"), F.col("home").alias("parent_id"), "name"),
        busbar.select("version", F.col("busbar").alias("id"), F.lit("busbar").alias("type"), "parent_id", F.coalesce("level_name", "own_name").alias("name")),
        chains.groupBy("version", F.col("chain_id").alias("id")).agg(F.first("chain_name").alias("name")).select("version", "id", F.lit("acline").alias("type"), none.alias("parent_id"), "name"),
    ])

    def bad(df: DataFrame, message: Column | str, id_: str = "id") -> DataFrame:
        return df.select("version", F.col(id_).alias("object_id"), (F.lit(message) if isinstance(message, str) else message).alias("message"))

    lost = by_node.filter(F.col("home").isNull() & ((F.col("class") != JUNCTION) | F.col("chain").isNull()))
    anomaly = _union([
        bad(level.filter("home IS NULL"), f"{LEVEL} unresolved"),
        bad(bay.filter("home IS NULL AND class = 'Bay'"), f"{BAY} unresolved"),
        bad(bay.filter("home IS NULL AND class = 'Feeder'"), f"{FEEDER} unresolved"),
        bad(section.filter("busbar IS NULL"), "busbar section in no known level or station"),
        bad(devices.filter("lent IS NULL AND home IS NULL AND holder IS NOT NULL"), F.concat(F.lit("container "), "holder", F.lit(" is no bay, level, station or house"))),
        bad(wiring.filter((F.col("class") == CABLE) & F.col("anomaly").isNotNull()), F.concat(F.lit("cable segment: "), "anomaly"), "equipment_id"),
        bad(lone.join(by_node.select("version", "equipment_id"), ["version", "equipment_id"], "left_anti"), "no container, and no sound terminal with a node", "equipment_id"),
        bad(lost, F.when(F.col("class") == JUNCTION, "junction without container of its nodes and without cable").otherwise("no container, and none of its nodes has one"), "equipment_id"),
    ])
    return Housing(container, member, anomaly)


def line_references(facts: DataFrame) -> DataFrame:
    """(version, owner_id, key, value): of each cable segment its line, and the line's literals where the line is known."""
    line = facts.filter((F.col("class") == CABLE) & (F.col("attribute") == HOLDER) & (F.col("value") != "")).groupBy(*OBJECT).agg(first_value(HOLDER).alias("line"))
    own = line.select("version", F.col("id").alias("owner_id"), F.lit("cim:ACLineSegment.Line").alias("key"), F.col("line").alias("value"))
    of_line = facts.filter("class = 'Line' AND value IS NOT NULL").select("version", F.col("id").alias("line"), "attribute", "value").distinct()
    more = salted_join(line.withColumnRenamed("id", "owner_id"), of_line, ["version", "line"]).select("version", "owner_id", F.concat(F.lit("cim:Line."), "attribute").alias("key"), "value")
    return own.unionByName(more)


def build(facts: DataFrame, switch_states: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """The stored model of facts: container, equipment, node, edge (with switch states) and anomaly, all with version."""
    facts = cut(facts)
    terminals = cut(tm.terminal_table(facts))
    wiring = cut(tm.classify(terminals, tm.class_of(facts)))
    h = resolve(facts, wiring)
    edges = tm.model_edges(wiring).join(switch_states(facts).withColumnRenamed("id", "equipment_id"), ["version", "equipment_id"], "left")
    anomaly = h.anomaly.unionByName(wiring.filter("anomaly IS NOT NULL AND class <> 'ACLineSegment'").select("version", F.col("equipment_id").alias("object_id"), F.col("anomaly").alias("message")))
    return {"container": h.container, "equipment": h.member.select("version", F.col("equipment_id").alias("id"), "class", "container_id"), "node": tm.model_nodes(terminals, wiring), "edge": edges, "anomaly": anomaly}
