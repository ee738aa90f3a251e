"""Relational projection of a grid model for downstream consumers: one function per view.

All keys are derived from the text ids by ext_id. Rows that a view's inner conditions exclude are absent by design.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalar import attr_text, ext_id, json_text, mapped
from gridloom.operators.components import components
from gridloom.operators.skew import ordered
from gridloom.operators.topology import GROUND, TRANSFORMER, first_per_key
from gridloom.session import cut

#: Control-unit types and the satellite classes they come from.
UNIT_TYPES = {"AirConditioningUnit": "AIRCONDITION", "Heatpump": "HEATPUMP", "BatteryUnit": "STORAGE"}
UNIT_CLASSES = (*UNIT_TYPES, "PhotoVoltaicUnit")
#: Type, warning, critical and target fraction of the default thresholds.
THRESHOLDS = [(1, "OVERLOAD", 0.8, 0.9, 0.85), (2, "OVERVOLTAGE", 1.05, 1.08, 1.065), (3, "UNDERVOLTAGE", 0.95, 0.92, 0.935)]
#: Views that have columns but never rows.
EMPTY_VIEWS = {
    "switching_state": "id long, terminal_id long, state boolean, modified_date timestamp, modified_by string",
    "switching_state_history": "id long, terminal_id long, state boolean, modified_date timestamp, modified_by string",
    "circuit_config": "id long, circuit_id long, load_limitation_mode string, modified_date timestamp, modified_by string, modified_reason string",
    "circuit_config_history": "id long, circuit_id long, load_limitation_mode string, modified_date timestamp, modified_by string, modified_reason string",
    "sensitivity": "id long, calculation_trigger string, steua_id long, terminal_id long, sensitivity_power double, sensitivity_voltage double, modified_date timestamp",
    "sensitivity_history": "id long, calculation_trigger string, steua_id long, terminal_id long, sensitivity_power double, sensitivity_voltage double, modified_date timestamp",
}


@dataclass
class Model:
    """container(id, type, parent_id), equipment(id, container_id), edge(equipment_id, t1, t2), geometry(owner_id, owner_kind,
    lat, lon) and attribute(owner_id, key, seq, value), where value is JSON and key `satellite` holds nested objects."""

    container: DataFrame
    equipment: DataFrame
    edge: DataFrame
    geometry: DataFrame
    attribute: DataFrame

    def first(self, key: str, as_: str, kind: str = "string") -> DataFrame:
        """(owner_id, as_): the first value of an attribute."""
        return self.attribute.filter((F.col("key") == key) & (F.col("seq") == 0)).select("owner_id", attr_text(F.col("value")).try_cast(kind).alias(as_))

    def names(self) -> DataFrame:
        """(owner_id, name): the attribute `name`, else `IdentifiedObject.name`."""
        a = self.attribute.filter(F.col("key").isin("name", "IdentifiedObject.name"))
        pick = lambda k: F.max(F.when(F.col("key") == k, attr_text(F.col("value"))))
        return a.groupBy("owner_id").agg(F.coalesce(pick("name"), pick("IdentifiedObject.name")).alias("name"))

    def classes(self) -> DataFrame:
        return self.first("cim_class", "cim_class").withColumnRenamed("owner_id", "equipment_id")

    def satellites(self, *classes: str) -> DataFrame:
        """(owner_id, seq, class, value) of the nested objects, of some classes only if named."""
        s = self.attribute.filter(F.col("key") == "satellite").select("owner_id", "seq", F.get_json_object("value", "$.class").alias("class"), "value")
        return s.filter(F.col("class").isin(*classes)) if classes else s

    def places(self, kind: str) -> DataFrame:
        return self.geometry.filter(F.col("owner_kind") == kind).select("owner_id", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))


def container(m: Model) -> DataFrame:
    c = m.container.filter(F.col("type").isin("substation", "distribution-box"))
    c = c.join(m.names(), c["id"] == F.col("owner_id"), "left").drop("owner_id")
    c = c.join(m.places("container"), c["id"] == F.col("owner_id"), "left")
    kind = F.upper(F.replace(F.col("type"), F.lit("-"), F.lit("_")))
    return c.select(ext_id(F.col("id")).alias("id"), F.col("id").alias("external_id"), "name", kind.alias("container_type"), F.lit(None).cast("string").alias("address"), "latitude", "longitude")


def transformer(m: Model) -> DataFrame:
    """With the greatest rating and power factor over the transformer's ends."""
    value = lambda k: F.max(json_text(F.col("value"), k).try_cast("double"))
    ends = m.satellites("PowerTransformerEnd").groupBy(F.col("owner_id").alias("equipment_id")).agg(value("PowerTransformerEnd.ratedS").alias("nominal_apparent_power"), value("PowerTransformerEnd.maxFactor").alias("max_apparent_power_factor"))
    e = m.equipment.withColumnRenamed("id", "equipment_id").join(m.classes().filter(F.col("cim_class") == TRANSFORMER), "equipment_id").join(ends, "equipment_id", "left")
    return e.select(
        ext_id(F.col("equipment_id")).alias("id"), ext_id(F.col("container_id")).alias("container_id"), F.lit(1).alias("strip_number"),
        "nominal_apparent_power", F.lit(None).cast("int").alias("max_apparent_power"), "max_apparent_power_factor",
    )


def busbar(m: Model) -> DataFrame:
    return m.container.filter(F.col("type") == "busbar").select(ext_id(F.col("id")).alias("id"), ext_id(F.col("parent_id")).alias("container_id"))


def feeder_area(m: Model) -> DataFrame:
    c = m.container.filter(F.col("type") == "bay")
    none = F.lit(None).cast("bigint")
    return c.join(m.names(), c["id"] == F.col("owner_id"), "left").select(ext_id(F.col("id")).alias("id"), F.col("id").alias("external_id"), "name", none.alias("net_island"), none.alias("network_group_id"))


def house_connection(m: Model) -> DataFrame:
    """Houses; power and market location from the usage points of their equipment, the address from its location."""
    own = m.equipment.select(F.col("id").alias("owner_id"), "container_id")
    text = lambda k: F.max(json_text(F.col("value"), k))
    power = F.max(json_text(F.col("value"), "UsagePoint.ratedPower").try_cast("double"))
    facts = m.satellites("UsagePoint", "UsagePointLocation").join(own, "owner_id").groupBy("container_id").agg(
        power.alias("rated_power"), text("UsagePoint.marketParticipantLocationIdentifier").alias("malo"), text("Location.mainAddress").alias("address")
    )
    h = m.container.filter(F.col("type") == "house").select("id")
    h = h.join(facts, h["id"] == F.col("container_id"), "left").join(m.names(), h["id"] == F.col("owner_id"), "left").drop("owner_id").join(m.places("container"), h["id"] == F.col("owner_id"), "left")
    return h.select(
        ext_id(F.col("id")).alias("id"), F.coalesce("address", "name", "id").alias("address"), "latitude", "longitude",
        F.coalesce("rated_power", F.lit(0.0)).alias("rated_power"), F.coalesce("malo", "id").alias("malo"), F.col("id").alias("network_area_id"),
    )


def network_device(m: Model, device_circuits: DataFrame | None = None, group_id: int | None = None) -> DataFrame:
    """Transformers, busbars and houses; with (network_device_id, circuit_id) one row for each circuit of a device."""
    none = F.lit(None).cast("string")
    ids = transformer(m).select("id").unionByName(busbar(m).select("id")).unionByName(house_connection(m).select("id"))
    if device_circuits is None:
        ids = ids.withColumn("net_island", F.lit(None).cast("bigint"))
    else:
        ids = ids.join(device_circuits.select(F.col("network_device_id").alias("id"), F.col("circuit_id").alias("net_island")), "id", "left")
    return ids.select("id", none.alias("external_id"), none.alias("name"), "net_island", F.lit(group_id).cast("bigint").alias("network_group_id"))


def terminal_index(m: Model) -> DataFrame:
    """(terminal_key, equipment_id, terminal_no, node_id, container_id, cim_class): both sides of edges, and bare busbar sections."""
    side = lambda no: m.edge.select(F.concat("equipment_id", F.lit(f"#T{no}")).alias("terminal_key"), "equipment_id", F.lit(no).alias("terminal_no"), F.col(f"t{no}").alias("node_id"))
    own = m.equipment.select(F.col("id").alias("equipment_id"), "container_id")
    sides = side(1).unionByName(side(2)).join(own, "equipment_id").join(m.classes(), "equipment_id", "left")
    bars = m.first("busbar_node_id", "node_id").withColumnRenamed("owner_id", "equipment_id").filter(~F.contains(F.col("equipment_id"), F.lit("#")))
    bars = bars.join(m.edge.select("equipment_id"), "equipment_id", "left_anti").join(own, "equipment_id")
    bars = bars.select(F.concat("equipment_id", F.lit("#T1")).alias("terminal_key"), "equipment_id", F.lit(1).alias("terminal_no"), "node_id", "container_id", F.lit("BusbarSection").alias("cim_class"))
    return sides.select(*bars.columns).unionByName(bars)


def terminal(m: Model) -> DataFrame:
    t = terminal_index(m).drop("cim_class").join(m.classes(), "equipment_id")
    t = t.join(m.container.select(F.col("id").alias("container_id"), F.col("type").alias("container_type")), "container_id")
    t = t.join(m.names().withColumnRenamed("owner_id", "equipment_id"), "equipment_id", "left").join(m.places("equipment").withColumnRenamed("owner_id", "equipment_id"), "equipment_id", "left")
    t = t.join(m.first("Fuse.nominalCurrent", "current", "int").withColumnRenamed("owner_id", "equipment_id"), "equipment_id", "left")
    own, box = ext_id(F.col("equipment_id")), ext_id(F.col("container_id"))
    device = F.when(F.col("cim_class") == TRANSFORMER, own).when((F.col("cim_class") == "BusbarSection") | (F.col("container_type") == "house"), box)
    feeder = F.when((F.col("cim_class") != TRANSFORMER) & (F.col("container_type") == "bay"), box)
    return t.select(
        ext_id(F.col("terminal_key")).alias("id"), F.col("terminal_key").alias("external_id"), "name", device.alias("network_device_id"), feeder.alias("feeder_area_id"),
        mapped(F.col("cim_class"), {"Fuse": "FUSE", "Switch": "SWITCH"}, "NOT_SWITCHABLE").alias("type"), F.lit(True).alias("default_switching_state"),
        F.col("current").alias("fuse_value"), F.col("current").alias("fuse_nominal_current"), "latitude", "longitude",
    )


def terminal_feeder_end_extension(m: Model) -> DataFrame:
    return terminal(m).filter(F.col("feeder_area_id").isNotNull()).select("id", F.lit(None).cast("bigint").alias("sequence_number"), F.lit(None).cast("string").alias("first_segment_cable_type"))


def _members(m: Model) -> DataFrame:
    """(node_id, terminal_key, ...) of nodes other than GND with at least two terminals."""
    t = cut(terminal_index(m).filter(F.col("node_id") != GROUND))  # read more than once, here and by the callers
    return t.join(t.groupBy("node_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 2").select("node_id"), "node_id", "left_semi")


def connection(m: Model) -> DataFrame:
    """One per node with two or more terminals; its ends are the two least terminal keys."""
    t = _members(m).join(m.container.select(F.col("id").alias("container_id"), F.col("type").alias("box")), "container_id", "left")
    kind = F.when(F.col("cim_class") == TRANSFORMER, "TRANSFORMER").when(F.col("cim_class") == "BusbarSection", "BUSBAR").when(F.col("box") == "house", "HOUSE_CONNECTION")
    t = t.select("node_id", F.struct("terminal_key", kind.alias("kind")).alias("end"))
    # The two least of a node by two partial aggregates; no list of a node's terminals is made.
    first = t.groupBy("node_id").agg(F.min("end").alias("a"))
    second = t.join(first, "node_id").filter(F.col("end.terminal_key") > F.col("a.terminal_key")).groupBy("node_id").agg(F.min("end").alias("b"))
    both = first.join(second, "node_id")
    return both.select(
        ext_id(F.col("node_id")).alias("id"), F.col("node_id").alias("external_id"), ext_id(F.col("a.terminal_key")).alias("source_id"), F.col("a.kind").alias("source_device_type"),
        ext_id(F.col("b.terminal_key")).alias("target_id"), F.col("b.kind").alias("target_device_type"), F.lit(True).alias("is_active"),
    )


def connection_terminal_map(m: Model) -> DataFrame:
    t = ordered(_members(m).select("node_id", "terminal_key"), ["node_id"], ["terminal_key"], "no")
    return t.select(ext_id(F.concat("node_id", F.lit("~"), "terminal_key")).alias("id"), ext_id(F.col("node_id")).alias("connection_id"), ext_id(F.col("terminal_key")).alias("terminal_id"), (F.col("no") + 1).cast("int").alias("sequence_number"))


def line_path(m: Model) -> DataFrame:
    """(owner_id, path_positions): the path points of a cable in sequence order, as JSON."""
    n = lambda k, t: json_text(F.col("value"), f"PositionPoint.{k}").try_cast(t)
    p = m.satellites("PositionPoint").select("owner_id", F.struct(n("sequenceNumber", "int").alias("sequenceNumber"), n("xPosition", "double").alias("x"), n("yPosition", "double").alias("y")).alias("p"))
    return p.groupBy("owner_id").agg(F.to_json(F.sort_array(F.collect_list("p"))).alias("path_positions"))


def line_segment(m: Model) -> DataFrame:
    """One per cable at a node with two or more terminals: the least of its nodes, with length, resistance and path."""
    t = _members(m).filter(F.col("cim_class") == "ACLineSegment").groupBy("equipment_id").agg(F.min("node_id").alias("node_id"))
    t = t.withColumnRenamed("equipment_id", "owner_id").join(m.first("Conductor.length", "length", "double"), "owner_id", "left").join(m.first("ACLineSegment.r", "r", "double"), "owner_id", "left").join(line_path(m), "owner_id", "left")
    none = F.lit(None).cast("double")
    return t.select(
        ext_id(F.concat("node_id", F.lit("~seg~"), "owner_id")).alias("id"), ext_id(F.col("node_id")).alias("connection_id"), F.col("owner_id").alias("external_id"), F.lit(1).alias("sequence_number"),
        "length", "r", none.alias("x"), none.alias("bch"), none.alias("total_resistance"), "path_positions",
    )


def control_unit(m: Model) -> DataFrame:
    """Controllable units of houses: one row per unit satellite of a power-electronics connection."""
    e = m.equipment.select(F.col("id").alias("owner_id"), "container_id").join(m.classes().filter(F.col("cim_class") == "PowerElectronicsConnection").select(F.col("equipment_id").alias("owner_id")), "owner_id")
    e = e.join(m.container.filter(F.col("type") == "house").select(F.col("id").alias("container_id")), "container_id", "left_semi")
    e = e.join(m.satellites(*UNIT_CLASSES).select("owner_id", F.col("class").alias("unit"), F.col("value").alias("u")), "owner_id")
    e = e.join(m.satellites("RegulatingControl").select("owner_id", F.col("value").alias("rc")), "owner_id", "left").join(m.names(), "owner_id", "left")
    stepped = json_text(F.col("rc"), "RegulatingControl.discrete").try_cast("boolean")
    target = lambda k: F.when(~stepped, json_text(F.col("rc"), f"RegulatingControl.{k}AllowedTargetValue").try_cast("double"))
    none = F.lit(None).cast("bigint")
    return e.select(
        ext_id(F.col("owner_id")).alias("id"), F.col("owner_id").alias("external_id"), "name", none.alias("net_island"), none.alias("network_group_id"), ext_id(F.col("container_id")).alias("house_connection_id"),
        mapped(F.col("unit"), UNIT_TYPES).alias("steua_type"), F.when(F.col("unit") == "PhotoVoltaicUnit", "PRODUCER").otherwise("CONSUMER").alias("steua_role"),
        json_text(F.col("u"), "PowerElectronicsUnit.maxP").try_cast("double").alias("max_power"), F.lit(None).cast("int").alias("total_controllable_load"),
        F.when(stepped, "STEPPED").otherwise("STEPLESS").alias("steua_control_type"), target("min").alias("stepless_min"), target("max").alias("stepless_max"),
    )


def control_step(m: Model) -> DataFrame:
    s = m.satellites("DiscreteControlLimit")
    return s.select(ext_id(F.concat("owner_id", F.lit("~step~"), F.col("seq").cast("string"))).alias("id"), ext_id(F.col("owner_id")).alias("steua_id"), json_text(F.col("value"), "DiscreteControlLimit.value").try_cast("double").alias("step_value"))


def measuring_device(m: Model) -> DataFrame:
    """Meters, each with its first terminal."""
    t = terminal_index(m).drop("cim_class").join(m.classes().filter(F.col("cim_class") == "Meter"), "equipment_id")
    t = first_per_key(t, ["equipment_id"], ["terminal_no"]).select(F.col("equipment_id").alias("owner_id"), "terminal_key")
    up = m.satellites("UsagePoint").groupBy("owner_id").agg(F.min(F.struct("seq", json_text(F.col("value"), "UsagePoint.marketParticipantLocationIdentifier").alias("melo")))["melo"].alias("melo"))
    t = t.join(m.names(), "owner_id", "left").join(up, "owner_id", "left")
    none = F.lit(None)
    return t.select(
        ext_id(F.col("owner_id")).alias("id"), F.col("owner_id").alias("external_id"), "name", ext_id(F.col("terminal_key")).alias("terminal_id"), none.cast("bigint").alias("measuring_interval"),
        none.cast("bigint").alias("transmission_interval"), "melo", none.cast("string").alias("sign_convention"),
    )


def bridge_nodes(m: Model, terminals: DataFrame) -> DataFrame:
    """(group_id, node): the raw nodes of each busbar without voltage level (`busbar:...`) and of each junction, which are one place.

    terminals: equipment_id, node (terminals.terminal_table of one version): the wiring before nodes were merged.
    """
    bars = m.equipment.filter(F.col("container_id").startswith("busbar:")).select(F.col("id").alias("equipment_id"), F.col("container_id").alias("group_id"))
    junctions = m.classes().filter("cim_class = 'Junction'").select("equipment_id", F.col("equipment_id").alias("group_id"))
    return terminals.filter("node IS NOT NULL").join(bars.unionByName(junctions), "equipment_id").select("group_id", "node").distinct()


def bridged_circuits(nodes: DataFrame, bridges: DataFrame) -> DataFrame:
    """Circuits (node, circuit_id) joined where a bridge (group_id, node) touches several; a joined circuit has the least id."""
    touched = bridges.join(nodes, "node").select(F.concat(F.lit("g:"), "group_id").alias("g"), F.concat(F.lit("c:"), "circuit_id").alias("c")).distinct()
    of = components(touched, "g", "c").filter(F.col("node").startswith("c:")).select(F.expr("substring(node, 3)").alias("circuit_id"), F.expr("substring(component, 3)").alias("joined"))
    return nodes.join(of, "circuit_id", "left").select("node", F.coalesce("joined", "circuit_id").alias("circuit_id"))


def circuit_rows(nodes: DataFrame, m: Model, ends: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(circuit_id, external_id, name) and (circuit_id, device_id): names and member devices of the circuits (node, circuit_id).

    A circuit is named after the least end of its transformers (ends: id, name, transformer_id), else after its least
    transformer, busbar or house; its external id is that id and `-Island`, its name the end's name or the id. A transformer
    or house is a member of the least circuit that it touches, a busbar of all its sections' circuits.
    """
    t = terminal_index(m).join(nodes.withColumnRenamed("node", "node_id"), "node_id").join(m.container.select(F.col("id").alias("container_id"), "type"), "container_id", "left")
    pick = lambda cond, c: t.filter(cond).select(F.col(c).alias("device_id"), "circuit_id")
    one = lambda df, kind: df.groupBy("device_id").agg(F.min("circuit_id").alias("circuit_id")).withColumn("kind", F.lit(kind))
    members = one(pick(F.col("cim_class") == TRANSFORMER, "equipment_id"), 1)
    members = members.unionByName(pick(F.col("cim_class") == "BusbarSection", "container_id").distinct().withColumn("kind", F.lit(2)))
    members = members.unionByName(one(pick((F.col("type") == "house") & (F.col("cim_class") != TRANSFORMER), "container_id"), 3))
    candidates = members.select("circuit_id", F.struct("kind", F.col("device_id").alias("id"), F.col("device_id").alias("name")).alias("n"))
    if ends is not None:
        of = ends.select(F.col("transformer_id").alias("device_id"), F.struct(F.lit(0).alias("kind"), "id", F.coalesce(F.nullif("name", F.lit("")), "id").alias("name")).alias("n"))
        candidates = candidates.unionByName(members.filter("kind = 1").join(of, "device_id").select("circuit_id", "n"))
    named = candidates.groupBy("circuit_id").agg(F.min("n").alias("n"))
    return named.select("circuit_id", F.concat("n.id", F.lit("-Island")).alias("external_id"), F.col("n.name").alias("name")), members.select("circuit_id", "device_id").distinct()


def circuit_network_device_map(rows: DataFrame, members: DataFrame) -> DataFrame:
    both = members.join(rows, "circuit_id")
    return both.select(ext_id(F.concat("external_id", F.lit("~"), "device_id")).alias("id"), ext_id(F.col("external_id")).alias("circuit_id"), ext_id(F.col("device_id")).alias("network_device_id"))


def network_group(m: Model, key: str = "IdentifiedObject.networkGroup") -> DataFrame:
    """The one group that the attribute names: the least of its values."""
    g = m.attribute.filter(F.col("key") == key).agg(F.min(attr_text(F.col("value"))).alias("g")).filter(F.col("g").isNotNull())
    return g.select(ext_id(F.col("g")).alias("id"), F.col("g").alias("external_id"), F.col("g").alias("name"))


def threshold(spark) -> DataFrame:
    rows = spark.createDataFrame(THRESHOLDS, "id long, threshold_type string, warning_fraction double, critical_fraction double, load_limitation_target_fraction double")
    none = F.lit(None).cast("double")
    return rows.select(
        "id", F.lit(None).cast("bigint").alias("terminal_id"), F.lit("2020-01-01 00:00:00").cast("timestamp").alias("modified_date"), F.lit("SYSTEM").alias("modified_by"), F.lit(True).alias("is_default"),
        "threshold_type", "warning_fraction", none.alias("warning_value"), "critical_fraction", none.alias("critical_value"), "load_limitation_target_fraction", none.alias("load_limitation_target_value"),
    )


def empty_view(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], EMPTY_VIEWS[name])


def collapse_inputs(m: Model) -> tuple[DataFrame, DataFrame]:
    """Terminals and kinds of equipment as chains.collapse takes them: walks stop at busbars, transformers and what stands in a house."""
    t = cut(terminal_index(m))
    box = m.container.select(F.col("id").alias("container_id"), F.col("type").alias("box"))
    stop = F.when(F.col("cim_class") == "BusbarSection", "busbar").when(F.col("cim_class") == TRANSFORMER, "transformer").when(F.col("box") == "house", "house")
    kinds = t.join(box, "container_id", "left").select("equipment_id", F.col("cim_class").alias("class"), stop.alias("stop")).distinct()
    return t.filter(F.col("node_id") != GROUND).select(F.col("terminal_key").alias("terminal_id"), "equipment_id", "node_id"), kinds


def collapsed_views(m: Model, found: tuple[DataFrame, DataFrame, DataFrame]) -> dict[str, DataFrame]:
    """The views of terminals, connections, their map and line segments over collapsed connections (chains.collapse), in the columns of the plain ones.

    Terminals are those at which a connection begins, ends or passes; connections begin at busbars.
    """
    links, inside, segments = found
    key = lambda *c: ext_id(F.concat(*(x if not isinstance(x, str) else F.col(x) for x in c)))
    used = links.select(F.col("source_terminal").alias("external_id")).union(links.select("target_terminal")).union(inside.select("terminal_id")).distinct()
    connections = links.select(
        ext_id(F.col("connection_id")).alias("id"), F.col("connection_id").alias("external_id"), ext_id(F.col("source_terminal")).alias("source_id"), F.lit("BUSBAR").alias("source_device_type"), ext_id(F.col("target_terminal")).alias("target_id"),
        mapped(F.col("target_kind"), {"busbar": "BUSBAR", "transformer": "TRANSFORMER", "house": "HOUSE_CONNECTION"}).alias("target_device_type"), F.lit(True).alias("is_active"),
    )
    places = inside.select(key("connection_id", F.lit("~"), "terminal_id").alias("id"), ext_id(F.col("connection_id")).alias("connection_id"), ext_id(F.col("terminal_id")).alias("terminal_id"), "sequence_number")
    s = segments.withColumnRenamed("equipment_id", "owner_id").join(m.first("Conductor.length", "length", "double"), "owner_id", "left").join(m.first("ACLineSegment.r", "r", "double"), "owner_id", "left").join(line_path(m), "owner_id", "left")
    none = F.lit(None).cast("double")
    lines = s.select(
        key("connection_id", F.lit("~seg~"), "owner_id").alias("id"), ext_id(F.col("connection_id")).alias("connection_id"), F.col("owner_id").alias("external_id"), "sequence_number", "length", "r", none.alias("x"), none.alias("bch"),
        none.alias("total_resistance"), "path_positions",
    )
    return {"terminal": terminal(m).join(used, "external_id", "left_semi"), "connection": connections, "connection_terminal_map": places, "line_segment": lines}
