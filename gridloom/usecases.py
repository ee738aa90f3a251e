"""Questions on a stored grid model, one method each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import components as comp
from gridloom.operators import containers, staging
from gridloom.operators import topology as top


@dataclass
class Grid:
    """container(id, type, parent_id), equipment(id, container_id), node(id, kind), edge(equipment_id, t1, t2, class, is_open), geometry(owner_id, owner_kind, lat, lon)."""

    container: DataFrame
    equipment: DataFrame
    node: DataFrame
    edge: DataFrame
    geometry: DataFrame

    def station_subgraph(self, station: str) -> dict[str, DataFrame]:
        """Containers below a station, the equipment in it and them, its edges and their nodes; all empty for an unknown id."""
        here = self.container.filter(F.col("id") == station).select(F.col("id").alias("node"))
        below = comp.descendants(self.container, here, "id", "parent_id")
        inside = self.equipment.join(below.union(here).withColumnRenamed("node", "container_id"), "container_id", "left_semi")
        edges = self.edge.join(inside.select(F.col("id").alias("equipment_id")), "equipment_id", "left_semi")
        nodes = self.node.join(top.endpoints(edges).select(F.col("node").alias("id")).distinct(), "id", "left_semi")
        return {"container": self.container.join(below.withColumnRenamed("node", "id"), "id", "left_semi"), "equipment": inside, "edge": edges, "node": nodes}

    def reachable(self, seeds: DataFrame, through_ground: bool = True) -> DataFrame:
        return top.reachable_nodes(self.edge, seeds, through_ground)

    def electrically_connected(self, a: str, b: str, overrides: DataFrame | None = None) -> bool:
        """Whether closed switches lead from a to b, with some switches turned if overrides are given."""
        edges = self.edge if overrides is None else top.with_overrides(self.edge, overrides)
        pair = self.edge.sparkSession.createDataFrame([(a, b)], "a string, b string")
        return top.electrically_connected(top.electrical_groups(edges), pair).first().connected

    def in_box(self, south: float, west: float, north: float, east: float) -> DataFrame:
        """Geometry in a box, its borders included."""
        return self.geometry.filter(F.col("lat").between(south, north) & F.col("lon").between(west, east))

    def container_counts(self) -> DataFrame:
        return self.container.groupBy("type").agg(F.count(F.lit(1)).alias("n"))

    def what_if(self, scenarios: DataFrame) -> DataFrame:
        """(scenario, circuit_id, n_nodes, n_edges, n_boundary) of all scenarios (scenario, equipment_id, is_open) in one run."""
        names = scenarios.select("scenario").distinct()
        every = self.edge.crossJoin(names)  # a copy of the grid for each scenario
        return top.circuit_summary(top.with_overrides(every, scenarios, ["scenario"]), ["scenario"])

    def violations(self, nsc: bool = False, connectivity: bool = False, flagged: DataFrame | None = None) -> DataFrame:
        """(object_id, rule, message) of the rules on the stored model; all are collected, none stops the others.

        nsc: the model comes from the second dialect, where several cables at a bay are right. connectivity: also say which
        nodes lie off the largest part of the whole grid. flagged: only for these objects (column id).
        """
        found = rules(self.container, self.equipment, self.node, self.edge, nsc)
        if connectivity:
            found = found.union(off_the_main_part(self.edge))
        return found if flagged is None else found.join(flagged.select(F.col("id").alias("object_id")).distinct(), "object_id", "left_semi")

    @classmethod
    def from_facts(cls, facts: DataFrame) -> Grid:
        """The grid that the facts of one version describe."""
        m = {k: v.drop("version") for k, v in containers.build(facts, staging.switch_states).items()}
        points = staging.first_points(facts).select("owner_id", F.lit("equipment").alias("owner_kind"), "lat", "lon")
        return cls(m["container"], m["equipment"], m["node"], m["edge"], points)


def off_the_main_part(edge: DataFrame) -> DataFrame:
    """(object_id, rule, message): the parts of the grid, joined by any equipment but not by GND, other than the largest one; the object is a part's least node."""
    parts = top.islands(edge, edge.select("equipment_id", F.lit("").alias("owner_id")).distinct())
    return parts.select(F.col("component").alias("object_id"), F.lit("connectivity").alias("rule"), F.concat(F.lit("separate part of "), F.col("n_nodes").cast("string"), F.lit(" nodes")).alias("message"))


def voltage_levels(facts: DataFrame, equipment: DataFrame) -> DataFrame:
    """(version, object_id, rule, message): equipment (version, id, container_id) without exactly one base voltage, transformers without one or two.

    A transformer's voltages are its own and its ends'; other equipment without one has that of the voltage level that it
    names, or whose bay it names. Equipment that no fact describes is left out. Not among violations(): a rule that few
    models keep.
    """
    ref = lambda a: facts.filter((F.col("attribute") == a) & F.col("is_reference") & F.col("value").isNotNull() & (F.col("value") != ""))
    known = facts.groupBy("version", "id").agg(staging.object_class().alias("class")).join(equipment.select("version", "id").distinct(), ["version", "id"], "left_semi")
    own = ref("ConductingEquipment.BaseVoltage").select("version", "id", F.col("value").alias("voltage"))
    ends = ref("PowerTransformerEnd.PowerTransformer").select("version", F.col("id").alias("end"), F.col("value").alias("id"))
    of_end = ends.join(ref("TransformerEnd.BaseVoltage").select("version", F.col("id").alias("end"), F.col("value").alias("voltage")), ["version", "end"]).select("version", "id", "voltage")
    level = ref("VoltageLevel.BaseVoltage").groupBy("version", F.col("id").alias("holder")).agg(F.min("value").alias("voltage"))
    bay = ref("Bay.VoltageLevel").groupBy("version", F.col("id").alias("bay")).agg(F.min("value").alias("level"))
    named = ref("Equipment.EquipmentContainer").groupBy("version", "id").agg(F.min("value").alias("holder")).join(bay.withColumnRenamed("bay", "holder"), ["version", "holder"], "left")
    boxed = named.withColumn("holder", F.coalesce("level", "holder")).join(level, ["version", "holder"]).select("version", "id", "voltage")
    count = lambda df, n: df.groupBy("version", "id").agg(F.countDistinct("voltage").alias(n))
    k = known.join(count(own, "own"), ["version", "id"], "left").join(count(own.union(of_end), "all"), ["version", "id"], "left").join(count(boxed, "box"), ["version", "id"], "left").na.fill(0, ["own", "all", "box"])
    trafo = F.col("class") == top.TRANSFORMER
    n = F.when(trafo, F.col("all")).when(F.col("own") == 0, F.least(F.col("box"), F.lit(1))).otherwise(F.col("own"))
    k = k.withColumn("n", n).filter((F.col("n") == 0) | (F.col("n") > F.when(trafo, 2).otherwise(1)))
    message = F.when(F.col("n") == 0, "no voltage level").otherwise(F.concat(F.col("n").cast("string"), F.lit(" voltage levels, at most "), F.when(trafo, "2").otherwise("1")))
    return k.select("version", F.col("id").alias("object_id"), F.lit("voltage-level").alias("rule"), message.alias("message"))


def rules(container: DataFrame, equipment: DataFrame, node: DataFrame, edge: DataFrame, nsc: bool = False) -> DataFrame:
    up = container.select(F.col("id").alias("parent_id"), F.col("type").alias("parent_type"))
    c = container.join(up, "parent_id", "left")
    topless = F.col("parent_id").isNull() | (F.col("parent_id") == "")
    path = (
        F.when(F.col("type").isin("substation", "acline", "distribution-box") & ~topless, "must be top level")
        .when(F.col("type").isin("bay", "busbar") & topless, "has no parent")
        .when(F.col("type").isin("bay", "busbar") & F.col("parent_type").isNull(), "parent unknown")
        .when(F.col("type").isin("bay", "busbar") & ~F.col("parent_type").isin("substation", "distribution-box"), "parent must be a station")
    )
    found = c.select(F.col("id").alias("object_id"), F.lit("container-path").alias("rule"), path.alias("message")).filter("message IS NOT NULL")

    of = edge.join(equipment.select(F.col("id").alias("equipment_id"), "container_id"), "equipment_id", "left")
    kind = container.select(F.col("id").alias("container_id"), "type", "parent_id")
    boxed = of.join(kind, "container_id", "left")
    station = F.when(F.col("type") == "bay", F.col("parent_id")).otherwise(F.col("container_id"))
    trafo = boxed.filter(F.col("class") == top.TRANSFORMER).select(station.alias("id"))
    box = container.filter("type = 'distribution-box'").select("id").join(trafo, "id", "left_semi")
    found = found.union(box.select("id", F.lit("kvs-no-transformer"), F.lit("distribution box holds a transformer")))

    cables = boxed.filter(F.col("type") == "acline").select(F.explode(F.array("t1", "t2")).alias("node"), F.col("container_id").alias("cable")).filter(F.col("node") != top.GROUND).distinct()
    bays = boxed.filter(F.col("type") == "bay").select(F.explode(F.array("t1", "t2")).alias("node"), F.col("container_id").alias("bay")).filter(F.col("node") != top.GROUND).distinct()
    many = bays.join(cables, "node").groupBy("bay").agg(F.countDistinct("cable").alias("n")).filter("n > 1")
    if not nsc:
        found = found.union(many.select("bay", F.lit("bay-cable-count"), F.concat(F.col("n").cast("string"), F.lit(" cables at one bay"))))

    used = top.endpoints(edge).select(F.col("node").alias("id")).distinct()
    found = found.union(node.filter("kind = 'real'").join(used, "id", "left_anti").select("id", F.lit("unreferenced-node"), F.lit("no terminal uses it")))
    homeless = of.filter(F.col("container_id").isNull() | (F.col("container_id") == ""))
    found = found.union(homeless.select("equipment_id", F.lit("equipment-without-container"), F.lit("installed but in no container")))
    owners = boxed.filter(station.isNotNull()).select("equipment_id", station.alias("owner_id"))
    return found.union(top.islands(edge, owners).select("owner_id", F.lit("station-connectivity"), F.concat(F.lit("separate part at "), "component", F.lit(" with "), F.col("n_nodes").cast("string"), F.lit(" nodes"))))
