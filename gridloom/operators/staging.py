"""Facts (version, id, profile, class, attribute, value, is_reference, seq): look-ups, references and records.

Every function takes a facts frame; repeated facts are removed by distinct_facts first. Objects are (version, id); a
reference points to an object of the same version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.skew import salted_join
from gridloom.operators.widen import DOUBLE

OBJECT = ["version", "id"]
FACT = ["version", "id", "profile", "class", "attribute", "value", "is_reference", "seq"]
#: Relations that describe the grid's wiring and containment, not an object's properties.
TOPOLOGY_ATTRIBUTES = ("Terminal.ConductingEquipment", "Terminal.ConnectivityNode", "ConnectivityNode.ConnectivityNodeContainer", "Equipment.EquipmentContainer", "Bay.VoltageLevel")
#: Classes that many objects share or that describe the grid's structure; and classes of drawings. No walk visits them.
STRUCTURAL_CLASSES = (
    "Terminal", "ConnectivityNode", "Substation", "VoltageLevel", "Bay", "Feeder", "Building", "Line", "ControlArea", "BaseVoltage", "InstanceSet", "CoordinateSystem", "PerLengthSequenceImpedance", "PSRType", "GeographicalRegion",
    "SubGeographicalRegion", "NameType", "NameTypeAuthority", "OperationalLimitType", "EnergySchedulingType", "RatioTapChangerTable", "RatioTapChangerTablePoint", "PhaseTapChangerTable", "PhaseTapChangerTablePoint", "TopologicalIsland",
    "LoadArea", "SubLoadArea", "BasePower", "LoadResponseCharacteristic", "DiagramObjectStyle", "CommunicationLink", "RemoteUnit", "RemoteSource",
)
DRAWING_CLASSES = ("Diagram", "DiagramObject", "DiagramObjectPoint")
#: The reference of a power-electronics unit (PV unit, battery, wallbox) to the connection that it belongs to.
UNIT_OF = "PowerElectronicsUnit.PowerElectronicsConnection"


def distinct_facts(facts: DataFrame) -> DataFrame:
    """Each fact once, in the columns of a fact; further columns are dropped."""
    return facts.select(*FACT).distinct()


def of_ids(facts: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """All facts of the given ids (column id); unknown ids are silently absent."""
    return facts.join(ids.select(F.col("id").alias(column)).distinct(), column, "left_semi")


def reverse_references(facts: DataFrame, targets: DataFrame) -> DataFrame:
    """Reference facts that point to the given ids."""
    return salted_join(facts.filter("is_reference"), targets.select(F.col("id").alias("value")).distinct(), ["value"], "left_semi")


def class_page(facts: DataFrame, class_: str, after: str, size: int) -> DataFrame:
    """All facts of the next `size` ids of a class after an id, in id order."""
    page = facts.filter((F.col("class") == class_) & (F.col("id") > after)).select("id").distinct().orderBy("id").limit(size)
    return facts.join(F.broadcast(page) if size <= 100_000 else page, "id", "left_semi")


def fact_groups(facts: DataFrame, partitions: int | None = None) -> DataFrame:
    """The facts object by object: all of an object next to each other in one partition, in order of profile, attribute, seq and value.

    Objects are not collected into lists, so that one with very many facts needs no memory; mapInArrow sees them in turn.
    """
    by = facts.repartition(partitions, *OBJECT) if partitions else facts.repartition(*OBJECT)
    return by.sortWithinPartitions(*OBJECT, "profile", "attribute", "seq", "value")


def object_marks(facts: DataFrame) -> DataFrame:
    """(version, id, class, is_unit, has_container): whether an object is a power-electronics unit, and whether it has a container reference."""
    has = lambda a: F.coalesce(F.bool_or(F.col("attribute") == a), F.lit(False))
    return facts.groupBy(*OBJECT).agg(object_class().alias("class"), has(UNIT_OF).alias("is_unit"), has("Equipment.EquipmentContainer").alias("has_container"))


def first_value(attribute: str, reference: bool | None = None) -> Column:
    """Aggregate: the attribute's value of the least (seq, value), of references or literals only if asked."""
    mine = (F.col("attribute") == attribute) & F.col("value").isNotNull()
    if reference is not None:
        mine = mine & (F.col("is_reference") == F.lit(reference))
    return F.min(F.when(mine, F.struct("seq", "value")))["value"]


def object_class() -> Column:
    """Aggregate: the class of an object; `Equipment` only if nothing more exact is said."""
    return F.coalesce(F.min(F.when(F.col("class") != "Equipment", F.col("class"))), F.min("class"))


def records(facts: DataFrame, literals: Sequence[str] = (), references: Sequence[str] = ()) -> DataFrame:
    """One row per object: class, name, and the first literal / reference of each attribute, named by the part after its dot."""
    short = lambda a: a.rsplit(".", 1)[-1]
    name = F.coalesce(first_value("IdentifiedObject.name", False), F.lit("(unnamed)")).alias("display_name")
    cols = [first_value(a, False).alias(short(a)) for a in literals] + [first_value(a, True).alias(short(a)) for a in references]
    return facts.groupBy(*OBJECT).agg(object_class().alias("class"), name, *cols)


def switch_states(facts: DataFrame) -> DataFrame:
    """(version, id, is_open) of every object with a switch attribute; `Switch.open` beats `Switch.normalOpen`, open is `true`."""
    state = F.coalesce(first_value("Switch.open", False), first_value("Switch.normalOpen", False))
    there = facts.filter(F.col("attribute").isin("Switch.open", "Switch.normalOpen"))
    return there.groupBy(*OBJECT).agg((F.coalesce(F.lower(state), F.lit("false")) == "true").alias("is_open"))


def attribute_walk(facts: DataFrame, owners: DataFrame, skipped_classes: Sequence[str] = STRUCTURAL_CLASSES + DRAWING_CLASSES, skipped_attributes: Sequence[str] = TOPOLOGY_ATTRIBUTES) -> DataFrame:
    """(version, owner_id, id): the objects that an owner's references lead to, in both directions, for satellites.

    A walk from each owner (version, id) over references other than the skipped attributes; objects of a skipped class or
    with a container of their own (other equipment) are neither visited nor passed, but for power-electronics units, which
    have a container and still belong to their connection. They are removed before the join, so that a hub that thousands
    of objects refer to is never expanded. Ends when no owner sees anything new.
    """
    from gridloom.session import cut, drop

    refs = facts.filter(F.col("is_reference") & F.col("value").isNotNull() & ~F.col("attribute").isin(*skipped_attributes)).select("version", F.col("id").alias("a"), F.col("value").alias("b")).distinct()
    has = lambda a, n: F.coalesce(F.max((F.col("attribute") == a).cast("int")), F.lit(0)).alias(n)
    known = facts.groupBy(*OBJECT).agg(object_class().alias("class"), has("Equipment.EquipmentContainer", "contained"), has(UNIT_OF, "unit"))
    allowed = known.filter(~F.col("class").isin(*skipped_classes) & ((F.col("contained") == 0) | (F.col("unit") == 1))).select("version", F.col("id").alias("to"))
    links = refs.select("version", F.col("a").alias("at"), F.col("b").alias("to")).union(refs.select("version", F.col("b").alias("at"), F.col("a").alias("to"))).distinct()
    links = cut(links.join(allowed, ["version", "to"], "left_semi"))
    seen = cut(owners.select("version", F.col("id").alias("owner_id"), F.col("id").alias("at")).distinct())
    frontier = seen
    while True:
        step = salted_join(frontier, links, ["version", "at"]).select("version", "owner_id", F.col("to").alias("at")).distinct()
        fresh = cut(step.join(seen, ["version", "owner_id", "at"], "left_anti"))
        if fresh.isEmpty():
            break
        grown = cut(seen.union(fresh))
        drop(seen)
        drop(frontier)
        seen, frontier = grown, fresh
    drop(links)
    return seen.filter(F.col("at") != F.col("owner_id")).select("version", "owner_id", F.col("at").alias("id"))


def satellite_rows(facts: DataFrame, walk: DataFrame) -> DataFrame:
    """(version, owner_id, id, class, key, n_values, first): the literals of every satellite; repeated keys count their values."""
    lit = facts.filter(~F.col("is_reference") & F.col("value").isNotNull()).groupBy(*OBJECT, F.col("attribute").alias("key")).agg(F.count(F.lit(1)).alias("n_values"), F.min(F.struct("seq", "value"))["value"].alias("first"))
    cls = facts.groupBy(*OBJECT).agg(object_class().alias("class"))
    return salted_join(walk, lit.join(cls, OBJECT), OBJECT).select("version", "owner_id", "id", "class", "key", "n_values", "first")


def number_keys(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "seq") -> DataFrame:
    """Arrival index per key, from 0, in the given total order."""
    from pyspark.sql import Window

    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def first_points(facts: DataFrame) -> DataFrame:
    """(version, owner_id, lat, lon): owner -> Location -> PositionPoint of the least sequence number with both numbers."""
    loc = facts.filter((F.col("attribute") == "PowerSystemResource.Location") & F.col("is_reference")).select("version", F.col("id").alias("owner_id"), F.col("value").alias("location")).distinct()
    point = facts.filter(F.col("class") == "PositionPoint").groupBy(*OBJECT).agg(
        first_value("PositionPoint.Location").alias("location"), first_value("PositionPoint.sequenceNumber").alias("no"),
        first_value("PositionPoint.xPosition").alias("x"), first_value("PositionPoint.yPosition").alias("y"),
    )
    number = lambda c: F.when(F.trim(c).rlike(DOUBLE), F.trim(c).try_cast("double"))  # noqa: E731  (a cast alone takes `7.5d`)
    point = point.select("version", "location", F.trim("no").try_cast("bigint").alias("no"), number("y").alias("lat"), number("x").alias("lon"), "id").filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    first = point.groupBy("version", "location").agg(F.min(F.struct("no", "id", "lat", "lon")).alias("p"))
    return loc.join(first, ["version", "location"]).groupBy("version", "owner_id").agg(F.min("p").alias("p")).select("version", "owner_id", "p.lat", "p.lon")
