"""Network tables from facts, the flow problem from network tables, and its results: loadings, totals and the focus line.

Everything is scoped by version; a bus is a topological node, or a connectivity node where the facts have no topology.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.scalar import nominal_kv, number_or
from gridloom.operators import flow
from gridloom.operators.components import components
from gridloom.operators.staging import OBJECT, first_value
from gridloom.session import cut

#: Fixed values of the network tables: reactive limits of a generator without any, current limit in kA of equipment without any, voltage of a bus without any in kV.
NO_MIN_Q, NO_MAX_Q, NO_LIMIT_KA, NO_VOLTAGE_KV = -9999.0, 9999.0, 1.0, 0.4
#: Least short-circuit voltage in percent.
LEAST_VK = 0.01
BASE_MVA = 100.0


def _of_class(facts: DataFrame, classes: Sequence[str], literals: Sequence[str] = (), references: Sequence[str] = ()) -> DataFrame:
    """One row per object of the classes: its name, literals and references, named by the part after the dot; SSH facts of another class name count as well."""
    ids = facts.filter(F.col("class").isin(*classes)).select(*OBJECT).distinct()
    wanted = ["IdentifiedObject.name", "Equipment.inService", *literals, *references]
    short = lambda a: a.rsplit(".", 1)[-1]
    rows = facts.filter(F.col("attribute").isin(*wanted)).groupBy(*OBJECT).agg(
        first_value("IdentifiedObject.name", False).alias("name"), (F.coalesce(first_value("Equipment.inService", False), F.lit("true")) == "true").alias("in_service"),
        *(first_value(a, False).alias(short(a)) for a in literals), *(F.nullif(first_value(a, True), F.lit("")).alias(short(a)) for a in references),
    )
    return ids.join(rows, OBJECT, "left").withColumn("in_service", F.coalesce("in_service", F.lit(True)))


def _whole(c: Column) -> Column:
    """A whole number, 0 where it is none."""
    return F.coalesce(F.when(F.trim(c).rlike("^[+-]?[0-9]+$"), F.trim(c).try_cast("int")), F.lit(0))


def equipment_buses(facts: DataFrame) -> DataFrame:
    """(version, equipment_id, bus1, bus2, n): the buses of the first two terminals in order of sequence number and id; a bus is null where a terminal has none."""
    t = facts.filter(F.col("class") == "Terminal").groupBy(*OBJECT).agg(
        F.nullif(first_value("Terminal.ConductingEquipment"), F.lit("")).alias("equipment_id"), F.nullif(first_value("Terminal.TopologicalNode"), F.lit("")).alias("tn"), F.nullif(first_value("Terminal.ConnectivityNode"), F.lit("")).alias("cn"),
        _whole(first_value("ACDCTerminal.sequenceNumber")).alias("no"),
    )
    t = t.filter("equipment_id IS NOT NULL").select("version", "equipment_id", "no", "id", F.coalesce("tn", "cn").alias("bus"))
    # At most two rows of an equipment pass the ranking, however many terminals it has.
    two = t.withColumn("_i", F.row_number().over(Window.partitionBy("version", "equipment_id").orderBy("no", "id"))).filter("_i <= 2")
    at = lambda i: F.max(F.when(F.col("_i") == i, F.col("bus")))
    return two.groupBy("version", "equipment_id").agg(at(1).alias("bus1"), at(2).alias("bus2"), F.count(F.lit(1)).alias("n"))


def terminal_buses(facts: DataFrame) -> DataFrame:
    """(version, terminal, bus, equipment_id) of every terminal."""
    t = facts.filter(F.col("class") == "Terminal").groupBy(*OBJECT)
    filled = lambda a: F.nullif(first_value(a), F.lit(""))
    return t.agg(F.coalesce(filled("Terminal.TopologicalNode"), filled("Terminal.ConnectivityNode")).alias("bus"), filled("Terminal.ConductingEquipment").alias("equipment_id")).withColumnRenamed("id", "terminal")


def current_limits(facts: DataFrame) -> DataFrame:
    """(version, equipment_id, max_i_ka): the least permanent current limit of an equipment, over its terminals' limit sets, in kA."""
    limit = _of_class(facts, ["CurrentLimit"], ["CurrentLimit.normalValue"], ["OperationalLimit.OperationalLimitType", "OperationalLimit.OperationalLimitSet"]).select("version", "normalValue", "OperationalLimitType", "OperationalLimitSet")
    kind = _of_class(facts, ["OperationalLimitType"], (), ["OperationalLimitType.kind"]).filter(F.lower(F.substring_index("kind", ".", -1)) == "patl").select("version", F.col("id").alias("OperationalLimitType"))
    sets = _of_class(facts, ["OperationalLimitSet"], (), ["OperationalLimitSet.Terminal"]).select("version", F.col("id").alias("OperationalLimitSet"), F.col("Terminal").alias("terminal"))
    value = number_or(F.col("normalValue"), None)
    of = limit.join(kind, ["version", "OperationalLimitType"]).join(sets, ["version", "OperationalLimitSet"]).join(terminal_buses(facts), ["version", "terminal"])
    return of.filter(F.col("equipment_id").isNotNull() & (value != 0)).groupBy("version", "equipment_id").agg((F.min(value) / 1000).alias("max_i_ka"))


def lines(facts: DataFrame) -> DataFrame:
    """Cable segments with two buses; a length that is missing or 0 counts as 1 km."""
    value = lambda c: number_or(F.col(c), 0.0)
    s = _of_class(facts, ["ACLineSegment"], ["Conductor.length", "ACLineSegment.r", "ACLineSegment.x", "ACLineSegment.bch", "ACLineSegment.gch"])
    s = s.join(equipment_buses(facts).withColumnRenamed("equipment_id", "id"), OBJECT).filter("bus1 IS NOT NULL AND bus2 IS NOT NULL")
    s = s.join(current_limits(facts).withColumnRenamed("equipment_id", "id"), OBJECT, "left")
    km = F.coalesce(F.nullif(number_or(F.col("length"), 1.0), F.lit(0.0)), F.lit(1.0))
    c = value("bch") / (2 * math.pi * flow.FREQUENCY_HZ) * 1e9
    return s.select(
        "version", F.col("id").alias("line_id"), "name", F.col("bus1").alias("from_bus"), F.col("bus2").alias("to_bus"), km.alias("length_km"), (value("r") / km).alias("r_ohm_per_km"), (value("x") / km).alias("x_ohm_per_km"),
        (c / km).alias("c_nf_per_km"), (value("gch") / km * 1e6).alias("g_us_per_km"), F.coalesce("max_i_ka", F.lit(NO_LIMIT_KA)).alias("max_i_ka"), "in_service",
    )


def transformers(facts: DataFrame) -> DataFrame:
    """Transformers with exactly two ends at buses; the impedances of both ends add up on the high-voltage side, the first end by number."""
    value = lambda c: number_or(F.col(c), 0.0)
    e = _of_class(facts, ["PowerTransformerEnd"], ["TransformerEnd.endNumber", "PowerTransformerEnd.r", "PowerTransformerEnd.x", "PowerTransformerEnd.ratedS", "PowerTransformerEnd.ratedU"], ["PowerTransformerEnd.PowerTransformer", "TransformerEnd.Terminal"])
    e = e.withColumnRenamed("Terminal", "terminal").join(terminal_buses(facts).select("version", "terminal", "bus"), ["version", "terminal"], "left").filter("PowerTransformer IS NOT NULL")
    e = e.select("version", F.col("PowerTransformer").alias("trafo_id"), F.struct(_whole(F.col("endNumber")).alias("no"), "id", value("r").alias("r"), value("x").alias("x"), value("ratedS").alias("s"), value("ratedU").alias("u"), "bus").alias("e"))
    two = e.groupBy("version", "trafo_id").agg(F.count(F.lit(1)).alias("n"), F.min("e").alias("hv"), F.max("e").alias("lv")).filter("n = 2 AND hv.bus IS NOT NULL AND lv.bus IS NOT NULL")
    own = _of_class(facts, ["PowerTransformer"]).select("version", F.col("id").alias("trafo_id"), "name", "in_service")
    two = two.join(own, ["version", "trafo_id"], "left")
    filled = lambda c: F.nullif(c, F.lit(0.0))
    mva = F.coalesce(filled(F.col("hv.s")), filled(F.col("lv.s")), F.lit(1.0))
    ratio = F.coalesce(F.pow(F.try_divide("hv.u", "lv.u"), 2), F.lit(0.0))
    r, x = F.col("hv.r") + F.col("lv.r") * ratio, F.col("hv.x") + F.col("lv.x") * ratio
    base = F.col("hv.u") * F.col("hv.u") / mva
    percent = lambda z: F.round(F.coalesce(F.try_divide(z, base), F.lit(0.0)) * 100, 6)
    return two.select(
        "version", "trafo_id", "name", F.col("hv.bus").alias("hv_bus"), F.col("lv.bus").alias("lv_bus"), mva.alias("sn_mva"), F.col("hv.u").alias("vn_hv_kv"), F.col("lv.u").alias("vn_lv_kv"), percent(F.sqrt(r * r + x * x)).alias("vk_percent"),
        percent(r).alias("vkr_percent"), F.coalesce("in_service", F.lit(True)).alias("in_service"),
    )


def _at_bus(facts: DataFrame, classes: Sequence[str], id_: str, literals: Sequence[str]) -> DataFrame:
    own = _of_class(facts, classes, literals).join(equipment_buses(facts).select("version", F.col("equipment_id").alias("id"), F.col("bus1").alias("bus")), OBJECT)
    return own.filter("bus IS NOT NULL").withColumnRenamed("id", id_)


def loads(facts: DataFrame, classes: Sequence[str] = ("ConformLoad",)) -> DataFrame:
    own = _at_bus(facts, classes, "load_id", ["EnergyConsumer.p", "EnergyConsumer.q"])
    return own.select("version", "load_id", "name", "bus", number_or(F.col("p"), 0.0).alias("p_mw"), number_or(F.col("q"), 0.0).alias("q_mvar"), "in_service")


def generators(facts: DataFrame) -> DataFrame:
    """Machines as voltage-controlled generators; what the facts count as consumed is produced here."""
    own = _at_bus(facts, ["SynchronousMachine"], "gen_id", ["RotatingMachine.p", "SynchronousMachine.minQ", "SynchronousMachine.maxQ"])
    return own.select("version", "gen_id", "name", "bus", (-number_or(F.col("p"), 0.0)).alias("p_mw"), F.lit(1.0).alias("vm_pu"), number_or(F.col("minQ"), NO_MIN_Q).alias("min_q_mvar"), number_or(F.col("maxQ"), NO_MAX_Q).alias("max_q_mvar"), "in_service")


def external_grids(facts: DataFrame) -> DataFrame:
    own = _at_bus(facts, ["ExternalNetworkInjection"], "ext_grid_id", [])
    return own.select("version", "ext_grid_id", "name", "bus", F.lit(1.0).alias("vm_pu"), "in_service")


def buses(facts: DataFrame, line_table: DataFrame, rounds: int = 5) -> DataFrame:
    """(version, bus_id, name, vn_kv): every topological node, and every bus of a terminal where there is none.

    The voltage comes from the name of the node's voltage level, else from the rated voltage of a transformer end there (of
    several the end of the least id), else from a bus at the other end of a line, over at most `rounds` lines; else null.
    """
    node = _of_class(facts, ["TopologicalNode"], (), ["TopologicalNode.ConnectivityNodeContainer"]).select("version", F.col("id").alias("bus_id"), "name", F.col("ConnectivityNodeContainer").alias("holder"))
    plain = _of_class(facts, ["ConnectivityNode"], (), ["ConnectivityNode.ConnectivityNodeContainer"]).select("version", F.col("id").alias("bus_id"), "name", F.col("ConnectivityNodeContainer").alias("holder"))
    named = node.unionByName(plain.join(node.select("version").distinct(), "version", "left_anti"))
    none = F.lit(None).cast("string")
    used = terminal_buses(facts).filter("bus IS NOT NULL").select("version", F.col("bus").alias("bus_id")).distinct().join(named.select("version", "bus_id"), ["version", "bus_id"], "left_anti")
    every = named.unionByName(used.select("version", "bus_id", none.alias("name"), none.alias("holder")))
    level = _of_class(facts, ["VoltageLevel"]).select("version", F.col("id").alias("holder"), nominal_kv(F.col("name")).alias("level_kv"))
    end = _of_class(facts, ["PowerTransformerEnd"], ["PowerTransformerEnd.ratedU"], ["TransformerEnd.Terminal"]).select("version", "id", F.col("Terminal").alias("terminal"), number_or(F.col("ratedU"), None).alias("u")).filter("u <> 0")
    rated = end.join(terminal_buses(facts).select("version", "terminal", F.col("bus").alias("bus_id")), ["version", "terminal"]).groupBy("version", "bus_id").agg(F.min(F.struct("id", "u"))["u"].alias("rated_kv"))
    every = every.join(level, ["version", "holder"], "left").join(rated, ["version", "bus_id"], "left")
    now = every.select("version", "bus_id", "name", F.coalesce("level_kv", "rated_kv").alias("vn_kv"))
    ends = line_table.select("version", F.col("from_bus").alias("a"), F.col("to_bus").alias("b"))
    ends = cut(ends.union(ends.select("version", "b", "a")).distinct())
    for _ in range(rounds):
        given = ends.join(now.filter("vn_kv > 0").select("version", F.col("bus_id").alias("a"), F.col("vn_kv").alias("v")), ["version", "a"]).groupBy("version", F.col("b").alias("bus_id")).agg(F.min("v").alias("v"))
        now = now.join(given, ["version", "bus_id"], "left").select("version", "bus_id", "name", F.coalesce("vn_kv", "v").alias("vn_kv"))
    return now


def supplied(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables without what no line or transformer joins to an external grid; of a version without any, without what is off its largest component."""
    ends = tables["lines"].select("version", F.col("from_bus").alias("a"), F.col("to_bus").alias("b")).union(tables["trafos"].select("version", "hv_bus", "lv_bus")).union(tables["buses"].select("version", "bus_id", F.lit(None).cast("string")))
    of = cut(components(ends, "a", "b", ["version"]))
    fed = of.join(tables["ext_grid"].select("version", F.col("bus").alias("node")).distinct(), ["version", "node"], "left_semi").select("version", "component").distinct()
    sizes = of.groupBy("version", "component").agg(F.count(F.lit(1)).alias("n")).join(fed.select("version").distinct(), "version", "left_anti")
    largest = sizes.groupBy("version").agg(F.min(F.struct((-F.col("n")).alias("n"), "component"))["component"].alias("component"))
    kept = cut(of.join(fed.unionByName(largest), ["version", "component"], "left_semi").select("version", "node"))
    on = lambda df, c: df.join(kept.withColumnRenamed("node", c), ["version", c], "left_semi").select(df.columns)
    return {
        "buses": on(tables["buses"], "bus_id"), "lines": on(on(tables["lines"], "from_bus"), "to_bus"), "trafos": on(on(tables["trafos"], "hv_bus"), "lv_bus"), "loads": on(tables["loads"], "bus"), "gens": on(tables["gens"], "bus"),
        "ext_grid": on(tables["ext_grid"], "bus"),
    }


def network_tables(facts: DataFrame, load_classes: Sequence[str] = ("ConformLoad",), only_supplied: bool = True) -> dict[str, DataFrame]:
    """buses, lines, trafos, loads, gens and ext_grid of facts, in the columns of sources.catalog.TABLES and version."""
    line_table = cut(lines(facts))
    made = {"buses": buses(facts, line_table), "lines": line_table, "trafos": transformers(facts), "loads": loads(facts, load_classes), "gens": generators(facts), "ext_grid": external_grids(facts)}
    made = {k: cut(v) if k != "lines" else v for k, v in made.items()}
    return supplied(made) if only_supplied else made


def flow_problem(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Buses and branches per unit, as flow.ac_flow takes them; a network is a version.

    Rows at unknown buses and rows out of service are left out; a bus without voltage has 0.4 kV, a short-circuit voltage is
    at least 0.01 %, capacitance and conductance at least 0. A version without external grid gets one at the bus of the
    highest voltage, of several the least id. Branches carry their id, kind and current limit.
    """
    bus = tables["buses"].groupBy("version", "bus_id").agg(F.coalesce(F.max("vn_kv"), F.lit(0.0)).alias("kv"))
    bus = cut(bus.withColumn("kv", F.when(F.col("kv") == 0, NO_VOLTAGE_KV).otherwise(F.col("kv"))))
    known = lambda df, c: df.filter("in_service").join(bus.select("version", F.col("bus_id").alias(c)), ["version", c], "left_semi")
    kv = lambda c, n: bus.select("version", F.col("bus_id").alias(c), F.col("kv").alias(n))
    ln = known(known(tables["lines"], "from_bus"), "to_bus").join(kv("from_bus", "kv"), ["version", "from_bus"])
    z, km = F.col("kv") * F.col("kv") / BASE_MVA, F.col("length_km")
    least = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0))
    ln = ln.select(
        "version", F.col("line_id").alias("branch_id"), F.lit("line").alias("kind"), "from_bus", "to_bus", (F.col("r_ohm_per_km") * km / z).alias("r_pu"), (F.col("x_ohm_per_km") * km / z).alias("x_pu"),
        (2 * math.pi * flow.FREQUENCY_HZ * least("c_nf_per_km") * 1e-9 * km * z).alias("b_pu"), (least("g_us_per_km") * 1e-6 * km * z).alias("g_pu"), F.lit(1.0).alias("ratio"), "max_i_ka",
        F.col("kv").alias("kv"),
    )
    tr = known(known(tables["trafos"], "hv_bus"), "lv_bus").join(kv("hv_bus", "hv"), ["version", "hv_bus"]).join(kv("lv_bus", "lv"), ["version", "lv_bus"])
    vk, vkr = F.greatest(F.col("vk_percent"), F.lit(LEAST_VK)) / 100, F.col("vkr_percent") / 100
    # Impedance on the low-voltage side's base, the off-nominal ratio on the high-voltage side.
    scale = F.pow(F.coalesce(F.try_divide("vn_lv_kv", "lv"), F.lit(1.0)), 2) * BASE_MVA / F.col("sn_mva")
    ratio = F.coalesce(F.try_divide(F.col("vn_hv_kv") * F.col("lv"), F.col("vn_lv_kv") * F.col("hv")), F.lit(1.0))
    tr = tr.select(
        "version", F.col("trafo_id").alias("branch_id"), F.lit("trafo").alias("kind"), F.col("hv_bus").alias("from_bus"), F.col("lv_bus").alias("to_bus"), (vkr * scale).alias("r_pu"), (F.sqrt(F.greatest(vk * vk - vkr * vkr, F.lit(0.0))) * scale).alias("x_pu"),
        F.lit(0.0).alias("b_pu"), F.lit(0.0).alias("g_pu"), F.when(ratio > 0, ratio).otherwise(1.0).alias("ratio"), F.lit(None).cast("double").alias("max_i_ka"), F.col("hv").alias("kv"),
    )
    branches = ln.unionByName(tr).withColumnRenamed("version", "network")

    slack = known(tables["ext_grid"], "bus").groupBy("version", F.col("bus").alias("bus_id")).agg(F.first("vm_pu").alias("slack_vm"))
    top = bus.join(slack.select("version").distinct(), "version", "left_anti").groupBy("version").agg(F.min(F.struct((-F.col("kv")).alias("v"), "bus_id"))["bus_id"].alias("bus_id")).withColumn("slack_vm", F.lit(1.0))
    load = known(tables["loads"], "bus").groupBy("version", F.col("bus").alias("bus_id")).agg(F.sum("p_mw").alias("lp"), F.sum("q_mvar").alias("lq"))
    gen = known(tables["gens"], "bus").groupBy("version", F.col("bus").alias("bus_id")).agg(F.sum("p_mw").alias("gp"), F.max("vm_pu").alias("gv"))
    b = bus.join(slack.unionByName(top), ["version", "bus_id"], "left").join(load, ["version", "bus_id"], "left").join(gen, ["version", "bus_id"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    kind = F.when(F.col("slack_vm").isNotNull(), "slack").when(F.col("gv").isNotNull(), "pv").otherwise("pq")
    return b.select(F.col("version").alias("network"), "bus_id", kind.alias("kind"), F.coalesce("slack_vm", "gv", F.lit(1.0)).alias("vm_pu"), (zero("gp") - zero("lp")).alias("p_mw"), (-zero("lq")).alias("q_mvar"), "kv"), branches


def branch_results(solved: DataFrame, branches: DataFrame) -> DataFrame:
    """(network, branch_id, kind, p_from_mw, q_from_mvar, i_ka, loading_percent): what flows into a branch at its first bus, and the greater current of both ends.

    solved: flow.ac_flow; the loading is null for branches without current limit.
    """
    v = solved.filter("converged").select("network", "bus_id", "vm_pu", F.radians("va_degree").alias("a"))
    at = lambda c, i: v.select("network", F.col("bus_id").alias(c), F.col("vm_pu").alias(f"v{i}"), F.col("a").alias(f"a{i}"))
    d = branches.join(at("from_bus", 1), ["network", "from_bus"]).join(at("to_bus", 2), ["network", "to_bus"]).withColumn("kv", F.col("kv"))
    z2 = F.col("r_pu") * F.col("r_pu") + F.col("x_pu") * F.col("x_pu")
    g, b = F.col("r_pu") / z2, -F.col("x_pu") / z2
    half_b, half_g = F.col("b_pu") / 2, F.col("g_pu") / 2
    u1 = F.col("v1") / F.col("ratio")
    angle = F.col("a1") - F.col("a2")

    def power(u: Column, w: Column, th: Column) -> tuple[Column, Column]:
        p = u * u * (g + half_g) - u * w * (g * F.cos(th) + b * F.sin(th))
        q = -u * u * (b + half_b) - u * w * (g * F.sin(th) - b * F.cos(th))
        return p * BASE_MVA, q * BASE_MVA

    p1, q1 = power(u1, F.col("v2"), angle)
    p2, q2 = power(F.col("v2"), u1, -angle)
    amps = lambda p, q, v: F.sqrt(p * p + q * q) / (math.sqrt(3) * F.col(v) * F.col("kv"))
    i = F.greatest(amps(p1, q1, "v1"), amps(p2, q2, "v2"))
    return d.select("network", "branch_id", "kind", p1.alias("p_from_mw"), q1.alias("q_from_mvar"), i.alias("i_ka"), (F.try_divide(i, F.col("max_i_ka")) * 100).alias("loading_percent"))


def totals(buses_: DataFrame, solved: DataFrame, results: DataFrame, loads_: DataFrame, gens_: DataFrame) -> DataFrame:
    """(network, load_mw, load_mvar, gen_mw, slack_mw, least_vm, greatest_vm, greatest_loading) of every network.

    slack_mw: what the slack buses take in beyond the given injections.
    """
    ld = loads_.filter("in_service").groupBy(F.col("version").alias("network")).agg(F.sum("p_mw").alias("load_mw"), F.sum("q_mvar").alias("load_mvar"))
    gn = gens_.filter("in_service").groupBy(F.col("version").alias("network")).agg(F.sum("p_mw").alias("gen_mw"))
    given = buses_.filter("kind = 'slack'").select("network", "bus_id", F.col("p_mw").alias("given"))
    sl = solved.join(given, ["network", "bus_id"]).groupBy("network").agg(F.sum(F.col("p_mw") - F.col("given")).alias("slack_mw"))
    v = solved.groupBy("network").agg(F.min("vm_pu").alias("least_vm"), F.max("vm_pu").alias("greatest_vm"))
    m = results.groupBy("network").agg(F.max("loading_percent").alias("greatest_loading"))
    return v.join(ld, "network", "left").join(gn, "network", "left").join(sl, "network", "left").join(m, "network", "left").na.fill(0.0, ["load_mw", "load_mvar", "gen_mw"]).select("network", "load_mw", "load_mvar", "gen_mw", "slack_mw", "least_vm", "greatest_vm", "greatest_loading")


def focus(results: DataFrame, ptdf: DataFrame, lodf: DataFrame, most: int = 10) -> DataFrame:
    """(network, line, what, rank, other, factor): for the most loaded line of each network the buses and outages that matter most.

    what: `bus` (whose injection moves the line's flow most), `takes` (branches that take its flow if it trips), `gives`
    (outages that put most flow on it); ranked by size, equals by name. Infinite and own factors are left out.
    """
    line = results.filter("loading_percent IS NOT NULL").groupBy("network").agg(F.min(F.struct((-F.col("loading_percent")).alias("l"), "branch_id"))["branch_id"].alias("line"))
    bus = ptdf.join(line, (ptdf["network"] == line["network"]) & (ptdf["branch_id"] == F.col("line"))).select(ptdf["network"], "line", F.lit("bus").alias("what"), F.col("bus_id").cast("string").alias("other"), "factor")
    finite = lodf.filter("factor IS NOT NULL AND branch_id <> outage_id")
    takes = finite.join(line, (finite["network"] == line["network"]) & (finite["outage_id"] == F.col("line"))).select(finite["network"], "line", F.lit("takes").alias("what"), F.col("branch_id").alias("other"), "factor")
    gives = finite.join(line, (finite["network"] == line["network"]) & (finite["branch_id"] == F.col("line"))).select(finite["network"], "line", F.lit("gives").alias("what"), F.col("outage_id").alias("other"), "factor")
    every = bus.unionByName(takes).unionByName(gives)
    rank = F.row_number().over(Window.partitionBy("network", "what").orderBy(F.desc(F.abs(F.round("factor", 9))), "other"))
    return every.withColumn("rank", rank).filter(F.col("rank") <= most).select("network", "line", "what", "rank", "other", "factor")
