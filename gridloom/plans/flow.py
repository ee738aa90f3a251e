"""Power-flow queries: one ring network per region, with a chord; and network tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.operators import flow as fl
from gridloom.operators import network as nt
from gridloom.operators import staging as st
from gridloom.plans import staging as ps
from gridloom.session import table


def branches(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive nations of a region, the ring closed, a chord from the first to the third, and a spur (a bridge)."""
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    n = table(spark, d, "nation").select(
        F.col("n_regionkey").alias("network"), F.col("n_nationkey").alias("bus"), F.row_number().over(w).alias("no"), F.coalesce(F.lead("n_nationkey").over(w), F.first("n_nationkey").over(w)).alias("next"),
        F.lead("n_nationkey", 2).over(w).alias("third"),
    )
    x = lambda a, b: ((F.col(a) * 7 + F.col(b) * 3) % 10 / 20 + 0.05).alias("x")
    ring = n.select("network", F.concat(F.lit("L-"), "no").alias("branch_id"), F.col("bus").alias("from_bus"), F.col("next").alias("to_bus"), x("bus", "next"))
    chord = n.filter("no = 1").select("network", F.lit("X-1").alias("branch_id"), F.col("bus"), F.col("third"), x("bus", "third"))
    spur = n.filter("no = 1").select("network", F.lit("Z-1").alias("branch_id"), F.col("bus"), (F.col("bus") + 1000), F.lit(0.1).alias("x"))
    return ring.union(chord).union(spur)


def ptdf_top(spark: SparkSession, d: str) -> DataFrame:
    """The 20 greatest factors (the ranking is the feature here)."""
    return fl.ptdf(branches(spark, d)).orderBy(F.desc(F.abs(F.round("factor", 9))), "network", "branch_id", "bus_id").limit(20)


def lodf_bridges(spark: SparkSession, d: str) -> DataFrame:
    return fl.bridges(fl.lodf(branches(spark, d)))


def lodf_rows(spark: SparkSession, d: str) -> DataFrame:
    return fl.lodf(branches(spark, d)).withColumn("factor", F.round("factor", 9))


def ac_flow(spark: SparkSession, d: str) -> DataFrame:
    """Nations as buses, injections from the balances of their customers."""
    b = branches(spark, d)
    load = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("bus_id")).agg((-F.sum("c_acctbal") / F.count(F.lit(1)) / 200).alias("p_mw"))
    ends = b.select("network", F.col("from_bus").alias("bus_id")).union(b.select("network", "to_bus")).distinct()
    first = ends.groupBy("network").agg(F.min("bus_id").alias("slack"))
    buses = ends.join(load, "bus_id", "left").join(first, "network").select(
        "network", "bus_id", F.when(F.col("bus_id") == F.col("slack"), "slack").when(F.col("bus_id") % 4 == 1, "pv").otherwise("pq").alias("kind"),
        F.lit(1.02).alias("vm_pu"), F.coalesce("p_mw", F.lit(-5.0)).alias("p_mw"), F.lit(-2.0).alias("q_mvar"),
    )
    out = fl.ac_flow(buses, b.select("network", "from_bus", "to_bus", (F.col("x") / 4).alias("r_pu"), F.col("x").alias("x_pu"), F.lit(0.01).alias("b_pu")))
    return out.select("network", "bus_id", F.round("vm_pu", 6).alias("vm_pu"), F.round("va_degree", 4).alias("va_degree"), F.round("p_mw", 3).alias("p_mw"), "converged")


def flow_totals(spark: SparkSession, d: str) -> DataFrame:
    return ac_flow(spark, d).groupBy("network").agg(F.round(F.sum("p_mw"), 2).alias("losses_mw"), F.min("vm_pu").alias("least_vm"), F.max("vm_pu").alias("greatest_vm"))


def _buses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("bus_id"), F.when(F.col("s_suppkey") % 9 == 0, (F.col("s_suppkey") % 4 + 1) * 10.0).alias("vn_kv"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").filter("s_suppkey % 13 <> 0").select(F.col("s_suppkey").alias("from_bus"), (F.col("s_suppkey") + 1).alias("to_bus"))


def voltage_propagation(spark: SparkSession, d: str) -> DataFrame:
    return fl.spread_voltage(_buses(spark, d), _lines(spark, d))


def slack_reachability(spark: SparkSession, d: str) -> DataFrame:
    slack = _buses(spark, d).filter("bus_id IN (5, 40)").select("bus_id")
    return fl.supplied_buses(_buses(spark, d), _lines(spark, d), slack)


def line_parameters(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    f = fl.line_parameters(F.col("s_suppkey") / 10, F.col("s_suppkey") / 5, F.col("s_suppkey") * 1e-6, F.col("s_suppkey") * 1e-8, (F.col("s_suppkey") % 4).cast("double"))
    t = fl.transformer_parameters(F.col("s_suppkey") / 100, F.col("s_suppkey") / 10, F.lit(110.0), F.lit(40.0))
    cols = s.select("s_suppkey", *f, *t)
    return cols.select("s_suppkey", *(F.round(c, 6).alias(c) for c in cols.columns[1:]))


def network_lines(spark: SparkSession, d: str) -> DataFrame:
    """The cable segments of all versions as rows of the network table."""
    out = nt.lines(st.distinct_facts(table(spark, d, "staging_records")))
    return out.select(*(F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes))


def network_loads(spark: SparkSession, d: str) -> DataFrame:
    """The energy consumers of all versions as loads."""
    return nt.loads(st.distinct_facts(table(spark, d, "staging_records")), ["EnergyConsumer"])


def network_supplied(spark: SparkSession, d: str) -> DataFrame:
    """(version, n_buses, n_lines, load_mw): what is left of each version without the parts that its largest one does not supply."""
    t = nt.network_tables(st.distinct_facts(table(spark, d, "staging_records")), ["EnergyConsumer"])
    n = lambda name, as_: t[name].groupBy("version").agg(F.count(F.lit(1)).alias(as_))
    load = t["loads"].groupBy("version").agg(F.round(F.sum("p_mw"), 6).alias("load_mw"))
    return n("buses", "n_buses").join(n("lines", "n_lines"), "version", "left").join(load, "version", "left").na.fill(0, ["n_lines"])


def focus_line(spark: SparkSession, d: str) -> DataFrame:
    """For the branch of each network that carries most, the buses and outages that matter most to it (three each: the ranking is the feature)."""
    b = branches(spark, d)
    solved = ac_flow(spark, d)
    v = solved.select("network", F.col("bus_id").alias("from_bus"), F.col("va_degree").alias("a")).join(b, ["network", "from_bus"]).join(solved.select("network", F.col("bus_id").alias("to_bus"), F.col("va_degree").alias("c")), ["network", "to_bus"])
    load = v.select("network", "branch_id", F.round(F.abs(F.col("a") - F.col("c")) / F.col("x"), 4).alias("loading_percent"))
    return nt.focus(load, fl.ptdf(b), fl.lodf(b), 3).withColumn("factor", F.round("factor", 9))


QUERIES = {f.__name__: f for f in (ptdf_top, lodf_bridges, lodf_rows, ac_flow, flow_totals, voltage_propagation, slack_reachability, line_parameters, network_lines, network_loads, network_supplied, focus_line)}

_BUS = "bus AS (SELECT s_suppkey AS bus_id, CASE WHEN s_suppkey % 9 = 0 THEN (s_suppkey % 4 + 1) * 10.0::DOUBLE END AS vn FROM supplier), ends AS (SELECT s_suppkey AS a, s_suppkey + 1 AS b FROM supplier WHERE s_suppkey % 13 <> 0 UNION SELECT s_suppkey + 1, s_suppkey FROM supplier WHERE s_suppkey % 13 <> 0)"
_STEPS = "".join(f", v{i} AS (SELECT b.bus_id, coalesce(b.vn, (SELECT min(x.vn) FROM ends e JOIN {'bus' if i == 1 else f'v{i - 1}'} x ON x.bus_id = e.a WHERE e.b = b.bus_id)) AS vn FROM {'bus' if i == 1 else f'v{i - 1}'} b)" for i in range(1, 6))



def _number(value: str, default: str) -> str:
    return f"coalesce(CASE WHEN regexp_full_match(trim({value}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim({value}) AS DOUBLE) END, {default})"


_NO = ps._first_sql("ACDCTerminal.sequenceNumber")
_TABLES = f"""{ps._F},
trm AS (SELECT version, id, nullif({ps._first_sql('Terminal.ConductingEquipment')}, '') AS eq, coalesce(nullif({ps._first_sql('Terminal.TopologicalNode')}, ''), nullif({ps._first_sql('Terminal.ConnectivityNode')}, '')) AS bus,
  coalesce(CASE WHEN regexp_full_match(trim({_NO}), '[+-]?[0-9]+') THEN TRY_CAST(trim({_NO}) AS INT) END, 0) AS no FROM f WHERE class = 'Terminal' GROUP BY version, id),
two AS (SELECT version, eq, max(bus) FILTER (WHERE i = 1) AS bus1, max(bus) FILTER (WHERE i = 2) AS bus2 FROM (SELECT *, row_number() OVER (PARTITION BY version, eq ORDER BY no, id) AS i FROM trm WHERE eq IS NOT NULL) WHERE i <= 2 GROUP BY ALL),
rec AS (SELECT version, id, {ps._first_sql('IdentifiedObject.name', False)} AS name, coalesce({ps._first_sql('Equipment.inService', False)}, 'true') = 'true' AS in_service,
  {', '.join(f"{ps._first_sql(a, False)} AS {n}" for n, a in (('len', 'Conductor.length'), ('r', 'ACLineSegment.r'), ('x', 'ACLineSegment.x'), ('bch', 'ACLineSegment.bch'), ('gch', 'ACLineSegment.gch'), ('p', 'EnergyConsumer.p'), ('q', 'EnergyConsumer.q')))} FROM f GROUP BY version, id),
line AS (SELECT r.version, r.id AS line_id, r.name, t.bus1 AS from_bus, t.bus2 AS to_bus, coalesce(nullif({_number('r.len', '1.0')}, 0), 1.0) AS km, {_number('r.r', '0.0')} AS r, {_number('r.x', '0.0')} AS x, {_number('r.bch', '0.0')} AS b, {_number('r.gch', '0.0')} AS g, in_service
  FROM rec r JOIN two t ON t.version = r.version AND t.eq = r.id WHERE (r.version, r.id) IN (SELECT (version, id) FROM f WHERE class = 'ACLineSegment') AND bus1 IS NOT NULL AND bus2 IS NOT NULL),
load AS (SELECT r.version, r.id AS load_id, r.name, t.bus1 AS bus, {_number('r.p', '0.0')} AS p_mw, {_number('r.q', '0.0')} AS q_mvar, in_service
  FROM rec r JOIN two t ON t.version = r.version AND t.eq = r.id WHERE (r.version, r.id) IN (SELECT (version, id) FROM f WHERE class = 'EnergyConsumer') AND bus1 IS NOT NULL)"""

ORACLES = {
    "lodf_bridges": "SELECT DISTINCT n_regionkey AS network, 'Z-1' AS branch_id FROM nation",
    "voltage_propagation": f"WITH {_BUS}{_STEPS} SELECT bus_id, vn AS vn_kv FROM v5",
    "slack_reachability": f"WITH RECURSIVE {_BUS}, r(n) AS (SELECT bus_id FROM bus WHERE bus_id IN (5, 40) UNION SELECT e.b FROM r JOIN ends e ON e.a = r.n) SELECT n AS bus_id FROM r",
    "line_parameters": """SELECT s_suppkey, round(s_suppkey / 10 / km, 6) AS r_ohm_per_km, round(s_suppkey / 5 / km, 6) AS x_ohm_per_km, round(s_suppkey * 1e-6 / (2 * pi() * 50) * 1e9 / km, 6) AS c_nf_per_km, round(s_suppkey * 1e-8 * 1e6 / km, 6) AS g_us_per_km,
  round(sqrt(pow(s_suppkey / 100, 2) + pow(s_suppkey / 10, 2)) / (110.0 * 110 / 40) * 100, 6) AS vk_percent, round(s_suppkey / 100 / (110.0 * 110 / 40) * 100, 6) AS vkr_percent
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN CAST(s_suppkey % 4 AS DOUBLE) ELSE 1.0::DOUBLE END AS km FROM supplier)""",
    "network_lines": f"""WITH {_TABLES} SELECT version, line_id, name, from_bus, to_bus, round(km, 6) AS length_km, round(r / km, 6) AS r_ohm_per_km, round(x / km, 6) AS x_ohm_per_km, round(b / (2 * pi() * 50) * 1e9 / km, 6) AS c_nf_per_km,
  round(g / km * 1e6, 6) AS g_us_per_km, 1.0::DOUBLE AS max_i_ka, in_service FROM line""",
    "network_loads": f"WITH {_TABLES} SELECT * FROM load",
    "network_supplied": f"""WITH RECURSIVE {_TABLES},
bus AS (SELECT DISTINCT version, bus FROM trm WHERE bus IS NOT NULL), links AS (SELECT version, from_bus AS a, to_bus AS b FROM line UNION SELECT version, to_bus, from_bus FROM line UNION SELECT version, bus, bus FROM bus),
reach(version, n, r) AS (SELECT DISTINCT version, a, a FROM links UNION SELECT l.version, l.b, x.r FROM reach x JOIN links l ON l.version = x.version AND l.a = x.n WHERE x.r < l.b), root AS (SELECT version, n, min(r) AS r FROM reach GROUP BY ALL),
best AS (SELECT version, r FROM root GROUP BY version, r QUALIFY row_number() OVER (PARTITION BY version ORDER BY count(*) DESC, r) = 1), kept AS (SELECT version, n FROM root SEMI JOIN best USING (version, r))
SELECT k.version, k.n AS n_buses, coalesce(l.n, 0) AS n_lines, round(p.p, 6) AS load_mw FROM (SELECT version, count(*) AS n FROM kept GROUP BY 1) k
LEFT JOIN (SELECT version, count(*) AS n FROM line WHERE (version, from_bus) IN (SELECT (version, n) FROM kept) GROUP BY 1) l USING (version)
LEFT JOIN (SELECT version, sum(p_mw) AS p FROM load WHERE (version, bus) IN (SELECT (version, n) FROM kept) GROUP BY 1) p USING (version)""",
}
