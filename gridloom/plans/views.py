"""The relational projection on a fixture model. The fixture is SQL that Spark and the oracle both run as it stands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import chains
from gridloom.operators import projection as pj
from gridloom.operators import topology as top
from gridloom.session import table

#: name -> SQL over the star schema; later ones may use earlier ones.
FIXTURE = {
    "m_edge": """
SELECT CONCAT('E-', l_orderkey, '-', l_partkey) AS equipment_id, CONCAT('P-', l_partkey) AS t1,
  CASE WHEN max(l_tax) >= 0.08 THEN 'GND' ELSE CONCAT('O-', l_orderkey) END AS t2,
  CASE min(l_returnflag) WHEN 'A' THEN 'ACLineSegment' WHEN 'N' THEN CASE WHEN l_partkey % 3 = 0 THEN 'Fuse' ELSE 'Switch' END
    ELSE CASE WHEN l_partkey % 7 = 0 THEN 'Meter' WHEN l_partkey % 7 < 3 THEN 'PowerElectronicsConnection' ELSE 'PowerTransformer' END END AS class,
  CASE WHEN min(l_returnflag) = 'N' THEN min(l_linestatus) = 'O' END AS is_open, l_partkey AS part, l_orderkey AS ord
FROM lineitem WHERE l_quantity >= 49 GROUP BY l_orderkey, l_partkey""",
    "m_container": """
SELECT CONCAT('R-', r_regionkey) AS id, CASE WHEN r_regionkey % 2 = 0 THEN 'substation' ELSE 'distribution-box' END AS type, CAST(NULL AS VARCHAR(99)) AS parent_id, r_name AS name FROM region
UNION ALL SELECT CONCAT('N-', n_nationkey), 'bay', CONCAT('R-', n_regionkey), n_name FROM nation
UNION ALL SELECT CONCAT('S-', s_suppkey), 'busbar', CONCAT('R-', n_regionkey), s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT CONCAT('C-', c_custkey), 'house', CONCAT('N-', c_nationkey), CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END FROM customer""",
    "m_part": """
SELECT equipment_id AS id, CASE WHEN class IN ('Meter', 'PowerElectronicsConnection') OR part % 2 = 0 THEN CONCAT('C-', o_custkey) ELSE CONCAT('N-', c_nationkey) END AS container_id,
  class, part, ord FROM m_edge JOIN orders ON o_orderkey = ord JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT CONCAT('BS-', s_suppkey), CONCAT('S-', s_suppkey), 'BusbarSection', s_suppkey, 0 FROM supplier
UNION ALL SELECT CONCAT('BS-', s_suppkey, '#2'), CONCAT('S-', s_suppkey), 'BusbarSection', s_suppkey + 1, 0 FROM supplier WHERE s_suppkey % 5 = 0""",
    "m_geometry": """
SELECT CONCAT('C-', c_custkey) AS owner_id, 'container' AS owner_kind, CAST(47 + c_custkey % 800 AS DOUBLE) AS lat, CAST(6 + c_custkey % 9 AS DOUBLE) AS lon FROM customer WHERE c_custkey % 3 > 0
UNION ALL SELECT id, 'equipment', CAST(part % 90 AS DOUBLE), CAST(part % 45 AS DOUBLE) FROM m_part WHERE part % 4 = 1""",
    "m_attribute": """
SELECT id AS owner_id, 'cim_class' AS key, 0 AS seq, CONCAT('"', class, '"') AS value FROM m_part
UNION ALL SELECT id, 'IdentifiedObject.name', 0, CONCAT('"', name, '"') FROM m_container WHERE name IS NOT NULL
UNION ALL SELECT id, 'IdentifiedObject.name', 0, CONCAT('"', class, ' ', part, '"') FROM m_part WHERE part % 5 > 0
UNION ALL SELECT id, 'name', 0, CONCAT('"own ', part, '"') FROM m_part WHERE part % 11 = 0
UNION ALL SELECT id, 'busbar_node_id', 0, CONCAT('"P-', part, '"') FROM m_part WHERE class = 'BusbarSection'
UNION ALL SELECT id, 'Fuse.nominalCurrent', 0, CONCAT('"', part % 400, '"') FROM m_part WHERE class = 'Fuse' AND part % 2 = 0
UNION ALL SELECT id, 'Conductor.length', 0, CONCAT('"', part % 1000, '.5"') FROM m_part WHERE class = 'ACLineSegment'
UNION ALL SELECT id, 'ACLineSegment.r', 0, CONCAT('"0.', 1 + part % 9, '"') FROM m_part WHERE class = 'ACLineSegment' AND part % 3 = 0
UNION ALL SELECT 'N-0', 'IdentifiedObject.networkGroup', 0, '"north"'""",
    "m_satellite": """
SELECT id AS owner_id, 0 AS seq, 'PowerTransformerEnd' AS class, 'PowerTransformerEnd.ratedS' AS k, CONCAT('', part % 630) AS v FROM m_part WHERE class = 'PowerTransformer'
UNION ALL SELECT id, 1, 'PowerTransformerEnd', 'PowerTransformerEnd.ratedS', CONCAT('', part % 400) FROM m_part WHERE class = 'PowerTransformer' AND part % 2 = 1
UNION ALL SELECT id, 0, 'UsagePoint', 'UsagePoint.ratedPower', CONCAT('', part % 30) FROM m_part WHERE class = 'Meter'
UNION ALL SELECT id, 1, 'UsagePoint', 'UsagePoint.marketParticipantLocationIdentifier', CONCAT('DE', part) FROM m_part WHERE class = 'Meter' AND part % 2 = 0
UNION ALL SELECT id, 2, 'UsagePointLocation', 'Location.mainAddress', CONCAT('Street ', ord % 100) FROM m_part WHERE class = 'Meter' AND part % 3 = 0
UNION ALL SELECT id, 0, CASE part % 4 WHEN 0 THEN 'PhotoVoltaicUnit' WHEN 1 THEN 'BatteryUnit' WHEN 2 THEN 'Heatpump' ELSE 'Wallbox' END, 'PowerElectronicsUnit.maxP', CONCAT('', part % 20) FROM m_part WHERE class = 'PowerElectronicsConnection'
UNION ALL SELECT id, 1, 'RegulatingControl', 'RegulatingControl.discrete', CASE WHEN part % 2 = 0 THEN 'true' ELSE 'false' END FROM m_part WHERE class = 'PowerElectronicsConnection' AND part % 5 > 1
UNION ALL SELECT id, 2, 'DiscreteControlLimit', 'DiscreteControlLimit.value', CONCAT('', part % 7) FROM m_part WHERE class = 'PowerElectronicsConnection' AND part % 5 > 2
UNION ALL SELECT id, 0, 'PositionPoint', 'PositionPoint.sequenceNumber', '1' FROM m_part WHERE class = 'ACLineSegment' AND part % 2 = 0""",
    "m_position": """
SELECT id AS owner_id, 1 + (part + s) % 3 AS n, CAST(part % 90 AS DOUBLE) AS x, CAST(s + 40 AS DOUBLE) AS y, 1 + s AS seq
FROM m_part JOIN (SELECT 0 AS s UNION ALL SELECT 1 UNION ALL SELECT 2) p ON class = 'ACLineSegment' AND part % 2 = 1""",
}


def model(spark: SparkSession, d: str) -> pj.Model:
    for t in ("region", "nation", "supplier", "customer", "orders", "lineitem"):
        table(spark, d, t).createOrReplaceTempView(t)
    for name, sql in FIXTURE.items():
        spark.sql(sql.replace("VARCHAR(99)", "STRING")).createOrReplaceTempView(name)
    sat = spark.table("m_satellite").select("owner_id", F.lit("satellite").alias("key"), "seq", F.format_string('{"class": "%s", "attributes": {"%s": "%s"}}', "class", "k", "v").alias("value"))
    at = spark.table("m_position").select(
        "owner_id", F.lit("satellite").alias("key"), "seq",
        F.format_string('{"class": "PositionPoint", "attributes": {"PositionPoint.sequenceNumber": "%s", "PositionPoint.xPosition": "%s", "PositionPoint.yPosition": "%s"}}', F.col("n").cast("string"), F.col("x").cast("string"), F.col("y").cast("string")).alias("value"),
    )
    return pj.Model(
        spark.table("m_container").select("id", "type", "parent_id"), spark.table("m_part").select("id", "container_id"), spark.table("m_edge").select("equipment_id", "t1", "t2"),
        spark.table("m_geometry"), spark.table("m_attribute").unionByName(sat).unionByName(at),
    )


def _simple(f):
    return lambda spark, d: f(model(spark, d))


def _circuits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    m = model(spark, d)
    return pj.circuit_rows(top.circuits(spark.table("m_edge").select("equipment_id", "t1", "t2", "class", "is_open")), m)


def proj_circuit(spark: SparkSession, d: str) -> DataFrame:
    return _circuits(spark, d)[0].select(pj.ext_id(F.col("external_id")).alias("id"), "external_id", "name")


def proj_circuit_device_map(spark: SparkSession, d: str) -> DataFrame:
    return pj.circuit_network_device_map(*_circuits(spark, d))


def proj_network_device_circuit(spark: SparkSession, d: str) -> DataFrame:
    group = pj.network_group(model(spark, d)).first()  # one row at most
    return pj.network_device(model(spark, d), proj_circuit_device_map(spark, d), group.id if group else None)


def _collapsed(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        m = model(spark, d)
        return pj.collapsed_views(m, chains.collapse(*pj.collapse_inputs(m)))[name]

    query.__doc__ = f"The view {name} over collapsed connections."
    return query


QUERIES = {
    "proj_container": _simple(pj.container), "proj_transformer": _simple(pj.transformer), "proj_busbar": _simple(pj.busbar), "proj_feeder_area": _simple(pj.feeder_area), "proj_house": _simple(pj.house_connection),
    "proj_network_device": _simple(pj.network_device), "proj_terminal": _simple(pj.terminal), "proj_connection": _simple(pj.connection), "proj_connection_map": _simple(pj.connection_terminal_map),
    "proj_line_segment": _simple(lambda m: pj.line_segment(m).drop("path_positions")), "line_path": _simple(lambda m: pj.line_path(m).select("owner_id", F.get_json_object("path_positions", "$[0].sequenceNumber").alias("first"), F.get_json_object("path_positions", "$[0].y").try_cast("double").alias("y"))),
    "proj_control_unit": _simple(pj.control_unit), "proj_control_step": _simple(pj.control_step), "proj_measuring_device": _simple(pj.measuring_device), "proj_feeder_extension": _simple(pj.terminal_feeder_end_extension),
    "proj_network_group": _simple(pj.network_group), "proj_circuit": proj_circuit, "proj_circuit_device_map": proj_circuit_device_map, "proj_network_device_circuit": proj_network_device_circuit,
    "proj_threshold": lambda spark, d: pj.threshold(spark), "proj_threshold_history": lambda spark, d: pj.threshold(spark),
    **{f"proj_collapsed_{n}": _collapsed(n) for n in ("terminal", "connection", "connection_terminal_map", "line_segment")},
    **{f"proj_{n}": (lambda n: lambda spark, d: pj.empty_view(spark, n))(n) for n in pj.EMPTY_VIEWS},
    "ext_ids": lambda spark, d: table(spark, d, "customer").select("c_custkey", pj.ext_id(F.col("c_name")).alias("ext_id")),
}

_M = ",\n".join(f"{n} AS ({s})" for n, s in FIXTURE.items())


def _id(x: str) -> str:
    """MD5's first 16 hex digits as a signed 64-bit number."""
    h = f"CAST(CONCAT('0x', substr(md5({x}), 1, 16)) AS UBIGINT)"
    return f"CAST(CASE WHEN {h} >= 9223372036854775808 THEN CAST({h} AS HUGEINT) - 18446744073709551616 ELSE {h} END AS BIGINT)"


_V = f"""WITH RECURSIVE {_M},
n AS (SELECT owner_id, coalesce(max(CASE WHEN key = 'name' THEN value END), max(CASE WHEN key = 'IdentifiedObject.name' THEN value END)) AS q FROM m_attribute WHERE key LIKE '%name' GROUP BY 1),
nm AS (SELECT owner_id, trim(q, '"') AS name FROM n),
num AS (SELECT owner_id, key, trim(value, '"') AS v FROM m_attribute),
tx AS (
  SELECT CONCAT(e.equipment_id, '#T', s) AS k, e.equipment_id AS eq, s AS no, CASE s WHEN 1 THEN t1 ELSE t2 END AS node, p.container_id AS box, p.class AS cls
  FROM m_edge e JOIN m_part p ON p.id = e.equipment_id CROSS JOIN (SELECT 1 AS s UNION ALL SELECT 2)
  UNION ALL SELECT CONCAT(id, '#T1'), id, 1, CONCAT('P-', part), container_id, class FROM m_part WHERE class = 'BusbarSection' AND id NOT LIKE '%#%'),
mem AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY k) AS pos, count(*) OVER (PARTITION BY node) AS deg FROM tx WHERE node <> 'GND'),
dev AS (SELECT tx.*, m.type, CASE WHEN cls = 'PowerTransformer' THEN 'TRANSFORMER' WHEN cls = 'BusbarSection' THEN 'BUSBAR' WHEN m.type = 'house' THEN 'HOUSE_CONNECTION' END AS kind FROM tx LEFT JOIN m_container m ON m.id = tx.box),
term AS (SELECT {_id('k')} AS id, k AS external_id, nm.name, CASE WHEN cls = 'PowerTransformer' THEN {_id('eq')} WHEN cls = 'BusbarSection' OR type = 'house' THEN {_id('box')} END AS network_device_id,
  CASE WHEN cls <> 'PowerTransformer' AND type = 'bay' THEN {_id('box')} END AS feeder_area_id, CASE WHEN cls IN ('Fuse', 'Switch') THEN upper(cls) ELSE 'NOT_SWITCHABLE' END AS type, true AS default_switching_state,
  CAST(f.v AS INT) AS fuse_value, CAST(f.v AS INT) AS fuse_nominal_current, g.lat AS latitude, g.lon AS longitude
  FROM dev LEFT JOIN nm ON nm.owner_id = eq LEFT JOIN num f ON f.owner_id = eq AND f.key = 'Fuse.nominalCurrent' LEFT JOIN m_geometry g ON g.owner_id = eq AND g.owner_kind = 'equipment'),
trafo AS (SELECT {_id('p.id')} AS id, {_id('p.container_id')} AS container_id, 1 AS strip_number, max(CAST(s.v AS DOUBLE)) AS nominal_apparent_power, CAST(NULL AS INT) AS max_apparent_power, CAST(NULL AS DOUBLE) AS max_apparent_power_factor
  FROM m_part p LEFT JOIN m_satellite s ON s.owner_id = p.id AND s.class = 'PowerTransformerEnd' WHERE p.class = 'PowerTransformer' GROUP BY p.id, p.container_id),
house AS (SELECT c.id AS hid, coalesce(max(CASE WHEN k = 'Location.mainAddress' THEN v END), max(c.name), c.id) AS address, max(g.lat) AS latitude, max(g.lon) AS longitude,
  coalesce(max(CASE WHEN k = 'UsagePoint.ratedPower' THEN CAST(v AS DOUBLE) END), 0) AS rated_power, coalesce(max(CASE WHEN k LIKE '%LocationIdentifier' THEN v END), c.id) AS malo
  FROM m_container c LEFT JOIN m_part p ON p.container_id = c.id LEFT JOIN m_satellite s ON s.owner_id = p.id LEFT JOIN m_geometry g ON g.owner_id = c.id AND g.owner_kind = 'container' WHERE c.type = 'house' GROUP BY c.id),
links AS (SELECT t1 AS a, t2 AS b FROM m_edge WHERE class <> 'PowerTransformer' AND NOT coalesce(is_open, false) AND t2 <> 'GND' UNION SELECT t2, t1 FROM m_edge WHERE class <> 'PowerTransformer' AND NOT coalesce(is_open, false) AND t2 <> 'GND'
  UNION SELECT t1, t1 FROM m_edge UNION SELECT t2, t2 FROM m_edge),
label_reach(n, r) AS (SELECT DISTINCT a, a FROM links UNION SELECT l.b, x.r FROM label_reach x JOIN links l ON l.a = x.n WHERE x.r < l.b),
circ AS (SELECT n AS node, min(r) AS cid FROM label_reach WHERE n <> 'GND' GROUP BY n),
touch AS (SELECT d.*, cid FROM dev d JOIN circ ON circ.node = d.node),
memb AS (
  SELECT eq AS dv, min(cid) AS cid, 1 AS kd FROM touch WHERE cls = 'PowerTransformer' GROUP BY eq
  UNION ALL SELECT DISTINCT box, cid, 2 FROM touch WHERE cls = 'BusbarSection'
  UNION ALL SELECT box, min(cid), 3 FROM touch WHERE type = 'house' AND cls <> 'PowerTransformer' GROUP BY box),
cname AS (SELECT *, CONCAT(plain, '-Island') AS nm FROM (SELECT cid, CASE WHEN min(kd) = 1 THEN min(CASE WHEN kd = 1 THEN dv END) WHEN min(kd) = 2 THEN min(CASE WHEN kd = 2 THEN dv END) ELSE min(dv) END AS plain FROM memb GROUP BY cid)),
cmap AS (SELECT DISTINCT {_id("CONCAT(nm, '~', dv)")} AS id, {_id('nm')} AS circuit_id, {_id('dv')} AS network_device_id FROM memb JOIN cname USING (cid)),
devices AS (SELECT id FROM trafo UNION ALL SELECT {_id('id')} FROM m_container WHERE type = 'busbar' UNION ALL SELECT {_id('hid')} FROM house)
"""

_DUCK = {"string": "VARCHAR", "long": "BIGINT", "timestamp": "TIMESTAMPTZ"}
ORACLES = {
    "proj_container": f"{_V} SELECT {_id('c.id')} AS id, c.id AS external_id, name, CASE type WHEN 'substation' THEN 'SUBSTATION' ELSE 'DISTRIBUTION_BOX' END AS container_type, CAST(NULL AS VARCHAR) AS address, lat AS latitude, lon AS longitude FROM m_container c LEFT JOIN m_geometry g ON g.owner_id = c.id WHERE type IN ('substation', 'distribution-box')",
    "proj_transformer": f"{_V} SELECT * FROM trafo",
    "proj_busbar": f"{_V} SELECT {_id('id')} AS id, {_id('parent_id')} AS container_id FROM m_container WHERE type = 'busbar'",
    "proj_feeder_area": f"{_V} SELECT {_id('id')} AS id, id AS external_id, name, CAST(NULL AS BIGINT) AS net_island, CAST(NULL AS BIGINT) AS network_group_id FROM m_container WHERE type = 'bay'",
    "proj_house": f"{_V} SELECT {_id('hid')} AS id, address, latitude, longitude, rated_power, malo, hid AS network_area_id FROM house",
    "proj_network_device": f"{_V} SELECT id, CAST(NULL AS VARCHAR) AS external_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS BIGINT) AS net_island, CAST(NULL AS BIGINT) AS network_group_id FROM devices",
    "proj_terminal": f"{_V} SELECT * FROM term",
    "proj_connection": f"{_V} SELECT {_id('a.node')} AS id, a.node AS external_id, {_id('a.k')} AS source_id, x.kind AS source_device_type, {_id('b.k')} AS target_id, y.kind AS target_device_type, true AS is_active FROM mem a JOIN mem b ON a.node = b.node AND a.pos = 1 AND b.pos = 2 JOIN dev x ON x.k = a.k JOIN dev y ON y.k = b.k",
    "proj_connection_map": f"""{_V} SELECT {_id("CONCAT(node, '~', k)")} AS id, {_id('node')} AS connection_id, {_id('k')} AS terminal_id, CAST(pos AS INT) AS sequence_number FROM mem WHERE deg >= 2""",
    "proj_line_segment": f"""{_V} SELECT {_id("CONCAT(s.node, '~seg~', eq)")} AS id, {_id('s.node')} AS connection_id, eq AS external_id, 1 AS sequence_number, CAST(l.v AS DOUBLE) AS length, CAST(r.v AS DOUBLE) AS r, CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS bch, CAST(NULL AS DOUBLE) AS total_resistance
FROM (SELECT eq, min(node) AS node FROM mem WHERE deg >= 2 AND cls = 'ACLineSegment' GROUP BY eq) s LEFT JOIN num l ON l.owner_id = eq AND l.key = 'Conductor.length' LEFT JOIN num r ON r.owner_id = eq AND r.key = 'ACLineSegment.r'""",
    "line_path": f"{_V} SELECT owner_id, CAST(min(n) AS VARCHAR) AS first, arg_min(y, n) AS y FROM (SELECT owner_id, n, y FROM m_position UNION ALL SELECT owner_id, 1, NULL FROM m_satellite WHERE class = 'PositionPoint') GROUP BY owner_id",
    "proj_control_unit": f"""{_V} SELECT {_id('p.id')} AS id, p.id AS external_id, name, CAST(NULL AS BIGINT) AS net_island, CAST(NULL AS BIGINT) AS network_group_id, {_id('p.container_id')} AS house_connection_id,
  CASE u.class WHEN 'BatteryUnit' THEN 'STORAGE' WHEN 'Heatpump' THEN 'HEATPUMP' END AS steua_type, CASE u.class WHEN 'PhotoVoltaicUnit' THEN 'PRODUCER' ELSE 'CONSUMER' END AS steua_role, CAST(u.v AS DOUBLE) AS max_power, CAST(NULL AS INT) AS total_controllable_load,
  CASE WHEN rc.v = 'true' THEN 'STEPPED' ELSE 'STEPLESS' END AS steua_control_type, CAST(NULL AS DOUBLE) AS stepless_min, CAST(NULL AS DOUBLE) AS stepless_max
FROM m_part p JOIN m_satellite u ON u.owner_id = p.id AND u.class IN ('PhotoVoltaicUnit', 'BatteryUnit', 'Heatpump') LEFT JOIN nm ON nm.owner_id = p.id LEFT JOIN m_satellite rc ON rc.owner_id = p.id AND rc.class = 'RegulatingControl' WHERE p.class = 'PowerElectronicsConnection'""",
    "proj_control_step": f"""{_V} SELECT {_id("CONCAT(owner_id, '~step~', seq)")} AS id, {_id('owner_id')} AS steua_id, CAST(v AS DOUBLE) AS step_value FROM m_satellite WHERE class = 'DiscreteControlLimit'""",
    "proj_measuring_device": f"""{_V} SELECT {_id('p.id')} AS id, p.id AS external_id, name, {_id("CONCAT(p.id, '#T1')")} AS terminal_id, CAST(NULL AS BIGINT) AS measuring_interval, CAST(NULL AS BIGINT) AS transmission_interval,
  CAST(NULL AS VARCHAR) AS melo, CAST(NULL AS VARCHAR) AS sign_convention FROM m_part p LEFT JOIN nm ON nm.owner_id = p.id WHERE p.class = 'Meter'""",
    "proj_feeder_extension": f"{_V} SELECT id, CAST(NULL AS BIGINT) AS sequence_number, CAST(NULL AS VARCHAR) AS first_segment_cable_type FROM term WHERE feeder_area_id IS NOT NULL",
    "proj_network_group": f"""{_V} SELECT {_id("'north'")} AS id, 'north' AS external_id, 'north' AS name""",
    "proj_circuit": f"{_V} SELECT {_id('nm')} AS id, nm AS external_id, plain AS name FROM cname",
    "proj_circuit_device_map": f"{_V} SELECT * FROM cmap",
    "proj_network_device_circuit": f"""{_V} SELECT d.id, CAST(NULL AS VARCHAR) AS external_id, CAST(NULL AS VARCHAR) AS name, circuit_id AS net_island, {_id("'north'")} AS network_group_id FROM devices d LEFT JOIN cmap ON network_device_id = d.id""",
    "proj_threshold": """SELECT CAST(i AS BIGINT) AS id, CAST(NULL AS BIGINT) AS terminal_id, TIMESTAMPTZ '2020-01-01 00:00:00+00' AS modified_date, 'SYSTEM' AS modified_by, true AS is_default, t AS threshold_type, CAST(w AS DOUBLE) AS warning_fraction, CAST(NULL AS DOUBLE) AS warning_value,
  CAST(c AS DOUBLE) AS critical_fraction, CAST(NULL AS DOUBLE) AS critical_value, CAST(l AS DOUBLE) AS load_limitation_target_fraction, CAST(NULL AS DOUBLE) AS load_limitation_target_value
FROM (VALUES (1, 'OVERLOAD', 0.8, 0.9, 0.85), (2, 'OVERVOLTAGE', 1.05, 1.08, 1.065), (3, 'UNDERVOLTAGE', 0.95, 0.92, 0.935)) v(i, t, w, c, l)""",
    "ext_ids": f"SELECT c_custkey, {_id('c_name')} AS ext_id FROM customer",
}
ORACLES["proj_threshold_history"] = ORACLES["proj_threshold"]
ORACLES |= {f"proj_{n}": "SELECT " + ", ".join(f"CAST(NULL AS {_DUCK.get(c.split()[1], c.split()[1].upper())}) AS {c.split()[0]}" for c in cols.split(", ")) + " WHERE false" for n, cols in pj.EMPTY_VIEWS.items()}
