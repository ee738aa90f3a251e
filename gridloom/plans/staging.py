"""Queries on the facts: look-ups, records, terminals, wiring, rules, satellites and first points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import staging as st
from gridloom.operators import terminals as tm
from gridloom.operators import topology as top
from gridloom.session import table


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return st.distinct_facts(table(spark, d, "staging_records"))


def fact_classes(spark: SparkSession, d: str) -> DataFrame:
    return _facts(spark, d).groupBy("class").agg(F.count(F.lit(1)).alias("n_facts"), F.countDistinct("version", "id").alias("n_objects"))


def version_counts(spark: SparkSession, d: str) -> DataFrame:
    return _facts(spark, d).groupBy("version").agg(F.count(F.lit(1)).alias("n_facts"))


def ids_in_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Objects that several profiles describe."""
    return _facts(spark, d).groupBy("version", "id").agg(F.countDistinct("profile").alias("n_profiles")).filter("n_profiles > 1")


def forward_refs(spark: SparkSession, d: str) -> DataFrame:
    """The reference facts of all busbar sections."""
    f = _facts(spark, d)
    ids = f.filter("class = 'BusbarSection'").select("id")
    return st.of_ids(f.filter("is_reference"), ids).select("version", "id", "attribute", "value", "seq")


def reverse_refs(spark: SparkSession, d: str) -> DataFrame:
    """The references that point to busbar sections."""
    f = _facts(spark, d)
    return st.reverse_references(f, f.filter("class = 'BusbarSection'").select("id")).select("version", "id", "attribute", "value", "seq")


def class_page(spark: SparkSession, d: str) -> DataFrame:
    """The facts of the first 100 fuses after ST-0000050 (a page is the feature here)."""
    return st.class_page(_facts(spark, d), "Fuse", "ST-0000050", 100).select("version", "id", "attribute", "value", "seq")


def eav_pivot(spark: SparkSession, d: str) -> DataFrame:
    return st.records(_facts(spark, d), ["Switch.normalOpen", "Switch.ratedCurrent", "Conductor.length"], ["Equipment.EquipmentContainer", "PowerSystemResource.Location"])


def switch_states(spark: SparkSession, d: str) -> DataFrame:
    return st.switch_states(_facts(spark, d))


def resolved_terminals(spark: SparkSession, d: str) -> DataFrame:
    f = _facts(spark, d)
    return tm.classify(tm.terminal_table(f), tm.class_of(f))


def terminal_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return resolved_terminals(spark, d).filter(F.col("anomaly").isNotNull()).groupBy("class", "anomaly").agg(F.count(F.lit(1)).alias("n"))


def zero_based_terminals(spark: SparkSession, d: str) -> DataFrame:
    return tm.zero_based(tm.terminal_table(_facts(spark, d)))


def split_busbars(spark: SparkSession, d: str) -> DataFrame:
    f = _facts(spark, d)
    return tm.split_busbars(tm.terminal_table(f), tm.class_of(f).filter("class = 'BusbarSection'"))


def built_edges(spark: SparkSession, d: str) -> DataFrame:
    return tm.model_edges(resolved_terminals(spark, d))


def built_nodes(spark: SparkSession, d: str) -> DataFrame:
    f = _facts(spark, d)
    t = tm.terminal_table(f)
    return tm.model_nodes(t, tm.classify(t, tm.class_of(f)))


def built_circuits(spark: SparkSession, d: str) -> DataFrame:
    """(version, circuit_id, n_nodes) of the grid built from the facts, every version a grid of its own."""
    f = _facts(spark, d)
    e = tm.model_edges(tm.classify(tm.terminal_table(f), tm.class_of(f))).join(st.switch_states(f).withColumnRenamed("id", "equipment_id"), ["version", "equipment_id"], "left")
    return top.circuits(e, ["version"]).groupBy("version", "circuit_id").agg(F.count(F.lit(1)).alias("n_nodes"))


def junction_merge(spark: SparkSession, d: str) -> DataFrame:
    """Busbar sections taken as junctions: their nodes become one."""
    f = _facts(spark, d)
    return tm.junction_merge(tm.terminal_table(f), tm.class_of(f), "BusbarSection")


def equipment_without_container(spark: SparkSession, d: str) -> DataFrame:
    f = _facts(spark, d)
    r = st.records(f, references=["Equipment.EquipmentContainer"])
    wired = tm.terminal_table(f).select("version", F.col("equipment_id").alias("id")).distinct()
    return r.filter(F.col("EquipmentContainer").isNull()).join(wired, ["version", "id"], "left_semi").select("version", "id", "class")


def equipment_without_terminals(spark: SparkSession, d: str) -> DataFrame:
    f = _facts(spark, d)
    contained = f.filter("attribute = 'Equipment.EquipmentContainer'").select("version", "id").distinct()
    return tm.without_terminals(tm.terminal_table(f), contained)


def unreferenced_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Model nodes that no raw terminal names."""
    used = table(spark, d, "jag2nsc_raw_terminal").select(F.col("node_id").alias("id")).dropna().distinct()
    return table(spark, d, "model_node").filter("kind = 'real'").select("id").distinct().join(used, "id", "left_anti")


#: ModelingAuthority and equipment without container are hubs of the test table.
SKIPPED = (*st.STRUCTURAL_CLASSES, *st.DRAWING_CLASSES, "ModelingAuthority", "Breaker", "Fuse", "ACLineSegment", "Disconnector")


def satellite_objects(spark: SparkSession, d: str) -> DataFrame:
    """What the transformers' references lead to."""
    f = _facts(spark, d)
    owners = f.filter("class = 'PowerTransformer'").select("version", "id").distinct()
    return st.attribute_walk(f, owners, SKIPPED)


def satellite_values(spark: SparkSession, d: str) -> DataFrame:
    return st.satellite_rows(_facts(spark, d), satellite_objects(spark, d))


def first_position_point(spark: SparkSession, d: str) -> DataFrame:
    return st.first_points(_facts(spark, d))


def attribute_index(spark: SparkSession, d: str) -> DataFrame:
    """Arrival index of the permanent current limits of an object."""
    f = _facts(spark, d).filter("attribute = 'OperationalLimit.permanentCurrent'").select("version", "id", "value").distinct()
    return st.number_keys(f, ["version", "id"], ["value"])


def current_limit_min(spark: SparkSession, d: str) -> DataFrame:
    """(version, id, max_i_ka): the least permanent current limit in kA, 1.0 where none is a number."""
    f = _facts(spark, d).filter("attribute = 'OperationalLimit.permanentCurrent'")
    return f.groupBy("version", "id").agg(F.coalesce(F.round(F.min(F.when(F.trim("value").rlike(r"^[0-9]+(\.[0-9]+)?$"), F.trim("value").try_cast("double"))) / 1000, 6), F.lit(1.0)).alias("max_i_ka"))


def voltage_rule(spark: SparkSession, d: str) -> DataFrame:
    """Equipment with terminals that has not exactly one base voltage (transformers one or two)."""
    from gridloom.usecases import voltage_levels

    f = _facts(spark, d)
    wired = tm.terminal_table(f).filter("equipment_id IS NOT NULL").select("version", F.col("equipment_id").alias("id")).distinct()
    return voltage_levels(f, wired)


def unit_marks(spark: SparkSession, d: str) -> DataFrame:
    """(class, is_unit, has_container, n): how many objects are power-electronics units, and how many name a container."""
    return st.object_marks(_facts(spark, d)).groupBy("class", "is_unit", "has_container").agg(F.count(F.lit(1)).alias("n"))


def nsc_terminals(spark: SparkSession, d: str) -> DataFrame:
    """The wiring of the facts read as those of the second dialect."""
    f = tm.nsc_facts(table(spark, d, "staging_records"))
    return tm.terminal_table(f).select("version", "terminal_id", "equipment_id", "node", "seq")


def resolved_fuses(spark: SparkSession, d: str) -> DataFrame:
    """The wiring of all fuses, asked for by id."""
    f = _facts(spark, d)
    ids = tm.class_of(f).filter("class = 'Fuse'").select("version", "id")
    return tm.resolve_for(f, ids).select("version", "equipment_id", "node1", "node2", "anomaly")


QUERIES = {f.__name__: f for f in (
    fact_classes, version_counts, ids_in_profiles, forward_refs, reverse_refs, class_page, eav_pivot, switch_states, resolved_terminals, terminal_anomalies, zero_based_terminals, split_busbars,
    built_edges, built_nodes, built_circuits, junction_merge, equipment_without_container, equipment_without_terminals, unreferenced_nodes, satellite_objects, satellite_values, first_position_point, attribute_index,
    current_limit_min, voltage_rule, unit_marks, nsc_terminals, resolved_fuses,
)}

_F = "f AS (SELECT DISTINCT * FROM staging_records)"


def _first(attribute: str, reference: bool | None = None) -> str:
    kind = "" if reference is None else " AND is_reference" if reference else " AND NOT is_reference"
    return f"min({{'s': seq, 'v': value}}) FILTER (WHERE attribute = '{attribute}' AND value IS NOT NULL{kind}).v"


def _first_sql(attribute: str, reference: bool | None = None) -> str:
    return f"struct_extract({_first(attribute, reference)[:-2]}, 'v')"


_CLASS = "coalesce(min(class) FILTER (WHERE class <> 'Equipment'), min(class))"
_CLASSES = f"cls AS (SELECT version, id, {_CLASS} AS class FROM f GROUP BY version, id)"
_TERMINALS = f"""term AS (
  SELECT version, id AS terminal_id, nullif({_first_sql('Terminal.ConductingEquipment')}, '') AS equipment_id,
    coalesce(nullif({_first_sql('Terminal.ConnectivityNode')}, ''), nullif({_first_sql('Terminal.TopologicalNode')}, '')) AS node,
    trim({_first_sql('ACDCTerminal.sequenceNumber')}) AS seq
  FROM f WHERE class = 'Terminal' GROUP BY version, id)"""
_WIRING = f"""g AS (
  SELECT t.version, t.equipment_id, c.class, count(*) AS n, count(node) AS wn, min(seq) AS lo, max(seq) AS hi, count(seq) AS ws, min(node) AS least, count(DISTINCT node) AS n_nodes,
    min(node) FILTER (WHERE seq = '1') AS at1, min(node) FILTER (WHERE seq = '2') AS at2, coalesce(c.class IN ('Junction', 'BusbarSection'), false) AS nr
  FROM term t LEFT JOIN cls c ON c.version = t.version AND c.id = t.equipment_id WHERE t.equipment_id IS NOT NULL GROUP BY ALL),
a AS (SELECT *, CASE
    WHEN nr AND wn < n THEN 'terminal without node' WHEN nr THEN NULL WHEN n > 2 THEN 'more than two terminals' WHEN wn < n THEN 'terminal without node'
    WHEN n = 2 AND ws = 2 AND lo = hi THEN 'sequence given twice' WHEN n = 1 AND NOT coalesce(lo = '1', false) THEN 'single terminal not numbered 1'
    WHEN n = 2 AND NOT coalesce(lo = '1' AND hi = '2', false) THEN 'terminals not numbered 1 and 2' END AS anomaly FROM g),
wiring AS (SELECT version, equipment_id, class, CASE WHEN nr THEN 'node' ELSE 'edge' END AS role,
    CASE WHEN anomaly IS NULL THEN CASE WHEN nr THEN least ELSE at1 END END AS node1, CASE WHEN anomaly IS NULL AND NOT nr AND n = 2 THEN at2 END AS node2, n_nodes, anomaly FROM a),
edge AS (SELECT version, equipment_id, node1 AS t1, coalesce(node2, 'GND') AS t2, class FROM wiring WHERE role = 'edge' AND anomaly IS NULL AND node1 IS NOT NULL)"""
_ALL = f"{_F}, {_CLASSES}, {_TERMINALS}, {_WIRING}"
_STATE = f"state AS (SELECT version, id, coalesce(lower(coalesce({_first_sql('Switch.open', False)}, {_first_sql('Switch.normalOpen', False)})), 'false') = 'true' AS is_open FROM f WHERE attribute IN ('Switch.open', 'Switch.normalOpen') GROUP BY version, id)"
_TOPOLOGY = ", ".join(f"'{a}'" for a in st.TOPOLOGY_ATTRIBUTES)
_WALKED = f"""{_F}, {_CLASSES},
ref AS (SELECT DISTINCT version, id AS a, value AS b FROM f WHERE is_reference AND value IS NOT NULL AND attribute NOT IN ({_TOPOLOGY})),
allowed AS (SELECT version, id FROM cls WHERE class NOT IN ({', '.join(f"'{c}'" for c in SKIPPED)})
  AND (version, id) NOT IN (SELECT (version, id) FROM f WHERE attribute = 'Equipment.EquipmentContainer')),
link AS (SELECT version, a, b FROM ref UNION SELECT version, b, a FROM ref),
ok AS (SELECT l.* FROM link l JOIN allowed w ON w.version = l.version AND w.id = l.b),
walk(version, owner_id, id) AS (SELECT DISTINCT version, id, id FROM f WHERE class = 'PowerTransformer'
  UNION SELECT w.version, w.owner_id, o.b FROM walk w JOIN ok o ON o.version = w.version AND o.a = w.id),
sat AS (SELECT * FROM walk WHERE id <> owner_id)"""

ORACLES = {
    "fact_classes": f"WITH {_F} SELECT class, count(*) AS n_facts, count(DISTINCT (version, id)) AS n_objects FROM f GROUP BY class",
    "version_counts": f"WITH {_F} SELECT version, count(*) AS n_facts FROM f GROUP BY version",
    "ids_in_profiles": f"WITH {_F} SELECT version, id, count(DISTINCT profile) AS n_profiles FROM f GROUP BY ALL HAVING count(DISTINCT profile) > 1",
    "forward_refs": f"WITH {_F} SELECT version, id, attribute, value, seq FROM f WHERE is_reference AND id IN (SELECT id FROM f WHERE class = 'BusbarSection')",
    "reverse_refs": f"WITH {_F} SELECT version, id, attribute, value, seq FROM f WHERE is_reference AND value IN (SELECT id FROM f WHERE class = 'BusbarSection')",
    "class_page": f"WITH {_F} SELECT version, id, attribute, value, seq FROM f WHERE id IN (SELECT DISTINCT id FROM f WHERE class = 'Fuse' AND id > 'ST-0000050' ORDER BY id LIMIT 100)",
    "eav_pivot": f"""WITH {_F} SELECT version, id, {_CLASS} AS class, coalesce({_first_sql('IdentifiedObject.name', False)}, '(unnamed)') AS display_name,
  {_first_sql('Switch.normalOpen', False)} AS "normalOpen", {_first_sql('Switch.ratedCurrent', False)} AS "ratedCurrent", {_first_sql('Conductor.length', False)} AS length,
  {_first_sql('Equipment.EquipmentContainer', True)} AS "EquipmentContainer", {_first_sql('PowerSystemResource.Location', True)} AS "Location" FROM f GROUP BY version, id""",
    "switch_states": f"WITH {_F}, {_STATE} SELECT * FROM state",
    "resolved_terminals": f"WITH {_ALL} SELECT * FROM wiring",
    "terminal_anomalies": f"WITH {_ALL} SELECT class, anomaly, count(*) AS n FROM wiring WHERE anomaly IS NOT NULL GROUP BY ALL",
    "zero_based_terminals": f"""WITH {_F}, {_TERMINALS}, k AS (SELECT version, equipment_id FROM term WHERE equipment_id IS NOT NULL GROUP BY ALL HAVING min(seq) = '0' AND (max(seq) = '0' OR (max(seq) = '1' AND count(DISTINCT seq) = 2)))
SELECT t.version, t.terminal_id, t.equipment_id, t.node, CASE WHEN k.version IS NULL THEN seq ELSE CAST(CAST(seq AS INT) + 1 AS VARCHAR) END AS seq FROM term t LEFT JOIN k ON k.version = t.version AND k.equipment_id = t.equipment_id""",
    "split_busbars": f"""WITH {_F}, {_CLASSES}, {_TERMINALS}, b AS (SELECT version, id FROM cls WHERE class = 'BusbarSection'), n AS (SELECT t.*, b.id AS b, row_number() OVER (PARTITION BY t.version, t.equipment_id ORDER BY terminal_id) AS no FROM term t LEFT JOIN b ON b.version = t.version AND b.id = t.equipment_id)
SELECT version, terminal_id, CASE WHEN b IS NOT NULL AND no > 1 THEN equipment_id || '#' || no ELSE equipment_id END AS equipment_id, node, CASE WHEN b IS NULL THEN seq ELSE '1' END AS seq FROM n""",
    "built_edges": f"WITH {_ALL} SELECT * FROM edge",
    "built_nodes": f"""WITH {_ALL} SELECT DISTINCT t.version, t.node AS id, 'real' AS kind FROM term t JOIN wiring w ON w.version = t.version AND w.equipment_id = t.equipment_id WHERE w.anomaly IS NULL AND t.node IS NOT NULL AND t.node <> 'GND'
UNION ALL SELECT DISTINCT version, 'GND', 'virtual' FROM edge WHERE t2 = 'GND'""",
    "built_circuits": f"""WITH RECURSIVE {_ALL}, {_STATE},
e AS (SELECT printf('%09d', x.version) || '/' || t1 AS t1, printf('%09d', x.version) || '/' || t2 AS t2, class <> 'PowerTransformer' AND NOT coalesce(is_open, false) AND t1 <> 'GND' AND t2 <> 'GND' AS c FROM edge x LEFT JOIN state s ON s.version = x.version AND s.id = x.equipment_id),
links AS (SELECT t1 AS a, t2 AS b FROM e WHERE c UNION SELECT t2, t1 FROM e WHERE c UNION SELECT t1, t1 FROM e UNION SELECT t2, t2 FROM e),
label_reach(n, r) AS (SELECT DISTINCT a, a FROM links UNION SELECT l.b, x.r FROM label_reach x JOIN links l ON l.a = x.n WHERE x.r < l.b),
label AS (SELECT n AS node, min(r) AS root FROM label_reach GROUP BY n)
SELECT CAST(left(root, 9) AS BIGINT) AS version, substr(root, 11) AS circuit_id, count(*) AS n_nodes FROM label WHERE node NOT LIKE '%/GND' GROUP BY root""",
    "junction_merge": f"""WITH RECURSIVE {_F}, {_CLASSES}, {_TERMINALS}, own AS (SELECT t.version, t.equipment_id, printf('%09d', t.version) || '/' || t.node AS node FROM term t JOIN cls c ON c.version = t.version AND c.id = t.equipment_id WHERE c.class = 'BusbarSection' AND t.node IS NOT NULL),
links AS (SELECT DISTINCT x.node AS a, y.node AS b FROM own x JOIN own y ON x.version = y.version AND x.equipment_id = y.equipment_id),
label_reach(n, r) AS (SELECT DISTINCT a, a FROM links UNION SELECT l.b, x.r FROM label_reach x JOIN links l ON l.a = x.n WHERE x.r < l.b)
SELECT CAST(left(n, 9) AS BIGINT) AS version, substr(n, 11) AS node, substr(min(r), 11) AS merged FROM label_reach GROUP BY n HAVING min(r) <> n""",
    "equipment_without_container": f"""WITH {_F}, {_TERMINALS} SELECT version, id, {_CLASS} AS class FROM f WHERE (version, id) IN (SELECT (version, equipment_id) FROM term WHERE equipment_id IS NOT NULL) GROUP BY version, id
HAVING {_first_sql('Equipment.EquipmentContainer', True)} IS NULL""",
    "equipment_without_terminals": f"WITH {_F}, {_TERMINALS} SELECT DISTINCT version, id AS equipment_id FROM f WHERE attribute = 'Equipment.EquipmentContainer' AND NOT EXISTS (SELECT 1 FROM term t WHERE t.version = f.version AND t.equipment_id = f.id)",
    "unreferenced_nodes": "SELECT DISTINCT id FROM model_node WHERE kind = 'real' AND NOT EXISTS (SELECT 1 FROM jag2nsc_raw_terminal WHERE node_id = id)",
    "satellite_objects": f"WITH RECURSIVE {_WALKED} SELECT * FROM sat",
    "satellite_values": f"""WITH RECURSIVE {_WALKED}, lit AS (SELECT version, id, attribute AS key, count(*) AS n_values, struct_extract(min({{'s': seq, 'v': value}}), 'v') AS first FROM f WHERE NOT is_reference AND value IS NOT NULL GROUP BY ALL)
SELECT s.version, s.owner_id, s.id, c.class, l.key, l.n_values, l.first FROM sat s JOIN lit l ON l.version = s.version AND l.id = s.id JOIN cls c ON c.version = s.version AND c.id = s.id""",
    "first_position_point": f"""WITH {_F}, loc AS (SELECT DISTINCT version, id AS owner_id, value AS location FROM f WHERE attribute = 'PowerSystemResource.Location' AND is_reference),
p AS (SELECT version, id, {_first_sql('PositionPoint.Location')} AS location, TRY_CAST(trim({_first_sql('PositionPoint.sequenceNumber')}) AS BIGINT) AS no, trim({_first_sql('PositionPoint.xPosition')}) AS x, trim({_first_sql('PositionPoint.yPosition')}) AS y FROM f WHERE class = 'PositionPoint' GROUP BY version, id),
q AS (SELECT l.version, owner_id, CASE WHEN regexp_full_match(y, '-?[0-9]+(\\.[0-9]+)?([eE][+-]?[0-9]+)?') THEN TRY_CAST(y AS DOUBLE) END AS lat, CASE WHEN regexp_full_match(x, '-?[0-9]+(\\.[0-9]+)?([eE][+-]?[0-9]+)?') THEN TRY_CAST(x AS DOUBLE) END AS lon, no, id FROM loc l JOIN p ON p.version = l.version AND p.location = l.location)
SELECT version, owner_id, lat, lon FROM q WHERE lat IS NOT NULL AND lon IS NOT NULL QUALIFY row_number() OVER (PARTITION BY version, owner_id ORDER BY no NULLS FIRST, id) = 1""",
    "attribute_index": f"WITH {_F} SELECT version, id, value, CAST(row_number() OVER (PARTITION BY version, id ORDER BY value NULLS FIRST) - 1 AS INT) AS seq FROM (SELECT DISTINCT version, id, value FROM f WHERE attribute = 'OperationalLimit.permanentCurrent')",
    "current_limit_min": f"WITH {_F} SELECT version, id, coalesce(round(min(CASE WHEN regexp_full_match(trim(value), '[0-9]+(\\.[0-9]+)?') THEN TRY_CAST(trim(value) AS DOUBLE) END) / 1000, 6), 1.0) AS max_i_ka FROM f WHERE attribute = 'OperationalLimit.permanentCurrent' GROUP BY ALL",
    "voltage_rule": f"""WITH {_F}, {_CLASSES}, {_TERMINALS}, wired AS (SELECT DISTINCT version, equipment_id AS id FROM term WHERE equipment_id IS NOT NULL),
r AS (SELECT version, id, attribute, value FROM f WHERE is_reference AND value <> ''), own AS (SELECT version, id, value AS v FROM r WHERE attribute = 'ConductingEquipment.BaseVoltage'),
k AS (SELECT c.version, c.id, c.class, count(DISTINCT o.v) AS n FROM cls c JOIN wired w ON w.version = c.version AND w.id = c.id LEFT JOIN own o ON o.version = c.version AND o.id = c.id GROUP BY ALL)
SELECT version, id AS object_id, 'voltage-level' AS rule, CASE WHEN n = 0 THEN 'no voltage level' ELSE n || ' voltage levels, at most ' || CASE WHEN class = 'PowerTransformer' THEN '2' ELSE '1' END END AS message
FROM k WHERE n = 0 OR n > CASE WHEN class = 'PowerTransformer' THEN 2 ELSE 1 END""",
    "unit_marks": f"""WITH {_F} SELECT class, is_unit, has_container, count(*) AS n FROM (SELECT version, id, {_CLASS} AS class, count(*) FILTER (WHERE attribute = '{st.UNIT_OF}') > 0 AS is_unit, count(*) FILTER (WHERE attribute = 'Equipment.EquipmentContainer') > 0 AS has_container FROM f GROUP BY version, id) GROUP BY ALL""",
    "nsc_terminals": f"""WITH {_F}, {_TERMINALS}, bar AS (SELECT DISTINCT version, id FROM f WHERE class = 'BusbarSection'),
b AS (SELECT t.version, terminal_id, equipment_id, node, row_number() OVER (PARTITION BY t.version, equipment_id ORDER BY terminal_id) AS no FROM term t JOIN bar ON bar.version = t.version AND bar.id = t.equipment_id),
up AS (SELECT version, equipment_id FROM term t WHERE equipment_id IS NOT NULL AND (version, equipment_id) NOT IN (SELECT (version, id) FROM bar) GROUP BY ALL HAVING min(seq) = '0' AND (count(*) = 1 OR count(*) = 2 AND max(seq) = '1'))
SELECT version, terminal_id, equipment_id || CASE WHEN no > 1 THEN '#' || no ELSE '' END AS equipment_id, node, '1' AS seq FROM b
WHERE (version, terminal_id) IN (SELECT (version, id) FROM f WHERE attribute = 'ACDCTerminal.sequenceNumber')
UNION ALL SELECT version, terminal_id, equipment_id || CASE WHEN no > 1 THEN '#' || no ELSE '' END, node, NULL FROM b WHERE (version, terminal_id) NOT IN (SELECT (version, id) FROM f WHERE attribute = 'ACDCTerminal.sequenceNumber')
UNION ALL SELECT t.version, terminal_id, t.equipment_id, node, CASE WHEN u.version IS NULL OR seq IS NULL THEN seq ELSE CAST(CAST(seq AS INT) + 1 AS VARCHAR) END FROM term t LEFT JOIN up u ON u.version = t.version AND u.equipment_id = t.equipment_id
WHERE t.equipment_id IS NULL OR (t.version, t.equipment_id) NOT IN (SELECT (version, id) FROM bar)""",
    "resolved_fuses": f"""WITH {_ALL} SELECT c.version, c.id AS equipment_id, w.node1, w.node2, CASE WHEN w.version IS NULL THEN 'no terminal' ELSE w.anomaly END AS anomaly FROM cls c LEFT JOIN wiring w ON w.version = c.version AND w.equipment_id = c.id WHERE c.class = 'Fuse'""",
}
