"""Queries of the general data problems (rows that fail to parse, near points, wide tables, nested records, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import delimited, eager, nested, orphans, spatial, widen
from gridloom.session import table
from gridloom.sources import documents

#: Distance in metres within which two points are near.
NEAR_M = 25.0


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    parsed = delimited.parse_rows(table(spark, d, "raw_rows"), table(spark, d, "raw_layouts"))
    return delimited.errors(parsed).select("source_file", "line")


def p1_errors(spark: SparkSession, d: str) -> DataFrame:
    """The invalid rows and every further error in them in the form of staging_errors."""
    return delimited.every_error(delimited.parse_rows(table(spark, d, "raw_rows"), table(spark, d, "raw_layouts")))


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """The valid rows of all layouts, typed, and the records recovered from broken rows."""
    layouts = table(spark, d, "raw_layouts")
    return delimited.all_records(delimited.parse_rows(table(spark, d, "raw_rows"), layouts), layouts)


def p1_records_lines(spark: SparkSession, d: str) -> DataFrame:
    """The valid rows of the layout `lines`, typed."""
    layouts = table(spark, d, "raw_layouts")
    return delimited.records(delimited.parse_rows(table(spark, d, "raw_rows"), layouts), layouts, "lines")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    points = spatial.current_locations(table(spark, d, "geometry_point"))
    near = spatial.near_pairs(points, NEAR_M).select(F.lit("near").alias("relation"), "left_id", "right_id")
    within = spatial.containing_areas(points, table(spark, d, "supply_area"))
    return near.unionByName(within.select(F.lit("within").alias("relation"), F.col("point_id").alias("left_id"), F.col("area_id").alias("right_id")))


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """Points at exactly the same place, as membership."""
    return spatial.co_located(spatial.current_locations(table(spark, d, "geometry_point")))


def p2_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The near pairs between the classes of p2_classes."""
    return spatial.near_pairs(spatial.class_points(spatial.current_locations(table(spark, d, "geometry_point"))), NEAR_M)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    wide = widen.widen(table(spark, d, "staging_records"), table(spark, d, "attribute_types"))
    return wide.select("version", "id", F.explode("bad_attributes").alias("attribute"))


def p3_wide(spark: SparkSession, d: str) -> DataFrame:
    """The wide table itself, one row per object."""
    return widen.widen(table(spark, d, "staging_records"), table(spark, d, "attribute_types"))


def p3_cells(spark: SparkSession, d: str) -> DataFrame:
    """(version, id, class, attribute, long_value, double_value, boolean_value, date_value, string_value): the filled cells of the wide table."""
    wide = widen.widen(table(spark, d, "staging_records"), table(spark, d, "attribute_types"))
    kinds = {"long": "bigint", "double": "double", "boolean": "boolean", "date": "date", "string": "string"}
    out = None
    keys = ["version", "id", "class", "bad_attributes"]
    for kind, sql in kinds.items():
        names = [f.name for f in wide.schema.fields if f.name not in keys and f.dataType.simpleString() == sql]
        if not names:
            continue
        cell = F.explode(F.array(*(F.struct(F.lit(n.removesuffix("_value")).alias("attribute"), F.col(f"`{n}`").alias("v")) for n in names)))
        one = wide.select("version", "id", "class", cell.alias("c")).filter("c.v IS NOT NULL")
        one = one.select("version", "id", "class", "c.attribute", *(F.col("c.v").alias(f"{k}_value") if k == kind else F.lit(None).cast(t).alias(f"{k}_value") for k, t in kinds.items()))
        out = one if out is None else out.unionByName(one)
    return out


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = nested.nodes(table(spark, d, "model_file"), once=False).filter(F.col("kind") != "unreadable")
    return found.select("file_id", "parent_path", F.col("path").alias("child_path")).distinct()


def p4_table(kind: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return nested.flat_table(nested.nodes(table(spark, d, "model_file")), kind)

    query.__doc__ = f"The flat table of kind {kind}."
    return query


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    """(dimension, key, n_rows, n_objects, n_links): for each class and each value the rows, the different objects, and the links to them.

    n_links counts the pairs of such a row and a reference that points to the row's object: the join of the facts with the
    references, whose multiplicities are those of the references. Null classes and values are groups; a null version or id
    is an object's key like any other (the join needs keys that are not null, so ids get a mark in front and a null version
    stands as the least number); a reference without value points to nothing.
    """
    facts = table(spark, d, "staging_records")
    version, mark = F.coalesce("version", F.lit(-(2**63))), lambda c: F.concat(F.lit("="), c)
    left = facts.withColumns({"version": version, "id": F.coalesce(mark(F.col("id")), F.lit(""))})
    links = facts.filter("is_reference AND value IS NOT NULL").distinct().select(version.alias("version"), mark(F.col("value")).alias("id"))
    out = eager.eager_counts(left, links, ["version", "id"], ["class", "value"])
    return out.select("dimension", "key", F.col("n_left").alias("n_rows"), F.col("n_keys").alias("n_objects"), F.col("n_rows").alias("n_links"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.model_orphans(*(table(spark, d, t) for t in ("model_edge", "jag2nsc_raw_terminal", "model_node", "model_equipment")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("ref_table", "ref_column", "record_id").distinct()


def p7_monthly(spark: SparkSession, d: str) -> DataFrame:
    """(ref_table, ref_column, month, n_references, n_orphans): counts per table, column and month of loaded_at."""
    month = F.date_format("at", "yyyy-MM").alias("month")
    refs = orphans.model_references(table(spark, d, "model_edge"), table(spark, d, "jag2nsc_raw_terminal")).filter(F.col("key").isNotNull() & (F.col("key") != ""))
    keys = ["ref_table", "ref_column", "month"]
    every = refs.groupBy("ref_table", "ref_column", month).agg(F.count(F.lit(1)).alias("n_references"), F.lit(0).cast("long").alias("n_orphans"))
    lost = _orphans(spark, d).groupBy("ref_table", "ref_column", month).agg(F.lit(0).cast("long").alias("n_references"), F.count(F.lit(1)).alias("n_orphans"))
    return every.unionByName(lost).groupBy(*keys).agg(F.sum("n_references").alias("n_references"), F.sum("n_orphans").alias("n_orphans"))


def p7_filter(spark: SparkSession, d: str) -> DataFrame:
    """(n_references, n_unknown, n_passed): how many references to unknown keys the Bloom filter lets pass to the exact join."""
    refs = orphans.model_references(table(spark, d, "model_edge"), table(spark, d, "jag2nsc_raw_terminal"))
    return orphans.filter_report(refs, orphans.model_targets(table(spark, d, "model_node"), table(spark, d, "model_equipment")), ["target", "key"])


def document_facts(spark: SparkSession, d: str) -> DataFrame:
    """The readable documents of model_file as facts."""
    good, _ = documents.classify(table(spark, d, "model_file"))
    return documents.facts(good, 1)


def document_errors(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong in the paths and bodies of model_file."""
    return documents.facts_and_errors(table(spark, d, "model_file"), 1)[1]


QUERIES = {
    "document_facts": document_facts,
    "document_errors": document_errors,
    "p1_found": p1_found,
    "p1_errors": p1_errors,
    "p1_records": p1_records,
    "p1_records_lines": p1_records_lines,
    "p2_found": p2_found,
    "p2_classes": p2_classes,
    "p2_class_pairs": p2_class_pairs,
    "p3_found": p3_found,
    "p3_wide": p3_wide,
    "p3_cells": p3_cells,
    "p4_found": p4_found,
    **{f"p4_{k}": p4_table(k) for k in nested.KINDS},
    "p5_counts": p5_counts,
    "p7_found": p7_found,
    "p7_monthly": p7_monthly,
    "p7_filter": p7_filter,
}

_TYPED = """
typed AS (
  SELECT s.version, s.id, s.attribute, t.value_type AS kind, trim(s.value) AS v
  FROM staging_records s JOIN attribute_types t ON s.attribute = t.attribute
  WHERE t.value_type <> 'string' AND s.value IS NOT NULL AND trim(s.value) <> ''),
judged AS (
  SELECT version, id, attribute, CASE kind
    WHEN 'long' THEN regexp_full_match(v, '-?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL
    WHEN 'double' THEN regexp_full_match(v, '-?[0-9]+(\\.[0-9]+)?([eE][+-]?[0-9]+)?') AND isfinite(coalesce(TRY_CAST(v AS DOUBLE), 'inf'::DOUBLE))
    WHEN 'boolean' THEN lower(v) IN ('true', 'false')
    ELSE regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL END AS good
  FROM typed)
"""

_LOCATED = """
located AS (
  SELECT point_id AS id, any_value(lat) AS lat, any_value(lon) AS lon
  FROM (SELECT * FROM geometry_point QUALIFY rank() OVER (PARTITION BY point_id ORDER BY version DESC) = 1)
  GROUP BY point_id
  HAVING any_value(lat) BETWEEN -90 AND 90 AND any_value(lon) BETWEEN -180 AND 180 AND NOT (any_value(lat) = 0 AND any_value(lon) = 0))
"""

_REFS = """
refs AS (
  SELECT DISTINCT * FROM (
    SELECT 'node' AS target, 'model_edge' AS ref_table, 'terminal1_node_id' AS ref_column, equipment_id AS record_id, terminal1_node_id AS key, loaded_at AS seen FROM model_edge
    UNION ALL SELECT 'node', 'model_edge', 'terminal2_node_id', equipment_id, terminal2_node_id, loaded_at FROM model_edge
    UNION ALL SELECT 'equipment', 'jag2nsc_raw_terminal', 'equipment_id', terminal_id, equipment_id, loaded_at FROM jag2nsc_raw_terminal
    UNION ALL SELECT 'node', 'jag2nsc_raw_terminal', 'node_id', terminal_id, node_id, loaded_at FROM jag2nsc_raw_terminal)
  WHERE key IS NOT NULL AND key <> ''),
live AS (SELECT DISTINCT 'node' AS target, id, loaded_at, deleted_at FROM model_node UNION SELECT DISTINCT 'equipment', id, loaded_at, deleted_at FROM model_equipment),
judged AS (
  SELECT r.*, NOT EXISTS (
    SELECT 1 FROM live l WHERE l.target = r.target AND l.id = r.key AND r.seen >= l.loaded_at AND (l.deleted_at IS NULL OR r.seen < l.deleted_at)) AS lost
  FROM refs r)
"""



def _elements(field: str) -> str:
    """SQL: the elements of a field of `node` as a list; an object is its element 0."""
    v = f"json_extract(node, '$.{field}')"
    return f"CASE json_type({v}) WHEN 'ARRAY' THEN json_extract({v}, '$[*]') WHEN 'OBJECT' THEN [{v}] ELSE CAST([] AS JSON[]) END"


def _below(source: str, *fields: str) -> str:
    """SQL: the objects in the fields of each node of `source`, with their paths."""
    lists = {f: f"list_concat({_elements(f)}, {_elements(nested.ALSO[f])})" if f in nested.ALSO else _elements(f) for f in fields}
    parts = " UNION ALL ".join(f"SELECT file_id, path, '{f}' AS f, {x} AS l FROM {source}" for f, x in lists.items())
    return f"SELECT file_id, path AS parent_path, path || '.' || f || '[' || (i - 1) || ']' AS path, f, e AS node FROM (SELECT file_id, path, f, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM ({parts})) WHERE json_type(e) = 'OBJECT'"


_NODES = f"""
root AS (SELECT DISTINCT file_id, '$' AS path, CAST(body AS JSON) AS node FROM model_file WHERE json_valid(body) AND json_type(body) = 'OBJECT'),
top AS ({_below('root', *nested.FIELDS['file'])}), bus AS (SELECT * FROM top WHERE f = 'busbars'), bay AS (SELECT * FROM top WHERE f = 'bays'),
section AS ({_below('bus', 'sections')}), inner_ AS ({_below('bay', 'equipments')}), owner AS (SELECT * FROM section UNION ALL SELECT * FROM inner_ UNION ALL SELECT * FROM top WHERE f IN ('equipments', 'segments')), satellite AS ({_below('owner', 'satellites')}),
entry AS (SELECT file_id, path AS parent_path, path || '.attributes.' || k AS path FROM (SELECT file_id, path, unnest(json_keys(t)) AS k, unnest(json_extract(t, '$.*')) AS v FROM (SELECT file_id, path, json_extract(node, '$.attributes') AS t FROM satellite) WHERE json_type(t) = 'OBJECT') WHERE json_type(v) <> 'NULL'),
node AS (SELECT DISTINCT file_id, parent_path, path FROM top UNION SELECT file_id, parent_path, path FROM section UNION SELECT file_id, parent_path, path FROM inner_ UNION SELECT file_id, parent_path, path FROM satellite UNION SELECT * FROM entry)
"""

ORACLES = {
    "p4_found": f"WITH {_NODES} SELECT file_id, parent_path, path AS child_path FROM node",
    "p2_found": f"""
WITH {_LOCATED},
v AS (SELECT DISTINCT area_id, ring_no, vertex_no, lat, lon FROM supply_area),
edges AS (
  SELECT area_id, lat AS y1, lon AS x1,
    coalesce(lead(lat) OVER r, first_value(lat) OVER r) AS y2, coalesce(lead(lon) OVER r, first_value(lon) OVER r) AS x2
  FROM v WINDOW r AS (PARTITION BY area_id, ring_no ORDER BY vertex_no)),
crossed AS (
  SELECT p.id, e.area_id, count(*) AS n FROM located p JOIN edges e
  ON (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY 1, 2)
SELECT 'near' AS relation, a.id AS left_id, b.id AS right_id FROM located a JOIN located b ON a.id < b.id
WHERE 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= 25
UNION ALL SELECT 'within', id, area_id FROM crossed WHERE n % 2 = 1
""",
    "p2_classes": f"WITH {_LOCATED} SELECT id AS point_id, min(id) OVER (PARTITION BY lat, lon) AS class_id FROM located",
    "p2_class_pairs": f"""
WITH {_LOCATED}, c AS (SELECT min(id) AS id, lat, lon FROM located GROUP BY lat, lon)
SELECT a.id AS left_id, b.id AS right_id FROM c a JOIN c b ON a.id < b.id
WHERE 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= 25
""",
    "p3_found": f"WITH {_TYPED} SELECT version, id, attribute FROM judged GROUP BY ALL HAVING NOT bool_or(good)",
    "p3_cells": """
WITH f AS (SELECT * FROM staging_records), kind AS (SELECT attribute, min(value_type) AS kind FROM attribute_types WHERE attribute IS NOT NULL GROUP BY attribute),
t AS (SELECT f.version, f.id, f.attribute, f.seq, coalesce(k.kind, 'string') AS kind, CASE WHEN coalesce(k.kind, 'string') = 'string' THEN f.value ELSE trim(f.value) END AS v FROM f LEFT JOIN kind k USING (attribute) WHERE f.attribute IS NOT NULL AND f.value IS NOT NULL),
good AS (SELECT * FROM t WHERE v <> '' AND CASE kind
    WHEN 'long' THEN regexp_full_match(v, '-?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL
    WHEN 'double' THEN regexp_full_match(v, '-?[0-9]+(\\.[0-9]+)?([eE][+-]?[0-9]+)?') AND isfinite(coalesce(TRY_CAST(v AS DOUBLE), 'inf'::DOUBLE))
    WHEN 'boolean' THEN lower(v) IN ('true', 'false')
    WHEN 'date' THEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL ELSE true END),
cell AS (SELECT version, id, attribute, kind, struct_extract(min({'s': coalesce(seq, -2147483648), 'v': v}), 'v') AS v FROM good GROUP BY ALL),
cls AS (SELECT version, id, coalesce(min(class) FILTER (WHERE class <> 'Equipment'), min(class)) AS class FROM f GROUP BY ALL)
SELECT c.version, c.id, x.class, c.attribute, CASE WHEN kind = 'long' THEN TRY_CAST(v AS BIGINT) END AS long_value, CASE WHEN kind = 'double' THEN TRY_CAST(v AS DOUBLE) END AS double_value,
  CASE WHEN kind = 'boolean' THEN lower(v) = 'true' END AS boolean_value, CASE WHEN kind = 'date' THEN TRY_CAST(v AS DATE) END AS date_value, CASE WHEN kind = 'string' THEN v END AS string_value
FROM cell c JOIN cls x ON x.version IS NOT DISTINCT FROM c.version AND x.id IS NOT DISTINCT FROM c.id
""",
    "p5_counts": """
WITH f AS (SELECT DISTINCT * FROM staging_records),
m AS (SELECT version, value AS id, count(*) AS m FROM f WHERE is_reference AND value IS NOT NULL GROUP BY ALL),
g AS (SELECT f.*, coalesce(m.m, 0) AS m FROM f LEFT JOIN m ON m.version IS NOT DISTINCT FROM f.version AND m.id = f.id)
SELECT 'class' AS dimension, class AS key, count(*) AS n_rows, count(DISTINCT (version, id)) AS n_objects, CAST(sum(m) AS BIGINT) AS n_links FROM g GROUP BY class
UNION ALL SELECT 'value', value, count(*), count(DISTINCT (version, id)), CAST(sum(m) AS BIGINT) FROM g GROUP BY value
""",
    "p7_found": f"WITH {_REFS} SELECT DISTINCT ref_table, ref_column, record_id FROM judged WHERE lost",
    "p7_monthly": f"""
WITH {_REFS} SELECT ref_table, ref_column, strftime(seen AT TIME ZONE 'UTC', '%Y-%m') AS month, count(*) AS n_references, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_orphans
FROM judged GROUP BY ALL
""",
}
