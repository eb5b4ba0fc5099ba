"""Registered queries of the general data problems (pN_)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import drift, nested
from ..session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of fields from file to file of a feed."""
    found = drift.changes(table(spark, folder, "raw_file"), table(spark, folder, "raw_record"))
    return found.select("file_id", "change_kind", "field_name")


def p1_unified(spark: SparkSession, folder: str) -> DataFrame:
    """All records under one schema."""
    return drift.unified(table(spark, folder, "raw_file"), table(spark, folder, "raw_record"))


def p1_long(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of every record with the column it goes to, without a bound on columns."""
    return drift.unified_long(table(spark, folder, "raw_file"), table(spark, folder, "raw_record"))


def p1_displaced(spark: SparkSession, folder: str) -> DataFrame:
    """Values that share their column with another field of their record."""
    return drift.displaced(table(spark, folder, "raw_file"), table(spark, folder, "raw_record"))


def p1_log(spark: SparkSession, folder: str) -> DataFrame:
    """The changes in order, with the names and types before and after."""
    return drift.change_log(table(spark, folder, "raw_file"), table(spark, folder, "raw_record"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of nested fields with the numbers of what holds them."""
    return nested.entries(table(spark, folder, "api_page"))


def p2_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Every element of every body with its parent link."""
    return nested.flatten(table(spark, folder, "api_page"))


def p2_items(spark: SparkSession, folder: str) -> DataFrame:
    """Items with their scalar fields."""
    return nested.level_rows(table(spark, folder, "api_page"), "data").drop("variant_no", "upgrade_no")


def p2_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Variants with their scalar fields and their item's number."""
    return nested.level_rows(table(spark, folder, "api_page"), "variants").drop("upgrade_no")


def p2_upgrades(spark: SparkSession, folder: str) -> DataFrame:
    """Upgrades with their scalar fields and their variant's and item's numbers."""
    return nested.level_rows(table(spark, folder, "api_page"), "upgrades")


QUERIES = {f.__name__: f for f in (p1_found, p1_unified, p1_long, p1_displaced, p1_log, p2_found, p2_nodes, p2_items, p2_variants, p2_upgrades)}

_OBJECTS = (
    "WITH p AS (SELECT page_id, body::JSON AS j FROM api_page WHERE json_valid(body)), "
    "i AS (SELECT page_id, n AS item_no, json_extract(j, '$.data[' || n || ']') AS o FROM (SELECT page_id, j, unnest(range(json_array_length(j, '$.data')::BIGINT))::INT AS n FROM p WHERE json_type(j, '$.data') = 'ARRAY')), "
    "v AS (SELECT page_id, item_no, n AS variant_no, json_extract(o, '$.variants[' || n || ']') AS o FROM (SELECT *, unnest(range(json_array_length(o, '$.variants')::BIGINT))::INT AS n FROM i WHERE json_type(o, '$.variants') = 'ARRAY')), "
    "u AS (SELECT page_id, item_no, variant_no, n AS upgrade_no, json_extract(o, '$.upgrades[' || n || ']') AS o FROM (SELECT *, unnest(range(json_array_length(o, '$.upgrades')::BIGINT))::INT AS n FROM v WHERE json_type(o, '$.upgrades') = 'ARRAY')), "
    "objects AS (SELECT page_id, item_no, -1 AS variant_no, -1 AS upgrade_no, o FROM i UNION ALL SELECT page_id, item_no, variant_no, -1, o FROM v UNION ALL SELECT page_id, item_no, variant_no, upgrade_no, o FROM u), "
)

#: Entries by SQL; Python literals are read by exchanging their quotes and names for JSON's.
_ENTRIES = (
    _OBJECTS
    + "f AS (SELECT * EXCLUDE (o), json_extract(o, '$.' || field_name) AS v FROM objects CROSS JOIN (VALUES ('attack'), ('requiredAttributes'), ('scalesWith')) AS n(field_name) WHERE json_type(o) = 'OBJECT'), "
    "t AS (SELECT * REPLACE (CASE WHEN json_type(v) = 'VARCHAR' THEN CASE WHEN json_valid(v ->> '$') THEN TRY_CAST(v ->> '$' AS JSON) "
    "ELSE TRY_CAST(replace(replace(replace(replace(v ->> '$', '''', chr(34)), 'None', 'null'), 'True', 'true'), 'False', 'false') AS JSON) END ELSE v END AS v) FROM f), "
    "e AS (SELECT * EXCLUDE (v, n), n AS entry_no, json_extract_string(v, '$[' || n || '].name') AS name, json_extract_string(v, '$[' || n || '].' || CASE field_name WHEN 'scalesWith' THEN 'scaling' ELSE 'amount' END) AS value "
    "FROM (SELECT *, unnest(range(json_array_length(v)::BIGINT))::INT AS n FROM t WHERE json_type(v) = 'ARRAY') "
    "UNION ALL SELECT * EXCLUDE (v), 0, v ->> '$.name', json_extract_string(v, '$.' || CASE field_name WHEN 'scalesWith' THEN 'scaling' ELSE 'amount' END) FROM t WHERE json_type(v) = 'OBJECT' AND list_contains(json_keys(v), 'name') "
    "UNION ALL SELECT * EXCLUDE (v, n), n - 1, json_keys(v)[n], json_extract_string(v, '$.' || chr(34) || json_keys(v)[n] || chr(34)) "
    "FROM (SELECT *, unnest(range(1, len(json_keys(v)) + 1))::INT AS n FROM t WHERE json_type(v) = 'OBJECT' AND NOT list_contains(json_keys(v), 'name'))) "
    "SELECT page_id, item_no, variant_no, upgrade_no, field_name, entry_no, lower(trim(name)) AS entry_name, "
    "CASE WHEN field_name = 'scalesWith' THEN upper(trim(value)) ELSE round(TRY_CAST(replace(trim(value), ',', '') AS DOUBLE))::BIGINT::VARCHAR END AS entry_value FROM e WHERE trim(name) <> '' AND entry_value IS NOT NULL"
)

#: Every element by SQL, numbered in the order in which they stand.
_NODES = (
    "WITH t AS (SELECT page_id, t.id, t.parent, t.key, t.type, t.atom FROM api_page, json_tree(body) AS t WHERE json_valid(body)), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY id) - 1 AS node_id, row_number() OVER (PARTITION BY page_id, parent ORDER BY id) - 1 AS ordinal FROM t) "
    "SELECT n.page_id, n.node_id, p.node_id AS parent_id, n.ordinal, CASE WHEN p.type = 'OBJECT' THEN n.key END AS name, "
    "CASE n.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind, "
    "CASE WHEN n.type NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN n.atom ->> '$' END AS value FROM n LEFT JOIN n AS p ON p.page_id = n.page_id AND p.id = n.parent"
)

ORACLES: dict[str, str] = {"p2_found": _ENTRIES, "p2_nodes": _NODES}
