"""Queries on schemas and dictionaries, with their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions import datatypes as dt
from lakewright.operators import dictionary as dic
from lakewright.operators import schema_check as sc
from lakewright.operators.upsert import duplicate_keys, inserted_if_absent, upserted
from lakewright.queries.common import derive, load, plain

# Every part is a variable of the table named by its brand; types follow from its type.
EXPECTED = """
SELECT lower(p_brand) AS lake_table_name, 'v' || CAST(p_partkey AS STRING) AS lake_variable_name,
       CASE WHEN p_size < 10 THEN 'integer' WHEN p_size < 20 THEN 'numeric'
            WHEN p_size < 25 THEN NULL ELSE 'text' END AS data_type,
       CASE WHEN p_size = 50 THEN NULL ELSE p_type IN ('LARGE', 'ECONOMY') END AS is_required,
       CASE WHEN p_size < 5 THEN 'Integer' WHEN p_size < 15 THEN 'numeric'
            WHEN p_size < 22 THEN '' WHEN p_size < 27 THEN NULL ELSE 'timestamp' END
       AS target_type,
       CASE WHEN p_brand = 'Brand#3' AND p_size > 25 THEN 2 ELSE 1 END AS version_number
FROM {part} WHERE p_type <> 'PROMO'
"""
OBSERVED = """
SELECT lower(p_brand) AS lake_table_name, 'v' || CAST(p_partkey AS STRING) AS lake_variable_name,
       CASE WHEN p_size < 7 THEN 'integer' WHEN p_size < 12 THEN 'double precision'
            WHEN p_size < 23 THEN 'numeric' WHEN p_size < 35 THEN 'text'
            ELSE 'timestamp without time zone' END AS data_type,
       CASE WHEN p_size < 7 THEN 'int4' WHEN p_size < 12 THEN 'float8'
            WHEN p_size < 23 THEN 'numeric' WHEN p_size < 35 THEN 'text' ELSE 'timestamp' END
       AS udt_name
FROM {part} WHERE p_type <> 'ECONOMY'
"""
_KIND = """CASE WHEN lower(coalesce(o.data_type, '')) IN ('integer', 'int', 'int4', 'smallint',
 'int2', 'bigint', 'int8') OR lower(coalesce(o.udt_name, '')) IN ('int4', 'int2', 'int8')
 THEN 'integer' WHEN lower(coalesce(o.data_type, '')) IN ('numeric', 'decimal', 'real',
 'double precision') OR lower(coalesce(o.udt_name, '')) IN ('numeric', 'float4', 'float8')
 THEN 'numeric' WHEN lower(o.data_type) = 'boolean' OR lower(o.udt_name) = 'bool' THEN 'boolean'
 WHEN lower(o.data_type) = 'date' THEN 'date' WHEN o.data_type LIKE '%timestamp%'
 THEN 'timestamp' WHEN lower(o.data_type) LIKE 'time%' THEN 'time' ELSE 'text' END"""
_SHOWN = "o.data_type || ' (' || o.udt_name || ')'"
_SCHEMA_ISSUES = f"""
WITH e AS {plain(EXPECTED)}, o AS {plain(OBSERVED)},
v AS (SELECT lake_table_name, CASE WHEN count(DISTINCT version_number) = 1
        THEN CAST(max(version_number) AS VARCHAR) END AS schema_version FROM e GROUP BY ALL),
b AS (SELECT e.lake_table_name, e.lake_variable_name, e.data_type AS expected_type,
        e.target_type, o.data_type AS observed_type, {_SHOWN} AS shown, {_KIND} AS kind
      FROM e JOIN o USING (lake_table_name, lake_variable_name)),
i AS (
SELECT lake_table_name, lake_variable_name, 'SCHEMA_MISSING_COLUMN' AS issue_code,
  'Missing required column' AS issue_type, 'structural' AS issue_group,
  'critical' AS severity, true AS is_blocking,
  'Required column ''' || lake_variable_name || ''' must exist with type ' || data_type
  AS expected_value, 'Column not present in observed schema' AS observed_value
FROM e WHERE is_required AND NOT EXISTS (SELECT 1 FROM o
  WHERE o.lake_table_name = e.lake_table_name AND o.lake_variable_name = e.lake_variable_name)
UNION ALL
SELECT lake_table_name, lake_variable_name, 'SCHEMA_UNEXPECTED_COLUMN',
  'Unexpected column not in expected schema', 'structural', 'critical', true,
  'No column with this name is defined in expected schema',
  'Observed unexpected column ''' || lake_variable_name || ''' with type ' || {_SHOWN}
FROM o WHERE NOT EXISTS (SELECT 1 FROM e
  WHERE o.lake_table_name = e.lake_table_name AND o.lake_variable_name = e.lake_variable_name)
UNION ALL
SELECT lake_table_name, lake_variable_name, 'SCHEMA_TYPE_MISMATCH',
  'Data type mismatch between expected and observed', 'dtype', 'warning', false,
  expected_type, shown FROM b WHERE expected_type <> observed_type
UNION ALL
SELECT lake_table_name, lake_variable_name, 'TYPE_TARGET_MISSING',
  'No target type defined in type_decision_table', 'dtype', 'warning', false,
  'target_type should be defined in type_decision_table.xlsx', 'observed type: ' || shown
FROM b WHERE coalesce(target_type, '') = ''
UNION ALL
SELECT lake_table_name, lake_variable_name, 'TYPE_TARGET_MISMATCH',
  'Observed type does not match target type for staging', 'dtype', 'warning', false,
  'target_type = ' || target_type, 'observed: ' || shown || ' -> normalized: ' || kind
FROM b WHERE target_type <> '' AND kind <> lower(target_type))
SELECT i.*, 'variable_level' AS check_context, schema_version
FROM i LEFT JOIN v USING (lake_table_name)"""


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "customer", "orders", "lineitem", "events", "labels")
    tables = {n: load(spark, sf_dir, n) for n in names}
    seen = sc.observed_schema(spark, tables)
    rows = [load(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(n).alias("lake_table_name"), "row_count") for n in names]
    counts = rows[0]
    for r in rows[1:]:
        counts = counts.unionByName(r)
    return seen.join(counts, "lake_table_name").select(
        "lake_table_name", "lake_variable_name", "ordinal_position", "row_count",
        dt.normalized_type(F.col("data_type"), F.col("udt_name")).alias("kind"))


_OBSERVED_SQL = """
SELECT table_name AS lake_table_name, column_name AS lake_variable_name,
       column_index AS ordinal_position, row_count,
       CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 'integer' WHEN data_type = 'DOUBLE'
            THEN 'numeric' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp' ELSE 'text' END
       AS kind
FROM duckdb_columns() JOIN (
  SELECT 'region' AS table_name, count(*) AS row_count FROM region
  UNION ALL SELECT 'customer', count(*) FROM customer
  UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'lineitem', count(*) FROM lineitem
  UNION ALL SELECT 'events', count(*) FROM events
  UNION ALL SELECT 'labels', count(*) FROM labels) USING (table_name)"""

STRUCTURE = """
SELECT 'raw' AS table_schema, upper(p_brand) AS table_name, 'V' || CAST(p_partkey AS STRING)
       AS column_name,
       CASE WHEN p_size < 10 THEN 'character varying' WHEN p_size < 20 THEN 'numeric'
            WHEN p_size < 28 THEN 'integer' WHEN p_size < 35 THEN 'timestamp with time zone'
            WHEN p_size < 40 THEN 'boolean' ELSE 'jsonb' END AS data_type,
       'udt' AS udt_name, CASE WHEN p_size < 10 THEN p_size END AS length,
       CASE WHEN p_size BETWEEN 10 AND 19 THEN p_size END AS precision,
       CASE WHEN p_size BETWEEN 10 AND 17 THEN 2 END AS scale,
       CASE WHEN p_size = 3 THEN '0' END AS default_value,
       p_size > 25 AS is_nullable, CAST(p_size AS INT) AS ordinal_position
FROM {part} WHERE p_type <> 'SMALL'
"""
PRIMARY_KEYS = """
SELECT 'raw' AS table_schema, p_brand AS table_name, 'v' || CAST(p_partkey AS STRING)
       AS column_name FROM {part} WHERE p_type = 'LARGE'
"""
SOURCES = """
SELECT p_type AS source_type, p_name AS source_table_name, 'Var ' || CAST(p_size AS STRING)
       AS source_variable_name, p_brand AS lake_table_name,
       'V' || CAST(p_partkey AS STRING) AS lake_variable_name FROM {part}
UNION ALL
SELECT 'ZZZ', p_name, 'again', lower(p_brand), 'v' || CAST(p_partkey AS STRING) FROM {part}
WHERE p_type = 'MEDIUM'
"""
FINAL_TYPES = """
SELECT p_brand AS table_name, 'v' || CAST(p_partkey AS STRING) AS variable,
       CASE WHEN p_size > 30 THEN 'DATE' END AS final_type FROM {part} WHERE p_type <> 'PROMO'
"""


def _expected_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sc.expected_schema(
        derive(spark, sf_dir, SOURCES), derive(spark, sf_dir, STRUCTURE),
        derive(spark, sf_dir, PRIMARY_KEYS), derive(spark, sf_dir, FINAL_TYPES), "2025.0")
    return out.drop("default_value", "udt_name")


_HASH_COLUMNS = ["schema_version", "table_schema", "lake_table_name", "lake_variable_name",
                 "data_type", "udt_name", "length", "precision", "scale", "default_value",
                 "is_nullable", "is_required", "is_primary_key", "ordinal_position",
                 "source_type", "source_table_name", "source_variable_name", "type_descriptor",
                 "target_type"]
_HASH = "sha256(concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in _HASH_COLUMNS) + "))"
_SUMS = ", ".join(
    f"CAST(sum(CAST('0x' || substr(column_schema_hash, {at}, 15) AS HUGEINT)) OVER w AS VARCHAR)"
    for at in (1, 16, 31, 46))
_EXPECTED_SCHEMA = f"""
WITH d AS (
  SELECT lower(lake_table_name) AS lake_table_name, lower(lake_variable_name)
    AS lake_variable_name, min((lower(source_type), lower(source_table_name),
    lower(source_variable_name))) AS s FROM {plain(SOURCES)} GROUP BY ALL),
s AS (SELECT table_schema, lower(table_name) AS lake_table_name, lower(column_name)
        AS lake_variable_name, * EXCLUDE (table_schema, table_name, column_name)
      FROM {plain(STRUCTURE)}),
k AS (SELECT DISTINCT table_schema, lower(table_name) AS lake_table_name, lower(column_name)
        AS lake_variable_name, true AS pk FROM {plain(PRIMARY_KEYS)}),
t AS (SELECT lower(table_name) AS lake_table_name, lower(variable) AS lake_variable_name,
        min(lower(final_type)) AS target_type FROM {plain(FINAL_TYPES)} GROUP BY ALL),
j AS (
  SELECT '2025.0' AS schema_version, table_schema, lake_table_name, lake_variable_name,
    data_type, udt_name, length, "precision", scale, default_value,
    coalesce(is_nullable, true) AS is_nullable, NOT coalesce(is_nullable, true) AS is_required,
    CASE WHEN s.table_schema IS NOT NULL THEN coalesce(pk, false) END AS is_primary_key,
    ordinal_position, d.s[1] AS source_type, d.s[2] AS source_table_name,
    d.s[3] AS source_variable_name,
    CASE WHEN length IS NOT NULL THEN 'varchar(' || length || ')'
      WHEN "precision" IS NOT NULL AND scale IS NOT NULL
      THEN 'numeric(' || "precision" || ',' || scale || ')'
      WHEN data_type IN ('boolean', 'integer', 'date') THEN data_type
      WHEN data_type LIKE '%timestamp%' THEN 'timestamp' ELSE 'text' END AS type_descriptor,
    target_type
  FROM d LEFT JOIN s USING (lake_table_name, lake_variable_name)
  LEFT JOIN k USING (table_schema, lake_table_name, lake_variable_name)
  LEFT JOIN t USING (lake_table_name, lake_variable_name)),
h AS (SELECT *, {_HASH} AS column_schema_hash FROM j)
SELECT * EXCLUDE (default_value, udt_name), sha256(concat_ws('|', {_SUMS}))
  AS table_schema_hash FROM h
WINDOW w AS (PARTITION BY schema_version, lake_table_name, table_schema)"""


def _dictionary(where: str, label: str, unit: str, required: str) -> str:
    return f"""
SELECT p_type AS source_type, lower(p_brand) AS lake_table_name,
       'v' || CAST(p_partkey AS STRING) AS lake_variable_name,
       p_name AS source_table_name, 'Var ' || CAST(p_size AS STRING) AS source_variable_name,
       CASE WHEN p_size > 25 THEN 'text' ELSE 'integer' END AS data_type,
       {label} AS variable_label, CAST(NULL AS STRING) AS variable_definition,
       CAST(NULL AS STRING) AS value_labels, {unit} AS variable_unit,
       CAST(p_size AS DOUBLE) AS valid_min, CAST(NULL AS DOUBLE) AS valid_max,
       CAST(NULL AS STRING) AS allowed_values, p_size = 1 AS is_identifier,
       p_size = 2 AS is_phi, {required} AS is_required,
       CASE WHEN p_size > 40 THEN 'labs, vitals' ELSE 'labs' END AS validated_table_target,
       'col_' || CAST(p_size AS STRING) AS validated_variable_name,
       CAST(NULL AS STRING) AS notes, CAST(NULL AS STRING) AS needs_further_review
FROM {{part}} {where}"""


OLD = _dictionary("WHERE p_type <> 'PROMO'", "p_name", "CASE WHEN p_size > 20 THEN 'kg' END",
                  "p_size = 3")
NEW = _dictionary(
    "WHERE p_type <> 'ECONOMY'", "CASE WHEN p_size > 45 THEN upper(p_name) ELSE p_name END",
    "CASE WHEN p_size > 30 THEN 'kg' WHEN p_size > 10 THEN '' END", "p_size IN (3, 4)")
_CASTS = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c not in ("valid_min", "valid_max")
    else f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) || '.0' END AS {c}"
    for c in dic.TRACKED_FIELDS)


def _fields(text: str, value: str) -> str:
    return (f"(SELECT * FROM (SELECT source_type, lake_table_name, lake_variable_name, "
            f"{_CASTS} FROM {plain(text)}) UNPIVOT INCLUDE NULLS "
            f"({value} FOR field_changed IN ({', '.join(dic.TRACKED_FIELDS)})))")


_CHANGES = f"""
SELECT lake_table_name, lake_variable_name, source_type, field_changed,
  CASE WHEN n.f AND o.f THEN nullif(old_value, '') ELSE old_value END AS old_value,
  CASE WHEN n.f AND o.f THEN nullif(new_value, '') ELSE new_value END AS new_value,
  CASE WHEN o.f IS NULL THEN 'ADD' WHEN n.f IS NULL THEN 'REMOVE' ELSE 'UPDATE' END
  AS change_type
FROM (SELECT *, true AS f FROM {_fields(NEW, 'new_value')}) n
FULL JOIN (SELECT *, true AS f FROM {_fields(OLD, 'old_value')}) o
USING (lake_table_name, lake_variable_name, source_type, field_changed)
WHERE n.f IS NULL OR o.f IS NULL OR coalesce(old_value, '') <> coalesce(new_value, '')"""
_INITIAL = f"""
SELECT lake_table_name, lake_variable_name, source_type, field_changed,
  CAST(NULL AS VARCHAR) AS old_value, new_value, 'INITIAL' AS change_type
FROM {_fields(NEW, 'new_value')}"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dic.dictionary_changes(derive(spark, sf_dir, NEW), derive(spark, sf_dir, OLD))


def _initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = derive(spark, sf_dir, NEW)
    return dic.dictionary_changes(new, spark.createDataFrame([], new.schema))


METADATA = OLD.replace("AS needs_further_review\n", """AS needs_further_review,
       CASE WHEN p_type = 'LARGE' THEN 2 ELSE 3 END AS version_number,
       p_type <> 'LARGE' OR p_size > 10 AS is_active,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at,
       TIMESTAMP '2024-01-01 00:00:00' AS updated_at, CAST('text' AS STRING) AS target_type
""")


def _next_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = derive(spark, sf_dir, METADATA)
    out = dic.next_metadata(derive(spark, sf_dir, NEW), metadata, 4)
    return out.select(
        *dic.KEY, "variable_label", "variable_unit", "is_required", "version_number",
        "is_active", "target_type",
        (F.col("created_at") == F.lit("2024-01-01").cast("timestamp")).alias("is_old"))


_NEXT_METADATA = f"""
SELECT lake_table_name, lake_variable_name, source_type,
  CASE WHEN n.f THEN n.variable_label ELSE o.variable_label END AS variable_label,
  CASE WHEN n.f THEN n.variable_unit ELSE o.variable_unit END AS variable_unit,
  CASE WHEN n.f THEN n.is_required ELSE o.is_required END AS is_required,
  CASE WHEN n.f OR o.is_active THEN 4 ELSE o.version_number END AS version_number,
  coalesce(n.f, false) AS is_active, o.target_type, o.f IS NOT NULL AS is_old
FROM (SELECT *, true AS f FROM {plain(NEW)}) n
FULL JOIN (SELECT *, true AS f FROM {plain(METADATA)}) o
USING (lake_table_name, lake_variable_name, source_type)"""

CORE = """
SELECT ' ' || p_brand || ' ' AS lake_table_name, upper(p_name) || CAST(p_size AS STRING)
       AS lake_variable_name, ' Text' AS data_type, p_type AS source_type,
       p_name AS source_table_name, 'Var ' || CAST(p_size AS STRING) AS source_variable_name
FROM {part} WHERE p_type <> 'SMALL'
UNION ALL
SELECT NULL, p_name, 'INTEGER', p_type, p_name, 'none' FROM {part} WHERE p_type = 'SMALL'
"""
PRIOR = """
SELECT DISTINCT p_brand AS table_name, ' ' || p_name || CAST(p_size AS STRING) AS variable,
       'text' AS suggested_type, CASE WHEN p_size < 20 THEN 'DATE' WHEN p_size < 30 THEN ' ' END
       AS final_type, CASE WHEN p_size < 15 THEN 'checked' WHEN p_size < 25 THEN '' END
       AS decision_note
FROM {part} WHERE p_type <> 'LARGE'
"""
_REFRESHED = f"""
WITH u AS (SELECT lower(trim(lake_table_name)) AS table_name, lower(trim(lake_variable_name))
             AS variable, min(lower(trim(data_type))) AS suggested_type FROM {plain(CORE)}
           WHERE lake_table_name IS NOT NULL GROUP BY ALL),
p AS (SELECT lower(trim(table_name)) AS table_name, lower(trim(variable)) AS variable,
        any_value(final_type) AS final_type, any_value(decision_note) AS decision_note
      FROM {plain(PRIOR)} GROUP BY ALL)
SELECT table_name, variable, suggested_type,
  CASE WHEN trim(final_type) <> '' THEN final_type END AS final_type,
  CASE WHEN trim(decision_note) <> '' THEN decision_note ELSE 'PENDING REVIEW' END
  AS decision_note FROM u LEFT JOIN p USING (table_name, variable)"""
_ORPHANS = f"""
SELECT lower(trim(table_name)) AS table_name, lower(trim(variable)) AS variable,
  suggested_type, final_type, decision_note FROM {plain(PRIOR)}
WHERE (lower(trim(table_name)), lower(trim(variable))) NOT IN (
  SELECT (lower(trim(lake_table_name)), lower(trim(lake_variable_name))) FROM {plain(CORE)}
  WHERE lake_table_name IS NOT NULL)"""

LOOSE = """
SELECT p_type AS source_type, p_brand AS lake_table_name, p_name AS lake_variable_name,
       'text' AS data_type, CASE WHEN p_size < 10 THEN 'yes' WHEN p_size < 20 THEN 'N'
       WHEN p_size < 30 THEN 'true' WHEN p_size < 40 THEN NULL ELSE '?' END AS is_required,
       CASE WHEN p_size > 30 THEN 'n/a' ELSE CAST(p_size AS STRING) END AS valid_min,
       CAST(p_partkey AS STRING) AS notes
FROM {part}
"""


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dic.load_dictionary(derive(spark, sf_dir, LOOSE), "PROMO")
    return out.select(*dic.KEY, "data_type", "is_required", "is_phi", "valid_min", "valid_max",
                      "variable_unit", "notes")


_LOADED = f"""
SELECT lake_table_name, lake_variable_name, source_type, data_type,
  coalesce(upper(is_required) IN ('Y', 'YES', 'TRUE', '1'), false) AS is_required,
  false AS is_phi, TRY_CAST(valid_min AS DOUBLE) AS valid_min, CAST(NULL AS DOUBLE) AS valid_max,
  CAST(NULL AS VARCHAR) AS variable_unit, notes
FROM {plain(LOOSE)} WHERE source_type = 'PROMO'"""


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = derive(spark, sf_dir, """
        SELECT c_custkey AS k, c_name AS name, c_acctbal AS amount, c_mktsegment AS first_seen
        FROM {customer}""")
    incoming = derive(spark, sf_dir, """
        SELECT o_custkey + 500 AS k, 'new' AS name, max(o_totalprice) AS amount,
               'orders' AS first_seen FROM {orders} GROUP BY o_custkey""")
    return upserted(current, incoming, ["k"], keep=("first_seen",))


BUSY = "SELECT o_custkey AS k FROM {orders} GROUP BY o_custkey HAVING count(*) > 9"


def _absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    seen = derive(spark, sf_dir, BUSY)
    return inserted_if_absent(seen, customers, ["k"])


QUERIES = {
    "schema_issues": (
        lambda s, d: sc.schema_issues(derive(s, d, EXPECTED), derive(s, d, OBSERVED)),
        _SCHEMA_ISSUES),
    "observed_schema": (_observed, _OBSERVED_SQL),
    "expected_schema": (_expected_schema, _EXPECTED_SCHEMA),
    "dictionary_changes": (_changes, _CHANGES),
    "dictionary_initial": (_initial, _INITIAL),
    "dictionary_upsert": (_next_metadata, _NEXT_METADATA),
    "dictionary_load": (_loaded, _LOADED),
    "current_version": (
        lambda s, d: dic.current_version(derive(s, d, METADATA)),
        f"SELECT coalesce(max(version_number), 0) AS version_number FROM {plain(METADATA)}"),
    "ingest_dictionary": (
        lambda s, d: dic.derive_ingest_dictionary(derive(s, d, CORE)),
        f"SELECT DISTINCT source_type, source_table_name, source_variable_name, "
        f"lake_table_name, lake_variable_name FROM {plain(CORE)} "
        f"WHERE lake_table_name IS NOT NULL AND lake_variable_name IS NOT NULL"),
    "type_decision_refresh": (
        lambda s, d: dic.refreshed_type_decisions(derive(s, d, CORE), derive(s, d, PRIOR)),
        _REFRESHED),
    "type_decision_orphans": (
        lambda s, d: dic.orphaned_type_decisions(derive(s, d, CORE), derive(s, d, PRIOR)),
        _ORPHANS),
    "duplicate_keys": (
        lambda s, d: duplicate_keys(
            load(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL "
        "HAVING count(*) > 1"),
    "key_upsert": (
        _upsert,
        "SELECT k, CASE WHEN n.k2 IS NOT NULL THEN 'new' ELSE c_name END AS name, "
        "CASE WHEN n.k2 IS NOT NULL THEN n.amount ELSE c_acctbal END AS amount, "
        "coalesce(c_mktsegment, 'orders') AS first_seen FROM (SELECT c_custkey AS k, * "
        "FROM customer) FULL JOIN (SELECT o_custkey + 500 AS k, o_custkey + 500 AS k2, "
        "max(o_totalprice) AS amount FROM orders GROUP BY ALL) n USING (k)"),
    "insert_if_absent": (
        _absent,
        f"SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN {plain(BUSY)}"),
}
