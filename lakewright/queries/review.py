"""Review queries over logs derived from the test tables, with their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.plans import review as rv
from lakewright.queries.common import derive, load, plain
from lakewright.queries.dictionary import METADATA, NEW, OLD, _CHANGES
from lakewright.queries.profiling import (
    _PROFILE, _SENTINELS, _SUMMARY, ALL, SMALL, profile_sql, profiler,
)

AUDIT = """
SELECT 'AUD_' || CAST(event_id AS STRING) AS audit_id,
       'ING_' || CAST(user_id AS STRING) AS ingest_id,
       event_type || '|' || CASE WHEN value > 50 THEN 'partial' ELSE 'success' END AS action,
       props AS details, CASE WHEN user_id < 40 THEN 'svc_Loader' ELSE 'analyst' END
       AS executed_by, ts AS executed_at_utc
FROM {events}
"""
BATCHES = """
SELECT 'ING_' || CAST(o_orderkey AS STRING) AS ingest_id,
       'SRC_' || CAST(o_custkey AS STRING) AS source_id,
       CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'O' THEN 'error'
            ELSE 'partial' END AS status, CAST(NULL AS STRING) AS error_message,
       CAST(EXTRACT(DAY FROM o_orderdate) AS INT) AS file_count,
       CAST(EXTRACT(MONTH FROM o_orderdate) AS INT) AS files_success, 1 AS files_error,
       o_orderdate AS batch_started_at_utc, o_orderdate AS batch_completed_at_utc,
       o_orderdate AS ingest_timestamp
FROM {orders}
"""
FILES = """
SELECT 'F_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_'
       || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS ingest_file_id,
       'ING_' || CAST(l_orderkey AS STRING) AS ingest_id,
       'part_' || CAST(l_partkey AS STRING) || '.csv' AS file_name,
       '/in/part_' || CAST(l_partkey AS STRING) || '.csv' AS file_path,
       CASE WHEN l_returnflag = 'A' THEN 'labs' WHEN l_returnflag = 'N' THEN 'vitals' END
       AS lake_table_name, CAST(l_suppkey AS BIGINT) AS file_size_bytes,
       CAST(l_quantity AS BIGINT) AS row_count,
       CASE WHEN l_linestatus = 'F' THEN 'success' ELSE 'error' END AS load_status,
       l_shipdate AS logged_at_utc, l_shipdate AS completed_at_utc
FROM {lineitem}
"""
ISSUES = """
SELECT 'ING_' || CAST(l_suppkey AS STRING) AS ingest_id,
       'table_' || CAST(l_linenumber AS STRING) AS lake_table_name,
       'v_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_partkey AS STRING) || '_'
       || CAST(l_suppkey AS STRING) AS lake_variable_name,
       CASE WHEN l_returnflag = 'A' THEN 'SCHEMA_MISSING_COLUMN' ELSE 'TYPE_TARGET_MISSING' END
       AS issue_code,
       CASE WHEN l_returnflag = 'A' THEN 'Missing required column' ELSE 'No target type' END
       AS issue_type,
       CASE WHEN l_returnflag = 'A' THEN 'critical' WHEN l_returnflag = 'N' THEN 'info'
            ELSE 'warning' END AS severity,
       l_linestatus = 'F' AS is_blocking, 'message' AS issue_message, 'text' AS expected_value,
       'int4' AS observed_value
FROM {lineitem}
"""
REGISTRY = """
SELECT c_name AS source_id, c_name AS source_name, CASE WHEN c_mktsegment = 'MACHINERY'
       THEN 'CSV' ELSE 'SQL' END AS system_type, 'monthly' AS update_frequency,
       c_acctbal > 2000 AS active, c_nationkey AS created_at_utc
FROM {customer}
"""
STEPS = """
SELECT 'STEP_' || CAST(p_partkey AS STRING) AS step_id, CAST(p_size AS INT) AS step_order,
       p_name AS step_name, CASE WHEN p_type = 'PROMO' THEN 'SQL' ELSE 'R' END AS step_type,
       p_retailprice > 930 AS enabled
FROM {part}
"""
TRANSFORMS = """
SELECT CASE WHEN l_returnflag = 'A' THEN 'labs' WHEN l_returnflag = 'N' THEN 'vitals'
       ELSE 'injuries' END AS target_table, 'src_' || CAST(l_suppkey AS STRING) AS source_table,
       CAST(l_quantity AS BIGINT) AS target_row_count
FROM {lineitem}
"""
VALIDATED = """
SELECT CASE WHEN l_returnflag = 'A' THEN 'REG_A' WHEN l_returnflag = 'N' THEN 'REG_B'
       ELSE 'REG_C' END AS source_type,
       'ING_' || CAST(l_orderkey AS STRING) AS ingest_id
FROM {lineitem}
"""
RAW_TABLES = """
SELECT DISTINCT 'raw' AS table_schema, upper(p_brand) || '_' || p_type AS table_name FROM {part}
"""
LAKE_NAMES = """
SELECT lower(p_brand) || '_' || lower(p_type) AS lake_table_name, p_name AS source_type,
       p_partkey FROM {part} WHERE p_type <> 'PROMO'
"""

_RANK = "CASE severity WHEN 'critical' THEN 1 WHEN 'warning' THEN 2 WHEN 'info' THEN 3 END"
_ISSUES_SELECT = "SELECT * FROM " + plain(ISSUES)


def _on(text: str, operator, *args, **options):
    return lambda s, d: operator(derive(s, d, text), *args, **options)


def _raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.list_raw_tables(derive(spark, sf_dir, RAW_TABLES), derive(spark, sf_dir, LAKE_NAMES))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.latest_batch_files(derive(spark, sf_dir, BATCHES), derive(spark, sf_dir, FILES))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.operators.dictionary import dictionary_changes

    changes = dictionary_changes(derive(spark, sf_dir, NEW), derive(spark, sf_dir, OLD))
    return rv.version_history(changes.withColumn("version_number", F.lit(4)))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.table_counts({t: load(spark, sf_dir, t) for t in _COUNTED})


_COUNTED = ("customer", "orders", "lineitem", "part", "documents", "events", "embeddings")

QUERIES = {
    "explore_audit_log": (
        _on(AUDIT, rv.explore_audit_log, ingest_id="ing_3", action="CLICK",
            executed_by="loader", n=40),
        f"SELECT * FROM {plain(AUDIT)} WHERE ingest_id ILIKE '%ing_3%' AND action ILIKE "
        f"'%CLICK%' AND executed_by ILIKE '%loader%' ORDER BY executed_at_utc DESC, audit_id "
        f"LIMIT 40"),
    "explore_batch_log": (
        _on(BATCHES, rv.explore_batch_log, source_id="src_1", status="partial", n=50),
        f"SELECT * FROM {plain(BATCHES)} WHERE source_id ILIKE '%src_1%' AND status = 'partial' "
        f"ORDER BY ingest_timestamp DESC, ingest_id LIMIT 50"),
    "explore_ingest_dictionary": (
        _on(NEW, rv.explore_ingest_dictionary, source_table="BOLT", lake_table="brand#1"),
        f"SELECT * FROM {plain(NEW)} WHERE source_table_name ILIKE '%BOLT%' AND lake_table_name "
        f"ILIKE '%brand#1%' ORDER BY source_type, lake_table_name, lake_variable_name, "
        f"source_variable_name LIMIT 200"),
    "explore_ingest_file_log": (
        _on(FILES, rv.explore_ingest_file_log, file_name="PART_1", lake_table="lab",
            load_status="error"),
        f"SELECT * FROM {plain(FILES)} WHERE file_name ILIKE '%PART_1%' AND lake_table_name "
        f"ILIKE '%lab%' AND load_status = 'error' ORDER BY logged_at_utc DESC, ingest_file_id "
        f"LIMIT 50"),
    "explore_metadata": (
        _on(METADATA, rv.explore_metadata, lake_table="BRAND#2", version_number=3,
            required_only=True),
        f"SELECT * FROM {plain(METADATA)} WHERE is_active AND lake_table_name ILIKE '%brand#2%' "
        f"AND version_number = 3 AND is_required ORDER BY lake_table_name, lake_variable_name, "
        f"source_type LIMIT 200"),
    "explore_steps": (
        _on(STEPS, rv.explore_steps, step_type="SQL", enabled_only=True),
        f"SELECT * FROM {plain(STEPS)} WHERE step_type = 'SQL' AND enabled"),
    "explore_source_registry": (
        _on(REGISTRY, rv.explore_source_registry, system_type="csv", active_only=True),
        f"SELECT * FROM {plain(REGISTRY)} WHERE system_type ILIKE '%csv%' AND active "
        f"ORDER BY created_at_utc DESC, source_id LIMIT 50"),
    "explore_structure_qc": (
        _on(ISSUES, rv.explore_structure_qc, ingest_id="ing_1", issue_type="TYPE",
            blocking_only=True),
        f"{_ISSUES_SELECT} WHERE ingest_id ILIKE '%ing_1%' AND issue_type ILIKE '%TYPE%' AND "
        f"is_blocking ORDER BY {_RANK}, lake_table_name, lake_variable_name, issue_code "
        f"LIMIT 100"),
    "list_ingests": (
        _on(BATCHES, rv.list_ingests, n=25, status="error"),
        f"SELECT ingest_id, source_id, status, files_success FROM {plain(BATCHES)} WHERE status "
        f"= 'error' ORDER BY ingest_timestamp DESC, ingest_id LIMIT 25"),
    "list_raw_tables": (
        _raw_tables,
        f"SELECT lower(table_name) AS lake_table_name, table_schema, table_name, "
        f"'raw.' || table_name AS full_name, source_type, source_type IS NOT NULL AS "
        f"source_match FROM {plain(RAW_TABLES)} t LEFT JOIN (SELECT DISTINCT "
        f"lower(lake_table_name) AS l, source_type FROM {plain(LAKE_NAMES)}) "
        f"ON l = lower(table_name)"),
    "source_review": (
        _on(REGISTRY, rv.source_review),
        f"SELECT count(*) AS sources, count(*) FILTER (active) AS active_sources, "
        f"count(*) FILTER (NOT active) AS inactive_sources FROM {plain(REGISTRY)}"),
    "latest_batch_files": (
        _latest,
        f"SELECT ingest_id, file_name, lake_table_name, row_count, load_status FROM "
        f"{plain(FILES)} WHERE ingest_id = (SELECT ingest_id FROM {plain(BATCHES)} "
        f"ORDER BY batch_started_at_utc DESC, ingest_id DESC LIMIT 1)"),
    "ingested_rows": (
        _on(FILES, rv.ingested_rows),
        f"SELECT ingest_id, count(*) AS files, CAST(sum(row_count) AS BIGINT) AS total_rows, "
        f"count(*) FILTER (load_status = 'error') AS failed_files FROM {plain(FILES)} "
        f"GROUP BY ALL"),
    "issues_by_table": (
        _on(ISSUES, rv.issues_by_table),
        f"SELECT lake_table_name, severity, count(*) AS issue_count FROM {plain(ISSUES)} "
        f"GROUP BY ALL"),
    "issues_by_severity": (
        _on(ISSUES, rv.issues_by_severity),
        f"SELECT severity, count(*) AS total_issues, count(DISTINCT lake_table_name) "
        f"AS tables_affected FROM {plain(ISSUES)} GROUP BY ALL"),
    "issues_by_type": (
        _on(ISSUES, rv.issues_by_type),
        f"SELECT issue_type, severity, count(*) AS occurrences FROM {plain(ISSUES)} "
        f"GROUP BY ALL"),
    "issue_detail": (
        _on(ISSUES, rv.issue_detail, "table_3"),
        f"SELECT lake_variable_name, issue_type, severity, is_blocking, issue_message, "
        f"expected_value, observed_value FROM {plain(ISSUES)} "
        f"WHERE lake_table_name = 'table_3'"),
    "metadata_overview": (
        _on(METADATA, rv.metadata_overview),
        f"SELECT count(*) AS total_active_vars, count(DISTINCT lake_table_name) AS tables, "
        f"count(DISTINCT source_type) AS source_types, max(version_number) AS latest_version "
        f"FROM {plain(METADATA)} WHERE is_active"),
    "metadata_by_source": (
        _on(METADATA, rv.metadata_by_source),
        f"SELECT source_type, count(*) AS variables, count(DISTINCT lake_table_name) AS tables "
        f"FROM {plain(METADATA)} WHERE is_active GROUP BY ALL"),
    "metadata_by_table": (
        _on(METADATA, rv.metadata_by_table),
        f"SELECT lake_table_name, source_type, count(*) AS variables, count(*) FILTER "
        f"(is_identifier) AS identifiers, count(*) FILTER (is_phi) AS phi_fields, count(*) "
        f"FILTER (is_required) AS required_fields FROM {plain(METADATA)} WHERE is_active "
        f"GROUP BY ALL"),
    "version_history": (
        _history,
        f"SELECT 4 AS version_number, change_type, count(*) AS changes FROM ({_CHANGES}) "
        f"GROUP BY ALL"),
    "removed_variables": (
        _on(METADATA, rv.removed_variables),
        f"SELECT lake_table_name, lake_variable_name, source_type, version_number, updated_at "
        f"FROM {plain(METADATA)} WHERE NOT is_active ORDER BY updated_at DESC, lake_table_name, "
        f"lake_variable_name, source_type LIMIT 20"),
    "profile_scores": (
        lambda s, d: rv.profile_scores(profiler(s, d, SMALL).summary()),
        profile_sql(SMALL, _SUMMARY + """SELECT table_name, row_count, variable_count,
          quality_score, critical_issue_count AS critical, warning_issue_count AS warnings,
          info_issue_count AS info, round_even(avg_valid_pct, 1) AS avg_valid_pct,
          worst_variable, round_even(worst_variable_missing_pct, 1) AS worst_miss_pct
          FROM summary""")),
    "serious_issues": (
        lambda s, d: rv.serious_issues(profiler(s, d, SMALL).issues()),
        profile_sql(SMALL, "SELECT * REPLACE (round_even(value, 1) AS value) FROM issues "
                           "WHERE severity IN ('critical', 'warning')")),
    "worst_variables": (
        lambda s, d: rv.worst_variables(profiler(s, d, ALL).profile()),
        profile_sql(ALL, """SELECT table_name, variable_name, inferred_type,
          round_even(total_missing_pct, 1) AS missing_pct, round_even(na_pct, 1) AS na_pct,
          round_even(empty_pct, 1) AS empty_pct, round_even(whitespace_pct, 1) AS ws_pct,
          round_even(sentinel_pct, 1) AS sentinel_pct, round_even(valid_pct, 1) AS valid_pct
          FROM profile ORDER BY total_missing_pct DESC, table_name, variable_name LIMIT 20""")),
    "sentinel_review": (
        lambda s, d: rv.sentinel_review(profiler(s, d, SMALL).sentinels()),
        profile_sql(SMALL, "SELECT * REPLACE (round_even(sentinel_pct, 1) AS sentinel_pct) "
                           f"FROM ({_SENTINELS})")),
    "table_detail": (
        lambda s, d: rv.table_detail(profiler(s, d, SMALL).profile(), "raw_orders"),
        profile_sql(SMALL, f"""SELECT variable_name, inferred_type, total_count, valid_count,
          round_even(valid_pct, 1) AS valid_pct, round_even(total_missing_pct, 1) AS missing_pct,
          round_even(na_pct, 1) AS na_pct, round_even(empty_pct, 1) AS empty_pct,
          round_even(sentinel_pct, 1) AS sentinel_pct, unique_count FROM ({_PROFILE})
          WHERE table_name = 'raw_orders'""")),
    "audit_by_action": (
        _on(AUDIT, rv.audit_by_action),
        f"SELECT action, count(*) AS events FROM {plain(AUDIT)} GROUP BY ALL"),
    "audit_by_ingest": (
        _on(AUDIT, rv.audit_by_ingest),
        f"SELECT ingest_id, count(*) AS events, min(executed_at_utc) AS first_event, "
        f"max(executed_at_utc) AS last_event FROM {plain(AUDIT)} GROUP BY ALL "
        f"ORDER BY last_event DESC, ingest_id LIMIT 20"),
    "table_counts": (
        _counts,
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}"
                           for t in _COUNTED)),
    "source_breakdown": (
        _on(VALIDATED, rv.source_breakdown),
        f"SELECT source_type, count(DISTINCT ingest_id) AS ingests, count(*) AS total_rows "
        f"FROM {plain(VALIDATED)} GROUP BY ALL"),
    "transform_totals": (
        _on(TRANSFORMS, rv.transform_totals),
        f"SELECT target_table, CAST(sum(target_row_count) AS BIGINT) AS total_rows, "
        f"count(DISTINCT source_table) AS source_tables FROM {plain(TRANSFORMS)} GROUP BY ALL"),
}
