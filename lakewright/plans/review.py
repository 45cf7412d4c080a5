"""Review queries over the governance tables: filters, rankings and group counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.text import all_of
from lakewright.sources.lake import Lake


def contains(column: str, text: str | None) -> list[Column]:
    """Case-insensitive substring test, none when no text is given."""
    return [] if text is None else [F.col(column).ilike(f"%{text}%")]


def equals(column: str, value) -> list[Column]:
    return [] if value is None else [F.col(column) == F.lit(value)]


def flagged(column: str, wanted: bool) -> list[Column]:
    return [F.col(column)] if wanted else []


def severity_rank(column: str = "severity") -> Column:
    c = F.col(column)
    return (
        F.when(c == "critical", 1).when(c == "warning", 2).when(c == "info", 3).otherwise(4)
    )


def explore(df: DataFrame, conditions: list[Column], order: list, n: int | None) -> DataFrame:
    """Rows meeting all conditions, in order, the first ``n``."""
    out = df.where(all_of(conditions)).orderBy(*order)
    return out if n is None else out.limit(n)


def _newest(column: str, *ties: str) -> list:
    return [F.desc_nulls_first(column), *ties]


def explore_audit_log(log: DataFrame, ingest_id=None, action=None, executed_by=None, n=20):
    where = contains("ingest_id", ingest_id) + contains("action", action) \
        + contains("executed_by", executed_by)
    return explore(log, where, _newest("executed_at_utc", "audit_id"), n)


def explore_batch_log(log: DataFrame, ingest_id=None, source_id=None, status=None, n=20):
    where = contains("ingest_id", ingest_id) + contains("source_id", source_id) \
        + equals("status", status)
    return explore(log, where, _newest("ingest_timestamp", "ingest_id"), n)


def explore_ingest_dictionary(
    dictionary: DataFrame, source_type=None, source_table=None, source_variable=None,
    lake_table=None, lake_variable=None, n=200,
):
    where = contains("source_type", source_type) + contains("source_table_name", source_table) \
        + contains("source_variable_name", source_variable) \
        + contains("lake_table_name", lake_table) + contains("lake_variable_name", lake_variable)
    order = ["source_type", "lake_table_name", "lake_variable_name", "source_variable_name"]
    return explore(dictionary, where, order, n)


def explore_ingest_file_log(
    log: DataFrame, ingest_id=None, file_name=None, lake_table=None, load_status=None, n=50
):
    where = contains("ingest_id", ingest_id) + contains("file_name", file_name) \
        + contains("lake_table_name", lake_table) + equals("load_status", load_status)
    return explore(log, where, _newest("logged_at_utc", "ingest_file_id"), n)


def explore_metadata(
    metadata: DataFrame, lake_table=None, lake_variable=None, source_type=None,
    version_number=None, required_only=False, active_only=True, n=200,
):
    where = flagged("is_active", active_only) + contains("lake_table_name", lake_table) \
        + contains("lake_variable_name", lake_variable) + contains("source_type", source_type) \
        + equals("version_number", version_number) + flagged("is_required", required_only)
    return explore(metadata, where, ["lake_table_name", "lake_variable_name", "source_type"], n)


def explore_steps(steps: DataFrame, step_type=None, enabled_only=False):
    where = equals("step_type", step_type) + flagged("enabled", enabled_only)
    return explore(steps, where, ["step_order", "step_id"], None)


def explore_source_registry(
    registry: DataFrame, source_id=None, system_type=None, active_only=False, n=50
):
    where = contains("source_id", source_id) + contains("system_type", system_type) \
        + flagged("active", active_only)
    return explore(registry, where, _newest("created_at_utc", "source_id"), n)


def explore_structure_qc(
    issues: DataFrame, ingest_id=None, severity=None, issue_type=None, lake_table=None,
    blocking_only=False, n=100,
):
    where = contains("ingest_id", ingest_id) + equals("severity", severity) \
        + contains("issue_type", issue_type) + contains("lake_table_name", lake_table) \
        + flagged("is_blocking", blocking_only)
    order = [severity_rank(), "lake_table_name", "lake_variable_name", "issue_code"]
    return explore(issues, where, order, n)


def list_ingests(log: DataFrame, n=10, source_id=None, status=None):
    where = contains("source_id", source_id) + equals("status", status)
    rows = explore(log, where, _newest("ingest_timestamp", "ingest_id"), n)
    return rows.select("ingest_id", "source_id", "status", "files_success")


def list_raw_tables(tables: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Raw tables (``table_schema, table_name``) with the sources the dictionary gives them."""
    sources = dictionary.select(
        F.lower("lake_table_name").alias("lake_table_name"), "source_type"
    ).distinct()
    named = tables.withColumns({
        "lake_table_name": F.lower("table_name"),
        "full_name": F.concat_ws(".", "table_schema", "table_name"),
    })
    return named.join(sources, "lake_table_name", "left").withColumn(
        "source_match", F.col("source_type").isNotNull()
    )


def raw_table_listing(lake: Lake) -> DataFrame:
    rows = [("raw", t) for t in lake.tables("raw")]
    tables = lake.spark.createDataFrame(rows, "table_schema string, table_name string")
    return list_raw_tables(tables, lake.read("reference", "ingest_dictionary"))


def source_review(registry: DataFrame) -> DataFrame:
    """Active and inactive sources."""
    return registry.agg(
        F.count(F.lit(1)).alias("sources"),
        F.count_if("active").alias("active_sources"),
        F.count_if(~F.col("active")).alias("inactive_sources"),
    )


def latest_batch_files(batches: DataFrame, files: DataFrame) -> DataFrame:
    """Files of the batch that started last. The batch is found by one aggregation, so no
    sort of the log is needed."""
    latest = batches.agg(
        F.max(F.struct("batch_started_at_utc", "ingest_id")).alias("b")
    ).select("b.ingest_id")
    return files.join(F.broadcast(latest), "ingest_id", "left_semi").select(
        "ingest_id", "file_name", "lake_table_name", "row_count", "load_status"
    )


def ingested_rows(files: DataFrame) -> DataFrame:
    """Files and rows loaded per batch."""
    return files.groupBy("ingest_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("total_rows"),
        F.count_if(F.col("load_status") == "error").alias("failed_files"),
    )


def issues_by_table(issues: DataFrame) -> DataFrame:
    return issues.groupBy("lake_table_name", "severity").agg(
        F.count(F.lit(1)).alias("issue_count")
    )


def issues_by_severity(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity").agg(
        F.count(F.lit(1)).alias("total_issues"),
        F.count_distinct("lake_table_name").alias("tables_affected"),
    )


def issues_by_type(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue_type", "severity").agg(F.count(F.lit(1)).alias("occurrences"))


def issue_detail(issues: DataFrame, lake_table: str) -> DataFrame:
    return issues.where(F.col("lake_table_name") == lake_table).select(
        "lake_variable_name", "issue_type", "severity", "is_blocking", "issue_message",
        "expected_value", "observed_value",
    ).orderBy("severity", "lake_variable_name")


def metadata_overview(metadata: DataFrame) -> DataFrame:
    return metadata.where("is_active").agg(
        F.count(F.lit(1)).alias("total_active_vars"),
        F.count_distinct("lake_table_name").alias("tables"),
        F.count_distinct("source_type").alias("source_types"),
        F.max("version_number").alias("latest_version"),
    )


def metadata_by_source(metadata: DataFrame) -> DataFrame:
    return metadata.where("is_active").groupBy("source_type").agg(
        F.count(F.lit(1)).alias("variables"),
        F.count_distinct("lake_table_name").alias("tables"),
    )


def metadata_by_table(metadata: DataFrame, source_type: str | None = None) -> DataFrame:
    rows = metadata.where(all_of([F.col("is_active"), *equals("source_type", source_type)]))
    return rows.groupBy("lake_table_name", "source_type").agg(
        F.count(F.lit(1)).alias("variables"),
        F.count_if("is_identifier").alias("identifiers"),
        F.count_if("is_phi").alias("phi_fields"),
        F.count_if("is_required").alias("required_fields"),
    )


def version_history(history: DataFrame, n: int | None = 30) -> DataFrame:
    rows = history.groupBy("version_number", "change_type").agg(
        F.count(F.lit(1)).alias("changes")
    ).orderBy(F.desc("version_number"), "change_type")
    return rows if n is None else rows.limit(n)


def removed_variables(metadata: DataFrame, n: int = 20) -> DataFrame:
    order = [F.desc("updated_at"), "lake_table_name", "lake_variable_name", "source_type"]
    return metadata.where(~F.col("is_active")).orderBy(*order).limit(n).select(
        "lake_table_name", "lake_variable_name", "source_type", "version_number", "updated_at"
    )


def _one_digit(df: DataFrame, columns: dict[str, str]) -> list[Column]:
    return [F.bround(F.col(c), 1).alias(alias) for c, alias in columns.items()]


def profile_scores(summary: DataFrame) -> DataFrame:
    return summary.select(
        "table_name", "row_count", "variable_count", "quality_score",
        F.col("critical_issue_count").alias("critical"),
        F.col("warning_issue_count").alias("warnings"),
        F.col("info_issue_count").alias("info"),
        F.bround("avg_valid_pct", 1).alias("avg_valid_pct"),
        "worst_variable",
        F.bround("worst_variable_missing_pct", 1).alias("worst_miss_pct"),
    ).orderBy("quality_score", "table_name")


def serious_issues(issues: DataFrame) -> DataFrame:
    return issues.where(F.col("severity").isin("critical", "warning")).select(
        "table_name", "variable_name", "issue_type", "severity", "description",
        F.bround("value", 1).alias("value"), "recommendation",
    ).orderBy(severity_rank(), "table_name", "variable_name")


def worst_variables(profile: DataFrame, n: int = 20) -> DataFrame:
    order = [F.desc("total_missing_pct"), "table_name", "variable_name"]
    return profile.orderBy(*order).limit(n).select(
        "table_name", "variable_name", "inferred_type",
        *_one_digit(profile, {
            "total_missing_pct": "missing_pct", "na_pct": "na_pct", "empty_pct": "empty_pct",
            "whitespace_pct": "ws_pct", "sentinel_pct": "sentinel_pct", "valid_pct": "valid_pct",
        }),
    )


def sentinel_review(sentinels: DataFrame) -> DataFrame:
    return sentinels.select(
        "table_name", "variable_name", "sentinel_value", "sentinel_count",
        F.bround("sentinel_pct", 1).alias("sentinel_pct"), "detection_method", "confidence",
    ).orderBy(F.desc("sentinel_count"), "table_name", "variable_name", "sentinel_value")


def table_detail(profile: DataFrame, table: str) -> DataFrame:
    rows = profile.where(F.col("table_name") == table)
    return rows.orderBy(F.desc("total_missing_pct"), "variable_name").select(
        "variable_name", "inferred_type", "total_count", "valid_count",
        *_one_digit(rows, {
            "valid_pct": "valid_pct", "total_missing_pct": "missing_pct", "na_pct": "na_pct",
            "empty_pct": "empty_pct", "sentinel_pct": "sentinel_pct",
        }),
        "unique_count",
    )


def audit_by_action(log: DataFrame) -> DataFrame:
    return log.groupBy("action").agg(F.count(F.lit(1)).alias("events"))


def audit_by_ingest(log: DataFrame, ingest_id: str | None = None, n: int = 20) -> DataFrame:
    return log.where(all_of(contains("ingest_id", ingest_id))).groupBy("ingest_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("executed_at_utc").alias("first_event"),
        F.max("executed_at_utc").alias("last_event"),
    ).orderBy(F.desc("last_event"), "ingest_id").limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of many tables, one partial count per table and no shuffle of rows."""
    from functools import reduce

    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def source_breakdown(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_type").agg(
        F.count_distinct("ingest_id").alias("ingests"), F.count(F.lit(1)).alias("total_rows")
    )


def transform_totals(log: DataFrame) -> DataFrame:
    """Rows moved into each domain table and the sources they came from."""
    return log.groupBy("target_table").agg(
        F.sum("target_row_count").alias("total_rows"),
        F.count_distinct("source_table").alias("source_tables"),
    )


def validated_counts(lake: Lake) -> DataFrame:
    from lakewright.operators.harmonization import DOMAIN_TABLES

    spark: SparkSession = lake.spark
    present = {t: lake.read("validated", t) for t in DOMAIN_TABLES if lake.exists("validated", t)}
    absent = [(t, 0) for t in DOMAIN_TABLES if t not in present]
    empty = spark.createDataFrame(absent, "table_name string, rows bigint")
    counts = table_counts(present).unionByName(empty) if present else empty
    return counts.orderBy(F.desc("rows"), "table_name")
