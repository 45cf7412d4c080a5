"""Expected against observed table schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.datatypes import declared_name, normalized_type, type_descriptor
from lakewright.operators.ingestion import LINEAGE
from lakewright.sources.lake import Lake

KEY = ["lake_table_name", "lake_variable_name"]
ISSUE_COLUMNS = [
    *KEY, "issue_code", "issue_type", "issue_group", "severity", "is_blocking",
    "expected_value", "observed_value", "check_context", "schema_version",
]
OBSERVED_SCHEMA = (
    "lake_table_name string, lake_variable_name string, data_type string, udt_name string, "
    "ordinal_position int, is_nullable boolean"
)


def observed_schema(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column names and types of tables, from their schemas alone."""
    rows = []
    for table, df in tables.items():
        fields = [f for f in df.schema.fields if f.name not in LINEAGE]
        for i, f in enumerate(fields, start=1):
            rows.append((table, f.name, *declared_name(f.dataType), i, f.nullable))
    return spark.createDataFrame(rows, OBSERVED_SCHEMA)


def schema_issues(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Issues of all tables at once. ``expected`` has ``lake_table_name,
    lake_variable_name, data_type, is_required, target_type`` and may have
    ``version_number``; ``observed`` has the names with ``data_type, udt_name``.

    One full outer join finds missing and unexpected columns and compares the types of
    shared ones.
    """
    version = F.col("version_number") if "version_number" in expected.columns else F.lit(None)
    wanted = expected.select(
        *KEY, F.col("data_type").alias("expected_type"),
        F.coalesce("is_required", F.lit(False)).alias("is_required"), "target_type",
        version.cast("string").alias("own_version"), F.lit(True).alias("is_expected"),
    )
    versions = wanted.groupBy("lake_table_name").agg(
        F.when(F.count_distinct("own_version") == 1, F.max("own_version")).alias("schema_version")
    )
    seen = observed.select(
        *KEY, F.col("data_type").alias("observed_type"), "udt_name",
        F.lit(True).alias("is_observed"),
    )
    both = wanted.join(seen, KEY, "full_outer").join(versions, "lake_table_name", "left")
    name = F.col("lake_variable_name")
    shared = F.col("is_expected") & F.col("is_observed")
    reduced = normalized_type(F.col("observed_type"), F.col("udt_name"))
    target = F.coalesce("target_type", F.lit(""))
    shown = F.concat("observed_type", F.lit(" ("), "udt_name", F.lit(")"))

    # Issue codes and wording.
    def issue(cond, code, kind, group, severity, blocking, expected_value, observed_value):
        return F.when(cond, F.struct(
            F.lit(code).alias("issue_code"), F.lit(kind).alias("issue_type"),
            F.lit(group).alias("issue_group"), F.lit(severity).alias("severity"),
            F.lit(blocking).alias("is_blocking"),
            expected_value.alias("expected_value"), observed_value.alias("observed_value"),
        ))

    found = F.array_compact(F.array(
        issue(
            F.col("is_required") & F.col("is_observed").isNull(),
            "SCHEMA_MISSING_COLUMN", "Missing required column", "structural", "critical", True,
            F.concat(F.lit("Required column '"), name, F.lit("' must exist with type "),
                     "expected_type"),
            F.lit("Column not present in observed schema"),
        ),
        issue(
            F.col("is_observed") & F.col("is_expected").isNull(),
            "SCHEMA_UNEXPECTED_COLUMN", "Unexpected column not in expected schema",
            "structural", "critical", True,
            F.lit("No column with this name is defined in expected schema"),
            F.concat(F.lit("Observed unexpected column '"), name, F.lit("' with type "), shown),
        ),
        issue(
            shared & (F.col("expected_type") != F.col("observed_type")),
            "SCHEMA_TYPE_MISMATCH", "Data type mismatch between expected and observed",
            "dtype", "warning", False, F.col("expected_type"), shown,
        ),
        issue(
            shared & (target == ""),
            "TYPE_TARGET_MISSING", "No target type defined in type_decision_table",
            "dtype", "warning", False,
            F.lit("target_type should be defined in type_decision_table.xlsx"),
            F.concat(F.lit("observed type: "), shown),
        ),
        issue(
            shared & (target != "") & (reduced != F.lower(target)),
            "TYPE_TARGET_MISMATCH", "Observed type does not match target type for staging",
            "dtype", "warning", False,
            F.concat(F.lit("target_type = "), "target_type"),
            F.concat(F.lit("observed: "), shown, F.lit(" -> normalized: "), reduced),
        ),
    ))
    return both.withColumn("issue", F.explode(found)).select(
        *KEY, "issue.*", F.lit("variable_level").alias("check_context"), "schema_version"
    ).select(*ISSUE_COLUMNS)


def validate_schema(
    lake: Lake, ingest_id: str, source_id: str | None = None, source_type: str | None = None,
    halt_on_error: bool = True,
) -> dict:
    """Check the raw tables of a batch against the active dictionary and log the issues. With
    critical issues the run stops after the issues are written, unless told to go on. Tables
    that the dictionary does not name are not checked; they are listed as ``tables_skipped``."""
    spark = lake.spark
    if not ingest_id or not ingest_id.strip():
        raise ValueError("ingest_id must be a non-empty string")
    batch = lake.read("governance", "batch_log").where(F.col("ingest_id") == ingest_id).first()
    if batch is None:
        raise ValueError(f"ingest_id '{ingest_id}' not found in governance.batch_log")
    active = lake.read("reference", "metadata").where("is_active")
    if active.isEmpty():
        raise ValueError("no active metadata: run the dictionary sync first")
    loaded = lake.read("governance", "ingest_file_log").where(
        (F.col("ingest_id") == ingest_id) & (F.col("load_status") == "success")
    )
    if source_type is None:
        source_type = source_type_of_files(active, loaded)
        if source_type is None:
            raise ValueError(f"could not derive source_type for ingest '{ingest_id}'")
    expected = active.where(F.upper("source_type") == source_type.upper())
    if expected.isEmpty():
        raise ValueError(f"no active metadata for source_type '{source_type}'")
    names = [r[0] for r in loaded.select("lake_table_name").distinct().collect() if r[0]]
    known = {r[0] for r in expected.select("lake_table_name").distinct().collect()}
    checked = {
        n: lake.read("raw", n) for n in names if n in known and lake.exists("raw", n)
    }
    counts = {"critical": 0, "warning": 0, "info": 0}
    issues = None
    if checked:
        observed = observed_schema(spark, checked)
        wanted = expected.where(F.col("lake_table_name").isin(list(checked)))
        issues = schema_issues(wanted, observed)
        log = issues.select(
            F.expr("uuid()").alias("qc_issue_id"),
            F.lit(source_id or batch["source_id"]).alias("source_id"),
            F.lit(source_type).alias("source_type"),
            *ISSUE_COLUMNS,
            F.concat_ws(": ", "issue_type", "lake_variable_name").alias("issue_message"),
            F.current_timestamp().alias("check_run_at"),
            F.current_timestamp().alias("created_at"),
            F.lit("validate_schema").alias("created_by"),
            F.lit(None).cast("string").alias("notes"),
            F.lit(ingest_id).alias("ingest_id"),
        )
        lake.append("governance", "structure_qc_table", log, ("ingest_id",))
        counts.update({
            r["severity"]: r["count"] for r in issues.groupBy("severity").count().collect()
        })
    if counts["critical"] and halt_on_error:
        raise RuntimeError(
            f"{counts['critical']} critical schema issues for ingest '{ingest_id}'; "
            "see governance.structure_qc_table"
        )
    return {
        "success": counts["critical"] == 0, "issues_count": sum(counts.values()),
        "critical_count": counts["critical"], "warning_count": counts["warning"],
        "info_count": counts["info"], "tables_validated": len(checked),
        "tables_skipped": sorted(set(names) - set(checked)), "issues": issues,
    }


def source_type_of_files(metadata: DataFrame, files: DataFrame) -> str | None:
    """Source type whose dictionary names the lake tables of the files; of several the first."""
    row = (
        metadata.join(files.select("lake_table_name").distinct(), "lake_table_name", "left_semi")
        .agg(F.min("source_type").alias("source_type")).first()
    )
    return row["source_type"]


def hashed(columns: list[str]) -> Column:
    """SHA-256 of the texts of columns; NULL counts as empty text."""
    return F.sha2(
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256
    )


def combined_hash(hashes: Column) -> Column:
    """One hash of a set of SHA-256 texts in any order: their parts are summed, so that no
    group of hashes has to be gathered in one place."""
    parts = [
        F.sum(F.conv(F.substring(hashes, at, 15), 16, 10).cast("decimal(38,0)")).cast("string")
        for at in (1, 16, 31, 46)
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


EXPECTED_COLUMNS = [
    "schema_version", "table_schema", "lake_table_name", "lake_variable_name", "data_type",
    "udt_name", "length", "precision", "scale", "default_value", "is_nullable", "is_required",
    "is_primary_key", "ordinal_position", "source_type", "source_table_name",
    "source_variable_name", "type_descriptor", "target_type",
]


def expected_schema(
    dictionary: DataFrame, structure: DataFrame, primary_keys: DataFrame,
    decisions: DataFrame, schema_version: str,
) -> DataFrame:
    """Dictionary rows with the structure, key, type and hashes of their columns.

    ``structure`` has ``table_schema, table_name, column_name, data_type, udt_name, length,
    precision, scale, default_value, is_nullable, ordinal_position``; ``primary_keys`` has
    ``table_schema, table_name, column_name``; ``decisions`` has ``table_name, variable,
    final_type``. Of repeated dictionary keys the first by source counts.
    """
    low = [F.lower(c).alias(c) for c in (
        "lake_table_name", "lake_variable_name", "source_type", "source_table_name",
        "source_variable_name",
    )]
    entries = (
        dictionary.select(*low)
        .where(F.col("lake_table_name").isNotNull() & F.col("lake_variable_name").isNotNull())
        .groupBy(*KEY)
        .agg(F.min(F.struct("source_type", "source_table_name", "source_variable_name"))
             .alias("source"))
        .select(*KEY, "source.*")
    )
    columns = structure.select(
        "table_schema", F.lower("table_name").alias("lake_table_name"),
        F.lower("column_name").alias("lake_variable_name"),
        *[c for c in structure.columns if c not in ("table_schema", "table_name", "column_name")],
    )
    keys = primary_keys.select(
        "table_schema", F.lower("table_name").alias("lake_table_name"),
        F.lower("column_name").alias("lake_variable_name"), F.lit(True).alias("is_primary_key"),
    ).distinct()
    types = decisions.select(
        F.lower("table_name").alias("lake_table_name"),
        F.lower("variable").alias("lake_variable_name"),
        F.lower("final_type").alias("target_type"),
    ).groupBy(*KEY).agg(F.min("target_type").alias("target_type"))
    joined = (
        entries.join(
            columns.join(keys, ["table_schema", *KEY], "left").withColumn(
                "is_primary_key", F.coalesce("is_primary_key", F.lit(False))
            ),
            KEY, "left",
        )
        .join(types, KEY, "left")
    )
    nullable = F.coalesce(F.col("is_nullable"), F.lit(True))
    described = joined.withColumns({
        "schema_version": F.lit(schema_version),
        "is_nullable": nullable,
        "is_required": ~nullable,
        "type_descriptor": type_descriptor(
            F.col("data_type"), F.col("length"), F.col("precision"), F.col("scale")
        ),
    }).withColumn("column_schema_hash", hashed(EXPECTED_COLUMNS))
    per_table = ["schema_version", "lake_table_name", "table_schema"]
    table_hash = described.groupBy(*per_table).agg(
        combined_hash(F.col("column_schema_hash")).alias("table_schema_hash")
    )
    condition = [F.col(f"c.{c}").eqNullSafe(F.col(f"t.{c}")) for c in per_table]
    return described.alias("c").join(table_hash.alias("t"), condition, "left").select(
        *[f"c.{c}" for c in EXPECTED_COLUMNS], "column_schema_hash", "table_schema_hash"
    )
