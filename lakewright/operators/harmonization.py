"""Mapping staging tables of several sources into shared domain tables."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.datatypes import convert, spark_type, type_rank
from lakewright.functions.text import trim_blanks
from lakewright.operators.lineage import write_audit_event
from lakewright.operators.upsert import held_keys, require_unique, same_key, upserted
from lakewright.sources.lake import Lake

MAP_KEY = ["source_type", "source_table", "source_column", "target_table", "target_column"]
HAND_MADE = ("expression", "constant", "coalesce")
MAP_SCHEMA = (
    "source_type string, source_table string, source_column string, target_table string, "
    "target_column string, transform_type string, transform_expression string, "
    "is_active boolean, priority int, notes string, created_at timestamp, updated_at timestamp"
)
# The shared domain tables.
DOMAIN_TABLES = [
    "admission", "admission_vitals", "blood_products", "complications", "demographics",
    "diagnoses", "discharge", "injuries", "injury_event", "insurance", "labs", "medications",
    "micro_cultures", "micro_sensitivities", "patient_tracking", "pmh",
    "prehospital_procedures", "prehospital_transport", "prehospital_vitals", "procedures",
    "toxicology", "trauma_scores", "vitals",
]
GOVERNANCE_FIELDS = [
    T.StructField("validated_id", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
]


def target_rows(metadata: DataFrame) -> DataFrame:
    """Active dictionary rows with a target, one row per target of a comma-separated list."""
    target, variable = F.col("validated_table_target"), F.col("validated_variable_name")
    return (
        metadata.where("is_active")
        .where((F.trim(target) != "") & (F.trim(variable) != ""))
        .withColumn("validated_table_target", F.explode(F.split(trim_blanks(target), r"\s*,\s*")))
        .withColumn("validated_table_target", trim_blanks(F.col("validated_table_target")))
        .where(F.col("validated_table_target") != "")
    )


def derived_mappings(metadata: DataFrame) -> DataFrame:
    """Column mappings a dictionary implies: direct where the names agree, else rename."""
    name, target = F.col("lake_variable_name"), F.col("validated_variable_name")
    same = F.lower(trim_blanks(name)) == F.lower(trim_blanks(target))
    return target_rows(metadata).select(
        "source_type",
        F.col("lake_table_name").alias("source_table"),
        name.alias("source_column"),
        F.col("validated_table_target").alias("target_table"),
        target.alias("target_column"),
        F.when(same, "direct").otherwise("rename").alias("transform_type"),
        F.lit(None).cast("string").alias("transform_expression"),
        F.lit(True).alias("is_active"),
        F.lit(100).alias("priority"),
        F.lit(None).cast("string").alias("notes"),
    )


def merged_mappings(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The map after an upsert: hand-made transforms, priorities and notes survive."""
    def by_hand(c: str):
        kept = F.col("old.transform_type").isin(*HAND_MADE)
        return lambda old, new: F.when(kept, old).otherwise(new)

    stamped = incoming.withColumns({
        "created_at": F.current_timestamp(), "updated_at": F.current_timestamp(),
    })
    return upserted(
        current, stamped, MAP_KEY, keep=("priority", "notes", "created_at"),
        rules={c: by_hand(c) for c in ("transform_type", "transform_expression")},
    )


def sync_harmonization_map(
    lake: Lake, mappings: DataFrame | None = None, deactivate_absent: bool = False
) -> dict:
    """Upsert the mappings of the dictionary, or the given ones, into the map."""
    if mappings is None:
        mappings = derived_mappings(lake.read("reference", "metadata"))
    else:
        mappings = mappings.withColumns({
            "is_active": F.coalesce(F.col("is_active").cast("boolean"), F.lit(True)),
            "priority": F.coalesce(F.col("priority").cast("int"), F.lit(100)),
        })
    if mappings.isEmpty():
        raise ValueError("no mappings: no dictionary row names a validated table")
    require_unique(mappings, MAP_KEY, "mappings")
    if lake.exists("reference", "harmonization_map"):
        current = lake.read("reference", "harmonization_map")
    else:
        current = lake.spark.createDataFrame([], MAP_SCHEMA)
    merged = merged_mappings(current, mappings)
    if deactivate_absent:
        seen = held_keys(mappings, MAP_KEY).withColumn("seen", F.lit(True))
        merged = merged.join(seen, same_key(MAP_KEY), "left").withColumn(
            "is_active", F.col("is_active") & F.coalesce("seen", F.lit(False))
        ).select(*merged.columns)
    lake.replace("reference", "harmonization_map", merged)
    facts = mappings.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("target_table").alias("t"),
        F.count_distinct("source_type").alias("s"),
    ).first()
    return {"count": facts["n"], "tables_mapped": facts["t"], "sources_mapped": facts["s"]}


def active_mappings(
    mapping: DataFrame, target_table: str, source_type: str | None = None
) -> DataFrame:
    out = mapping.where((F.col("target_table") == target_table) & F.col("is_active"))
    if source_type is not None:
        out = out.where(F.col("source_type") == source_type)
    return out.orderBy("source_type", "source_table", "priority", "target_column", "source_column")


def _column_of(m: dict, staging: DataFrame, target: T.DataType | None) -> Column:
    """One mapping as a column; what cannot be computed is NULL."""
    fields = {f.name: f.dataType for f in staging.schema.fields}
    kind, text = m["transform_type"], m["transform_expression"]
    value = F.lit(None)
    if kind in ("direct", "rename") and m["source_column"] in fields:
        source = fields[m["source_column"]]
        return convert(F.col(f"`{m['source_column']}`"), source, target)
    if kind in ("expression", "coalesce") and text is not None and text.strip():
        value = F.expr(text)
    elif kind == "constant" and text is not None:
        value = F.lit(text)
    return value if target is None else value.cast(target)


def harmonized(
    staging: DataFrame, mappings: list[dict], source_type: str, source_table: str,
    target: T.StructType | None = None, conflict: str = "error",
) -> DataFrame:
    """Staging rows projected into a domain table, with their source. Two mappings to one
    target column are an error, or with ``conflict="priority"`` coalesced by priority."""
    types = {f.name: f.dataType for f in target.fields} if target is not None else {}
    by_target: dict[str, list[dict]] = defaultdict(list)
    for m in sorted(mappings, key=lambda m: 100 if m.get("priority") is None else m["priority"]):
        by_target[m["target_column"]].append(m)
    twice = [t for t, ms in by_target.items() if len(ms) > 1]
    if twice and conflict != "priority":
        raise ValueError(f"several mappings to one target column: {', '.join(sorted(twice))}")
    columns = {
        name: F.coalesce(*[_column_of(m, staging, types.get(name)) for m in ms]).alias(name)
        for name, ms in by_target.items()
    }
    return staging.select(
        F.lit(source_type).alias("source_type"), F.lit(source_table).alias("source_table"),
        *columns.values(),
    )


def validated_columns(metadata: DataFrame, staging_types: DataFrame) -> DataFrame:
    """Columns of the domain tables: the most specific type over all sources (of equals the
    first by type text), the sources and whether any source calls it an identifier.
    ``staging_types`` has ``table_name, column_name, sql_type``."""
    typed = target_rows(metadata).join(
        staging_types.select(
            F.col("table_name").alias("lake_table_name"),
            F.col("column_name").alias("lake_variable_name"), "sql_type",
        ),
        ["lake_table_name", "lake_variable_name"], "left",
    )
    declared = F.upper(F.trim("target_type"))
    resolved = F.coalesce(
        F.nullif(F.col("sql_type"), F.lit("")), F.nullif(declared, F.lit("")), F.lit("TEXT")
    )
    best = F.min_by(F.col("resolved"), F.struct(-type_rank(F.col("resolved")), F.col("resolved")))
    return typed.withColumn("resolved", resolved).groupBy(
        "validated_table_target", "validated_variable_name"
    ).agg(
        best.alias("resolved_type"),
        F.concat_ws(", ", F.sort_array(F.collect_set("source_type"))).alias("sources"),
        F.coalesce(F.bool_or("is_identifier"), F.lit(False)).alias("is_identifier"),
    )


def validated_schemas(metadata: DataFrame, staging_types: DataFrame) -> dict[str, T.StructType]:
    """Schema of every domain table a dictionary maps to, governance columns first."""
    rows = validated_columns(metadata, staging_types).orderBy(
        "validated_table_target", "validated_variable_name"
    ).collect()
    fields: dict[str, list] = defaultdict(lambda: list(GOVERNANCE_FIELDS))
    for r in rows:
        kind = spark_type(r["resolved_type"]) or T.StringType()
        fields[r["validated_table_target"]].append(
            T.StructField(r["validated_variable_name"], kind)
        )
    return {t: T.StructType(f) for t, f in fields.items()}


def staging_column_types(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, sql_type`` of staging tables, from their schemas."""
    names = {
        T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
        T.FloatType: "REAL", T.DoubleType: "DOUBLE PRECISION", T.BooleanType: "BOOLEAN",
        T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMPTZ",
    }
    rows = []
    for table, df in tables.items():
        for f in df.schema.fields:
            kind = f.dataType
            if isinstance(kind, T.DecimalType):
                text = f"NUMERIC({kind.precision},{kind.scale})"
            else:
                text = names.get(type(kind), "TEXT")
            rows.append((table, f.name, text))
    return spark.createDataFrame(rows, "table_name string, column_name string, sql_type string")


def _log_transform(lake: Lake, ingest_id: str, target: str, entries: list[dict]) -> None:
    schema = (
        "source_schema string, source_table string, source_row_count bigint, "
        "target_schema string, target_row_count bigint, operation_type string, "
        "columns_mapped int, status string, error_message string, started_at timestamp, "
        "completed_at timestamp, duration_seconds double, source_type string"
    )
    rows = [(
        "staging", e["source_table"], e["source_rows"], "validated", e["rows"], "insert",
        e["columns"], e["status"], e["error"], e["started"], e["completed"],
        round((e["completed"] - e["started"]).total_seconds(), 2), e["source_type"],
    ) for e in entries]
    df = lake.spark.createDataFrame(rows, schema).coalesce(1)
    lake.replace_slice(
        "governance", "transform_log", df, {"ingest_id": ingest_id, "target_table": target}
    )


def harmonize_table(
    lake: Lake, target_table: str, ingest_id: str, source_type: str | None = None,
    schema: T.StructType | None = None, conflict: str = "error",
) -> dict:
    """Rebuild one batch's rows of a domain table. Every source table is one slice of it and
    one write that counts its rows on the way. A source that fails is logged; the others go on,
    and the rows an earlier run made of it stay. Rows of sources that are no longer mapped go.
    With ``source_type`` only the slices of that type are touched."""
    spark = lake.spark
    mapping = lake.read("reference", "harmonization_map")
    groups: dict[tuple, list[dict]] = defaultdict(list)
    for m in active_mappings(mapping, target_table, source_type).collect():
        groups[m["source_type"], m["source_table"]].append(m.asDict())
    out = {"target_table": target_table, "rows_inserted": 0, "sources_processed": 0,
           "sources_skipped": 0, "sources_failed": 0}
    for old in lake.slices("validated", target_table):
        mine = old["ingest_id"] == ingest_id and source_type in (None, old["source_type"])
        if groups and mine and (old["source_type"], old["source_table"]) not in groups:
            lake.drop_slice("validated", target_table, old)
    if not groups:
        return out
    if schema is None:
        staged = {t: lake.read("staging", t) for t in
                  sorted({t for _, t in groups}) if lake.exists("staging", t)}
        if not staged:
            schema = T.StructType(GOVERNANCE_FIELDS)
        else:
            schema = validated_schemas(
                lake.read("reference", "metadata"), staging_column_types(spark, staged)
            ).get(target_table, T.StructType(GOVERNANCE_FIELDS))
    entries = []
    for (kind, table), mappings in sorted(groups.items()):
        entry = {"source_type": kind, "source_table": table, "source_rows": 0, "rows": 0,
                 "columns": 0, "started": datetime.now(timezone.utc), "error": None}
        if not lake.exists("staging", table):
            entry.update(status="failed", error="Staging table not found")
            out["sources_skipped"] += 1
        else:
            entry["columns"] = len(mappings)
            staging = lake.read("staging", table)
            if "_ingest_id" in staging.columns:
                staging = staging.where(F.col("_ingest_id") == ingest_id)
            try:
                seen = Observation()
                rows = harmonized(staging, mappings, kind, table, schema, conflict)
                rows = rows.observe(seen, F.count(F.lit(1)).alias("n")).withColumns({
                    "validated_id": F.concat_ws(
                        ":", F.lit(ingest_id), "source_type", "source_table",
                        F.monotonically_increasing_id().cast("string"),
                    ),
                    "created_at": F.current_timestamp(),
                })
                fitted = rows.select(*[
                    F.col(f.name) if f.name in rows.columns
                    else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in schema.fields
                ], *[c for c in rows.columns if c not in schema.names])
                lake.replace_slice("validated", target_table, fitted, {
                    "ingest_id": ingest_id, "source_type": kind, "source_table": table,
                })
                n = seen.get["n"]
                entry.update(status="success", rows=n, source_rows=n)
                out["rows_inserted"] += n
                out["sources_processed"] += 1
            except Exception as error:
                entry.update(status="failed", error=str(error), source_rows=staging.count())
                out["sources_failed"] += 1
        entry["completed"] = datetime.now(timezone.utc)
        entries.append(entry)
    _log_transform(lake, ingest_id, target_table, entries)
    return out


def harmonize_data(
    lake: Lake, ingest_id: str, target_tables: list[str] | None = None,
    source_type: str | None = None, conflict: str = "error",
) -> dict:
    """Harmonize all mapped domain tables for a batch, or the named ones."""
    batches = lake.read("governance", "batch_log").where(F.col("ingest_id") == ingest_id)
    if batches.isEmpty():
        raise ValueError(f"ingest_id '{ingest_id}' not found in governance.batch_log")
    if target_tables is None:
        mapping = lake.read("reference", "harmonization_map").where("is_active")
        target_tables = sorted(
            r[0] for r in mapping.select("target_table").distinct().collect()
        )
        if not target_tables:
            raise ValueError("no active mappings: sync the harmonization map first")
    started = datetime.now(timezone.utc)
    ok = failed = total = sources = 0
    by_table = {}
    for table in target_tables:
        try:
            done = harmonize_table(lake, table, ingest_id, source_type, conflict=conflict)
        except Exception:
            done = {"rows_inserted": 0, "sources_processed": 0, "sources_failed": 1}
        by_table[table] = done["rows_inserted"]
        total += done["rows_inserted"]
        sources += done["sources_processed"]
        if done["rows_inserted"] > 0 or done["sources_processed"] > 0:
            ok += 1
        elif done["sources_failed"] > 0:
            failed += 1
    status = "success" if failed == 0 else "partial"
    seconds = (datetime.now(timezone.utc) - started).total_seconds()
    write_audit_event(
        lake, "harmonization", "schema", "validated.*",
        {"tables_processed": len(target_tables), "tables_ok": ok, "tables_failed": failed,
         "total_rows": total, "sources_processed": sources,
         "source_type_filter": source_type or "ALL", "duration_seconds": round(seconds, 1)},
        status, ingest_id,
    )
    return {"tables_processed": len(target_tables), "total_rows": total,
            "sources_processed": sources, "by_table": by_table, "status": status}
