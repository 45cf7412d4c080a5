"""Source registry, audit events and the batch and file logs."""

from __future__ import annotations

import getpass
import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.operators.upsert import upserted
from lakewright.sources.lake import Lake

# The vocabulary of the source registry.
VOCABULARY = {
    "system_type": ["CSV", "XLSX", "SQL", "API", "FHIR", "Other"],
    "update_frequency": [
        "daily", "weekly", "biweekly", "monthly", "quarterly", "annually", "ad_hoc",
    ],
    "ingest_method": ["push", "pull", "api", "sftp", "manual"],
    "pii_classification": ["PHI", "Limited", "NonPHI"],
}
REQUIRED_FIELDS = [
    "source_id", "source_name", "system_type", "update_frequency", "data_owner",
    "ingest_method", "expected_schema_version", "pii_classification", "active",
]
REGISTRY_SCHEMA = (
    "source_id string, source_name string, system_type string, update_frequency string, "
    "data_owner string, ingest_method string, expected_schema_version string, "
    "retention_policy string, pii_classification string, active boolean"
)
AUDIT_SCHEMA = (
    "audit_id string, ingest_id string, action string, details string, executed_by string"
)


def registry_violations(entries: DataFrame) -> DataFrame:
    """Registry entries that break a rule, one row per broken rule: a required field absent
    or NULL, or a value outside its vocabulary. Keeps ``source_id``."""
    checks: list[Column] = []

    def broken(cond: Column, field: str, problem: str, value: Column) -> Column:
        made = F.struct(
            F.lit(field).alias("field"), F.lit(problem).alias("problem"),
            value.cast("string").alias("value"),
        )
        return F.when(cond, made)

    for field in REQUIRED_FIELDS:
        if field in entries.columns:
            c = F.col(field)
            checks.append(broken(c.isNull(), field, "required field is NULL", c))
        else:
            checks.append(
                broken(F.lit(True), field, "required field is missing", F.lit(None))
            )
    for field, allowed in VOCABULARY.items():
        if field in entries.columns:
            c = F.col(field)
            checks.append(broken(~c.isin(allowed), field, "value is not allowed", c))
    if "active" in entries.columns and entries.schema["active"].dataType.simpleString() != "boolean":
        c = F.col("active")
        is_flag = F.lower(c.cast("string")).isin("true", "false")
        checks.append(broken(c.isNotNull() & ~is_flag, "active", "value is not a flag", c))
    found = F.explode(F.array_compact(F.array(*checks)))
    return entries.select("source_id", found.alias("found")).select("source_id", "found.*")


def audit_events(events: DataFrame) -> DataFrame:
    """Audit rows from ``ingest_id, event_type, status, object_type, object_name, payload``:
    an action line of the parts that are present and the details as JSON."""
    parts = ("event_type", "status", "object_type", "object_name")
    details = F.struct("event_type", "object_type", "object_name", "status", "payload")
    return events.select(
        "ingest_id",
        F.concat_ws("|", *parts).alias("action"),
        F.to_json(details, {"ignoreNullFields": "false"}).alias("details"),
    )


def write_audit_event(
    lake: Lake,
    event_type: str,
    object_type: str,
    object_name: str,
    details: dict | None = None,
    status: str | None = None,
    ingest_id: str | None = None,
) -> str:
    audit_id = f"AUD_{uuid.uuid4()}"
    action = "|".join(p for p in (event_type, status, object_type, object_name) if p is not None)
    body = {
        "event_type": event_type, "object_type": object_type, "object_name": object_name,
        "status": status, "payload": details,
    }
    row = [(audit_id, ingest_id, action, json.dumps(body), getpass.getuser())]
    df = lake.spark.createDataFrame(row, AUDIT_SCHEMA)
    lake.append("governance", "audit_log", df.withColumn("executed_at_utc", F.current_timestamp()))
    return audit_id


def register_source(lake: Lake, created_by: str | None = None, **fields) -> str:
    """Insert or update one source after checking it; returns insert or update."""
    spark = lake.spark
    absent = [f for f in REQUIRED_FIELDS if f != "active" and fields.get(f) is None]
    if absent:
        raise ValueError(f"missing required fields: {', '.join(absent)}")
    if not isinstance(fields.setdefault("active", True), bool):
        raise ValueError("field 'active' must be true or false")
    fields.setdefault("retention_policy", None)
    entry = spark.createDataFrame([fields], REGISTRY_SCHEMA)
    broken = registry_violations(entry).collect()
    if broken:
        raise ValueError("; ".join(f"{b['field']}: {b['problem']} ({b['value']})" for b in broken))
    now = F.current_timestamp()
    entry = entry.withColumns({
        "created_at_utc": now, "last_modified_utc": now,
        "created_by": F.lit(created_by or getpass.getuser()),
    })
    action = "insert"
    if lake.exists("governance", "source_registry"):
        current = lake.read("governance", "source_registry")
        if not current.where(F.col("source_id") == fields["source_id"]).isEmpty():
            action = "update"
        entry = upserted(current, entry, ["source_id"], keep=("created_at_utc", "created_by"))
    lake.replace("governance", "source_registry", entry)
    event = "source_registration" if action == "insert" else "source_update"
    write_audit_event(
        lake, event, "table", "governance.source_registry",
        {"action": action, "source_id": fields["source_id"]}, "success",
    )
    return action


def batch_status(files: DataFrame) -> DataFrame:
    """Status of each batch from the states of its files: no success is an error, no error a
    success, anything else partial."""
    ok = F.count_if(F.col("load_status") == "success")
    bad = F.count_if(F.col("load_status") != "success")
    return files.groupBy("ingest_id").agg(
        F.count(F.lit(1)).alias("n_files"),
        ok.alias("n_success"),
        bad.alias("n_error"),
        F.when(ok == 0, "error").when(bad == 0, "success").otherwise("partial").alias("status"),
    )
