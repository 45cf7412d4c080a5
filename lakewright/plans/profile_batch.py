"""Profiling all tables of a batch and storing the results."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewright.operators.lineage import write_audit_event
from lakewright.operators.profile_states import (
    LINEAGE, profile_of_states, refresh_states, stored_states,
)
from lakewright.operators.profiling import overall_score
from lakewright.sources.lake import Lake

RESULTS = {
    "data_profile": "profile",
    "data_profile_distribution": "distributions",
    "data_profile_sentinel": "sentinels",
    "data_profile_issue": "issues",
    "data_profile_summary": "summary",
}


def batch_tables(lake: Lake, ingest_id: str, zone: str) -> list[str]:
    """Tables a batch loaded (raw, staging) or filled (validated)."""
    if zone == "validated":
        log, name = "transform_log", "target_table"
        done = F.col("status") == "success"
    else:
        log, name = "ingest_file_log", "lake_table_name"
        done = F.col("load_status") == "success"
    rows = (
        lake.read("governance", log).where((F.col("ingest_id") == ingest_id) & done)
        .select(name).distinct().collect()
    )
    return sorted(r[0] for r in rows if r[0] is not None and lake.exists(zone, r[0]))


def profile_batch(
    lake: Lake, ingest_id: str, zone: str = "raw", settings: dict | str | None = None
) -> dict:
    """Profile the batch's tables, with all the rows they hold now, and replace the batch's
    earlier results. Only the batch's own rows are read, in one pass over its tables; those of
    earlier batches are known by their stored states."""
    if zone not in ("raw", "staging", "validated"):
        raise ValueError(f"cannot profile zone {zone!r}")
    if lake.read("governance", "batch_log").where(F.col("ingest_id") == ingest_id).isEmpty():
        raise ValueError(f"ingest_id '{ingest_id}' not found in governance.batch_log")
    names = batch_tables(lake, ingest_id, zone)
    if not names:
        raise ValueError(f"no tables of ingest '{ingest_id}' in zone '{zone}'")
    refresh_states(lake, zone, names, ingest_id, settings)
    lineage = () if zone == "validated" else LINEAGE
    tables = {n: lake.read(zone, n).drop(*lineage) for n in names}
    profiler = profile_of_states(
        stored_states(lake, zone, names), tables, settings, ingest_id=ingest_id, schema_name=zone
    ).store()
    slice_of = {"ingest_id": ingest_id, "schema_name": zone}
    for table, result in RESULTS.items():
        rows = getattr(profiler, result)().drop(*slice_of).coalesce(1)
        lake.replace_slice("governance", table, rows, slice_of)
    mine = (F.col("ingest_id") == ingest_id) & (F.col("schema_name") == zone)
    summary = lake.read("governance", "data_profile_summary").where(mine)
    totals = summary.agg(
        F.count(F.lit(1)).alias("tables"), F.sum("variable_count").alias("variables"),
        *[F.sum(f"{s}_issue_count").alias(s) for s in ("critical", "warning", "info")],
    ).first()
    score = overall_score(summary).first()["overall_score"]
    sentinels = lake.read("governance", "data_profile_sentinel").where(mine).count()
    outcome = {
        "tables_profiled": totals["tables"], "variables_profiled": totals["variables"],
        "sentinels_detected": sentinels, "critical_issues": totals["critical"],
        "warning_issues": totals["warning"], "info_issues": totals["info"],
        "overall_score": score,
    }
    write_audit_event(
        lake, "data_profiling", "schema", zone, outcome, "success", ingest_id
    )
    return outcome
