"""The variable dictionary: loading, field-level changes, versions and derived tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.names import key_name
from lakewright.functions.text import yes_no
from lakewright.operators.lineage import write_audit_event
from lakewright.operators.upsert import held_keys, require_unique, same_key, upserted
from lakewright.sources.lake import Lake

KEY = ["lake_table_name", "lake_variable_name", "source_type"]
# Dictionary columns, those whose changes are recorded, and the flags.
TRACKED_FIELDS = [
    "source_table_name", "source_variable_name", "data_type", "variable_label",
    "variable_definition", "value_labels", "variable_unit", "valid_min", "valid_max",
    "allowed_values", "is_identifier", "is_phi", "is_required", "validated_table_target",
    "validated_variable_name", "notes", "needs_further_review",
]
FLAGS = ["is_identifier", "is_phi", "is_required"]
NUMBERS = ["valid_min", "valid_max"]
REQUIRED_COLUMNS = ["source_type", "lake_table_name", "lake_variable_name", "data_type"]
INGEST_COLUMNS = [
    "source_type", "source_table_name", "source_variable_name", "lake_table_name",
    "lake_variable_name",
]


def load_dictionary(df: DataFrame, source_type: str | None = None) -> DataFrame:
    """A dictionary as read from a file, brought to its columns and types: absent columns are
    NULL, flags boolean, bounds numeric."""
    absent = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if absent:
        raise ValueError(f"dictionary lacks required columns: {', '.join(absent)}")

    def column(name: str) -> Column:
        c = F.col(name) if name in df.columns else F.lit(None)
        if name in FLAGS:
            return yes_no(c).alias(name)
        if name in NUMBERS:
            return c.cast("string").try_cast("double").alias(name)
        return c.cast("string").alias(name)

    out = df.select(*[column(c) for c in [*KEY, *TRACKED_FIELDS]])
    return out if source_type is None else out.where(F.col("source_type") == source_type)


def _texts(df: DataFrame, name: str) -> DataFrame:
    fields = F.struct(*[F.col(c).cast("string").alias(c) for c in TRACKED_FIELDS])
    return df.select(*KEY, fields.alias(name))


def dictionary_changes(new: DataFrame, current: DataFrame) -> DataFrame:
    """Field-level changes from ``current`` to ``new``, one row per variable and field. All
    fields of added and removed variables are listed, of kept ones those whose text differs
    (NULL and empty text are the same). With an empty ``current`` every row is INITIAL.

    Variables are joined once, whole; fields become rows only after the join.
    """
    none_yet = current.isEmpty()
    before = _texts(current, "old").withColumnsRenamed({k: f"held_{k}" for k in KEY})
    joined = _texts(new, "new").join(before, same_key(KEY), "full_outer").withColumns(
        {k: F.coalesce(k, f"held_{k}") for k in KEY}
    )
    entries = F.array(*[
        F.struct(
            F.lit(f).alias("field_changed"), F.col(f"old.{f}").alias("old_value"),
            F.col(f"new.{f}").alias("new_value"),
        )
        for f in TRACKED_FIELDS
    ])
    rows = joined.select(
        *KEY, F.col("new").isNotNull().alias("in_new"), F.col("old").isNotNull().alias("in_old"),
        F.inline(entries),
    )
    old, new_value = F.col("old_value"), F.col("new_value")
    kept = F.col("in_new") & F.col("in_old")
    differs = F.coalesce(old, F.lit("")) != F.coalesce(new_value, F.lit(""))

    def value(c: Column) -> Column:
        return F.when(kept, F.nullif(c, F.lit(""))).otherwise(c)

    change = (
        F.when(F.lit(none_yet), "INITIAL")
        .when(~F.col("in_old"), "ADD")
        .when(~F.col("in_new"), "REMOVE")
        .when(differs, "UPDATE")
    )
    return rows.select(
        *KEY, "field_changed", value(old).alias("old_value"),
        value(new_value).alias("new_value"), change.alias("change_type"),
    ).where(F.col("change_type").isNotNull())


def current_version(metadata: DataFrame) -> DataFrame:
    """Highest dictionary version, 0 before the first sync."""
    return metadata.agg(F.coalesce(F.max("version_number"), F.lit(0)).alias("version_number"))


def next_metadata(
    new: DataFrame, metadata: DataFrame, version: int, scope: Column | None = None
) -> DataFrame:
    """The dictionary table after a sync: variables of ``new`` inserted or updated, active
    variables within ``scope`` that ``new`` lacks soft-deleted, all others untouched."""
    now = F.current_timestamp()
    incoming = new.withColumns({
        "version_number": F.lit(version), "is_active": F.lit(True),
        "created_at": now, "updated_at": now,
    })
    merged = upserted(metadata, incoming, KEY, keep=("created_at",))
    present = held_keys(new, KEY).withColumn("present", F.lit(True))
    marked = merged.join(present, same_key(KEY), "left")
    gone = F.col("present").isNull() & F.col("is_active")
    if scope is not None:
        gone = gone & scope
    gone = F.coalesce(gone, F.lit(False))
    return marked.withColumns({
        "version_number": F.when(gone, F.lit(version)).otherwise(F.col("version_number")),
        "updated_at": F.when(gone, now).otherwise(F.col("updated_at")),
        "is_active": F.col("is_active") & ~gone,
    }).select(*metadata.columns)


METADATA_SCHEMA = ", ".join(
    [f"{c} string" for c in KEY]
    + [f"{c} {'boolean' if c in FLAGS else 'double' if c in NUMBERS else 'string'}"
       for c in TRACKED_FIELDS]
    + ["version_number int", "is_active boolean", "created_at timestamp",
       "updated_at timestamp", "target_type string"]
)


def sync_metadata(
    lake: Lake, dictionary: DataFrame, source_type: str | None = None,
    decisions: DataFrame | None = None, dict_path: str | None = None,
) -> dict:
    """Bring ``reference.metadata`` to a dictionary: record the changes under the next
    version, soft-delete what is gone, upsert the rest. The version rises with every sync.
    With ``source_type`` only that source is compared."""
    spark = lake.spark
    new = load_dictionary(dictionary, source_type)
    require_unique(new, KEY, "dictionary")
    if lake.exists("reference", "metadata"):
        metadata = lake.read("reference", "metadata")
    else:
        metadata = spark.createDataFrame([], METADATA_SCHEMA)
    scope = None if source_type is None else F.col("source_type") == source_type
    active = metadata.where("is_active")
    if scope is not None:
        active = active.where(scope)
    version = current_version(metadata).first()["version_number"] + 1
    changes = dictionary_changes(new, active)
    counts = {
        r["change_type"]: r["n"] for r in changes.groupBy("change_type")
        .agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if counts:
        lake.append("reference", "metadata_history", changes.select(
            F.lit(version).alias("version_number"), *changes.columns,
            F.current_timestamp().alias("changed_at"),
        ))
    updated = next_metadata(new, metadata, version, scope)
    if decisions is not None:
        types = decisions.select(
            key_name(F.col("table_name")).alias("t"), key_name(F.col("variable")).alias("v"),
            F.lower("final_type").alias("decided"),
        ).groupBy("t", "v").agg(F.min("decided").alias("decided"))
        updated = updated.join(
            types,
            (key_name(F.col("lake_table_name")) == F.col("t"))
            & (key_name(F.col("lake_variable_name")) == F.col("v")), "left",
        ).withColumn("target_type", F.coalesce("decided", "target_type")) \
            .select(*metadata.columns)
    lake.replace("reference", "metadata", updated)
    total = lake.read("reference", "metadata").where(F.col("version_number") == version) \
        .where("is_active").count()
    found = {k: counts.get(k.upper(), 0) for k in ("initial", "add", "update", "remove")}
    write_audit_event(
        lake, "metadata_sync", "table", "reference.metadata",
        {"version_number": version, "dict_path": dict_path,
         "source_filter": source_type or "ALL", "total_variables": total,
         "initial": found["initial"], "adds": found["add"], "updates": found["update"],
         "removes": found["remove"]},
        "success",
    )
    return {
        "version_number": version, "total_variables": total,
        "adds": found["add"] + found["initial"], "updates": found["update"],
        "removes": found["remove"], "total_changes": sum(counts.values()), "rows_synced": total,
    }


def derive_ingest_dictionary(dictionary: DataFrame) -> DataFrame:
    """The distinct source-to-lake name pairs of a dictionary."""
    absent = [c for c in INGEST_COLUMNS if c not in dictionary.columns]
    if absent:
        raise ValueError(f"dictionary lacks required columns: {', '.join(absent)}")
    return (
        dictionary.select(*INGEST_COLUMNS)
        .where("lake_table_name IS NOT NULL AND lake_variable_name IS NOT NULL").distinct()
    )


def sync_ingest_dictionary(lake: Lake, dictionary: DataFrame, mode: str = "replace") -> dict:
    """Replace or extend ``reference.ingest_dictionary`` with lower-cased, trimmed names."""
    if mode not in ("replace", "append"):
        raise ValueError(f"invalid mode {mode!r}: use 'replace' or 'append'")
    rows = dictionary.select(*[
        key_name(F.col(c)).alias(c) if c in INGEST_COLUMNS else F.col(c)
        for c in dictionary.columns
    ])
    before = 0
    if mode == "append" and lake.exists("reference", "ingest_dictionary"):
        before = lake.read("reference", "ingest_dictionary").count()
        lake.append("reference", "ingest_dictionary", rows)
    else:
        lake.replace("reference", "ingest_dictionary", rows)
    facts = lake.read("reference", "ingest_dictionary").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("lake_table_name").alias("tables"),
        F.sort_array(F.collect_set("source_type")).alias("sources"),
    ).first()
    return {"status": "success", "rows_synced": facts["n"] - before,
            "tables_synced": facts["tables"], "source_types": facts["sources"]}


def _decision_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "table_name": key_name(F.col("table_name")), "variable": key_name(F.col("variable")),
    })


def refreshed_type_decisions(dictionary: DataFrame, prior: DataFrame) -> DataFrame:
    """Type decisions for every variable of a dictionary: prior final types and notes are
    kept, variables without a note are pending review."""
    universe = (
        dictionary.select(
            key_name(F.col("lake_table_name")).alias("table_name"),
            key_name(F.col("lake_variable_name")).alias("variable"),
            key_name(F.col("data_type")).alias("suggested_type"),
        )
        .where("table_name IS NOT NULL AND variable IS NOT NULL")
        .groupBy("table_name", "variable").agg(F.min("suggested_type").alias("suggested_type"))
    )
    def filled(c: Column) -> Column:
        return F.when(F.trim(c) != "", c)

    # Of several rows of one variable a filled one counts before a blank one.
    blank = [filled(F.col(c)).isNull().alias(f"no_{c}") for c in ("final_type", "decision_note")]
    old = _decision_keys(prior).groupBy("table_name", "variable").agg(
        F.min(F.struct(*blank, "final_type", "decision_note")).alias("old")
    )

    return universe.join(old, ["table_name", "variable"], "left").select(
        "table_name", "variable", "suggested_type",
        filled(F.col("old.final_type")).alias("final_type"),
        F.coalesce(filled(F.col("old.decision_note")), F.lit("PENDING REVIEW"))
        .alias("decision_note"),
    )


def orphaned_type_decisions(dictionary: DataFrame, prior: DataFrame) -> DataFrame:
    """Prior decisions whose variable the dictionary no longer has."""
    universe = dictionary.select(
        key_name(F.col("lake_table_name")).alias("table_name"),
        key_name(F.col("lake_variable_name")).alias("variable"),
    )
    return _decision_keys(prior).join(universe, ["table_name", "variable"], "left_anti")


def update_type_decisions(lake: Lake, dictionary: DataFrame) -> dict:
    """Refresh ``reference.type_decisions``; orphans are dropped and counted."""
    if lake.exists("reference", "type_decisions"):
        prior = lake.read("reference", "type_decisions")
    else:
        prior = lake.spark.createDataFrame(
            [], "table_name string, variable string, suggested_type string, "
                "final_type string, decision_note string",
        )
    removed = orphaned_type_decisions(dictionary, prior).count()
    lake.replace("reference", "type_decisions", refreshed_type_decisions(dictionary, prior))
    facts = lake.read("reference", "type_decisions").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("decision_note") == "PENDING REVIEW").alias("new"),
    ).first()
    return {"status": "success", "total_rows": facts["n"], "new_rows": facts["new"],
            "preserved_rows": facts["n"] - facts["new"], "removed_rows": removed}


def refresh_metadata(lake: Lake, dictionary: DataFrame, source_type: str | None = None) -> dict:
    """Everything derived from a new dictionary, in order; the first failure ends the chain."""
    done: dict = {}
    steps = {
        "ingest_dictionary": lambda: sync_ingest_dictionary(
            lake, derive_ingest_dictionary(dictionary)
        ),
        "type_decisions": lambda: update_type_decisions(lake, dictionary),
        "metadata": lambda: sync_metadata(
            lake, dictionary, source_type,
            decisions=lake.read("reference", "type_decisions"),
        ),
    }
    for name, step in steps.items():
        try:
            done[name] = step()
        except Exception as error:
            return {"status": "error", "failed_step": name, "error_message": str(error), **done}
    return {"status": "success", **done}
