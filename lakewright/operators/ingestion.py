"""Ingestion of delimited files into raw tables and promotion of raw to typed staging."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.datatypes import lenient_cast, spark_type, strict_cast
from lakewright.functions.names import key_name, normalized
from lakewright.functions.text import blank_to_null, trim_blanks
from lakewright.operators.lineage import batch_status, write_audit_event
from lakewright.session import written
from lakewright.sources import files as fl
from lakewright.sources.lake import Lake

FILE_SCHEMA = (
    "ingest_file_id string, file_name string, file_path string, lake_table_name string, "
    "file_size_bytes bigint, row_count bigint, checksum string, load_status string, "
    "logged_at_utc timestamp, completed_at_utc timestamp"
)
LINEAGE = ("_ingest_id", "_source_file")


def ingest_dictionary(df: DataFrame) -> DataFrame:
    """Dictionary with its keys in the lower-cased, trimmed form files are matched by."""
    keys = (
        "source_type", "source_table_name", "source_variable_name",
        "lake_table_name", "lake_variable_name",
    )
    return df.select(*[key_name(F.col(k)).alias(k) for k in keys])


def resolve_lake_tables(files: DataFrame, dictionary: DataFrame, source_type: str) -> DataFrame:
    """Lake table of each file of ``files`` (``path``): the dictionary's table for the file's
    base name, else ``labs`` for ``labs_<year>`` files, whose year is kept."""
    wanted = F.lit(source_type.strip().lower())
    tables = (
        ingest_dictionary(dictionary)
        .where((F.col("source_type") == wanted) & (F.col("lake_table_name") != ""))
        .groupBy("source_table_name").agg(F.min("lake_table_name").alias("mapped"))
    )
    base = fl.base_name(F.col("path"))
    named = files.withColumn("file_base", base)
    fallback = F.when(
        F.col("mapped").isNull() & F.col("file_base").startswith("labs_"), "labs"
    )
    year = F.regexp_extract("file_base", r"^labs_(\d+)$", 1).try_cast("int")
    return named.join(tables, named["file_base"] == tables["source_table_name"], "left").select(
        *files.columns,
        "file_base",
        F.coalesce("mapped", fallback).alias("lake_table_name"),
        F.when(fallback.isNotNull(), year).alias("lab_year"),
    )


def derive_source_types(files: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Source types whose dictionary rows name one of the files, with the files matched."""
    bases = files.select(fl.base_name(F.col("path")).alias("file_base")).distinct()
    named = dictionary.select(
        "source_type", key_name(F.col("source_table_name")).alias("file_base")
    ).distinct()
    return named.join(bases, "file_base").groupBy("source_type").agg(
        F.count(F.lit(1)).alias("n_files")
    )


def projected_columns(df: DataFrame, mapping: list[tuple[str, str]]) -> list[Column]:
    """Mapped lake variables, renamed from their source columns, in dictionary order; a
    variable none of whose source columns is present is NULL."""
    have = set(df.columns)
    chosen: dict[str, str | None] = {}
    for source, lake in mapping:
        found = source if source in have else lake if lake in have else None
        if chosen.get(lake) is None:
            chosen[lake] = found
    return [
        (F.col(f"`{source}`") if source else F.lit(None).cast("string")).alias(lake)
        for lake, source in chosen.items()
    ]


def projected(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    return df.select(*projected_columns(df, mapping))


def coerced(df: DataFrame, descriptors: dict[str, str]) -> DataFrame:
    """Text columns cast to their described types; text that does not parse is NULL."""
    return df.select(*[
        lenient_cast(F.col(f"`{c}`"), descriptors[c]).alias(c) if c in descriptors
        else F.col(f"`{c}`")
        for c in df.columns
    ])


def chosen_type(final_type: Column, suggested_type: Column) -> Column:
    """The decided type: the final one, else the suggested one, else TEXT."""
    return F.coalesce(
        trim_blanks(blank_to_null(final_type)), trim_blanks(blank_to_null(suggested_type)),
        F.lit("TEXT"),
    )


def type_choices(columns: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decided type of each (table_name, variable) of ``columns``; of several decisions for
    one variable the first in ``decision_order`` (or by type text) counts; those that name no
    type come last."""
    order = [F.col(c) for c in decisions.columns if c == "decision_order"]
    no_final, no_suggested = (
        blank_to_null(F.col(c)).isNull() for c in ("final_type", "suggested_type")
    )
    keyed = decisions.select(
        key_name(F.col("table_name")).alias("table_key"),
        key_name(F.col("variable")).alias("variable_key"),
        F.struct(
            (no_final & no_suggested).alias("no_type"), *order, no_final.alias("no_final"),
            "final_type", no_suggested.alias("no_suggested"), "suggested_type",
        ).alias("decision"),
    ).groupBy("table_key", "variable_key").agg(F.min("decision").alias("decision"))
    return columns.withColumns({
        "table_key": key_name(F.col("table_name")), "variable_key": key_name(F.col("variable")),
    }).join(keyed, ["table_key", "variable_key"], "left").select(
        *columns.columns,
        chosen_type(F.col("decision.final_type"), F.col("decision.suggested_type"))
        .alias("chosen_type"),
    )


def promoted(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Every column cast strictly to its decided type; one bad value fails the job."""
    return df.select(*[
        strict_cast(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`")
        for c in df.columns
    ])


TYPES_FACT = "lakewright.decided_types"


def _decided_types(lake: Lake, table: str, columns: list[str], decisions: DataFrame) -> dict[str, str]:
    """Types other than TEXT decided for columns of a table."""
    asked = lake.spark.createDataFrame(
        [(table, c) for c in columns], "table_name string, variable string"
    )
    if "lake_table_name" in decisions.columns:
        decisions = decisions.withColumnsRenamed(
            {"lake_table_name": "table_name", "lake_variable_name": "variable"}
        )
    chosen = {r["variable"]: r["chosen_type"] for r in type_choices(asked, decisions).collect()}
    return {c: t for c, t in chosen.items() if t.upper() != "TEXT"}


def _types_still_fit(lake: Lake, table: str, typed: dict[str, str]) -> bool:
    """Whether the staging table was made with these types; columns it lacks may have any."""
    known = lake.noted("staging", table, TYPES_FACT) if lake.exists("staging", table) else None
    if known is None:
        return False
    staged = set(lake.read("staging", table).columns) - set(LINEAGE)
    return {c: t for c, t in typed.items() if c in staged} == json.loads(known)


def promote_to_staging(
    lake: Lake, table: str, decisions: DataFrame, ingest_id: str | None = None
) -> dict:
    """Bring a raw table to staging with decided types, batch by batch.

    Batches that staging lacks, and the one named, are read from their slice of the raw table
    alone, and each becomes a slice of the staging table. Only where the decided type of a
    column has changed since, the table is rebuilt as a whole. Values that do not fit fail the
    promotion; what staging held before stays. ``n_rows`` counts the rows promoted now,
    ``mode`` tells slices from a whole table."""
    table = table.strip().lower()
    out = {"status": "error", "lake_table": table, "n_rows": None, "n_columns": None,
           "n_typed": None, "mode": None, "error_message": None}
    if not lake.exists("raw", table):
        return {**out, "error_message": f"raw.{table} does not exist."}
    raw = lake.read("raw", table)
    columns = [c for c in raw.columns if c not in LINEAGE]
    typed = _decided_types(lake, table, columns, decisions)
    out = {**out, "n_columns": len(columns), "n_typed": len(typed)}
    noted = {TYPES_FACT: json.dumps(typed)}
    seen = Observation()
    count = F.count(F.lit(1)).alias("n")
    try:
        if not _types_still_fit(lake, table, typed):
            out["mode"] = "table"
            rows = promoted(raw, typed).observe(seen, count)
            lake.replace("staging", table, rows, ("_ingest_id",), noted)
            return {**out, "status": "promoted", "n_rows": seen.get["n"]}
        out["mode"] = "slices"
        here = [s["_ingest_id"] for s in lake.slices("raw", table)]
        staged = {s["_ingest_id"] for s in lake.slices("staging", table)}
        total = 0
        for batch in here:
            if batch in staged and batch != ingest_id:
                continue
            seen = Observation()
            rows = promoted(raw.where(F.col("_ingest_id") == batch), typed).observe(seen, count)
            lake.replace_slice("staging", table, rows.drop("_ingest_id"), {"_ingest_id": batch})
            total += seen.get["n"]
        for batch in staged - set(here):
            lake.drop_slice("staging", table, {"_ingest_id": batch})
        lake.note("staging", table, noted)
    except Exception as error:
        return {**out, "error_message": str(error)}
    return {**out, "status": "promoted", "n_rows": total}


def backfill_staging(lake: Lake, decisions: DataFrame, mode: str = "missing_only") -> list[dict]:
    """Promote all raw tables, or those without a staging table. Tables whose decided types
    are as before only take in the batches that staging lacks."""
    if mode not in ("missing_only", "all"):
        raise ValueError(f"invalid mode {mode!r}: use 'missing_only' or 'all'")
    present = set(lake.tables("staging")) if mode == "missing_only" else set()
    tables = [t for t in lake.tables("raw") if t not in present]
    results = [promote_to_staging(lake, t, decisions) for t in tables]
    errors = sum(r["status"] == "error" for r in results)
    write_audit_event(
        lake, "staging_backfill", "schema", "staging",
        {"mode": mode, "tables_attempted": len(tables),
         "tables_promoted": len(tables) - errors, "tables_errored": errors, "tables": tables},
        "success" if errors == 0 else "partial",
    )
    return results


def open_batch(lake: Lake, ingest_id: str, source_id: str, paths: list[str]) -> None:
    """Log a batch as started and its files as pending; an ingest_id is used once."""
    spark = lake.spark
    if lake.exists("governance", "batch_log") and not (
        lake.read("governance", "batch_log").where(F.col("ingest_id") == ingest_id).isEmpty()
    ):
        raise ValueError(f"ingest_id '{ingest_id}' already exists.")
    _write_files(lake, ingest_id, [
        {"path": p, "load_status": "pending"} for p in paths
    ])
    _write_batch(lake, ingest_id, source_id, "started", len(paths))


def _write_batch(
    lake: Lake, ingest_id: str, source_id: str | None, status: str, count: int,
    ok: int | None = None, bad: int | None = None, started: datetime | None = None,
    error: str | None = None,
) -> None:
    now = datetime.now(timezone.utc)
    schema = (
        "ingest_timestamp timestamp, status string, error_message string, file_count int, "
        "files_success int, files_error int, batch_started_at_utc timestamp, "
        "batch_completed_at_utc timestamp, source_id string"
    )
    done = None if status == "started" else now
    row = (started or now, status, error, count, ok, bad, started or now, done, source_id)
    df = lake.spark.createDataFrame([row], schema)
    lake.replace_slice("governance", "batch_log", df, {"ingest_id": ingest_id})


def _write_files(lake: Lake, ingest_id: str, files: list[dict]) -> None:
    """Rows of the file log of one batch, one per file of the batch."""
    now = datetime.now(timezone.utc)
    rows = []
    for f in files:
        done = None if f["load_status"] == "pending" else now
        rows.append((
            None, f["path"].rsplit("/", 1)[-1], f["path"], f.get("lake_table"),
            f.get("file_size_bytes"), f.get("row_count"), f.get("checksum"), f["load_status"],
            f.get("logged_at") or now, done,
        ))
    df = lake.spark.createDataFrame(rows, FILE_SCHEMA).withColumn(
        "ingest_file_id", F.sha2(F.concat_ws("|", F.lit(ingest_id), "file_path"), 256)
    )
    lake.replace_slice("governance", "ingest_file_log", df.coalesce(1), {"ingest_id": ingest_id})


def plain_path(path: str) -> str:
    """A path as it was given: local paths without their scheme."""
    return re.sub(r"^file:/+", "/", path)


def _known_facts(facts: DataFrame) -> tuple[dict, dict]:
    """Facts by path and the distinct headers by id. The files are read once; the driver holds
    a short row per file and each different header once."""
    header_id = F.sha2(F.to_json("header"), 256)
    stored = written(facts.withColumn("header_id", header_id))
    by_path = {r["path"]: r for r in stored.drop("header").collect()}
    headers = stored.where("found").select("header_id", "header").distinct().collect()
    return by_path, {r["header_id"]: tuple(r["header"]) for r in headers}


def _load_group(
    lake: Lake, paths: list[str], header: list[str], lake_table: str,
    mapping: list[tuple[str, str]], lab_years: dict[str, int | None], ingest_id: str, options: dict,
) -> None:
    scan = fl.read_text_csv(lake.spark, paths, header, **options)
    rows = scan.select(*projected_columns(scan, mapping), "_source_file")
    if lake_table == "labs":
        pairs = [x for p, y in lab_years.items() if y is not None
                 for x in (F.lit(fl.file_stem(p)), F.lit(str(y)))]
        year = (
            F.try_element_at(F.create_map(*pairs), fl.base_name(F.col("_source_file")))
            if pairs else F.lit(None).cast("string")
        )
        rows = rows.withColumn("lab_year", year)
    rows = rows.withColumn("_ingest_id", F.lit(ingest_id))
    lake.append("raw", lake_table, rows, ("_ingest_id",))


def ingest_batch(
    lake: Lake, ingest_id: str, source_id: str | None, source_type: str,
    dictionary: DataFrame, type_decisions: DataFrame | None = None, **csv_options,
) -> dict:
    """Load the pending files of a batch into raw tables and close the batch.

    Files that share a lake table and a header are read by one job. A group that fails is
    halved, and its halves are tried, so that a bad file is an error of its own and the others
    load: one bad file among ``n`` costs about ``2 log n`` jobs.
    """
    spark = lake.spark
    pending = (
        lake.read("governance", "ingest_file_log").where(F.col("ingest_id") == ingest_id)
        .select("file_path", "logged_at_utc").collect()
    )
    logged = {r["file_path"]: r["logged_at_utc"] for r in pending}
    facts, headers = _known_facts(fl.file_facts(spark, list(logged)))
    listed = spark.createDataFrame([(p,) for p in logged], "path string")
    homes = {r["path"]: r for r in resolve_lake_tables(listed, dictionary, source_type).collect()}
    wanted = F.lit(source_type.strip().lower())
    entries = (
        ingest_dictionary(dictionary).where(F.col("source_type") == wanted)
        .select("lake_table_name", normalized(F.col("source_variable_name")).alias("source"),
                F.col("lake_variable_name").alias("lake"))
        .distinct().orderBy("lake_table_name", "lake", "source").collect()
    )
    mappings: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for e in entries:
        mappings[e["lake_table_name"]].append((e["source"], e["lake"]))

    groups: dict[tuple, list[str]] = defaultdict(list)
    results: dict[str, dict] = {}
    notes: dict[str, str] = {}
    for path in logged:
        table = homes[path]["lake_table_name"]
        fact = facts[path]
        problem = fact["problem"] if not fact["found"] else None
        if problem is None and table is None:
            problem = f"no lake table for file under source_type '{source_type}'"
        elif problem is None and not mappings[table]:
            problem = f"no variable mappings for lake table '{table}'"
        if problem:
            results[path] = {"load_status": "error", "lake_table": table, "problem": problem}
            continue
        header = headers[fact["header_id"]]
        if not header:
            results[path] = {"load_status": "error", "lake_table": table, "problem": "empty file"}
            continue
        groups[table, header].append(path)

    for table in {table for table, _ in groups}:  # a repeated run of the batch replaces its own rows
        if lake.exists("raw", table):
            lake.drop_slice("raw", table, {"_ingest_id": ingest_id})
    for (table, header), paths in groups.items():
        years = {p: homes[p]["lab_year"] for p in paths}
        attempts = [paths]
        while attempts:  # a group that fails is halved until the bad files stand alone
            tried = attempts.pop()
            try:
                _load_group(
                    lake, tried, list(header), table, mappings[table], years, ingest_id,
                    csv_options,
                )
                wide = fl.too_wide_lines(spark, tried, len(header), **csv_options).collect()
                lines = {plain_path(unquote(r["_source_file"])): r["lines"] for r in wide}
                for p in tried:
                    results[p] = {"load_status": "success", "lake_table": table}
                    if found := lines.get(plain_path(p)):
                        notes[p] = f"{found} lines hold more fields than the header; these are not loaded"
            except Exception as error:
                if len(tried) == 1:
                    results[tried[0]] = {
                        "load_status": "error", "lake_table": table, "problem": str(error),
                    }
                else:
                    middle = len(tried) // 2
                    attempts.extend((tried[middle:], tried[:middle]))

    counts: dict[str, int] = {}
    for table in {r["lake_table"] for r in results.values() if r["load_status"] == "success"}:
        per_file = (
            lake.read("raw", table).where(F.col("_ingest_id") == ingest_id)
            .groupBy("_source_file").count().collect()
        )
        # The scan gives file names with escapes, as in a url.
        counts.update({plain_path(unquote(r["_source_file"])): r["count"] for r in per_file})
    log = []
    for path, result in results.items():
        fact, good = facts[path], result["load_status"] == "success"
        log.append({
            "path": path, "logged_at": logged[path], **result,
            "file_size_bytes": fact["file_size_bytes"] if good else None,
            "checksum": fact["checksum"] if good else None,
            "row_count": counts.get(plain_path(path), 0) if good else None,
        })
    _write_files(lake, ingest_id, log)

    promotions = []
    loaded = sorted({f["lake_table"] for f in log if f["load_status"] == "success"})
    if type_decisions is not None:
        promotions = [promote_to_staging(lake, t, type_decisions, ingest_id) for t in loaded]

    this_batch = lake.read("governance", "ingest_file_log").where(F.col("ingest_id") == ingest_id)
    closing = batch_status(this_batch).first()
    opened = (
        lake.read("governance", "batch_log").where(F.col("ingest_id") == ingest_id).first()
    )
    problems = "; ".join([
        *[f"{f['path']}: {f['problem']}" for f in log if f.get("problem")],
        *[f"{path}: {note}" for path, note in notes.items()],
    ])
    _write_batch(
        lake, ingest_id, source_id, closing["status"], closing["n_files"], closing["n_success"],
        closing["n_error"], opened["batch_started_at_utc"] if opened else None, problems or None,
    )
    return {
        "ingest_id": ingest_id, "status": closing["status"], "n_files": closing["n_files"],
        "n_success": closing["n_success"], "n_error": closing["n_error"],
        "promotions": promotions,
        "errors": {f["path"]: f["problem"] for f in log if f.get("problem")},
        "notes": notes,
    }


def ingest_folder(
    lake: Lake, folder: str, ingest_id: str, source_id: str, dictionary: DataFrame,
    source_type: str | None = None, type_decisions: DataFrame | None = None, **csv_options,
) -> dict:
    """Ingest every CSV file of a folder as one batch. Without a source type it is the one
    whose dictionary rows name the files (of several, the first by name)."""
    found = fl.discover(lake.spark, folder)
    paths = sorted(plain_path(r["path"]) for r in found.select("path").collect())
    if not paths:
        raise FileNotFoundError(f"no CSV files in {folder}")
    if source_type is None:
        types = derive_source_types(found, dictionary).orderBy("source_type").collect()
        if not types:
            raise ValueError("no dictionary row names one of the files: cannot derive source type")
        source_type = types[0]["source_type"]
    open_batch(lake, ingest_id, source_id, paths)
    return ingest_batch(
        lake, ingest_id, source_id, source_type, dictionary, type_decisions, **csv_options
    )


def aligned(target: DataFrame, df: DataFrame) -> DataFrame:
    """``target`` with the rows of ``df`` below: columns either side lacks are NULL."""
    return target.unionByName(df, allowMissingColumns=True)


def empty_table(spark: SparkSession, expected: DataFrame, lake_table: str) -> DataFrame:
    """An empty table with the columns and types the expected schema describes."""
    rows = expected.where(F.lower("lake_table_name") == lake_table.lower()).collect()
    if not rows:
        raise ValueError(f"no expected schema for lake table '{lake_table}'")
    fields = [
        T.StructField(r["lake_variable_name"], spark_type(r["type_descriptor"] or "text")
                      or T.StringType())
        for r in rows
    ]
    return spark.createDataFrame([], T.StructType(fields))


def create_raw_table(lake: Lake, expected: DataFrame, lake_table: str) -> dict:
    """An empty raw table of the described columns. The first batch loaded into it brings the
    lineage columns and makes it a table of slices."""
    table = lake_table.lower()
    df = empty_table(lake.spark, expected, table)
    status = "exists" if lake.exists("raw", table) else "created"
    if status == "created":
        lake.replace("raw", table, df)
    return {"status": status, "lake_table_name": table, "n_columns": len(df.columns)}
