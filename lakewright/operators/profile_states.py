"""Profiles of growing tables, merged from what each batch has counted.

A state is the frequency table of one batch of one table: how often each column holds each value,
with the value's class, number, placeholder key and date layouts. Counts add up, so the profile of
a table is that of the summed states of its batches: equal to a profile of all rows, without
reading them. A state holds each distinct value of a batch once, long texts as digests.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.profiling import Profiler, cells_by_type, column_catalog, frequencies
from lakewright.operators.settings import profiling_settings
from lakewright.sources.lake import Lake

STATES = "data_profile_state"
LINEAGE = ("_ingest_id", "_source_file")
KEY = ["col_id", "value", "digest", "kind", "number", "key", "layouts"]


def basis(settings: dict) -> str:
    """What of the settings a state depends on, as a short digest."""
    text = json.dumps(settings["sentinel_detection"], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def _columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """The columns of the tables with the types they have now."""
    rows = [
        (t, f.name, f.dataType.simpleString(), f.dataType.typeName() == "string")
        for t, df in tables.items() for f in df.schema.fields
    ]
    return spark.createDataFrame(
        rows, "table_name string, variable_name string, data_type string, is_text boolean"
    )


def state_of(tables: dict[str, DataFrame], settings: dict | str | None = None) -> DataFrame:
    """The state of one batch: ``table_name``, ``variable_name``, ``data_type``, ``basis`` and the
    frequencies of the cells."""
    settings = profiling_settings(settings)
    spark = next(iter(tables.values())).sparkSession
    catalog = column_catalog(tables, settings)
    names = [(c["col_id"], c["table_name"], c["variable_name"]) for c in catalog]
    listed = spark.createDataFrame(names, "col_id int, table_name string, variable_name string")
    typed = listed.join(_columns(spark, tables).drop("is_text"), ["table_name", "variable_name"])
    counted = frequencies(cells_by_type(tables, catalog), settings)
    return counted.join(F.broadcast(typed), "col_id").drop("col_id").withColumn("basis", F.lit(basis(settings)))


def merged(states: DataFrame, tables: dict[str, DataFrame], settings: dict) -> DataFrame:
    """Frequencies of all batches in ``states`` (with ``ingest_id``) by the tables' column ids. A column
    that a batch does not have yet is NULL in all of its rows."""
    spark = states.sparkSession
    names = [(c["table_name"], c["variable_name"], c["col_id"]) for c in column_catalog(tables, settings)]
    ids = spark.createDataFrame(names, "table_name string, variable_name string, col_id int")
    known = states.join(F.broadcast(ids), ["table_name", "variable_name"])
    held = states.groupBy("table_name", "ingest_id", "variable_name").agg(F.sum("n").alias("n"))
    sizes = held.groupBy("table_name", "ingest_id").agg(F.max("n").alias("n"))
    gaps = (
        sizes.join(ids, "table_name")
        .join(held.drop("n"), ["table_name", "ingest_id", "variable_name"], "left_anti")
    )
    text, none = F.lit(None).cast("string"), F.lit(None)
    empty = gaps.select(
        "col_id", text.alias("value"), text.alias("digest"), "n", F.lit("na").alias("kind"),
        none.cast("double").alias("number"), text.alias("key"), F.lit(0).alias("layouts"),
    )
    both = known.select(*empty.columns).unionByName(empty)
    return both.groupBy(*KEY).agg(F.sum("n").alias("n"))


def profile_of_states(
    states: DataFrame, tables: dict[str, DataFrame], settings: dict | str | None = None, **options
) -> Profiler:
    """A profile of the tables from their batches' states. Text columns are read only where a long
    text may be among the most frequent values."""
    settings = profiling_settings(settings)
    return Profiler(tables, settings, freq=merged(states, tables, settings), **options)


def _stale(lake: Lake, zone: str, tables: dict[str, DataFrame], used: str) -> set[tuple[str, str]]:
    """(table, batch) whose stored state was made on another basis or for other types."""
    if not lake.exists("governance", STATES):
        return set()
    now = _columns(lake.spark, tables).withColumnRenamed("data_type", "now")
    made = (
        lake.read("governance", STATES)
        .where((F.col("schema_name") == zone) & F.col("table_name").isin(*tables))
        .select("table_name", "ingest_id", "variable_name", "data_type", "basis").distinct()
    )
    changed = made.join(F.broadcast(now), ["table_name", "variable_name"]).where(
        (F.col("data_type") != F.col("now")) | (F.col("basis") != used)
    )
    return {(r[0], r[1]) for r in changed.select("table_name", "ingest_id").distinct().collect()}


def refresh_states(
    lake: Lake, zone: str, names: list[str], ingest_id: str, settings: dict | str | None = None
) -> list[str]:
    """Store the state of a batch, and of earlier batches that have none that still fits. Only the
    slices of these batches are read. Returns the batches counted."""
    settings = profiling_settings(settings)
    key, lineage = ("ingest_id", ()) if zone == "validated" else ("_ingest_id", LINEAGE)
    tables = {n: lake.read(zone, n).drop(*lineage) for n in names}
    stored = {
        (s["table_name"], s["ingest_id"]) for s in lake.slices("governance", STATES)
        if s["schema_name"] == zone
    } - _stale(lake, zone, tables, basis(settings))
    todo: dict[str, dict[str, DataFrame]] = {}
    for name in names:
        for batch in sorted({s[key] for s in lake.slices(zone, name)}):
            if batch == ingest_id or (name, batch) not in stored:
                rows = lake.read(zone, name).where(F.col(key) == batch).drop(*lineage)
                todo.setdefault(batch, {})[name] = rows
    for batch, parts in todo.items():
        lake.replace_slices(
            "governance", STATES, state_of(parts, settings),
            {"schema_name": zone, "ingest_id": batch}, "table_name", list(parts),
        )
    return list(todo)


def stored_states(lake: Lake, zone: str, names: list[str]) -> DataFrame:
    """The states of the batches that the tables hold now."""
    key = "ingest_id" if zone == "validated" else "_ingest_id"
    batches = {n: sorted({s[key] for s in lake.slices(zone, n)}) for n in names}
    here = reduce(lambda a, b: a | b, [
        (F.col("table_name") == n) & F.col("ingest_id").isin(*ids) for n, ids in batches.items()
    ])
    return lake.read("governance", STATES).where((F.col("schema_name") == zone) & here)
