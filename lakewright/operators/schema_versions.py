"""Published schema versions: from when to when each one holds, and which one a date falls under."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewright.sources.lake import Lake

TABLE = "expected_schema"
_TABLE_KEY = ["table_schema", "lake_table_name"]


def publish_schema(
    lake: Lake, expected: DataFrame, effective_from: datetime.date, effective_to: datetime.date | None = None,
) -> None:
    """Store ``expected_schema``'s rows as the schema that holds from a day on.

    A second publication for the same day takes the place of the first. Without ``effective_to``
    a version holds until the next one.
    """
    if effective_to is not None and effective_to < effective_from:
        raise ValueError(f"effective_to {effective_to} is before effective_from {effective_from}")
    rows = expected.withColumn("effective_to", F.lit(effective_to).cast("date"))
    lake.replace_slice("reference", TABLE, rows, {"effective_from": effective_from.isoformat()})


def published_schemas(lake: Lake) -> DataFrame:
    return lake.read("reference", TABLE).withColumn("effective_from", F.col("effective_from").cast("date"))


def schema_history(published: DataFrame) -> DataFrame:
    """``table_schema``, ``lake_table_name``, ``table_schema_hash``, ``schema_version``, ``effective_from``,
    ``effective_to``: a row for each stretch of days in which a table's schema stayed the same.

    ``published`` has those columns for each publication, any number of rows a table. A publication ends
    at its own ``effective_to`` or the day before the next publication, whichever comes first; a table that
    the next one lacks ends there too. The last stretch is open: its ``effective_to`` is NULL. The
    version is that of the stretch's first publication. A publication without rows is none.
    """
    days = published.where(F.col("effective_from").isNotNull()).select("effective_from").distinct()
    # One row for each publication, whatever the size of the schemas.
    following = days.withColumn("next", F.lead("effective_from").over(Window.orderBy("effective_from")))
    tables = published.groupBy(*_TABLE_KEY, "effective_from").agg(
        F.min(F.struct("schema_version", "table_schema_hash", "effective_to")).alias("of")
    ).select(*_TABLE_KEY, "effective_from", "of.*")
    ended = tables.join(following, "effective_from").withColumn("until", F.least("effective_to", F.date_sub("next", 1)))
    in_order = Window.partitionBy(*_TABLE_KEY).orderBy("effective_from")
    carried_on = (
        F.lag("table_schema_hash").over(in_order).eqNullSafe(F.col("table_schema_hash"))
        & F.coalesce(F.lag("until").over(in_order) == F.date_sub("effective_from", 1), F.lit(False))
    )
    starts = ended.withColumn("starts", F.when(carried_on, 0).otherwise(1))
    stretches = starts.withColumn("stretch", F.sum("starts").over(in_order))
    return stretches.groupBy(*_TABLE_KEY, "stretch").agg(
        F.min_by("schema_version", "effective_from").alias("schema_version"),
        F.first("table_schema_hash").alias("table_schema_hash"),
        F.min("effective_from").alias("effective_from"), F.max_by("until", "effective_from").alias("effective_to"),
    ).drop("stretch")


def schemas_in_force(rows: DataFrame, history: DataFrame, date_column: str) -> DataFrame:
    """All rows with ``schema_version`` and ``table_schema_hash`` of their ``lake_table_name`` on their date;
    NULL where no version holds. With several table schemas a row comes once for each.

    The stretches of a table do not overlap, so the join by table name yields one match a date.
    """
    held = history.select(
        F.col("lake_table_name").alias("_table"), "schema_version", "table_schema_hash",
        F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"),
    )
    on_day = (
        (F.col("lake_table_name") == F.col("_table")) & (F.col(date_column) >= F.col("_from"))
        & (F.col("_to").isNull() | (F.col(date_column) <= F.col("_to")))
    )
    return rows.join(held, on_day, "left").drop("_table", "_from", "_to")
