"""Distinct values of named columns, per table and consolidated."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.functions.text import as_text

RESULT_SCHEMA = (
    "variable_name string, table_name string, unique_count bigint, unique_values string, "
    "status string"
)


def distinct_values(
    tables: dict[str, DataFrame], wanted: list[tuple[str, str]], max_values: int = 50,
    shown: int = 20, zone: str = "raw",
) -> DataFrame:
    """Sorted distinct values of (variable, table) pairs. A column of more than
    ``max_values`` values is unconstrained and shows its first ones; a column without values
    or without a table is reported as such.

    Values are made distinct before anything is collected, and only the first values of a
    column (never more than ``max_values`` + 1) are gathered into one list.
    """
    spark = next(iter(tables.values())).sparkSession
    absent, parts = [], []
    for variable, table in wanted:
        df = tables.get(table)
        if df is None or variable not in df.columns:
            absent.append((variable, f"{zone}.{table}", None, None, "column_not_found"))
            continue
        parts.append((variable, table))
    results = [spark.createDataFrame(absent, RESULT_SCHEMA)] if absent else []
    if parts:
        results.append(_listed(spark, tables, parts, max_values, shown, zone))
    return reduce(DataFrame.unionByName, results)


def _listed(
    spark: SparkSession, tables: dict[str, DataFrame], pairs: list[tuple[str, str]],
    max_values: int, shown: int, zone: str,
) -> DataFrame:
    per_table: dict[str, list[str]] = {}
    for variable, table in pairs:
        per_table.setdefault(table, []).append(variable)
    cells = []
    for table, variables in per_table.items():
        df = tables[table]
        types = {f.name: f.dataType for f in df.schema.fields}
        texts = [as_text(F.col(f"`{v}`"), types[v]).alias(v) for v in variables]
        entries = F.array(*[
            F.struct(F.lit(v).alias("variable_name"), t.alias("value"))
            for v, t in zip(variables, texts)
        ])
        cells.append(
            df.select(F.explode(entries).alias("e"))
            .select("e.variable_name", F.lit(f"{zone}.{table}").alias("table_name"), "e.value")
        )
    key = ["variable_name", "table_name"]
    values = reduce(DataFrame.unionByName, cells).where(F.col("value").isNotNull()).distinct()
    order = Window.partitionBy(*key).orderBy("value")
    first = (
        values.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= max(max_values, shown))
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list("value")).alias("listed"))
    )
    counts = values.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    asked = spark.createDataFrame(
        [(v, f"{zone}.{t}") for v, t in pairs], "variable_name string, table_name string"
    )
    n = F.coalesce(F.col("n"), F.lit(0))
    many = n > max_values
    head = F.concat_ws(", ", F.slice("listed", 1, shown))
    note = F.concat(F.lit(" ... ("), n.cast("string"), F.lit(" total - UNCONSTRAINED)"))
    return (
        F.broadcast(asked).join(counts, key, "left").join(first, key, "left")
        .select(
            *key,
            n.alias("unique_count"),
            F.when(n == 0, "(all null)").when(many, F.concat(head, note))
            .otherwise(F.concat_ws(", ", "listed")).alias("unique_values"),
            F.when(n == 0, "all_null").when(many, "unconstrained").otherwise("ok")
            .alias("status"),
        )
    )


def consolidated(results: DataFrame) -> DataFrame:
    """One row per variable: its tables, value counts and value lists joined."""
    rows = F.sort_array(F.collect_list(F.struct("table_name", "unique_values")))
    return (
        results.where(F.col("status").isin("ok", "unconstrained"))
        .groupBy("variable_name")
        .agg(rows.alias("rows"), F.sum("unique_count").alias("total_unique_count"))
        .select(
            "variable_name",
            F.concat_ws("; ", "rows.table_name").alias("tables"),
            "total_unique_count",
            F.concat_ws(" | ", "rows.unique_values").alias("all_values"),
        )
    )


def export_values(results: DataFrame, path: str) -> str:
    results.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
