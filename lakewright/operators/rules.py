"""Row-level quality rules, alone and over a lake, and the reshaping of hourly crosstabs."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.text import as_text, to_number
from lakewright.sources.lake import Lake

# The rules a library starts with.
SEED_RULES = [
    ("RANGE_AGE_001", "Age non-negative", "Age must be zero or positive", "range", "error",
     "age >= 0"),
    ("REQ_PATID_001", "Required patient_id", "patient_id must not be NULL", "required", "error",
     "NOT ISNULL(patient_id)"),
    ("RANGE_HR_001", "Heart rate reasonable", "HR must be between 20 and 250", "range",
     "warning", "heart_rate BETWEEN 20 AND 250"),
]
RULE_SCHEMA = (
    "rule_id string, rule_name string, rule_description string, rule_category string, "
    "rule_severity string, rule_expression string"
)
LIBRARY_SCHEMA = f"{RULE_SCHEMA}, target_table string, is_active boolean"
RESULT_COLUMNS = [
    "rule_id", "rule_category", "rule_severity", "table_name", "status", "checked_count",
    "pass_count", "fail_count", "undecided_count", "error_message",
]


def rule_results(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Rows checked, passed, failed and undecided (predicate NULL) per rule, all rules in one
    pass over the table."""
    measures = []
    for i, rule in enumerate(rules):
        holds = F.expr(rule["rule_expression"])
        measures += [
            F.count_if(holds).alias(f"pass_{i}"),
            F.count_if(~holds).alias(f"fail_{i}"),
        ]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *measures)
    entries = F.array(*[
        F.struct(
            F.lit(r["rule_id"]).alias("rule_id"),
            F.lit(r.get("rule_category")).alias("rule_category"),
            F.lit(r.get("rule_severity")).alias("rule_severity"),
            F.col("rows").alias("checked_count"),
            F.col(f"pass_{i}").alias("pass_count"),
            F.col(f"fail_{i}").alias("fail_count"),
            (F.col("rows") - F.col(f"pass_{i}") - F.col(f"fail_{i}")).alias("undecided_count"),
        )
        for i, r in enumerate(rules)
    ])
    return counted.select(F.inline(entries))


def rule_violations(df: DataFrame, rules: list[dict], keys: list[str]) -> DataFrame:
    """The keys of rows that break a rule, one row per broken rule."""
    broken = F.array_compact(F.array(*[
        F.when(~F.expr(r["rule_expression"]), F.struct(
            F.lit(r["rule_id"]).alias("rule_id"),
            F.lit(r.get("rule_severity")).alias("rule_severity"),
        ))
        for r in rules
    ]))
    return df.select(*keys, F.explode(broken).alias("b")).select(*keys, "b.*")


def bound_checks(df: DataFrame, bounds: list[dict]) -> DataFrame:
    """Values outside the dictionary's range or allowed list, per variable, in one pass.
    ``bounds`` are dictionary rows with ``lake_variable_name, valid_min, valid_max,
    allowed_values`` (comma-separated)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [b for b in bounds if b["lake_variable_name"] in types]
    measures = []
    for i, b in enumerate(present):
        text = as_text(F.col(f"`{b['lake_variable_name']}`"), types[b["lake_variable_name"]])
        number = to_number(text)
        low, high = b.get("valid_min"), b.get("valid_max")
        allowed = [v.strip() for v in (b.get("allowed_values") or "").split(",") if v.strip()]
        measures += [
            F.count(text).alias(f"n_{i}"),
            F.count_if(number < low if low is not None else F.lit(False)).alias(f"low_{i}"),
            F.count_if(number > high if high is not None else F.lit(False)).alias(f"high_{i}"),
            F.count_if(~text.isin(allowed) if allowed else F.lit(False)).alias(f"list_{i}"),
        ]
    counted = df.agg(*measures)
    entries = F.array(*[
        F.struct(
            F.lit(b["lake_variable_name"]).alias("variable_name"),
            F.col(f"n_{i}").alias("value_count"),
            F.col(f"low_{i}").alias("below_min_count"),
            F.col(f"high_{i}").alias("above_max_count"),
            F.col(f"list_{i}").alias("not_allowed_count"),
        )
        for i, b in enumerate(present)
    ])
    return counted.select(F.inline(entries))


def hourly_long(df: DataFrame, ids: list[str], pattern: str = r"^(.+)_(\d+)$") -> DataFrame:
    """A crosstab with columns such as ``prbc_0 … prbc_23`` as rows (ids, product_type, hour,
    units); hours without units are left out."""
    import re

    wide = [c for c in df.columns if c not in ids and re.match(pattern, c)]
    cells = F.array(*[
        F.struct(
            F.lit(re.match(pattern, c).group(1)).alias("product_type"),
            F.lit(int(re.match(pattern, c).group(2))).alias("hour"),
            F.col(f"`{c}`").alias("units"),
        )
        for c in wide
    ])
    return df.select(*ids, F.inline(cells)).where(F.col("units").isNotNull())


def seed_rules(spark: SparkSession) -> DataFrame:
    """The rules a library starts with; they hold for every table that has their columns."""
    return spark.createDataFrame([(*r, None, True) for r in SEED_RULES], LIBRARY_SCHEMA)


def _resolves(df: DataFrame, rule: dict) -> str | None:
    """What is wrong with a rule's expression for this table, found without a job."""
    try:
        holds = df.select(F.expr(rule["rule_expression"]).alias("holds"))
        kind = holds.schema["holds"].dataType.typeName()
    except AnalysisException as error:
        return str(error)
    except PySparkException as error:  # the expression cannot be read at all
        return str(error)
    return None if kind == "boolean" else f"the expression gives {kind}, not boolean"


def _tried(df: DataFrame, rules: list[dict]) -> tuple[list[dict], list[tuple[dict, str]]]:
    """Results of rules in one pass. Where it fails the rules are halved, so that one that cannot
    be computed on these rows stands alone."""
    if not rules:
        return [], []
    try:
        return [r.asDict() for r in rule_results(df, rules).collect()], []
    except PySparkException as error:
        if len(rules) == 1:
            return [], [(rules[0], str(error))]
    middle = len(rules) // 2
    (good, bad), (more, worse) = _tried(df, rules[:middle]), _tried(df, rules[middle:])
    return good + more, bad + worse


def run_rules(
    lake: Lake, ingest_id: str, zone: str = "staging", tables: list[str] | None = None,
    keys: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Apply the active rules of ``governance.rule_library`` to a batch's rows.

    Each table is read once for the counts of all its rules and once for the rows that break
    them. A rule without ``target_table`` holds for the tables that have its columns; a rule that
    names a table and does not fit it, or cannot be computed, is an error of its own. Counts go to
    ``governance.rule_result``, the keys of broken rows (as JSON; without ``keys`` the whole row) to
    ``governance.rule_violation``; a rerun replaces the batch's. Returns the counts.
    """
    spark = lake.spark
    batch_key = "ingest_id" if zone == "validated" else "_ingest_id"
    library = [r.asDict() for r in lake.read("governance", "rule_library").where("is_active").collect()]
    library.sort(key=lambda r: r["rule_id"])
    held = tables if tables is not None else [
        t for t in lake.tables(zone) if any(s[batch_key] == ingest_id for s in lake.slices(zone, t))
    ]
    rows: list[tuple] = []
    broken: list[DataFrame] = []
    for table in held:
        df = lake.read(zone, table).where(F.col(batch_key) == ingest_id)
        wrong, fitting = [], []
        for rule in library:
            if rule["target_table"] not in (None, table):
                continue
            problem = _resolves(df, rule)
            if problem is None:
                fitting.append(rule)
            elif rule["target_table"] is not None:
                wrong.append((rule, problem))
        good, bad = _tried(df, fitting)
        for r in good:
            rows.append((
                r["rule_id"], r["rule_category"], r["rule_severity"], table, "done", r["checked_count"],
                r["pass_count"], r["fail_count"], r["undecided_count"], None,
            ))
        for rule, problem in wrong + bad:
            rows.append((
                rule["rule_id"], rule["rule_category"], rule["rule_severity"], table, "error",
                None, None, None, None, problem,
            ))
        failed = {r["rule_id"] for r in good if r["fail_count"]}
        if failed:
            own = (keys or {}).get(table) or [c for c in df.columns if c != batch_key]
            keyed = df.withColumn("row_key", F.to_json(F.struct(*[F.col(f"`{c}`") for c in own])))
            rules = [r for r in fitting if r["rule_id"] in failed]
            broken.append(rule_violations(keyed, rules, ["row_key"]).withColumn("table_name", F.lit(table)))
    schema = (
        "rule_id string, rule_category string, rule_severity string, table_name string, "
        "status string, checked_count bigint, pass_count bigint, fail_count bigint, "
        "undecided_count bigint, error_message string"
    )
    slice_of = {"ingest_id": ingest_id, "schema_name": zone}
    none = spark.createDataFrame([], "row_key string, rule_id string, rule_severity string, table_name string")
    lake.replace_slice("governance", "rule_violation", reduce(DataFrame.unionByName, broken, none), slice_of)
    lake.replace_slice("governance", "rule_result", spark.createDataFrame(rows, schema).coalesce(1), slice_of)
    mine = (F.col("ingest_id") == ingest_id) & (F.col("schema_name") == zone)
    return lake.read("governance", "rule_result").where(mine).select(*RESULT_COLUMNS)
