"""Queries on lakes that are made of the test tables: slices, promotion, ingestion, harmonization
and profiles by batch, with their checks. Each run has databases and a folder of its own."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.text import as_text
from lakewright.operators import harmonization as har
from lakewright.operators import ingestion as ing
from lakewright.operators import rules as rl
from lakewright.operators import schema_versions as sv
from lakewright.operators.deidentify import DeidRules, deidentify
from lakewright.operators.profile_states import profile_of_states, refresh_states, stored_states
from lakewright.operators.profiling import Profiler
from lakewright.queries import profiling as pq
from lakewright.queries.common import derive, load
from lakewright.session import shared_folder
from lakewright.sources import files as fl
from lakewright.sources.lake import Lake


def new_lake(spark: SparkSession) -> Lake:
    name = f"q{uuid.uuid4().hex[:12]}_"
    return Lake(spark, name, f"{shared_folder(spark)}/lake-{name}")


def _slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority: one slice made of itself, one emptied, one whose rerun fails."""
    lake = new_lake(spark)
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    lake.append("governance", "orders", orders, ("o_orderpriority",))

    def replace(priority: str, df: DataFrame) -> None:
        lake.replace_slice("governance", "orders", df, {"o_orderpriority": priority})

    def held(priority: str) -> DataFrame:
        rows = lake.read("governance", "orders").where(F.col("o_orderpriority") == priority)
        return rows.drop("o_orderpriority")

    replace("1-URGENT", held("1-URGENT").where("o_orderkey % 2 = 0").withColumn("note", F.lit("even")))
    replace("3-MEDIUM", held("3-MEDIUM").limit(0))
    try:
        replace("2-HIGH", held("2-HIGH").withColumn("o_totalprice", F.expr("double(concat(o_totalprice, ' USD'))")))
    except PySparkException:
        pass  # the point of the query: earlier rows must stand
    else:
        raise AssertionError("a failing job must not replace a slice")
    replace("9-NEW", held("5-LOW"))
    return lake.read("governance", "orders").select("o_orderkey", "o_totalprice", "note", "o_orderpriority")


_SLICES_SQL = """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderpriority = '1-URGENT' THEN 'even' END AS note, o_orderpriority
FROM orders WHERE o_orderpriority <> '3-MEDIUM' AND (o_orderpriority <> '1-URGENT' OR o_orderkey % 2 = 0)
UNION ALL SELECT o_orderkey, o_totalprice, NULL, '9-NEW' FROM orders WHERE o_orderpriority = '5-LOW'"""


# Orders as text, by the year's half as batches.
RAW_BATCHES = """
SELECT CAST(o_orderkey AS STRING) AS order_key, ' ' || CAST(o_custkey AS STRING) || ' ' AS customer_key,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS total_price,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
  o_orderstatus AS status, CAST(NULL AS STRING) AS _source_file,
  CASE WHEN EXTRACT(MONTH FROM o_orderdate) < 7 THEN 'I1' ELSE 'I2' END AS _ingest_id
FROM {orders}
"""


def _promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches promoted one after the other, the second as a slice of its own."""
    lake = new_lake(spark)
    raw = derive(spark, sf_dir, RAW_BATCHES)
    decisions = spark.createDataFrame(
        [("orders", "order_key", "BIGINT", None), ("orders", "customer_key", "INTEGER", None),
         ("orders", "total_price", "NUMERIC(12,2)", None), ("orders", "order_date", "TEXT", "DATE")],
        "table_name string, variable string, suggested_type string, final_type string")
    modes = []
    for batch in ("I1", "I2"):
        rows = raw.where(F.col("_ingest_id") == batch).drop("_ingest_id")
        lake.replace_slice("raw", "orders", rows, {"_ingest_id": batch})
        done = ing.promote_to_staging(lake, "orders", decisions, batch)
        modes.append((done["status"], done["mode"]))
    if modes != [("promoted", "table"), ("promoted", "slices")]:
        raise AssertionError(modes)
    return lake.read("staging", "orders").select(
        "order_key", "customer_key", F.col("total_price").cast("double").alias("total_price"),
        "order_date", "status", F.col("_ingest_id").alias("batch"))


_PROMOTIONS_SQL = """
SELECT o_orderkey AS order_key, CAST(o_custkey AS INTEGER) AS customer_key,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_price,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS order_date, o_orderstatus AS status,
  CASE WHEN month(o_orderdate) < 7 THEN 'I1' ELSE 'I2' END AS batch FROM orders"""


# Columns of the domain table by source: column, target, transform, expression.
PARTY_MAP = {
    ("CRM", "customer"): [
        ("c_custkey", "party_key", "direct", None), ("c_name", "party_name", "rename", None),
        ("c_acctbal", "balance", "expression", "CAST(c_acctbal AS DECIMAL(18,2))"),
        (None, "kind", "constant", "customer")],
    ("ERP", "supplier"): [
        ("s_suppkey", "party_key", "rename", None), ("s_name", "party_name", "rename", None),
        ("s_acctbal", "balance", "expression", "CAST(s_acctbal AS DECIMAL(18,2))"),
        (None, "kind", "constant", "supplier")],
    ("ERP", "nation"): [("n_nationkey", "party_key", "rename", None)],
}


def _harmonized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties of one batch, made twice. In the second run customers fail and keep their rows,
    suppliers are fewer and nations are no longer mapped."""
    lake = new_lake(spark)
    for _, table in PARTY_MAP:
        df = load(spark, sf_dir, table)
        lake.replace_slice("staging", table, df, {"_ingest_id": "I1"})
        lake.replace_slice("staging", table, df, {"_ingest_id": "I2"})
    lake.replace_slice("governance", "batch_log", spark.createDataFrame([("success",)], "status string"), {"ingest_id": "I1"})
    schema = ("source_type string, source_table string, source_column string, target_table string, target_column string, "
              "transform_type string, transform_expression string, is_active boolean, priority int, notes string")
    lines = [(*source, c, "party", t, k, e, None, None, None) for source, ms in PARTY_MAP.items() for c, t, k, e in ms]
    metadata = [(*source, c or f"_{t}", "party", t, {"party_key": "BIGINT", "balance": "NUMERIC(18,2)"}.get(t), True, False)
                for source, ms in PARTY_MAP.items() for c, t, *_ in ms]
    lake.replace("reference", "metadata", spark.createDataFrame(
        metadata, "source_type string, lake_table_name string, lake_variable_name string, validated_table_target string, "
        "validated_variable_name string, target_type string, is_active boolean, is_identifier boolean"))

    def run(map_lines: list[tuple], failed: int) -> None:
        lake.replace("reference", "harmonization_map", har.merged_mappings(
            spark.createDataFrame([], har.MAP_SCHEMA),
            spark.createDataFrame([(*m[:7], True, 100, None) for m in map_lines], schema)))
        done = har.harmonize_data(lake, "I1")
        log = lake.read("governance", "transform_log").where("status = 'failed'").count()
        if log != failed:
            raise AssertionError((done, log))

    run(lines, 0)
    lake.replace_slice("staging", "supplier", load(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0"), {"_ingest_id": "I1"})
    broken = [(*m[:6], "raise_error('no balance')", *m[7:]) if m[1] == "customer" and m[4] == "balance" else m for m in lines]
    run([m for m in broken if m[1] != "nation"], 1)
    rows = lake.read("validated", "party")
    return rows.select("source_type", "source_table", "ingest_id", "party_key", "party_name",
                       F.col("balance").cast("double").alias("balance"), "kind")


_HARMONIZED_SQL = """
SELECT 'CRM' AS source_type, 'customer' AS source_table, 'I1' AS ingest_id, CAST(c_custkey AS BIGINT) AS party_key, c_name AS party_name,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance, 'customer' AS kind FROM customer
UNION ALL SELECT 'ERP', 'supplier', 'I1', s_suppkey, s_name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE), 'supplier'
FROM supplier WHERE s_suppkey % 3 = 0"""


def _states(spark: SparkSession, sf_dir: str, names: list[str]) -> Profiler:
    """Tables loaded in three batches, each counted when it comes; the profile is that of the
    batches' states."""
    lake = new_lake(spark)
    for number in range(3):
        for name, df in pq.tables(spark, sf_dir, names).items():
            text = F.concat_ws("|", *[as_text(F.col(c), t.dataType) for c, t in zip(df.columns, df.schema.fields)])
            batch = df.where(F.crc32(text.cast("binary")) % 3 == number)
            lake.replace_slice("raw", name, batch, {"_ingest_id": f"I{number}"})
        counted = refresh_states(lake, "raw", names, f"I{number}")
        if counted != [f"I{number}"]:
            raise AssertionError(f"batches counted again: {counted}")
    tables = {n: lake.read("raw", n).drop("_ingest_id") for n in names}
    return profile_of_states(stored_states(lake, "raw", names), tables)


MERGED = ["raw_orders", "customer", "conversations"]


def _merged_tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _states(spark, sf_dir, MERGED).tops().where(F.col("inferred_type") != "numeric")
    return rows.select("table_name", "variable_name", "value_rank", "value", "n", "pct")


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV files, ingested as one batch and read back from the raw table, with
    what the log says of the batch."""
    lake = new_lake(spark)
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_orderstatus").alias("Status"),
        F.concat(F.lit('a, "'), F.col("o_orderpriority"), F.lit('"\nb')).alias("Priority (Y/N)"))
    orders.repartition(4, "Order Key").write.options(header=True, escape='"').csv(folder)
    bases = [r[0] for r in fl.discover(spark, folder).select(fl.base_name(F.col("path"))).collect()]
    dictionary = spark.createDataFrame(
        [("WEB", base, source, "orders", name) for base in bases
         for source, name in (("Order Key", "order_key"), ("Status", "status"), ("Priority (Y/N)", "priority"))],
        "source_type string, source_table_name string, source_variable_name string, lake_table_name string, lake_variable_name string")
    ing.ingest_folder(lake, folder, "I1", "SRC", dictionary)
    log = lake.read("governance", "ingest_file_log").where("load_status = 'success'").agg(
        F.sum("row_count").alias("logged_rows"), F.count_distinct("checksum").alias("logged_files"))
    raw = lake.read("raw", "orders").select("order_key", "status", "priority", F.col("_ingest_id").alias("batch"))
    return raw.join(F.broadcast(log), F.lit(True))


_INGESTED_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status, 'a, "' || o_orderpriority || '"' || chr(10) || 'b' AS priority,
  'I1' AS batch, count(*) OVER () AS logged_rows, CAST(4 AS BIGINT) AS logged_files FROM orders"""

RULES = [
    ("QTY", "range", "error", "l_quantity > 5", "lineitem"),
    ("SHIP", "order", "warning", "CASE WHEN l_returnflag <> 'A' THEN l_linenumber < 4 END", "lineitem"),
    ("STATUS", "list", "warning", "o_orderstatus IN ('F', 'O')", None),
    ("LOST", "range", "error", "no_such_column > 1", "orders"),
    ("BROKEN", "range", "error", "o_orderkey >", "orders"),
    ("NUMBER", "range", "error", "o_orderkey + 1", "orders"),
    ("CAST", "range", "error", "int(o_orderpriority) > 1", "orders"),
    ("OFF", "range", "error", "o_orderkey > 1", "customer"),
]


def _rules(spark: SparkSession, sf_dir: str, violations: bool) -> DataFrame:
    """Rules of a library over a batch, broken ones among good ones."""
    lake = new_lake(spark)
    for table in ("lineitem", "orders"):
        lake.replace_slice("staging", table, load(spark, sf_dir, table), {"_ingest_id": "I1"})
        lake.replace_slice("staging", table, load(spark, sf_dir, table), {"_ingest_id": "I2"})
    lake.replace("governance", "rule_library", spark.createDataFrame(
        [(i, i, None, c, s, e, t, True) for i, c, s, e, t in RULES], rl.LIBRARY_SCHEMA))
    found = rl.run_rules(lake, "I2", keys={"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"]})
    if violations:
        rows = lake.read("governance", "rule_violation")
        return rows.groupBy("table_name", "rule_id", "rule_severity", "row_key").agg(F.count(F.lit(1)).alias("n"))
    return found.drop("error_message")


_RULES_SQL = """
SELECT 'QTY' AS rule_id, 'range' AS rule_category, 'error' AS rule_severity, 'lineitem' AS table_name, 'done' AS status,
  count(*) AS checked_count, count(*) FILTER (l_quantity > 5) AS pass_count, count(*) FILTER (NOT l_quantity > 5) AS fail_count,
  count(*) FILTER (l_quantity IS NULL) AS undecided_count FROM lineitem
UNION ALL SELECT 'SHIP', 'order', 'warning', 'lineitem', 'done', count(*), count(*) FILTER (l_returnflag <> 'A' AND l_linenumber < 4),
  count(*) FILTER (l_returnflag <> 'A' AND l_linenumber >= 4), count(*) FILTER (l_returnflag = 'A') FROM lineitem
UNION ALL SELECT 'STATUS', 'list', 'warning', 'orders', 'done', count(*), count(*) FILTER (o_orderstatus IN ('F', 'O')),
  count(*) FILTER (o_orderstatus NOT IN ('F', 'O')), count(*) FILTER (o_orderstatus IS NULL) FROM orders
UNION ALL SELECT id, 'range', 'error', 'orders', 'error', NULL, NULL, NULL, NULL
FROM (VALUES ('LOST'), ('BROKEN'), ('NUMBER'), ('CAST')) AS v(id)"""
_BROKEN_SQL = """
SELECT table_name, rule_id, rule_severity, row_key, count(*) AS n FROM (
SELECT 'lineitem' AS table_name, 'QTY' AS rule_id, 'error' AS rule_severity,
  '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}' AS row_key FROM lineitem WHERE NOT l_quantity > 5
UNION ALL SELECT 'lineitem', 'SHIP', 'warning', '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}'
FROM lineitem WHERE l_returnflag <> 'A' AND l_linenumber >= 4
UNION ALL SELECT 'orders', 'STATUS', 'warning', '{"o_orderkey":' || o_orderkey || '}' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
) GROUP BY ALL"""

# Identifiers beyond what doubles hold, with leading zeros, and birth dates in every layout.
PEOPLE = """
SELECT c_custkey AS k, CAST(9007199254740993 + c_custkey AS STRING) AS mrn, '00' || CAST(c_custkey AS STRING) AS accountnumber,
  CASE c_custkey % 8 WHEN 0 THEN '1980-2-3' WHEN 1 THEN '1980/02/03 10:00' WHEN 2 THEN '2/3/1980' WHEN 3 THEN '02-03-1980'
       WHEN 4 THEN '3-FEB-1980' WHEN 5 THEN '19800203' WHEN 6 THEN 'spring' ELSE NULL END AS dob
FROM {customer}
"""


def _exact_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = DeidRules(salt="s", id_offsets={"MRN": 111111, "Account Number": 222222}, id_columns=["MRN", "Account Number"],
                      stable_keys=[], shift_days=(40, 40), exact_ids=True)
    return deidentify(derive(spark, sf_dir, PEOPLE), rules)


_EXACT_IDS_SQL = """
SELECT c_custkey AS k, CAST(9007199254740993 + c_custkey + 111111 AS VARCHAR) AS mrn, CAST(c_custkey + 222222 AS VARCHAR) AS accountnumber,
  CASE WHEN c_custkey % 8 < 6 THEN DATE '1980-03-14' END AS dob FROM customer"""

# Three publications of the brands' tables: one unchanged in the second, one missing there, one changed each time.
VERSIONS = """
SELECT 'lake' AS table_schema, lower(p_brand) AS lake_table_name, p_partkey AS part, {version} AS schema_version,
  CASE WHEN {version} = '1' OR ({version} = '2' AND p_brand = 'Brand#1') THEN 'a'
       WHEN {version} = '3' AND p_brand = 'Brand#4' THEN 'c' ELSE 'b' END AS table_schema_hash
FROM part WHERE NOT ({version} = '2' AND p_brand = 'Brand#2')
"""
_DAYS = {"1": (date(1993, 1, 1), None), "2": (date(1994, 7, 1), date(1995, 6, 30)), "3": (date(1996, 1, 1), None)}


def _schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    for version in ("2", "1", "3", "2"):  # in any order; a repeated one takes its own place
        expected = spark.sql(VERSIONS.replace("FROM part", "FROM {part}").replace("{version}", f"'{version}'"), part=load(spark, sf_dir, "part"))
        sv.publish_schema(lake, expected, *_DAYS[version])
    return sv.schema_history(sv.published_schemas(lake))


def _schemas_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.concat(F.lit("brand#"), F.col("o_custkey") % 6).alias("lake_table_name"))
    return sv.schemas_in_force(rows, _schema_history(spark, sf_dir), "day")


_PUBLISHED = " UNION ALL ".join(
    f"SELECT *, DATE '{start}' AS f, {'DATE ' + repr(str(end)) if end else 'CAST(NULL AS DATE)'} AS t FROM ("
    + VERSIONS.replace("{version}", f"'{version}'") + ")" for version, (start, end) in _DAYS.items())
_HISTORY_SQL = f"""
WITH p AS (SELECT table_schema, lake_table_name, table_schema_hash, schema_version, f, t FROM ({_PUBLISHED}) GROUP BY ALL),
d AS (SELECT f, lead(f) OVER (ORDER BY f) AS next FROM (SELECT DISTINCT f FROM p)),
e AS (SELECT p.*, CASE WHEN t IS NULL THEN next - 1 WHEN next IS NULL THEN t ELSE least(t, next - 1) END AS until FROM p JOIN d USING (f)),
s AS (SELECT *, CASE WHEN lag(table_schema_hash) OVER w = table_schema_hash AND lag(until) OVER w = f - 1 THEN 0 ELSE 1 END AS starts
      FROM e WINDOW w AS (PARTITION BY lake_table_name ORDER BY f)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY lake_table_name ORDER BY f) AS stretch FROM s)
SELECT table_schema, lake_table_name, arg_min(schema_version, f) AS schema_version, table_schema_hash, min(f) AS effective_from,
  arg_max_null(until, f) AS effective_to FROM g GROUP BY table_schema, lake_table_name, stretch, table_schema_hash"""
_IN_FORCE_SQL = f"""
WITH h AS ({_HISTORY_SQL}),
o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, 'brand#' || (o_custkey % 6) AS lake_table_name FROM orders)
SELECT o.*, h.schema_version, h.table_schema_hash FROM o LEFT JOIN h
ON o.lake_table_name = h.lake_table_name AND day >= effective_from AND (effective_to IS NULL OR day <= effective_to)"""

QUERIES = {
    "schema_history": (_schema_history, _HISTORY_SQL),
    "schemas_in_force": (_schemas_in_force, _IN_FORCE_SQL),
    "lake_rule_results": (lambda s, d: _rules(s, d, False), _RULES_SQL),
    "lake_rule_violations": (lambda s, d: _rules(s, d, True), _BROKEN_SQL),
    "deid_exact_ids": (_exact_ids, _EXACT_IDS_SQL),
    "slice_replacement": (_slices, _SLICES_SQL),
    "promoted_batches": (_promotions, _PROMOTIONS_SQL),
    "ingested_files": (_ingested, _INGESTED_SQL),
    "harmonized_lake": (_harmonized, _HARMONIZED_SQL),
    "merged_profile": (
        lambda s, d: pq._bare(_states(s, d, MERGED).profile()), pq.profile_sql(MERGED, pq._PROFILE)),
    "merged_distributions": (_merged_tops, pq.profile_sql(MERGED, pq._TOPS)),
}
