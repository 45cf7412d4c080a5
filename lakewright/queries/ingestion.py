"""Queries on names, casts, ingestion and promotion, with their checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions import datatypes as dt
from lakewright.functions import text as tx
from lakewright.functions.names import normalized
from lakewright.operators import ingestion as ing
from lakewright.operators.lineage import audit_events, batch_status, registry_violations
from lakewright.queries.common import derive, load, plain
from lakewright.session import shared_folder
from lakewright.sources import files as fl

_TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(13))"

NAMES = """
SELECT page_id AS id, ' ' || url || ' (cm) ' AS name FROM {pages}
UNION ALL SELECT c_custkey, c_name || ' (Y/N) ' || c_mktsegment FROM {customer}
UNION ALL SELECT p_partkey, '__' || p_name || ' (Minutes) ' || p_brand || '(kg)' FROM {part}
"""
_NORMAL = "lower(trim(name))"
for _pattern, _plain in ((r"\(y/n\)", "yn"), (r"\(minutes\)", "minutes"), (r"\(min\)", "min"),
                         (r"\(cm\)", "cm"), (r"\(kg\)", "kg"), ("[^a-z0-9]+", "_")):
    _NORMAL = f"regexp_replace({_NORMAL}, '{_pattern}', '{_plain}', 'g')"

# Numbers as text in the many ways extracts write them.
NUMBER_TEXTS = """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_shipdate, l_returnflag,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '.' || CAST(l_suppkey AS STRING)
       WHEN l_returnflag = 'A' THEN CAST(l_partkey AS STRING) || '.'
       WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '+' || CAST(l_suppkey AS STRING)
       WHEN l_returnflag = 'R' THEN ' ' || CAST(l_suppkey AS STRING) || ' '
       WHEN l_linenumber = 1 THEN CAST(l_suppkey AS STRING) || 'e2'
       WHEN l_linenumber = 2 THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)
       WHEN l_linenumber = 3 THEN 'abc' WHEN l_linenumber = 4 THEN ''
       WHEN l_linenumber = 5 THEN 'NA'
       ELSE CAST(l_partkey AS STRING) END AS t
FROM {lineitem}
"""
_GUARDED = r"'-?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?'"
_NUM = r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?'"
_LINE = "l_orderkey, l_partkey, l_linenumber, l_suppkey, l_shipdate, l_returnflag"


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import types as T

    df = derive(spark, sf_dir, NUMBER_TEXTS)
    return df.select(
        *[c for c in df.columns if c != "t"],
        tx.guarded_number(F.col("t"), T.DoubleType()).alias("as_double"),
        tx.guarded_number(F.col("t"), T.LongType()).alias("as_bigint"),
        tx.to_number(F.col("t")).alias("as_number"),
    )


_GUARDED_SQL = f"""
SELECT {_LINE},
  CASE WHEN regexp_full_match(t, {_GUARDED}) THEN TRY_CAST(t AS DOUBLE) END AS as_double,
  CASE WHEN regexp_full_match(t, '-?[0-9]+') THEN TRY_CAST(t AS BIGINT) END AS as_bigint,
  CASE WHEN regexp_full_match({_TRIM.format('t')}, {_NUM})
       THEN TRY_CAST({_TRIM.format('t')} AS DOUBLE) END AS as_number
FROM {plain(NUMBER_TEXTS)}"""

# The date of each order in the layouts extracts use.
DATE_TEXTS = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
  CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) AS y,
  CAST(EXTRACT(MONTH FROM o_orderdate) AS STRING) AS m,
  CAST(EXTRACT(DAY FROM o_orderdate) AS STRING) AS d, o_orderpriority AS p, o_orderstatus AS s
FROM {orders}
"""
DATED = f"""
SELECT o_orderkey, day, CASE WHEN p = '1-URGENT' THEN y || '-' || m || '-' || d
  WHEN p = '2-HIGH' THEN m || '/' || d || '/' || y WHEN p = '3-MEDIUM' THEN y || '/' || m || '/' || d
  WHEN p = '4-NOT SPECIFIED' THEN d || '-' || 'Jan' || '-' || y ELSE CAST(day AS STRING) END
  AS t, p, s FROM ({DATE_TEXTS}) AS q
"""


def _strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derive(spark, sf_dir, DATED)
    return df.select("o_orderkey", dt.strict_cast(F.col("t"), "DATE").alias("cast_day"))


_STRICT_DATES = f"""
SELECT o_orderkey, CASE WHEN p = '4-NOT SPECIFIED'
  THEN make_date(CAST(year(day) AS INTEGER), 1, CAST(day(day) AS INTEGER)) ELSE day END
  AS cast_day FROM {plain(DATED)}"""


def _lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive(spark, sf_dir, f"""
        SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_shipdate, l_returnflag,
          t AS i, t AS n,
          CASE WHEN l_returnflag = 'A' THEN 'T' WHEN l_returnflag = 'R' THEN 'false'
               ELSE 'yes' END AS b,
          CASE WHEN l_linenumber = 1 THEN 'NA' ELSE CAST(l_shipdate AS STRING) END AS ts,
          CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END
          AS day, t AS note
        FROM ({NUMBER_TEXTS}) AS q""")
    return ing.coerced(raw, {
        "i": "integer", "n": "numeric(12,2)", "b": "boolean", "ts": "timestamp", "day": "date",
        "note": "text",
    })


_LENIENT_SQL = f"""
SELECT {_LINE},
  CASE WHEN regexp_full_match({_TRIM.format('t')}, '[+-]?[0-9]+')
       THEN TRY_CAST({_TRIM.format('t')} AS INTEGER) END AS i,
  CASE WHEN regexp_full_match({_TRIM.format('t')}, {_NUM})
       THEN TRY_CAST({_TRIM.format('t')} AS DOUBLE) END AS n,
  CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS b,
  CASE WHEN l_linenumber <> 1 THEN l_shipdate END AS ts,
  CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE) END AS day, t AS note
FROM {plain(NUMBER_TEXTS)}"""

# Text copy of orders, promoted with a decision table made of its columns.
ORDER_TEXTS = """
SELECT CAST(o_orderkey AS STRING) AS o_orderkey, ' ' || CAST(o_custkey AS STRING) AS o_custkey,
       o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS o_totalprice,
       CAST(o_orderdate AS STRING) AS o_orderdate, o_orderpriority,
       CASE WHEN o_orderstatus = 'F' THEN 'on' ELSE 'no' END AS is_final,
       CAST(EXTRACT(DAY FROM o_orderdate) AS STRING) || ':5' AS clock
FROM {orders}
"""
ORDER_TYPES = {
    "o_orderkey": "BIGINT", "o_custkey": "integer", "o_totalprice": "NUMERIC(12,2)",
    "o_orderdate": "TIMESTAMP", "o_orderpriority": "varchar(3)", "is_final": "BOOLEAN",
    "clock": "TIME",
}


def _promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive(spark, sf_dir, ORDER_TEXTS.replace("EXTRACT(DAY", "EXTRACT(MONTH"))
    out = ing.promoted(raw, ORDER_TYPES)
    return out.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


_PROMOTED_SQL = """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice,
       o_orderdate, left(o_orderpriority, 3) AS o_orderpriority,
       o_orderstatus = 'F' AS is_final,
       lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || ':05:00' AS clock
FROM orders"""

# Files that would arrive for each document, and the dictionary naming some of them.
FILES = """
SELECT '/lake/raw/' || lang || '/incoming/' || CASE WHEN source = 'src1' THEN 'Labs_'
       || CAST(2000 + n_chars AS STRING) ELSE upper(source) || '_' || lang END || '.csv' AS path,
       doc_id
FROM {documents}
"""
FILE_DICTIONARY = """
SELECT DISTINCT ' Registry' AS source_type, source || '_' || lang AS source_table_name,
       'var ' || lang AS source_variable_name,
       CASE WHEN lang = 'fr' THEN '' ELSE 'lake_' || lang END AS lake_table_name,
       'v_' || lang AS lake_variable_name
FROM {documents} WHERE source <> 'src2'
UNION ALL
SELECT DISTINCT 'OTHER', source || '_en', 'x', 'lake_x', 'x' FROM {documents}
WHERE source = 'src2'
"""
_BASE = "lower(regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', ''))"
_LAKE_TABLES = f"""
WITH f AS (SELECT *, {_BASE} AS file_base FROM {plain(FILES)}),
d AS (SELECT lower(source_table_name) AS b, min(lake_table_name) AS mapped
      FROM {plain(FILE_DICTIONARY)} WHERE lower(trim(source_type)) = 'registry'
        AND lake_table_name <> '' GROUP BY ALL)
SELECT path, doc_id, file_base,
  CASE WHEN mapped IS NOT NULL THEN mapped WHEN file_base LIKE 'labs\\_%' ESCAPE '\\' THEN 'labs'
  END AS lake_table_name,
  CASE WHEN mapped IS NULL AND file_base LIKE 'labs\\_%' ESCAPE '\\'
       THEN TRY_CAST(regexp_extract(file_base, '^labs_(\\d+)$', 1) AS INTEGER) END AS lab_year
FROM f LEFT JOIN d ON f.file_base = d.b"""
_SOURCE_TYPES = f"""
SELECT source_type, count(*) AS n_files FROM (
  SELECT DISTINCT source_type, lower(source_table_name) AS b FROM {plain(FILE_DICTIONARY)})
JOIN (SELECT DISTINCT {_BASE} AS b FROM {plain(FILES)}) USING (b) GROUP BY ALL"""

# Columns waiting for a type, and decisions about some of them, some taken twice.
COLUMNS_TO_TYPE = """
SELECT p_brand AS table_name, p_name || CAST(p_partkey AS STRING) AS variable FROM {part}
"""
DECISIONS = """
SELECT ' ' || lower(p_brand) AS table_name, upper(p_name) || CAST(p_partkey AS STRING) AS variable,
       CASE WHEN p_type = 'LARGE' THEN ' ' WHEN p_type = 'SMALL' THEN ' integer '
            WHEN p_type = 'PROMO' THEN NULL ELSE 'DATE' END AS final_type,
       CASE WHEN p_size > 25 THEN 'numeric(9,2)' ELSE NULL END AS suggested_type,
       CAST(p_size AS INT) AS decision_order
FROM {part} WHERE p_type <> 'ECONOMY'
UNION ALL
SELECT p_brand, p_name || CAST(p_partkey AS STRING), 'BOOLEAN', 'text', 20 FROM {part}
WHERE p_type = 'MEDIUM'
"""


def _type_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ing.type_choices(
        derive(spark, sf_dir, COLUMNS_TO_TYPE), derive(spark, sf_dir, DECISIONS)
    )


_TYPE_CHOICES = f"""
WITH d AS (
  SELECT lower(trim(table_name)) AS t, lower(trim(variable)) AS v,
         arg_min({{'f': final_type, 's': suggested_type}},
                 (decision_order, coalesce(final_type, ''), coalesce(suggested_type, ''))) AS x
  FROM {plain(DECISIONS)} GROUP BY ALL)
SELECT table_name, variable,
  coalesce(nullif(trim(x.f), ''), nullif(trim(x.s), ''), 'TEXT') AS chosen_type
FROM {plain(COLUMNS_TO_TYPE)} c LEFT JOIN d ON lower(c.table_name) = t AND lower(c.variable) = v"""

FILE_STATES = """
SELECT 'ING_' || CAST(o_custkey AS STRING) AS ingest_id,
       CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'O' THEN 'error'
            ELSE 'skipped' END AS load_status
FROM {orders}
"""
_BATCH_STATUS = f"""
SELECT ingest_id, count(*) AS n_files, count(*) FILTER (load_status = 'success') AS n_success,
  count(*) FILTER (load_status <> 'success') AS n_error,
  CASE WHEN count(*) FILTER (load_status = 'success') = 0 THEN 'error'
       WHEN count(*) FILTER (load_status <> 'success') = 0 THEN 'success' ELSE 'partial' END
  AS status
FROM {plain(FILE_STATES)} GROUP BY ALL"""


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as CSV, quotes and line ends included, and scanned as text."""
    rows = load(spark, sf_dir, "conversations")
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    header = ["Conv ID", "Turn (min)", "Role", "Text"]
    rows.toDF(*header).write.options(header=True, escape='"').csv(folder)
    return fl.read_text_csv(spark, [folder], header).drop("_source_file")


def _projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped variables only, renamed; one mapped variable has no source column."""
    mapping = [("p_partkey", "part_number"), ("absent", "colour"), ("p_name", "label"),
               ("other_label", "label"), ("p_type", "p_type")]
    return ing.projected(load(spark, sf_dir, "part"), mapping)


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"))
    suppliers = load(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"))
    return ing.aligned(customers, suppliers)


REGISTRY = """
SELECT s_name AS source_id, CASE WHEN s_nationkey = 3 THEN NULL ELSE s_name END AS source_name,
       CASE WHEN s_nationkey < 5 THEN 'CSV' WHEN s_nationkey < 15 THEN 'SQL' ELSE 'csv' END
       AS system_type,
       CASE WHEN s_acctbal < 0 THEN 'hourly' ELSE 'monthly' END AS update_frequency,
       'owner' AS data_owner,
       CASE WHEN s_nationkey = 7 THEN 'fax' WHEN s_nationkey = 8 THEN NULL ELSE 'pull' END
       AS ingest_method, '1.0.0' AS expected_schema_version,
       CASE WHEN s_acctbal > 9000 THEN 'Public' ELSE 'PHI' END AS pii_classification,
       CASE WHEN s_nationkey = 11 THEN NULL ELSE s_acctbal > 100 END AS active
FROM {supplier}
UNION ALL
SELECT c_name, c_name, 'API', 'daily', c_mktsegment, 'push', '1', c_mktsegment, c_acctbal > 0
FROM {customer}
"""
_NULLS = " UNION ALL ".join(
    f"SELECT source_id, '{f}' AS field, 'required field is NULL' AS problem, "
    f"CAST(NULL AS VARCHAR) AS value FROM r WHERE {f} IS NULL"
    for f in ("source_id", "source_name", "system_type", "update_frequency", "data_owner",
              "ingest_method", "expected_schema_version", "pii_classification", "active"))
_NOT_ALLOWED = " UNION ALL ".join(
    f"SELECT source_id, '{f}', 'value is not allowed', {f} FROM r WHERE {f} NOT IN ({allowed})"
    for f, allowed in (
        ("system_type", "'CSV', 'XLSX', 'SQL', 'API', 'FHIR', 'Other'"),
        ("update_frequency", "'daily', 'weekly', 'biweekly', 'monthly', 'quarterly', "
                             "'annually', 'ad_hoc'"),
        ("ingest_method", "'push', 'pull', 'api', 'sftp', 'manual'"),
        ("pii_classification", "'PHI', 'Limited', 'NonPHI'")))

AUDIT_INPUT = """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE 'ING_' || CAST(user_id AS STRING) END
       AS ingest_id, event_type, CASE WHEN value > 50 THEN NULL ELSE 'success' END AS status,
       'table' AS object_type, 'raw.' || event_type AS object_name,
       CAST(event_id AS STRING) AS payload
FROM {events}
"""


def _audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = audit_events(derive(spark, sf_dir, AUDIT_INPUT))
    field = lambda p: F.get_json_object("details", f"$.{p}")
    return made.select("ingest_id", "action", field("object_name").alias("object_name"),
                       field("status").alias("status"), field("payload").alias("payload"))


FLAGS = """
SELECT event_id, CASE WHEN event_type = 'click' THEN 'y' WHEN event_type = 'error' THEN 'No'
  WHEN event_type = 'view' THEN '1' WHEN value > 50 THEN 'TRUE' WHEN value > 20 THEN NULL
  ELSE 'maybe' END AS flag FROM {events}
"""

QUERIES = {
    "normalize_names": (
        lambda s, d: derive(s, d, NAMES).select(
            "id", normalized(F.col("name")).alias("normal_name")),
        f"SELECT id, trim({_NORMAL}, '_') AS normal_name FROM {plain(NAMES)}"),
    "guarded_cast": (_guarded, _GUARDED_SQL),
    "strict_date_cast": (_strict_dates, _STRICT_DATES),
    "lenient_coercion": (_lenient, _LENIENT_SQL),
    "promote_types": (_promoted, _PROMOTED_SQL),
    "yes_no_flags": (
        lambda s, d: derive(s, d, FLAGS).select(
            "event_id", tx.yes_no(F.col("flag")).alias("is_set")),
        f"SELECT event_id, coalesce(upper(flag) IN ('Y', 'YES', 'TRUE', '1'), false) AS is_set "
        f"FROM {plain(FLAGS)}"),
    "lake_tables_of_files": (
        lambda s, d: ing.resolve_lake_tables(
            derive(s, d, FILES), derive(s, d, FILE_DICTIONARY), "REGISTRY "), _LAKE_TABLES),
    "source_types_of_files": (
        lambda s, d: ing.derive_source_types(
            derive(s, d, FILES), derive(s, d, FILE_DICTIONARY)), _SOURCE_TYPES),
    "type_choices": (_type_choices, _TYPE_CHOICES),
    "batch_status": (lambda s, d: batch_status(derive(s, d, FILE_STATES)), _BATCH_STATUS),
    "csv_text_scan": (
        _csv_round_trip,
        "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn_min, role, "
        "text FROM conversations"),
    "dictionary_projection": (
        _projection,
        "SELECT p_partkey AS part_number, CAST(NULL AS VARCHAR) AS colour, p_name AS label, "
        "p_type FROM part"),
    "aligned_union": (
        _aligned,
        "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, "
        "CAST(NULL AS DOUBLE) AS balance FROM customer "
        "UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier"),
    "registry_violations": (
        lambda s, d: registry_violations(derive(s, d, REGISTRY)),
        f"WITH r AS {plain(REGISTRY)} {_NULLS} UNION ALL {_NOT_ALLOWED}"),
    "audit_events": (
        _audit_events,
        f"SELECT ingest_id, concat_ws('|', event_type, status, object_type, object_name) "
        f"AS action, object_name, status, payload FROM {plain(AUDIT_INPUT)}"),
}
