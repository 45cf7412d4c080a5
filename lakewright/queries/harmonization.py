"""Queries on harmonization, de-identification, value lists and rules, with their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.hashing import (
    LETTERS, weighted_hash,
)
from lakewright.operators import categories as cat
from lakewright.operators import harmonization as har
from lakewright.operators import rules as rl
from lakewright.operators.deidentify import DeidRules, deidentify
from lakewright.queries.common import derive, load, plain

# Dictionary rows with their targets, one per part.
TARGETS = """
SELECT p_type AS source_type, lower(p_brand) AS lake_table_name,
       lower(p_name) || CAST(p_partkey AS STRING) AS lake_variable_name,
       CASE WHEN p_size < 10 THEN 'labs' WHEN p_size < 20 THEN ' labs , vitals,,pmh '
            WHEN p_size < 25 THEN NULL WHEN p_size < 30 THEN ' ' ELSE 'injuries' END
       AS validated_table_target,
       CASE WHEN p_size = 12 THEN '' WHEN p_brand = 'Brand#7' THEN
            upper(p_name) || CAST(p_partkey AS STRING) ELSE 'Col ' || CAST(p_size AS STRING) END
       AS validated_variable_name,
       CASE WHEN p_size < 15 THEN ' numeric ' WHEN p_size < 35 THEN 'Date' END AS target_type,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_size > 48 END AS is_identifier,
       p_type <> 'SMALL' AS is_active
FROM {part}
"""
_TARGET_ROWS = f"""
SELECT * EXCLUDE (validated_table_target, target), trim(target) AS validated_table_target
FROM (SELECT *, unnest(string_split_regex(trim(validated_table_target), '\\s*,\\s*')) AS target
      FROM {plain(TARGETS)} WHERE is_active AND trim(validated_table_target) <> ''
        AND trim(validated_variable_name) <> '') WHERE trim(target) <> ''"""
_MAPPINGS = f"""
SELECT source_type, lake_table_name AS source_table, lake_variable_name AS source_column,
  validated_table_target AS target_table, validated_variable_name AS target_column,
  CASE WHEN lower(trim(lake_variable_name)) = lower(trim(validated_variable_name))
       THEN 'direct' ELSE 'rename' END AS transform_type,
  CAST(NULL AS VARCHAR) AS transform_expression, true AS is_active, 100 AS priority,
  CAST(NULL AS VARCHAR) AS notes FROM ({_TARGET_ROWS})"""

CURRENT_MAP = """
SELECT p_type AS source_type, lower(p_brand) AS source_table,
       lower(p_name) || CAST(p_partkey AS STRING) AS source_column,
       CASE WHEN p_size < 10 THEN 'labs' ELSE 'injuries' END AS target_table,
       'Col ' || CAST(p_size AS STRING) AS target_column,
       CASE WHEN p_size < 5 THEN 'expression' WHEN p_size < 8 THEN 'direct' ELSE 'constant' END
       AS transform_type, CASE WHEN p_size < 5 THEN 'a + b' WHEN p_size > 40 THEN 'x' END
       AS transform_expression, p_size <> 9 AS is_active, CAST(p_size AS INT) AS priority,
       p_name AS notes, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
       TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM {part} WHERE p_size < 10 OR p_size > 35
"""
_MERGED = f"""
SELECT source_type, source_table, source_column, target_table, target_column,
  CASE WHEN n.f IS NULL OR o.transform_type IN ('expression', 'constant', 'coalesce')
       THEN o.transform_type ELSE n.transform_type END AS transform_type,
  CASE WHEN n.f IS NULL OR o.transform_type IN ('expression', 'constant', 'coalesce')
       THEN o.transform_expression ELSE n.transform_expression END AS transform_expression,
  CASE WHEN n.f THEN n.is_active ELSE o.is_active END AS is_active,
  CASE WHEN o.f THEN o.priority ELSE n.priority END AS priority,
  CASE WHEN o.f THEN o.notes ELSE n.notes END AS notes, o.f IS NOT NULL AS is_old
FROM (SELECT *, true AS f FROM ({_MAPPINGS})) n
FULL JOIN (SELECT *, true AS f FROM {plain(CURRENT_MAP)}) o
USING (source_type, source_table, source_column, target_table, target_column)"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = har.merged_mappings(
        derive(spark, sf_dir, CURRENT_MAP), har.derived_mappings(derive(spark, sf_dir, TARGETS)))
    old = F.col("created_at") == F.lit("2024-01-01").cast("timestamp")
    return out.withColumn("is_old", old).drop("created_at", "updated_at")


STAGED = """
SELECT lower(p_brand) AS table_name, lower(p_name) || CAST(p_partkey AS STRING) AS column_name,
       CASE WHEN p_retailprice < 920 THEN 'NUMERIC(9,2)' WHEN p_retailprice < 940 THEN 'TIMESTAMP'
            WHEN p_retailprice < 960 THEN 'VARCHAR(5)' WHEN p_retailprice < 970 THEN ''
            ELSE 'SMALLINT' END AS sql_type
FROM {part} WHERE p_type <> 'ECONOMY'
"""
_RESOLVED = f"""
WITH m AS (
  SELECT validated_table_target, validated_variable_name, source_type, is_identifier,
    coalesce(nullif(sql_type, ''), nullif(upper(trim(target_type)), ''), 'TEXT') AS t
  FROM ({_TARGET_ROWS}) d LEFT JOIN {plain(STAGED)} s
    ON s.table_name = d.lake_table_name AND s.column_name = d.lake_variable_name),
r AS (SELECT *, CASE trim(regexp_extract(t, '^[A-Z ]+')) WHEN 'TIMESTAMPTZ' THEN 10
  WHEN 'TIMESTAMP' THEN 9 WHEN 'DATE' THEN 8 WHEN 'TIMETZ' THEN 7 WHEN 'TIME' THEN 6
  WHEN 'DOUBLE PRECISION' THEN 5 WHEN 'REAL' THEN 5 WHEN 'NUMERIC' THEN 4 WHEN 'BIGINT' THEN 3
  WHEN 'INTEGER' THEN 2 WHEN 'SMALLINT' THEN 1 WHEN 'BOOLEAN' THEN 0 ELSE -1 END AS rank
  FROM m)
SELECT validated_table_target, validated_variable_name,
  arg_min(t, (-rank, t)) AS resolved_type,
  string_agg(DISTINCT source_type, ', ' ORDER BY source_type) AS sources,
  coalesce(bool_or(is_identifier), false) AS is_identifier FROM r GROUP BY ALL"""

PARTY = T.StructType([
    T.StructField("party_key", T.LongType()), T.StructField("party_name", T.StringType()),
    T.StructField("balance_text", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("origin", T.StringType()), T.StructField("rank", T.IntegerType()),
    T.StructField("code", T.DoubleType()), T.StructField("missing", T.StringType()),
    T.StructField("unknown", T.StringType()), T.StructField("label", T.StringType()),
])


def _map(column, target, kind, text=None, priority=100):
    return {"source_column": column, "target_column": target, "transform_type": kind,
            "transform_expression": text, "priority": priority}


CUSTOMERS = """
SELECT c_custkey AS key, c_name AS party_name, c_nationkey AS nation,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS balance, c_mktsegment AS segment,
       CASE WHEN c_nationkey = 3 THEN 'none' WHEN c_nationkey = 4 THEN
            CAST(c_custkey AS STRING) || '.' ELSE CAST(c_custkey AS STRING) || 'e1' END AS code,
       CASE WHEN c_nationkey > 12 THEN c_mktsegment END AS note
FROM {customer}
"""
CUSTOMER_MAP = [
    _map("key", "party_key", "rename"), _map("party_name", "party_name", "direct"),
    _map("balance", "balance_text", "rename"), _map("segment", "segment", "direct"),
    _map("key", "origin", "constant", "it's a customer"),
    _map("nation", "rank", "expression", "nation * 2 + 1"), _map("code", "code", "direct"),
    _map("gone", "missing", "rename"), _map("key", "unknown", "guess"),
    _map("note", "label", "coalesce", "COALESCE(note, party_name)"),
]
SUPPLIER_MAP = [
    _map("s_suppkey", "party_key", "rename"), _map("s_name", "party_name", "rename"),
    _map("s_acctbal", "segment", "expression",
         "CASE WHEN s_acctbal > 5000 THEN 'rich' ELSE 'other' END"),
    _map("s_name", "origin", "constant", None), _map("s_nationkey", "rank", "rename"),
    _map("s_acctbal", "code", "expression", "  "),
    _map("s_absent", "label", "rename", priority=1), _map("s_name", "label", "rename", priority=2),
]


def _parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = har.harmonized(
        derive(spark, sf_dir, CUSTOMERS), CUSTOMER_MAP, "CRM", "customers", PARTY)
    suppliers = har.harmonized(
        load(spark, sf_dir, "supplier"), SUPPLIER_MAP, "ERP", "supplier", PARTY, "priority")
    return customers.unionByName(suppliers, allowMissingColumns=True)


_PARTIES = f"""
SELECT 'CRM' AS source_type, 'customers' AS source_table, key AS party_key, party_name,
  balance AS balance_text, segment, 'it''s a customer' AS origin, nation * 2 + 1 AS rank,
  CASE WHEN regexp_full_match(code, '-?[0-9]*\\.?[0-9]+([eE][+-]?[0-9]+)?')
       THEN CAST(code AS DOUBLE) END AS code, CAST(NULL AS VARCHAR) AS missing,
  CAST(NULL AS VARCHAR) AS "unknown", coalesce(note, party_name) AS label
FROM {plain(CUSTOMERS)}
UNION ALL
SELECT 'ERP', 'supplier', s_suppkey, s_name, NULL,
  CASE WHEN s_acctbal > 5000 THEN 'rich' ELSE 'other' END, NULL, s_nationkey, NULL, NULL, NULL,
  s_name FROM supplier"""

# --- de-identification --------------------------------------------------------------------

SALT = "example"
PEOPLE = """
SELECT c_custkey AS `Account Number`, c_name AS MRN, c_mktsegment AS FNAME,
       CASE WHEN c_nationkey = 4 THEN NULL ELSE c_name END AS LNAME,
       CASE WHEN c_nationkey = 5 THEN NULL ELSE CAST(CAST(first_day AS DATE) AS STRING) END
       AS DOB, c_acctbal AS amount
FROM {customer} JOIN (SELECT o_custkey, min(o_orderdate) AS first_day FROM {orders}
                      GROUP BY o_custkey) AS q ON o_custkey = c_custkey
"""


def _hash_sql(value: str, salt: str, size: int) -> str:
    whole = f"('{salt}||' || coalesce({value}, 'NA'))"
    return (f"CAST(list_sum(list_transform(range(1, length({whole}) + 1), lambda i: "
            f"(unicode(substr({whole}, i, 1)) * i) % 1000003)) % {size} AS BIGINT)")


def _pseudonym_sql(value: str, salt: str) -> str:
    """The pseudonym unrolled: state and letter of every step as columns of nested selects."""
    inner = f"SELECT *, {_hash_sql('v', salt, 2147483647)} + 1 AS y0, '' AS n0 FROM ({value})"
    for k in range(1, 11):
        inner = (f"SELECT *, y{k - 1} // 52 + {k} AS y{k}, n{k - 1} || "
                 f"substr('{LETTERS}', CAST(y{k - 1} % 52 + 1 AS INTEGER), 1) AS n{k} "
                 f"FROM ({inner})")
    return inner


_PEOPLE = plain(PEOPLE.replace("`", '"'))
_RULES = DeidRules(salt=SALT)
_DEID = f"""
SELECT CAST("Account Number" AS DOUBLE) + {_RULES.offset("Account Number")} AS "Account Number",
  MRN || '{_RULES.offset("MRN")}' AS MRN,
  CAST(DOB AS DATE) + CAST({_hash_sql(
      f"CAST(CAST(\"Account Number\" + {_RULES.offset('Account Number')} AS BIGINT) AS VARCHAR)",
      SALT, 7301)} - 3650 AS INTEGER) AS DOB, amount
FROM {_PEOPLE}"""


def _deid(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = derive(spark, sf_dir, PEOPLE)
    return deidentify(people, _RULES).drop("FNAME", "LNAME")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = derive(spark, sf_dir, PEOPLE)
    keep = people.withColumn("k", F.col("Account Number"))
    return deidentify(keep, _RULES).select("k", "LNAME")


_NAMES = (f"SELECT k, CASE WHEN v IS NOT NULL THEN n10 END AS \"LNAME\" FROM ("
          + _pseudonym_sql(f'SELECT "Account Number" AS k, LNAME AS v FROM {_PEOPLE}',
                           f"{SALT}||LNAME") + ")")


def _hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select(
        "page_id", weighted_hash(F.col("url"), SALT, 7301).alias("small_hash"),
        weighted_hash(F.col("url"), SALT).alias("hash"))


def _whole_text_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(
        "doc_id", weighted_hash(F.col("text"), SALT).alias("hash"))


# --- value lists and rules -----------------------------------------------------------------

WANTED = [("o_orderstatus", "orders"), ("o_orderpriority", "orders"), ("o_orderdate", "orders"),
          ("n_name", "nation"), ("p_brand", "part"), ("p_size", "part"), ("p_name", "part"),
          ("nothing", "part"), ("x", "absent"), ("l_quantity", "lineitem"), ("empty", "void")]
VOID = "SELECT CASE WHEN r_name = '' THEN r_name END AS empty FROM {region}"


def _value_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = {t: load(spark, sf_dir, t) for t in ("orders", "nation", "part", "lineitem")}
    out["void"] = derive(spark, sf_dir, VOID)
    return out


def _values_sql() -> str:
    doubles = {"l_quantity"}
    parts = []
    for v, t in WANTED:
        if (v, t) in (("nothing", "part"), ("x", "absent")):
            parts.append(f"SELECT '{v}' AS variable_name, 'raw.{t}' AS table_name, "
                         "CAST(NULL AS BIGINT) AS unique_count, CAST(NULL AS VARCHAR) "
                         "AS unique_values, 'column_not_found' AS status")
            continue
        text = f"CAST(CAST({v} AS BIGINT) AS VARCHAR)" if v in doubles else f"CAST({v} AS VARCHAR)"
        source = plain(VOID) if t == "void" else t
        parts.append(f"""SELECT '{v}' AS variable_name, 'raw.{t}' AS table_name, n AS unique_count,
  CASE WHEN n = 0 THEN '(all null)' WHEN n > 50 THEN array_to_string(l[1:20], ', ') || ' ... ('
    || n || ' total - UNCONSTRAINED)' ELSE array_to_string(l, ', ') END AS unique_values,
  CASE WHEN n = 0 THEN 'all_null' WHEN n > 50 THEN 'unconstrained' ELSE 'ok' END AS status
FROM (SELECT count(x) AS n, list(x ORDER BY x) AS l FROM
      (SELECT DISTINCT {text} AS x FROM {source} WHERE {v} IS NOT NULL))""")
    return " UNION ALL ".join(parts)


SHARED = [("l_returnflag", "lineitem"), ("l_returnflag", "returns"), ("l_linestatus", "lineitem"),
          ("l_shipdate", "lineitem"), ("l_shipdate", "returns")]
RETURNS = "SELECT * FROM {lineitem} WHERE l_returnflag = 'R'"


def _consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"lineitem": load(spark, sf_dir, "lineitem"),
              "returns": derive(spark, sf_dir, RETURNS)}
    return cat.consolidated(cat.distinct_values(tables, SHARED))


def _shared_sql() -> str:
    parts = []
    for v, t in SHARED:
        source = plain(RETURNS) if t == "returns" else t
        parts.append(f"""SELECT '{v}' AS variable_name, 'raw.{t}' AS table_name, n,
  CASE WHEN n > 50 THEN array_to_string(l[1:20], ', ') || ' ... (' || n
    || ' total - UNCONSTRAINED)' ELSE array_to_string(l, ', ') END AS vals
FROM (SELECT count(x) AS n, list(x ORDER BY x) AS l FROM
      (SELECT DISTINCT CAST({v} AS VARCHAR) AS x FROM {source}))""")
    return ("SELECT variable_name, string_agg(table_name, '; ' ORDER BY table_name) AS tables, "
            "CAST(sum(n) AS BIGINT) AS total_unique_count, "
            "string_agg(vals, ' | ' ORDER BY table_name) AS all_values FROM ("
            + " UNION ALL ".join(parts) + ") GROUP BY ALL")


ROW_RULES = [
    {"rule_id": "QTY", "rule_category": "range", "rule_severity": "error",
     "rule_expression": "l_quantity BETWEEN 2 AND 49"},
    {"rule_id": "PRICE", "rule_category": "range", "rule_severity": "warning",
     "rule_expression": "l_extendedprice >= 1000"},
    {"rule_id": "FLAG", "rule_category": "required", "rule_severity": "error",
     "rule_expression": "NOT ISNULL(l_returnflag)"},
    {"rule_id": "NET", "rule_category": "range", "rule_severity": "warning",
     "rule_expression": "nullif(l_discount, 0) + l_tax < 0.15"},
]
_RULE_SQL = {"QTY": "l_quantity BETWEEN 2 AND 49", "PRICE": "l_extendedprice >= 1000",
             "FLAG": "l_returnflag IS NOT NULL",
             "NET": "nullif(l_discount, 0) + l_tax < 0.15"}
_RULE_RESULTS = " UNION ALL ".join(
    f"SELECT '{r['rule_id']}' AS rule_id, '{r['rule_category']}' AS rule_category, "
    f"'{r['rule_severity']}' AS rule_severity, count(*) AS checked_count, "
    f"count(*) FILTER ({_RULE_SQL[r['rule_id']]}) AS pass_count, "
    f"count(*) FILTER (NOT ({_RULE_SQL[r['rule_id']]})) AS fail_count, "
    f"count(*) FILTER (({_RULE_SQL[r['rule_id']]}) IS NULL) AS undecided_count FROM lineitem"
    for r in ROW_RULES)
_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
_VIOLATIONS = " UNION ALL ".join(
    f"SELECT {', '.join(_KEYS)}, '{r['rule_id']}' AS rule_id, '{r['rule_severity']}' "
    f"AS rule_severity FROM lineitem WHERE NOT ({_RULE_SQL[r['rule_id']]})" for r in ROW_RULES)

BOUNDS = [
    {"lake_variable_name": "o_totalprice", "valid_min": 1000.0, "valid_max": 400000.0},
    {"lake_variable_name": "o_custkey", "valid_min": 100.0},
    {"lake_variable_name": "o_orderstatus", "allowed_values": "F, O"},
    {"lake_variable_name": "not_there", "valid_min": 0.0},
]
_BOUNDS = """
SELECT 'o_totalprice' AS variable_name, count(o_totalprice) AS value_count,
  count(*) FILTER (o_totalprice < 1000) AS below_min_count,
  count(*) FILTER (o_totalprice > 400000) AS above_max_count, 0 AS not_allowed_count FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), count(*) FILTER (o_custkey < 100), 0, 0
FROM orders UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), 0, 0,
  count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders"""

CROSSTAB = "SELECT l_orderkey, " + ", ".join(
    f"sum(CASE WHEN l_returnflag = '{f}' AND l_linenumber = {n} THEN l_quantity END) "
    f"AS {name}_{n}"
    for f, name in (("A", "prbc"), ("N", "ffp"), ("R", "cryo")) for n in range(1, 8)
) + " FROM {lineitem} GROUP BY l_orderkey"
_LONG = """
SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'prbc' WHEN 'N' THEN 'ffp' ELSE 'cryo' END
  AS product_type, l_linenumber AS hour, sum(l_quantity) AS units
FROM lineitem GROUP BY ALL"""

QUERIES = {
    "map_fanout": (
        lambda s, d: har.derived_mappings(derive(s, d, TARGETS)), _MAPPINGS),
    "map_upsert": (_merged, _MERGED),
    "active_mappings": (
        lambda s, d: har.active_mappings(
            derive(s, d, CURRENT_MAP), "injuries", "PROMO").drop("created_at", "updated_at"),
        f"SELECT * EXCLUDE (created_at, updated_at) FROM {plain(CURRENT_MAP)} "
        f"WHERE target_table = 'injuries' AND is_active AND source_type = 'PROMO'"),
    "resolve_types": (
        lambda s, d: har.validated_columns(derive(s, d, TARGETS), derive(s, d, STAGED)),
        _RESOLVED),
    "harmonize_parties": (_parties, _PARTIES),
    "deid_ids_and_dates": (_deid, _DEID),
    "deid_names": (_names, _NAMES),
    "deid_hashes": (
        _hashes, f"SELECT page_id, {_hash_sql('url', SALT, 7301)} AS small_hash, "
                 f"{_hash_sql('url', SALT, 2147483647)} AS hash FROM pages"),
    "whole_text_hashes": (
        _whole_text_hashes,
        f"SELECT doc_id, CAST(list_sum(list_transform(string_split('{SALT}||' || text, ''), "
        f"lambda c, i: (unicode(c) * i) % 1000003)) % 2147483647 AS BIGINT) AS hash "
        f"FROM documents"),
    "distinct_values": (
        lambda s, d: cat.distinct_values(_value_tables(s, d), WANTED), _values_sql()),
    "consolidated_values": (_consolidated, _shared_sql()),
    "rule_results": (
        lambda s, d: rl.rule_results(load(s, d, "lineitem"), ROW_RULES), _RULE_RESULTS),
    "rule_violations": (
        lambda s, d: rl.rule_violations(load(s, d, "lineitem"), ROW_RULES, _KEYS), _VIOLATIONS),
    "bound_checks": (lambda s, d: rl.bound_checks(load(s, d, "orders"), BOUNDS), _BOUNDS),
    "hourly_long": (
        lambda s, d: rl.hourly_long(derive(s, d, CROSSTAB), ["l_orderkey"]), _LONG),
}
