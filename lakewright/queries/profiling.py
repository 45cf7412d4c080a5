"""Profiling queries and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.profiling import (
    Profiler, column_issues, overall_score, quality_score,
)
from lakewright.operators.quantiles import exact_quantiles
from lakewright.operators.settings import DEFAULTS, profiling_settings
from lakewright.queries.common import derive, load, plain

# A raw, all-text copy of orders whose values carry the blanks and placeholders real extracts
# have: whole groups of values are written as NULL, empty, spaces or a placeholder.
RAW_ORDERS = """
SELECT CAST(o_orderkey AS STRING) AS order_no,
       CASE WHEN o_orderstatus = 'P' THEN 'unknown' WHEN o_orderstatus = 'F' THEN ' F '
            ELSE o_orderstatus END AS status,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' WHEN o_orderpriority = '5-LOW'
            THEN '  ' WHEN o_orderpriority = '3-MEDIUM' THEN NULL
            ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS total_price,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN ' 999 '
            WHEN o_orderstatus = 'P' THEN '  12 ' WHEN o_orderpriority = '5-LOW' THEN '33'
            ELSE CAST(EXTRACT(MONTH FROM o_orderdate) AS STRING) END AS month_text,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'N/A'
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
       'orders' AS origin
FROM {orders}
"""
DERIVED = {"raw_orders": RAW_ORDERS}

# Columns of the tables profiled here and how the checking engine writes them as text.
COLUMNS = {
    "region": {"r_regionkey": "x", "r_name": "x"},
    "nation": {"n_nationkey": "x", "n_name": "x", "n_regionkey": "x"},
    "customer": {"c_custkey": "x", "c_name": "x", "c_nationkey": "x", "c_acctbal": "d",
                 "c_mktsegment": "x"},
    "supplier": {"s_suppkey": "x", "s_name": "x", "s_nationkey": "x", "s_acctbal": "d"},
    "part": {"p_partkey": "x", "p_name": "x", "p_brand": "x", "p_type": "x", "p_size": "x",
             "p_retailprice": "d"},
    "orders": {"o_orderkey": "x", "o_custkey": "x", "o_orderstatus": "x", "o_totalprice": "d",
               "o_orderdate": "x", "o_orderpriority": "x"},
    "lineitem": {"l_orderkey": "x", "l_partkey": "x", "l_suppkey": "x", "l_linenumber": "x",
                 "l_quantity": "d", "l_extendedprice": "d", "l_discount": "d", "l_tax": "d",
                 "l_returnflag": "x", "l_linestatus": "x", "l_shipdate": "x"},
    "events": {"event_id": "x", "ts": "x", "user_id": "x", "event_type": "x", "value": "d",
               "props": "x"},
    "documents": {"doc_id": "x", "text": "x", "lang": "x", "source": "x", "n_chars": "x"},
    "pages": {"page_id": "x", "url": "x", "html": "x"},
    "benchmark": {"item_id": "x", "text": "x"},
    "labels": {"doc_id": "x", "quality": "x", "toxic": "x"},
    "conversations": {"conv_id": "x", "turn": "x", "role": "x", "text": "x"},
    "raw_orders": {c: "x" for c in ("order_no", "status", "priority", "total_price",
                                    "month_text", "order_date", "origin")},
}
SMALL = ["raw_orders", "customer", "supplier", "part", "nation", "region", "labels"]
TEXTS = ["documents", "pages", "conversations", "benchmark", "events"]
ALL = [t for t in COLUMNS if t != "orders"]


def tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {
        n: derive(spark, sf_dir, DERIVED[n]) if n in DERIVED else load(spark, sf_dir, n)
        for n in names
    }


def profiler(spark: SparkSession, sf_dir: str, names: list[str], **options) -> Profiler:
    return Profiler(tables(spark, sf_dir, names), **options)


def _bare(df: DataFrame) -> DataFrame:
    return df.drop("ingest_id", "schema_name", "profiled_at")


# --- checks -----------------------------------------------------------------------------

_NUM = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_REPEAT = "-?(00+|11+|22+|33+|44+|55+|66+|77+|88+|99+)"
_NUMERIC = [str(v) for v in DEFAULTS["sentinel_detection"]["numeric_sentinels"]]
_STRINGS = DEFAULTS["sentinel_detection"]["string_sentinels"]
_IDS = [c.lower() for c in DEFAULTS["identifier_columns"]]


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _text(column: str, kind: str) -> str:
    if kind == "d":
        return (f"CASE WHEN {column} = floor({column}) AND abs({column}) < 1e15 "
                f"THEN CAST(CAST({column} AS BIGINT) AS VARCHAR) "
                f"ELSE CAST({column} AS VARCHAR) END")
    return f"CAST({column} AS VARCHAR)"


def profile_sql(names: list[str], select: str) -> str:
    """Common table expressions of a profile of the tables, ended by ``select``. They give
    cells, freq, types, sentinels, profile and valid (values that are no blank or sentinel)."""
    cells = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS variable_name, {i} AS ordinal, "
        f"{_text(c, k)} AS x FROM {plain(DERIVED[t]) if t in DERIVED else t}"
        for t in names for i, (c, k) in enumerate(COLUMNS[t].items())
    )
    return rf"""
WITH cells AS ({cells}),
freq AS (
  SELECT table_name, variable_name, ordinal, x, count(*) AS n FROM cells GROUP BY ALL),
classed AS (
  SELECT *, trim(x, ' ' || chr(9) || chr(10) || chr(13)) AS tr,
         CASE WHEN x IS NULL THEN 'na' WHEN x = '' THEN 'empty'
              WHEN regexp_full_match(x, '\s+') THEN 'white' ELSE 'filled' END AS kind,
         CASE WHEN regexp_full_match(tr, '{_NUM}') THEN TRY_CAST(tr AS DOUBLE) END AS num,
         CASE WHEN upper(tr) IN ({_list(_NUMERIC + _STRINGS)})
                OR regexp_full_match(tr, '{_REPEAT}') THEN upper(tr) END AS key,
         TRY_CAST(regexp_extract(tr, '^\d\d\d\d-\d\d-\d\d') AS DATE) IS NOT NULL AS is_date
  FROM freq),
totals AS (
  SELECT table_name, variable_name, ordinal, sum(n) AS total,
         coalesce(sum(n) FILTER (kind = 'na'), 0) AS na,
         coalesce(sum(n) FILTER (kind = 'empty'), 0) AS empty,
         coalesce(sum(n) FILTER (kind = 'white'), 0) AS white,
         coalesce(sum(n) FILTER (tr <> ''), 0) AS filled,
         coalesce(sum(n) FILTER (num IS NOT NULL), 0) AS numbers,
         coalesce(sum(n) FILTER (is_date), 0) AS dates,
         count(DISTINCT tr) FILTER (tr <> '') AS trimmed_values
  FROM classed GROUP BY ALL),
types AS (
  SELECT *, CASE WHEN lower(variable_name) IN ({_list(_IDS)})
        OR regexp_matches(lower(variable_name), '_id$|_no$|^id_|^accountno|^medrecno|^traumano')
        THEN 'identifier' WHEN filled = 0 THEN 'categorical'
        WHEN numbers / filled > 0.9 THEN 'numeric' WHEN dates / filled > 0.8 THEN 'date'
        ELSE 'categorical' END AS inferred_type
  FROM totals),
candidates AS (
  SELECT c.table_name, c.variable_name, c.key, sum(c.n) AS n, any_value(t.total) AS total,
         sum(c.n) FILTER (tr IN ({_list(_NUMERIC)})) AS listed,
         any_value(inferred_type) = 'numeric' AS is_numeric,
         any_value(trimmed_values) AS trimmed_values
  FROM classed c JOIN types t USING (table_name, variable_name)
  WHERE c.key IS NOT NULL GROUP BY ALL),
sentinels AS (
  SELECT *, CASE WHEN is_numeric AND listed > 0 THEN listed ELSE n END AS sentinel_count,
         CASE WHEN (is_numeric AND listed > 0) OR key IN ({_list(_STRINGS)}) THEN 'config_list'
              ELSE 'frequency_analysis' END AS detection_method
  FROM candidates
  WHERE (is_numeric AND listed > 0) OR key IN ({_list(_STRINGS)})
     OR (is_numeric AND trimmed_values <= 50 AND n / total * 100 >= 1.0
         AND regexp_full_match(key, '{_REPEAT}'))),
valid AS (
  SELECT c.*, t.inferred_type FROM classed c JOIN types t USING (table_name, variable_name)
  WHERE kind = 'filled' AND NOT EXISTS (
    SELECT 1 FROM sentinels s WHERE s.table_name = c.table_name
      AND s.variable_name = c.variable_name AND s.key = c.key)),
uniques AS (
  SELECT table_name, variable_name, count(*) AS unique_count, sum(n) AS valid_count
  FROM valid GROUP BY ALL),
counts AS (
  SELECT table_name, variable_name, ordinal, inferred_type, total AS total_count,
         coalesce(valid_count, 0) AS valid_count, na AS na_count, empty AS empty_count,
         white AS whitespace_count, total - na - empty - white - coalesce(valid_count, 0)
         AS sentinel_count, coalesce(unique_count, 0) AS unique_count,
         total - coalesce(valid_count, 0) AS total_missing_count
  FROM types LEFT JOIN uniques USING (table_name, variable_name)),
profile AS (
  SELECT table_name, variable_name, ordinal, inferred_type,
         CAST(total_count AS BIGINT) AS total_count, CAST(valid_count AS BIGINT) AS valid_count,
         CAST(na_count AS BIGINT) AS na_count, CAST(empty_count AS BIGINT) AS empty_count,
         CAST(whitespace_count AS BIGINT) AS whitespace_count,
         CAST(sentinel_count AS BIGINT) AS sentinel_count,
         round_even(na_count / total_count * 100, 2) AS na_pct,
         round_even(empty_count / total_count * 100, 2) AS empty_pct,
         round_even(whitespace_count / total_count * 100, 2) AS whitespace_pct,
         round_even(sentinel_count / total_count * 100, 2) AS sentinel_pct,
         CAST(total_missing_count AS BIGINT) AS total_missing_count,
         round_even(total_missing_count / total_count * 100, 2) AS total_missing_pct,
         round_even(valid_count / total_count * 100, 2) AS valid_pct,
         CAST(unique_count AS BIGINT) AS unique_count,
         CASE WHEN valid_count > 0 THEN round_even(unique_count / valid_count * 100, 2)
              ELSE 0 END AS unique_pct
  FROM counts),
issues AS ({_issues_sql("profile", "inferred_type")}),
ranked AS (
  SELECT v.table_name, v.variable_name, v.inferred_type, v.x AS value,
         CAST(n AS BIGINT) AS n, round_even(n / u.valid_count * 100, 2) AS pct,
         row_number() OVER (PARTITION BY v.table_name, v.variable_name
           ORDER BY n DESC, x) AS value_rank
  FROM valid v JOIN uniques u USING (table_name, variable_name)),
numeric_stats AS (
  SELECT table_name, variable_name, round_even(min(num), 2) AS stat_min,
         round_even(max(num), 2) AS stat_max, round_even(avg(num), 2) AS stat_mean,
         round_even(quantile_cont(num, 0.5), 2) AS stat_median,
         round_even(stddev_samp(num), 2) AS stat_sd,
         round_even(quantile_cont(num, 0.25), 2) AS stat_q25,
         round_even(quantile_cont(num, 0.75), 2) AS stat_q75,
         round_even(quantile_cont(num, 0.75) - quantile_cont(num, 0.25), 2) AS stat_iqr
  FROM (SELECT table_name, variable_name, num, unnest(range(n)) FROM valid
        WHERE inferred_type = 'numeric' AND num IS NOT NULL)
  GROUP BY ALL)
{select}
"""


def _number_text(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')"


def _issues_sql(source: str, kind: str) -> str:
    pct = "total_missing_pct"
    card = "round_even(unique_count / total_count * 100, 2)"
    base = "SELECT table_name, variable_name"
    return f"""
{base}, 'identifier_missing' AS issue_type, 'critical' AS severity,
  'Identifier column ' || variable_name || ' has ' || {_number_text(pct)} || '% missing values'
  AS description, {pct} AS value,
  'Investigate source data -- identifier fields must be complete.' AS recommendation
  FROM {source} WHERE {kind} = 'identifier' AND {pct} > 0
UNION ALL {base}, 'high_missingness', 'warning', variable_name || ' has ' || {_number_text(pct)}
  || '% missing values (threshold: 20%)', {pct},
  'Review data source; consider imputation or exclusion.'
  FROM {source} WHERE {kind} <> 'identifier' AND {pct} > 20
UNION ALL {base}, 'moderate_missingness', 'info', variable_name || ' has ' || {_number_text(pct)}
  || '% missing values', {pct}, 'Monitor; may need review before use.'
  FROM {source} WHERE {kind} <> 'identifier' AND {pct} > 10 AND {pct} <= 20
UNION ALL {base}, 'constant_value', 'info', variable_name || ' has only one unique value across '
  || total_count || ' rows', 1.0, 'Column provides no discriminating information.'
  FROM {source} WHERE unique_count = 1 AND total_count > 0
UNION ALL {base}, 'high_cardinality', 'info', variable_name || ' has ' || {_number_text(card)}
  || '% unique values (' || unique_count || ' of ' || total_count || ')', {card},
  'Verify this is expected; high cardinality may indicate free-text.'
  FROM {source} WHERE {kind} <> 'identifier' AND total_count > 10
   AND unique_count > 0 AND unique_count / total_count > 0.90
"""


_PROFILE = "SELECT * EXCLUDE (ordinal) FROM profile"
_SENTINELS = """SELECT table_name, variable_name, key AS sentinel_value,
 CAST(sentinel_count AS BIGINT) AS sentinel_count,
 round_even(sentinel_count / total * 100, 2) AS sentinel_pct, detection_method,
 CASE WHEN detection_method = 'config_list' THEN 'high' ELSE 'medium' END AS confidence
 FROM sentinels"""
_SCORE = """CASE WHEN coalesce({p}, 100) <= 5 AND coalesce({c}, 999) <= 0 THEN 'Excellent'
 WHEN coalesce({p}, 100) <= 10 AND coalesce({c}, 999) <= 2 THEN 'Good'
 WHEN coalesce({p}, 100) <= 20 AND coalesce({c}, 999) <= 5 THEN 'Fair' ELSE 'Needs Review' END"""
_SUMMARY = f"""
, per_table AS (
  SELECT table_name, max(total_count) AS row_count, count(*) AS variable_count,
         CAST(sum(CAST(round(valid_pct * 100) AS BIGINT)) AS BIGINT) AS cents,
         cents // count(*) AS low, 2 * (cents % count(*)) AS twice,
         CASE WHEN twice > count(*) OR (twice = count(*) AND low % 2 = 1) THEN (low + 1) / 100
              ELSE low / 100 END AS avg_valid_pct, min(valid_pct) AS min_valid_pct,
         max(total_missing_pct) AS max_missing_pct FROM profile GROUP BY ALL),
rated AS (
  SELECT table_name, count(*) FILTER (severity = 'critical') AS critical_issue_count,
         count(*) FILTER (severity = 'warning') AS warning_issue_count,
         count(*) FILTER (severity = 'info') AS info_issue_count FROM issues GROUP BY ALL),
worst AS (
  SELECT table_name, variable_name AS worst_variable,
         total_missing_pct AS worst_variable_missing_pct FROM profile
  QUALIFY row_number() OVER (PARTITION BY table_name
                             ORDER BY total_missing_pct DESC, ordinal) = 1),
summary AS (
  SELECT table_name, row_count, variable_count, avg_valid_pct, min_valid_pct, max_missing_pct,
         coalesce(critical_issue_count, 0) AS critical_issue_count,
         coalesce(warning_issue_count, 0) AS warning_issue_count,
         coalesce(info_issue_count, 0) AS info_issue_count,
         {_SCORE.format(p="max_missing_pct", c="coalesce(critical_issue_count, 0)")}
         AS quality_score, worst_variable, worst_variable_missing_pct
  FROM per_table LEFT JOIN rated USING (table_name) JOIN worst USING (table_name))
"""


def _quantile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = []
    for table, column in (("lineitem", "l_extendedprice"), ("orders", "o_totalprice"),
                          ("events", "value")):
        cells.append(load(spark, sf_dir, table).select(
            F.lit(column).alias("variable_name"), F.col(column).alias("v"), F.lit(1).alias("n")
        ).where("v IS NOT NULL"))
    values = cells[0].unionByName(cells[1]).unionByName(cells[2])
    found = exact_quantiles(values, "variable_name", "v", "n", [0.01, 0.25, 0.5, 0.75, 0.999])
    return found.select("variable_name", "fraction", F.bround("quantile", 4).alias("quantile"))


_QUANTILES = " UNION ALL ".join(
    f"SELECT '{c}' AS variable_name, CAST({q} AS DOUBLE) AS fraction, "
    f"round_even(quantile_cont({c}, {q}), 4) AS quantile FROM {t}"
    for t, c in (("lineitem", "l_extendedprice"), ("orders", "o_totalprice"), ("events", "value"))
    for q in (0.01, 0.25, 0.5, 0.75, 0.999)
)

# Each part is taken as a profiled variable of its brand.
PART_PROFILES = """
SELECT p_name || ' ' || CAST(p_partkey AS STRING) AS variable_name, p_brand AS table_name,
       CAST(p_size AS DOUBLE) / 2 AS total_missing_pct,
       CASE WHEN p_type = 'PROMO' THEN 'identifier' WHEN p_type = 'SMALL' THEN 'numeric'
            ELSE 'categorical' END AS column_type,
       CASE WHEN p_type = 'LARGE' THEN CAST(1 AS BIGINT) ELSE CAST(floor(p_retailprice) AS BIGINT) END
       AS unique_count, CAST(1000 AS BIGINT) AS total_count
FROM {part}
"""
PART_SCORES = """
SELECT p_partkey, CAST(p_size AS DOUBLE) / 2 AS max_missing_pct,
       CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type = 'STANDARD' THEN 1
            WHEN p_type = 'MEDIUM' THEN 4 WHEN p_type = 'LARGE' THEN 9 ELSE 0 END
       AS critical_count
FROM {part}
"""


def _issues_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = column_issues(derive(spark, sf_dir, PART_PROFILES), DEFAULTS)
    return found.select("table_name", "variable_name", "issue_type", "severity", "description",
                        "value", "recommendation")


def _scores_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, PART_SCORES)
    label = quality_score(F.col("max_missing_pct"), F.col("critical_count"), DEFAULTS)
    return rows.select("p_partkey", label.alias("quality_score"))


def _overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overall_score(profiler(spark, sf_dir, SMALL).summary())


def _modes(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    return _bare(profiler(spark, sf_dir, names).distributions()).drop("top_values_json")


_MODES = """
SELECT p.table_name, p.variable_name,
       CASE WHEN p.inferred_type <> 'numeric' THEN
              CASE WHEN r.value IS NOT NULL THEN 'categorical' END
            WHEN s.stat_min IS NOT NULL THEN 'numeric' END AS distribution_type,
       s.* EXCLUDE (table_name, variable_name), r.value AS mode_value, r.n AS mode_count,
       r.pct AS mode_pct
FROM profile p LEFT JOIN numeric_stats s USING (table_name, variable_name)
LEFT JOIN (SELECT * FROM ranked WHERE value_rank = 1) r USING (table_name, variable_name)
"""
_TOPS = """SELECT table_name, variable_name, CAST(value_rank AS INTEGER) AS value_rank, value,
 n, pct FROM ranked WHERE value_rank <= 15 AND inferred_type <> 'numeric'"""


def _tops(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    rows = profiler(spark, sf_dir, names).tops().where(F.col("inferred_type") != "numeric")
    return rows.select("table_name", "variable_name", "value_rank", "value", "n", "pct")


def _custom_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = profiling_settings({"missingness_thresholds": {"high": 30}})
    return _bare(Profiler(tables(spark, sf_dir, ["raw_orders"]), settings).issues())


QUERIES = {
    "profile_missingness": (
        lambda s, d: _bare(profiler(s, d, SMALL).profile()), profile_sql(SMALL, _PROFILE)),
    "profile_lineitem": (
        lambda s, d: _bare(profiler(s, d, ["lineitem"]).profile()),
        profile_sql(["lineitem"], _PROFILE)),
    "profile_texts": (
        lambda s, d: _bare(profiler(s, d, TEXTS).profile()), profile_sql(TEXTS, _PROFILE)),
    "type_inference": (
        lambda s, d: _bare(profiler(s, d, ALL).types()),
        profile_sql(ALL, "SELECT table_name, variable_name, inferred_type FROM types")),
    "sentinels": (
        lambda s, d: _bare(profiler(s, d, [*SMALL, "lineitem"]).sentinels()),
        profile_sql([*SMALL, "lineitem"], _SENTINELS)),
    "numeric_distribution": (
        lambda s, d: _bare(profiler(s, d, ["lineitem", "raw_orders", "part"]).numeric()),
        profile_sql(["lineitem", "raw_orders", "part"], "SELECT * FROM numeric_stats")),
    "numeric_distribution_refined": (
        lambda s, d: _bare(
            profiler(s, d, ["lineitem", "events"], small_distinct=0).numeric()),
        profile_sql(["lineitem", "events"], "SELECT * FROM numeric_stats")),
    "exact_quantiles": (_quantile_table, _QUANTILES),
    "categorical_distribution": (
        lambda s, d: _tops(s, d, ["raw_orders", "customer", "documents", "pages"]),
        profile_sql(["raw_orders", "customer", "documents", "pages"], _TOPS)),
    "value_distributions": (
        lambda s, d: _modes(s, d, [*SMALL, "lineitem", "conversations"]),
        profile_sql([*SMALL, "lineitem", "conversations"], _MODES)),
    "quality_issues": (
        lambda s, d: _bare(profiler(s, d, [*SMALL, *TEXTS]).issues()),
        profile_sql([*SMALL, *TEXTS], "SELECT * FROM issues")),
    "issue_rules": (_issues_of_parts, _issues_sql(plain(PART_PROFILES), "column_type")),
    "custom_thresholds": (
        _custom_profile,
        profile_sql(["raw_orders"], """SELECT * REPLACE (
            replace(description, '(threshold: 20%)', '(threshold: 30%)') AS description)
            FROM issues WHERE issue_type <> 'high_missingness' OR value > 30
            UNION ALL SELECT table_name, variable_name, 'moderate_missingness', 'info',
            variable_name || ' has ' || regexp_replace(CAST(total_missing_pct AS VARCHAR),
            '\\.0$', '') || '% missing values', total_missing_pct,
            'Monitor; may need review before use.' FROM profile
            WHERE inferred_type <> 'identifier' AND total_missing_pct > 20
              AND total_missing_pct <= 30""")),
    "quality_scores": (
        _scores_of_parts,
        "SELECT p_partkey, " + _SCORE.format(p="max_missing_pct", c="critical_count")
        + f" AS quality_score FROM {plain(PART_SCORES)}"),
    "table_summary": (
        lambda s, d: _bare(profiler(s, d, ALL).summary()),
        profile_sql(ALL, _SUMMARY + "SELECT * FROM summary")),
    "overall_score": (
        _overall,
        profile_sql(SMALL, _SUMMARY + """SELECT list_extract(['Excellent', 'Good', 'Fair',
          'Needs Review'], max(list_position(['Excellent', 'Good', 'Fair', 'Needs Review'],
          quality_score))) AS overall_score FROM summary""")),
}
