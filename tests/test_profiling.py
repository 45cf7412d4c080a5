from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakewright.operators.profiling import Profiler, column_issues, profile_table, quality_score
from lakewright.operators.settings import DEFAULTS, profiling_settings


def column(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` string")


def one_type(spark, name, values):
    return Profiler({"t": column(spark, name, values)}).types().first()["inferred_type"]


@pytest.mark.parametrize("name", [
    "ACCOUNTNO", "accountno", "mrn", "cisir_id", "patient_id", "record_no", "id_visit",
])
def test_identifier_by_name(spark, name):
    assert one_type(spark, name, ["100", "200", "300"]) == "identifier"


@pytest.mark.parametrize("name, values, kind", [
    ("weight_kg", ["1.5", "2.7", "3.9", "4.1", "5.0", None, "6.3", "7.8", "8.2", "9.4"], "numeric"),
    ("admission_date", ["2025-01-15", "2025-02-20", "2025-03-10", "2025-04-01", "2025-05-25"],
     "date"),
    ("dob", ["01/15/2025", "02/20/2025", "03/10/2025", "04/01/2025", "05/25/2025"], "date"),
    ("seen", ["15-Jan-2025", "3-feb-2025 10:00"], "date"),
    ("seen", ["2025-02-30", "2025-13-01"], "categorical"),
    ("gender", ["Male", "Female", "Male", "Female", "Other"], "categorical"),
    ("some_col", [None, None, None], "categorical"),
    ("some_col", ["", "", "", "  "], "categorical"),
    ("mixed_col", [*map(str, range(1, 9)), "abc", "def"], "categorical"),
    ("edge", [*map(str, range(1, 10)), "abc"], "categorical"),
])
def test_type_by_content(spark, name, values, kind):
    assert one_type(spark, name, values) == kind


def sentinels(spark, values, name="col"):
    rows = Profiler({"t": column(spark, name, values)}).sentinels().collect()
    return {r["sentinel_value"]: (r["sentinel_count"], r["detection_method"], r["confidence"])
            for r in rows}


def test_sentinels(spark):
    assert sentinels(spark, ["10", "20", "999", "30", "999", "40"]) == {
        "999": (2, "config_list", "high")}
    assert sentinels(spark, ["Active", "UNKNOWN", "Active", "unknown", "Active"]) == {
        "UNKNOWN": (2, "config_list", "high")}
    assert sentinels(spark, ["10", "20", "30", "40", "50"]) == {}
    assert sentinels(spark, [None, None, None]) == {}
    assert sentinels(spark, ["10", "20", "55", "30", "55"]) == {
        "55": (2, "frequency_analysis", "medium")}
    # A number that is only in a text column is no placeholder; padded ones count.
    assert sentinels(spark, ["a", "b", "999", "c"]) == {}
    assert sentinels(spark, ["1", " 999 ", "999", "999.0"]) == {"999": (2, "config_list", "high")}


def test_frequent_sentinel_needs_few_values(spark):
    few = [str(i) for i in range(100, 149)] + ["5555"] * 5  # 50 distinct values
    assert "5555" in sentinels(spark, few)
    assert "5555" not in sentinels(spark, [*few, "7000"])
    padded = [*few, " 100", "101 "]  # the same 50 values once trimmed
    assert "5555" in sentinels(spark, padded)


def test_missingness_classes(spark):
    values = ["hello", None, "", "  ", "world", "UNKNOWN", None, "test"]
    row = Profiler({"t": column(spark, "c", values)}).profile().first()
    assert (row["total_count"], row["na_count"], row["empty_count"], row["whitespace_count"],
            row["sentinel_count"], row["valid_count"]) == (8, 2, 1, 1, 1, 3)
    assert row["total_missing_count"] == 5 and row["total_missing_pct"] == 62.5
    values = ["A", "A", "B", None, "", "  "]
    row = Profiler({"t": column(spark, "c", values)}).profile().first()
    assert (row["unique_count"], row["valid_count"], row["unique_pct"]) == (2, 3, 66.67)
    row = Profiler({"t": column(spark, "c", ["A", None, "B", "C", None])}).profile().first()
    assert (row["na_pct"], row["valid_pct"], row["total_missing_pct"]) == (40.0, 60.0, 40.0)
    row = Profiler({"t": column(spark, "c", ["unknown", "UNKNOWN", "x"])}).profile().first()
    assert (row["sentinel_count"], row["valid_count"]) == (2, 1)


def test_numeric_distribution(spark):
    row = Profiler({"t": column(spark, "c", ["1", "2", "3", "4", "5"])}).distributions().first()
    assert (row["stat_min"], row["stat_max"], row["stat_mean"], row["stat_median"]) == (1, 5, 3, 3)
    assert (row["stat_sd"], row["stat_q25"], row["stat_q75"], row["stat_iqr"]) == (1.58, 2, 4, 2)
    assert row["distribution_type"] == "numeric" and row["top_values_json"] is None
    row = Profiler({"t": column(spark, "c", ["10", "20", "30", "999"])}).distributions().first()
    assert (row["stat_min"], row["stat_max"], row["stat_mean"]) == (10, 30, 20)
    row = Profiler({"t": column(spark, "c", [None, None])}).distributions().first()
    assert row["distribution_type"] is None and row["mode_value"] is None
    row = Profiler({"t": column(spark, "c", ["10", None, "", "  ", "20", "30"])}) \
        .distributions().first()
    assert (row["stat_min"], row["stat_max"], row["stat_mean"]) == (10, 30, 20)
    row = Profiler({"t": column(spark, "c", ["7"])}).distributions().first()
    assert row["stat_sd"] is None and row["stat_median"] == 7


def test_categorical_distribution_and_long_texts(spark):
    row = Profiler({"t": column(spark, "c", list("ABACAB"))}).distributions().first()
    assert (row["mode_value"], row["mode_count"], row["mode_pct"]) == ("A", 3, 50.0)
    assert json.loads(row["top_values_json"]) == [
        {"value": "A", "count": 3, "pct": 50.0}, {"value": "B", "count": 2, "pct": 33.33},
        {"value": "C", "count": 1, "pct": 16.67}]
    base = "word " * 500
    texts = [base + "one", base + "one", base + "two", "short"]
    row = Profiler({"t": column(spark, "c", texts)}).distributions().first()
    assert row["mode_value"] == base + "one" and row["mode_count"] == 2
    assert len(json.loads(row["top_values_json"])) == 3
    profile = Profiler({"t": column(spark, "c", texts)}).profile().first()
    assert profile["unique_count"] == 3


def test_long_texts_are_judged_whole(spark):
    feeds, digits = "\f" * 64 + "words " * 30, "7" * 64 + " words" * 30
    row = Profiler({"t": column(spark, "c", [feeds, digits, "\f" * 200])}).profile().first()
    assert (row["whitespace_count"], row["valid_count"], row["inferred_type"]) == \
        (1, 2, "categorical")
    numbers = Profiler({"t": column(spark, "c", [digits + str(i) for i in range(20)])})
    assert numbers.types().first()["inferred_type"] == "categorical"
    placeholder = "not recorded at the time of the visit " * 5
    settings = profiling_settings(
        {"sentinel_detection": {"string_sentinels": [placeholder.strip()]}})
    values = [placeholder, placeholder.upper(), placeholder + "x", "short"]
    profiler = Profiler({"t": column(spark, "c", values)}, settings)
    found = profiler.sentinels().collect()
    assert [(r["sentinel_value"], r["sentinel_count"]) for r in found] == \
        [(placeholder.strip(), 2)]
    row = profiler.profile().first()
    assert (row["sentinel_count"], row["valid_count"], row["unique_count"]) == (2, 2, 2)
    assert {r["value"] for r in profiler.tops().collect()} == {placeholder + "x", "short"}


@pytest.mark.parametrize("name, pct, kind, unique, total, expected", [
    ("ACCOUNTNO", 5.0, "identifier", 100, 200, {"identifier_missing"}),
    ("some_var", 25.0, "categorical", 10, 100, {"high_missingness"}),
    ("some_var", 15.0, "categorical", 10, 100, {"moderate_missingness"}),
    ("some_var", 20.0, "categorical", 10, 100, {"moderate_missingness"}),
    ("some_var", 10.0, "categorical", 10, 100, set()),
    ("status", 0.0, "categorical", 1, 100, {"constant_value"}),
    ("free_text", 0.0, "categorical", 95, 100, {"high_cardinality"}),
    ("patient_id", 0.0, "identifier", 95, 100, set()),
    ("value", 0.0, "categorical", 10, 10, set()),
    ("weight", 2.0, "numeric", 50, 100, set()),
    ("ACCOUNTNO", 25.0, "identifier", 50, 100, {"identifier_missing"}),
])
def test_issues(spark, name, pct, kind, unique, total, expected):
    rows = spark.createDataFrame(
        [(name, "t", pct, kind, unique, total)],
        "variable_name string, table_name string, total_missing_pct double, "
        "column_type string, unique_count bigint, total_count bigint")
    assert {r["issue_type"] for r in column_issues(rows, DEFAULTS).collect()} == expected


def test_issue_wording(spark):
    rows = spark.createDataFrame(
        [("v", "t", 25.0, "categorical", 10, 100)],
        "variable_name string, table_name string, total_missing_pct double, "
        "column_type string, unique_count bigint, total_count bigint")
    issue = column_issues(rows, DEFAULTS).first()
    assert issue["description"] == "v has 25% missing values (threshold: 20%)"
    assert issue["value"] == 25.0


def test_quality_scores(spark):
    cases = [
        (3.0, 0, "Excellent"), (8.0, 1, "Good"), (15.0, 3, "Fair"), (25.0, 10, "Needs Review"),
        (3.0, 1, "Good"), (3.0, 3, "Fair"), (3.0, 6, "Needs Review"),
        (None, 0, "Needs Review"), (3.0, None, "Needs Review"), (None, None, "Needs Review"),
        (5.0, 0, "Excellent"), (5.01, 0, "Good"),
    ]
    df = spark.createDataFrame(cases, "p double, c int, want string")
    got = df.select(quality_score(F.col("p"), F.col("c"), DEFAULTS).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_table_profile_and_empty_table(spark):
    df = spark.createDataFrame(
        [("1", "a", None), ("2", "b", None), ("3", "a", None), (None, "b", "x")],
        "patient_id string, kind string, note string")
    result = profile_table(df, "visits", ingest_id="I1", schema_name="raw")
    summary = result.summary.first()
    assert (summary["row_count"], summary["variable_count"]) == (4, 3)
    assert (summary["worst_variable"], summary["max_missing_pct"]) == ("note", 75.0)
    assert summary["critical_issue_count"] == 1 and summary["quality_score"] == "Needs Review"
    assert result.profile.count() == 3 and result.distributions.count() == 3
    empty = profile_table(df.where("false"), "visits", ingest_id="I1")
    row = empty.summary.first()
    assert (row["row_count"], row["variable_count"], row["quality_score"]) == (0, 3, "Excellent")
    assert row["worst_variable"] is None
    assert empty.profile.isEmpty() and empty.distributions.isEmpty() and empty.issues.isEmpty()


def test_typed_columns_profile_like_text(spark):
    df = spark.createDataFrame([(99.0, True), (1.5, False), (3.0, True)], "x double, b boolean")
    assert {r["sentinel_value"] for r in Profiler({"t": df}).sentinels().collect()} == {"99"}


def test_classes_sum_to_total(spark):
    values = ["NA", "na ", None, "", " ", "\t", "x", "999", "1", "12", "MISSING"] * 7
    row = Profiler({"t": column(spark, "c", values)}).profile().first()
    parts = sum(row[f"{k}_count"] for k in ("na", "empty", "whitespace", "sentinel", "valid"))
    assert parts == row["total_count"] == len(values)


def test_settings():
    merged = profiling_settings({"missingness_thresholds": {"high": 30}})
    assert merged["missingness_thresholds"] == {"critical": 0, "high": 30, "moderate": 10}
    assert profiling_settings("/no/such/file.yml") == DEFAULTS


def test_few_values_are_counted_trimmed_without_holding_all_texts(spark):
    numbers = [str(i) for i in range(100, 149)] + ["5555"] * 5
    # Padded variants and padded words are the same trimmed texts; bare ones are over the limit alone.
    assert "5555" in sentinels(spark, [*numbers, *[f" {v} " for v in numbers], *["\t" + v for v in numbers]])
    assert "5555" in sentinels(spark, [*numbers[1:], "abc", " abc", "abc\t"])
    assert "5555" not in sentinels(spark, [*numbers, " 7000"])
    padded = [f" {v}" for v in (*range(1000, 1060), *[5555] * 9)]  # none is bare, 61 texts
    assert "5555" not in sentinels(spark, padded)
    profiler = Profiler({"t": column(spark, "c", [*map(str, range(3000)), *["77"] * 99])}).store()
    assert profiler.groups.where("texts IS NOT NULL").count() == 0  # too many: none counted


def test_counts_are_merged_in_small_partitions(spark, monkeypatch):
    from lakewright import session

    seen, keys = [], ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k) for k in keys]
    real = session.written

    def noted(df):
        seen.append(int(df.sparkSession.conf.get(keys[0])))
        return real(df)

    monkeypatch.setattr("lakewright.operators.profiling.written", noted)
    Profiler({"t": column(spark, "c", ["1", "2"])}).profile()
    assert seen[0] >= session.FINE_PARTITIONS and [spark.conf.get(k) for k in keys] == before
