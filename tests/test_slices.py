"""Slices of lake tables: replacement, promotion by batch, harmonization reruns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakewright.operators import harmonization as har
from lakewright.operators import ingestion as ing
from lakewright.operators.profile_states import profile_of_states, refresh_states, stored_states
from lakewright.plans.profile_batch import profile_batch

TYPES = "table_name string, variable string, suggested_type string, final_type string"


def counts(df, *keys):
    return {tuple(r[k] for k in keys): r["count"] for r in df.groupBy(*keys).count().collect()}


def test_slice_replacement(lake, spark):
    df = spark.range(10).select("id", (F.col("id") * 2).alias("v"))
    lake.replace_slice("governance", "t", df, {"k": "a b/1", "j": "x'y"})
    lake.replace_slice("governance", "t", df.limit(3), {"k": "b", "j": "x"})
    # The new rows may be made of the old ones, and bring new columns.
    old = lake.read("governance", "t").where("k = 'a b/1' AND id < 4").select("id", "v")
    lake.replace_slice("governance", "t", old.withColumn("w", F.lit(1)), {"k": "a b/1", "j": "x'y"})
    lake.append("governance", "t", df.limit(2).withColumns({"k": F.lit("b"), "j": F.lit("x")}), ("k", "j"))
    assert counts(lake.read("governance", "t"), "k", "j") == {("a b/1", "x'y"): 4, ("b", "x"): 5}
    bad = df.select(F.concat(F.lit("z"), "id").cast("int").alias("id"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lake.replace_slice("governance", "t", bad, {"k": "b", "j": "x"})
    assert counts(lake.read("governance", "t"), "k")[("b",)] == 5
    lake.replace_slice("governance", "t", df.limit(0), {"k": "b", "j": "x"})
    assert counts(lake.read("governance", "t"), "k") == {("a b/1",): 4}
    lake.drop_slice("governance", "t", {"k": "b", "j": "x"})
    assert lake.slices("governance", "t") == [{"k": "a b/1", "j": "x'y"}]


def test_slices_leave_each_other(lake, spark):
    """Slices made by appending lie in the table's folder, also beside a column named Location."""
    df = spark.range(9).select("id", F.lit("x").alias("Location"), (F.col("id") % 3).cast("string").alias("k"))
    lake.append("governance", "t", df, ("k",))
    lake.replace_slice("governance", "t", df.where("k = '1'").limit(1).drop("k"), {"k": "1"})
    lake.drop_slice("governance", "t", {"k": "0"})
    assert counts(lake.read("governance", "t"), "k") == {("1",): 1, ("2",): 3}
    lake.replace_slices("governance", "t", df.drop("k").withColumn("k", F.lit("5")), {}, "k", ["2", "5"])
    assert counts(lake.read("governance", "t"), "k") == {("1",): 1, ("5",): 9}


def test_table_swap_and_recovery(lake, spark):
    df = spark.range(10).toDF("id")
    lake.replace("reference", "r", df)
    lake.replace("reference", "r", lake.read("reference", "r").limit(5), facts={"a.b": "it's"})
    assert lake.read("reference", "r").count() == 5 and lake.noted("reference", "r", "a.b") == "it's"
    lake.replace("reference", "r", lake.read("reference", "r").withColumn("x", F.lit(1)))
    assert lake.read("reference", "r").columns == ["id", "x"] and lake.tables("reference") == ["r"]
    # A swap that ended between its two renames.
    lake._rename("reference", "r", "aside_r_12345678")
    assert lake.recover("reference") == ["r"]
    assert lake.read("reference", "r").count() == 5 and lake.tables("reference") == ["r"]


def raw(lake, batch, *rows):
    df = lake.spark.createDataFrame(rows, "id string, weight string, _source_file string")
    lake.append("raw", "people", df.withColumn("_ingest_id", F.lit(batch)), ("_ingest_id",))


def test_promotion_by_batch(lake, spark):
    types = [("people", "weight", "NUMERIC(6,2)", None)]
    raw(lake, "I1", ("1", "70.5", "f"), ("2", None, "f"))
    first = ing.promote_to_staging(lake, "people", spark.createDataFrame(types, TYPES), "I1")
    assert (first["mode"], first["n_rows"], first["n_typed"]) == ("table", 2, 1)
    # The raw rows of the first batch become unreadable as numbers: the second does not read them.
    lake.drop_slice("raw", "people", {"_ingest_id": "I1"})
    raw(lake, "I1", ("1", "heavy", "f"))
    raw(lake, "I2", ("3", "81.25", "g"))
    second = ing.promote_to_staging(lake, "people", spark.createDataFrame(types, TYPES), "I2")
    assert (second["mode"], second["n_rows"]) == ("slices", 1)
    staged = {r["id"]: str(r["weight"]) for r in lake.read("staging", "people").collect()}
    assert staged == {"1": "70.50", "2": "None", "3": "81.25"}
    plan = ing.promoted(lake.read("raw", "people").where("_ingest_id = 'I2'"), {})._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_ingest_id" in plan
    # A batch that does not fit leaves its earlier slice.
    raw(lake, "I2", ("4", "light", "g"))
    assert ing.promote_to_staging(lake, "people", spark.createDataFrame(types, TYPES), "I2")["status"] == "error"
    assert lake.read("staging", "people").count() == 3
    # A new column joins; a changed type rebuilds the table.
    lake.drop_slice("raw", "people", {"_ingest_id": "I1"})
    lake.drop_slice("raw", "people", {"_ingest_id": "I2"})
    raw(lake, "I2", ("3", "81.25", "g"))
    more = spark.createDataFrame([("5", "1", "7", "h", "I3")], "id string, weight string, age string, _source_file string, _ingest_id string")
    lake.append("raw", "people", more, ("_ingest_id",))
    wider = spark.createDataFrame([*types, ("people", "age", "INTEGER", None)], TYPES)
    third = ing.promote_to_staging(lake, "people", wider, "I3")
    assert (third["mode"], third["n_rows"]) == ("slices", 1)
    assert dict(lake.read("staging", "people").dtypes)["age"] == "int"
    assert counts(lake.read("staging", "people"), "_ingest_id") == {("I2",): 1, ("I3",): 1}
    changed = spark.createDataFrame([("people", "weight", "DOUBLE PRECISION", None)], TYPES)
    assert ing.promote_to_staging(lake, "people", changed, "I3")["mode"] == "table"
    assert dict(lake.read("staging", "people").dtypes)["weight"] == "double"


def test_harmonization_rerun(lake, spark):
    for table, n in (("people", 3), ("visitors", 2)):
        df = spark.range(n).select(F.col("id").cast("string").alias("pid"), F.lit("5").alias("age"), F.lit("I1").alias("_ingest_id"))
        lake.append("staging", table, df, ("_ingest_id",))
    lines = [("A", t, c, "demographics", c2, "expression" if c == "age" else "direct", "cast(age as int)" if c == "age" else None, None, None, None)
             for t in ("people", "visitors") for c, c2 in (("pid", "patient_key"), ("age", "age"))]
    mappings = spark.createDataFrame(lines, ", ".join(f"{c} string" for c in (
        "source_type", "source_table", "source_column", "target_table", "target_column", "transform_type",
        "transform_expression", "is_active", "priority", "notes")))
    har.sync_harmonization_map(lake, mappings)
    metadata = [("A", t, c, "demographics", v, None, True, False) for t in ("people", "visitors") for c, v in (("pid", "patient_key"), ("age", "age"))]
    lake.replace("reference", "metadata", spark.createDataFrame(
        metadata, "source_type string, lake_table_name string, lake_variable_name string, validated_table_target string, "
        "validated_variable_name string, target_type string, is_active boolean, is_identifier boolean"))
    assert har.harmonize_table(lake, "demographics", "I1")["rows_inserted"] == 5
    # People can no longer be computed: their rows stay, visitors are made anew.
    bad = spark.createDataFrame([("9", "old")], "pid string, age string")
    lake.replace_slice("staging", "people", bad, {"_ingest_id": "I1"})
    lake.replace_slice("staging", "visitors", bad.withColumn("age", F.lit("6")), {"_ingest_id": "I1"})
    again = har.harmonize_table(lake, "demographics", "I1")
    assert (again["sources_failed"], again["rows_inserted"]) == (1, 1)
    rows = counts(lake.read("validated", "demographics"), "source_table", "age")
    assert rows == {("people", "5"): 3, ("visitors", "6"): 1}
    log = {r["source_table"]: r for r in lake.read("governance", "transform_log").collect()}
    assert (log["people"]["status"], log["people"]["source_row_count"]) == ("failed", 1)
    # A source that is no longer mapped goes; one without rows leaves an empty slice.
    lake.replace_slice("staging", "visitors", bad.limit(0), {"_ingest_id": "I1"})
    lake.replace("reference", "harmonization_map", lake.read("reference", "harmonization_map").where("source_table = 'visitors'"))
    assert har.harmonize_table(lake, "demographics", "I1")["rows_inserted"] == 0
    assert lake.read("validated", "demographics").count() == 0


def test_failing_groups_are_halved(lake, spark, tmp_path, monkeypatch):
    paths = []
    for i in range(16):
        paths.append(str(tmp_path / f"labs_{2000 + i}.csv"))
        (tmp_path / f"labs_{2000 + i}.csv").write_text("Value\n1\n")
    dictionary = spark.createDataFrame(
        [("A", "lab_results", "Value", "labs", "value")],
        "source_type string, source_table_name string, source_variable_name string, lake_table_name string, lake_variable_name string")
    tries = []

    def load(lake, paths, *rest):
        tries.append(len(paths))
        if any(p.endswith("labs_2011.csv") for p in paths):
            raise RuntimeError("unreadable " + "x" * 3000)
        return good(lake, paths, *rest)

    good = ing._load_group
    monkeypatch.setattr(ing, "_load_group", load)
    ing.open_batch(lake, "I1", "S", paths)
    result = ing.ingest_batch(lake, "I1", "S", "A", dictionary)
    assert (result["n_success"], result["n_error"]) == (15, 1) and len(tries) == 9
    assert lake.read("raw", "labs").count() == 15
    assert len(next(iter(result["errors"].values()))) > 3000


def test_profiles_by_batch(lake, spark):
    """The second batch's profile covers both, and reads its own slice of the raw table alone."""
    long = "x" * 300
    def load(batch, *rows):
        df = spark.createDataFrame(rows, "code string, note string")
        lake.replace_slice("raw", "visits", df, {"_ingest_id": batch})
        log = spark.createDataFrame([("visits", "success")], "lake_table_name string, load_status string")
        lake.replace_slice("governance", "ingest_file_log", log, {"ingest_id": batch})
        lake.replace_slice("governance", "batch_log", spark.createDataFrame([("success",)], "status string"), {"ingest_id": batch})

    load("I1", ("1", long + "a"), ("2", None), ("N/A", long + "a"))
    first = profile_batch(lake, "I1")
    assert (first["tables_profiled"], first["sentinels_detected"]) == (1, 1)
    # Were the first batch read again, its missing file would show.
    place = lake._location("raw", "visits", {"_ingest_id": "I1"})
    kept = place + "-kept"
    files = lake._filesystem(place)
    files[0].rename(files[1], lake._filesystem(kept)[1])
    files[0].mkdirs(files[1])
    load("I2", ("3", ""), ("4", "short"), ("2", long + "b"))
    assert refresh_states(lake, "raw", ["visits"], "I2") == ["I2"]
    states = stored_states(lake, "raw", ["visits"])
    profile = {r["variable_name"]: r for r in profile_of_states(states, {"visits": lake.read("raw", "visits").drop("_ingest_id")}).profile().collect()}
    note = profile["note"]
    assert (note["total_count"], note["na_count"], note["empty_count"], note["unique_count"]) == (6, 1, 1, 3)
    assert (profile["code"]["unique_count"], profile["code"]["sentinel_count"]) == (4, 1)
    files[0].delete(files[1], True)
    files[0].rename(lake._filesystem(kept)[1], files[1])
    assert profile_batch(lake, "I2")["variables_profiled"] == 2
    modes = {r["variable_name"]: r["mode_value"] for r in lake.read("governance", "data_profile_distribution").where("ingest_id = 'I2'").collect()}
    assert modes == {"code": "2", "note": long + "a"}
    # A later column is NULL in earlier batches; other placeholders make earlier states stale.
    wider = spark.createDataFrame([("7", "n", "new")], "code string, note string, extra string")
    lake.replace_slice("raw", "visits", wider, {"_ingest_id": "I3"})
    assert refresh_states(lake, "raw", ["visits"], "I3") == ["I3"]
    tables = {"visits": lake.read("raw", "visits").drop("_ingest_id")}
    extra = [r for r in profile_of_states(stored_states(lake, "raw", ["visits"]), tables).profile().collect() if r["variable_name"] == "extra"][0]
    assert (extra["total_count"], extra["na_count"]) == (7, 6)
    settings = {"sentinel_detection": {"string_sentinels": ["short"]}}
    assert refresh_states(lake, "raw", ["visits"], "I3", settings) == ["I1", "I2", "I3"]
    # The type of a column changes, as after a promotion.
    numbers = lake.read("raw", "visits").withColumn("code", F.expr("try_cast(code AS INT)"))
    lake.replace("raw", "visits", numbers, ("_ingest_id",))
    assert refresh_states(lake, "raw", ["visits"], "I3", settings) == ["I1", "I2", "I3"]


def test_created_raw_table_takes_batches(lake, spark):
    expected = spark.createDataFrame(
        [("People", "id", "text"), ("People", "weight", "text"), ("People", "later", "text")],
        "lake_table_name string, lake_variable_name string, type_descriptor string")
    assert ing.create_raw_table(lake, expected, "people")["status"] == "created"
    raw(lake, "I1", ("1", "70.5", "f"))
    raw(lake, "I2", ("2", "80", "g"))
    assert counts(lake.read("raw", "people"), "_ingest_id", "later") == {("I1", None): 1, ("I2", None): 1}
    types = spark.createDataFrame([("people", "weight", "NUMERIC(6,2)", None)], TYPES)
    assert ing.promote_to_staging(lake, "people", types)["n_rows"] == 2
    assert [s["_ingest_id"] for s in lake.slices("staging", "people")] == ["I1", "I2"]


def test_schema_validity(lake, spark):
    from datetime import date

    from lakewright.operators import schema_versions as sv

    def publish(day, tables, until=None):
        rows = [("lake", name, "x", f"v{day}", kind) for name, kind in tables.items()]
        sv.publish_schema(lake, spark.createDataFrame(
            rows, "table_schema string, lake_table_name string, lake_variable_name string, schema_version string, table_schema_hash string"), day, until)

    one, two, three = date(2025, 1, 1), date(2025, 3, 1), date(2025, 5, 1)
    publish(two, {"same": "z"})
    publish(one, {"same": "a", "gone": "a", "changed": "a", "back": "a"})
    publish(two, {"same": "a", "changed": "b", "late": "a"})  # in place of the first of that day
    publish(three, {"same": "a", "changed": "b", "back": "a", "late": "a"}, date(2025, 12, 31))
    history = sv.schema_history(sv.published_schemas(lake))
    found = {(r["lake_table_name"], r["effective_from"], r["effective_to"], r["schema_version"]) for r in history.collect()}
    end = date(2025, 12, 31)
    assert found == {
        ("same", one, end, f"v{one}"), ("gone", one, date(2025, 2, 28), f"v{one}"), ("changed", one, date(2025, 2, 28), f"v{one}"),
        ("changed", two, end, f"v{two}"), ("back", one, date(2025, 2, 28), f"v{one}"), ("back", three, end, f"v{three}"),
        ("late", two, end, f"v{two}"),
    }
    asked = [("gone", date(2025, 2, 28)), ("gone", two), ("changed", two), ("back", date(2025, 4, 1)), ("same", date(2026, 1, 1)), (None, two), ("same", None)]
    rows = spark.createDataFrame(asked, "lake_table_name string, day date")
    held = {(r["lake_table_name"], r["day"]): r["schema_version"] for r in sv.schemas_in_force(rows, history, "day").collect()}
    assert held == dict(zip(asked, [f"v{one}", None, f"v{two}", None, None, None, None]))
    with pytest.raises(ValueError):
        publish(three, {"same": "a"}, two)
