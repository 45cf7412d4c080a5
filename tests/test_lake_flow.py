"""Registration, ingestion, validation, profiling and harmonization on a small lake."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lakewright.operators import dictionary as dic
from lakewright.operators import harmonization as har
from lakewright.operators import ingestion as ing
from lakewright.operators.lineage import register_source
from lakewright.operators.schema_check import validate_schema
from lakewright.plans.profile_batch import profile_batch
from lakewright.plans.review import raw_table_listing, validated_counts
from lakewright.streaming.incoming import ingest_arrivals

DICT_COLUMNS = (
    "source_type string, source_table_name string, source_variable_name string, "
    "data_type string, lake_table_name string, lake_variable_name string, is_required string, "
    "validated_table_target string, validated_variable_name string"
)
DICTIONARY = [
    ("REG_A", "Patients", "Patient ID", "text", "people", "patient_id", "Y", "demographics",
     "patient_key"),
    ("REG_A", "Patients", "Weight (kg)", "text", "people", "weight_kg", "N",
     "demographics, vitals", "weight_kg"),
    ("REG_A", "Patients", "Born", "text", "people", "birth_date", "N", "demographics", "born"),
    ("REG_A", "Patients", "Absent", "text", "people", "absent", "N", None, None),
    ("REG_A", "lab_results", "Value", "text", "labs", "value", "N", "labs", "result_value"),
    ("REG_A", "lab_results", "Test Name", "text", "labs", "test_name", "N", "labs", "test_name"),
]
TYPES = [
    ("people", "weight_kg", "text", "NUMERIC(6,2)", "ok"),
    ("people", "birth_date", "text", "DATE", "ok"),
    ("labs", "value", "double precision", None, None),
]


@pytest.fixture
def incoming(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    (folder / "patients.csv").write_text(
        'Patient ID,Weight (kg),Born,Extra\n1,70.5,2001-02-03,x\n2,,1/5/1999,"a, ""b""\nc"\n')
    (folder / "labs_2019.csv").write_text("Test Name,Value\nNa,135.5\nK,4\n")
    (folder / "labs_2020.csv").write_text("Value,Test Name\n1e3,Ca\n")
    return folder


def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, DICT_COLUMNS)


def decisions(spark):
    return spark.createDataFrame(
        TYPES, "table_name string, variable string, suggested_type string, final_type string, "
               "decision_note string")


def ingest(lake, folder, ingest_id="I1", **options):
    return ing.ingest_folder(
        lake, str(folder), ingest_id, "SRC", dictionary(lake.spark), **options)


def test_register_source(lake):
    fields = dict(source_id="S1", source_name="Source", system_type="CSV",
                  update_frequency="monthly", data_owner="o", ingest_method="pull",
                  expected_schema_version="1.0.0", pii_classification="PHI")
    assert register_source(lake, **fields) == "insert"
    assert register_source(lake, **{**fields, "source_name": "New"}) == "update"
    row = lake.read("governance", "source_registry").first()
    assert row["source_name"] == "New" and row["active"]
    with pytest.raises(ValueError, match="system_type"):
        register_source(lake, **{**fields, "system_type": "NOT_A_TYPE"})
    with pytest.raises(ValueError, match="missing required"):
        register_source(lake, source_id="S2")
    actions = [r["action"] for r in lake.read("governance", "audit_log").collect()]
    assert sorted(actions) == [
        "source_registration|success|table|governance.source_registry",
        "source_update|success|table|governance.source_registry"]


def test_ingest_batch(lake, incoming):
    result = ingest(lake, incoming, type_decisions=decisions(lake.spark))
    assert (result["status"], result["n_files"], result["n_error"]) == ("success", 3, 0)
    people = lake.read("raw", "people").orderBy("patient_id").collect()
    assert [r["weight_kg"] for r in people] == ["70.5", None]
    assert people[0]["absent"] is None and people[0]["_ingest_id"] == "I1"
    labs = {r["test_name"]: (r["value"], r["lab_year"]) for r in lake.read("raw", "labs").collect()}
    assert labs == {"Na": ("135.5", "2019"), "K": ("4", "2019"), "Ca": ("1e3", "2020")}
    log = {r["file_name"]: r for r in lake.read("governance", "ingest_file_log").collect()}
    text = (incoming / "patients.csv").read_bytes()
    assert log["patients.csv"]["checksum"] == hashlib.md5(text).hexdigest()
    assert log["patients.csv"]["file_size_bytes"] == len(text)
    assert {f: r["row_count"] for f, r in log.items()} == {
        "patients.csv": 2, "labs_2019.csv": 2, "labs_2020.csv": 1}
    batch = lake.read("governance", "batch_log").first()
    assert batch["status"] == "success" and batch["batch_completed_at_utc"] is not None
    staged = dict(lake.read("staging", "labs").dtypes)
    assert staged["value"] == "double" and staged["test_name"] == "string"
    with pytest.raises(ValueError, match="already exists"):
        ing.open_batch(lake, "I1", "SRC", ["x.csv"])


def test_too_wide_lines_are_logged(lake, incoming):
    path = sorted(incoming.glob("*.csv"))[0]
    width = len(path.read_text().split("\n")[0].split(","))
    path.write_text(path.read_text().rstrip("\n") + "\n" + ",".join(["9"] * width) + ",,LOST\n")
    result = ingest(lake, incoming)
    assert list(result["notes"]) == [str(path)] and result["notes"][str(path)].startswith("1 lines")
    log = lake.read("governance", "batch_log").first()
    assert str(path) in log["error_message"] and log["status"] == "success"


def test_strict_promotion_keeps_old_table(lake, incoming):
    good = decisions(lake.spark)
    (incoming / "patients.csv").write_text("Patient ID,Weight (kg),Born\n1,70.5,2001-02-03\n")
    ingest(lake, incoming, type_decisions=good)
    assert dict(lake.read("staging", "people").dtypes)["weight_kg"] == "decimal(6,2)"
    (incoming / "patients.csv").write_text("Patient ID,Weight (kg),Born\n3,heavy,2001-02-03\n")
    result = ingest(lake, incoming, "I2", type_decisions=good)
    assert result["status"] == "success"
    failed = [p for p in result["promotions"] if p["lake_table"] == "people"][0]
    assert failed["status"] == "error"
    assert lake.read("staging", "people").count() == 1
    assert lake.read("raw", "people").count() == 2
    assert not [t for t in lake.tables("staging") if t.startswith("swap_")]
    results = ing.backfill_staging(lake, good, "missing_only")
    assert results == []


def test_missing_and_unknown_files(lake, incoming):
    (incoming / "strange.csv").write_text("x,y\n1,2\n")
    paths = [str(incoming / n) for n in ("patients.csv", "gone.csv", "strange.csv")]
    ing.open_batch(lake, "I1", "SRC", paths)
    pending = lake.read("governance", "ingest_file_log").collect()
    assert {r["load_status"] for r in pending} == {"pending"} and len(pending) == 3
    result = ing.ingest_batch(lake, "I1", "SRC", "REG_A", dictionary(lake.spark))
    assert (result["status"], result["n_files"], result["n_success"]) == ("partial", 3, 1)
    log = {r["file_name"]: r for r in lake.read("governance", "ingest_file_log").collect()}
    assert log["gone.csv"]["load_status"] == "error" and log["gone.csv"]["row_count"] is None
    assert log["strange.csv"]["lake_table_name"] is None
    # A repeated run replaces the batch's own rows.
    ing.ingest_batch(lake, "I1", "SRC", "REG_A", dictionary(lake.spark))
    assert lake.read("raw", "people").count() == 2


def test_new_columns_widen_raw_table(lake, incoming):
    ingest(lake, incoming)
    more = lake.spark.createDataFrame(
        [*DICTIONARY, ("REG_A", "Patients", "Extra", "text", "people", "extra", "N", None, None)],
        DICT_COLUMNS)
    ing.ingest_folder(lake, str(incoming), "I2", "SRC", more)
    rows = {(r["_ingest_id"], r["patient_id"]): r["extra"]
            for r in lake.read("raw", "people").collect()}
    assert rows == {("I1", "1"): None, ("I1", "2"): None, ("I2", "1"): "x",
                    ("I2", "2"): 'a, "b"\nc'}


def test_validation(lake, incoming):
    ingest(lake, incoming)
    spark = lake.spark
    dic.sync_metadata(lake, dictionary(spark), decisions=decisions(spark))
    lake.append("raw", "people", spark.createDataFrame([("z", "I1")], "surprise string, _ingest_id string"),
                ("_ingest_id",))
    with pytest.raises(RuntimeError, match="critical"):
        validate_schema(lake, "I1")
    logged = lake.read("governance", "structure_qc_table")
    codes = {(r["issue_code"], r["lake_variable_name"]) for r in logged.collect()}
    assert ("SCHEMA_UNEXPECTED_COLUMN", "surprise") in codes
    assert ("TYPE_TARGET_MISMATCH", "weight_kg") in codes
    result = validate_schema(lake, "I1", source_type="reg_a", halt_on_error=False)
    assert not result["success"] and result["critical_count"] >= 1
    with pytest.raises(ValueError, match="not found"):
        validate_schema(lake, "NOPE")


def test_metadata_sync_versions(lake):
    spark = lake.spark
    first = dic.sync_metadata(lake, dictionary(spark))
    assert (first["version_number"], first["adds"]) == (1, 17 * len(DICTIONARY))
    again = dic.sync_metadata(lake, dictionary(spark))
    assert (again["version_number"], again["updates"], again["removes"]) == (2, 0, 0)
    fewer = spark.createDataFrame(DICTIONARY[:-1], DICT_COLUMNS)
    third = dic.sync_metadata(lake, fewer)
    assert third["removes"] == 17
    gone = lake.read("reference", "metadata").where("NOT is_active").collect()
    assert [r["lake_variable_name"] for r in gone] == ["test_name"]
    assert gone[0]["version_number"] == 3
    back = dic.sync_metadata(lake, dictionary(spark))
    assert back["adds"] == 17
    twice = spark.createDataFrame([DICTIONARY[0], DICTIONARY[0]], DICT_COLUMNS)
    with pytest.raises(ValueError, match="duplicate key"):
        dic.sync_metadata(lake, twice)


def test_sync_of_one_source_leaves_others(lake):
    spark = lake.spark
    other = [("REG_B", *r[1:]) for r in DICTIONARY[:2]]
    dic.sync_metadata(lake, spark.createDataFrame([*DICTIONARY, *other], DICT_COLUMNS))
    only = spark.createDataFrame(other[:1], DICT_COLUMNS)
    result = dic.sync_metadata(lake, only, source_type="REG_B")
    assert result["removes"] == 17
    active = lake.read("reference", "metadata").where("is_active").groupBy("source_type").count()
    assert {r[0]: r[1] for r in active.collect()} == {"REG_A": 6, "REG_B": 1}


def test_refresh_chain(lake):
    spark = lake.spark
    result = dic.refresh_metadata(lake, dictionary(spark))
    assert result["status"] == "success"
    assert result["ingest_dictionary"]["tables_synced"] == 2
    assert result["type_decisions"]["new_rows"] == len(DICTIONARY)
    assert raw_table_listing(lake).isEmpty()
    bad = dic.refresh_metadata(lake, dictionary(spark).drop("source_table_name"))
    assert bad["status"] == "error" and bad["failed_step"] == "ingest_dictionary"


def test_profile_batch_is_repeatable(lake, incoming):
    ingest(lake, incoming)
    first = profile_batch(lake, "I1")
    assert first["tables_profiled"] == 2
    counts = {t: lake.read("governance", t).count() for t in (
        "data_profile", "data_profile_distribution", "data_profile_issue",
        "data_profile_summary")}
    assert profile_batch(lake, "I1") == first
    assert counts == {t: lake.read("governance", t).count() for t in counts}
    stored = lake.read("governance", "data_profile")
    assert {r["inferred_type"] for r in stored.where("variable_name = 'patient_id'").collect()} \
        == {"identifier"}
    assert counts["data_profile"] == 7
    details = lake.read("governance", "audit_log").where("ingest_id = 'I1'").first()["details"]
    assert json.loads(details)["payload"]["tables_profiled"] == 2


def test_harmonize(lake, incoming):
    spark = lake.spark
    (incoming / "patients.csv").write_text(
        "Patient ID,Weight (kg),Born\n1,70.5,2001-02-03\n2,80,1/5/1999\n")
    types = spark.createDataFrame(
        [("people", "weight_kg", "", "NUMERIC(6,2)"), ("people", "birth_date", "", "DATE")],
        "table_name string, variable string, suggested_type string, final_type string")
    ingest(lake, incoming, type_decisions=types)
    dic.sync_metadata(lake, dictionary(spark), decisions=decisions(spark))
    synced = har.sync_harmonization_map(lake)
    assert synced == {"count": 6, "tables_mapped": 3, "sources_mapped": 1}
    manual = spark.createDataFrame([
        ("REG_A", "people", "patient_id", "demographics", "origin", "constant", "it's here",
         True, 100, None),
        ("REG_A", "nowhere", "x", "demographics", "patient_key", "rename", None, True, 1, None),
        ("REG_A", "labs", "value", "labs", "result_value", "expression",
         "CAST(value AS DOUBLE) * 2", True, 5,
         "by hand"),
    ], "source_type string, source_table string, source_column string, target_table string, "
       "target_column string, transform_type string, transform_expression string, "
       "is_active boolean, priority int, notes string")
    har.sync_harmonization_map(lake, manual)
    har.sync_harmonization_map(lake)  # the dictionary must not undo what is made by hand
    kept = lake.read("reference", "harmonization_map").where("target_table = 'labs'")
    assert {r["target_column"]: r["transform_type"] for r in kept.collect()} == {
        "result_value": "expression", "test_name": "direct"}
    result = har.harmonize_data(lake, "I1")
    assert result["by_table"]["demographics"] == 2 and result["by_table"]["vitals"] == 2
    rows = lake.read("validated", "demographics").orderBy("patient_key").collect()
    assert [(r["patient_key"], str(r["weight_kg"]), str(r["born"]), r["origin"]) for r in rows] \
        == [("1", "70.50", "2001-02-03", "it's here"), ("2", "80.00", "1999-01-05", "it's here")]
    assert len({r["validated_id"] for r in rows}) == 2
    log = {(r["target_table"], r["source_table"]): (r["status"], r["target_row_count"])
           for r in lake.read("governance", "transform_log").collect()}
    assert log["demographics", "nowhere"] == ("failed", 0)
    assert log["demographics", "people"] == ("success", 2)
    har.harmonize_data(lake, "I1")
    assert lake.read("validated", "demographics").count() == 2
    counts = {r["table_name"]: r["rows"] for r in validated_counts(lake).collect()}
    assert len(counts) == 23 and counts["demographics"] == 2 and counts["pmh"] == 0
    outcome = profile_batch(lake, "I1", "validated")
    assert outcome["tables_profiled"] == 3


def test_second_batch_keeps_first(lake, incoming):
    spark = lake.spark
    (incoming / "patients.csv").write_text("Patient ID,Weight (kg),Born\n1,70.5,2001-02-03\n")
    ingest(lake, incoming, type_decisions=decisions(spark))
    ingest(lake, incoming, "I2", type_decisions=decisions(spark))
    dic.sync_metadata(lake, dictionary(spark), decisions=decisions(spark))
    har.sync_harmonization_map(lake)
    for batch in ("I1", "I2"):
        har.harmonize_table(lake, "demographics", batch)
    per_batch = lake.read("validated", "demographics").groupBy("ingest_id").count().collect()
    assert {r[0]: r[1] for r in per_batch} == {"I1": 1, "I2": 1}


def test_arrivals(lake, incoming, tmp_path):
    spark = lake.spark
    options = dict(checkpoint=str(tmp_path / "cp"), source_id="SRC", source_type="REG_A",
                   dictionary=dictionary(spark))
    ingest_arrivals(lake, str(incoming), **options).awaitTermination()
    assert lake.read("raw", "labs").count() == 3
    (incoming / "labs_2021.csv").write_text("Test Name,Value\nMg,2\n")
    ingest_arrivals(lake, str(incoming), **options).awaitTermination()
    assert lake.read("raw", "labs").count() == 4
    batches = lake.read("governance", "batch_log").select("ingest_id", "file_count").collect()
    assert sorted(r["file_count"] for r in batches) == [1, 3]
    # A second stream of the same source, with a checkpoint of its own.
    other = tmp_path / "other"
    other.mkdir()
    (other / "labs_2022.csv").write_text("Test Name,Value\nZn,3\n")
    options["checkpoint"] = str(tmp_path / "cp2")
    ingest_arrivals(lake, str(other), **options).awaitTermination()
    assert lake.read("raw", "labs").count() == 5


def test_empty_table_from_schema(lake):
    expected = lake.spark.createDataFrame(
        [("people", "a", "numeric(5,1)"), ("people", "b", None), ("other", "c", "date")],
        "lake_table_name string, lake_variable_name string, type_descriptor string")
    assert ing.create_raw_table(lake, expected, "People")["status"] == "created"
    assert ing.create_raw_table(lake, expected, "people")["status"] == "exists"
    assert dict(lake.read("raw", "people").dtypes) == {"a": "decimal(5,1)", "b": "string"}


def test_overall_rows_survive_upsert_reading_its_table(lake):
    df = lake.spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    lake.replace("reference", "pairs", df)
    lake.replace("reference", "pairs", lake.read("reference", "pairs").withColumn("v", F.upper("v")))
    assert sorted(r["v"] for r in lake.read("reference", "pairs").collect()) == ["A", "B"]
