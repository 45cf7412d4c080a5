from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import datatypes as dt
from lakewright.functions import text as tx
from lakewright.functions.hashing import LETTERS, pseudonym, weighted_hash, weighted_hash_of
from lakewright.functions.names import normalize_columns, normalize_name, normalized
from lakewright.operators import dictionary as dic
from lakewright.operators import harmonization as har
from lakewright.operators.deidentify import DeidRules, deidentify, deidentify_files
from lakewright.operators.ingestion import type_choices
from lakewright.operators.schema_check import schema_issues
from lakewright.operators.upsert import inserted_if_absent
from lakewright.sources import files as fl

EXPECTED = ("lake_table_name string, lake_variable_name string, data_type string, "
            "is_required boolean, target_type string, version_number int")
OBSERVED = "lake_table_name string, lake_variable_name string, data_type string, udt_name string"


def issues(spark, expected, observed):
    e = spark.createDataFrame([("t", *r, 1) for r in expected], EXPECTED)
    o = spark.createDataFrame([("t", *r) for r in observed], OBSERVED)
    return {(r["issue_code"], r["lake_variable_name"], r["severity"])
            for r in schema_issues(e, o).collect()}


ID = ("id", "integer", True, "integer")
NAME = ("name", "text", False, "text")


def test_schema_issues(spark):
    seen = [("id", "integer", "int4"), ("name", "text", "text")]
    assert issues(spark, [ID, NAME], seen) == set()
    assert issues(spark, [ID, NAME, ("must", "text", True, "text")], seen) == {
        ("SCHEMA_MISSING_COLUMN", "must", "critical")}
    assert issues(spark, [ID, NAME, ("may", "text", False, "text")], seen) == set()
    assert issues(spark, [ID, NAME], [*seen, ("extra", "text", "text")]) == {
        ("SCHEMA_UNEXPECTED_COLUMN", "extra", "critical")}
    assert issues(spark, [ID, NAME], [seen[0], ("name", "integer", "int4")]) == {
        ("SCHEMA_TYPE_MISMATCH", "name", "warning"), ("TYPE_TARGET_MISMATCH", "name", "warning")}
    assert issues(spark, [ID], []) == {("SCHEMA_MISSING_COLUMN", "id", "critical")}
    assert issues(spark, [("id", "integer", True, None)], seen[:1]) == {
        ("TYPE_TARGET_MISSING", "id", "warning")}


def dictionary(spark, n, **changed):
    rows = [{
        "source_type": "TEST", "source_table_name": "test_table",
        "source_variable_name": f"src_var_{i}", "data_type": "text",
        "lake_table_name": "test_table", "lake_variable_name": f"var_{i}",
        "variable_label": f"Variable {i}", "is_identifier": "N", **changed,
    } for i in range(1, n + 1)]
    schema = ("source_type string, source_table_name string, source_variable_name string, "
              "data_type string, lake_table_name string, lake_variable_name string, "
              "variable_label string, is_identifier string, variable_unit string")
    return dic.load_dictionary(spark.createDataFrame(
        [tuple(r.get(c.split()[0]) for c in schema.split(", ")) for r in rows], schema))


def test_dictionary_diff(spark):
    empty = dictionary(spark, 1).where("false")
    first = dic.dictionary_changes(dictionary(spark, 3), empty).collect()
    assert len(first) == 51 and {r["change_type"] for r in first} == {"INITIAL"}
    assert all(r["old_value"] is None for r in first)
    added = dic.dictionary_changes(dictionary(spark, 2), dictionary(spark, 1)).collect()
    assert {(r["change_type"], r["lake_variable_name"]) for r in added} == {("ADD", "var_2")}
    gone = dic.dictionary_changes(dictionary(spark, 1), dictionary(spark, 2)).collect()
    assert {(r["change_type"], r["lake_variable_name"]) for r in gone} == {("REMOVE", "var_2")}
    assert len(gone) == 17 and all(r["new_value"] is None for r in gone)
    assert dic.dictionary_changes(dictionary(spark, 3), dictionary(spark, 3)).isEmpty()
    label = dic.dictionary_changes(
        dictionary(spark, 1, variable_label="Updated Label"), dictionary(spark, 1)).collect()
    assert [(r["field_changed"], r["old_value"], r["new_value"]) for r in label] == [
        ("variable_label", "Variable 1", "Updated Label")]
    unit = dic.dictionary_changes(dictionary(spark, 1, variable_unit="kg"), dictionary(spark, 1))
    assert [(r["field_changed"], r["old_value"], r["new_value"]) for r in unit.collect()] == [
        ("variable_unit", None, "kg")]
    blank = dic.dictionary_changes(dictionary(spark, 1, variable_unit=""), dictionary(spark, 1))
    assert blank.isEmpty()


def test_dictionary_needs_its_columns(spark):
    with pytest.raises(ValueError, match="lake_table_name"):
        dic.load_dictionary(spark.createDataFrame([("a",)], "source_type string"))


def test_names(spark):
    names = [" Weight (kg) ", "ED LOS (Minutes)", "Alive (Y/N)", "__A--b__", "x (cm)#1"]
    plain = ["weight_kg", "ed_los_minutes", "alive_yn", "a_b", "x_cm_1"]
    assert [normalize_name(n) for n in names] == plain
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(normalized(F.col("n"))).collect()] == plain
    twice = spark.createDataFrame([(1, 2, 3)], "`A b` int, a_b int, c int")
    assert normalize_columns(twice).first().asDict() == {"a_b": 1, "c": 3}


def values(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("t"))).collect()]


def test_guarded_numbers(spark):
    texts = [".5", "5.", "+5", "1e3", "abc", "-2", None]
    got = values(spark, texts, lambda c: tx.guarded_number(c, T.DoubleType()))
    assert got == [0.5, None, None, 1000.0, None, -2.0, None]
    assert values(spark, ["3.7", "4"], lambda c: tx.guarded_number(c, T.IntegerType())) == [None, 4]


def test_strict_casts(spark):
    assert values(spark, ["9:05", "23:1:2", "1:00 PM"], lambda c: dt.strict_cast(c, "TIME")) == [
        "09:05:00", "23:01:02", "13:00:00"]
    assert values(spark, ["on", "No", "t"], lambda c: dt.strict_cast(c, "boolean")) == [
        True, False, True]
    assert values(spark, ["abcdef"], lambda c: dt.strict_cast(c, "varchar(3)")) == ["abc"]
    with pytest.raises(Exception, match="invalid value for DATE"):
        values(spark, ["not a day"], lambda c: dt.strict_cast(c, "DATE"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["x"], lambda c: dt.strict_cast(c, "integer"))
    with pytest.raises(ValueError, match="unknown type"):
        dt.strict_cast(F.lit("x"), "geometry")


def test_two_mappings_to_one_column(spark):
    staging = spark.createDataFrame([(None, "b"), ("a", "c")], "x string, y string")
    maps = [
        {"source_column": "y", "target_column": "z", "transform_type": "rename",
         "transform_expression": None, "priority": 2},
        {"source_column": "x", "target_column": "z", "transform_type": "rename",
         "transform_expression": None, "priority": 1},
    ]
    with pytest.raises(ValueError, match="several mappings"):
        har.harmonized(staging, maps, "S", "t")
    got = har.harmonized(staging, maps, "S", "t", conflict="priority").collect()
    assert [r["z"] for r in got] == ["b", "a"]


def brute_hash(value, salt, size=2147483647):
    whole = f"{salt}||{value}"
    return sum(ord(c) * i % 1000003 for i, c in enumerate(whole, 1)) % size


def brute_name(value, salt):
    y, out = brute_hash(value, salt) + 1, ""
    for k in range(1, 11):
        out += LETTERS[y % 52]
        y = y // 52 + k
    return out


def test_hashes_and_pseudonyms(spark):
    texts = ["123", "é x", "", None, "a" * 300]
    want = [brute_hash("NA" if t is None else t, "s") for t in texts]
    assert values(spark, texts, lambda c: weighted_hash(c, "s")) == want
    assert [weighted_hash_of(t, "s") for t in texts if t is not None] == [
        w for w, t in zip(want, texts) if t is not None]
    got = values(spark, texts, lambda c: pseudonym(c, "s"))
    assert got == [None if t is None else brute_name(t, "s") for t in texts]


def test_deidentify(spark):
    df = spark.createDataFrame(
        [("1", "2000-01-01", "Ann", "x"), ("bad", None, None, "y"), (None, "1990/5/6", "Bo", "z")],
        "mrn string, `Birth Date` string, fname string, note string")
    rules = DeidRules(salt="s")
    offset = 100000 + brute_hash("MRN", "s", 900000)
    got = deidentify(df, rules).collect()
    assert [r["mrn"] for r in got] == [1.0 + offset, None, None]
    shift = brute_hash(str(1 + offset), "s", 7301) - 3650
    assert (got[0]["Birth Date"].toordinal() - 730120) == shift
    assert got[1]["Birth Date"] is None and got[1]["fname"] is None
    assert got[0]["fname"] == brute_name("Ann", "s||FNAME") and got[0]["note"] == "x"
    texts = spark.createDataFrame([("a",), (None,)], "mrn string")
    assert [r[0] for r in deidentify(texts, rules).collect()] == [f"a{offset}", None]
    strong = deidentify(df, DeidRules(salt="s", strong=True)).collect()
    assert strong[0]["Birth Date"] is not None


def test_deidentify_files_and_extracts(spark, tmp_path):
    root = tmp_path / "raw" / "deep"
    root.mkdir(parents=True)
    (root / "a.csv").write_text("MRN,note\n1,x\n2,y\n")
    (root / "b.txt").write_text("MRN\tnote\n5\tq\n")
    (root / "skip.bin").write_text("zzz")
    manifest = deidentify_files(spark, [str(tmp_path / "raw")], str(tmp_path / "out"))
    rows = {r["input_path"].rsplit("/", 1)[-1]: r for r in manifest.collect()}
    assert {k: (r["status"], r["n_rows_written"]) for k, r in rows.items()} == {
        "a.csv": ("wrote", 2), "b.txt": ("wrote", 1)}
    assert rows["a.csv"]["output_path"].endswith("/deep/a__deid.csv")
    toys = fl.toy_extracts(spark, [str(tmp_path / "raw")], str(tmp_path / "toy"), 1)
    assert {r["n_rows_written"] for r in toys.collect()} == {1}


def test_strict_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("ID,Full Name\n1,Ann\n")
    assert fl.read_csv_strict(spark, str(path), ["id", "full_name"]).collect()[0].asDict() == {
        "id": "1", "full_name": "Ann"}
    path.write_text("Report of May\n\nprinted today\n1,Ann\n2,Bo\n")
    got = fl.read_csv_strict(spark, str(path), ["id", "full_name"]).collect()
    assert [(r["id"], r["full_name"]) for r in got] == [("1", "Ann"), ("2", "Bo")]
    path.write_text("1,2,3\n")
    assert fl.read_csv_strict(spark, str(path), ["id", "full_name"]) is None
    assert fl.read_csv_strict(spark, str(tmp_path / "none.csv"), ["id"]) is None


def test_file_facts_on_many_files(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"f{i}.csv").write_text(f'"a\nb",c\n{i},2\n')
    found = fl.discover(spark, str(tmp_path)).collect()
    assert len(found) == 5
    facts = fl.file_facts(spark, [r["path"] for r in found] + [str(tmp_path / "no.csv")]).collect()
    assert sum(r["found"] for r in facts) == 5
    assert all(r["header"] == ["a\nb", "c"] for r in facts if r["found"])
    missing = [r for r in facts if not r["found"]]
    assert missing[0]["problem"] == "file does not exist" and missing[0]["checksum"] is None


def test_null_keys_are_inserted_once(spark):
    have = spark.createDataFrame([(None, "a")], "k string, v string")
    more = spark.createDataFrame([(None, "b"), ("x", "c")], "k string, v string")
    assert [tuple(r) for r in inserted_if_absent(have, more, ["k"]).collect()] == [("x", "c")]


def test_blank_decisions_do_not_hide_filled_ones(spark):
    rows = [("t", "v", None, None), ("t", "v", "DATE", "checked"), ("t", "v", " ", "")]
    prior = spark.createDataFrame(rows, "table_name string, variable string, final_type string, decision_note string")
    core = spark.createDataFrame([("t", "v", "text")], "lake_table_name string, lake_variable_name string, data_type string")
    found = dic.refreshed_type_decisions(core, prior).first()
    assert (found["final_type"], found["decision_note"]) == ("DATE", "checked")
    asked = spark.createDataFrame([("t", "v")], "table_name string, variable string")
    decisions = spark.createDataFrame(
        [("t", "v", None, None), ("t", "v", "INTEGER", None)],
        "table_name string, variable string, final_type string, suggested_type string",
    )
    assert type_choices(asked, decisions).first()["chosen_type"] == "INTEGER"


def test_date_before_a_line_end(spark):
    df = spark.createDataFrame([("2024-01-05 seen\nok",)], "v string")
    assert df.select(tx.date_layout_match(F.col("v"), tx.DATE_LAYOUTS[0])).first()[0]


def test_priority_zero_comes_first(spark):
    staging = spark.createDataFrame([("a", "b")], "x string, y string")
    maps = [
        {"target_column": "t", "source_column": c, "transform_type": "direct", "transform_expression": None, "priority": p}
        for c, p in (("x", 50), ("y", 0))
    ]
    assert har.harmonized(staging, maps, "S", "s", conflict="priority").first()["t"] == "b"


def test_data_below_many_title_lines(spark, tmp_path):
    path = tmp_path / "titled.csv"
    path.write_text("".join(f"title {i}\n" for i in range(14)) + "1,2\n3,4\n")
    found = fl.read_csv_strict(spark, str(path), ["a", "b"], max_skip=20)
    assert sorted(map(tuple, found.collect())) == [("1", "2"), ("3", "4")]
    assert fl.read_csv_strict(spark, str(path), ["a", "b"], max_skip=5) is None


def test_one_unreadable_header_is_one_row(spark, tmp_path):
    good, bad = tmp_path / "good%41.csv", tmp_path / "bad.csv"
    good.write_text("a,b\n1,2\n")
    bad.write_text('"' + "x" * 200_000)
    found = {r["path"]: r for r in fl.file_facts(spark, [str(good), str(bad)]).collect()}
    assert found[str(good)]["found"] and not found[str(bad)]["found"] and found[str(bad)]["problem"]


def test_header_of_more_than_a_mebibyte(spark, tmp_path):
    names = [f"column_{i:06d}" for i in range(100_000)]
    body = "\ufeff" + ",".join(names) + "\n1,2\n"
    (tmp_path / "wide.csv").write_text(body, encoding="utf-8")
    fact = fl.file_facts(spark, [str(tmp_path / "wide.csv")]).first()
    assert fact["header"] == names and fact["file_size_bytes"] == len(body.encode())


def test_too_wide_lines_are_counted(spark, tmp_path):
    for name, body in (("good%41.csv", '1,2\n3\n"a,b","c""d,\ne"\n,\n'), ("wide.csv", '1,2,LOST\n3,4\n1,2,,LOST\n5,"x,\ny",z\n7\n"a,b"\n')):
        (tmp_path / name).write_text("p,q\n" + body)
    found = fl.too_wide_lines(spark, [str(tmp_path / n) for n in ("good%41.csv", "wide.csv")], 2).collect()
    assert [(r["_source_file"].rsplit("/", 1)[1], r["lines"]) for r in found] == [("wide.csv", 3)]
