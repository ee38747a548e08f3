import csv
import hashlib
import json

import pytest

from quillstone.functions import names
from quillstone.operators import cohort, housekeeping
from quillstone.sources import files


def test_manifest_names_every_file_and_finds_what_changed(spark, tmp_path):
    out, at = str(tmp_path / "rows"), tmp_path / "manifest.json"
    spark.range(100).repartition(3).write.parquet(out)
    at.write_text("old")
    made = files.write_manifest(spark, out, str(at), {"rows": 100})
    assert json.loads(at.read_text()) == made and made["rows"] == 100
    parts = sorted((tmp_path / "rows").glob("*.parquet"))
    assert [(f["name"], f["size"], f["sha256"]) for f in made["files"]] == [(p.name, p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in parts]
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("manifest")] == ["manifest.json"]

    rows = [(f["name"], f["size"], f["sha256"].upper()) for f in made["files"]]
    wrong = [rows[0], (rows[1][0], rows[1][1] + 1, rows[1][2]), ("gone.parquet", 1, "00")]
    manifest = spark.createDataFrame(wrong, "name string, size long, sha256 string")
    got = {r.name: r.verdict for r in housekeeping.verify_files(housekeeping.file_hashes(spark, out, "*.parquet"), manifest).collect()}
    want = {rows[0][0]: "ok", rows[1][0]: "size", "gone.parquet": "missing"} | {r[0]: "unexpected" for r in rows[2:]}
    assert got == want
    other = spark.createDataFrame([(rows[0][0], rows[0][1], "00")], "name string, size long, sha256 string")
    assert {r.verdict for r in housekeeping.verify_files(housekeeping.file_hashes(spark, out, rows[0][0]), other).collect()} == {"sha256"}


def test_union_csv_has_all_columns(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "id int, name string"), spark.createDataFrame([(2.5, 2)], "score double, id int")
    files.write_union_csv([a, b], str(tmp_path / "u"))
    rows = [r for p in (tmp_path / "u").glob("*.csv") for r in csv.DictReader(p.open())]
    assert sorted(rows, key=lambda r: r["id"]) == [{"id": "1", "name": "x", "score": ""}, {"id": "2", "name": "", "score": "2.5"}]


def test_sorted_files_are_in_total_order(spark, tmp_path):
    files.write_sorted(spark.range(1000).selectExpr("(id * 7919) % 1000 k", "id"), str(tmp_path / "s"), ["k"])
    got = [[r.k for r in spark.read.parquet(str(p)).collect()] for p in sorted((tmp_path / "s").glob("*.parquet"))]
    assert [k for part in got for k in part] == list(range(1000))


def test_coverage_and_exclusion_with_nulls(spark):
    asked = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3), ("b", None)], "scope string, item int")
    have = spark.createDataFrame([("a", 1), ("b", 3), ("b", 9), ("c", 1)], "scope string, item int")
    assert {tuple(r) for r in housekeeping.scope_coverage(have, asked, "scope", "item").collect()} == {("a", 2, 1, 1, False), ("b", 1, 1, 0, True)}
    assert housekeeping.scope_coverage(have, asked.limit(0), "scope", "item").count() == 0
    rows, out = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "key string, n int"), spark.createDataFrame([("x",), ("x",), (None,)], "key string")
    assert sorted(r.n for r in cohort.excluding(rows, out, "key").collect()) == [2, 3]


@pytest.mark.parametrize(("name", "kind"), [("NetAssets", "numeric"), ("CompanyRegistrationNumber", "identifier"), ("EntityDate", "text"), ("AverageNumberEmployeesDuringPeriod", "numeric"), ("Address", "other"), ("", "other"), (None, None)])
def test_name_kinds(spark, name, kind):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(names.name_kind(df.n)).first()[0] == kind


def test_unit_families(spark):
    df = spark.createDataFrame([("GBP/shares",), ("gbp",), ("Pure",), (None,), ("",)], "u string")
    assert [r[0] for r in df.select(names.unit_family(df.u)).collect()] == ["currency/shares", "currency", "pure", None, ""]
