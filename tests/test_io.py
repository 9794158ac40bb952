"""Readers and writers round trip through fresh folders."""

import json

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from caseworks.operators.registry import check_bundles, latest_models, register, require_bundles
from caseworks.operators.scoring import capture, to_csv_line
from caseworks.operators.splits import prepare_per_target, split_at_least_one
from caseworks.sources import readers, writers

import csv
import random

import pytest


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    rows = [("a, b", 'say "hi"', 1), ("two\nlines", "", 2)]
    df = spark.createDataFrame(rows, "Subject string, Description string, n int")
    df.coalesce(1).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(str(tmp_path / "c.csv"))
    read = readers.read_cases_csv(spark, str(tmp_path / "c.csv"), "Subject string, Description string, n int")
    assert {(r[0], r[1] or "", r[2]) for r in read.collect()} == set(rows)
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "x.csv").write_text("a,b\n1,x\n")
    (tmp_path / "folder" / "note.txt").write_text("ignored")
    inferred = readers.read_cases_csv(spark, str(tmp_path / "folder"))
    assert inferred.dtypes == [("a", "int"), ("b", "string")] and inferred.count() == 1


@pytest.mark.parametrize("size", [7, 40, 300, 1 << 20])
def test_csv_cut_anywhere_equals_one_task(spark, tmp_path, size):
    """Ranges of any size give the rows of the reader that takes a file in one task."""
    rng = random.Random(5)
    for name, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerow(["id", 'the "note"' if name != "c" else 'the\n"note"', "n"])
            for k in range(80):
                note = "".join(rng.choice(['"', ",", "\n", "é", "word ", ""]) for _ in range(rng.randint(0, 12)))
                writer.writerow([f"{name}{k}", note, rng.randint(0, 9)])
    schema = "id string, note string, n int"
    plain = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = readers.read_cases_csv(spark, str(tmp_path), schema)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        if size == 300:
            from caseworks.sources.split_csv import _lines

            assert _lines(spark, readers.case_csv_files(spark, str(tmp_path))).rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_types_and_directory_rule(spark, tmp_path):
    (tmp_path / "b.csv").write_text('i,l,d,t,day,s,none\n1,5000000000,1.5,true,2024-01-02,x y,\n-2,7,2,false,2024-1-3,"1\n2",\n')
    found = readers.read_cases_csv(spark, str(tmp_path), which="one")
    assert [t for _, t in found.dtypes] == ["int", "bigint", "double", "boolean", "date", "string", "string"] and found.count() == 2
    (tmp_path / "a.csv").write_text("q\n1\n")
    assert readers.case_csv_files(spark, str(tmp_path), "one")[0].endswith("/a.csv") and len(readers.case_csv_files(spark, str(tmp_path))) == 2
    (tmp_path / "data.csv").write_text("q\n1\n")
    assert readers.case_csv_files(spark, str(tmp_path), "one")[0].endswith("/data.csv")
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_cases_csv(spark, str(tmp_path / "none"))


def test_json_records(spark, tmp_path):
    (tmp_path / "many.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    (tmp_path / "one.json").write_text(json.dumps({"a": 3}))
    assert sorted(r["a"] for r in readers.read_json_records(spark, str(tmp_path), "a long").collect()) == [1, 2, 3]


def test_columns_json(spark):
    df = spark.createDataFrame([(7, '{"v": ["x", "y"], "n": [1, 2]}'), (8, "junk")], "id int, j string")
    got = readers.columns_json_to_rows(df, "j", {"v": "string", "n": "int"}, keep=["id"]).collect()
    assert [tuple(r) for r in got] == [(7, "x", 1), (7, "y", 2)]


def test_libsvm(spark, tmp_path):
    df = spark.createDataFrame([(1.0, Vectors.sparse(4, {0: 1.5, 3: 2.0})), (0.0, Vectors.sparse(4, {}))], ["label", "features"])
    writers.write_libsvm(df, str(tmp_path / "m"))
    read = readers.read_libsvm(spark, str(tmp_path / "m"), 4)
    assert {(r["label"], r["features"]) for r in read.collect()} == {(r["label"], r["features"]) for r in df.collect()}


def test_label_first_and_last(spark, tmp_path):
    df = spark.createDataFrame([(3, Vectors.dense(1.0, 2.0))], ["y", "v"])
    writers.write_label_first_csv(df, "y", "v", str(tmp_path / "first"), size=2)
    assert spark.read.text(str(tmp_path / "first")).first()[0] == "3,1.0,2.0"
    writers.write_label_last_csv(df, "y", "v", str(tmp_path / "last"), size=2)
    assert {r[0] for r in spark.read.text(str(tmp_path / "last")).collect()} == {"f0,f1,target", "1.0,2.0,3"}


def test_splits_by_target_and_side(spark, sf, tmp_path):
    parts = readers.table(spark, sf, "part")
    split = split_at_least_one(parts, "p_partkey", ["p_name"], ["p_type", "p_brand"])
    writers.write_splits(split, str(tmp_path / "s"))
    read = spark.read.option("header", True).csv(str(tmp_path / "s"))
    assert read.count() == split.count()
    assert {p.name for p in (tmp_path / "s" / "target=p_type").iterdir()} == {"split=train", "split=validation"}


def test_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id int, y string, z string")
    writers.write_manifest(prepare_per_target(df, "id", [], ["y", "z"]), "out", str(tmp_path / "m"))
    assert json.loads(spark.read.text(str(tmp_path / "m")).first()[0]) == {
        "total_rows": 3,
        "targets": {
            "y": {"rows": 2, "unique_labels": 2, "output_path": "out/target=y"},
            "z": {"rows": 1, "unique_labels": 1, "output_path": "out/target=z"},
        },
    }


def test_cases_table(spark, tmp_path):
    writers.write_cases(spark.range(3), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_registry(spark, tmp_path):
    path = str(tmp_path / "r")
    for accuracy, status in ((0.7, "Approved"), (0.9, "PendingManualApproval")):
        register(spark, path, "acme", "dept", f"models/{accuracy}", accuracy, status)
    versions = spark.read.parquet(path)
    assert latest_models(versions).first()["path"] == "models/0.7"
    assert latest_models(versions, approved_only=False).first()["path"] == "models/0.9"
    assert versions.select("group_name").distinct().first()[0] == "acme-dept-models"


def test_bundles(spark):
    rows = [("a", "model", "i"), ("a", "features", "i"), ("a", "labels", "i"), ("b", "model", "i")]
    files = spark.createDataFrame(rows, "target string, kind string, image string")
    got = {r["target"]: (r["missing"], r["complete"]) for r in check_bundles(files).collect()}
    assert got == {"a": ("", True), "b": ("features,labels", False)}
    require_bundles(files, ["a"], ["x"])
    for targets, artifacts in ((["a"], []), (["a", "b"], ["x", "y"]), (["c"], ["x"])):
        with pytest.raises(ValueError):
            require_bundles(files, targets, artifacts)
    with pytest.raises(ValueError, match="image"):
        require_bundles(files.unionByName(spark.createDataFrame([("a", "extra", "j")], files.schema)), ["a"], ["x"])


def test_capture_appends(spark, tmp_path):
    df = spark.range(2000).withColumn("prediction", F.lit("x"))
    capture(df, "id", 100, str(tmp_path / "c"))
    capture(df, "id", 10, str(tmp_path / "c"))
    n = spark.read.json(str(tmp_path / "c")).count()
    assert 2000 + 140 < n < 2000 + 260


def test_csv_line_is_what_a_csv_reader_reads(spark):
    values = ["plain", "a, b", 'q "x"', "two\nlines", ""]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(5)))
    line = df.select(to_csv_line(df.columns)).first()[0]
    assert next(csv.reader([line + "\n"] if "\n" not in line else line.splitlines(True))) == values
