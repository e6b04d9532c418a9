import pytest
from pyspark.sql import functions as F

import treeferry as tf

ROOT, TARGET = "hdfs://h:8020/user/etl/data", "hdfs://h:8020/user/etl/data2"
ENTRY = "uri string, len bigint, file_type string"


@pytest.fixture(scope="module")
def source(spark):
    entries = [(ROOT, 0, "directory"), (ROOT + "/info.dat", 14488255, "file"), (ROOT + "/info2.dat", 14488255, "file")]
    return tf.to_source_manifest(spark.createDataFrame(entries, ENTRY), ROOT, TARGET)


@pytest.fixture(scope="module")
def destination(spark):
    entries = [
        (TARGET, 0, "directory"),
        (TARGET + "/data", 0, "directory"),
        (TARGET + "/data/info.dat", 14488255, "file"),
        (TARGET + "/data/info2.dat", 7, "file"),
    ]
    return tf.to_destination_manifest(spark.createDataFrame(entries, ENTRY))


def test_golden_comparison(source, destination):
    rows = {r["destination"].removeprefix(TARGET): r for r in tf.compare_manifests(source, destination).collect()}
    assert {path: r["status"] for path, r in rows.items()} == {
        "": "destination_only",
        "/data": "both",
        "/data/info.dat": "both",
        "/data/info2.dat": "both",
    }
    assert rows[""]["source"] is None and rows["/data/info2.dat"]["dest_len"] == 7


def test_golden_plan(source, destination):
    plan = tf.copy_plan(source, destination)
    rows = tf.with_dependencies(plan, ROOT, TARGET).collect()
    found = {
        r["source"].removeprefix(ROOT): (r["destination"], r["action"], [tuple(f) for f in r["dependent_folders"]])
        for r in rows
    }
    folder = [(ROOT, TARGET + "/data")]
    assert found == {
        "": (TARGET + "/data", "keep", []),
        "/info.dat": (TARGET + "/data/info.dat", "replace", folder),
        "/info2.dat": (TARGET + "/data/info2.dat", "replace", folder),
    }


def test_plan_is_a_left_outer_join_without_arrays(source, destination):
    plan = tf.with_dependencies(tf.copy_plan(source, destination), ROOT, TARGET)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in text and "FullOuter" not in text
    assert "transform" not in text[text.index("Join LeftOuter"):]


def test_nothing_at_the_destination(spark, source):
    none = spark.createDataFrame([], ENTRY)
    actions = {r["file_type"]: r["action"] for r in tf.copy_plan(source, none).collect()}
    assert actions == {"directory": "create", "file": "copy"}


def test_expand_then_distinct(spark):
    entries = [(f"{ROOT}/a/b/f{i}", i, "file") for i in range(20)]
    manifest = tf.to_source_manifest(spark.createDataFrame(entries, ENTRY), ROOT, TARGET)
    plan = tf.with_dependencies(manifest, ROOT, TARGET)
    expanded = tf.expand_copies(plan).orderBy("position").where(F.col("len").isin(0, 3)).collect()
    assert tf.expand_copies(plan).count() == 80
    assert [r["position"] for r in expanded if r["source"].endswith("f3")] == [3]
    distinct = tf.distinct_copies(tf.expand_copies(plan))
    assert distinct.count() == 23
    folders = {tuple(r) for r in distinct.where("file_type = 'directory'").select("source", "destination").collect()}
    assert folders == {tuple(r) for r in tf.directories_of(manifest, ROOT, TARGET).collect()}
    assert folders == {(ROOT + p, TARGET + "/data" + p) for p in ("", "/a", "/a/b")}


def test_directories_of_a_whole_filesystem(spark):
    entries = [("hdfs://a/", 0, "directory"), ("hdfs://a/f", 1, "file"), ("hdfs://a/d/e/g", 1, "file")]
    manifest = tf.to_source_manifest(spark.createDataFrame(entries, ENTRY), "hdfs://a/", "hdfs://b/t")
    for rows in (manifest, manifest.where(tf.is_file())):
        found = {tuple(r) for r in tf.directories_of(rows, "hdfs://a/", "hdfs://b/t").collect()}
        assert found == {("hdfs://a/", "hdfs://b/t"), ("hdfs://a/d", "hdfs://b/t/d"), ("hdfs://a/d/e", "hdfs://b/t/d/e")}


def test_directories_of_a_single_file(spark):
    manifest = tf.to_source_manifest(spark.createDataFrame([(ROOT, 5, "file")], ENTRY), ROOT, TARGET)
    assert tf.directories_of(manifest, ROOT, TARGET).count() == 0


def test_verify_lengths(source, destination):
    rows = {r["destination"].rpartition("/")[2]: r["same_length"] for r in tf.verify_lengths(source, destination).collect()}
    assert rows == {"info.dat": True, "info2.dat": False}


def test_summary(source):
    assert {tuple(r) for r in tf.manifest_summary(source).collect()} == {("directory", 1, 0), ("file", 2, 28976510)}
