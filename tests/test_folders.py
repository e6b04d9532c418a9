"""Folders as a dictionary: the same copies as with ancestors in every row."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import treeferry as tf
ENTRY = "uri string, len bigint, file_type string"

ROOT, TARGET = "hdfs://nn1:8020/data", "hdfs://nn2:8020/backup"


def both(spark, entries, root=ROOT, target=TARGET):
    manifest = tf.to_source_manifest(spark.createDataFrame(entries, ENTRY), root, target)
    folders, rows = tf.folder_dictionary(manifest, root, target)
    plain = tf.expand_copies(tf.with_dependencies(manifest, root, target))
    found = tf.expand_folder_ids(rows, folders, root, target)
    assert found.select(plain.columns).schema.simpleString() == plain.schema.simpleString()
    return Counter(map(tuple, plain.collect())), Counter(map(tuple, found.select(plain.columns).collect())), folders, rows


DEEP = "/".join(["d"] * 37)


@pytest.mark.parametrize(
    ("entries", "root"),
    [
        ([(f"{ROOT}/a/b/f{i}", i, "file") for i in range(20)] + [(f"{ROOT}/a/b", 0, "directory"), (f"{ROOT}/c", 0, "directory"), (ROOT, 0, "directory"), (f"{ROOT}/f", 5, "file")], ROOT),
        ([(f"{ROOT}/{DEEP}/f{i}", i, "file") for i in range(3)] + [(f"{ROOT}/x{DEEP}", 0, "directory")], ROOT),
        ([(f"{ROOT}/a/f", 1, "file")] * 3 + [(f"{ROOT}/a", 0, "directory")] * 2, ROOT),
        ([(ROOT, 7, "file")], ROOT),
        ([(ROOT, 0, "directory")], ROOT),
        ([], ROOT),
        ([("hdfs://a/", 0, "directory"), ("hdfs://a/f", 1, "file"), ("hdfs://a/d/e/g", 1, "file")], "hdfs://a/"),
    ],
)
def test_same_copies(spark, entries, root):
    plain, found, folders, _ = both(spark, entries, root)
    assert found == plain
    assert folders.where("parent_id IS NULL").count() <= 1


def test_rows_take_the_same_bytes_at_any_depth(spark):
    for depth in (1, 40):
        path = "/".join(["folder"] * depth)
        _, _, folders, rows = both(spark, [(f"{ROOT}/{path}/f{i}", i, "file") for i in range(5)])
        assert rows.agg(F.max(F.length("name"))).first()[0] == 2 and folders.agg(F.max(F.length("name"))).first()[0] == 6
        assert folders.count() == depth + 1 and set(rows.columns) == {"folder_id", "name", "file_type", "len"}
        assert tf.folder_ancestors(folders).count() == (depth + 1) * (depth + 2) // 2
        assert sorted(r.depth for r in tf.folder_paths(folders).collect()) == list(range(depth + 1))


def test_a_folder_with_most_rows(spark):
    plain, found, *_ = both(spark, [(f"{ROOT}/hot/f{i}", i, "file") for i in range(9000)] + [(f"{ROOT}/g", 1, "file")])
    assert found == plain
