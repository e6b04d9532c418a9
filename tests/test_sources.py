"""The tree as a data source, kept manifests, followed links, names that are bytes."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan, LessThanOrEqual, StringContains, StringStartsWith

import treeferry as tf
from treeferry.sources.tree_source import TreeReader
from treeferry.storage import MARK, LocalStore, escaped_name, plain_path


def make(root, names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())


TREE = [f"{a}/{b}/{c}" for a in "pqr" for b in "stu" for c in "xyz"] + ["p/top", "lonely"]


def paths(frame, root):
    return sorted(row.uri.removeprefix(f"file://{root}") for row in frame.collect())


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_scan_tree(spark, tmp_path, parts):
    make(tmp_path, TREE)
    (tmp_path / "empty").mkdir()
    everything = sorted(str(p).removeprefix(str(tmp_path)) for p in tmp_path.rglob("*")) + [""]
    rows = tf.scan_tree(spark, str(tmp_path), parts=parts)
    assert paths(rows, tmp_path) == sorted(everything)
    assert rows.agg(F.sum("len")).first()[0] == sum(len(n) for n in TREE)
    under = tf.scan_tree(spark, str(tmp_path), F.col("uri").startswith(f"file://{tmp_path}/p/s") & (F.col("depth") <= 3) & F.col("uri").contains("x"), parts)
    assert paths(under, tmp_path) == ["/p/s/x"]
    # One load with several queries over it: none gets another one's filters.
    files = rows.where("file_type = 'file'")
    assert files.count() == len(TREE) and rows.where("depth = 0").count() == 1 and rows.count() == len(everything)
    assert paths(rows.where("depth = 1").unionByName(rows.where("depth = 2 AND file_type = 'file'")), tmp_path) == ["/empty", "/lonely", "/p", "/p/top", "/q", "/r"]


def test_roots_of_a_scan(spark, tmp_path):
    make(tmp_path, ["f"])
    assert paths(tf.scan_tree(spark, str(tmp_path / "f")), tmp_path) == ["/f"]
    with pytest.raises(Exception, match="does not exist"):
        tf.scan_tree(spark, str(tmp_path / "none")).collect()


def test_pushed_filters_are_shown(spark, tmp_path):
    make(tmp_path, ["f"])
    rows = tf.scan_tree(spark, str(tmp_path), (F.col("depth") < 2) & (F.col("file_type") == "file"))
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "LessThan(depth,2)" in plan and "EqualTo(file_type,file)" in plan


@pytest.mark.parametrize(
    ("filters", "opened", "found"),
    [
        ([StringStartsWith(("uri",), "file://{}/p/s")], ["", "/p", "/p/s"], ["/p/s", "/p/s/x", "/p/s/y", "/p/s/z"]),
        ([LessThanOrEqual(("depth",), 1)], [""], ["", "/lonely", "/p", "/q", "/r"]),
        ([LessThan(("depth",), 1)], [], [""]),
        ([EqualTo(("depth",), 2), EqualTo(("file_type",), "file")], ["", "/p", "/q", "/r"], ["/p/top"]),
        ([GreaterThan(("depth",), 2), StringStartsWith(("uri",), "file://{}/q/t/x")], ["", "/q", "/q/t"], ["/q/t/x"]),
        ([EqualTo(("file_type",), "link")], [], []),
        ([StringStartsWith(("uri",), "file://{}/p"), StringStartsWith(("uri",), "file://{}/q")], [], []),
    ],
)
def test_excluded_subtrees_are_not_opened(tmp_path, monkeypatch, filters, opened, found):
    make(tmp_path, TREE)
    seen, scan = [], LocalStore.scan
    monkeypatch.setattr(LocalStore, "scan", lambda self, path, *more: seen.append(path.removeprefix(str(tmp_path))) or scan(self, path, *more))
    filters = [type(f)(f.attribute, f.value.format(tmp_path) if isinstance(f.value, str) else f.value) for f in filters]
    for parts in (1, 100):
        seen.clear()
        reader = TreeReader(f"file://{tmp_path}", {}, parts, push=True)
        left = StringContains(("uri",), "x")
        assert list(reader.pushFilters([*filters, left])) == [left]
        rows = [row["uri"] for part in reader.partitions() for batch in reader.read(part) for row in batch.to_pylist()]
        assert sorted(r.removeprefix(f"file://{tmp_path}") for r in rows) == found
        assert sorted(seen) == opened


def manifests(spark, n=1000):
    source = spark.range(n).selectExpr("concat('s', id) AS source", "concat('file:///d/', id) AS destination", "id AS len", "'file' AS file_type")
    return source, spark.range(n // 2, n * 2).selectExpr("concat('file:///d/', id) AS uri", "id + id % 2 AS len", "'file' AS file_type")


@pytest.mark.parametrize("buckets", [(8, 8), (4, 16), (None, None)])
def test_kept_manifests_are_compared_without_a_shuffle(spark, tmp_path, buckets):
    source, present = manifests(spark)
    for name, rows, n in (("a b'", source, buckets[0]), ("b", present, buckets[1])):
        assert tf.keep_manifest(rows, str(tmp_path / name), n).count() == rows.count()
    spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
    try:
        compared = tf.compare_manifests(tf.kept_manifest(spark, str(tmp_path / "a b'")), tf.kept_manifest(spark, str(tmp_path / "b")))
        assert "Exchange" not in compared._jdf.queryExecution().executedPlan().toString()
        assert sorted(compared.collect(), key=repr) == sorted(tf.compare_manifests(source, present).collect(), key=repr)
    finally:
        spark.conf.unset("spark.sql.bucketing.coalesceBucketsInJoin.enabled")
    # A new listing against a kept one: only the new side moves.
    plan = tf.compare_manifests(source, tf.kept_manifest(spark, str(tmp_path / "b")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1
    with pytest.raises(FileNotFoundError):
        tf.kept_manifest(spark, str(tmp_path / "none"))


def test_offsets_of_a_million_partitions(spark):
    index = spark.range(1_000_000).select((F.col("id") * 2147).cast("int").alias("partition"), (F.col("id") % 3).cast("int").alias("max_batch"))
    # The numbers of tasks are INT, so a tenth of the rows for the sums; all of them for the plan.
    offsets = tf.batch_partition_offsets(index)
    assert "SinglePartition" not in offsets._jdf.queryExecution().executedPlan().toString()
    found = offsets.selectExpr("first_task - (partition div 2147 div 3) * 6 AS rest", "partition div 2147 % 3 AS kind").groupBy("kind").agg(F.min("rest"), F.max("rest"))
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, 0), (1, 1, 1), (2, 3, 3)]
    assert sorted(tuple(r) for r in tf.batch_partition_offsets(spark.createDataFrame([(5, 2), (-7, 0), (2**31 - 1, 1), (-(2**31), 3)], "partition int, max_batch int")).collect()) == [
        (-(2**31), 3, 0), (-7, 0, 4), (5, 2, 5), (2**31 - 1, 1, 8),
    ]


def test_followed_links(spark, roots):
    source, target = roots
    make(source, ["a/f", "b/c/g"])
    for link, to in {
        "to_file": "a/f", "chain": "to_file", "to_folder": "b", "b/c/up": "../..", "b/c/here": ".", "none": "nowhere", "ring1": "ring2", "ring2": "ring1",
        "a/over": "../b",
    }.items():
        os.symlink(to, source / link)
    report = tf.copy_tree(spark, str(source), str(target), on_error="fail", follow_links=True)
    found = {r.destination.removeprefix(f"file://{target}/data"): r.outcome for r in report.collect()}
    copied = {n for n, outcome in found.items() if outcome == "copied"}
    assert copied == {"/a/f", "/b/c/g", "/to_file", "/chain", "/to_folder/c/g", "/a/over/c/g"}
    skipped = {n for n, outcome in found.items() if outcome == "skipped"}
    assert skipped == {"/b/c/up", "/b/c/here", "/to_folder/c/up", "/to_folder/c/here", "/a/over/c/up", "/a/over/c/here", "/none", "/ring1", "/ring2"}
    assert (target / "data/to_folder/c/g").read_bytes() == b"b/c/g" and not (target / "data/to_folder").is_symlink()
    listing = tf.walk_tree(spark, str(source))
    assert listing.links == 9 and listing.files == 2


NAMES = [b"bad\xff", b"\xc3\xa4 fine", b"\xc3", b"mixed \xe4\xc3\xa4", MARK.encode() + b"ff", MARK.encode(), b"%ff", b"\xed\xa0\x80"]


@pytest.mark.parametrize("name", NAMES)
def test_marked_names_come_back(name):
    own = os.fsdecode(name)
    held = escaped_name(own)
    held.encode("utf-8")
    assert os.fsencode(plain_path("/a/" + held)) == b"/a/" + name
    if own.isprintable() and MARK not in own:
        assert held == own


def test_names_that_are_not_utf8_are_copied(spark, roots):
    source, target = roots
    for i, name in enumerate(NAMES):
        folder = os.path.join(os.fsencode(source), name)
        os.mkdir(folder)
        with open(os.path.join(folder, name + b".f"), "wb") as file:
            file.write(name * (i + 1))
    tf.copy_tree(spark, str(source), str(target), on_error="fail")
    report = tf.copy_tree(spark, str(source), str(target), on_error="fail", range_bytes=4)
    assert report.where("outcome = 'replaced'").count() == len(NAMES)
    for i, name in enumerate(NAMES):
        with open(os.path.join(os.fsencode(target), b"data", name, name + b".f"), "rb") as file:
            assert file.read() == name * (i + 1)
    gone = tf.delete_paths(spark.createDataFrame([(f"file://{target}/data",)], "uri string")).collect()
    assert [r.outcome for r in gone] == ["deleted"] and os.listdir(target) == []
