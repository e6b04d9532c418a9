import hashlib
import os
import re
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import treeferry as tf
from treeferry.operators import copying


def fill(root, files):
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def tree(root):
    """Relative path -> content hash, or None for a directory."""
    found = {}
    for folder, folders, files in os.walk(root):
        for name in folders:
            found[os.path.relpath(os.path.join(folder, name), root)] = None
        for name in files:
            path = os.path.join(folder, name)
            found[os.path.relpath(path, root)] = hashlib.sha256(open(path, "rb").read()).hexdigest()
    return found


def outcomes(report):
    rows = report.groupBy("outcome").count().collect()
    return {row["outcome"]: row["count"] for row in rows}


FILES = {
    "a/b/c/deep.bin": os.urandom(300_000),
    "a/_SUCCESS": b"",
    "a/_temporary/0/part": b"part",
    ".hidden/file": b"hidden",
    "name with space": b"1",
    "percent%20name": b"2",
    "co:lon/na:me": b"3",
    "question?#mark": b"4",
    "größe/データ": "ü".encode(),
}


@pytest.mark.parametrize("num_tasks", [None, 1, 3])
def test_whole_tree(spark, roots, num_tasks):
    source, target = roots
    fill(source, FILES)
    (source / "empty" / "inner").mkdir(parents=True)
    report = tf.copy_tree(spark, str(source), str(target), num_tasks=num_tasks)
    assert tree(target / "data") == tree(source)
    assert outcomes(report) == {"copied": len(FILES), "dir_created": 11}
    rows = report.where("file_type = 'file'").collect()
    assert sum(r["bytes"] for r in rows) == sum(map(len, FILES.values()))
    for r in rows:
        folder, _, name = r["destination"].rpartition("/")
        assert re.fullmatch(re.escape(folder) + r"/\.treeferry-[0-9a-f]{32}\.0", r["temp_path"]) and name
    if num_tasks:
        assert len({r["task_attempt_id"] for r in rows}) <= num_tasks


def test_many_files_get_more_shuffle_partitions(spark, roots, monkeypatch):
    from treeferry import session

    monkeypatch.setattr(session, "ROWS_PER_SHUFFLE_PARTITION", 1)
    source, target = roots
    fill(source, FILES)
    fill(target, {"data/question?#mark": b"old"})
    assert outcomes(tf.copy_tree(spark, str(source), str(target)))["replaced"] == 1
    assert tree(target / "data") == tree(source)


def test_again_replaces_every_file_and_keeps_others(spark, roots):
    source, target = roots
    fill(source, FILES)
    fill(target, {"data/a/_SUCCESS": b"longer than the source", "data/other": b"stays"})
    assert outcomes(tf.copy_tree(spark, str(source), str(target))) == {
        "copied": len(FILES) - 1, "replaced": 1, "dir_created": 7, "dir_exists": 2,
    }
    assert outcomes(tf.copy_tree(spark, str(source), str(target))) == {"replaced": len(FILES), "dir_exists": 9}
    wanted = tree(source)
    assert tree(target / "data") == wanted | {"other": hashlib.sha256(b"stays").hexdigest()}


def test_a_report_read_twice_copies_once(spark, roots):
    source, target = roots
    fill(source, {"f": b"x"})
    report = tf.copy_tree(spark, str(source), str(target))
    first = report.orderBy("destination").collect()
    os.remove(target / "data" / "f")
    assert report.orderBy("destination").collect() == first
    assert not (target / "data" / "f").exists()


def test_single_file_root(spark, roots):
    source, target = roots
    fill(source, {"only": b"abc"})
    report = tf.copy_tree(spark, str(source / "only"), str(target))
    assert outcomes(report) == {"copied": 1} and (target / "only").read_bytes() == b"abc"


def test_roots_must_exist(spark, roots):
    source, target = roots
    with pytest.raises(FileNotFoundError):
        tf.copy_tree(spark, str(source / "none"), str(target))
    with pytest.raises(FileNotFoundError):
        tf.copy_tree(spark, str(source), str(target / "new" / "deep"))
    fill(source, {"f": b"x"})
    tf.copy_tree(spark, str(source), str(target / "new" / "deep"), create_destination=True)
    assert (target / "new" / "deep" / "data" / "f").read_bytes() == b"x"


def test_onto_itself_is_rejected(spark, roots):
    source, _ = roots
    for destination in (source, source.parent):
        with pytest.raises(ValueError, match="onto itself"):
            tf.copy_tree(spark, str(source), str(destination))


def test_a_directory_where_a_file_must_go(spark, roots):
    source, target = roots
    fill(source, {"f": b"x", "g": b"y"})
    (target / "data" / "f").mkdir(parents=True)
    report = tf.copy_tree(spark, str(source), str(target))
    failed = report.where("outcome = 'failed'").collect()
    assert [(os.path.basename(r["destination"]), "is a directory" in r["error"]) for r in failed] == [("f", True)]
    assert (target / "data" / "g").read_bytes() == b"y"
    with pytest.raises(tf.CopyFailed, match="1 entries") as raised:
        tf.copy_tree(spark, str(source), str(target), on_error="fail")
    assert outcomes(raised.value.report) == {"failed": 1, "replaced": 1, "dir_exists": 1}


def test_a_file_where_a_directory_must_go(spark, roots):
    source, target = roots
    fill(source, {"d/f": b"x"})
    fill(target, {"data/d": b"a file"})
    report = tf.copy_tree(spark, str(source), str(target))
    assert outcomes(report) == {"dir_exists": 1, "failed": 2}
    errors = {os.path.basename(r["destination"]): r["error"] for r in report.where("outcome = 'failed'").collect()}
    assert "is a file" in errors["d"]
    assert (target / "data" / "d").read_bytes() == b"a file"


def test_unlistable_entries_are_failed_rows(spark, roots):
    source, target = roots
    fill(source, {"f": b"x"})
    os.mkfifo(source / "pipe")
    report = tf.copy_tree(spark, str(source), str(target))
    assert outcomes(report) == {"copied": 1, "dir_created": 1, "failed": 1}


def test_exclude(spark, roots):
    source, target = roots
    fill(source, FILES)
    tf.copy_tree(spark, str(source), str(target), exclude=tf.EXCLUDE_PATTERNS)
    kept = {n: h for n, h in tree(source).items() if "_temporary" not in n and "_SUCCESS" not in n}
    assert tree(target / "data") == kept


def plan_of(spark, source, target, lengths):
    rows = [(f"file://{source}/{n}", f"file://{target}/{n}", "file", size, "copy") for n, size in lengths.items()]
    return spark.createDataFrame(rows, "source string, destination string, file_type string, len bigint, action string")


@pytest.mark.parametrize("range_bytes", [1 << 30, 1000])
def test_changed_length_fails_and_keeps_the_old_file(spark, roots, range_bytes):
    source, target = roots
    fill(source, {"grown": b"x" * 5000, "same": b"y" * 5000})
    fill(target, {"grown": b"old"})
    plan = plan_of(spark, source, target, {"grown": 4000, "same": 5000})
    report = tf.execute_copy(plan, 1 << 20, range_bytes=range_bytes)
    rows = {os.path.basename(r["destination"]): r for r in report.collect()}
    assert len(rows) == 2 and rows["same"]["outcome"] == "copied"
    assert rows["grown"]["outcome"] == "failed" and "4000" in rows["grown"]["error"]
    assert (target / "grown").read_bytes() == b"old"
    assert sorted(os.listdir(target)) == ["grown", "same"]


@pytest.mark.parametrize("range_bytes", [1 << 30, 1000])
def test_missing_source_and_missing_parent(spark, roots, range_bytes):
    source, target = roots
    fill(source, {"d/f": b"x" * 3000})
    plan = plan_of(spark, source, target, {"gone": 3000, "d/f": 3000})
    report = tf.execute_copy(plan, 1 << 20, range_bytes=range_bytes)
    assert outcomes(report) == {"failed": 2}
    assert os.listdir(target) == []


def test_unsupported_type_fails(spark, roots):
    source, target = roots
    plan = plan_of(spark, source, target, {"f": 1}).withColumn("file_type", F.lit("socket"))
    assert "neither a file nor a directory" in tf.execute_copy(plan, 1 << 20).first()["error"]


def test_large_files_are_copied_in_ranges(spark, roots):
    source, target = roots
    fill(source, {"large": os.urandom(1_000_003), "exact": os.urandom(200_000), "small": b"s", "none": b""})
    fill(target, {"data/exact": b"old"})
    report = tf.copy_tree(spark, str(source), str(target), range_bytes=100_000, buffer_bytes=4096)
    assert tree(target / "data") == tree(source)
    assert outcomes(report) == {"copied": 3, "replaced": 1, "dir_exists": 1}
    sizes = {os.path.basename(r["destination"]): r["bytes"] for r in report.where("file_type = 'file'").collect()}
    assert sizes == {"large": 1_000_003, "exact": 200_000, "small": 1, "none": 0}


def test_one_large_file_is_spread_over_tasks(spark, roots):
    source, target = roots
    fill(source, {"huge": b"x" * 900_000, **{f"f{i}": b"y" * 10_000 for i in range(90)}})
    lengths = {name: os.path.getsize(source / name) for name in os.listdir(source)}
    batches = copying.plan_batches(plan_of(spark, source, target, lengths), 5 << 20, range_bytes=50_000)
    assert batches.cut_files == 1
    per_batch = batches.rows.groupBy("partition", "batch").agg(F.sum("len").alias("bytes"), F.count("*").alias("n"))
    assert max(r["n"] for r in per_batch.collect()) <= 6
    assert batches.rows.agg(F.sum("len")).first()[0] == sum(lengths.values())


def test_finished_ranges_may_be_finished_again(tmp_path):
    """A second attempt after the rename finds the file in place and no temporary."""
    (tmp_path / ".temp").write_bytes(b"abc, and more of a longer one")
    row = {
        "destination": f"file://{tmp_path}/f", "temp_path": f"file://{tmp_path}/.temp",
        "range_error": None, "bytes": 3, "file_len": 3, "action": "copy",
    }
    assert copying._finish_ranges(copying.Task(1), row)["outcome"] == "copied"
    assert copying._finish_ranges(copying.Task(2, 1), row)["outcome"] == "copied"
    with pytest.raises(OSError):
        copying._finish_ranges(copying.Task(3), row)
    assert os.listdir(tmp_path) == ["f"] and (tmp_path / "f").read_bytes() == b"abc"


def one_file(source, target, action="copy"):
    return {
        "source": f"file://{source}/f", "destination": f"file://{target}/f", "file_type": "file", "len": 3, "range_start": None,
        "temp_path": f"file://{target}/.treeferry-x", "action": action,
    }


def test_two_attempts_at_the_same_time(roots):
    source, target = roots
    fill(source, {"f": b"new"})
    fill(target, {".treeferry-x.0": b"ne"})  # the first attempt is under way
    second = copying.Task(2, 1, speculative=True)
    assert copying._copy_part(4096)(second, one_file(source, target))["outcome"] == "copied"
    assert (target / ".treeferry-x.0").exists() and (target / "f").read_bytes() == b"new"


@pytest.mark.parametrize("number", [0, 2])
def test_a_repeated_task_removes_what_its_lost_attempts_left(roots, number):
    source, target = roots
    fill(source, {"f": b"new"})
    fill(target, {".treeferry-x.0": b"mine, and longer", ".treeferry-x.1": b"mine", ".treeferry-y.0": b"another's", "f": b"old"})
    result = copying._copy_part(4096)(copying.Task(9, number), one_file(source, target, "replace"))
    assert result["outcome"] == "replaced" and (target / "f").read_bytes() == b"new"
    left = {".treeferry-y.0", "f"} | (set() if number else {".treeferry-x.1"})
    assert set(os.listdir(target)) == left


@pytest.mark.parametrize("range_bytes", [1 << 30, 1000])
def test_a_run_takes_over_what_one_of_its_id_left(spark, roots, range_bytes):
    source, target = roots
    fill(source, {"f": b"n" * 2500})
    uri = f"file://{target}/data/f"
    name = spark.range(1).select(copying.temp_uri(F.lit(uri), "run")).first()[0].removeprefix("file://")
    fill(target, {"data/other": b""})
    for left in (name, name + ".0"):
        with open(left, "wb") as file:
            file.write(b"left by an application that broke off" * 999)
    report = tf.copy_tree(spark, str(source), str(target), run_id="run", range_bytes=range_bytes)
    assert outcomes(report) == {"copied": 1, "dir_exists": 1}
    assert (target / "data" / "f").read_bytes() == b"n" * 2500
    # of the names of both kinds of copy, the one that was used is gone
    assert len(os.listdir(target / "data")) == 3


@pytest.mark.parametrize("range_bytes", [1 << 30, 1000])
def test_the_longest_names(spark, roots, range_bytes):
    source, target = roots
    names = ["x" * 255, "y" * 220, "\u00e9" * 127]
    fill(source, {name: name.encode() * 9 for name in names})
    assert outcomes(tf.copy_tree(spark, str(source), str(target), range_bytes=range_bytes)) == {"copied": 3, "dir_created": 1}
    assert tree(target / "data") == tree(source)


def test_many_cut_files_are_finished_by_several_tasks(spark, roots):
    source, target = roots
    fill(source, {f"f{i}": b"x" * 20 for i in range(600)})
    report = tf.copy_tree(spark, str(source), str(target), range_bytes=10).where("outcome = 'copied'")
    tasks = [r["count"] for r in report.groupBy("task_attempt_id").count().collect()]
    assert sum(tasks) == 600 and len(tasks) > 1 and max(tasks) <= 256


def test_a_destination_inside_the_source(spark, roots):
    source, _ = roots
    (source / "backup" / "deep").mkdir(parents=True)
    (source.parent / "data2").mkdir()
    for inside in ("backup", "backup/deep"):
        with pytest.raises(ValueError, match="into itself"):
            tf.copy_tree(spark, str(source), str(source / inside))
    tf.copy_tree(spark, str(source), str(source.parent / "data2"))


def test_links_are_reported(spark, roots):
    source, target = roots
    fill(source, {"f": b"x", "d/g": b"y"})
    os.symlink(source / "f", source / "to_file")
    os.symlink(source, source / "d" / "to_root")
    os.symlink(source / "gone", source / "dangling")
    report = tf.copy_tree(spark, str(source), str(target), on_error="fail")
    assert outcomes(report) == {"copied": 2, "dir_created": 2, "skipped": 3}
    skipped = {os.path.basename(r["destination"]): r["file_type"] for r in report.where("outcome = 'skipped'").collect()}
    assert skipped == {"to_file": "link", "to_root": "link", "dangling": "link"}


def test_an_excluded_directory_is_not_read(spark, roots):
    source, target = roots
    fill(source, {"kept": b"x", "no/deep/f": b"y", "also/kept": b"z"})
    os.mkfifo(source / "pipe")
    report = tf.copy_tree(spark, str(source), str(target), exclude=[".*/no", ".*/pipe"], on_error="fail")
    assert outcomes(report) == {"copied": 2, "dir_created": 2}
    listed = tf.walk_tree(spark, str(source), exclude=[".*/no"]).rows
    assert listed.where("uri LIKE '%/no%'").isEmpty()


def test_filesystem_settings_reach_the_tasks(spark, roots, monkeypatch):
    from treeferry.storage import LocalStore, Stores

    @staticmethod
    def opened(scheme, authority, options):
        if options.get("token") != f"for {authority}":
            raise PermissionError(f"no settings for {authority}")
        return LocalStore(), ""

    monkeypatch.setattr(Stores, "_open", opened)
    source, target = roots
    fill(source, {"f": b"x", "d/g": b"y"})
    options = {"source_options": {"token": "for a"}, "destination_options": {"token": "for b"}}
    report = tf.copy_tree(spark, f"test://a{source}", f"test://b{target}", **options)
    assert outcomes(report) == {"copied": 2, "dir_created": 2} and tree(target / "data") == tree(source)
    with pytest.raises(PermissionError):
        tf.copy_tree(spark, f"test://a{source}", f"test://b{target}")


def test_stores_whose_files_appear_when_closed(spark, roots, monkeypatch):
    from pyarrow.fs import LocalFileSystem

    from treeferry import storage

    monkeypatch.setattr(storage, "OBJECT_STORES", ("local",))
    monkeypatch.setattr(storage.Stores, "_open", staticmethod(lambda *_: (storage.ArrowStore(LocalFileSystem()), "")))
    source, target = roots
    fill(source, {"f": b"x", "d/g": b"y"})
    report = tf.copy_tree(spark, f"test://a{source}", f"test://b{target}", on_error="fail")
    assert tree(target / "data") == tree(source)
    assert report.where("file_type = 'file' AND temp_path IS NULL").isEmpty()  # never straight to the file's own name


def test_repeats_in_a_plan_are_copied_once(spark, roots):
    source, target = roots
    fill(source, {"f": b"x", "g": b"y"})
    plan = plan_of(spark, source, target, {"f": 1, "g": 1})
    many = plan.join(spark.range(300).where("id > 0"), F.col("source").endswith("f") | (F.col("id") == 1))
    assert outcomes(tf.execute_copy(many.drop("id"), 1 << 20)) == {"copied": 2}


def test_small_files_share_tasks_of_few_bytes(spark, roots):
    """Each file's cost was a task's whole share of bytes, so each had a task of its own."""
    source, target = roots
    sizes = {f"f{i:04d}": i % 7 for i in range(600)} | {"large": 3 << 20}
    fill(source, {name: b"x" * size for name, size in sizes.items()})
    report = tf.execute_copy(plan_of(spark, source, target, sizes), 1 << 20).collect()
    assert {row["outcome"] for row in report} == {"copied"} and len(os.listdir(target)) == 601
    shares = Counter(row["task_attempt_id"] for row in report)
    assert 3 <= len(shares) <= 5 and max(shares.values()) <= 257


def test_ranges_are_planned_in_buckets_of_their_number(spark, roots, monkeypatch):
    """Buckets were as many as the files needed, whatever the number of their ranges."""
    from treeferry.operators import balance

    module, kept = sys.modules["treeferry.plans.copy_tree"], []
    plan_batches = module.plan_batches
    monkeypatch.setattr(balance, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(module, "plan_batches", lambda *given: kept.append(plan_batches(*given)) or kept[-1])
    source, target = roots
    fill(source, {f"f{i}": bytes(range(250)) * 20 for i in range(4)})
    tf.copy_tree(spark, str(source), str(target), on_error="fail", range_bytes=100)
    assert tree(target / "data") == tree(source)
    shares = [row["count"] for row in kept[0].rows.groupBy("partition").count().collect()]
    assert sum(shares) == 200 and max(shares) <= 60


def test_speculation_needs_an_atomic_replace(spark, roots, monkeypatch):
    from pyarrow.fs import LocalFileSystem

    from treeferry.plans import copy_tree as job
    from treeferry.storage import ArrowStore, Stores

    source, target = roots
    fill(source, {"f": b"x"})
    monkeypatch.setattr(job, "speculates", lambda spark: True)
    tf.copy_tree(spark, str(source), str(target))
    monkeypatch.setattr(Stores, "at", lambda self, uri: (ArrowStore(LocalFileSystem()), uri.removeprefix("file://")))
    with pytest.raises(ValueError, match="speculation"):
        tf.copy_tree(spark, str(source), str(target))


def test_through_pyarrow_filesystems(spark, roots, monkeypatch):
    """The whole job with the store that serves HDFS and object stores."""
    from pyarrow.fs import LocalFileSystem

    from treeferry.storage import ArrowStore, Stores

    monkeypatch.setattr(Stores, "at", lambda self, uri: (ArrowStore(LocalFileSystem()), uri.removeprefix("file://")))
    source, target = roots
    fill(source, FILES)
    fill(target, {"data/a/_SUCCESS": b"old"})
    found = outcomes(tf.copy_tree(spark, str(source), str(target)))
    assert found == {"copied": len(FILES) - 1, "replaced": 1, "dir_created": 7, "dir_exists": 2}
    assert tree(target / "data") == tree(source)


def test_only_the_roots_own_place_is_listed(spark, roots, monkeypatch):
    from treeferry.plans import copy_tree as job

    source, target = roots
    fill(source, {"f": b"x"})
    fill(target, {"unrelated/f": b"y"})
    listed, real = [], job.walk_root
    monkeypatch.setattr(job, "walk_root", lambda spark, uri, *a, **k: listed.append(uri) or real(spark, uri, *a, **k))
    tf.copy_tree(spark, str(source), str(target))
    assert sorted(listed) == [f"file://{source}", f"file://{target}/data"]


def test_create_directories(spark, roots, monkeypatch):
    monkeypatch.setattr(copying, "CALLS_PER_TASK", 4)
    _, target = roots
    (target / "there").mkdir()
    paths = ["there", "new", "new/a", "new/a/b", "none/x"] + [f"new/c{i}" for i in range(9)]
    rows = spark.createDataFrame([(None, f"file://{target}/{p}") for p in paths], "source string, destination string")
    report = tf.create_directories(rows)
    found = {r["destination"].removeprefix(f"file://{target}/"): r["outcome"] for r in report.collect()}
    assert found == {p: "dir_exists" if p == "there" else "failed" if p == "none/x" else "dir_created" for p in paths}
    assert not (target / "none").exists()
    assert tf.create_directories(rows.limit(0)).count() == 0


def test_levels_that_share_a_job(monkeypatch):
    monkeypatch.setattr(copying, "CALLS_PER_TASK", 10)
    levels = [(3, 1), (4, 2), (5, 30), (6, 5), (7, 5), (8, 1)]
    assert copying._level_groups(levels) == [[(3, 1), (4, 2)], [(5, 30)], [(6, 5), (7, 5)], [(8, 1)]]


def test_delete_paths(spark, roots):
    _, target = roots
    fill(target, {"d/e/f": b"x", "d/e2/f": b"x", "g": b"y", "kept": b"z", "dd/kept": b"z"})
    os.symlink(target / "kept", target / "d" / "link")
    os.symlink(target / "dd", target / "link")
    os.mkfifo(target / "d" / "pipe")
    (target / "d" / "empty").mkdir()
    asked = ("d", "g", "none", "d/e", "d/e/f", "d", "link", "d/none")
    rows = spark.createDataFrame([(f"file://{target}/{p}",) for p in asked], "uri string")
    report = tf.delete_paths(rows)
    found = sorted((os.path.basename(r["destination"]), r["outcome"]) for r in report.collect())
    assert found == [("d", "deleted"), ("g", "deleted"), ("link", "deleted"), ("none", "absent")]
    assert sorted(os.listdir(target)) == ["dd", "kept"] and os.listdir(target / "dd") == ["kept"]
    (target / "g").write_bytes(b"back")
    assert report.count() == 4 and (target / "g").exists()


def test_delete_a_large_tree_in_several_tasks(spark, roots, monkeypatch):
    _, target = roots
    monkeypatch.setattr(copying, "CALLS_PER_TASK", 20)
    fill(target, {f"t/d{i % 7}/f{i}": b"" for i in range(100)})
    tasks = []
    real = copying._run_once
    monkeypatch.setattr(copying, "_run_once", lambda todo, *a: tasks.append(todo.rdd.getNumPartitions()) or real(todo, *a))
    report = tf.delete_paths(spark.createDataFrame([(f"file://{target}/t",)], "uri string"))
    assert outcomes(report) == {"deleted": 1} and os.listdir(target) == [] and max(tasks) == 5


def test_relative_paths_start_at_the_working_directory(spark, roots, monkeypatch):
    source, target = roots
    fill(source, {"f": b"x"})
    here = os.path.relpath(source, spark._jvm.java.lang.System.getProperty("user.dir"))
    tf.copy_tree(spark, here + "/", f"file:{target}//")
    assert (target / "data" / "f").read_bytes() == b"x"


def test_report_summary(spark, roots):
    source, target = roots
    fill(source, {"f": b"abc", "g": b"de"})
    summary = tf.report_summary(tf.copy_tree(spark, str(source), str(target)))
    assert {tuple(r) for r in summary.collect()} == {("file", "copied", 2, 5), ("directory", "dir_created", 1, 0)}


def test_a_deletion_tells_what_stood_in_its_way(spark, roots, monkeypatch):
    from treeferry.storage import LocalStore

    class Stuck(LocalStore):
        def remove_file(self, path):
            if path.endswith("stuck"):
                raise PermissionError(f"cannot remove {path}")
            super().remove_file(path)

    source, _ = roots
    fill(source, {"tree/a/b/stuck": b"x", "tree/a/fine": b"y", "other/z": b"z"})
    uris = spark.createDataFrame([(f"file://{source}/tree",), (f"file://{source}/other",)], "uri string")
    report = {r.destination.rpartition("/")[2]: r for r in tf.delete_paths(uris, {"file://": {"store": Stuck}}).collect()}
    assert report["other"].outcome == "deleted" and report["tree"].outcome == "failed" and len(report) == 2
    assert "below it" in report["tree"].error and "cannot remove" in report["tree"].error
    assert tree(source) == {"tree": None, "tree/a": None, "tree/a/b": None, "tree/a/b/stuck": tree(source)["tree/a/b/stuck"]}
