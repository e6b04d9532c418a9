"""Old files survive copies that fail, and runs that broke off can be finished or undone."""

import os
import subprocess
import sys
import time

import pytest
from pyspark import cloudpickle

import treeferry as tf
from treeferry.operators import copying
from treeferry.operators.ledger import Ledger
from treeferry.storage import ArrowStore, LocalStore
from workload.standin import ObjectStandIn

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need its store
REPOSITORY = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def fill(root, files):
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def contents(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}


def outcomes(report):
    return {r.destination.rpartition("/")[2]: r.outcome for r in report.where("file_type = 'file'").collect()}


def plan_of(spark, source, target, sizes, action="replace"):
    rows = [(f"file://{source}/{n}", f"file://{target}/{n}", "file", size, action) for n, size in sizes.items()]
    return spark.createDataFrame(rows, "source string, destination string, file_type string, len bigint, action string")


@pytest.mark.parametrize("names", [("broken_a", "changed_b", "fine_c")])
def test_a_failure_leaves_the_old_target(spark, roots, names):
    source, target = roots
    new = {name: f"new {name} ".encode() * 1000 for name in names}
    old = {f"data/{name}": f"old {name}".encode() for name in names}
    fill(source, new)
    fill(target, old)
    store = {"store": ObjectStandIn}
    report = tf.copy_tree(spark, str(source), str(target), source_options=store, destination_options=store)
    assert outcomes(report) == {"broken_a": "failed", "changed_b": "failed", "fine_c": "replaced"}
    assert contents(target) == old | {"data/fine_c": new["fine_c"]}


def test_files_too_large_to_move(spark, roots, monkeypatch):
    """They are refused, or written directly where that is asked for."""

    class Small(ObjectStandIn):
        largest_move = 100

    source, target = roots
    new, old = {"large": b"x" * 200, "broken_l": b"y" * 200, "small": b"z"}, {"data/large": b"old", "data/broken_l": b"old", "data/small": b"old"}
    fill(source, new)
    fill(target, old)
    store = {"store": Small}
    run = lambda **more: outcomes(tf.copy_tree(spark, str(source), str(target), source_options=store, destination_options=store, **more))
    assert run() == {"large": "failed", "broken_l": "failed", "small": "replaced"}
    assert contents(target) == old | {"data/small": b"z"}
    assert run(direct_writes=True) == {"large": "replaced", "broken_l": "failed", "small": "replaced"}
    assert contents(target)["data/large"] == new["large"]
    (source / "large").write_bytes(b"changed after the listing" * 20)
    task = copying.Task(0, options={"file://": store})
    row = {"source": f"file://{source}/large", "destination": f"file://{target}/data/large", "len": 200, "action": "replace", "temp_path": f"file://{target}/t"}
    with pytest.raises(OSError, match="has 500 bytes"):
        copying._copy_file(task, row, 1 << 20, direct_writes=True)
    assert contents(target)["data/large"] == new["large"]


def test_moves_of_object_stores_never_delete_first(tmp_path, monkeypatch):
    from pyarrow.fs import LocalFileSystem

    from treeferry import storage

    monkeypatch.setattr(storage, "OBJECT_STORES", ("local",))
    monkeypatch.setattr(storage, "LARGEST_MOVES", {"local": 7})
    store = ArrowStore(LocalFileSystem())
    assert store.appears_when_closed and store.replaces_atomically and store.largest_move == 7

    class Watched:
        type_name = "local"

        def __init__(self, inner):
            self.inner = inner

        def delete_file(self, path):
            raise AssertionError("deleted first")

        def __getattr__(self, name):
            return getattr(self.inner, name)

    store.filesystem = Watched(store.filesystem)
    fill(tmp_path, {"new": b"new", "old": b"old"})
    store.rename(str(tmp_path / "new"), str(tmp_path / "old"), replace=True)
    assert contents(tmp_path) == {"old": b"new"}


class DeletesFirst(LocalStore):
    """As HDFS through pyarrow: the old file goes, then the new one is renamed. The worker
    dies in between, once for each mark."""

    replaces_atomically = False

    def rename(self, path, target, replace):
        if os.path.exists(target):
            os.remove(target)
            if target.endswith("dies"):
                os._exit(1)
        os.rename(path, target)


def test_a_gap_between_delete_and_rename_is_closed(spark, roots):
    source, target = roots
    new = {"dies": b"new" * 100, "fine": b"new", "none": b"n"}
    fill(source, new)
    fill(target, {"dies": b"old", "fine": b"old"})
    store = {"file://": {"store": DeletesFirst}}
    plan = plan_of(spark, source, target, {n: len(d) for n, d in new.items()})
    kept = {"run_id": "r1", "ledger": str(target) + "-ledger", "options": store}
    with pytest.raises(Exception):  # noqa: B017, PT011  the job ends with its worker
        tf.execute_copy(plan, 1 << 40, **kept)
    assert "dies" not in contents(target)
    found = outcomes(tf.recover_copies(spark, kept["ledger"], "r1"))
    assert found["dies"] == "finished" and contents(target)["dies"] == new["dies"]
    assert not [name for name in contents(target) if "treeferry" in name]
    again = outcomes(tf.recover_copies(spark, kept["ledger"], "r1"))
    assert "dies" not in again  # the ledger has it now
    with pytest.raises(ValueError, match="run_id"):
        tf.recover_copies(spark, kept["ledger"], "")


@pytest.mark.parametrize(
    ("left", "old", "outcome", "after"),
    [
        ({".0": b"whole"}, None, "finished", b"whole"),
        ({".0": b"whole"}, b"old", "undone", b"old"),
        ({".0": b"wh"}, None, "undone", None),
        ({".0": b"wh", ".1": b"whole"}, None, "finished", b"whole"),
        ({".1": b"wh", ".3": b"who"}, b"old", "undone", b"old"),
        ({}, b"old", "untouched", b"old"),
    ],
)
def test_what_recovery_does(spark, roots, left, old, outcome, after):
    source, target = roots
    ledger = Ledger.of(spark, str(target) + "-ledger", "r")
    assert tf.recover_copies(spark, str(target) + "-ledger", "r").isEmpty()
    plan = plan_of(spark, source, target, {"f": 5})
    row = copying.plan_batches(plan, 1 << 20, run_id="r", ledger=ledger).rows.first()
    for suffix, data in left.items():
        with open(row.temp_path.removeprefix("file://") + suffix, "wb") as file:
            file.write(data)
    if old is not None:
        fill(target, {"f": old})
    assert outcomes(tf.recover_copies(spark, str(target) + "-ledger", "r")) == {"f": outcome}
    assert contents(target) == ({} if after is None else {"f": after})


def test_ranges_are_undone(spark, roots):
    """The length of a file in ranges tells nothing: its last range may be there first."""
    source, target = roots
    ledger = Ledger.of(spark, str(target) + "-ledger", "r")
    rows = copying.plan_batches(plan_of(spark, source, target, {"f": 5}), 1 << 20, range_bytes=2, run_id="r", ledger=ledger).rows
    with open(rows.first().temp_path.removeprefix("file://"), "wb") as file:
        file.write(b"whole")
    assert outcomes(tf.recover_copies(spark, str(target) + "-ledger", "r")) == {"f": "undone"}
    assert contents(target) == {}


def test_going_on_copies_the_rest_only(spark, roots):
    source, target = roots
    files = {f"d{i % 3}/f{i}": f"text {i}".encode() for i in range(40)} | {"broken_x": b"later", "large": b"0123456789"}
    fill(source, files)
    ledger = {"run_id": "r", "ledger": str(target) + "-ledger", "range_bytes": 4}
    first = tf.copy_tree(spark, str(source), str(target), source_options={"store": ObjectStandIn}, **ledger)
    assert outcomes(first)["broken_x"] == "failed"
    for name in ("f3", "f4"):
        path = next((target / "data").rglob(name))
        path.write_bytes(b"#" * path.stat().st_size)
    (target / "data/d2/f2").unlink()  # gone since: copied again
    (source / "d1/f1").write_bytes(b"a longer text than before")  # changed since: copied again
    report = tf.copy_tree(spark, str(source), str(target), on_error="fail", **ledger)
    done = {r.destination.rpartition("/")[2] for r in report.where("task_attempt_id IS NULL AND file_type = 'file'").collect()}
    assert done == {name.rpartition("/")[2] for name in files} - {"broken_x", "f1", "f2"}
    assert set(outcomes(report)) == {name.rpartition("/")[2] for name in files} and report.count() == len(files) + 4
    found = contents(target / "data")
    assert found["d0/f3"] == b"#" * 6 and found["d1/f1"] == b"a longer text than before"
    assert {n: found[n] for n in files if n not in ("d0/f3", "d1/f4", "d1/f1")} == {n: d for n, d in files.items() if n not in ("d0/f3", "d1/f4", "d1/f1")}
    with pytest.raises(ValueError, match="run_id"):
        tf.copy_tree(spark, str(source), str(target), ledger=ledger["ledger"])


SCRIPT = """
import os, sys, time
sys.path.insert(0, sys.argv[1])
source, target, shared, ledger = sys.argv[2:6]
from pyspark.sql import SparkSession
import treeferry as tf
from treeferry.operators import copying, ledger as kept

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", shared).getOrCreate())
kept.DONE_ROWS = 3
real = copying.copy_bytes

def slow(*args, **kwargs):
    time.sleep(0.3)
    return real(*args, **kwargs)

copying.copy_bytes = slow
tf.copy_tree(spark, source, target, num_tasks=2, run_id="killed", ledger=ledger)
"""


def test_a_killed_driver(spark, roots, tmp_path):
    """The driver is killed half-way; another one copies only the rest."""
    source, target = roots
    files = {f"f{i}": os.urandom(2000) for i in range(60)}
    fill(source, files)
    shared, ledger = tmp_path / "shared", tmp_path / "ledger"
    shared.mkdir()
    broken = subprocess.Popen([sys.executable, "-c", SCRIPT, REPOSITORY, source, target, shared, ledger], cwd=tmp_path, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    until = time.monotonic() + 120
    while time.monotonic() < until and len(list((ledger / "killed" / "done").glob("[!_]*.parquet")) if (ledger / "killed" / "done").exists() else []) < 4:
        time.sleep(0.1)
    broken.kill()
    broken.wait()
    time.sleep(8)  # its workers end with it
    before = {name: os.stat(target / "data" / name).st_mtime_ns for name in os.listdir(target / "data") if not name.startswith(".")}
    assert 12 <= len(before) < 60
    report = tf.copy_tree(spark, str(source), str(target), on_error="fail", run_id="killed", ledger=str(ledger))
    assert set(outcomes(report)) == set(files) and contents(target / "data") == files
    done = {r.destination.rpartition("/")[2] for r in report.where("task_attempt_id IS NULL AND file_type = 'file'").collect()}
    assert len(done) >= 12
    assert all(os.stat(target / "data" / name).st_mtime_ns == before[name] for name in done)
    # At most the copies since the last few were handed on are made again.
    assert len(set(before) - done) <= 2 * 3
