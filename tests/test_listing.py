import os

import pyarrow as pa
import pytest

import treeferry as tf
from treeferry.sources import listing
from treeferry.storage import escaped_name, plain_path


def test_whole_tree_with_hidden_and_empty_entries(spark, roots):
    source, _ = roots
    (source / "a" / "b").mkdir(parents=True)
    (source / ".hidden").mkdir()
    (source / "empty").mkdir()
    for name, size in {"a/b/f": 5, "a/_SUCCESS": 0, ".hidden/x y%20:z": 2, "top": 1}.items():
        (source / name).write_bytes(b"x" * size)
    root = f"file://{source}"
    rows = tf.list_tree(spark, str(source)).collect()
    found = {row["uri"].removeprefix(root): (row["len"], row["file_type"], row["depth"]) for row in rows}
    assert len(rows) == len(found) and found == {
        "": (0, "directory", 0),
        "/a": (0, "directory", 1),
        "/a/b": (0, "directory", 2),
        "/a/b/f": (5, "file", 3),
        "/a/_SUCCESS": (0, "file", 2),
        "/.hidden": (0, "directory", 1),
        "/.hidden/x y%20:z": (2, "file", 2),
        "/empty": (0, "directory", 1),
        "/top": (1, "file", 1),
    }
    chains = {row["uri"]: [a["uri"] for a in row["ancestors"]] for row in rows}
    assert chains[root + "/a/b/f"] == [root, root + "/a", root + "/a/b"]


def test_links_are_left_out(spark, roots):
    source, _ = roots
    (source / "d").mkdir()
    (source / "f").write_text("x")
    os.symlink(source / "f", source / "to_file")
    os.symlink(source, source / "d" / "to_root")
    os.symlink(source / "gone", source / "dangling")
    names = {os.path.basename(row["uri"]) for row in tf.list_tree(spark, str(source)).collect()}
    assert names == {"data", "d", "f"}


def test_single_file_root_is_listed_once(spark, roots):
    source, _ = roots
    (source / "f").write_text("abc")
    rows = tf.list_tree(spark, str(source / "f")).collect()
    assert [(r["uri"], r["len"], r["file_type"], r["ancestors"]) for r in rows] == [(f"file://{source}/f", 3, "file", [])]


def test_missing_root(spark, roots):
    with pytest.raises(FileNotFoundError):
        tf.list_tree(spark, str(roots[0] / "none"))


def test_what_cannot_be_listed_is_an_error_row(spark, roots):
    source, _ = roots
    os.mkfifo(source / "pipe")
    (source / "good").write_text("x")
    found = tf.walk_tree(spark, str(source))
    assert found.entries.count() == 2
    errors = {os.path.basename(row["uri"]): row["error"] for row in found.errors.collect()}
    assert errors == {"pipe": "neither a file nor a directory"}


def frontier(uri, depth):
    nothing = pa.array([None], pa.string())
    return pa.RecordBatch.from_pydict({"uri": [uri], "depth": pa.array([depth], pa.int32()), "low": nothing, "high": nothing})


def test_unreadable_directory_is_an_error_row(tmp_path):
    batch = frontier(f"file://{tmp_path}/gone", 3)
    rows = [row for out in listing._walk(1.0)(iter([batch])) for row in out.to_pylist()]
    assert [(r["kind"], r["depth"]) for r in rows] == [("failed", 3)] and "FileNotFoundError" in rows[0]["error"]


def make_wide_tree(source):
    expected = set()
    for i in range(7):
        for j in range(5):
            folder = source / f"d{i}" / f"e{j}"
            folder.mkdir(parents=True)
            (folder / "f").write_text("x")
            expected |= {f"d{i}", f"d{i}/e{j}", f"d{i}/e{j}/f"}
    deep = source
    for level in range(12):
        deep = deep / f"n{level}"
        deep.mkdir()
        expected.add(str(deep.relative_to(source)))
    return expected


def test_work_left_over_goes_to_later_rounds(spark, roots, monkeypatch):
    """With no time to go on, each task reads one directory per round."""
    monkeypatch.setattr(listing, "FIRST_ROUND_SECONDS", 0.0)
    monkeypatch.setattr(listing, "ROUND_SECONDS", 0.0)
    source, _ = roots
    expected = make_wide_tree(source)
    rows = [row["uri"] for row in tf.list_tree(spark, str(source), num_tasks=3).collect()]
    assert sorted(rows) == sorted([f"file://{source}"] + [f"file://{source}/{path}" for path in expected])


def test_a_task_queues_no_more_than_its_share(tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "DIRECTORIES_PER_TASK", 4)
    expected = make_wide_tree(tmp_path)
    entries, todo = [], [(f"file://{tmp_path}", 0)]
    while todo:
        batch = frontier(*todo[0])
        out = [row for rows in listing._walk(60.0)(iter([batch])) for row in rows.to_pylist()]
        entries += [row["uri"] for row in out if row["kind"] == "entry"]
        todo = todo[1:] + [(row["uri"], row["depth"]) for row in out if row["kind"] == "pending"]
    assert sorted(entries) == sorted(f"file://{tmp_path}/{path}" for path in expected)


def test_a_flat_directory_is_read_in_ranges(spark, tmp_path):
    """Several tasks read one directory, none of them much more than its share."""
    names = [f"f{i:05d}" for i in range(6000)] + [f"Ä{i}" for i in range(300)] + ["low", "high", "a" * 255]
    for name in names:
        (tmp_path / name).write_bytes(name.encode()[:3])
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x").write_bytes(b"x")
    os.mkdir(os.fsencode(tmp_path) + b"/\xff")
    found = listing.walk_tree(spark, str(tmp_path), entries_per_range=500)
    rows = [(r.uri.rpartition("/")[2], r.len, r.file_type) for r in found.entries.where("depth = 1").collect()]
    assert sorted(rows) == sorted([(n, len(n.encode()[:3]), "file") for n in names] + [("sub", 0, "directory"), ("\uf8feff", 0, "directory")])
    assert found.entries.count() == len(names) + 4 and found.files == len(names) + 1 and found.failures == 0
    ranges = found.rows.where("kind = 'pending' AND low IS NOT NULL OR kind = 'pending' AND high IS NOT NULL").collect()
    assert len(ranges) >= 13
    shares = [sum((r.low is None or n >= r.low) and (r.high is None or n < r.high) for n in names) for r in ranges]
    read = [s for s in shares if s <= 501]
    assert len(read) >= 13 and max(shares) < 2 * 501


def test_a_flat_directory_of_byte_names_is_read_in_ranges(spark, tmp_path):
    """Names that are not UTF-8 gave no bounds, so one task read them all."""
    names = [b"\xc3\xc3\xa4\x80_%d" % i for i in range(400)] + [b"\xff%d" % i for i in range(200)] + [b"\xef\xa3\xbeff", b"\xef\xa3\xbe", b"a", b"\xc3\xa4"]
    for i, name in enumerate(names):
        with open(os.fsencode(tmp_path) + b"/" + name, "wb") as file:
            file.write(b"x" * (i % 7))
    found = listing.walk_tree(spark, str(tmp_path), entries_per_range=100)
    rows = [(os.fsencode(plain_path(r.uri.rpartition("/")[2])), r.len) for r in found.entries.where("depth = 1").collect()]
    assert sorted(rows) == sorted((name, i % 7) for i, name in enumerate(names)) and found.failures == 0
    ranges = found.rows.where("kind = 'pending' AND (low IS NOT NULL OR high IS NOT NULL)").select("low", "high").collect()
    held = [escaped_name(os.fsdecode(name)) for name in names]
    shares = [sum((r.low is None or n >= r.low) and (r.high is None or n < r.high) for n in held) for r in ranges]
    assert len(ranges) >= 6 and max(shares) < 200


def test_ranges_cover_everything_once():
    _ranges = listing._ranges
    names = [f"{i * 7919 % 10007}" for i in range(10007)]
    ranges = _ranges(iter(names), None, None, 1000)
    assert ranges[0][0] is None and ranges[-1][1] is None and [a[1] for a in ranges[:-1]] == [b[0] for b in ranges[1:]]
    inner = _ranges(iter(names), "3", "5", 100)
    assert inner[0][0] == "3" and inner[-1][1] == "5"
    assert _ranges(iter(["a"]), None, None, 1) == [(None, None)]
    assert _ranges(iter(["\udcff", "\udcfe"]), None, None, 1) == [(None, None)]


def test_a_task_reads_a_directory_once_for_all_its_ranges(tmp_path, monkeypatch):
    """Each range was a reading of the whole directory, and of twice as many if it was too large."""
    names = [f"f{i:04d}" for i in range(1000)]
    for name in names:
        (tmp_path / name).write_bytes(b"xy")
    read, scandir = [], os.scandir
    monkeypatch.setattr(os, "scandir", lambda path: read.append(path) or scandir(path))
    edges = [None, *names[25:600:25], "f07", "f08"]  # two ranges of 100 and more, a gap after them
    low, high = edges[:-1], edges[1:]
    batch = pa.RecordBatch.from_pydict({"uri": [f"file://{tmp_path}"] * len(low), "depth": pa.array([0] * len(low), pa.int32()), "low": low, "high": high})
    rows = [row for out in listing._walk(60.0, share=50)(iter([batch])) for row in out.to_pylist()]
    assert len(read) == 2  # once for what is in each range, once for the entries
    found = {row["uri"].rpartition("/")[2]: row["len"] for row in rows if row["kind"] == "entry"}
    parts = sorted((row["low"], row["high"]) for row in rows if row["kind"] == "pending")
    assert found == dict.fromkeys(names[:575], 2)
    assert parts[0][0] == "f0575" and parts[-1][1] == "f08" and {p[1] for p in parts[:-1]} == {p[0] for p in parts[1:]}
    assert max(sum(a <= name < b for name in names) for a, b in parts) <= 63
