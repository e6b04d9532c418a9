import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import treeferry as tf
from workload import inputs
from workload.check import compare
from workload.oracles import ORACLES
from workload.queries import QUERIES, _leftovers, _texts_by_id, checked_rows

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the supplied tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    same, got, wanted = compare(spark, SF_DIR, name)
    assert got == wanted and same


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the supplied tables")
def test_entry(spark):
    report = driver.entry(spark)
    assert report.where("outcome = 'copied'").count() == 14


def test_readback_compares_rows(spark):
    """A row count alone let wrong values pass."""
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i long, t string")
    assert checked_rows(rows.orderBy("t"), rows, "t").collect() == [("t", 3)]
    for other in ([(1, "b"), (2, None), (2, None)], [(1, "a"), (2, None), (2, "a")]):
        with pytest.raises(Exception, match="other rows"):
            checked_rows(spark.createDataFrame(other, rows.schema), rows, "t").collect()


def test_files_are_read_back_without_a_list_in_the_driver(spark, tmp_path):
    """Spark's reader held every name in the driver, and had no row for an empty file."""
    for name, text in {"doc_1.txt": "", "doc_2.txt": "two\nlines", ".doc_3.txt": "hidden", "other": "x"}.items():
        (tmp_path / name).write_text(text)
    texts = _texts_by_id(spark, str(tmp_path), r"doc_(\d+)\.txt$")
    assert sorted(texts.where("doc_id IS NOT NULL").select("doc_id", "text").collect()) == [(1, ""), (2, "two\nlines")]
    assert texts.where("doc_id IS NULL").select("text").collect() == [("x",)]
    assert "FileScan text" not in texts._jdf.queryExecution().executedPlan().toString()


def test_leftovers_are_longer_than_their_files_and_no_more(spark):
    """All had 50,000 bytes: less than long documents, and far more than short ones."""
    lengths = [0, 1, 9, 10, 11, 4000, 70_000]
    entries = spark.createDataFrame([(f"file:///s/raw/f{n}", n, "file") for n in lengths], "uri string, len bigint, file_type string")
    rows = _leftovers(entries, "file:///s/raw", "file:///t", "again").collect()
    assert len({row["uri"] for row in rows}) == 2 * len(lengths)
    over = sorted(len(row["text"]) - n for row, n in zip(rows, [n for n in lengths for _ in range(2)]))
    assert over[0] > 0 and over[-1] <= 20


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the supplied tables")
def test_copies_over_leftovers_have_one_place(spark, monkeypatch):
    """Both copies and the leftovers beside each stood on disk together: four files a document."""
    roots, before, new_root, copy_tree = [], [], inputs.new_root, tf.copy_tree
    below = lambda root: [f"{folder}/{name}" for folder, _, names in os.walk(root.removeprefix("file://")) for name in names]
    monkeypatch.setattr(inputs, "new_root", lambda spark, name: roots.append(new_root(spark, name)) or roots[-1])

    def watched(spark, source, root, **options):
        before.append({path: os.path.getsize(path) for path in below(root)})
        return copy_tree(spark, source, root, **options)

    monkeypatch.setattr(tf, "copy_tree", watched)
    QUERIES["copy_over_leftovers"](spark, SF_DIR)
    documents = inputs.table(spark, SF_DIR, "documents").count()
    files = [path for root in roots if "-documents-" not in root for path in below(root)]
    assert len(files) == 2 * documents
    assert sum(os.path.basename(path).startswith("doc_") for path in files) == documents
    # The second copy finds what the first one did: leftovers alone, at the same names and as long.
    assert before[0] == before[1] and len(before[0]) == 2 * documents
    assert not any(os.path.basename(path).startswith("doc_") for path in before[1])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the supplied tables")
def test_names_to_be_excluded_take_no_blocks(spark, monkeypatch):
    """Six files with a document's text stood on disk for two copies of it."""
    roots, new_root = {}, inputs.new_root
    monkeypatch.setattr(inputs, "new_root", lambda spark, name: roots.setdefault(name, new_root(spark, name)))
    QUERIES["copy_tree_excluding"](spark, SF_DIR)
    documents = inputs.table(spark, SF_DIR, "documents").count()
    found = {
        name: [os.stat(f"{folder}/{each}") for folder, _, names in os.walk(root.removeprefix("file://")) for each in names]
        for name, root in roots.items()
    }
    assert len(found["marked"]) == 6 * documents and len({file.st_ino for file in found["marked"]}) == documents
    assert len(found["unmarked"]) == 2 * documents and all(file.st_nlink == 1 for file in found["unmarked"])


def test_files_under_several_names(spark, tmp_path, monkeypatch):
    """Over what is there, over what an earlier attempt linked, and where nothing can be linked."""
    texts = {"a": "ä" * 9, "b": "", "c": "new"}
    wanted = {f"{name}{number}": text for name, text in texts.items() for number in range(3)}
    rows = pa.RecordBatch.from_pydict({"uris": [[f"file://{tmp_path}/{name}{number}" for number in range(3)] for name in texts], "text": list(texts.values())})
    for name in ("a0", "a2", "b1", "c0"):
        (tmp_path / name).write_text("an older text, of another length")
    read = lambda: {name: (tmp_path / name).read_text() for name in os.listdir(tmp_path)}
    inodes = lambda: {name: os.stat(tmp_path / name).st_ino for name in wanted}
    assert [batch.to_pydict() for batch in inputs._write_under_names([rows])] == [{"files": [3]}]
    first = inodes()
    assert read() == wanted and len(set(first.values())) == 3
    list(inputs._write_under_names([rows]))
    assert read() == wanted and inodes() == first
    for name in ("a1", "b2"):
        (tmp_path / name).unlink()

    def no_links(*_):
        raise PermissionError("no hard links here")

    monkeypatch.setattr(os, "link", no_links)
    list(inputs._write_under_names([rows]))
    assert read() == wanted and len(set(inodes().values())) == 5


def test_moved_files_may_be_moved_before(spark, tmp_path):
    """A task that is repeated finds what a lost attempt at it has moved."""
    rows = spark.createDataFrame([(f"file://{tmp_path}/{name}", f"file://{tmp_path}/to_{name}") for name in "abc"], "uri string, target string")
    for name in ("a", "b", "to_b", "to_c"):
        (tmp_path / name).write_text(name)
    inputs.move_files(rows)
    assert {name: (tmp_path / name).read_text() for name in os.listdir(tmp_path)} == {"to_a": "a", "to_b": "b", "to_c": "to_c"}
    with pytest.raises(Exception, match="FileNotFoundError"):
        inputs.move_files(rows.select("uri", F.concat("target", F.lit("_none")).alias("target")))


def test_all_cores_write_links_and_read_files(spark, tmp_path, monkeypatch):
    """A table in one split was written by one task, and what one task had listed read by one."""
    ids = spark.range(0, 40, 1, 1)
    uri = F.concat(F.lit(f"file://{tmp_path}/"), F.col("id").cast("string"))
    (tmp_path / "real").write_text("text")
    for _ in range(2):  # again over what is there
        inputs.write_links(ids.select(uri.alias("uri"), F.lit("real").alias("text")))
    assert sorted(os.listdir(tmp_path)) == sorted([str(i) for i in range(40)] + ["real"])
    assert all(os.readlink(tmp_path / str(i)) == "real" for i in range(40))
    read = inputs.read_files(ids.select(uri.alias("uri")))
    assert read.where("text = 'text'").count() == 40
    assert read.select(F.spark_partition_id().alias("p")).distinct().count() == spark.sparkContext.defaultParallelism

    tasks = []
    monkeypatch.setattr(type(ids), "mapInArrow", lambda self, *_: tasks.append(self.rdd.getNumPartitions()) or spark.range(1).selectExpr("id AS files"))
    inputs.write_links(ids.select(uri.alias("uri"), F.lit("real").alias("text")))
    assert tasks == [spark.sparkContext.defaultParallelism]


def test_files_are_written_over_in_place(tmp_path, monkeypatch):
    """A file that was there was removed and made anew, in a directory that all tasks wait for."""
    texts = {"shorter": "ä", "longer": "new " * 9, "empty": "", "absent": "new"}
    for name in ("shorter", "longer", "empty"):
        (tmp_path / name).write_text("an older text")
    before = {name: os.stat(tmp_path / name).st_ino for name in os.listdir(tmp_path)}
    monkeypatch.setattr(os, "remove", lambda path: pytest.fail(f"removed {path}"))
    rows = pa.RecordBatch.from_pydict({"uri": [f"file://{tmp_path}/{name}" for name in texts], "text": list(texts.values())})
    assert [batch.to_pydict() for batch in inputs._write_files([rows])] == [{"files": [4]}]
    assert {name: (tmp_path / name).read_bytes() for name in os.listdir(tmp_path)} == {n: t.encode() for n, t in texts.items()}
    assert before == {name: os.stat(tmp_path / name).st_ino for name in before}


def test_texts_move_only_where_cores_would_be_idle(spark, tmp_path, monkeypatch):
    """All texts went through a shuffle before they were written."""
    cores, spread = spark.sparkContext.defaultParallelism, []
    uri = F.concat(F.lit(f"file://{tmp_path}/"), F.col("id").cast("string"))
    rows = lambda tasks: spark.range(0, 40, 1, tasks).select(uri.alias("uri"), F.col("id").cast("string").alias("text"))
    kind = type(rows(1))
    repartition = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, count, *by: spread.append(count) or repartition(self, count, *by))
    inputs.write_files(rows(cores))
    assert spread == [] and len(os.listdir(tmp_path)) == 40
    inputs.write_files(rows(cores).where("id < 0"))
    inputs.write_files(rows(1))
    inputs.write_files(rows(cores).where("id < 10"))  # all with the first task
    assert spread == [cores, cores]
    assert {name: (tmp_path / name).read_text() for name in os.listdir(tmp_path)} == {str(i): str(i) for i in range(40)}
