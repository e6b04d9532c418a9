"""Manifests and real directory trees that Spark derives from the supplied tables."""

from __future__ import annotations

import contextlib
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import treeferry as tf
from treeferry.scratch import new_folder
from treeferry.session import qualified
from treeferry.storage import LocalStore, Stores, make_directories

SOURCE_ROOT = "hdfs://nn1:8020/lake/raw"
DESTINATION_ROOT = "hdfs://nn2:8020/backup"
# What a task reads at once of files, and how many it reads in all.
READ_BYTES, READ_ROWS, FILES_PER_TASK = 4 << 20, 1024, 16_384
# A task may have so many times a core's share of the rows before they are spread anew.
MOST_OF_A_CORE = 1.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_uri(root: str) -> Column:
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return F.concat_ws("/", F.lit(root), "lang", "source", name)


def _folders(documents: DataFrame, *levels: Column) -> DataFrame:
    """The folders that documents are in. The few distinct ones are expanded, not
    every document."""
    leaves = documents.select("lang", "source").distinct()
    folders = leaves.select(F.explode(F.array(*levels)).alias("uri")).distinct()
    return folders.select("uri", F.lit(0).cast("bigint").alias("len"), F.lit("directory").alias("file_type"))


def source_entries(spark: SparkSession, sf_dir: str, root: str = SOURCE_ROOT, length: str = "n_chars") -> DataFrame:
    """A listing with one file per document, by language and source."""
    documents = table(spark, sf_dir, "documents")
    files = documents.select(
        document_uri(root).alias("uri"), F.expr(length).cast("bigint").alias("len"), F.lit("file").alias("file_type")
    )
    return files.unionByName(
        _folders(
            documents,
            F.lit(root),
            F.concat_ws("/", F.lit(root), "lang"),
            F.concat_ws("/", F.lit(root), "lang", "source"),
        )
    )


def destination_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A destination that has the labelled documents already, the toxic ones with a
    wrong length and the toxic bad ones as directories, a file where the folder of source
    ``src0`` must go, and some files that the source lacks."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    root = DESTINATION_ROOT + "/raw"
    copied = documents.join(labels, "doc_id").select(
        document_uri(root).alias("uri"), (F.col("n_chars") + F.col("toxic")).alias("len"),
        F.when((F.col("toxic") == 1) & (F.col("quality") == 0), "directory").otherwise("file").alias("file_type"),
    )
    in_the_way = documents.where(F.col("source") == "src0").select(
        F.concat_ws("/", F.lit(root), "lang", "source").alias("uri"), F.lit(3).cast("bigint").alias("len"), F.lit("file").alias("file_type")
    )
    old = labels.where(F.col("quality") == 0).select(
        F.concat(F.lit(DESTINATION_ROOT + "/old/part_"), F.col("doc_id").cast("string")).alias("uri"),
        F.lit(7).cast("bigint").alias("len"),
        F.lit("file").alias("file_type"),
    )
    folders = _folders(documents, F.lit(DESTINATION_ROOT), F.lit(root), F.concat_ws("/", F.lit(root), "lang"))
    return copied.unionByName(old).unionByName(folders).unionByName(in_the_way.distinct())


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.to_source_manifest(source_entries(spark, sf_dir), SOURCE_ROOT, DESTINATION_ROOT)


def destination_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.to_destination_manifest(destination_entries(spark, sf_dir))


def full_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = tf.copy_plan(source_table(spark, sf_dir), destination_table(spark, sf_dir))
    return tf.with_dependencies(plan, SOURCE_ROOT, DESTINATION_ROOT)


def new_root(spark: SparkSession, name: str) -> str:
    """An empty directory in the shared folder."""
    root = qualified(spark, new_folder(spark, name))[0]
    make_directories(root)
    return root


def write_files(files: DataFrame) -> None:
    """Make real files of ``uri, text``, in folders that exist."""
    _write(files.select("uri", "text"), _write_files)


def write_under_names(files: DataFrame) -> None:
    """Make real files of ``uris, text``, in folders that exist: the text under each of the names.
    On a mount that has hard links they are names of one file, which takes its blocks once; to
    write over one of them in place changes all."""
    _write(files.select("uris", "text"), _write_under_names)


def _write(rows: DataFrame, act) -> None:
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # Texts are moved to other tasks only where those that read them would leave cores idle.
    if _largest_share(rows) > MOST_OF_A_CORE / cores:
        rows = rows.repartition(cores)
    rows.mapInArrow(act, "files bigint").agg(F.sum("files")).collect()


def _largest_share(rows: DataFrame) -> float:
    """The largest task's part of all rows, counted without their columns."""
    tasks = rows.groupBy(F.spark_partition_id()).count()
    largest, total = tasks.agg(F.max("count"), F.sum("count")).first()
    return largest / total if total else 0.0


def write_links(links: DataFrame) -> None:
    """Make symbolic links ``uri`` to ``text``, on a local mount."""

    def write(batches):
        stores = Stores()
        for batch in batches:
            for uri, text in zip(batch.column("uri").to_pylist(), batch.column("text").to_pylist()):
                path = stores.at(uri)[1]
                with contextlib.suppress(FileNotFoundError):
                    os.remove(path)
                os.symlink(text, path)
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    # However few splits the tables are read in, all cores write.
    spread = links.select("uri", "text").repartition(links.sparkSession.sparkContext.defaultParallelism)
    spread.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


def move_files(files: DataFrame) -> None:
    """Rename files ``uri`` to ``target``."""

    def move(batches):
        stores = Stores()
        for batch in batches:
            for uri, target in zip(batch.column("uri").to_pylist(), batch.column("target").to_pylist()):
                store, path = stores.at(uri)
                try:
                    store.rename(path, stores.at(target)[1], replace=True)
                except FileNotFoundError:
                    if store.status(path) or not store.status(stores.at(target)[1]):  # else a lost attempt was faster
                        raise
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    spread = files.select("uri", "target").repartition(files.sparkSession.sparkContext.defaultParallelism)
    spread.mapInArrow(move, "files bigint").agg(F.sum("files")).collect()


def _write_files(batches):
    """Write ``text`` to each ``uri``, whatever is there."""
    stores = Stores()
    for batch in batches:
        for uri, text in zip(batch.column("uri").to_pylist(), batch.column("text").to_pylist()):
            _write_file(*stores.at(uri), text)
        yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})


def _write_under_names(batches):
    """Write ``text`` to the first of ``uris`` and link the others to it, where they can be linked."""
    stores = Stores()
    for batch in batches:
        for uris, text in zip(batch.column("uris").to_pylist(), batch.column("text").to_pylist()):
            store, first = stores.at(uris[0])
            _write_file(store, first, text)
            for other, path in map(stores.at, uris[1:]):
                if not (isinstance(store, LocalStore) and isinstance(other, LocalStore) and _link(first, path)):
                    _write_file(other, path, text)
        yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})


def _write_file(store, path: str, text: str) -> None:
    """Write a file, whatever is there. A file on a mount is written over in place: its blocks
    are not freed, and the directory that all tasks share does not change."""
    in_place = isinstance(store, LocalStore)
    with store.open_range(path, 0) if in_place else store.open_fresh(path) as file:
        data = memoryview(text.encode("utf-8"))
        while len(data):
            data = data[file.write(data) :]
        if in_place:
            file.truncate()


def _link(file: str, path: str) -> bool:
    """Make ``path`` a name of ``file``, whatever is there; False where the mount has no such links."""
    try:
        with contextlib.suppress(FileExistsError):
            os.link(file, path)
            return True
        if not os.path.samefile(file, path):  # else of an earlier attempt
            os.remove(path)
            os.link(file, path)
        return True
    except OSError:
        return False


def read_files(files: DataFrame) -> DataFrame:
    """``uri, text`` of files, also of those whose names Spark's readers cannot hold. However few
    tasks have listed them, all cores read."""

    def read(batches):
        stores, uris, texts, held = Stores(), [], [], 0
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                store, path = stores.at(uri)
                with store.open_input(path) as file:
                    texts.append(file.read())
                uris.append(uri)
                held += len(texts[-1])
                if held >= READ_BYTES or len(uris) >= READ_ROWS:
                    yield _texts_of(uris, texts)
                    uris, texts, held = [], [], 0
        if uris:
            yield _texts_of(uris, texts)

    uris = files.select("uri")
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-uris.count() // FILES_PER_TASK))
    return uris.repartition(tasks).mapInArrow(read, "uri string, text string")


def _texts_of(uris: list[str], texts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"uri": uris, "text": pa.array([text.decode("utf-8") for text in texts], pa.string())})


def write_documents(documents: DataFrame, root: str) -> None:
    """Make real files ``<root>/<lang>/<source>/doc_<id>.txt`` of documents."""
    folders = _folders(
        documents, F.concat_ws("/", F.lit(root), "lang"), F.concat_ws("/", F.lit(root), "lang", "source")
    )
    made = tf.create_directories(folders.select(F.lit(None).cast("string").alias("source"), F.col("uri").alias("destination")))
    if not made.where(F.col("outcome") == "failed").isEmpty():
        raise OSError(f"could not make the folders below {root}")
    write_files(documents.select(document_uri(root).alias("uri"), "text"))


_trees: dict[tuple[str, str], str] = {}


def document_tree(spark: SparkSession, sf_dir: str) -> str:
    """A directory ``raw`` with every document as a file; made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trees:
        root = new_root(spark, "documents")
        make_directories(root + "/raw")
        write_documents(table(spark, sf_dir, "documents"), root + "/raw")
        _trees[key] = root + "/raw"
    return _trees[key]


def relative_to(column: str, root: str) -> Column:
    """A URI below ``root`` without the part that differs between runs."""
    return F.substr(column, F.lit(len(root) + 1))
