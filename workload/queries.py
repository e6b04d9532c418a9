"""One query per operator. Each runs the operator itself over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import treeferry as tf
from treeferry.operators.balance import task_count
from treeferry.operators.copying import plan_batches, temp_uri
from treeferry.operators.ledger import Ledger
from treeferry.scratch import written
from treeferry.storage import MARK
from workload import inputs
from workload.inputs import DESTINATION_ROOT, SOURCE_ROOT, relative_to, table
from workload.standin import HealedStandIn, ObjectStandIn

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SHARES = 48
LEAST_BUCKETS = 8

# --- functions over URIs


def qualify_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's path in the ways that users write it: relative, with dots,
    without scheme or authority."""
    spelled = F.expr(
        """array(
             concat(lang, '//', source, '/doc_', doc_id),
             concat('/lake/./', lang, '/../', lang, '/', source, '/doc_', doc_id, '/'),
             concat('hdfs://nn2:8020/', lang, '/', source, '/doc ', doc_id),
             concat('hdfs:///', lang, '/', source, '/doc_', doc_id),
             concat('s3a://', source, '/', lang, '//doc%20', doc_id, '//'),
             concat('file:/', lang, '/x/y/../../', source, '/doc:', doc_id))"""
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", F.explode(spelled).alias("path"))
    return documents.withColumn("uri", tf.qualify_path("path", "hdfs://nn1:8020", "/user/etl"))


def map_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = inputs.source_entries(spark, sf_dir)
    return entries.select(
        "uri", "len", "file_type", tf.map_destination("uri", SOURCE_ROOT, DESTINATION_ROOT).alias("destination")
    )


def uri_is_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages against their own section, look-alikes of it, and another protocol."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("uri"))
    pages = pages.withColumn("section", F.regexp_extract("uri", "^[a-z]+://[^/]+/[^/]+", 0))
    longer, slash = F.concat("section", F.lit("x")), F.concat("section", F.lit("/"))
    other = F.regexp_replace("section", "^https?:", "ftp:")
    shorter = F.expr("substr(section, 1, length(section) - 1)")
    section, uri = F.col("section"), F.col("uri")
    pairs = {
        "in_section": (section, uri),
        "in_section_slash": (slash, uri),
        "section_in_slash": (slash, section),
        "slash_in_section": (section, slash),
        "in_longer": (longer, uri),
        "in_shorter": (shorter, uri),
        "in_other_scheme": (other, uri),
        "section_in_page": (uri, section),
    }
    every = [
        F.struct(F.lit(name).alias("pair"), parent.alias("parent"), child.alias("child"))
        for name, (parent, child) in pairs.items()
    ]
    paired = pages.select("page_id", F.inline(F.array(every)))
    return paired.select("page_id", "pair", tf.uri_is_child("parent", "child").alias("is_child"))


def classify_file_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = inputs.source_entries(spark, sf_dir)
    named = entries.select("uri", F.col("uri").endswith(".txt").alias("leaf"), (F.col("len") == 0).alias("empty"))
    kind = tf.classify_file_type(~F.col("leaf") & F.col("empty"), "leaf", "uri")
    typed = named.select("uri", kind.alias("file_type"))
    return typed.select(
        "uri", "file_type", tf.is_directory().alias("is_directory"), tf.is_file().alias("is_file")
    )


def ancestor_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = inputs.source_entries(spark, sf_dir)
    chain = tf.ancestor_dependencies("uri", SOURCE_ROOT)
    exploded = entries.select("uri", F.posexplode(chain).alias("position", "ancestor"))
    return exploded.select(
        "uri",
        "position",
        F.col("ancestor.uri").alias("ancestor"),
        F.col("ancestor.len").alias("ancestor_len"),
        F.col("ancestor.file_type").alias("ancestor_type"),
    )


def dependent_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tf.with_dependencies(inputs.source_table(spark, sf_dir), SOURCE_ROOT, DESTINATION_ROOT)
    exploded = manifest.select(
        F.col("source").alias("uri"), F.posexplode("dependent_folders").alias("position", "folder")
    )
    return exploded.select("uri", "position", "folder.source", "folder.destination")


def exclude_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the output of a job, next to marker files and look-alikes."""
    marked = F.expr(
        """transform(
             array('_temporary/0/task-', '_SUCCESS-', '_committed_', '_started_', 'x_temporary/part-',
                   '_temporary_copy/part-', 'part-'),
             name -> concat('hdfs://nn1:8020/out/', lang, '/', source, '/', name, doc_id))"""
    )
    folder = F.expr("concat('hdfs://nn1:8020/out/', lang, '/', source, '/', doc_id, '/_temporary')")
    documents = table(spark, sf_dir, "documents")
    uris = documents.select("doc_id", F.explode(F.array_append(marked, folder)).alias("uri"))
    return tf.exclude_paths(uris)


# --- manifests, plans and summaries


def compare_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.compare_manifests(inputs.source_table(spark, sf_dir), inputs.destination_table(spark, sf_dir))


def compare_kept_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison of two manifests that were kept, as a later run opens them; fails where
    it would move rows."""
    folder = inputs.new_root(spark, "kept")
    for name, manifest in (("source", inputs.source_table(spark, sf_dir)), ("destination", inputs.destination_table(spark, sf_dir))):
        tf.keep_manifest(manifest, f"{folder}/{name}", buckets=8)
    compared = tf.compare_manifests(tf.kept_manifest(spark, folder + "/source"), tf.kept_manifest(spark, folder + "/destination"))
    plan = compared._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan:
        raise AssertionError("kept manifests are shuffled again:\n" + plan)
    return compared


def copy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.copy_plan(inputs.source_table(spark, sf_dir), inputs.destination_table(spark, sf_dir))


def expand_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.expand_copies(inputs.full_plan(spark, sf_dir))


def expand_folder_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a plan that names folders by numbers."""
    folders, rows = tf.folder_dictionary(inputs.source_table(spark, sf_dir), SOURCE_ROOT, DESTINATION_ROOT)
    return tf.expand_folder_ids(rows, folders, SOURCE_ROOT, DESTINATION_ROOT)


def distinct_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.distinct_copies(expand_copies(spark, sf_dir))


def directories_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders that the files alone depend on."""
    files = inputs.source_table(spark, sf_dir).where(tf.is_file())
    return tf.directories_of(files, SOURCE_ROOT, DESTINATION_ROOT)


def verify_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.verify_lengths(inputs.source_table(spark, sf_dir), inputs.destination_table(spark, sf_dir))


def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.manifest_summary(inputs.source_entries(spark, sf_dir))


# --- batches


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_linenumber").alias("partition"),
        (F.col("l_suppkey") % 5 + F.col("l_linenumber") % 3).cast("int").alias("batch"),
    )


def batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.batch_index(_batches(spark, sf_dir))


def batch_partition_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.batch_partition_offsets(batch_index(spark, sf_dir))


def assign_batch_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch numbers beyond the index wrap around, so part keys serve as batches."""
    offsets = written(batch_partition_offsets(spark, sf_dir), "offsets")
    keyed = _batches(spark, sf_dir).withColumn("batch", F.col("l_partkey").cast("int"))
    return tf.assign_batch_partition(keyed, offsets).select("l_orderkey", "partition", "batch", "task")


def _balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.source_table(spark, sf_dir).where(tf.is_file()).select("source", "destination", "len")
    total = files.agg(F.count("*").alias("files"), F.sum("len").alias("bytes")).first()
    share = -(-total["bytes"] // SHARES)
    return tf.balance_by_bytes(files, share, total["files"], least_buckets=LEAST_BUCKETS)


def balance_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _balanced(spark, sf_dir)


def route_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced documents in the tasks that their batches name; ``landed`` is the task
    in which each row was found."""
    batches = written(_balanced(spark, sf_dir), "batches")
    offsets = written(tf.batch_partition_offsets(tf.batch_index(batches)), "offsets")
    routed = tf.route_batches(tf.assign_batch_partition(batches, offsets), task_count(offsets))
    return routed.select("destination", "len", "task", F.spark_partition_id().alias("landed"))


# --- real directory trees


def list_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = inputs.document_tree(spark, sf_dir)
    listed = tf.list_tree(spark, root)
    return listed.select(
        relative_to("uri", root).alias("path"),
        "len",
        "file_type",
        "depth",
        F.array_join(
            F.transform("ancestors", lambda folder: F.substr(folder["uri"], F.lit(len(root) + 1))), ":"
        ).alias("ancestors"),
    )


def list_flat_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one directory, read in ranges of about fifty names by several tasks."""
    root = inputs.new_root(spark, "flat")
    documents = table(spark, sf_dir, "documents")
    inputs.write_files(documents.select(F.concat(F.lit(root + "/doc_"), F.col("doc_id").cast("string")).alias("uri"), "text"))
    listing = tf.walk_tree(spark, root, entries_per_range=50)
    ranges = listing.rows.where("kind = 'pending' AND (low IS NOT NULL OR high IS NOT NULL)").count()
    if ranges < listing.files // 50:
        raise AssertionError(f"{ranges} ranges for {listing.files} files of one directory")
    return listing.entries.where(tf.is_file()).select(F.substring_index("uri", "/", -1).alias("name"), "len")


def read_tree_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of documents as a data source, with filters that the walk takes over."""
    root = inputs.document_tree(spark, sf_dir)
    found = []
    for condition, pushed in (
        ((F.col("file_type") == "directory") & (F.col("depth") <= 2), "LessThanOrEqual(depth,2)"),
        (F.col("uri").startswith(root + "/e") & (F.col("file_type") == "file") & (F.col("depth") > 2), "StringStartsWith(uri,"),
    ):
        found.append(tf.scan_tree(spark, root, condition))
        plan = spark._jvm.PythonSQLUtils.explainString(found[-1]._jdf.queryExecution(), "formatted")
        if pushed not in plan:
            raise AssertionError(f"{pushed} is not pushed into the walk:\n{plan}")
    return found[0].unionByName(found[1]).select(relative_to("uri", root).alias("path"), "len", "file_type", "depth")


def source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = inputs.document_tree(spark, sf_dir)
    manifest = tf.source_manifest(spark, root, DESTINATION_ROOT, num_tasks=4)
    return manifest.select(
        relative_to("source", root).alias("path"),
        "destination",
        "len",
        "file_type",
        F.array_join(F.transform("dependent_folders", lambda f: f["destination"]), " ").alias("dependent_folders"),
    )


def destination_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = inputs.document_tree(spark, sf_dir)
    manifest = tf.destination_manifest(spark, root)
    return manifest.select(relative_to("uri", root).alias("path"), "len", "file_type")


def create_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder per order date and priority below existing, missing and absent parents,
    and where files are."""
    root = inputs.new_root(spark, "directories")
    orders = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    path = F.concat(F.lit(root + "/"), F.col("o_orderstatus"), F.lit("/"), day)
    leaves = orders.select(path.alias("source")).distinct()
    folders = tf.directories_of(
        leaves.withColumn("file_type", F.lit("directory")), root, root.rpartition("/")[0]
    )
    orphans = orders.select(
        F.concat(F.lit(root + "/none/"), F.col("o_orderpriority")).alias("source")
    ).distinct().withColumn("destination", F.col("source"))
    blocked = orders.select(F.concat(F.lit(root + "/file "), F.col("o_orderpriority")).alias("uri")).distinct()
    inputs.write_files(blocked.withColumn("text", F.lit("in the way")))
    blocked = blocked.select(F.col("uri").alias("source"), F.col("uri").alias("destination"))
    report = tf.create_directories(folders.unionByName(orphans).unionByName(blocked))
    return report.select(relative_to("destination", root).alias("path"), "file_type", "outcome")


def delete_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete the labelled documents' files, each asked for twice, as many that never were,
    and the whole folders of source ``src0``, labelled documents in them too; then list."""
    root = inputs.new_root(spark, "deleted")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    inputs.write_documents(documents.select("doc_id", "lang", "source", "text"), root)
    labelled = documents.join(labels, "doc_id")
    there = labelled.select(inputs.document_uri(root).alias("uri"))
    absent = labelled.select(F.concat(inputs.document_uri(root), F.lit(".none")).alias("uri"))
    folders = documents.where("source = 'src0'").select(F.concat_ws("/", F.lit(root), "lang", "source").alias("uri"))
    report = tf.delete_paths(there.unionByName(there).unionByName(absent).unionByName(folders))
    left = tf.list_tree(spark, root).where(tf.is_file())
    return report.select(relative_to("destination", root).alias("path"), "outcome").unionByName(
        left.select(relative_to("uri", root).alias("path"), F.lit("left").alias("outcome"))
    )


def _copied_documents(spark: SparkSession, sf_dir: str, **options) -> tuple[str, DataFrame]:
    """Copy the tree of documents to where the good ones have an older copy."""
    source, root = inputs.document_tree(spark, sf_dir), inputs.new_root(spark, "copied")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = documents.join(labels.where(F.col("quality") == 1), "doc_id")
    tf.create_directories(
        spark.range(1).select(F.lit(source).alias("source"), F.lit(root + "/raw").alias("destination"))
    )
    older = good.select("doc_id", "lang", "source", F.concat(F.lit("older "), "text").alias("text"))
    inputs.write_documents(older, root + "/raw")
    return root, tf.copy_tree(spark, source, root, **options)


def copy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, report = _copied_documents(spark, sf_dir)
    return tf.copy_report(report).select(
        relative_to("destination", root).alias("path"), "file_type", "outcome", "bytes", "error"
    )


def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.report_summary(_copied_documents(spark, sf_dir, num_tasks=4)[1])


def copy_tree_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text from a copy that tasks made in ranges of 1,000 bytes."""
    root, report = _copied_documents(spark, sf_dir, on_error="fail", range_bytes=1000)
    return _texts_by_id(spark, root + "/raw", r"doc_(\d+)\.txt$").select("doc_id", "text")


def _texts_by_id(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``doc_id`` (the first group of ``pattern`` in the URI), ``uri``, ``text`` of the files,
    empty ones too. Tasks list them: Spark's readers would hold every name in the driver. Names
    that begin with a dot, such as temporary ones, are passed over."""
    files = tf.walk_tree(spark, root).entries.where(tf.is_file() & ~F.substring_index("uri", "/", -1).startswith("."))
    doc_id = F.regexp_extract("uri", pattern, 1).try_cast("bigint")
    return inputs.read_files(files).select(doc_id.alias("doc_id"), "uri", "text")


def _long_named(spark: SparkSession, sf_dir: str) -> str:
    """A directory with every document under a name of 255 bytes."""
    root = inputs.new_root(spark, "long") + "/names"
    inputs.make_directories(root)
    documents = table(spark, sf_dir, "documents")
    name = F.rpad(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("_")), 255, "x")
    inputs.write_files(documents.select(F.concat(F.lit(root + "/"), name).alias("uri"), "text"))
    return root


def _copied_both_ways(spark: SparkSession, source: str) -> DataFrame:
    """The files of ``source`` from a copy of whole files and from one in ranges."""
    found = []
    for kind, range_bytes in (("whole", 1 << 30), ("ranges", 1000)):
        root = inputs.new_root(spark, kind)
        tf.copy_tree(spark, source, root, on_error="fail", range_bytes=range_bytes, run_id="again")
        texts = _texts_by_id(spark, root, r"doc_(\d+)[^/]*$")
        found.append(texts.select("doc_id", F.lit(kind).alias("kind"), "text"))
    return found[0].unionByName(found[1])


def copy_long_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the longest legal name, whole and in ranges."""
    return _copied_both_ways(spark, _long_named(spark, sf_dir))


def _leftovers(entries: DataFrame, source: str, root: str, run_id: str) -> DataFrame:
    """``uri, text`` at both temporary names of each file: longer than the file by 11 to 20
    bytes, however long that is, so leftovers take disk by the size of the files."""
    temp = temp_uri(tf.map_destination("uri", source, root), run_id)
    text = F.expr("repeat('left over ', cast(len div 10 as int) + 2)")
    names = F.explode(F.array(temp, F.concat(temp, F.lit(".0"))))
    return entries.where(tf.is_file()).select(names.alias("uri"), text.alias("text"))


def copy_over_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, over longer leftovers at the names that first attempts take. Both copies
    are made in one place, where the first one's files, once they are read, get such names again
    and are written over as leftovers: disk never has the files of both, and need not be freed."""
    source, root, run_id = inputs.document_tree(spark, sf_dir), inputs.new_root(spark, "over"), "again"
    entries = tf.list_tree(spark, source)

    def copied(kind: str, range_bytes: int) -> DataFrame:
        folders = tf.to_source_manifest(entries.where(tf.is_directory()), source, root)
        tf.create_directories(folders)
        inputs.write_files(_leftovers(entries, source, root, run_id))
        tf.copy_tree(spark, source, root, on_error="fail", range_bytes=range_bytes, run_id=run_id)
        # Names of the other kind of copy stay; they have no doc_id.
        texts = _texts_by_id(spark, root, r"doc_(\d+)[^/]*$").where("doc_id IS NOT NULL")
        return texts.select("doc_id", F.lit(kind).alias("kind"), "text")

    whole = written(copied("whole", 1 << 30), "texts", compression="zstd")
    copies = entries.where(tf.is_file()).select(tf.map_destination("uri", source, root).alias("uri"))
    inputs.move_files(copies.withColumn("target", F.concat(temp_uri(F.col("uri"), run_id), F.lit(".0"))))
    return whole.unionByName(copied("ranges", 1000))


def copy_tree_excluding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the output of a job, next to marker files and folders. The source has it
    as one file of six names; the copies are files of their own."""
    root, target = inputs.new_root(spark, "marked") + "/out", inputs.new_root(spark, "unmarked")
    inputs.make_directories(root + "/_temporary/0")
    names = ("part-", "x_temporary-", "_SUCCESS-", "_committed_", "_started_", "_temporary/0/task-")
    documents = table(spark, sf_dir, "documents")
    uris = F.array(*(F.concat(F.lit(f"{root}/{name}"), "doc_id") for name in names))
    inputs.write_under_names(documents.select(uris.alias("uris"), "text"))
    tf.copy_tree(spark, root, target, on_error="fail", exclude=tf.EXCLUDE_PATTERNS)
    texts = _texts_by_id(spark, target, r"-(\d+)$")
    return texts.select("doc_id", F.regexp_extract("uri", r"([^/]+-)\d+$", 1).alias("name"), "text")


def copy_tree_with_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a link beside it; the links are reported, not followed."""
    source, root = inputs.new_root(spark, "linked") + "/raw", inputs.new_root(spark, "unlinked")
    inputs.make_directories(source)
    documents = table(spark, sf_dir, "documents")
    inputs.write_documents(documents, source)
    uri = inputs.document_uri(source)
    inputs.write_links(documents.select(F.concat(uri, F.lit(".link")).alias("uri"), F.substring_index(uri, "/", -1).alias("text")))
    report = tf.copy_tree(spark, source, root, on_error="fail")
    return report.select(relative_to("destination", root).alias("path"), "file_type", "outcome")


def copy_following_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, a link to it and one to nothing beside it, links to whole folders, and
    in each folder one that leads back."""
    source, root = inputs.new_root(spark, "linked") + "/raw", inputs.new_root(spark, "followed")
    inputs.make_directories(source)
    documents = table(spark, sf_dir, "documents")
    inputs.write_documents(documents, source)
    uri = inputs.document_uri(source)
    folders = documents.select("lang", "source").distinct()
    links = documents.select(F.inline(F.array(
        F.struct(F.concat(uri, F.lit(".link")).alias("uri"), F.substring_index(uri, "/", -1).alias("text")),
        F.struct(F.concat(uri, F.lit(".none")).alias("uri"), F.lit("nowhere").alias("text")),
    )))
    links = links.unionByName(folders.select(F.concat_ws("/", F.lit(source), "lang", "source", F.lit("up")).alias("uri"), F.lit("..").alias("text")))
    links = links.unionByName(folders.select(F.concat(F.lit(source + "/copy_"), "lang").alias("uri"), F.col("lang").alias("text")).distinct())
    inputs.write_links(links)
    report = tf.copy_tree(spark, source, root, on_error="fail", follow_links=True)
    return report.select(relative_to("destination", root).alias("path"), "file_type", "outcome")


def copy_byte_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under names and folders that are no UTF-8, read from the copy."""
    source, root = inputs.new_root(spark, "bytes") + "/raw", inputs.new_root(spark, "copied")
    byte = lambda value: F.lit(f"{MARK}{value:02x}")
    inputs.make_directories(source + f"/d{MARK}ff")
    documents = table(spark, sf_dir, "documents")
    name = F.concat(F.lit(f"{source}/d{MARK}ff/"), byte(0xC3), F.lit("ä"), byte(0x80), F.lit("_"), F.col("doc_id").cast("string"))
    inputs.write_files(documents.select(name.alias("uri"), "text"))
    tf.copy_tree(spark, source, root, on_error="fail", range_bytes=5000)
    files = tf.walk_tree(spark, root).entries.where(tf.is_file())
    return inputs.read_files(files).select(F.substring_index("uri", "_", -1).cast("bigint").alias("doc_id"), "text")


def execute_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's file by a plan that tells a wrong length for the bad ones, which
    fail; with the report the texts of the copies."""
    source, root = inputs.document_tree(spark, sf_dir), inputs.new_root(spark, "executed")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    wrong = F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0))
    files = documents.join(labels, "doc_id", "left").select(
        inputs.document_uri(source).alias("source"),
        F.concat(F.lit(root + "/doc_"), F.col("doc_id").cast("string")).alias("destination"),
        F.lit("file").alias("file_type"),
        (F.octet_length("text") + wrong).cast("bigint").alias("len"),
        F.lit("copy").alias("action"),
    )
    report = tf.execute_copy(files, 1 << 20)
    texts = _texts_by_id(spark, root, r"doc_(\d+)$").select("doc_id", "text")
    own_id = F.regexp_extract("destination", r"doc_(\d+)$", 1).cast("bigint")
    # Catalyst knows the size of the names, not of the texts, which are no table to broadcast.
    return report.select(own_id.alias("doc_id"), "outcome", "bytes").join(texts.hint("merge"), "doc_id", "left")


def _fated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the name of their file: toxic ones cannot be read to their end, bad ones
    change after they are listed."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fate = F.when(F.col("toxic") == 1, "broken").when(F.col("quality") == 0, "changed").otherwise("doc")
    named = documents.join(labels, "doc_id", "left").select("doc_id", "text", fate.alias("fate"))
    return named.withColumn("name", F.concat_ws("_", "fate", F.col("doc_id").cast("string")))


def _fated_tree(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    """A source folder of such files, an empty root, and the documents."""
    source, root = inputs.new_root(spark, "fated") + "/raw", inputs.new_root(spark, "failing")
    inputs.make_directories(source)
    documents = _fated(spark, sf_dir)
    inputs.write_files(documents.select(F.concat(F.lit(source + "/"), "name").alias("uri"), "text"))
    return source, root, documents


def copy_failing_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document over an older copy, in a store whose files appear when they are closed;
    reads that break and lengths that are wrong leave the older copy."""
    source, root, documents = _fated_tree(spark, sf_dir)
    inputs.make_directories(root + "/raw")
    older = F.concat(F.lit("older "), "text").alias("text")
    inputs.write_files(documents.select(F.concat(F.lit(root + "/raw/"), "name").alias("uri"), older))
    store = {"store": ObjectStandIn}
    report = tf.copy_tree(spark, source, root, source_options=store, destination_options=store)
    own_id = F.regexp_extract("destination", r"_(\d+)$", 1).try_cast("bigint")
    texts = _texts_by_id(spark, root, r"_(\d+)$").select("doc_id", "text")
    return report.where(tf.is_file()).select(own_id.alias("doc_id"), "outcome").join(texts, "doc_id", "full")


def recover_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a run left it that broke off: the toxic ones whole under a temporary
    name with nothing in their place, the bad ones half, the other labelled ones whole, both
    beside an older copy, and the rest not begun."""
    root, ledger, run_id = inputs.new_root(spark, "recovered"), inputs.new_root(spark, "ledger"), "broke-off"
    documents = _fated(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    target = F.concat(F.lit(root + "/"), "name")
    files = documents.select(
        F.concat(F.lit("file:///source/"), "name").alias("source"), target.alias("destination"), F.lit("file").alias("file_type"),
        F.octet_length("text").cast("bigint").alias("len"), F.lit("replace").alias("action"),
    )
    plan_batches(files, 1 << 20, run_id=run_id, ledger=Ledger.of(spark, ledger, run_id))
    begun = documents.where("quality IS NOT NULL")
    part = F.when(F.col("fate") == "changed", F.substring("text", 1, 3)).otherwise(F.col("text"))
    inputs.write_files(begun.select(F.concat(temp_uri(target, run_id), F.lit(".0")).alias("uri"), part.alias("text")))
    there = begun.where("fate <> 'broken'")
    inputs.write_files(there.select(target.alias("uri"), F.concat(F.lit("older "), "text").alias("text")))
    report = tf.recover_copies(spark, ledger, run_id)
    own_id = F.regexp_extract("destination", r"_(\d+)$", 1).try_cast("bigint")
    texts = _texts_by_id(spark, root, r"_(\d+)$").select("doc_id", "text")
    return report.select(own_id.alias("doc_id"), "outcome", "bytes").join(texts, "doc_id", "full")


def continue_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by a run that went on where one had failed: what was copied then has
    been marked meanwhile, and is not copied again."""
    source, root, documents = _fated_tree(spark, sf_dir)
    ledger = {"run_id": "goes-on", "ledger": inputs.new_root(spark, "ledger")}
    tf.copy_tree(spark, source, root, source_options={"store": ObjectStandIn}, **ledger)
    done = documents.where("fate = 'doc'")
    inputs.write_files(done.select(F.concat(F.lit(root + "/raw/"), "name").alias("uri"), F.translate("text", "aeiou", "AEIOU").alias("text")))
    report = tf.copy_tree(spark, source, root, source_options={"store": HealedStandIn}, on_error="fail", **ledger)
    own_id = F.regexp_extract("destination", r"_(\d+)$", 1).try_cast("bigint")
    texts = _texts_by_id(spark, root, r"_(\d+)$").select("doc_id", "text")
    return report.where(tf.is_file()).select(own_id.alias("doc_id"), "outcome", "bytes").join(texts, "doc_id", "full")


def digest_of(rows: DataFrame) -> DataFrame:
    """``rows`` counted, with an order-free ``digest`` over all their columns."""
    columns = [F.col(f"`{name}`") for name in rows.columns]
    own = F.xxhash64(*columns, *(column.isNull() for column in columns))
    return rows.agg(F.count("*").alias("rows"), F.sum(own.cast("decimal(20,0)")).alias("digest"))


def checked_rows(copied: DataFrame, source: DataFrame, each: str) -> DataFrame:
    """``table_name`` and ``rows`` of a copy; fails where its rows are not those of the source."""
    wanted = digest_of(source).select(F.col("rows").alias("own_rows"), F.col("digest").alias("own_digest"))
    same = (F.col("rows") == F.col("own_rows")) & F.col("digest").eqNullSafe(F.col("own_digest"))
    wrong = F.raise_error(F.lit(f"the copy of {each} has other rows")).cast("bigint")
    return digest_of(copied).crossJoin(wanted).select(F.lit(each).alias("table_name"), F.when(same, F.col("rows")).otherwise(wrong).alias("rows"))


def copy_tree_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy the folder of all tables; rows of each, read from the copy and held against the source."""
    root = inputs.new_root(spark, "tables")
    tf.copy_tree(spark, sf_dir, root, on_error="fail")
    name = sf_dir.rstrip("/").rpartition("/")[2]
    counts = [
        checked_rows(spark.read.parquet(f"{root}/{name}/{each}.parquet"), spark.read.parquet(f"{sf_dir}/{each}.parquet"), each)
        for each in TABLES
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def _readback(each: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table's file as the root of a copy; all its rows, read from the copy."""
    root = inputs.new_root(spark, each)
    tf.copy_tree(spark, f"{sf_dir}/{each}.parquet", root, on_error="fail")
    copied = spark.read.parquet(f"{root}/{each}.parquet")
    if each == "embeddings":
        copied = copied.select("vec_id", "label", F.posexplode("embedding").alias("position", "value"))
        copied = copied.withColumn("value", F.col("value").cast("double"))
    return copied


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        qualify_path,
        map_destination,
        uri_is_child,
        classify_file_type,
        ancestor_dependencies,
        dependent_copies,
        exclude_paths,
        compare_manifests,
        compare_kept_manifests,
        copy_plan,
        expand_copies,
        expand_folder_ids,
        distinct_copies,
        directories_of,
        verify_lengths,
        manifest_summary,
        batch_index,
        batch_partition_offsets,
        assign_batch_partition,
        balance_by_bytes,
        route_batches,
        list_tree,
        list_flat_directory,
        read_tree_source,
        source_manifest,
        destination_manifest,
        create_directories,
        delete_paths,
        copy_report,
        report_summary,
        copy_tree_in_ranges,
        copy_long_names,
        copy_over_leftovers,
        copy_tree_excluding,
        copy_tree_with_links,
        copy_following_links,
        copy_byte_names,
        execute_copy,
        copy_failing_replacements,
        recover_copies,
        continue_copy,
        copy_tree_readback,
    )
} | {f"copy_tree_readback_{each}": partial(_readback, each) for each in TABLES}
