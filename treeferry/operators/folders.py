"""The folders of a plan as a dictionary: rows name their folder by a number.

A row's ancestors as an array take bytes by the depth of the tree. Here each folder is one
row of its number, its parent's number and its own name, and a plan's row has the number of
its folder and its own name. Paths and ancestors come back by doubling: in each round every
folder learns from the folder that it points to and then points twice as far, so a tree of
depth d takes about log2(d) joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeferry.functions.paths import DIRECTORY, below, folder_of, map_destination
from treeferry.operators.planning import directories_of
from treeferry.scratch import written


def _parent(uri: Column | str, root: str) -> Column:
    """The URI of an entry's folder; null for the root."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    folder, prefix = folder_of(uri), below(root)
    inner = F.substr(folder, F.lit(1), F.length(folder) - 1)
    return F.when(uri == root, F.lit(None)).when(folder == prefix, F.lit(root)).otherwise(inner)


def _name(uri: Column | str, root: str) -> Column:
    uri = F.col(uri) if isinstance(uri, str) else uri
    return F.when(uri == root, F.lit("")).otherwise(F.substring_index(uri, "/", -1))


def _numbered(plan: DataFrame, source_root: str, destination_root: str) -> DataFrame:
    """``folder_id, uri`` of every directory that a plan needs, written."""
    folders = directories_of(plan, source_root, destination_root).select(F.col("source").alias("uri"))
    return written(folders.select(F.monotonically_increasing_id().alias("folder_id"), "uri"), "folders")


def folder_dictionary(plan: DataFrame, source_root: str, destination_root: str) -> tuple[DataFrame, DataFrame]:
    """(folders, rows) of a plan or manifest with ``source, file_type, len``; runs jobs.

    ``folders``: ``folder_id, parent_id, name``, the root with no parent and an empty name.
    ``rows``: ``folder_id, name, file_type, len`` for each row, the root's without a folder;
    rows that repeat are kept. Both take the same bytes a row at any depth. A plan of one
    file, its own root, has no folders; an empty one has neither.
    """
    numbered = _numbered(plan, source_root, destination_root)
    parents = numbered.select(F.col("folder_id").alias("parent_id"), F.col("uri").alias("parent_uri"))
    own = numbered.withColumn("parent_uri", _parent("uri", source_root))
    folders = own.join(parents, "parent_uri", "left").select("folder_id", "parent_id", _name("uri", source_root).alias("name"))
    entries = plan.select(_parent("source", source_root).alias("uri"), _name("source", source_root).alias("name"), "file_type", "len")
    rows = entries.join(numbered, "uri", "left").select("folder_id", "name", "file_type", "len")
    return written(folders, "folder-names"), written(rows, "plan-rows")


def _joined(upper: Column, lower: Column) -> Column:
    return F.when(upper == "", lower).when(lower == "", upper).otherwise(F.concat(upper, F.lit("/"), lower))


def folder_paths(folders: DataFrame) -> DataFrame:
    """``folder_id, path`` (below the root, empty for it) and ``depth`` (0 for the root)."""
    known = folders.select("folder_id", F.col("parent_id").alias("up"), F.col("name").alias("path"), F.col("parent_id").isNotNull().cast("int").alias("depth"))
    while not known.where("up IS NOT NULL").isEmpty():
        above = known.select(F.col("folder_id").alias("up"), F.col("up").alias("next"), F.col("path").alias("upper"), F.col("depth").alias("more"))
        known = written(
            known.join(above, "up", "left").select(
                "folder_id",
                F.col("next").alias("up"),
                _joined(F.coalesce("upper", F.lit("")), F.col("path")).alias("path"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "folder-paths",
        )
    return known.select("folder_id", "path", "depth")


def folder_ancestors(folders: DataFrame) -> DataFrame:
    """``folder_id, ancestor_id`` for each folder and every folder that it is in, itself too."""
    known = folders.select("folder_id", F.col("folder_id").alias("ancestor_id"))
    jumps = folders.where("parent_id IS NOT NULL").select("folder_id", F.col("parent_id").alias("up"))
    while not jumps.isEmpty():
        # What is less than 2^k above the folder 2^k above is 2^k to 2^(k+1) above this one.
        farther = jumps.join(known.withColumnRenamed("folder_id", "up"), "up").select("folder_id", "ancestor_id")
        known = written(known.unionByName(farther), "ancestors")
        twice = jumps.join(jumps.select(F.col("folder_id").alias("up"), F.col("up").alias("next")), "up")
        jumps = written(twice.select("folder_id", F.col("next").alias("up")), "jumps")
    return known


def expand_folder_ids(rows: DataFrame, folders: DataFrame, source_root: str, destination_root: str) -> DataFrame:
    """The rows of ``expand_copies`` from a dictionary: ``source, destination, file_type, len,
    position``. Runs jobs over the folders, none over the rows."""
    paths = folder_paths(folders)
    uri = lambda path: F.when(path == "", F.lit(source_root)).otherwise(F.concat(F.lit(below(source_root)), path))
    entry = lambda source, *others: (source.alias("source"), map_destination(source, source_root, destination_root).alias("destination"), *others)

    placed = rows.join(paths, "folder_id", "left")
    whole = uri(_joined(F.coalesce("path", F.lit("")), F.col("name")))
    itself = placed.select(*entry(whole, "file_type", "len", F.coalesce(F.col("depth") + 1, F.lit(0)).alias("position")))

    # A folder's rows are counted first, so the ancestors are joined by folders, not by rows.
    counts = rows.where("folder_id IS NOT NULL").groupBy("folder_id").agg(F.count(F.lit(1)).alias("n"))
    needed = counts.join(folder_ancestors(folders), "folder_id").groupBy("ancestor_id").agg(F.sum("n").alias("n"))
    dependents = needed.join(paths.withColumnRenamed("folder_id", "ancestor_id"), "ancestor_id")
    # A hot folder's repeats are dealt before they are written out, in runs of 4,096 at most.
    runs = dependents.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / 4096)))).repartition("ancestor_id", "run")
    repeats = runs.select("path", "depth", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(4096), F.col("n") - F.col("run") * 4096).cast("int"))))
    above = repeats.select(*entry(uri(F.col("path")), F.lit(DIRECTORY).alias("file_type"), F.lit(0).cast("bigint").alias("len"), F.col("depth").alias("position")))
    return itself.unionByName(above)
