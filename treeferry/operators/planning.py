"""Plans: manifests compared and joined, and what a plan depends on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeferry.functions.paths import (
    DIRECTORY,
    ancestor_dependencies,
    below,
    folder_of,
    is_directory,
    map_destination,
)


def compare_manifests(source: DataFrame, destination: DataFrame) -> DataFrame:
    """Full outer comparison of two manifests on where each entry goes or is.

    ``status`` is ``source_only``, ``both`` or ``destination_only``. Manifests hold a
    URI once, so no join key repeats; only flat columns are shuffled.
    """
    left = source.select("source", "destination", "len", "file_type")
    right = destination.select(
        F.col("uri").alias("dest_uri"),
        F.col("len").alias("dest_len"),
        F.col("file_type").alias("dest_type"),
    )
    joined = left.join(right, left["destination"] == right["dest_uri"], "full")
    return joined.select(
        "source",
        F.coalesce("destination", "dest_uri").alias("destination"),
        F.coalesce("file_type", "dest_type").alias("file_type"),
        "len",
        "dest_len",
        "dest_type",
        F.when(F.col("dest_uri").isNull(), "source_only")
        .when(F.col("source").isNull(), "destination_only")
        .otherwise("both")
        .alias("status"),
    )


def copy_plan(source: DataFrame, destination: DataFrame) -> DataFrame:
    """What to do for every source entry: ``source, destination, len, file_type,
    dest_len, dest_type, action``.

    A directory where a file must go, or the reverse, is a ``conflict``: nothing is done
    there. Every source entry stays: an existing file is replaced whatever its length, and
    nothing at the destination is removed. Catalyst turns the full outer comparison
    and the filter into a left outer join.
    """
    kept = compare_manifests(source, destination).where(F.col("source").isNotNull())
    present = F.col("status") == "both"
    conflict = present & ((F.col("dest_type") == DIRECTORY) != is_directory())
    return kept.select(
        "source",
        "destination",
        "len",
        "file_type",
        "dest_len",
        "dest_type",
        F.when(conflict, "conflict")
        .when(is_directory(), F.when(present, "keep").otherwise("create"))
        .otherwise(F.when(present, "replace").otherwise("copy"))
        .alias("action"),
    )


def expand_copies(plan: DataFrame) -> DataFrame:
    """Each row's ``dependent_folders``, root first, and then the row itself: ``source,
    destination, file_type, len, position``."""
    folders = F.transform(
        "dependent_folders",
        lambda folder: F.struct(
            folder["source"].alias("source"),
            folder["destination"].alias("destination"),
            F.lit(DIRECTORY).alias("file_type"),
            F.lit(0).cast("bigint").alias("len"),
        ),
    )
    itself = F.array(F.struct("source", "destination", "file_type", "len"))
    expanded = plan.select(F.posexplode(F.concat(folders, itself)).alias("position", "copy"))
    return expanded.select("copy.*", "position")


def distinct_copies(copies: DataFrame) -> DataFrame:
    """Each copy once over the whole plan, however many rows depend on it. Repeats
    collapse before the shuffle, so a folder shared by most rows stays small."""
    return copies.select("source", "destination", "file_type", "len").distinct()


def directories_of(plan: DataFrame, source_root: str, destination_root: str) -> DataFrame:
    """Every directory that a plan needs, ``source, destination``: its own directory
    rows and the ancestors of all rows.

    Same rows as the directories of ``distinct_copies(expand_copies(plan))``, without
    expanding every file: the direct parents are made distinct first, and only those
    few are expanded to their ancestors.
    """
    source, prefix = F.col("source"), below(source_root)
    folder = (
        F.when(source == source_root, F.lit(prefix))
        .when(is_directory(), F.concat(source, F.lit("/")))
        .otherwise(folder_of(source))
    )
    folders = plan.where(is_directory() | (source != source_root)).select(folder.alias("folder")).distinct()
    without_slash = F.substr("folder", F.lit(1), F.length("folder") - 1)
    leaves = folders.select(F.when(F.col("folder") == prefix, F.lit(source_root)).otherwise(without_slash).alias("uri"))
    ancestors = F.transform(ancestor_dependencies("uri", source_root), lambda a: a["uri"])
    chain = leaves.select(F.explode(F.concat(ancestors, F.array("uri"))).alias("source"))
    return chain.distinct().select(
        "source", map_destination("source", source_root, destination_root).alias("destination")
    )


def verify_lengths(source: DataFrame, destination: DataFrame) -> DataFrame:
    """The files present on both sides with their lengths and whether these agree.
    Directories are dropped before the join, and ancestors are not part of it."""
    left = source.where(~is_directory()).select("source", "destination", "len")
    right = destination.where(~is_directory()).select(
        F.col("uri").alias("destination"), F.col("len").alias("dest_len")
    )
    joined = left.join(right, "destination")
    return joined.withColumn("same_length", F.col("len") == F.col("dest_len"))
