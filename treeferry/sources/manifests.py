"""Source and destination manifests: listings in the shape that plans join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeferry.functions.paths import ancestor_dependencies, dependent_copies, map_destination
from treeferry.session import qualified
from treeferry.sources.listing import walk_root, walk_tree


def to_source_manifest(entries: DataFrame, source_root: str, destination_root: str) -> DataFrame:
    """Map a listing of ``source_root``: ``source, destination, len, file_type``, and
    ``depth`` if the listing has it."""
    return entries.select(
        F.col("uri").alias("source"),
        map_destination("uri", source_root, destination_root).alias("destination"),
        "len",
        "file_type",
        *({"depth"} & set(entries.columns)),
    )


def with_dependencies(rows: DataFrame, source_root: str, destination_root: str) -> DataFrame:
    """Add ``dependent_folders``, the copies of each row's ancestors, root first. They
    follow from the row's own URI, so add them after joins: nothing has to carry them."""
    ancestors = ancestor_dependencies("source", source_root)
    return rows.withColumn("dependent_folders", dependent_copies(ancestors, source_root, destination_root))


def to_destination_manifest(entries: DataFrame) -> DataFrame:
    return entries.select("uri", "len", "file_type")


def source_manifest(
    spark: SparkSession, source: str, destination: str, num_tasks: int | None = None
) -> DataFrame:
    """List ``source`` and map every entry to its place below ``destination``: ``source,
    destination, len, file_type, depth, dependent_folders``."""
    source_root, destination_root = qualified(spark, source, destination)
    listing = walk_root(spark, source_root, num_tasks)
    manifest = to_source_manifest(listing.entries, source_root, destination_root)
    return with_dependencies(manifest, source_root, destination_root)


def destination_manifest(
    spark: SparkSession, destination: str, num_tasks: int | None = None
) -> DataFrame:
    """List ``destination``: ``uri, len, file_type``, without ancestors."""
    return to_destination_manifest(walk_tree(spark, destination, num_tasks).entries)
