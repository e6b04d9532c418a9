"""The whole job: list both trees, plan, make directories, copy, report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeferry.functions.paths import FILE, below, destination_of_root, is_directory, is_file, map_destination
from treeferry.operators.copying import (
    BUFFER_BYTES,
    FILE_COST_BYTES,
    RANGE_BYTES,
    Batches,
    CopyFailed,
    copy_batches,
    create_levels,
    plan_batches,
    recover,
)
from treeferry.operators.ledger import Ledger
from treeferry.operators.planning import copy_plan
from treeferry.scratch import written
from treeferry.session import qualified, side_by_side, speculates, spread_by
from treeferry.sources.listing import TreeListing, walk_root
from treeferry.sources.manifests import to_destination_manifest, to_source_manifest
from treeferry.storage import Stores, make_directories, root_of

# A task costs some tenths of a second besides its work, so small copies get few tasks.
TASKS_PER_CORE = 2
LEAST_BYTES_PER_TASK = 64 << 20
MOST_BYTES_PER_TASK = 4 << 30


def copy_tree(
    spark: SparkSession,
    source: str,
    destination: str,
    num_tasks: int | None = None,
    on_error: str = "collect",
    *,
    listing_tasks: int | None = None,
    create_destination: bool = False,
    exclude: Iterable[str] = (),
    range_bytes: int = RANGE_BYTES,
    buffer_bytes: int = BUFFER_BYTES,
    run_id: str | None = None,
    source_options: dict[str, str] | None = None,
    destination_options: dict[str, str] | None = None,
    direct_writes: bool = False,
    ledger: str | None = None,
    follow_links: bool = False,
) -> DataFrame:
    """Copy the tree at ``source`` below ``destination``, under the source's own name,
    and return the report: one row per file and directory.

    Every source file is copied, and replaces what is there; nothing else at the
    destination changes. Both roots must exist, unless ``create_destination`` is set.
    ``num_tasks`` bounds the copy tasks (default: by bytes and cores), ``listing_tasks``
    is the least for listing. ``on_error='fail'`` raises ``CopyFailed`` at the end if an
    entry failed, ``'collect'`` only reports it. ``exclude`` holds full-match patterns
    (Python syntax) of source URIs to leave out; a directory that matches is left out with
    everything below it. Symbolic links are reported as ``skipped``, or with ``follow_links``
    copied as what they lead to, unless that is nothing or a directory that they are in.
    ``source_options`` and ``destination_options`` are settings of the two filesystems,
    such as an endpoint or a user, as ``pyarrow.fs`` takes them in a URI. A run with the
    ``run_id`` of one that broke off takes over its temporary files.

    A file is replaced once its copy is whole under another name; a failure leaves the old one.
    Where a file is too large for the store to move (5 GiB on S3) its row fails.
    ``direct_writes`` writes such a file under its own name at once: if that breaks off, what
    was there is lost.

    ``ledger`` is a folder that keeps, for the ``run_id``, what the run means to do and each
    finished copy. A run with the id of one that broke off goes on: it finishes or undoes what
    was left (``recover_copies``) and copies what is not finished or has changed since. Its
    report covers all; what was finished before has its outcome of then and no task.
    """
    if on_error not in ("collect", "fail"):
        raise ValueError("on_error must be 'collect' or 'fail'")
    source_root, destination_root = qualified(spark, source, destination)
    options = {root_of(source_root): source_options or {}}
    options[root_of(destination_root)] = options.get(root_of(destination_root), {}) | (destination_options or {})
    _check_roots(spark, source_root, destination_root, options)
    kept = Ledger.of(spark, ledger, run_id or "", options) if ledger else None
    if create_destination:
        make_directories(destination_root, options)
    _check_exists(destination_root, options)

    if kept:
        recover(spark, kept)
    # Only entries below the copied root's own place can be replaced, whatever else the
    # destination holds.
    target_root = destination_of_root(source_root, destination_root)
    listing, present = side_by_side(
        spark,
        lambda: walk_root(spark, source_root, listing_tasks, exclude=tuple(exclude), options=options, follow_links=follow_links),
        lambda: walk_root(spark, target_root, listing_tasks, must_exist=False, options=options),
    )
    manifest = to_source_manifest(listing.entries, source_root, destination_root)

    finished: list[DataFrame] = []

    def planned() -> Batches | None:
        if not listing.files:
            return None
        weight = listing.bytes + listing.files * FILE_COST_BYTES
        share = bytes_per_task(weight, num_tasks, spark.sparkContext.defaultParallelism)
        # Without anything to compare with there is no join, and no shuffle to prepare for.
        keyed = spread_by(manifest, "destination", listing.files) if present.exists else manifest
        plan = copy_plan(keyed, to_destination_manifest(present.entries)).where(is_file())
        if kept:
            plan = written(_marked_done(plan, kept.done(spark)), "plan")
            finished.append(_finished(plan))
            plan = plan.where("NOT done")
        # Files and at most so many ranges: the plan has a row for each.
        rows = listing.files + listing.bytes // range_bytes
        return plan_batches(plan, share, rows, range_bytes, run_id, kept)

    def made() -> DataFrame:
        # Each level scans this table; in a large listing the directories are a small part.
        return create_levels(written(manifest.where(is_directory()), "directories"), options)

    directories, batches = side_by_side(spark, made, planned)
    report = directories
    if listing.failures:
        report = report.unionByName(_listing_failures(listing, source_root, destination_root))
    if listing.links:
        report = report.unionByName(_skipped_links(listing, source_root, destination_root))
    if present.failures:
        report = report.unionByName(_destination_failures(present))
    for rows in finished:
        report = report.unionByName(rows)
    if batches:
        report = report.unionByName(copy_batches(batches, num_tasks, buffer_bytes, options, direct_writes, kept))

    if on_error == "fail":
        failed = report.where(F.col("outcome") == "failed")
        first = F.min(F.struct("destination", "error"))
        count, example = failed.agg(F.count("*"), first).first()
        if count:
            raise CopyFailed(f"{count} entries were not copied, such as {example[0]}: {example[1]}", report)
    return report


def bytes_per_task(weight: int, num_tasks: int | None, cores: int) -> int:
    """Bytes for one copy task: the asked-for share, or several tasks for each core."""
    if num_tasks:
        return max(1, -(-weight // num_tasks))
    share = -(-weight // (cores * TASKS_PER_CORE))
    return min(max(share, LEAST_BYTES_PER_TASK), MOST_BYTES_PER_TASK)


def _marked_done(plan: DataFrame, done: DataFrame) -> DataFrame:
    """The plan with ``done``: whether the ledger has the copy, of the length that the source
    has now, and it is still there."""
    before = done.withColumnsRenamed({"outcome": "was", "bytes": "was_bytes"})
    there = (F.col("dest_type") == FILE) & (F.col("dest_len") == F.col("len"))
    joined = plan.join(before, ["source", "destination", "len"], "left")
    return joined.withColumn("done", F.coalesce(F.col("was").isNotNull() & there, F.lit(False)))


def _finished(plan: DataFrame) -> DataFrame:
    return plan.where("done").select(
        "source",
        "destination",
        "file_type",
        F.col("was").alias("outcome"),
        F.col("was_bytes").alias("bytes"),
        F.lit(None).cast("string").alias("temp_path"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("bigint").alias("task_attempt_id"),
    )


def _check_roots(spark: SparkSession, source_root: str, destination_root: str, options: dict) -> None:
    if source_root in (destination_root, destination_of_root(source_root, destination_root)):
        raise ValueError(f"{source_root} would be copied onto itself")
    if destination_root.startswith(below(source_root)):
        raise ValueError(f"{destination_root} is inside {source_root}, which would be copied into itself")
    if speculates(spark) and not Stores(options).at(destination_root)[0].replaces_atomically:
        raise ValueError("set spark.speculation=false: two attempts at one file could remove each other's copy")


def _check_exists(uri: str, options: dict) -> None:
    store, path = Stores(options).at(uri)
    if store.status(path) is None:
        raise FileNotFoundError(f"{uri} does not exist")


def _failures(errors: DataFrame, source: Column, destination: Column, outcome: str = "failed") -> DataFrame:
    return errors.select(
        source.cast("string").alias("source"),
        destination.alias("destination"),
        "file_type",
        F.lit(outcome).alias("outcome"),
        F.lit(None).cast("bigint").alias("bytes"),
        F.lit(None).cast("string").alias("temp_path"),
        "error",
        F.lit(None).cast("bigint").alias("task_attempt_id"),
    )


def _listing_failures(listing: TreeListing, source_root: str, destination_root: str) -> DataFrame:
    """What the source listing could not read, as failed report rows."""
    target = map_destination("uri", source_root, destination_root)
    return _failures(listing.errors, F.col("uri"), target)


def _skipped_links(listing: TreeListing, source_root: str, destination_root: str) -> DataFrame:
    target = map_destination("uri", source_root, destination_root)
    return _failures(listing.skipped, F.col("uri"), target, "skipped")


def _destination_failures(listing: TreeListing) -> DataFrame:
    return _failures(listing.errors, F.lit(None), F.col("uri"))
