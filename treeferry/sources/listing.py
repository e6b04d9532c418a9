"""Recursive tree listing as rounds of Spark tasks over the directories still to read."""

from __future__ import annotations

import random
import re
import time
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from treeferry.functions.paths import DIRECTORY, FILE, ancestor_dependencies
from treeferry.scratch import new_folder, read_table
from treeferry.session import qualified
from treeferry.storage import Stores, escaped_name, within

# How long a task reads directories before it leaves the rest to the next round. The
# first round has one task, so it ends early.
FIRST_ROUND_SECONDS = 1.0
ROUND_SECONDS = 20.0
DIRECTORIES_PER_TASK = 1024
ROWS_PER_BATCH = 10_000
# A directory with more entries is read in ranges of names, of about as many each, by several
# tasks; their bounds are taken from a sample of the names, with their bytes that are not UTF-8
# marked, so that any names can be told apart.
ENTRIES_PER_RANGE = 50_000
SAMPLED_NAMES = 1 << 14
# A task reads a directory once for all ranges of it that the task has: so many names are sampled
# then, and so many small ranges weigh as much as one of ``ENTRIES_PER_RANGE``, at most.
SAMPLED_IN_RANGES = 1 << 16
SMALL_RANGES = 64

# ``kind``: an entry of the tree, one that cannot be copied or read, a symbolic link, or a
# directory left for the next round.
ENTRY, FAILED, SKIPPED, PENDING = "entry", "failed", "skipped", "pending"
LINK = "link"
WALK_SCHEMA = "kind string, uri string, len bigint, file_type string, depth int, error string, low string, high string"
FRONTIER = ("uri", "depth", "low", "high")


def _ranges(names: Iterable[str], low: str | None, high: str | None, share: int) -> list[tuple[str | None, str | None]]:
    """Ranges of about ``share`` of the ``names`` each, together ``low`` to ``high``. Names pass
    one by one; a sample of them is kept."""
    chance, sample, seen = random.Random(0), [], 0
    for name in names:
        if not within(name, low, high):
            continue
        seen += 1
        if len(sample) < SAMPLED_NAMES:
            sample.append(name)
        elif (at := chance.randrange(seen)) < SAMPLED_NAMES:
            sample[at] = name
    return _edges(sample, seen, low, high, share)


def _is_text(name: str) -> bool:
    return name.isascii() or not any("\ud800" <= c <= "\udfff" for c in name)


def _edges(sample: Iterable[str], seen: int, low: str | None, high: str | None, share: int) -> list[tuple[str | None, str | None]]:
    """``low`` to ``high`` cut into ranges of about ``share`` of ``seen`` names, by a sample. Names
    and bounds are as a table holds them; a name that none can hold is no bound."""
    sample = sorted(name for name in sample if _is_text(name))
    parts = max(2, -(-seen * 5 // (share * 4)))  # some less, as a range that turns out too large takes a round more
    bounds = sorted({sample[len(sample) * k // parts] for k in range(1, parts)} - set(sample[:1])) if sample else []
    edges = [low, *bounds, high]
    return list(zip(edges, edges[1:]))


class _Places:
    """Ranges of names, none of which overlap, by the names in them."""

    def __init__(self, bounds: Iterable[tuple[str | None, str | None]]):
        self.bounds = sorted(bounds, key=lambda bound: bound[0] or "")
        self.lows = [low or "" for low, _ in self.bounds]

    def of(self, name: str) -> int | None:
        """The number of the range that holds the name."""
        at = bisect_right(self.lows, name) - 1
        return at if at >= 0 and within(name, *self.bounds[at]) else None


def _split_ranges(names: Iterable[str], bounds: Iterable[tuple[str | None, str | None]], share: int) -> tuple[list, list]:
    """The ranges to read now, and smaller ones in place of those with more than ``share`` of the
    ``names``. Names pass once for all ranges; a bounded sample of them is kept."""
    places, chance = _Places(bounds), random.Random(0)
    most = max(2, SAMPLED_IN_RANGES // len(places.bounds))
    seen, samples = [0] * len(places.bounds), [[] for _ in places.bounds]
    for name in names:
        if (place := places.of(name)) is None:
            continue
        seen[place] += 1
        sample = samples[place]
        if len(sample) < most:
            sample.append(name)
        elif (at := chance.randrange(seen[place])) < most:
            sample[at] = name
    read, parts = [], []
    for bound, count, sample in zip(places.bounds, seen, samples):
        edges = _edges(sample, count, *bound, share) if count > share else [bound]
        (parts if len(edges) > 1 else read).extend(edges)
    return read, parts


def any_of(patterns: Iterable[str]) -> str | None:
    """One pattern for all, or None for none."""
    return "|".join(f"(?:{pattern})" for pattern in patterns) or None


def _walk(
    seconds: float, exclude: str | None = None, options: dict[str, dict[str, str]] | None = None, share: int = ENTRIES_PER_RANGE, follow_links: bool = False
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that reads its directories, then what it finds below them, breadth
    first. Directories beyond its share, or its time, go to the next round, and so do ranges of
    names of a directory with more than ``share`` entries. What matches ``exclude`` makes no
    row, and a directory that does is not read. Followed links are listed as what they lead
    to; those that lead to nothing, or back to where they are, stay links."""
    schema = pa.schema(
        [
            ("kind", pa.string()),
            ("uri", pa.string()),
            ("len", pa.int64()),
            ("file_type", pa.string()),
            ("depth", pa.int32()),
            ("error", pa.string()),
            ("low", pa.string()),
            ("high", pa.string()),
        ]
    )
    whole = (None, None)

    def rows_of(stores: Stores, uri: str, depth: int, bounds: list[tuple], found: deque) -> Iterator[tuple]:
        prefix = uri.removesuffix("/") + "/"
        try:
            store, path = stores.at(uri)
            if whole not in bounds:
                read, parts = _split_ranges(map(escaped_name, store.names(path)), bounds, share)
                for bound in parts:
                    yield PENDING, uri, None, DIRECTORY, depth, None, *bound
                if not read:
                    return
                places = _Places(read)
                entries = store.scan(path, lambda name: places.of(escaped_name(name)) is not None)
            else:
                entries = store.scan(path)
                if store.splits_directories:
                    few = list(islice(entries, share + 1))
                    if len(few) > share and len(ranges := _ranges(map(escaped_name, store.names(path)), None, None, share)) > 1:
                        for bound in ranges:
                            yield PENDING, uri, None, DIRECTORY, depth, None, *bound
                        return
                    entries = chain(few, entries)
            for name, kind, length in entries:
                own, name, problem = name, escaped_name(name), None
                if exclude and re.fullmatch(exclude, prefix + name):
                    continue
                if kind == LINK and follow_links:
                    try:
                        kind, length = store.follow(f"{path.rstrip('/')}/{own}") or (LINK, 0)
                    except OSError as error:
                        yield SKIPPED, prefix + name, None, kind, depth + 1, str(error), *whole
                        continue
                if kind == LINK:
                    yield SKIPPED, prefix + name, None, kind, depth + 1, None, *whole
                    continue
                if kind not in (FILE, DIRECTORY):
                    problem = "neither a file nor a directory"
                    yield FAILED, prefix + name, None, kind, depth + 1, problem, *whole
                    continue
                yield ENTRY, prefix + name, length, kind, depth + 1, None, *whole
                if kind == DIRECTORY and len(found) < DIRECTORIES_PER_TASK:
                    found.append((prefix + name, depth + 1, [whole]))
                elif kind == DIRECTORY:
                    yield PENDING, prefix + name, None, kind, depth + 1, None, *whole
        except Exception as error:
            yield FAILED, uri, None, DIRECTORY, depth, f"{type(error).__name__}: {error}", *whole

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found_rows() -> Iterator[tuple]:
            stores, todo, until, done = Stores(options), deque(), time.monotonic() + seconds, 0
            ranges: dict[tuple[str, int], list[tuple]] = {}
            for batch in batches:
                for uri, depth, *bound in zip(*(batch.column(name).to_pylist() for name in FRONTIER)):
                    if tuple(bound) == whole:
                        todo.append((uri, depth, [whole]))
                    else:
                        ranges.setdefault((uri, depth), []).append(tuple(bound))
            todo.extend((*directory, bounds) for directory, bounds in ranges.items())
            while todo and (done == 0 or (done < DIRECTORIES_PER_TASK and time.monotonic() < until)):
                yield from rows_of(stores, *todo.popleft(), todo)
                done += 1
            for uri, depth, bounds in todo:
                for bound in bounds:
                    yield PENDING, uri, None, DIRECTORY, depth, None, *bound

        rows = found_rows()
        while part := list(islice(rows, ROWS_PER_BATCH)):
            yield batch_of(part)

    return walk


@dataclass(frozen=True)
class TreeListing:
    """A written listing: its entries, and the places that could not be read. The
    numbers were counted on the way; a repeated task may count twice."""

    root: str
    rows: DataFrame
    files: int = 0
    bytes: int = 0
    failures: int = 0
    links: int = 0
    exists: bool = True

    @property
    def entries(self) -> DataFrame:
        """``uri, len, file_type, depth``, one row per file and directory."""
        return self.rows.where(F.col("kind") == ENTRY).select("uri", "len", "file_type", "depth")

    @property
    def errors(self) -> DataFrame:
        """``uri, file_type, error`` of what is missing from ``entries``."""
        return self.rows.where(F.col("kind") == FAILED).select("uri", "file_type", "error")

    @property
    def skipped(self) -> DataFrame:
        """``uri, file_type, error`` of symbolic links, which are not followed."""
        return self.rows.where(F.col("kind") == SKIPPED).select("uri", "file_type", "error")

    def ancestors(self) -> Column:
        return ancestor_dependencies("uri", self.root)


def walk_tree(
    spark: SparkSession,
    uri: str,
    num_tasks: int | None = None,
    exclude: Iterable[str] = (),
    entries_per_range: int = ENTRIES_PER_RANGE,
    follow_links: bool = False,
) -> TreeListing:
    """List everything at and below ``uri``: files and directories, hidden and empty
    ones too; symbolic links are listed apart and not followed, or with ``follow_links``
    listed as what they lead to, unless that is nothing or a directory that they are in. A missing root is an error
    before any job. ``exclude`` holds full-match patterns (Python syntax) of URIs to leave
    out; a directory that matches is left out with everything below it. The root stays.

    Each round is one job over the directories not read yet, and over ranges of names of those
    with very many entries, so one huge directory is read by many tasks. It ends with a table in
    the shared folder, so a lost executor repeats single tasks, and the next round
    spreads the open directories evenly over its tasks. ``num_tasks`` is the least
    number of tasks for a round that has as many directories.
    """
    return walk_root(spark, qualified(spark, uri)[0], num_tasks, exclude=exclude, entries_per_range=entries_per_range, follow_links=follow_links)


def walk_root(
    spark: SparkSession,
    root: str,
    num_tasks: int | None = None,
    must_exist: bool = True,
    exclude: Iterable[str] = (),
    options: dict[str, dict[str, str]] | None = None,
    entries_per_range: int = ENTRIES_PER_RANGE,
    follow_links: bool = False,
) -> TreeListing:
    """``walk_tree`` for a root that is spelled as in the tables; if it need not
    exist, a missing one has no entries."""
    store, path = Stores(options).at(root)
    found = store.status(path)
    if found is None and must_exist:
        raise FileNotFoundError(f"{root} does not exist")
    kind, length = found or (DIRECTORY, 0)
    if kind not in (FILE, DIRECTORY):
        raise ValueError(f"{root} is neither a file nor a directory")

    columns = dict(kind=ENTRY, uri=root, len=length, file_type=kind, depth=0, error=None, low=None, high=None)
    seed = spark.range(0, 1, 1, 1).select(
        [F.lit(columns[field.name]).cast(field.dataType).alias(field.name) for field in StructType.fromDDL(WALK_SCHEMA)]
    )
    if found is None:
        return TreeListing(root, seed.where(F.lit(False)), exists=False)  # known to be empty when planning
    if kind == FILE:
        return TreeListing(root, seed, 1, length)

    return _walk_rounds(spark, root, seed, num_tasks, any_of(exclude), options, entries_per_range=entries_per_range, follow_links=follow_links)


def walk_below(
    spark: SparkSession, directories: DataFrame, options: dict[str, dict[str, str]] | None = None
) -> TreeListing:
    """Everything below the directories ``uri``, none of which is below another, without
    themselves. They are read by as many tasks as there are rows for."""
    none = F.lit(None).cast("string")
    frontier = directories.select("uri", F.lit(0).alias("depth"), none.alias("low"), none.alias("high"))
    return _walk_rounds(spark, "", None, None, None, options, frontier)


def _walk_rounds(
    spark: SparkSession,
    root: str,
    seed: DataFrame | None,
    num_tasks: int | None,
    exclude: str | None,
    options: dict[str, dict[str, str]] | None,
    frontier: DataFrame | None = None,
    entries_per_range: int = ENTRIES_PER_RANGE,
    follow_links: bool = False,
) -> TreeListing:
    table = new_folder(spark, "listing")
    number, counts = 0, Counter()
    least_tasks = num_tasks or spark.sparkContext.defaultParallelism
    tasks = 1
    if frontier is None:
        frontier = seed.select(*FRONTIER)
    else:
        tasks = max(1, min(frontier.count(), least_tasks))
        frontier = frontier.repartition(tasks)
    while tasks:
        seconds = ROUND_SECONDS if number else FIRST_ROUND_SECONDS
        rows = frontier.mapInArrow(_walk(seconds, exclude, options, entries_per_range, follow_links), WALK_SCHEMA)
        if number == 0 and seed is not None:
            rows = seed.unionByName(rows)
        seen = Observation()
        is_file = (F.col("kind") == ENTRY) & (F.col("file_type") == FILE)
        rows = rows.observe(
            seen,
            F.count_if(F.col("kind") == PENDING).alias("pending"),
            F.count_if((F.col("kind") == PENDING) & (F.col("low").isNotNull() | F.col("high").isNotNull())).alias("ranges"),
            F.count_if(F.col("kind") == FAILED).alias("failures"),
            F.count_if(F.col("kind") == SKIPPED).alias("links"),
            F.count_if(is_file).alias("files"),
            F.coalesce(F.sum(F.when(is_file, F.col("len"))), F.lit(0)).alias("bytes"),
        )
        rows.write.parquet(f"{table}/round={number}")
        counts.update({name: count for name, count in seen.get.items() if name not in ("pending", "ranges")})
        pending, ranges = seen.get["pending"], seen.get["ranges"]
        frontier = (
            read_table(spark, f"{table}/round={number}", WALK_SCHEMA)
            .where(F.col("kind") == PENDING)
            .select(*FRONTIER)
        )
        # Each task that has ranges of a directory reads all its names, so small ranges share one.
        weight = pending - ranges + ranges * max(min(1, entries_per_range / ENTRIES_PER_RANGE), 1 / SMALL_RANGES)
        tasks = min(pending, max(least_tasks, ceil(weight / DIRECTORIES_PER_TASK)))
        if tasks:
            frontier = frontier.repartition(tasks)
        number += 1
    return TreeListing(root, read_table(spark, table, WALK_SCHEMA), **counts)


def list_tree(spark: SparkSession, uri: str, num_tasks: int | None = None) -> DataFrame:
    """The tree at ``uri`` as a manifest: ``uri, len, file_type, depth, ancestors``."""
    listing = walk_tree(spark, uri, num_tasks)
    return listing.entries.withColumn("ancestors", listing.ancestors())
