"""The stages that change a filesystem. Each runs once and leaves a report table."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from treeferry.functions.paths import DIRECTORY, FILE, depth_of, folder_of
from treeferry.operators.balance import balance_by_bytes, spread_over_tasks
from treeferry.operators.ledger import DoneWriter, Ledger, attempts_of, finish_or_undo
from treeferry.operators.reporting import REPORT_SCHEMA
from treeferry.scratch import new_folder, read_table, written
from treeferry.session import speculates
from treeferry.sources.listing import ENTRY, PENDING, walk_below
from treeferry.storage import Stores, copy_bytes, split_parent

BUFFER_BYTES = 8 << 20
# Weight of a file besides its bytes, so that many small files share the work too.
FILE_COST_BYTES = 1 << 20
# Larger files are copied in ranges by several tasks, where the target can be written so.
RANGE_BYTES = 1 << 30
TEMP_PREFIX = ".treeferry-"
# Directories or deletions per task, and files where their bytes are few.
CALLS_PER_TASK = 256

# The copy stage also says which file a range belongs to; whole files leave these null.
STAGE_SCHEMA = REPORT_SCHEMA + ", file_len bigint, action string"


class CopyFailed(RuntimeError):
    """Some entries were not copied; ``report`` is the full report."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


class Task:
    """What the rows of one task share: stores, the attempt's id, which attempt at the task
    it is, and whether another one may run at the same time."""

    def __init__(self, attempt: int, number: int = 0, speculative: bool = False, options: dict | None = None):
        self.at = Stores(options).at
        self.attempt = attempt
        self.number = number
        self.speculative = speculative

    def own_name(self, temp: str) -> str:
        """The name of this attempt's temporary file. A lost attempt that is still writing
        has another, so it cannot spoil this one's."""
        return f"{temp}.{self.number}"

    def remove_leftovers(self, store, temp: str) -> None:
        """Remove what earlier attempts at this task left, by their names."""
        for number in range(0 if self.speculative else self.number):
            name = f"{temp}.{number}"
            if store.status(name):
                store.remove_file(name)


Act = Callable[[Task, dict], dict]


def _report_task(
    act: Act, schema: pa.Schema, speculative: bool, options: dict | None, done_folder: str | None = None
) -> Callable[[Iterator], Iterator]:
    """A task that calls ``act`` for each row and yields the report rows it returns. What it
    has put in place goes to the ledger's ``done_folder`` meanwhile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task = Task(context.taskAttemptId(), context.attemptNumber(), speculative, options)
        done = DoneWriter(task.at, done_folder) if done_folder else None

        def report_row(row: dict) -> dict:
            base = {
                "source": row.get("source"),
                "destination": row["destination"],
                "file_type": row.get("file_type"),
                "temp_path": row.get("temp_path"),
                "task_attempt_id": task.attempt,
            }
            if row.get("range_start") is not None:
                base |= {"file_len": row["file_len"], "action": row["action"]}
            try:
                result = base | act(task, row)
            except Exception as error:
                return base | {"outcome": "failed", "error": f"{type(error).__name__}: {error}"}
            if done and result["outcome"] in ("copied", "replaced", "finished"):
                done.add({"source": row["source"], "destination": row["destination"], "len": row["file_len"], "outcome": _outcome(row), "bytes": result["bytes"]})
            return result

        for batch in batches:
            rows = [report_row(row) for row in batch.to_pylist()]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if done:
            done.flush()

    return run


def _run_once(
    todo: DataFrame, act: Act, path: str, schema: str, options: dict | None = None, done_folder: str | None = None
) -> DataFrame:
    """Act on every row of ``todo`` in one job and read the report that it wrote, so
    that further actions on the report do not act on the filesystem again."""
    spark = todo.sparkSession
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    todo.mapInArrow(_report_task(act, arrow, speculates(spark), options, done_folder), schema).write.parquet(path)
    return read_table(spark, path, schema)


def _make_directory(task: Task, row: dict) -> dict:
    store, path = task.at(row["destination"])
    if found := store.status(path):
        if found[0] != DIRECTORY:
            raise NotADirectoryError(f"{path} is a {found[0]}")
        return {"outcome": "dir_exists"}
    parent = split_parent(path)[0]
    if not store.status(parent):
        raise FileNotFoundError(f"parent {parent} does not exist")
    try:
        store.make_directory(path)
    except FileExistsError:
        return {"outcome": "dir_exists"}
    return {"outcome": "dir_created"}


def _level_groups(levels: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Levels (depth, directories) that run as one job: a large one alone, small ones
    together while one task can do them."""
    groups: list[list[tuple[int, int]]] = []
    for level in levels:
        if groups and sum(count for _, count in groups[-1]) + level[1] <= CALLS_PER_TASK:
            groups[-1].append(level)
        else:
            groups.append([level])
    return groups


def create_directories(directories: DataFrame, options: dict | None = None) -> DataFrame:
    """Create the directories of ``source, destination``, parents before children, and
    report on each. A directory fails whose parent is missing, or where a file is."""
    depth = depth_of("destination").alias("depth")
    return create_levels(written(directories.select("source", "destination", depth), "directories"), options)


def create_levels(directories: DataFrame, options: dict | None = None) -> DataFrame:
    """``create_directories`` for a written table with ``depth``: one job per depth, over
    that depth's directories only; depths with few directories share a job of one task
    that goes through them in order."""
    spark = directories.sparkSession
    todo = directories.select("source", "destination", F.lit(DIRECTORY).alias("file_type"), "depth")
    return _by_levels(todo, _make_directory, options) or spark.createDataFrame([], REPORT_SCHEMA)


def _by_levels(todo: DataFrame, act: Act, options: dict | None, deepest_first: bool = False) -> DataFrame | None:
    """Act on rows with ``depth``, one depth after the other; None without any row."""
    spark = todo.sparkSession
    levels = sorted((tuple(level) for level in todo.groupBy("depth").count().collect()), reverse=deepest_first)
    report = new_folder(spark, "directories-report")
    for group in _level_groups(levels):
        depths = [depth for depth, _ in group]
        tasks = -(-sum(count for _, count in group) // CALLS_PER_TASK)
        some = todo.where(F.col("depth").between(min(depths), max(depths))).repartition(tasks)
        order = F.desc("depth") if deepest_first else F.asc("depth")
        _run_once(some.sortWithinPartitions(order), act, f"{report}/depth={depths[0]}", REPORT_SCHEMA, options)
    return read_table(spark, report, REPORT_SCHEMA) if levels else None


def _look(task: Task, row: dict) -> dict:
    store, path = task.at(row["destination"])
    if store.is_link(path):
        return {"outcome": FILE}
    found = store.status(path)
    return {"outcome": "absent" if not found else DIRECTORY if found[0] == DIRECTORY else FILE}


def _remove(of_store: str) -> Act:
    def act(task: Task, row: dict) -> dict:
        store, path = task.at(row["destination"])
        with contextlib.suppress(FileNotFoundError):  # a lost attempt at this task was faster
            getattr(store, of_store)(path)
        return {"outcome": "deleted"}

    return act


def _above(uri: str) -> Column:
    """The URIs of the directories above a URI, without the root's."""
    parts = F.split(uri, "/")
    some = F.transform(F.sequence(F.lit(4), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(F.size(parts) > 4, some).otherwise(F.array().cast("array<string>"))


def _outermost(uris: DataFrame) -> DataFrame:
    """The distinct URIs that are not below another one of them."""
    distinct = uris.select("uri").distinct()
    chain = distinct.select("uri", F.explode(_above("uri")).alias("above"))
    nested = chain.join(distinct.select(F.col("uri").alias("above")), "above", "left_semi")
    return distinct.join(nested.select("uri").distinct(), "uri", "left_anti")


def delete_paths(uris: DataFrame, options: dict | None = None) -> DataFrame:
    """Delete the files and whole directories of ``uri`` and report on each. A path that
    does not exist is no error. A URI that repeats, or is below another one, has no row of
    its own: the outer one's stands for it.

    A directory that could not be deleted tells the deepest error below it.

    Trees are listed first, their files deleted in batches that share the work, and their
    directories by depth, the deepest first; links are deleted and not followed.
    """
    spark = uris.sparkSession
    asked = written(_outermost(uris).select(F.col("uri").alias("destination")), "deletions")

    def in_batches(rows: DataFrame, act: Act, name: str) -> DataFrame:
        tasks = max(1, -(-rows.count() // CALLS_PER_TASK))
        return _run_once(rows.repartition(tasks), act, new_folder(spark, name), REPORT_SCHEMA, options)

    seen = in_batches(asked, _look, "delete-look")
    trees = seen.where(F.col("outcome") == DIRECTORY).select(F.col("destination").alias("uri"))
    below = walk_below(spark, trees, options).rows.where(F.col("kind") != PENDING)
    is_folder = (F.col("kind") == ENTRY) & (F.col("file_type") == DIRECTORY)
    unread = (F.col("kind") != ENTRY) & (F.col("file_type") == DIRECTORY)  # its removal will tell
    leaves = below.where(~is_folder & ~unread).select(F.col("uri").alias("destination"))
    files = in_batches(seen.where(F.col("outcome") == FILE).select("destination").unionByName(leaves), _remove("remove_file"), "delete-files")

    folders = trees.unionByName(below.where(is_folder).select("uri")).select(F.col("uri").alias("destination"), depth_of("uri").alias("depth"))
    report = files.unionByName(seen.where(F.col("outcome").isin("absent", "failed")))
    emptied = _by_levels(written(folders, "folders"), _remove("remove_directory"), options, deepest_first=True)
    if emptied is not None:
        report = report.unionByName(emptied)
    # Kept: listing, deleting and looking are done, and their errors are few.
    report = written(report.select(*StructType.fromDDL(REPORT_SCHEMA).names), "deletion-report")
    unlisted = below.where(unread).select(F.col("uri").alias("destination"), "error")
    failed = report.where(F.col("outcome") == "failed").select("destination", "error")
    inner = failed.unionByName(unlisted).select(F.explode(_above("destination")).alias("above"), F.struct((-depth_of("destination")).alias("minus"), "destination", "error").alias("inner"))
    first = inner.groupBy(F.col("above").alias("destination")).agg(F.min("inner").alias("inner"))
    own = report.join(asked, "destination", "left_semi").join(first, "destination", "left")
    told = F.concat("error", F.lit("; below it "), F.col("inner.destination"), F.lit(": "), F.col("inner.error"))
    return own.withColumn("error", F.coalesce(told, "error")).select(*StructType.fromDDL(REPORT_SCHEMA).names)


def _checked(store, path: str, expected: int, did: str = "wrote") -> None:
    found = store.status(path)
    if not found or found[1] != expected:
        raise OSError(f"{did} {found and found[1]} bytes, but the source was listed with {expected}")


def _outcome(row: dict) -> str:
    return "replaced" if row["action"] == "replace" else "copied"


def _copy_directly(task: Task, row: dict, buffer_bytes: int) -> dict:
    """Write a file under its own name at once. A read that fails half-way leaves a part in the
    place of what was there."""
    source_store, source_path = task.at(row["source"])
    store, path = task.at(row["destination"])
    _checked(source_store, source_path, row["len"], "has")
    with source_store.open_input(source_path) as reader, store.open_fresh(path) as writer:
        count = copy_bytes(reader, writer, buffer_bytes)
    _checked(store, path, row["len"])
    return {"outcome": _outcome(row), "bytes": count, "temp_path": None}


def _copy_file(task: Task, row: dict, buffer_bytes: int, direct_writes: bool = False) -> dict:
    """Copy one whole file through a temporary name in the destination's directory. What was
    there is replaced once the new file has the length that was listed, not before."""
    source_store, source_path = task.at(row["source"])
    store, path = task.at(row["destination"])
    if store.largest_move is not None and row["len"] > store.largest_move:
        if not direct_writes:
            raise OSError(f"{row['len']} bytes are more than {store.largest_move}, the most that can be moved into place there")
        return _copy_directly(task, row, buffer_bytes)
    task.remove_leftovers(store, task.at(row["temp_path"])[1])
    temp_path = task.own_name(row["temp_path"])
    _, temp = task.at(temp_path)
    unfinished = False
    try:
        with source_store.open_input(source_path) as reader, store.open_fresh(temp) as writer:
            unfinished = True
            count = copy_bytes(reader, writer, buffer_bytes)
        _checked(store, temp, row["len"])
        store.rename(temp, path, replace=True)
        unfinished = False
    finally:
        if unfinished and store.status(temp):
            store.remove_file(temp)
    return {"outcome": _outcome(row), "bytes": count, "temp_path": temp_path}


def _copy_range(task: Task, row: dict, buffer_bytes: int) -> dict:
    """Copy one range of a large file into the temporary file that its ranges share."""
    source_store, source_path = task.at(row["source"])
    store, temp = task.at(row["temp_path"])
    found = source_store.status(source_path)
    if not found or found[1] != row["file_len"]:
        raise OSError(f"the source has {found and found[1]} bytes, but was listed with {row['file_len']}")
    start = row["range_start"]
    with source_store.open_input(source_path, start) as reader, store.open_range(temp, start) as writer:
        count = copy_bytes(reader, writer, buffer_bytes, limit=row["len"])
    return {"outcome": "range", "bytes": count}


def _copy_part(buffer_bytes: int, direct_writes: bool = False) -> Act:
    def act(task: Task, row: dict) -> dict:
        if row["file_type"] != FILE:
            raise ValueError(f"{row['source']} is neither a file nor a directory")
        if row["action"] == "conflict":
            raise IsADirectoryError(f"{row['destination']} is a directory")
        if row["range_start"] is None:
            return _copy_file(task, row, buffer_bytes, direct_writes)
        return _copy_range(task, row, buffer_bytes)

    return act


def _finish_ranges(task: Task, row: dict) -> dict:
    """Put a file in place whose ranges are all written, or remove what there is."""
    store, path = task.at(row["destination"])
    _, temp = task.at(row["temp_path"])
    try:
        if row["range_error"] or row["bytes"] != row["file_len"]:
            raise OSError(row["range_error"] or f"wrote {row['bytes']} of {row['file_len']} bytes")
        found = store.status(temp)
        another = task.number or task.speculative
        if found or not another or store.status(path) != (FILE, row["file_len"]):  # else an earlier attempt got this far
            if found and found[1] > row["file_len"]:  # of a longer file, left by an earlier run
                store.truncate(temp, row["file_len"])
            _checked(store, temp, row["file_len"])
            store.rename(temp, path, replace=True)
    except Exception:
        if store.status(temp):
            store.remove_file(temp)
        raise
    return {"outcome": _outcome(row), "bytes": row["bytes"]}


def temp_uri(destination: Column, run_id: str) -> Column:
    """The temporary name of a destination in a run: beside it, and of one length whatever
    the file's own name, so every legal name can be copied."""
    return F.concat(folder_of(destination), F.lit(TEMP_PREFIX), F.md5(F.concat(F.lit(run_id + "\n"), destination).cast("binary")))


def _in_ranges(files: DataFrame, range_bytes: int, run_id: str) -> DataFrame:
    """One row per range of the files above ``range_bytes``, where the destination can
    be written in ranges; all other files stay one row, with no ``range_start``."""
    splits = (F.col("file_type") == FILE) & (F.col("action") != "conflict")
    large = splits & (F.col("len") > range_bytes) & F.col("destination").startswith("file://")
    size = F.lit(range_bytes).cast("bigint")
    starts = F.when(large, F.sequence(F.lit(0).cast("bigint"), F.col("len") - 1, size)).otherwise(
        F.array(F.lit(None).cast("bigint"))
    )
    return (
        files.withColumn("range_start", F.explode(starts))
        .withColumn("file_len", F.col("len"))
        .withColumn("temp_path", temp_uri(F.col("destination"), run_id))
        .withColumn("len", F.when(large, F.least(size, F.col("len") - F.col("range_start"))).otherwise(F.col("len")))
    )


@dataclass(frozen=True)
class Batches:
    """Written copy work: rows with ``partition, batch``, how many files are cut into
    ranges, and how many batches there are if they are all in one partition."""

    rows: DataFrame
    cut_files: int
    only_batches: int | None


def plan_batches(
    files: DataFrame,
    bytes_per_task: int,
    rows: int | None = None,
    range_bytes: int = RANGE_BYTES,
    run_id: str | None = None,
    ledger: Ledger | None = None,
    file_cost: int = FILE_COST_BYTES,
) -> Batches:
    """Cut the files of a plan (``source, destination, file_type, len, action``) into
    batches of about ``bytes_per_task``, so that neither many small files nor a few
    large ones end up together; each weighs ``file_cost`` besides. Files above ``range_bytes`` are cut into ranges first.
    ``rows`` is the number of files and ranges, if known. ``run_id`` marks the temporary names; a
    run with that of an earlier one takes over what that left. A ``ledger`` keeps the batches
    as what is meant to be done."""
    seen = Observation()
    parts = _in_ranges(
        files.select("source", "destination", "file_type", "len", "action"), range_bytes, run_id or uuid.uuid4().hex
    )
    cost = F.col("len") + file_cost
    balanced = balance_by_bytes(parts, bytes_per_task, rows, cost, order=("destination", "range_start"))
    counts = (F.count_if(F.col("range_start") == 0), F.max("partition"), F.max("batch"))
    names = ("cut_files", "last_partition", "last_batch")
    batches = written(balanced.observe(seen, *(c.alias(n) for c, n in zip(counts, names))), "batches", ledger and ledger.new_intents())
    cut_files, last_partition, last_batch = (seen.get[name] for name in names)
    only_batches = None if last_partition else (last_batch or 0) + 1
    return Batches(batches, cut_files, only_batches)


def copy_batches(
    batches: Batches,
    num_tasks: int | None = None,
    buffer_bytes: int = BUFFER_BYTES,
    options: dict | None = None,
    direct_writes: bool = False,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Copy written batches, one task each, and report on every file. With ``num_tasks``
    the batches are dealt to that many tasks. A ``ledger`` hears of each finished copy."""
    spark = batches.rows.sparkSession
    done = ledger and ledger.done_folder
    routed, _ = spread_over_tasks(batches.rows, num_tasks, batches.only_batches)
    stage = _run_once(routed, _copy_part(buffer_bytes, direct_writes), new_folder(spark, "copy-stage"), STAGE_SCHEMA, options, done)
    columns = StructType.fromDDL(REPORT_SCHEMA).names
    if not batches.cut_files:
        return stage.select(columns)

    cut_files = stage.where(F.col("file_len").isNotNull()).groupBy(
        "source", "destination", "file_type", "temp_path", "file_len", "action"
    )
    to_finish = cut_files.agg(F.sum("bytes").alias("bytes"), F.max("error").alias("range_error"))
    # An explicit count: adaptive execution would merge these few bytes, and so all renames.
    to_finish = to_finish.repartition(-(-batches.cut_files // CALLS_PER_TASK))
    finished = _run_once(to_finish, _finish_ranges, new_folder(spark, "ranges-report"), REPORT_SCHEMA, options, done)
    return stage.where(F.col("file_len").isNull()).select(columns).unionByName(finished)


def execute_copy(
    files: DataFrame,
    bytes_per_task: int,
    *,
    rows: int | None = None,
    num_tasks: int | None = None,
    range_bytes: int = RANGE_BYTES,
    buffer_bytes: int = BUFFER_BYTES,
    run_id: str | None = None,
    options: dict | None = None,
    direct_writes: bool = False,
    ledger: str | None = None,
) -> DataFrame:
    """Copy the files of a plan, each once, and report on each. Their directories have
    to exist. ``action`` says what is expected in a file's place: nothing (``copy``), a file
    (``replace``), or what forbids the copy (``conflict``). ``ledger`` is a folder that keeps
    what the run means to do and has done, for ``recover_copies``. However few bytes a task
    may have, small files share one: up to 256 of them."""
    kept = Ledger.of(files.sparkSession, ledger, run_id or "", options) if ledger else None
    once = files.select("source", "destination", "file_type", "len", "action").distinct()
    file_cost = min(FILE_COST_BYTES, max(1, bytes_per_task // CALLS_PER_TASK))
    batches = plan_batches(once, bytes_per_task, rows, range_bytes, run_id, kept, file_cost)
    return copy_batches(batches, num_tasks, buffer_bytes, options, direct_writes, kept)


def recover(spark: SparkSession, ledger: Ledger) -> DataFrame | None:
    """``recover_copies`` for an opened ledger; None where nothing was meant to be done."""
    if not ledger.has_intents():
        return None
    done = ledger.done(spark).select("destination", F.col("len").alias("file_len"))
    parts = ledger.intents(spark).where(F.col("file_type") == FILE)
    each = parts.groupBy("source", "destination", "file_type", "action", "file_len", "temp_path").agg(F.min("range_start").alias("range_start"))
    todo = written(each.join(done, ["destination", "file_len"], "left_anti"), "intents")
    tasks = max(1, -(-todo.count() // CALLS_PER_TASK))
    act = finish_or_undo(attempts_of(spark))
    return _run_once(todo.repartition(tasks), act, new_folder(spark, "recovery"), REPORT_SCHEMA, ledger.options, ledger.done_folder)


def recover_copies(spark: SparkSession, ledger: str, run_id: str, options: dict | None = None) -> DataFrame:
    """Finish or undo what a run that broke off left between temporary files and their places,
    and report on each file that it meant to copy and is not known to have finished:
    ``finished`` (the whole file waited and nothing was in its place, where a store deletes
    before it renames), ``undone`` (temporary files are removed, the place is as it was),
    ``untouched``, or ``failed``. No run with that id may be at work."""
    found = recover(spark, Ledger.of(spark, ledger, run_id, options))
    return spark.createDataFrame([], REPORT_SCHEMA) if found is None else found
