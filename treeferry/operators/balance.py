"""Batches of similar size, and the task that each batch goes to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeferry.scratch import written
from treeferry.session import spread_by

ROWS_PER_BUCKET = 100_000
# Partitions are INT: 2**31 of them end in region 127 of 2**24 each.
LAST_REGION = 127


def batch_index(batches: DataFrame) -> DataFrame:
    """The highest batch of each partition: ``partition, max_batch``."""
    return batches.groupBy("partition").agg(F.max("batch").alias("max_batch"))


def batch_partition_offsets(index: DataFrame) -> DataFrame:
    """Where each partition's batches start when all batches are numbered through:
    ``partition, max_batch, first_task``.

    A sum over all earlier partitions in three steps, none of which one task does alone:
    inside ranges of 65,536 partitions, over 256 such ranges, and over what is left, of
    which there are 256 at most, so their totals are handed on to all later ones.
    """
    keyed = index.select("*", F.shiftright(F.col("partition").cast("int"), 16).alias("range"))
    keyed = keyed.withColumn("region", F.shiftright("range", 8))
    size = F.sum((F.col("max_batch") + 1).cast("bigint"))

    def earlier(name: str, order: str, value: Column) -> Column:
        return F.coalesce(value.over(Window.partitionBy(name).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    ranges = keyed.groupBy("region", "range").agg(size.alias("total"))
    before_range = ranges.select(F.col("range"), earlier("region", "range", F.sum("total")).alias("in_region"))
    regions = ranges.groupBy("region").agg(F.sum("total").alias("total"))
    later = regions.where(F.col("region") < LAST_REGION).select(F.explode(F.sequence(F.col("region") + 1, F.lit(LAST_REGION))).alias("region"), "total")
    before_region = later.groupBy("region").agg(F.sum("total").alias("before"))
    inside = keyed.withColumn("in_range", earlier("range", "partition", size))
    placed = inside.join(before_range, "range").join(before_region, "region", "left")
    first = F.col("in_range") + F.col("in_region") + F.coalesce("before", F.lit(0))
    return placed.select(*index.columns, first.cast("int").alias("first_task"))


def task_count(offsets: DataFrame) -> int:
    """The number of tasks that an index makes: one row comes to the driver."""
    total = offsets.agg(F.max(F.col("first_task") + F.col("max_batch") + 1).alias("tasks")).first()
    return int(total["tasks"] or 0)


def assign_batch_partition(copies: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add ``task`` to rows with ``partition, batch``: the partition's offset plus the
    batch, wrapped around where it is beyond the index. A partition that the index
    lacks is an error.

    Pass ``offsets`` as a written table: its real size then decides whether Catalyst
    broadcasts it, and the rows to route are not shuffled for this join.
    """
    known = offsets.select(F.col("partition").alias("known_partition"), "max_batch", "first_task")
    joined = copies.join(known, copies["partition"] == known["known_partition"], "left")
    message = F.concat(F.lit("no index for partition "), F.col("partition").cast("string"))
    task = F.when(
        F.col("known_partition").isNotNull(),
        F.col("first_task") + F.col("batch") % (F.col("max_batch") + 1),
    ).otherwise(F.raise_error(message).cast("int"))
    return joined.withColumn("task", task.cast("int")).drop("known_partition", "max_batch", "first_task")


def route_batches(assigned: DataFrame, tasks: int) -> DataFrame:
    """Send each row to the task it names. The count is explicit, so adaptive
    execution neither merges nor splits these tasks."""
    return assigned.repartitionById(max(tasks, 1), "task")


def bucket_of(key: Column, buckets: int) -> Column:
    """An even spread of distinct keys over buckets that other engines compute alike."""
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def balance_by_bytes(
    copies: DataFrame,
    bytes_per_task: int,
    rows: int | None = None,
    cost: Column | None = None,
    order: tuple[str, ...] = ("destination",),
    least_buckets: int = 1,
) -> DataFrame:
    """Add ``partition, batch`` so that each batch holds about ``bytes_per_task``. Rows
    are distinct in ``order``, as they are in a plan.

    Rows are spread over buckets by hash; inside a bucket a running sum of bytes is
    cut at every multiple of ``bytes_per_task``. The number of buckets grows with
    ``rows`` (counted if not given), so no bucket grows with the data. A batch exceeds
    its share by less than its last row. ``cost`` (default ``len``) is a row's weight.
    """
    rows = copies.count() if rows is None else rows
    buckets = max(least_buckets, -(-rows // ROWS_PER_BUCKET))
    weight = F.col("len") if cost is None else cost
    ordered = Window.partitionBy("partition").orderBy(*order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_batch = F.when(F.col("cut") > F.lag("cut").over(ordered), 1).otherwise(0)
    bucketed = copies.withColumn("partition", bucket_of(F.concat_ws("\n", *order), buckets))
    return (
        spread_by(bucketed, "partition", rows)
        .withColumn("cut", F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
        .withColumn("cut", F.expr(f"cut div {int(bytes_per_task)}"))
        # Numbered without gaps: a row of several shares leaves no empty batches behind it.
        .withColumn("next", next_batch)
        .withColumn("batch", F.sum("next").over(so_far).cast("int"))
        .drop("cut", "next")
    )


def spread_over_tasks(
    batches: DataFrame, num_tasks: int | None = None, only_batches: int | None = None
) -> tuple[DataFrame, int]:
    """Number written batches through and route every row to its batch's task; with
    ``num_tasks``, the batches are dealt to that many tasks. ``only_batches`` is the
    number of batches where all are in one partition: their numbers serve as they are."""
    if only_batches is not None:
        tasks, assigned = only_batches, batches.withColumn("task", F.col("batch"))
    else:
        offsets = written(batch_partition_offsets(written(batch_index(batches), "index")), "offsets")
        tasks, assigned = task_count(offsets), assign_batch_partition(batches, offsets)
    if num_tasks and num_tasks < tasks:
        tasks, assigned = num_tasks, assigned.withColumn("task", F.col("task") % num_tasks)
    return route_batches(assigned, tasks), tasks
