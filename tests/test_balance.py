import pytest
from pyspark.sql import functions as F

import treeferry as tf
from treeferry.operators import balance
from treeferry.operators.balance import spread_over_tasks, task_count
from treeferry.scratch import written


def index_of(spark, pairs):
    return spark.createDataFrame(pairs, "partition int, max_batch int")


def test_index_and_offsets(spark):
    batches = spark.createDataFrame([(5, 0), (0, 2), (0, 1), (5, 0), (2, 3)], "partition int, batch int")
    index = tf.batch_index(batches)
    assert {tuple(r) for r in index.collect()} == {(0, 2), (2, 3), (5, 0)}
    offsets = tf.batch_partition_offsets(index)
    assert {tuple(r) for r in offsets.collect()} == {(0, 2, 0), (2, 3, 3), (5, 0, 7)}
    assert task_count(offsets) == 8
    assert task_count(tf.batch_partition_offsets(index_of(spark, []))) == 0


def test_every_batch_has_its_own_task(spark):
    offsets = tf.batch_partition_offsets(index_of(spark, [(0, 2), (2, 3), (5, 0)]))
    keys = spark.createDataFrame(
        [(p, b) for p, m in [(0, 2), (2, 3), (5, 0)] for b in range(m + 1)], "partition int, batch int"
    )
    assert sorted(r["task"] for r in tf.assign_batch_partition(keys, offsets).collect()) == list(range(8))


def test_batches_beyond_the_index_wrap_around(spark):
    offsets = tf.batch_partition_offsets(index_of(spark, [(1, 1), (2, 2)]))
    keys = spark.createDataFrame([(2, 3), (2, 7), (1, 4)], "partition int, batch int")
    tasks = {(r["partition"], r["batch"]): r["task"] for r in tf.assign_batch_partition(keys, offsets).collect()}
    assert tasks == {(2, 3): 2, (2, 7): 3, (1, 4): 0}


def test_unknown_partition_is_an_error(spark):
    offsets = tf.batch_partition_offsets(index_of(spark, [(1, 1)]))
    keys = spark.createDataFrame([(3, 0)], "partition int, batch int")
    with pytest.raises(Exception, match="no index for partition 3"):
        tf.assign_batch_partition(keys, offsets).collect()


def test_rows_land_in_their_task(spark):
    rows = spark.range(200).select((F.col("id") % 11).cast("int").alias("task"), "id")
    landed = tf.route_batches(rows, 11).select("task", F.spark_partition_id().alias("at"))
    assert landed.where("task <> at").count() == 0


def files(spark, lengths):
    return spark.createDataFrame([(f"hdfs://h/f{i:05d}", n) for i, n in enumerate(lengths)], "destination string, len bigint")


def test_batches_hold_about_their_share(spark, monkeypatch):
    monkeypatch.setattr(balance, "ROWS_PER_BUCKET", 50)
    lengths = [(i * 37) % 91 for i in range(400)]
    batches = tf.balance_by_bytes(files(spark, lengths), 500)
    sums = batches.groupBy("partition", "batch").agg(F.sum("len").alias("bytes")).collect()
    assert {r["partition"] for r in sums} == set(range(8))
    assert max(r["bytes"] for r in sums) < 500 + 91
    assert sum(r["bytes"] for r in sums) == sum(lengths)
    for partition in range(8):
        numbers = sorted(r["batch"] for r in sums if r["partition"] == partition)
        assert numbers == list(range(len(numbers)))


def test_a_third_of_all_bytes_in_one_row_leaves_no_gaps(spark):
    batches = tf.balance_by_bytes(files(spark, [10] * 50 + [250] + [10] * 0), 25).collect()
    numbers = {r["batch"] for r in batches}
    assert numbers == set(range(len(numbers)))


def test_cost_spreads_empty_files(spark):
    batches = tf.balance_by_bytes(files(spark, [0] * 100), 10, cost=F.col("len") + 1)
    assert {r["count"] for r in batches.groupBy("batch").count().collect()} == {10}


def test_dealt_to_a_number_of_tasks(spark):
    batches = written(tf.balance_by_bytes(files(spark, [10] * 100), 50), "batches")
    routed, tasks = spread_over_tasks(batches)
    assert tasks == 20 and routed.rdd.getNumPartitions() == 20
    routed, tasks = spread_over_tasks(batches, 3)
    assert tasks == 3 and routed.rdd.getNumPartitions() == 3
    counts = [r["count"] for r in routed.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 100 and max(counts) <= 35


def test_a_small_index_is_broadcast_and_the_rows_stay_put(spark):
    offsets = written(tf.batch_partition_offsets(index_of(spark, [(p, 3) for p in range(100)])), "offsets")
    keys = spark.range(1_000_000).select((F.col("id") % 100).cast("int").alias("partition"), F.lit(1).alias("batch"))
    plan = tf.assign_batch_partition(keys, offsets)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_many_rows_get_more_shuffle_partitions(spark, monkeypatch):
    from treeferry import session

    copies = files(spark, range(600))
    usual = tf.balance_by_bytes(copies, 5000, 600, least_buckets=40)
    monkeypatch.setattr(session, "ROWS_PER_SHUFFLE_PARTITION", 40)
    spread = tf.balance_by_bytes(copies, 5000, 600, least_buckets=40)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(partition" in plan and ", 15)" in plan
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, usual.collect()))
