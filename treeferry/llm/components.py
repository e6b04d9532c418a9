"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeferry.scratch import written

#: Nodes that a task holds before it hands on what it has found.
HELD_NODES = 500_000


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges of each task as stars around the least node that they connect: at most one
    edge a node and task is left, before anything is shuffled."""

    def contract(batches: Iterator) -> Iterator:
        import pyarrow as pa

        parent: dict[int, int] = {}

        def root(node: int) -> int:
            top = node
            while (above := parent.setdefault(top, top)) != top:
                top = above
            while node != top:
                parent[node], node = top, parent[node]
            return top

        def stars():
            found = [(node, root(node)) for node in list(parent)]
            found = [star for star in found if star[0] != star[1]]
            parent.clear()
            u, v = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > HELD_NODES:
                yield stars()
        yield stars()

    return edges.select("u", "v").mapInArrow(contract, "u long, v long")


def _least(pairs: DataFrame) -> DataFrame:
    """``u, v, least``: each pair with the least ``v`` of its ``u``.

    The join's key is another one than the aggregation's, so both its sides are dealt anew
    for it. Such a join is one whose large keys, the centres of stars, Spark can split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select((-F.col("u")).alias("minus"), "least")
    return pairs.withColumn("minus", -F.col("u")).join(least, "minus").drop("minus")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the node's least neighbour, or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _least(down)
    both = F.array(F.struct(F.col("u"), F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))
    return found.select(F.inline(both)).where("u <> v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, and nothing hangs on those that do."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below")),
    )))
    counts = ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return counts.where("above > 1 OR (above = 1 AND below = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of the edges ``u, v`` (long, not null). A component
    is named by its least node, which has a row as well.

    Alternates two steps that keep the components and turn them into stars, in a number of
    rounds that grows with the logarithm of the longest path. Each round is a table in the
    shared folder; nothing but whether to go on comes to the driver.
    """
    edges = written(_contracted(edges.where("u <> v")).distinct(), "edges")
    while not _is_stars(edges):
        edges = written(_contracted(_small_star(_large_star(edges))), "stars")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
