"""Nearest vectors by an adaptive scan of dimensions.

Vectors lie in lists around centroids that a bounded sample gives. A query probes its nearest
lists. There, vectors are turned by a random rotation and laid out in blocks of columns: after
each block a candidate's distance so far, scaled to all dimensions, is tested against the
tenth best distance known, and a candidate that is too far with high confidence is given up.
What passes all blocks gets its exact distance from the original vectors.

A list is cut into chunks and the queries that probe it into blocks, so copies of one vector
or one popular region are many equal tasks. A task hands on ten rows a query at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeferry.scratch import written

NEIGHBOURS = 10
#: Rows that centroids, the number of probes and first bounds are learnt from, at most.
SAMPLE_ROWS = 65_536
#: Lists, and numbers in all their centroids, at most. Both are sent to every worker.
MOST_LISTS, MOST_CENTROID_VALUES = 4096, 4 << 20
ROUNDS = 10
#: Queries of the sample that the number of probes is learnt from, and the share of their
#: neighbours that has to lie in the lists probed.
TRIED_QUERIES, COVERED = 512, 0.96
#: Columns of a block of the scan.
BLOCK_COLUMNS = 16
#: How many standard deviations an estimate may be above the bound before a candidate goes.
CONFIDENCE = 2.1
#: Rows of a chunk of a list, and queries of a block, that one task compares.
LEAST_CHUNK, MOST_CHUNK, QUERY_ROWS = 256, 16_384, 1024
SCANNED_ROWS = 1024


@dataclass(frozen=True)
class Model:
    """What the sample taught: a rotation, centroids (turned), how many lists to probe, and the
    sample itself, whose distances bound a query's tenth best from above."""

    rotation: object
    centroids: object
    probes: int
    sample_ids: object
    sample: object

    def nearest_lists(self, vectors, n: int):
        """The ``n`` nearest centroids of each original vector, nearest first."""
        import numpy as np

        far = (self.centroids**2).sum(axis=1)[None, :] - 2 * (vectors @ self.rotation @ self.centroids.T)
        if n == 1:
            return far.argmin(axis=1)[:, None]
        some = np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(np.arange(far.shape[1]), (len(far), 1))
        return np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable"), 1)

    def known(self, query_id: int, vector, k: int):
        """(distances, ids) of the ``k`` nearest of the sample: candidates as good as any, and a
        bound for all others."""
        import numpy as np

        far = np.sqrt(((self.sample - vector) ** 2).sum(axis=1))
        far[self.sample_ids == query_id] = math.inf
        some = np.argpartition(far, k - 1)[:k] if k < len(far) else np.arange(len(far))
        some = np.flatnonzero(far <= far[some].max(initial=-1)) if len(some) else some
        order = some[np.lexsort((self.sample_ids[some], far[some]))][:k]
        order = order[np.isfinite(far[order])]
        return far[order], self.sample_ids[order]


def _distances(a, b):
    """Squared distances of all of ``a`` to all of ``b``."""
    import numpy as np

    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T), 0)


def fit(ids, vectors, n_rows: int, k: int = NEIGHBOURS, seed: int = 13) -> Model:
    """Rotation, centroids by Lloyd's rounds, and the probes that find ``COVERED`` of the
    sample's own neighbours. In the sample these lie further apart than among all rows, so
    the number errs on the safe side."""
    import numpy as np

    chance = np.random.default_rng(seed)
    width = vectors.shape[1]
    rotation = np.linalg.qr(chance.standard_normal((width, width)))[0]
    turned = vectors @ rotation
    different = np.unique(turned, axis=0)
    n_lists = int(max(1, min(math.sqrt(n_rows), MOST_LISTS, MOST_CENTROID_VALUES // width, len(different))))
    centroids = different[chance.choice(len(different), n_lists, replace=False)]

    def assigned():
        return np.concatenate([(_distances(part, centroids)).argmin(axis=1) for part in np.array_split(turned, max(1, len(turned) // 2048))])

    for _ in range(ROUNDS):
        own = assigned()
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, turned)
        sizes = np.bincount(own, minlength=n_lists)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    own = assigned()

    tried = chance.choice(len(turned), min(TRIED_QUERIES, len(turned)), replace=False)
    ranks = []
    for part in np.array_split(tried, max(1, len(tried) // 64)):
        near = _distances(turned[part], turned)
        near[np.arange(len(part)), part] = math.inf
        near = np.argsort(near, axis=1, kind="stable")[:, : min(k, len(turned) - 1)]
        place = np.argsort(np.argsort(_distances(turned[part], centroids), axis=1, kind="stable"), axis=1, kind="stable")
        ranks.append(np.take_along_axis(place, own[near], 1).reshape(-1))
    ranks = np.sort(np.concatenate(ranks))
    probes = int(ranks[min(len(ranks) - 1, math.ceil(COVERED * len(ranks)) - 1)]) + 1 if len(ranks) else 1
    return Model(rotation, centroids, min(probes, n_lists), ids, vectors)


@dataclass(frozen=True)
class VectorIndex:
    """``rows`` (``vec_id, vector, list, number``, written), the rows of each list, and the
    model; ``width`` is the length of its vectors, or 0 where there are none."""

    rows: DataFrame
    sizes: DataFrame
    model: Broadcast | None
    n_rows: int
    width: int


def _usable(vector: Column) -> Column:
    """No null or non-finite component, and not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < math.inf), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column, width: int):
    import numpy as np
    import pyarrow as pa

    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _named(vectors: DataFrame, vector: str) -> DataFrame:
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    return named.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))


def build_index(vectors: DataFrame, vector: str = "embedding") -> VectorIndex:
    """An index of every usable row of ``vec_id`` and ``vector``.

    Rows without an id, and vectors that are null, zero, or hold a null or non-finite
    component take no part, nor do those of another length than most (of several such
    lengths, the least). Other columns are not looked at. The sample is drawn by a hash of
    the id.
    """
    import numpy as np

    spark = vectors.sparkSession
    named = _named(vectors, vector)
    lengths = named.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if not lengths:
        schema = f"vec_id long, vector {named.schema['vector'].dataType.simpleString()}, list int, number long"
        empty = spark.createDataFrame([], schema)
        return VectorIndex(empty, empty.groupBy("list").count(), None, 0, 0)
    width, n_rows = lengths
    usable = named.where(F.size("vector") == width)
    # A quarter more than wanted, as the hash gives no exact number; beyond that rows go.
    wanted = max(1024, min(SAMPLE_ROWS, 64 * math.isqrt(n_rows)))
    share = min(1.0, 1.25 * wanted / n_rows)
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = usable.where(drawn).limit(min(SAMPLE_ROWS, 2 * wanted)).toArrow()
    ids, first = np.unique(sample.column("vec_id").to_numpy(), return_index=True)
    if not len(ids):  # a few rows may all miss the draw
        sample = usable.limit(1024).toArrow()
        ids, first = np.unique(sample.column("vec_id").to_numpy(), return_index=True)
    model = spark.sparkContext.broadcast(fit(ids, _matrix(sample.column("vector"), width)[first], n_rows))

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                own = model.value.nearest_lists(_matrix(batch.column(1), width), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(own, pa.int32())], names=["vec_id", "vector", "list"])

    kind = named.schema["vector"].dataType.simpleString()
    listed = usable.mapInArrow(assign, f"vec_id long, vector {kind}, list int")
    rows = written(listed.withColumn("number", F.monotonically_increasing_id()), "vectors")
    sizes = written(rows.groupBy("list").agg(F.count(F.lit(1)).alias("rows")), "lists")
    return VectorIndex(rows, sizes, model, n_rows, width)


class Scan:
    """Candidates of one chunk, turned and in blocks of columns."""

    def __init__(self, model: Model, ids, vectors):
        import numpy as np

        self.ids, self.vectors, self.model = ids, vectors, model
        turned = vectors @ model.rotation
        self.width = turned.shape[1]
        self.blocks = [(start, np.ascontiguousarray(turned[:, start : start + BLOCK_COLUMNS])) for start in range(0, self.width, BLOCK_COLUMNS)]
        self.norm = float((vectors**2).sum(axis=1).max(initial=0))

    def near(self, query_id: int, query, bound: float, k: int):
        """(distances, ids) of the ``k`` nearest of this chunk that lie within ``bound``, as far
        as the tests let them pass; nearest first, of equal ones the least ids."""
        import numpy as np

        turned = query @ self.model.rotation
        slack = 1e-12 * (self.norm + float(query @ query))
        best, names = np.zeros(0), np.zeros(0, np.int64)
        for low in range(0, len(self.ids), SCANNED_ROWS):
            alive = low + np.flatnonzero(self.ids[low : low + SCANNED_ROWS] != query_id)
            so_far = np.zeros(len(alive))
            for start, block in self.blocks:
                apart = block[alive] - turned[start : start + block.shape[1]]
                so_far += np.einsum("ij,ij->i", apart, apart)
                seen = start + block.shape[1]
                limit = bound * (1 + CONFIDENCE / math.sqrt(seen)) if seen < self.width else bound * (1 + 1e-9)
                kept = so_far * (self.width / seen) <= limit * limit + slack
                alive, so_far = alive[kept], so_far[kept]
                if not len(alive):
                    break
            if not len(alive):
                continue
            exact = np.sqrt(((self.vectors[alive] - query) ** 2).sum(axis=1))
            best, names = np.concatenate([best, exact]), np.concatenate([names, self.ids[alive]])
            order = np.lexsort((names, best))
            first = np.sort(np.unique(names[order], return_index=True)[1])[:k]  # an id that repeats counts once
            best, names = best[order][first], names[order][first]
            if len(best) == k:
                bound = min(bound, float(best[-1]))
        return best, names


FOUND = "query_id long, vec_id long, score double"


def search(index: VectorIndex, queries: DataFrame, vector: str = "embedding", k: int = NEIGHBOURS, probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each usable query its ``k`` nearest rows found, by
    Euclidean distance in double precision, nearest first and ties by ``vec_id``.

    A row never finds rows of its own id. An id that repeats counts once, at its nearest
    vector; as a query it stands for its least vector. Queries that the index could not hold
    have no rows. ``probes``: lists to probe, in place of the number the sample gave.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    if not index.model:
        return queries.sparkSession.createDataFrame([], schema)
    model, width = index.model, index.width
    n_lists = len(model.value.centroids)
    probed = n_lists if len(model.value.sample_ids) <= k else min(probes or model.value.probes, n_lists)
    asked = _named(queries, vector).where(F.size("vector") == width).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    kind = asked.schema["vector"].dataType.simpleString()

    def probe(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                own, ids = _matrix(part.column(1), width), part.column(0).to_numpy()
                lists = model.value.nearest_lists(own, probed)
                known = [model.value.known(name, one, k) for name, one in zip(ids.tolist(), own, strict=True)]
                bounds = [far[k - 1] if len(far) == k else math.inf for far, _ in known]
                times = lists.shape[1]
                first = [[{"vec_id": i, "score": d} for d, i in zip(far, names, strict=True)] for far, names in known]
                first = [one if place == 0 else None for one in first for place in range(times)]
                at = pa.array(np.repeat(np.arange(len(ids)), times))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(lists.reshape(-1), pa.int32()), pa.array(np.repeat(bounds, times), pa.float64()), pa.array(first, pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])))],
                    names=["query_id", "query", "list", "bound", "known"],
                )

    probing = written(
        asked.select("vec_id", "vector").mapInArrow(probe, f"query_id long, query {kind}, list int, bound double, known array<struct<vec_id: bigint, score: double>>").withColumn("number", F.monotonically_increasing_id()),
        "probes",
    )
    # At most MOST_LISTS rows, so both sides take it from a broadcast.
    chunk = min(max(2 * index.n_rows // max(1, len(model.value.centroids)), LEAST_CHUNK), MOST_CHUNK)
    counted = probing.groupBy("list").agg(F.count(F.lit(1)).alias("queries")).join(index.sizes, "list")
    layout = written(counted.select("list", F.ceil(F.col("rows") / chunk).cast("int").alias("chunks"), F.ceil(F.col("queries") / QUERY_ROWS).cast("int").alias("blocks")), "layout")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("number"), F.col(n)).cast("int")
    rows = index.rows.join(F.broadcast(layout), "list").select("list", own("chunks").alias("chunk"), each("blocks").alias("block"), "vec_id", "vector")
    asking = probing.join(F.broadcast(layout), "list").select("list", each("chunks").alias("chunk"), own("blocks").alias("block"), "query_id", "query", "bound")

    def scan(left, right):
        import numpy as np
        import pyarrow as pa

        found = []
        if left.num_rows and right.num_rows:
            candidates = Scan(model.value, left.column("vec_id").to_numpy(), _matrix(left.column("vector"), width))
            asked_for = zip(right.column("query_id").to_pylist(), _matrix(right.column("query"), width), right.column("bound").to_pylist(), strict=True)
            for name, one, bound in asked_for:
                best, names = candidates.near(name, one, bound, k)
                found.append((np.full(len(best), name, np.int64), names, best))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    key = "list", "chunk", "block"
    near = rows.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(scan, FOUND)
    near = near.unionByName(probing.where("known IS NOT NULL").select("query_id", F.inline("known")))
    once = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = once.selectExpr("query_id", "row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def search_hundredths(vectors: DataFrame) -> DataFrame:
    """The nearest rows of every row whose ``vec_id`` a hundred divides, among all rows."""
    return search(build_index(vectors), vectors.where(F.col("vec_id") % 100 == 0))
