"""Vector search against distances to all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from treeferry.llm import vector_search as search

SCHEMA = "vec_id long, embedding array<float>"


def usable(v, width):
    return v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, k=10):
    """{query: [(rank, vec_id, score)]}; ids that repeat count once, at their nearest."""
    valid = [(i, v) for i, v in rows if i is not None and v is not None and usable(v, len(v))]
    if not valid:
        return {}
    lengths = [len(v) for _, v in valid]
    width = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    valid = [(i, np.array(v, np.float32).astype(float)) for i, v in valid if len(v) == width]
    found = {}
    for q in sorted({i for i, _ in valid if i % 100 == 0}):
        own = min(tuple(v) for i, v in valid if i == q)
        best = {}
        for i, v in valid:
            if i != q:
                best[i] = min(best.get(i, math.inf), float(np.sqrt(((v - np.array(own)) ** 2).sum())))
        near = sorted(best.items(), key=lambda p: (p[1], p[0]))[:k]
        if near:
            found[q] = [(rank + 1, i, score) for rank, (i, score) in enumerate(near)]
    return found


def got(frame):
    found = {}
    for r in search.search_hundredths(frame).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in found.items()}


def recall(found, wanted):
    assert set(found) == set(wanted)
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i, _ in wanted[q]}) for q in wanted)
    return hits / sum(map(len, wanted.values()))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    chance = np.random.default_rng(0)
    rows = [(i, chance.standard_normal(4).astype(np.float32).tolist()) for i in range(250)]
    rows += [(None, [1.0] * 4), (300, None), (400, [0.0] * 4), (500, [nan, 1.0, 0.0, 0.0]), (501, [inf, 1.0, 0.0, 0.0]), (600, [None, 1.0, 0.0, 0.0]), (700, []), (800, [1.0, 2.0])]
    rows += [(100, [9.0] * 4), (7, rows[0][1]), (8, rows[0][1]), rows[3], rows[3], (100, rows[100][1])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit(1) for name in ("list", "number", "score", "vector", "chunk", "rank")})
    assert got(frame) == brute(rows)
    as_double = frame.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert got(as_double) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(100, [1.0, 2.0])], [(100, [1.0, 2.0]), (100, [1.0, 2.0])], [(0, [1.0]), (1, [1.0]), (100, [1.0])]])
def test_small_tables(spark, rows):
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_fewer_different_ids_than_neighbours(spark):
    """Rows that repeat leave the sample with few ids; all lists are probed then."""
    rows = [(i % 4 * 100, [float(i % 50), 1.0]) for i in range(4000)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_copies_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(search, "LEAST_CHUNK", 50)
    monkeypatch.setattr(search, "QUERY_ROWS", 3)
    monkeypatch.setattr(search, "SCANNED_ROWS", 16)
    chance = np.random.default_rng(1)
    hot = chance.standard_normal(8).astype(np.float32)
    rows = [(i, (hot if i % 3 == 0 else chance.standard_normal(8)).astype(float).tolist()) for i in range(3000)]
    found, wanted = got(spark.createDataFrame(rows, SCHEMA)), brute(rows)
    assert recall(found, wanted) >= 0.9
    for q in wanted:
        if q % 3 == 0:
            assert found[q] == wanted[q] and found[q][-1][2] == 0


def test_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    found, wanted = got(frame), brute(rows)
    assert recall(found, wanted) >= 0.95
    exact = {i: np.array(v, float) for i, v in rows}
    for q, near in found.items():
        assert [rank for rank, _, _ in near] == list(range(1, 11))
        assert [(s, i) for _, i, s in near] == sorted((s, i) for _, i, s in near)
        for _, i, score in near:
            assert score == float(np.sqrt(((exact[i] - exact[q]) ** 2).sum()))


def test_abandoned_candidates(monkeypatch):
    """The tests give up most candidates early and hardly ever a near one."""
    chance = np.random.default_rng(2)
    centres = chance.standard_normal((20, 64)) * 3
    vectors = centres[chance.integers(20, size=4000)] + chance.standard_normal((4000, 64))
    ids = np.arange(4000)
    model = search.fit(ids[:500], vectors[:500], 4000)
    scan = search.Scan(model, ids, vectors)
    seen = []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: seen.append(a.size) or einsum(how, a, b))
    hits = 0
    for q in range(0, 4000, 100):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        known, _ = model.known(q, vectors[q], 10)
        scores, names = scan.near(q, vectors[q], known[-1], 10)
        hits += len(set(names) & set(np.argsort(far)[:10]))
        assert np.array_equal(scores, far[names])
    assert hits >= 0.98 * 400
    assert sum(seen) < 0.6 * 40 * vectors.size
    monkeypatch.setattr(search, "CONFIDENCE", 1e9)
    scores, names = scan.near(0, vectors[0], math.inf, 10)
    far = np.sqrt(((vectors - vectors[0]) ** 2).sum(axis=1))
    assert names.tolist() == np.argsort(far)[1:11].tolist()
