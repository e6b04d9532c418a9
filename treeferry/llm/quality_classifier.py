"""Quality by the votes of the nearest labelled documents.

Texts become vectors of weighted terms and, by a truncated singular value decomposition of
a bounded sample of labelled texts, short latent-semantic vectors. The sample's vectors are
broadcast; each document takes its exact cosine with all of them, block by block, and its
nearest neighbours vote, weighted by their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model is fitted on, at most: those with the least hash of their id.
SAMPLE_ROWS = 4096
DIMENSIONS, NEIGHBOURS, THRESHOLD = 48, 15, 0.3
#: Pairs of adjacent bytes are counted in so many terms.
PAIR_TERMS = 1024
#: Terms for how long a text is, and in steps for shares of it: repeated triples of words,
#: repeated lines, words after themselves, symbols by words, and capitals by bytes.
LENGTH_STEPS, SHARES, SHARE_STEPS = 8, 5, 8
#: What one such term weighs against all of a text's pairs.
STEP_WEIGHT = 0.6
TERMS = PAIR_TERMS + LENGTH_STEPS + SHARES * SHARE_STEPS
SYMBOLS, CAPITALS = b"#*$%&|<>!=", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK_BYTES, BLOCK_ROWS = 2 << 20, 512


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: those whose crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def term_counts(texts: list[bytes]):
    """A matrix with a row of term counts for each UTF-8 text."""
    import numpy as np

    counts = np.zeros((len(texts), TERMS), np.float32)
    if not texts:
        return counts
    lengths = np.array([len(text) for text in texts])
    whole = np.frombuffer(b"".join(texts), np.uint8)
    if len(whole) > 1:
        # Pairs by a multiplicative hash of both bytes; those across two texts are left out.
        pairs = (whole[:-1].astype(np.uint32) << np.uint32(8)) | whole[1:]
        terms = (pairs * np.uint32(2654435769)) >> np.uint32(22)
        rows = np.repeat(np.arange(len(texts)), lengths)
        inside = rows[:-1] == rows[1:]
        codes = rows[:-1][inside] * PAIR_TERMS + terms[inside]
        counts[:, :PAIR_TERMS] = np.bincount(codes, minlength=len(texts) * PAIR_TERMS).reshape(len(texts), PAIR_TERMS)
    for row, text in enumerate(texts):
        words, lines = text.split(), [line for line in text.split(b"\n") if line.strip()]
        n = len(words)
        counts[row, PAIR_TERMS + min(LENGTH_STEPS - 1, n.bit_length())] = 1
        shares = (
            1 - len(set(zip(words, words[1:], words[2:], strict=False))) / (n - 2) if n > 2 else 0,
            1 - len(set(lines)) / len(lines) if lines else 0,
            sum(map(eq, words, words[1:])) / n if n else 0,
            (len(text) - len(text.translate(None, SYMBOLS))) / n / 2 if n else 0,
            (len(text) - len(text.translate(None, CAPITALS))) / len(text) if text else 0,
        )
        for k, share in enumerate(shares):
            step = min(SHARE_STEPS - 1, int(2 * SHARE_STEPS * share))
            counts[row, PAIR_TERMS + LENGTH_STEPS + k * SHARE_STEPS + step] = 1
    return counts


@dataclass(frozen=True)
class Model:
    """``rarity`` weighs terms, ``axes`` turn them into latent vectors; ``vectors`` and
    ``labels`` are the sample's. At most ``SAMPLE_ROWS`` by ``DIMENSIONS`` numbers."""

    rarity: object
    axes: object
    vectors: object
    labels: object

    def weighted(self, counts):
        import numpy as np

        pairs = np.sqrt(counts[:, :PAIR_TERMS]) * self.rarity
        pairs /= np.maximum(np.linalg.norm(pairs, axis=1, keepdims=True), 1e-9)
        return np.hstack([pairs, STEP_WEIGHT * counts[:, PAIR_TERMS:]])

    def latent(self, counts):
        import numpy as np

        own = self.weighted(counts) @ self.axes
        return own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)

    def scores(self, counts):
        """The share of similarity-weighted votes for label 1 among the nearest neighbours."""
        import numpy as np

        cosines = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 1e-6) ** 4
        return (weights * self.labels[nearest]).sum(axis=1) / weights.sum(axis=1)


def fit(counts, labels) -> Model | None:
    """The model of a sample's term counts and labels; None without any row."""
    import numpy as np

    if not len(labels):
        return None
    seen = (counts[:, :PAIR_TERMS] > 0).sum(axis=0)
    rarity = (np.log((1 + len(labels)) / (1 + seen)) + 0.1).astype(np.float32)
    bare = Model(rarity, None, None, None)
    weighted = bare.weighted(counts)
    # The right singular vectors, from the small matrix of terms by terms.
    _, vectors = np.linalg.eigh(weighted.T.astype(np.float64) @ weighted)
    axes = vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32)
    latent = Model(rarity, axes, None, None).latent(counts).astype(np.float32)
    return Model(rarity, axes, latent, np.asarray(labels, np.float32))


def _texts(column) -> list[bytes]:
    buffers = (value.as_buffer() for value in column)
    return [b"" if own is None else own.to_pybytes() for own in buffers]


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= BLOCK_BYTES or len(block) >= BLOCK_ROWS:
            yield block
            block, size = [], 0
    if block:
        yield block


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on labelled rows that are not held out. A document with several labels counts by
    their mean; null labels and labels of unknown documents are not used."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [counts.tobytes() for block in _blocks(_texts(batch.column(1))) for counts in term_counts(block)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], names=["doc_id", "quality", "counts"])

    # The sample has at most sample_rows ids, so broadcasting it is bounded by a parameter.
    chosen = rows.join(F.broadcast(sample), "doc_id").mapInArrow(count, "doc_id long, quality double, counts binary")
    found = chosen.dropDuplicates(["doc_id"]).orderBy("doc_id").collect()

    import numpy as np

    matrix = np.frombuffer(b"".join(row["counts"] for row in found), np.float32).reshape(len(found), TERMS)
    return fit(matrix, [row["quality"] for row in found])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Only the whole text is judged. Null and empty texts are scored like other very short
    ones; without a model every score is 0.5. Rows that repeat are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = shared.value
        for batch in batches:
            texts = _texts(batch.column(1))
            parts = [own.scores(term_counts(block)) if own else np.full(len(block), 0.5) for block in _blocks(texts)]
            found = np.clip(np.round(np.concatenate(parts).astype(np.float64), 6), 0, 1) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scored = rows.mapInArrow(judge, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))
