"""Exact deduplication by composable polynomial fingerprints.

A text is read as a number in base 256, and its fingerprint is that number modulo a prime.
Fingerprints of adjacent pieces combine by shifting the first by the length of the second,
so the pieces of a huge text can be hashed by different tasks. Texts of equal fingerprint
and length are then compared piece by piece; a fingerprint alone decides nothing.

Texts that share their fingerprint with no other stay where they are read: a filter of
bounded size holds the fingerprints of groups, and only texts that pass it move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeferry.llm.chosen_rows import KeyFilter, keep_chosen
from treeferry.llm.columns import ascii_lower
from treeferry.scratch import written

# Fixed value: a prime of 126 bits.
PRIME = 2**126 - 137
#: Texts up to this length are hashed where they are read, longer ones in pieces of it.
PIECE_BYTES = 1 << 20

KEY = ["n_bytes", "fingerprint"]
FOUND = "doc_id long, n_bytes long, fingerprint binary, text_sha256 string"


def fingerprint(piece: bytes) -> int:
    return int.from_bytes(piece, "big") % PRIME


def combine(first: int, second: int, second_bytes: int) -> int:
    """The fingerprint of two pieces, one after the other."""
    return (first * pow(256, second_bytes, PRIME) + second) % PRIME


def combine_all(pieces: Iterable[tuple[int, int]]) -> int:
    """The fingerprint of pieces, given as (fingerprint, length) in order."""
    whole = 0
    for own, n_bytes in pieces:
        whole = combine(whole, own, n_bytes)
    return whole


def packed(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _hashed(batches: Iterator, piece_bytes: int) -> Iterator:
    """Batches of ``doc_id, body`` with the hashes of their normalised bodies. Bodies above
    ``piece_bytes`` get their digest only."""
    import pyarrow as pa

    for batch in batches:
        lengths, prints, digests = [], [], []
        for value in batch.column(1):
            own = value.as_buffer().to_pybytes().lower()  # of bytes, this changes A-Z alone
            lengths.append(len(own))
            prints.append(packed(fingerprint(own)) if len(own) <= piece_bytes else None)
            digests.append(hashlib.sha256(own).hexdigest())
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0), "n_bytes": pa.array(lengths, pa.int64()),
                "fingerprint": pa.array(prints, pa.binary()), "text_sha256": pa.array(digests, pa.string()),
            }
        )


def _suspected(batches: Iterator, piece_bytes: int, suspects: KeyFilter) -> Iterator:
    """The bodies of up to ``piece_bytes`` that may share their fingerprint with another."""
    import pyarrow as pa

    for batch in batches:
        rows = []
        for value in batch.column(0):
            own = value.as_buffer().to_pybytes().lower()
            if len(own) <= piece_bytes and suspects.keeps(found := packed(fingerprint(own))):
                rows.append((len(own), found, own))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))], names=[*KEY, "own"]
        )


def _bodies(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))


def _pieces(bodies: DataFrame, piece_bytes: int) -> DataFrame:
    """The long texts in pieces, dealt over all tasks, each with its own fingerprint.
    Pieces of one text share ``doc_id``, ``n_bytes`` and ``text_sha256``."""
    own = F.encode(ascii_lower(F.col("body")), "utf-8")
    long = bodies.where(F.octet_length("body") > piece_bytes).select("doc_id", own.alias("whole"))
    size = F.octet_length("whole").cast("long")
    cut = long.select(
        "doc_id", size.alias("n_bytes"), F.sha2("whole", 256).alias("text_sha256"), "whole",
        F.explode(F.sequence(F.lit(0), F.floor((size - 1) / piece_bytes).cast("int"))).alias("piece"),
    ).select(
        "doc_id", "n_bytes", "text_sha256", "piece",
        F.substring(F.col("whole"), F.col("piece") * piece_bytes + 1, F.lit(piece_bytes)).alias("own"),
    )

    @F.pandas_udf("binary")
    def hashes(pieces):
        return pieces.map(lambda piece: packed(fingerprint(piece)))

    return cut.repartition("text_sha256", "piece").withColumn("piece_print", hashes("own"))


def _prints(pieces: DataFrame) -> DataFrame:
    """The long texts' fingerprints, from those of their pieces."""

    @F.udf("binary")
    def whole(parts):
        return packed(combine_all((int.from_bytes(p["print"], "big"), p["size"]) for p in parts))

    part = F.struct("piece", F.col("piece_print").alias("print"), F.octet_length("own").alias("size"))
    texts = pieces.groupBy("text_sha256", "n_bytes").agg(F.array_sort(F.collect_set(part)).alias("parts"))
    return texts.select("text_sha256", "n_bytes", whole("parts").alias("fingerprint"))


def classes(docs: DataFrame, text: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per row of ``docs``, in a table of its own: ``doc_id``, ``n_bytes``,
    ``fingerprint``, ``text_sha256``, ``row_id`` (a number of the row) and ``digest``, which
    is null but where different texts share a fingerprint. Rows with equal texts are those
    that agree in ``n_bytes``, ``fingerprint`` and ``digest``.

    Suspected copies are compared by an aggregation: where the least and the greatest piece
    at each place are equal, all texts of the group are. Each task reduces what it has read
    before it sends anything, so a group that holds a third of all rows is no hot key.
    A text needs a few times its own length in a task's memory, a long one's pieces move alone.
    """
    bodies = _bodies(docs, text)
    hashed = bodies.mapInArrow(lambda batches: _hashed(batches, piece_bytes), FOUND)
    found, pieces = written(hashed.withColumn("row_id", F.monotonically_increasing_id()), "fingerprints"), None
    long = found.where("fingerprint IS NULL").drop("fingerprint")
    if not long.isEmpty():
        pieces = written(_pieces(bodies, piece_bytes), "pieces")
        whole = long.join(_prints(pieces), ["text_sha256", "n_bytes"])
        found = written(found.where("fingerprint IS NOT NULL").unionByName(whole), "combined")

    suspects = written(found.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*KEY), "suspects")
    wanted = docs.sparkSession.sparkContext.broadcast(KeyFilter(suspects, F.col("fingerprint")))
    texts = bodies.select("body").mapInArrow(lambda batches: _suspected(batches, piece_bytes, wanted.value), "n_bytes long, fingerprint binary, own binary")
    chunks = texts.select(*KEY, F.lit(0).alias("piece"), "own")
    if pieces is not None:
        prints = found.join(suspects, KEY, "left_semi").select("text_sha256", *KEY).distinct()
        chunks = chunks.unionByName(pieces.join(prints, ["text_sha256", "n_bytes"]).select(*KEY, "piece", "own"))
    # No join before the aggregation: each task sends two texts of a group at most.
    compared = chunks.groupBy(*KEY, "piece").agg((F.min("own") == F.max("own")).alias("same"))
    differing = written(compared.where("NOT same").select(*KEY).distinct(), "differing")
    marked = found.join(differing.withColumn("differs", F.lit(True)), KEY, "left")
    return marked.withColumn("digest", F.when(F.col("differs"), F.col("text_sha256"))).drop("differs")


def deduplicate(docs: DataFrame, text: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per row of ``docs``, dropped ones too: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so all null
    and empty texts are one group. Of equal texts the row with the largest ``doc_id`` stays.
    Where that id repeats, one of its rows does. A null id is less than any other; a group of
    null ids only keeps one of its rows, and its ``keep_id`` is null. An empty table gives an
    empty result; other columns, whatever their names, are not read.
    """
    rows = classes(docs, text, piece_bytes)
    key = [*KEY, F.coalesce("digest", F.lit("")).alias("digest")]
    rows = rows.select("doc_id", "row_id", "text_sha256", *key)
    order = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "row_id")
    groups = written(rows.groupBy(*KEY, "digest").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return rows.join(groups, [*KEY, "digest"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        "text_sha256",
    )


def _digest(own: bytes) -> bytes:
    return hashlib.sha256(own.lower()).digest()


def drop_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows that repeat both
    ``doc_id`` and text, one stays. An empty table gives an empty one.

    Rows whose text is no other's are passed on where they are read. Of those with copies
    only the ones that stay, and few others, are moved.
    """
    kept = written(deduplicate(docs, text).where("kept").select("doc_id", F.unhex("text_sha256").alias("key"), "group_size"), "decided")
    return keep_chosen(docs, _digest, kept, kept.where("group_size > 1").select("key"), text)


ORACLE = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS own FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(own) AS text_sha256
FROM t WINDOW same AS (PARTITION BY own)
"""
