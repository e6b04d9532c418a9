"""Packing of documents into sequences by first-fit decreasing.

Their pieces are dealt at random into groups of bounded size, and each group is packed by
itself: pieces in descending length go to the first sequence with room, which a tournament
tree over the sequences' free room finds in logarithmic time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeferry.llm.token_ids import encoded
from treeferry.scratch import written

SEQUENCE_TOKENS = 2048
#: Pieces of a group, on average; a short document is one piece. Larger groups pad less; one
#: is packed in one task.
GROUP_DOCUMENTS = 8192

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class TournamentTree:
    """Free room of numbered bins; each inner node holds the most room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Place ``size`` in the first bin that has room: its number and the room it had."""
        most, node = self.most, 1
        if most[1] < size:
            raise ValueError(f"no bin has room for {size}")
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        before = most[node]
        most[node] = before - size
        number = node - self.leaves
        while node > 1:
            node //= 2
            top = max(most[2 * node], most[2 * node + 1])
            if most[node] == top:
                break
            most[node] = top
        return number, before


def first_fit_decreasing(lengths: list[int], room: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece; equal lengths keep their order."""
    tree = TournamentTree(len(lengths), room)
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        number, before = tree.put(lengths[i])
        placed[i] = number, room - before
    return placed


def token_pieces(docs: DataFrame, tokenizer: str, end: int, room: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Every document as pieces of at most ``room`` ids, full ones but for the last:
    ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, and with ``with_ids``
    the piece's ``ids`` as well."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for doc_id, own in zip(ids, encoded((t.as_py() for t in batch.column(1)), tokenizer, end), strict=True):
                view, total = memoryview(own), len(own) // 4
                for start in range(0, total, room):
                    piece = view[4 * start : 4 * (start + room)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total, bytes(piece) if with_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [pa.array(column, pa.int64()) for column in columns[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays, names = [*arrays, pa.array(columns[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def assign_sequences(pieces: DataFrame, n_groups: int, room: int = SEQUENCE_TOKENS, seed: int = 1) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Sequences of a group are numbered from
    ``group << 32`` on. Groups are dealt by ``own_number``, a number that no two pieces have and
    that is written with them: rows that repeat are spread as others are."""
    names = [name for name in pieces.columns if name != "own_number"]

    def pack(table):
        import pyarrow as pa

        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        placed = first_fit_decreasing(table.column("length").to_pylist(), room)
        first = table.column("own_group")[0].as_py() << 32
        table = table.select(names)
        table = table.append_column("sequence_id", pa.array([first + bin for bin, _ in placed], pa.int64()))
        return table.append_column("offset", pa.array([offset for _, offset in placed], pa.int64()))

    # Pieces and not documents are dealt, so neither a huge text nor a repeated id fills a group.
    group = F.pmod(F.xxhash64("own_number", F.lit(seed)), F.lit(n_groups)).alias("own_group")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in names) + ", sequence_id long, offset long"
    return pieces.select("*", group).groupBy("own_group").applyInArrow(pack, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, end: int, room: int = SEQUENCE_TOKENS, group_documents: int = GROUP_DOCUMENTS, with_ids: bool = False
) -> DataFrame:
    """One row per piece of a document: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (and ``ids``).

    Null and empty texts are their end id alone. A null ``doc_id`` stays null, and rows that
    repeat are packed each. An empty table gives no piece. Other columns are not read.
    """
    # Written, so that texts are encoded once for the count and the packing.
    numbered = token_pieces(docs, tokenizer, end, room, with_ids).withColumn("own_number", F.monotonically_increasing_id())
    pieces = written(numbered, "pieces")
    n_groups = max(1, -(-pieces.count() // group_documents))
    return assign_sequences(pieces, n_groups, room)


def sequences(pieces: DataFrame, pad: int, room: int = SEQUENCE_TOKENS) -> DataFrame:
    """The sequences themselves, from pieces with their ids: ``sequence_id``, ``n_tokens``,
    ``ids``, padded with ``pad`` to ``room`` unless ``n_tokens`` is a power of two, and ``pieces``,
    an array of ``offset, length, doc_id, start`` in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", F.hex("ids").alias("ids"))))
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    ids = F.unhex(F.array_join(F.transform("parts", lambda part: part["ids"]), ""))
    filler = F.unhex(F.lit(pad.to_bytes(4, "little").hex()))
    whole = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    missing = F.when(whole, F.lit(0)).otherwise(F.lit(room) - F.col("n_tokens")).cast("int")
    return joined.select(
        "sequence_id", "n_tokens", F.concat(ids, F.unhex(F.repeat(F.hex(filler), missing))).alias("ids"),
        F.transform("parts", lambda part: part.dropFields("ids")).alias("pieces"),
    )
