"""Token ids in files of compressed bit planes.

Documents are dealt over files by ranges of ``doc_id``, so the files in order hold all ids in
ascending order. A file is a run of blocks with a fixed number of ids. Each block is
transposed: bit ``k`` (or byte ``k``) of all its ids forms plane ``k``, and each plane is
compressed by itself with zstandard, planes of leading zeros not at all. Behind the blocks
stand an index of them and the table of documents, so any range of ids can be read alone.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeferry.llm.task_files import NewFile, StoredFile, new_file_folder
from treeferry.llm.token_ids import encoded
from treeferry.scratch import written

BLOCK_IDS = 1 << 16
ZSTD_LEVEL = 3
#: A file is closed at so many ids (256 MiB before compression) or documents, whatever comes
#: first; a document is never cut.
FILE_IDS, FILE_DOCS = 1 << 26, 1 << 20
#: A writing task gets about so many bytes of the input, as Catalyst estimates it.
TASK_BYTES = 256 << 20
# Fixed value: the end of every file.
MAGIC = b"IDPLANE1"
TAIL = "<QQ8s"
TAIL_BYTES = struct.calcsize(TAIL)

FILES = "number long, uri string, n_docs long, n_ids long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


def to_planes(ids, plane: str) -> list[bytes]:
    """The planes of a block from the lowest on, as far as any id has a bit in them."""
    import numpy as np

    top = int(ids.max()).bit_length() if len(ids) else 0
    if plane == "byte":
        columns = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [np.ascontiguousarray(columns[:, k]).tobytes() for k in range(-(-top // 8))]
    return [np.packbits(((ids >> np.uint32(k)) & np.uint32(1)).astype(np.uint8)).tobytes() for k in range(top)]


def from_planes(planes: list[bytes], n_ids: int, plane: str):
    import numpy as np

    ids = np.zeros(n_ids, np.uint32)
    for k, own in enumerate(planes):
        values = np.frombuffer(own, np.uint8)
        values = values if plane == "byte" else np.unpackbits(values, count=n_ids)
        ids |= values.astype(np.uint32) << np.uint32(k * (8 if plane == "byte" else 1))
    return ids


class PlaneWriter:
    """Writes one file; holds a block of ids and the table of documents in memory."""

    def __init__(self, file: NewFile, plane: str, block_ids: int):
        import zstandard

        self.file, self.plane, self.block_ids = file, plane, block_ids
        self.compressor = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        self.waiting, self.n_waiting = [], 0
        self.blocks: list[list] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.waiting.append(ids)
        self.n_ids += len(ids) // 4
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= self.block_ids:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        import numpy as np

        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        at = 0
        while len(ids) - at >= self.block_ids or (all_of_it and at < len(ids)):
            block = ids[at : at + self.block_ids]
            at += len(block)
            start, lengths = self.file.n_bytes, []
            for own in to_planes(block, self.plane):
                packed = self.compressor.compress(own)
                self.file.write(packed)
                lengths.append(len(packed))
            self.blocks.append([start, len(block), lengths])
        self.waiting, self.n_waiting = [ids[at:].tobytes()], len(ids) - at

    def close(self) -> None:
        import numpy as np

        self._flush(True)
        named = np.array([i is not None for i in self.doc_ids], np.uint8)
        table = np.array([i or 0 for i in self.doc_ids], "<i8").tobytes() + np.array(self.counts, "<i8").tobytes() + named.tobytes()
        index = json.dumps({"plane": self.plane, "blocks": self.blocks, "n_docs": len(self.counts)}).encode()
        parts = [self.compressor.compress(index), self.compressor.compress(table)]
        for part in parts:
            self.file.write(part)
        self.file.write(struct.pack(TAIL, len(parts[0]), len(parts[1]), MAGIC))
        self.file.close()


class PlaneReader:
    """Reads one file of ``n_bytes``: documents in order, or any range of ids."""

    def __init__(self, uri: str, n_bytes: int):
        import numpy as np
        import zstandard

        self.file, self.decompressor = StoredFile(uri), zstandard.ZstdDecompressor()
        self.file.seek(n_bytes - TAIL_BYTES)
        n_index, n_table, magic = struct.unpack(TAIL, self.file.read(TAIL_BYTES))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a file of id planes")
        self.file.seek(n_bytes - TAIL_BYTES - n_index - n_table)
        index = json.loads(self.decompressor.decompress(self.file.read(n_index)))
        table = self.decompressor.decompress(self.file.read(n_table))
        n = index["n_docs"]
        self.plane, self.blocks = index["plane"], index["blocks"]
        self.doc_ids = np.frombuffer(table, "<i8", n)
        self.counts = np.frombuffer(table, "<i8", n, 8 * n)
        self.named = np.frombuffer(table, np.uint8, n, 16 * n)

    def _block(self, n_ids: int, lengths: list[int]) -> bytes:
        planes = [self.decompressor.decompress(self.file.read(length)) for length in lengths]
        return from_planes(planes, n_ids, self.plane).astype("<u4").tobytes()

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        """Each document's id and token ids; one block and one document are in memory."""
        self.file.seek(0)
        ready, blocks = bytearray(), iter(self.blocks)
        for doc_id, count, named in zip(self.doc_ids.tolist(), self.counts.tolist(), self.named.tolist(), strict=True):
            while len(ready) < 4 * count:
                _, n_ids, lengths = next(blocks)
                ready += self._block(n_ids, lengths)
            yield (doc_id if named else None), bytes(ready[: 4 * count])
            del ready[: 4 * count]

    def ids(self, first: int, count: int) -> bytes:
        """Ids ``first`` to ``first + count`` of the file, from the blocks that hold them."""
        out, at = [], 0
        for start, n_ids, lengths in self.blocks:
            if at < first + count and at + n_ids > first:
                self.file.seek(start)
                own = self._block(n_ids, lengths)
                out.append(own[4 * max(0, first - at) : 4 * (first + count - at)])
            at += n_ids
        return b"".join(out)

    def close(self) -> None:
        self.file.close()


def estimated_bytes(frame: DataFrame) -> int:
    """What Catalyst takes the size of a table to be, without reading it; 0 if it has no idea,
    which it states as a size beyond an exabyte."""
    size = int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def write_ids(
    docs: DataFrame, tokenizer: str, end: int, tasks: int | None = None, plane: str = "bit", block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS,
) -> DataFrame:
    """Encode every whole text, append ``end``, and write the ids in ascending ``doc_id``
    order. Returns a table with a row for each file: ``number`` (files in ascending order),
    ``uri``, ``n_docs``, ``n_ids``, ``n_bytes``.

    ``tasks`` write, each of them a run of files that are closed at ``file_ids`` or
    ``file_docs``; by default the session's shuffle partitions, and more for an input above
    ``TASK_BYTES`` for each. A task holds a block of ids, a document and the table of one file's
    documents. Null texts are empty and have only the end id. Null ids come first; rows of the same id are ordered by
    length, and rows that repeat are written each. An empty table gives no file.
    """
    spark = docs.sparkSession
    folder = new_file_folder(spark, "ids")
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-estimated_bytes(docs.select("doc_id", "text")) // TASK_BYTES))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("size", F.octet_length("text")).withColumn("tie", F.xxhash64("text"))
    order = ["doc_id", "size", "tie"]

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        writer, number = None, TaskContext.get().partitionId() << 32

        def closed() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pydict(
                {
                    "number": pa.array([number], pa.int64()), "uri": [writer.file.uri], "n_docs": [len(writer.counts)],
                    "n_ids": [writer.n_ids], "n_bytes": [writer.file.n_bytes],
                }
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, own in zip(ids, encoded((t.as_py() for t in batch.column(1)), tokenizer, end), strict=True):
                if writer is None:
                    writer = PlaneWriter(NewFile(folder, ".ids"), plane, block_ids)
                writer.add(doc_id, own)
                if writer.n_ids >= file_ids or len(writer.counts) >= file_docs:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    sorted_rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return written(sorted_rows.mapInArrow(write, FILES), "id-files")


def read_ids(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start`` (ids before it in all files),
    ``n_tokens``, ``ids`` (little-endian unsigned 32-bit).

    Only the table of files comes to the driver: at ``FILE_IDS`` each, 16,000 for 4 TB of ids.
    """
    placed, before = [], 0
    for row in sorted(files.collect(), key=lambda row: row["number"]):
        placed.append((row["uri"], row["n_bytes"], before, len(placed)))
        before += row["n_ids"]
    if not placed:
        return spark.createDataFrame([], ROWS)
    tasks = spark.createDataFrame(placed, "uri string, n_bytes long, before long, number int").repartitionById(len(placed), "number")

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            for file in batch.to_pylist():
                yield from _batches(PlaneReader(file["uri"], file["n_bytes"]), file["before"])

    return tasks.mapInArrow(read, ROWS)


def _batches(reader: PlaneReader, before: int, batch_bytes: int = 8 << 20) -> Iterator:
    import pyarrow as pa

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([len(r[2]) // 4 for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()),
            ],
            names=["doc_id", "start", "n_tokens", "ids"],
        )

    rows, size = [], 0
    for doc_id, ids in reader.documents():
        rows.append((doc_id, before, ids))
        before += len(ids) // 4
        size += len(ids)
        if size >= batch_bytes:
            yield batch(rows)
            rows, size = [], 0
    reader.close()
    if rows:
        yield batch(rows)


def round_trip(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Write the ids of ``docs`` and read them back: ``doc_id``, ``start``, ``n_tokens`` and
    ``ids_crc32`` of the ids that the files hold."""
    found = read_ids(docs.sparkSession, write_ids(docs, tokenizer, end))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
