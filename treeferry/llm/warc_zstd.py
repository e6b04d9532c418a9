"""WARC archives whose records are compressed with a dictionary of their own.

Each archive begins with a skippable Zstandard frame that holds a dictionary built from its
first records; every record follows as a frame of its own, so any reader of such files can
start at any record. Of records with equal payloads one is the response and the others
revisit it without a payload.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeferry.llm.task_files import NewFile, StoredFile, new_file_folder
from treeferry.scratch import written

#: Shorter payloads are archived again, as a reference would save nothing.
LEAST_REVISITED = 100
#: What a dictionary is built from, at most, and its size.
SAMPLE_BYTES, SAMPLE_RECORD_BYTES, DICTIONARY_BYTES = 4 << 20, 64 << 10, 112 << 10
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 1 << 30
ZSTD_LEVEL = 3

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "uri string, n_records long, n_bytes long"
ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _line_safe(value: str) -> str:
    """A header's value, with what would end or break its line percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A whole WARC record. A revisit has the HTTP header with the payload's length only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    fields += [("WARC-Target-URI", _line_safe(url))] if url is not None else []
    fields += [("Page-ID", str(page_id))] if page_id is not None else []
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class ArchiveWriter:
    """Writes the records of a task. The first ones wait until a dictionary is built."""

    def __init__(self, folder: str, archive_bytes: int = ARCHIVE_BYTES):
        self.folder, self.archive_bytes = folder, archive_bytes
        self.waiting: list[bytes] = []
        self.n_waiting, self.file, self.compressor, self.dictionary = 0, None, None, None
        self.files: list[tuple[str, int, int]] = []
        self.n_records = 0

    def add(self, whole: bytes) -> None:
        if self.compressor is None:
            self.waiting.append(whole)
            self.n_waiting += len(whole)
            if self.n_waiting >= SAMPLE_BYTES:
                self._begin()
        else:
            self._write(whole)

    def _begin(self) -> None:
        import zstandard

        try:
            samples = [whole[:SAMPLE_RECORD_BYTES] for whole in self.waiting]
            self.dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1 << 10, self.n_waiting // 8)), samples)
        except zstandard.ZstdError:  # too few records to learn from
            self.dictionary = None
        self.compressor = zstandard.ZstdCompressor(level=ZSTD_LEVEL, dict_data=self.dictionary, write_checksum=True)
        for whole in self.waiting:
            self._write(whole)
        self.waiting = []

    def _write(self, whole: bytes) -> None:
        if self.file is None:
            self.file, self.n_records = NewFile(self.folder, ".warc.zst"), 0
            if self.dictionary is not None:
                own = self.dictionary.as_bytes()
                self.file.write(struct.pack("<II", DICTIONARY_FRAME, len(own)) + own)
        self.file.write(self.compressor.compress(whole))
        self.n_records += 1
        if self.file.n_bytes >= self.archive_bytes:
            self._end()

    def _end(self) -> None:
        if self.file is not None:
            self.file.close()
            self.files.append((self.file.uri, self.n_records, self.file.n_bytes))
            self.file = None

    def close(self) -> list[tuple[str, int, int]]:
        if self.compressor is None and self.waiting:
            self._begin()
        self._end()
        return self.files


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode().partition(":")
        found[name.lower()] = value.strip()
    return found


def read_records(uri: str) -> Iterator[tuple[dict[str, str], int, str, bytes]]:
    """(headers, payload's length, its digest, payload) of each record. The digest is taken
    of the payload that was read; a revisit's length and digest come from its headers."""
    import zstandard

    file = StoredFile(uri)
    start = file.read(8)
    dictionary = None
    if len(start) == 8 and struct.unpack("<I", start[:4])[0] == DICTIONARY_FRAME:
        dictionary = zstandard.ZstdCompressionDict(file.read(struct.unpack("<I", start[4:])[0]))
    else:
        file.seek(0)
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(file, read_across_frames=True), 1 << 16)
    while version := stream.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError(f"{uri}: no record where one must begin")
        headers = _headers(stream)
        left = int(headers["content-length"])
        block = io.BytesIO(stream.read(left))
        block.readline()
        http = _headers(block)
        payload, told = block.read(), headers["warc-payload-digest"].removeprefix("sha256:")
        if headers["warc-type"] == "revisit":
            yield headers, int(http["content-length"]), told, b""
        else:
            digest = hashlib.sha256(payload).hexdigest()
            if digest != told or len(payload) != int(http["content-length"]):
                raise ValueError(f"{uri}: a payload differs from its digest")
            yield headers, len(payload), digest, payload
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{uri}: a record does not end")
    file.close()


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest``, ``refers_to`` (null for responses).

    Equal payloads are counted before anything is shuffled by them, and only the digests
    that repeat are joined; a payload of a third of all pages is a skewed join's key, which
    Spark splits.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html")).withColumn("digest", F.sha2("html", 256))
    long = rows.where(F.octet_length("html") >= LEAST_REVISITED)
    counts = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = written(counts.where("n > 1 AND first IS NOT NULL").drop("n"), "first-pages")
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    return rows.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive every row of ``pages``; a table of the archives: ``uri``, ``n_records``, ``n_bytes``.

    A null ``html`` is an empty payload, a null ``url`` leaves its header out. Of equal
    payloads of at least 100 bytes the smallest ``page_id`` is the response, as is any row
    that repeats that id; where no equal payload has an id, all are responses.
    """
    folder = folder or new_file_folder(pages.sparkSession, "warc")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        writer = ArchiveWriter(folder, archive_bytes)
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*batch.columns, strict=True):
                first = refers_to.as_py()
                writer.add(record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), digest.as_py(), first, first is not None, date))
        files = writer.close()
        if files:
            uris, records, sizes = zip(*files, strict=True)
            yield pa.RecordBatch.from_pydict({"uri": uris, "n_records": records, "n_bytes": sizes})

    return written(plan_records(pages).mapInArrow(write, FILES), "archives")


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, and with ``with_payload`` the ``payload``."""

    def read(batches: Iterable) -> Iterator:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield from _batches(read_records(uri), with_payload)

    # Numbered by one task, which sees a name for each archive, so that each has a task of its own.
    named = files.select("uri").coalesce(1).select("uri", F.monotonically_increasing_id().cast("int").alias("number"))
    tasks = named.repartitionById(max(1, files.count()), "number").select("uri")
    return tasks.mapInArrow(read, ROWS + (", payload binary" if with_payload else ""))


def _batches(records: Iterator, with_payload: bool, batch_rows: int = 1000, batch_bytes: int = 8 << 20) -> Iterator:
    import pyarrow as pa

    def batch(rows):
        columns = list(zip(*rows, strict=True))
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
        own = list(kinds.items())[: 6 if with_payload else 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, own, strict=False)], names=[n for n, _ in own])

    number = lambda value: None if value is None else int(value)
    rows, size = [], 0
    for headers, n_bytes, digest, payload in records:
        rows.append((number(headers.get("page-id")), n_bytes, digest, headers["warc-type"], number(headers.get("refers-to-page-id")), payload))
        size += len(payload) if with_payload else 0
        if len(rows) >= batch_rows or size >= batch_bytes:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_REVISITED} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_REVISITED} AND page_id <> first THEN first END AS refers_to FROM f
"""
