"""Keeping chosen rows of a table without moving the others' texts.

Filters of bounded size tell, where a row is read, that it certainly stays or certainly does not. Only the few rows that are left meet the table of what stays.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeferry.scratch import written

#: Bits of a filter, at most: 32 MiB. With keys for more than a thirty-second of them, more and
#: more rows pass that need not; the result is the same.
MOST_FILTER_BITS = 1 << 28
#: Rows that are judged and handed on at once, so that no second copy of a batch is held.
SLICE_ROWS = 256


class KeyFilter:
    """A bit for each of some binary keys; a yes may be wrong, a no never is.

    A table of the filter's words, as long as the filter at most, is the only thing that
    comes to the driver.
    """

    def __init__(self, keys: DataFrame, key: Column):
        wanted = max(1024, 32 * keys.count())
        self.bits = min(MOST_FILTER_BITS, 1 << (wanted - 1).bit_length())
        place = F.crc32(key) % self.bits
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int"))
        found = keys.select((place / 32).cast("long").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
        self.words = self._filled(found.toArrow(), self.bits)

    @staticmethod
    def _filled(found, bits: int) -> bytes:
        import numpy as np

        words = np.zeros(bits // 32, "<u4")
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype("<u4")
        return words.tobytes()

    def keeps(self, key: bytes) -> bool:
        place = zlib.crc32(key) % self.bits
        return bool(self.words[place >> 3] >> (place & 7) & 1)


def _pair(own_id: int | None, key: bytes) -> bytes:
    return b"%b:%b" % (b"" if own_id is None else str(own_id).encode(), key)


def keep_chosen(docs: DataFrame, key_of: Callable[[bytes], bytes], stays: DataFrame, contested: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` and key of the text (null: empty) are in
    ``stays``, with all their columns; of rows that repeat both, one.

    ``stays`` (``doc_id`` long, ``key`` binary) has a row for each that stays, and
    ``contested`` (``key``) every key of which some row does not: rows of other keys all stay.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(KeyFilter(contested, F.col("key")))

    def passing(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([shared.value.keeps(key) for key in batch.column(1).to_pylist()], pa.bool_()))

    # With rows whose key only looks contested: they stay as well.
    met = written(stays.select("doc_id", "key").mapInArrow(passing, "doc_id long, key binary"), "stays")
    pair = F.concat(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")), "utf-8"), F.col("key"))
    chosen = spark.sparkContext.broadcast(KeyFilter(met, pair))

    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumns(
        {"own_id": F.col(names[docs.columns.index("doc_id")]).cast("long"), "own_text": F.col(names[docs.columns.index(text)]).cast("string")}
    )
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("own_key", T.BinaryType())])

    def marked(batches: Iterator, certain: bool) -> Iterator:
        import pyarrow as pa

        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            *columns, ids, texts = batch.columns
            keys, mask = [], []
            for own_id, value in zip(ids.to_pylist(), texts, strict=True):
                own = value.as_buffer()
                key = key_of(b"" if own is None else own.to_pybytes())
                keys.append(key)
                mask.append(not shared.value.keeps(key) if certain else shared.value.keeps(key) and chosen.value.keeps(_pair(own_id, key)))
            keyed = pa.RecordBatch.from_arrays([*columns, ids, pa.array(keys, pa.binary())], names=[*batch.schema.names[:-1], "own_key"])
            yield keyed.filter(pa.array(mask, pa.bool_()))

    certain = rows.mapInArrow(lambda batches: marked(batches, True), schema)
    copies = rows.mapInArrow(lambda batches: marked(batches, False), schema).dropDuplicates(["own_key", "own_id"])
    same = (F.col("own_key") == F.col("key")) & F.col("own_id").eqNullSafe(F.col("doc_id"))
    return certain.unionByName(copies.join(met, same, "left_semi")).select(*names).toDF(*docs.columns)
