"""Small column helpers that several operators share."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ASCII letters, for lower-casing those alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_of(frame: DataFrame, name: str = "text") -> Column:
    """A text column as a non-null string."""
    return F.coalesce(frame[name].cast("string"), F.lit(""))


class LiteralIndex:
    """A small table in the plan: string keys to arrays of structs, found by hashing.

    The entries travel as one constant, so only parameters belong in here, never data
    that grow with the input. A look-up compares the few keys of one bucket.
    """

    def __init__(self, entries: dict[str, list[dict]], fields: str):
        self.buckets = max(1, 2 * len(entries))
        table: list[list[dict]] = [[] for _ in range(self.buckets)]
        for key, values in entries.items():
            table[zlib.crc32(key.encode()) % self.buckets].append({"key": key, "values": values})
        schema = f"array<array<struct<key:string,values:array<struct<{fields}>>>>>"
        self.column = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), schema)

    def find(self, key: Column) -> Column:
        """The values of a non-null key; an empty array for a key that is not there."""
        bucket = F.get(self.column, F.pmod(F.crc32(key), F.lit(self.buckets)).cast("int"))
        return F.flatten(F.transform(F.filter(bucket, lambda e: e["key"] == key), lambda e: e["values"]))
