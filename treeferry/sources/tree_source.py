"""A tree as a Spark data source, without a job of its own: ``scan_tree``.

Filters on ``uri`` (a prefix), ``depth`` and ``file_type`` are pushed into the walk, so directories
that cannot hold a wanted row are not opened. Planning reads the tree only until there are
directories enough for the partitions; each partition walks its own further.

Spark 4.1 keeps the filters that were pushed last with a ``load()``, for all that is read from
it, and a second query over it would get the first one's rows. So ``scan_tree`` makes a
load of its own behind which nothing is pushed further, and the format ``tree`` by itself takes
no filters over.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

from treeferry.functions.paths import DIRECTORY, FILE
from treeferry.session import default_filesystem, qualify
from treeferry.storage import Stores, escaped_name

TREE_SCHEMA = "uri string, len bigint, file_type string, depth int"
# Partitions that are wanted, and directories that planning opens for them at most.
PARTS, OPENED_WHEN_PLANNING = 64, 256
ROWS_PER_BATCH = 10_000
# Options with this prefix are settings of the filesystem, as in ``source_options``.
SETTING = "fs."


@dataclass
class Wanted:
    """What filters leave of a tree."""

    prefix: str = ""
    types: set[str] = field(default_factory=lambda: {FILE, DIRECTORY})
    least: int = 0
    most: int | None = None

    def add(self, one: Filter) -> bool:
        """Take a filter over, if it is one that is applied exactly here."""
        if one.attribute == ("uri",) and isinstance(one, StringStartsWith):
            if not (one.value.startswith(self.prefix) or self.prefix.startswith(one.value)):
                self.types = set()
            self.prefix = max(self.prefix, one.value, key=len)
        elif one.attribute == ("file_type",) and isinstance(one, EqualTo):
            self.types &= {one.value}
        elif one.attribute == ("depth",) and isinstance(one, EqualTo | LessThan | LessThanOrEqual | GreaterThan | GreaterThanOrEqual):
            if isinstance(one, EqualTo | LessThan | LessThanOrEqual):
                most = one.value - isinstance(one, LessThan)
                self.most = most if self.most is None else min(self.most, most)
            if isinstance(one, EqualTo | GreaterThan | GreaterThanOrEqual):
                self.least = max(self.least, one.value + isinstance(one, GreaterThan))
        else:
            return False
        return True

    def row(self, uri: str, file_type: str, depth: int) -> bool:
        return file_type in self.types and depth >= self.least and (self.most is None or depth <= self.most) and uri.startswith(self.prefix)

    def opens(self, uri: str, depth: int) -> bool:
        """Whether a wanted row can be below a directory."""
        below = uri.removesuffix("/") + "/"
        deep = self.most is None or depth < self.most
        return bool(self.types) and deep and (below.startswith(self.prefix) or self.prefix.startswith(below))


@dataclass
class TreePart(InputPartition):
    """Rows that planning found, or directories to walk: (URI, depth)."""

    rows: list
    directories: list


class TreeReader(DataSourceReader):
    def __init__(self, root: str, settings: dict[str, str], parts: int, push: bool = False):
        self.root, self.settings, self.parts, self.push = root, settings, parts, push
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return [one for one in filters if not (self.push and hasattr(one, "attribute") and self.wanted.add(one))]

    def _store(self):
        root = "://".join((self.root.partition("://")[0], self.root.partition("://")[2].partition("/")[0]))
        return Stores({root: self.settings})

    def _below(self, stores: Stores, uri: str, depth: int) -> Iterator[tuple]:
        """(URI, length, type, depth) of what is directly in a directory."""
        store, path = stores.at(uri)
        prefix = uri.removesuffix("/") + "/"
        for name, kind, length in store.scan(path):
            if kind in (FILE, DIRECTORY):
                yield prefix + escaped_name(name), length, kind, depth + 1

    def partitions(self) -> list[TreePart]:
        stores = self._store()
        store, path = stores.at(self.root)
        found = store.status(path)
        if found is None:
            raise FileNotFoundError(f"{self.root} does not exist")
        kind, length = found
        rows = [(self.root, length, kind, 0)] if self.wanted.row(self.root, kind, 0) else []
        todo = deque([(self.root, 0)] if kind == DIRECTORY and self.wanted.opens(self.root, 0) else [])
        opened = 0
        while todo and len(todo) < self.parts and opened < OPENED_WHEN_PLANNING and len(rows) < ROWS_PER_BATCH:
            opened += 1
            for uri, size, file_type, depth in self._below(stores, *todo.popleft()):
                if self.wanted.row(uri, file_type, depth):
                    rows.append((uri, size, file_type, depth))
                if file_type == DIRECTORY and self.wanted.opens(uri, depth):
                    todo.append((uri, depth))
        dealt = [list(todo)[i :: self.parts] for i in range(min(self.parts, len(todo)))]
        return [TreePart(rows, []), *(TreePart([], some) for some in dealt)]

    def read(self, partition: TreePart) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("uri", pa.string()), ("len", pa.int64()), ("file_type", pa.string()), ("depth", pa.int32())])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        rows, todo, stores = list(partition.rows), deque(partition.directories), self._store()
        while todo:
            for uri, size, file_type, depth in self._below(stores, *todo.popleft()):
                if self.wanted.row(uri, file_type, depth):
                    rows.append((uri, size, file_type, depth))
                if file_type == DIRECTORY and self.wanted.opens(uri, depth):
                    todo.append((uri, depth))
                if len(rows) >= ROWS_PER_BATCH:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)


class TreeSource(DataSource):
    """Options: ``path``, a URI; ``parts``, about how many partitions; ``fs.*``, the filesystem's
    settings; ``push``, whether filters are taken over (see above)."""

    @classmethod
    def name(cls) -> str:
        return "tree"

    def schema(self) -> str:
        return TREE_SCHEMA

    def reader(self, schema) -> TreeReader:
        settings = {name.removeprefix(SETTING): value for name, value in self.options.items() if name.startswith(SETTING)}
        path = self.options.get("path") or ""
        if "://" not in path:
            raise ValueError("the option path is a URI such as file:///data; tree_uri(spark, path) makes one")
        return TreeReader(path.rstrip("/") if path.count("/") > 3 else path, settings, int(self.options.get("parts", PARTS)), self.options.get("push") == "true")


def scan_tree(
    spark: SparkSession, path: str, condition: Column | None = None, parts: int = PARTS, options: dict[str, str] | None = None
) -> DataFrame:
    """``uri, len, file_type, depth`` of the files and directories at and below ``path`` for which
    ``condition`` holds, read anew by each job. Prefixes of ``uri``, ``depth`` and ``file_type`` in
    it prune the walk. ``options``: settings of the filesystem. Links and special files are left
    out; a missing root or a directory that cannot be read is an error.

    The partitions are fixed when the job is planned, so a lopsided tree makes lopsided tasks;
    ``list_tree`` spreads what is open over its tasks again and again.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TreeSource)
    root = qualify(path, *default_filesystem(spark))
    reader = spark.read.format("tree").option("path", root).option("parts", parts).option("push", "true")
    for name, value in (options or {}).items():
        reader = reader.option(SETTING + name, value)
    rows = reader.load()
    if condition is not None:
        rows = rows.where(condition)
    return rows.mapInArrow(lambda batches: batches, rows.schema)
