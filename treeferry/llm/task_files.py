"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from treeferry.scratch import new_folder
from treeferry.session import qualified
from treeferry.storage import Stores, make_directories


def new_file_folder(spark: SparkSession, name: str) -> str:
    """A new, existing folder that the driver and all executors share, as a URI."""
    folder = qualified(spark, new_folder(spark, name))[0]
    make_directories(folder)
    return folder


class NewFile:
    """A file under a name that no other attempt uses.

    A task that is lost leaves a file that no row names: readers take the files' names from
    the rows of tasks that ended well, never from a listing.
    """

    def __init__(self, folder: str, suffix: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
        store, path = Stores().at(self.uri)
        self._file = store.open_new(path)
        self.n_bytes = 0

    def write(self, data: bytes) -> None:
        view = memoryview(data)
        while len(view):
            view = view[self._file.write(view) :]
        self.n_bytes += len(data)

    def close(self) -> None:
        self._file.close()


class StoredFile:
    """A finished file, read from any place."""

    def __init__(self, uri: str):
        store, path = Stores().at(uri)
        self._file = store.open_input(path)
        self._open_at = lambda offset: store.open_input(path, offset)

    def read(self, n_bytes: int) -> bytes:
        parts = []
        while n_bytes:
            part = self._file.read(n_bytes)
            if not part:
                break
            parts.append(part)
            n_bytes -= len(part)
        return b"".join(parts)

    def seek(self, offset: int) -> None:
        self._file.close()
        self._file = self._open_at(offset)

    def close(self) -> None:
        self._file.close()
