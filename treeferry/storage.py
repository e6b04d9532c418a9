"""The few filesystem calls that tasks make, on local mounts and through pyarrow.

A store takes plain decoded paths. ``Stores`` turns the URIs of the tables into a
store and a path; one is made per task, so clients are shared inside a task.
"""

from __future__ import annotations

import contextlib
import os
import re
import stat
from collections.abc import Callable, Iterator
from urllib.parse import urlencode

# Scheme spellings of Hadoop connectors that pyarrow names differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}
# pyarrow's names of filesystems whose files appear when they are closed, and
# the bytes of a file that one server-side copy, and so a move, can take there.
OBJECT_STORES = ("s3", "gcs", "abfs")
LARGEST_MOVES = {"s3": 5 << 30}


class LocalStore:
    """``file:`` trees, such as a mount that all executors share."""

    replaces_atomically = True
    appears_when_closed = False
    largest_move: int | None = None
    #: Whether ``scan`` can read some of the names for less than the whole directory.
    splits_directories = True

    def status(self, path: str) -> tuple[str, int] | None:
        """(``file`` | ``directory`` | ``other``, length), or None where nothing is."""
        try:
            found = os.stat(path)
        except (FileNotFoundError, NotADirectoryError):
            return None
        if stat.S_ISDIR(found.st_mode):
            return "directory", 0
        return ("file" if stat.S_ISREG(found.st_mode) else "other"), found.st_size

    def names(self, path: str) -> Iterator[str]:
        """The names in a directory as it is read, without asking for anything else."""
        with os.scandir(path) as entries:
            for entry in entries:
                yield entry.name

    def scan(self, path: str, wanted: Callable[[str], bool] | None = None) -> Iterator[tuple[str, str, int]]:
        """(name, type, length) of each direct entry, as the directory is read: of those whose
        name is ``wanted``, if that is given; nothing is asked about others. A symbolic link is
        of type ``link`` and never followed, which also rules out cycles."""
        with os.scandir(path) as entries:
            for entry in entries:
                if wanted and not wanted(entry.name):
                    continue
                if entry.is_symlink():
                    yield entry.name, "link", 0
                elif entry.is_dir(follow_symlinks=False):
                    yield entry.name, "directory", 0
                elif entry.is_file(follow_symlinks=False):
                    yield entry.name, "file", entry.stat(follow_symlinks=False).st_size
                else:
                    yield entry.name, "other", 0

    def follow(self, path: str) -> tuple[str, int] | None:
        """(type, length) of what a symbolic link leads to in the end, or None if that is
        nothing. A link to a directory that the link is in, by device and inode, is an error."""
        try:
            target = os.stat(path)
        except FileNotFoundError:
            return None
        if stat.S_ISDIR(target.st_mode):
            above = os.path.dirname(path)
            while True:
                own = os.stat(above)
                if (own.st_dev, own.st_ino) == (target.st_dev, target.st_ino):
                    raise OSError("the link leads back to a directory that it is in")
                if above == os.path.dirname(above):
                    break
                above = os.path.dirname(above)
        return self.status(path)

    def make_directory(self, path: str) -> None:
        os.mkdir(path)

    def open_input(self, path: str, offset: int = 0):
        file = open(path, "rb", buffering=0)
        file.seek(offset)
        return file

    def open_new(self, path: str):
        return open(path, "xb", buffering=0)

    def open_fresh(self, path: str):
        """Open a temporary file, in place of what may have been left under its name. Mostly
        nothing was: a removal would lock the directory for nothing."""
        with contextlib.suppress(FileExistsError):
            return self.open_new(path)
        with contextlib.suppress(FileNotFoundError):
            os.remove(path)
        return self.open_new(path)

    def truncate(self, path: str, length: int) -> None:
        os.truncate(path, length)

    def open_range(self, path: str, offset: int):
        """Open for writing from ``offset`` on, next to writers of other ranges."""
        file = os.fdopen(os.open(path, os.O_CREAT | os.O_WRONLY, 0o666), "wb", buffering=0)
        file.seek(offset)
        return file

    def rename(self, path: str, target: str, replace: bool) -> None:
        """Put a finished file in place; a replaced file is never absent meanwhile."""
        if not replace and os.path.lexists(target):
            raise FileExistsError(f"{target} already exists")
        os.replace(path, target)

    def remove_file(self, path: str) -> None:
        os.remove(path)

    def remove_directory(self, path: str) -> None:
        """Remove a directory that is empty."""
        os.rmdir(path)

    def is_link(self, path: str) -> bool:
        return os.path.islink(path)


class ArrowStore:
    """Any filesystem that pyarrow reaches: HDFS and the object stores.

    In an object store a file is seen once its writer is closed, also when that is because a
    read failed, and a move is a copy inside the store that takes the target's place whole.
    pyarrow lists a directory in one piece and takes no range of names.
    """

    splits_directories = False

    def __init__(self, filesystem):
        self.filesystem = filesystem
        self.appears_when_closed = filesystem.type_name in OBJECT_STORES
        self.replaces_atomically = self.appears_when_closed
        self.largest_move = LARGEST_MOVES.get(filesystem.type_name)

    @staticmethod
    def _kind(info) -> str:
        return "directory" if not info.is_file and info.type.name == "Directory" else (
            "file" if info.is_file else "other"
        )

    def status(self, path: str) -> tuple[str, int] | None:
        info = self.filesystem.get_file_info(path)
        if info.type.name == "NotFound":
            return None
        return self._kind(info), info.size or 0

    def scan(self, path: str, wanted: Callable[[str], bool] | None = None) -> Iterator[tuple[str, str, int]]:
        from pyarrow.fs import FileSelector

        for info in self.filesystem.get_file_info(FileSelector(path)):
            if not wanted or wanted(info.base_name):
                yield info.base_name, self._kind(info), info.size or 0

    def make_directory(self, path: str) -> None:
        if self.status(path):
            raise FileExistsError(f"{path} already exists")
        self.filesystem.create_dir(path, recursive=False)

    def open_input(self, path: str, offset: int = 0):
        if not offset:
            return self.filesystem.open_input_stream(path, compression=None)
        file = self.filesystem.open_input_file(path)
        file.seek(offset)
        return file

    def open_new(self, path: str):
        if self.status(path):
            raise FileExistsError(f"{path} already exists")
        return self.filesystem.open_output_stream(path, compression=None)

    def open_fresh(self, path: str):
        return self.filesystem.open_output_stream(path, compression=None)

    def rename(self, path: str, target: str, replace: bool) -> None:
        """Put a finished file in place. Where a move cannot replace, the target is absent for
        a moment; ``recover_copies`` finishes what a crash leaves then."""
        if not (replace and self.replaces_atomically) and self.status(target):
            if not replace:
                raise FileExistsError(f"{target} already exists")
            self.filesystem.delete_file(target)
        self.filesystem.move(path, target)

    def remove_file(self, path: str) -> None:
        self.filesystem.delete_file(path)

    def remove_directory(self, path: str) -> None:
        """Remove a directory that is empty."""
        if next(self.scan(path), None):
            raise OSError(f"{path} is not empty")
        self.filesystem.delete_dir(path)

    def is_link(self, path: str) -> bool:
        return False


# Marks a byte of a name that is not UTF-8: the mark and two hexadecimal digits. A character of
# the private range, so real names hardly have it; where one does, its bytes are marked too.
MARK = "\uf8fe"
_MARKED = re.compile(f"{MARK}([0-9a-f]{{2}})")
# What stands for such bytes in the names that the system gives, and the mark itself.
_HELD_OTHERWISE = re.compile(f"[\udc80-\udcff{MARK}]")
_MARKS = {chr(0xDC00 + byte): f"{MARK}{byte:02x}" for byte in range(0x80, 0x100)}
_MARKS[MARK] = "".join(f"{MARK}{byte:02x}" for byte in MARK.encode())


def escaped_name(name: str) -> str:
    """A name as the system gives it, in a form that a table can hold: bytes that are not UTF-8
    are marked. ``plain_path`` gives the name back."""
    return name if name.isascii() else _HELD_OTHERWISE.sub(lambda found: _MARKS[found[0]], name)


def plain_path(path: str) -> str:
    """A path with its marked bytes as the system takes them."""
    if MARK not in path:
        return path
    data = b"".join(bytes.fromhex(part) if i % 2 else part.encode("utf-8", "surrogateescape") for i, part in enumerate(_MARKED.split(path)))
    return data.decode("utf-8", "surrogateescape")


def within(name: str, low: str | None, high: str | None) -> bool:
    return (low is None or name >= low) and (high is None or name < high)


def root_of(uri: str) -> str:
    """``scheme://authority`` of a URI."""
    scheme, _, rest = uri.partition("://")
    return f"{scheme}://{rest.partition('/')[0]}"


class Stores:
    """Stores by scheme and authority, for ``scheme://authority/path`` URIs.

    ``options``: by scheme and authority, the settings that ``pyarrow.fs`` takes in a URI,
    such as ``{"s3://bucket": {"endpoint_override": "host:9000", "region": "x"}}``. For a
    filesystem that pyarrow does not know, the setting ``store`` is a function that returns an
    object with the methods of ``LocalStore``; it is called in the tasks.
    """

    def __init__(self, options: dict[str, dict] | None = None):
        self._options = options or {}
        self._opened: dict[str, tuple[object, str]] = {}

    def at(self, uri: str) -> tuple[object, str]:
        scheme, _, rest = uri.partition("://")
        authority, slash, path = rest.partition("/")
        root = f"{scheme}://{authority}"
        if root not in self._opened:
            self._opened[root] = self._open(scheme, authority, self._options.get(root, {}))
        store, base = self._opened[root]
        # Where names are bytes, marked bytes are bytes again; elsewhere a name is text, as marked.
        return store, plain_path(slash + path) if isinstance(store, LocalStore) else base + slash + path

    @staticmethod
    def _open(scheme: str, authority: str, options: dict[str, str]) -> tuple[object, str]:
        if options.get("store"):
            return options["store"](), ""
        if scheme == "file":
            return LocalStore(), ""
        from pyarrow.fs import FileSystem

        settings = "?" + urlencode(options) if options else ""
        root = f"{ARROW_SCHEMES.get(scheme, scheme)}://{authority}/"
        try:
            opened, base = FileSystem.from_uri(root + settings)
        except Exception as error:  # its text may hold the settings, and with them secrets
            told = str(error).replace(root + settings, root)
            for secret in filter(None, map(str, options.values())):
                told = told.replace(secret, "***").replace(urlencode({"": secret})[1:], "***")
            raise OSError(f"cannot open {root}: {told}") from None
        return ArrowStore(opened), base.rstrip("/")


def make_directories(uri: str, options: dict[str, dict[str, str]] | None = None) -> None:
    """Make a directory and the parents that it lacks, from the driver."""
    store, path = Stores(options).at(uri)
    missing = []
    while path != "/" and not store.status(path):
        missing.append(path)
        path = split_parent(path)[0]
    for path in reversed(missing):
        store.make_directory(path)


def split_parent(path: str) -> tuple[str, str]:
    parent, _, name = path.rpartition("/")
    return parent or "/", name


def copy_bytes(source, target, buffer_bytes: int, limit: int | None = None) -> int:
    """Stream ``source`` into ``target``, at most ``limit`` bytes; the bytes written.

    Between two local files the kernel moves the bytes; elsewhere one buffer is in
    memory at a time.
    """
    in_kernel = hasattr(os, "copy_file_range") and _is_plain(source) and _is_plain(target)
    written = 0
    while limit is None or written < limit:
        wanted = buffer_bytes if limit is None else min(buffer_bytes, limit - written)
        if in_kernel:
            try:
                moved = os.copy_file_range(source.fileno(), target.fileno(), wanted)
            except OSError:
                in_kernel = False
                continue
            if moved:
                written += moved
                continue
            if written:
                break
            in_kernel = False  # an empty file, or one whose filesystem has to be read
        chunk = source.read(wanted)
        if not chunk:
            break
        view = memoryview(chunk)
        while len(view):
            view = view[target.write(view) :]
        written += len(chunk)
    return written


def _is_plain(file) -> bool:
    import io

    return isinstance(file, io.FileIO)
