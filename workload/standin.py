"""A store that behaves like an object store, over a local mount: for queries and tests."""

from __future__ import annotations

import contextlib
import io
import os
import shutil
import tempfile
import uuid
import weakref

from treeferry.storage import LocalStore


class _Published(io.BytesIO):
    """A file that is seen under its name once it is closed, however that comes about."""

    def __init__(self, path: str, uploads: str):
        super().__init__()
        self.path, self.uploads = path, uploads

    def close(self) -> None:
        if not self.closed:
            hidden = f"{self.uploads}/{uuid.uuid4().hex}"
            with open(hidden, "wb") as file:
                file.write(self.getvalue())
            _put(hidden, self.path)
        super().close()


def _put(hidden: str, path: str) -> None:
    """Put a written file in place. What it replaces is held meanwhile, so its blocks are freed
    when it is let go, and not while the directory is locked for all other tasks."""
    with contextlib.ExitStack() as held:
        with contextlib.suppress(FileNotFoundError):
            held.callback(os.close, os.open(path, os.O_PATH | os.O_NOFOLLOW))
        os.replace(hidden, path)


class _Breaks(io.BytesIO):
    """A file whose connection breaks half-way."""

    def read(self, size=-1):
        if self.tell() >= len(self.getvalue()) // 2:
            raise OSError("the connection broke")
        return super().read(min(size, max(1, len(self.getvalue()) // 2)))


class ObjectStandIn(LocalStore):
    """Files appear when closed, a move copies. Files called ``broken...`` cannot be read to
    their end, those called ``changed...`` are listed with a byte too many."""

    appears_when_closed = True

    def __init__(self):
        self._uploads: dict[int, str] = {}

    def _publish(self, path: str) -> _Published:
        """A file whose bytes wait in a folder of this store alone, beside the directory that it
        is for: tasks that write to one directory lock it only to put files in place."""
        folder = os.path.dirname(path)
        device = os.stat(folder).st_dev
        if device not in self._uploads:
            above = os.path.dirname(folder)
            beside = above if os.stat(above).st_dev == device else folder
            self._uploads[device] = tempfile.mkdtemp(prefix=".uploads-", dir=beside)
            weakref.finalize(self, shutil.rmtree, self._uploads[device], ignore_errors=True)
        return _Published(path, self._uploads[device])

    def scan(self, path, wanted=None):
        for name, kind, length in super().scan(path, wanted):
            yield name, kind, length + name.startswith("changed")

    def open_input(self, path, offset=0):
        if os.path.basename(path).startswith("broken"):
            with open(path, "rb") as file:
                return _Breaks(file.read())
        return super().open_input(path, offset)

    def open_new(self, path):
        if os.path.lexists(path):
            raise FileExistsError(path)
        return self._publish(path)

    def open_fresh(self, path):
        return self._publish(path)

    def rename(self, path, target, replace):
        with self._publish(target) as file, open(path, "rb") as reader:
            shutil.copyfileobj(reader, file)
        os.remove(path)


class HealedStandIn(ObjectStandIn):
    """The same store when nothing breaks any more."""

    def scan(self, path, wanted=None):
        return LocalStore.scan(self, path, wanted)

    def open_input(self, path, offset=0):
        return LocalStore.open_input(self, path, offset)
