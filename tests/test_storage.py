import os

import pytest
from pyarrow.fs import LocalFileSystem

from treeferry.storage import ArrowStore, LocalStore, Stores, copy_bytes
from workload.standin import ObjectStandIn


@pytest.fixture(params=["local", "arrow"])
def store(request):
    return LocalStore() if request.param == "local" else ArrowStore(LocalFileSystem())


def write(path, data):
    with open(path, "wb") as file:
        file.write(data)


def test_status_and_scan(store, tmp_path):
    write(tmp_path / "f 1%20", b"abc")
    (tmp_path / ".hidden").mkdir()
    assert store.status(str(tmp_path / "f 1%20")) == ("file", 3)
    assert store.status(str(tmp_path))[0] == "directory"
    assert store.status(str(tmp_path / "none")) is None
    assert sorted(store.scan(str(tmp_path))) == [(".hidden", "directory", 0), ("f 1%20", "file", 3)]


def test_copy_and_rename(store, tmp_path):
    data = os.urandom(100_003)
    source, temp, target = (str(tmp_path / name) for name in ("source", "temp", "target"))
    write(source, data)
    with store.open_input(source) as reader, store.open_new(temp) as writer:
        assert copy_bytes(reader, writer, 4096) == len(data)
    with pytest.raises(FileExistsError):
        store.open_new(temp)
    store.rename(temp, target, replace=False)
    assert open(target, "rb").read() == data and not os.path.exists(temp)
    write(temp, b"new")
    with pytest.raises(FileExistsError):
        store.rename(temp, target, replace=False)
    store.rename(temp, target, replace=True)
    assert open(target, "rb").read() == b"new"
    with store.open_input(source, 100_000) as reader:
        assert reader.read(10) == data[100_000:]


def test_directories(store, tmp_path):
    path = str(tmp_path / "d")
    store.make_directory(path)
    with pytest.raises(FileExistsError):
        store.make_directory(path)
    write(tmp_path / "d" / "f", b"x")
    with pytest.raises(OSError):
        store.remove_directory(path)
    store.remove_file(path + "/f")
    store.remove_directory(path)
    assert store.status(path) is None


def test_open_fresh(store, tmp_path):
    write(tmp_path / "f", b"longer than what follows")
    for _ in range(2):
        with store.open_fresh(str(tmp_path / "f")) as file:
            file.write(b"new")
        assert (tmp_path / "f").read_bytes() == b"new"


def test_a_fresh_file_takes_no_removal(tmp_path, monkeypatch):
    monkeypatch.setattr(os, "remove", lambda path: pytest.fail(f"removed {path}"))
    with LocalStore().open_fresh(str(tmp_path / "f")) as file:
        file.write(b"new")
    assert (tmp_path / "f").read_bytes() == b"new"


def test_the_stand_in_locks_a_directory_little(tmp_path, monkeypatch):
    """What is not closed yet is not in the directory, and what is replaced is freed after that."""
    folder, moves = tmp_path / "root" / "raw", []
    folder.mkdir(parents=True)
    replace = os.replace

    def watched(path, target):
        old = os.path.lexists(target)
        there = os.listdir(folder)
        replace(path, target)
        held = [name for name in os.listdir("/proc/self/fd") if os.path.islink(f"/proc/self/fd/{name}") and os.readlink(f"/proc/self/fd/{name}") == f"{target} (deleted)"]
        moves.append((there, old, len(held)))

    monkeypatch.setattr(os, "replace", watched)
    store, path = ObjectStandIn(), str(folder / "f")
    for data in (b"old", b"new"):
        with store.open_fresh(path) as file:
            file.write(data)
    assert moves == [([], False, 0), (["f"], True, 1)] and (folder / "f").read_bytes() == b"new"
    with pytest.raises(FileNotFoundError):
        store.open_fresh(str(tmp_path / "none" / "f"))
    assert len(os.listdir(tmp_path / "root")) == 2
    del store, file
    assert os.listdir(tmp_path / "root") == ["raw"] and os.listdir(folder) == ["f"]


def test_ranges_of_one_file(tmp_path):
    store, data = LocalStore(), os.urandom(10_000)
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write(source, data)
    for start in (7000, 0, 3500):
        with store.open_input(source, start) as reader, store.open_range(target, start) as writer:
            assert copy_bytes(reader, writer, 512, limit=3500) == min(3500, 10_000 - start)
    assert open(target, "rb").read() == data


def test_between_local_and_arrow(tmp_path):
    local, arrow = LocalStore(), ArrowStore(LocalFileSystem())
    data = os.urandom(50_000)
    a, b, c = (str(tmp_path / name) for name in "abc")
    write(a, data)
    with local.open_input(a) as reader, arrow.open_new(b) as writer:
        copy_bytes(reader, writer, 4096)
    with arrow.open_input(b) as reader, local.open_new(c) as writer:
        copy_bytes(reader, writer, 4096)
    assert open(c, "rb").read() == data


def test_stores_by_uri():
    stores = Stores()
    store, path = stores.at("file:///a b/c%20#d")
    assert isinstance(store, LocalStore) and path == "/a b/c%20#d"
    assert stores.at("file:///")[1] == "/"
    assert stores.at("file:///x")[0] is store
