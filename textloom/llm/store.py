"""Plain files in the shared store, written and read by tasks: any store that pyarrow can open by URI."""

from __future__ import annotations

import mmap
import posixpath

import pyarrow.fs as pafs


def open_store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder URI or local path, and the path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def make_folder(folder: str) -> None:
    fs, path = open_store(folder)
    fs.create_dir(path, recursive=True)


def keep_only(folder: str, names: set[str]) -> None:
    """Remove what lost or repeated task attempts have left beside the files in ``names``."""
    fs, path = open_store(folder)
    for info in fs.get_file_info(pafs.FileSelector(path)):
        if info.is_file and info.base_name not in names:
            fs.delete_file(info.path)


def create(folder: str, name: str):
    """A new binary file to write to. Names must hold the task attempt, so that attempts never share a file."""
    fs, path = open_store(folder)
    return fs.open_output_stream(posixpath.join(path, name), compression=None)


class RangeReader:
    """Reads byte ranges of a file: memory-mapped when it is local, by range requests otherwise."""

    def __init__(self, folder: str, name: str):
        fs, path = open_store(folder)
        full = posixpath.join(path, name)
        self.data = self.file = None
        if isinstance(fs, pafs.LocalFileSystem):
            with open(full, "rb") as f:
                size = f.seek(0, 2)
                self.data = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)) if size else memoryview(b"")
        else:
            self.file = fs.open_input_file(full)

    def read(self, start: int, length: int):
        if self.data is not None:
            return self.data[start : start + length]
        return memoryview(self.file.read_at(length, start))
