"""Spark's file system layer, as the driver sees it: metadata, renames and the ends of files, never whole contents."""

from __future__ import annotations

import io
from typing import NamedTuple

from pyspark.sql import SparkSession


class FileState(NamedTuple):
    """What tells one state of a file from another; the time is in milliseconds."""

    path: str
    length: int
    modified: int


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _located(spark, path)
    return files.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, where = _located(spark, path)
    return files.exists(where) and files.getFileStatus(where).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    files, where = _located(spark, path)
    files.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, where = _located(spark, path)
    files.mkdirs(where)


def rename(spark: SparkSession, path: str, target: str) -> None:
    files, where = _located(spark, path)
    if not files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{path} could not be renamed to {target}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a marker."""
    files, where = _located(spark, path)
    files.create(where, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    files, where = _located(spark, path)
    return [state.getPath().getName() for state in files.listStatus(where)] if files.exists(where) else []


def file_states(spark: SparkSession, path: str) -> list[FileState]:
    """The files below a folder, or the one at the path, in order; hidden ones and those in hidden folders are left out."""
    files, where = _located(spark, path)
    found, listing = [], files.listFiles(where, True)
    root = files.getFileStatus(where).getPath().toString()
    while listing.hasNext():
        state = listing.next()
        name = state.getPath().toString()
        if not any(part[:1] in ("_", ".") for part in name[len(root) :].split("/")):
            found.append(FileState(name, state.getLen(), state.getModificationTime()))
    return sorted(found)


class DriverFile(io.RawIOBase):
    """A file of any storage that Spark reads, opened by the driver: for footers, which are a few reads at the end."""

    def __init__(self, spark: SparkSession, path: str):
        files, where = _located(spark, path)
        self._size = files.getFileStatus(where).getLen()
        self._stream, self._at = files.open(where), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self._at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self._at, io.SEEK_END: self._size}[whence]
        return self._at

    def read(self, size: int = -1) -> bytes:
        size = self._size - self._at if size is None or size < 0 else min(size, self._size - self._at)
        if size <= 0:
            return b""
        self._stream.seek(self._at)
        data = bytes(self._stream.readNBytes(size))
        self._at += len(data)
        return data

    def close(self) -> None:
        if not self.closed:
            self._stream.close()
        super().close()
