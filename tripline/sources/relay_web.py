"""Parquet files behind web addresses, read in ranges: footers by the driver, row groups by tasks."""

from __future__ import annotations

import io
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq

_HEADERS = {"User-Agent": "Mozilla/5.0"}
_SILENCE = 300  # seconds without an answer after which a web source counts as failed


class WebFile(io.RawIOBase):
    """A file of one version behind a web address that serves byte ranges."""

    def __init__(self, url: str, version: str | None = None):
        request = urllib.request.Request(url, headers=_HEADERS, method="HEAD")
        with urllib.request.urlopen(request, timeout=_SILENCE) as reply:
            self.size = int(reply.headers.get("Content-Length") or -1)
            ranges = reply.headers.get("Accept-Ranges") == "bytes"
            found = reply.headers.get("ETag") or reply.headers.get("Last-Modified")
        if self.size < 0 or not ranges:
            raise OSError(f"{url} cannot be read in ranges")
        if version is not None and found != version:
            raise OSError(f"{url} has changed since it was first seen")
        self.url, self.version, self.at = url, found, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence]
        return self.at

    def read(self, size: int = -1) -> bytes:
        size = self.size - self.at if size is None or size < 0 else min(size, self.size - self.at)
        if size <= 0:
            return b""
        headers = _HEADERS | {"Range": f"bytes={self.at}-{self.at + size - 1}"}
        if self.version is not None and not self.version.startswith("W/"):
            headers["If-Range"] = self.version
        with urllib.request.urlopen(urllib.request.Request(self.url, headers=headers), timeout=_SILENCE) as reply:
            if reply.status != 206:
                raise OSError(f"{self.url} did not serve the bytes from {self.at}")
            data = reply.read()
        if len(data) != size:
            raise OSError(f"{self.url} ended after {self.at + len(data)} bytes")
        self.at += size
        return data


def opened(url: str, version: str | None = None) -> tuple[pq.ParquetFile, WebFile]:
    file = WebFile(url, version)
    return pq.ParquetFile(pa.PythonFile(file, mode="r")), file


def row_groups(url: str, version: str | None, schema: pa.Schema):
    """Reads the row groups that the rows of a task name, in the given types."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            for group in batch.column("group").to_pylist():
                file = file or opened(url, version)[0]
                for rows in file.iter_batches(row_groups=[group]):
                    # Nanoseconds become microseconds, as when Spark reads them; no other type gets narrower.
                    yield from pa.Table.from_batches([rows]).select(schema.names).cast(schema, safe=False).to_batches()

    return read
