"""Byte copies done inside Spark tasks: find out what to copy, copy one range, publish a finished file.

Every function may run more than once for the same row, because Spark retries tasks: a range is written at
its own offset of a hidden staging file, and publishing is a rename that a second attempt recognises.
"""

from __future__ import annotations

import os
import shutil
import urllib.error
import urllib.request
from datetime import datetime, timezone
from urllib.parse import unquote, urlsplit

_CHUNK = 1 << 20
_HEADERS = {"User-Agent": "Mozilla/5.0"}
_NO_HEAD = (403, 405, 501)  # answers of servers that serve a file but not its size alone
_SILENCE = 300  # seconds without an answer after which a web source counts as failed


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


def local_path(url: str) -> str | None:
    """The file system path behind a ``file:`` address or a plain path, else None."""
    parts = urlsplit(url)
    if parts.scheme == "file":
        return unquote(parts.path)
    return None if parts.scheme else url


def _describe(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _parts_of_folder(folder: str) -> list[tuple[str, int, bool, None]]:
    found = []
    for parent, folders, names in os.walk(folder):
        folders[:] = [name for name in folders if name[0] not in "._"]
        for name in names:
            if name[0] not in "._":
                path = os.path.join(parent, name)
                found.append((os.path.relpath(path, folder), os.path.getsize(path), True, None))
    if not found:
        raise FileNotFoundError(f"no files in {folder}")
    return sorted(found)


def _parts_of_source(url: str) -> list[tuple[str, int, bool, str | None]]:
    """(name below the source, size or -1, can be read from an offset, version); the name of a plain file is empty.

    The version is what a web server calls this state of the file, if it does, so that ranges are of one state.
    """
    path = local_path(url)
    if path is not None:
        return _parts_of_folder(path) if os.path.isdir(path) else [("", os.path.getsize(path), True, None)]
    request = urllib.request.Request(url, headers=_HEADERS, method="HEAD")
    try:
        with urllib.request.urlopen(request, timeout=_SILENCE) as reply:
            size = int(reply.headers.get("Content-Length") or -1)
            version = reply.headers.get("ETag") or reply.headers.get("Last-Modified")
            # A weak tag does not promise equal bytes, and no server compares ranges by it.
            version = None if version is None or version.startswith("W/") else version
            return [("", size, size >= 0 and reply.headers.get("Accept-Ranges") == "bytes", version)]
    except urllib.error.HTTPError as refusal:
        if refusal.code not in _NO_HEAD:
            raise
        return [("", -1, False, None)]


def inspect(url: str, target: str, overwrite: bool):
    """(started, is the target kept, parts, error) of one monthly file."""
    started = utc_now()
    if os.path.exists(target) and not overwrite:
        return started, True, [], None
    try:
        return started, False, _parts_of_source(url), None
    except Exception as error:
        return started, False, [], _describe(error)


def _open_range(url: str, part: str, offset: int, length: int, version: str | None):
    path = local_path(url)
    if path is not None:
        source = open(os.path.join(path, part) if part else path, "rb")
        source.seek(offset)
        return source
    headers = dict(_HEADERS)
    if offset > 0 or length >= 0:
        headers["Range"] = f"bytes={offset}-{'' if length < 0 else offset + length - 1}"
        if version is not None:
            headers["If-Range"] = version
    reply = urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=_SILENCE)
    if reply.status != 206 and (offset > 0 or "If-Range" in headers):
        reply.close()
        raise OSError(f"the server ignored the byte range at {offset}, or has another version of the file")
    return reply


def copy_range(url: str, part: str | None, staged: str, offset: int, length: int, version: str | None = None):
    """Copy ``length`` bytes (all that follow, if negative); returns (bytes copied, error). No part, no copy."""
    if part is None:
        return None, None
    try:
        target = os.path.join(staged, part) if part else staged
        os.makedirs(os.path.dirname(target), exist_ok=True)
        copied = 0
        if length == 0:
            open(target, "ab").close()
            return 0, None
        with _open_range(url, part, offset, length, version) as source:
            with open(os.open(target, os.O_WRONLY | os.O_CREAT, 0o644), "wb") as output:
                output.seek(offset)
                while length < 0 or copied < length:
                    chunk = source.read(_CHUNK if length < 0 else min(_CHUNK, length - copied))
                    if not chunk:
                        break
                    output.write(chunk)
                    copied += len(chunk)
        if copied < length:
            raise OSError(f"the source ended after {offset + copied} bytes")
        return copied, None
    except Exception as error:
        return None, _describe(error)


def _bytes_below(path: str) -> int:
    if not os.path.isdir(path):
        return os.path.getsize(path)
    return sum(part[1] for part in _parts_of_folder(path))


def _remove(path: str) -> None:
    try:
        shutil.rmtree(path) if os.path.isdir(path) else os.remove(path)
    except OSError:
        pass


def publish(target: str, staged: str, kept: bool, size: int | None, error: str | None):
    """Put the staged file in the target's place; returns (status, size, finished)."""
    if kept:
        return "skipped_already_exists", None, utc_now()
    try:
        if error is not None:
            _remove(staged)
            return f"failed: {error}", None, utc_now()
        if os.path.exists(staged):
            if _bytes_below(staged) != size:
                raise OSError(f"{_bytes_below(staged)} bytes were staged, {size} were copied")
            if os.path.isdir(staged) or os.path.isdir(target):
                previous = f"{staged}.previous"
                if os.path.exists(target):
                    os.rename(target, previous)
                try:
                    os.rename(staged, target)
                except OSError:
                    if os.path.exists(previous):
                        os.rename(previous, target)
                    raise
                _remove(previous)
            else:
                os.replace(staged, target)
        elif not os.path.exists(target) or _bytes_below(target) != size:
            raise FileNotFoundError(f"nothing was staged for {target}")
        return "success", size, utc_now()
    except Exception as failure:
        return f"failed: {_describe(failure)}", None, utc_now()
