from __future__ import annotations

import io
import os
import tempfile
from urllib.error import HTTPError

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripline.contract import landed_path
from tripline.sources import (
    append_manifest,
    failed_files,
    ingest_landing,
    land_files,
    landing_files,
    manifest_latest,
    read_manifest,
    transfer,
)

CONTENT = {1: b"a" * 10, 2: b"bc" * 50_000, 3: b""}


@pytest.fixture
def published(tmp_path):
    """Monthly files January to March, and April as a folder of parts."""
    folder = tmp_path / "published"
    folder.mkdir()
    for month, content in CONTENT.items():
        (folder / f"yellow_tripdata_2023-0{month}.parquet").write_bytes(content)
    april = folder / "yellow_tripdata_2023-04.parquet"
    (april / "deep").mkdir(parents=True)
    (april / "part-0").write_bytes(b"0123456789")
    (april / "deep" / "part-1").write_bytes(b"x" * 77)
    (april / "_SUCCESS").write_bytes(b"")
    (april / ".part-0.crc").write_bytes(b"crc")
    return folder


def content(base, month) -> bytes:
    with open(landed_path(str(base), 2023, month), "rb") as file:
        return file.read()


def leftovers(base) -> list[str]:
    return [name for _, folders, names in os.walk(base) for name in folders + names if name.startswith(".")]


def run(spark, published, base, months, **options):
    files = landing_files(spark, f"file://{published}", str(base), 2023, months)
    rows = land_files(files, **options).sort("month").collect()
    assert [row.landing_path for row in rows] == [landed_path(str(base), 2023, month) for month in sorted(months)]
    return [(row.status.split(":")[0], row.file_size_bytes) for row in rows]


def test_addresses(spark):
    row = landing_files(spark, "https://data.example.org/trips/", "/lake/landing/", 2023, ["02"]).first()
    assert tuple(row) == (2023, 2, "https://data.example.org/trips/yellow_tripdata_2023-02.parquet",
                          "/lake/landing/year=2023/month=02/yellow_tripdata_2023-02.parquet")


@pytest.mark.parametrize("range_bytes", [7, 1000, 256 << 20])
def test_fetch_skip_overwrite_and_fail(spark, published, tmp_path, range_bytes):
    base = tmp_path / "landing"
    months = [1, 2, 3, 4, 6] if range_bytes > 7 else [1, 3, 4, 6]
    sizes = {1: 10, 2: 100_000, 3: 0, 4: 87}
    fetched = [("success", sizes[month]) for month in months[:-1]]
    assert run(spark, published, base, months, range_bytes=range_bytes) == [*fetched, ("failed", None)]
    for month in months[:-2]:
        assert content(base, month) == CONTENT[month]
    april = tmp_path / landed_path("landing", 2023, 4)
    assert (april / "part-0").read_bytes() == b"0123456789"
    assert (april / "deep" / "part-1").read_bytes() == b"x" * 77
    assert sorted(os.listdir(april)) == ["deep", "part-0"]

    skipped = [("skipped_already_exists", None)] * len(fetched)
    assert run(spark, published, base, months) == [*skipped, ("failed", None)]

    (published / "yellow_tripdata_2023-01.parquet").write_bytes(b"new")
    (published / "yellow_tripdata_2023-04.parquet" / "part-0").unlink()
    assert run(spark, published, base, [1, 4], overwrite=True) == [("success", 3), ("success", 77)]
    assert content(base, 1) == b"new"
    assert os.listdir(april) == ["deep"]
    assert leftovers(base) == []


def test_a_failed_overwrite_leaves_the_old_file(spark, published, tmp_path):
    base = tmp_path / "landing"
    assert run(spark, published, base, [1]) == [("success", 10)]
    (published / "yellow_tripdata_2023-01.parquet").unlink()
    assert run(spark, published, base, [1], overwrite=True) == [("failed", None)]
    assert content(base, 1) == CONTENT[1]


def test_mounted_landing_path(spark, published, tmp_path):
    files = landing_files(spark, str(published), "store:/landing", 2023, [1])
    row = land_files(files, mount=("store:", str(tmp_path))).first()
    assert row.status == "success"
    assert row.landing_path == landed_path("store:/landing", 2023, 1)
    assert content(tmp_path / "landing", 1) == CONTENT[1]


def test_manifest_grows_and_knows_the_last_attempt(spark, published, tmp_path):
    base, history = tmp_path / "landing", str(tmp_path / "manifest")
    for months in ([1, 6], [1, 6]):
        attempts = ingest_landing(spark, str(published), str(base), 2023, months, manifest_path=history)
        assert attempts.count() == 2
    (published / "yellow_tripdata_2023-06.parquet").write_bytes(b"late")
    append_manifest(land_files(landing_files(spark, str(published), str(base), 2023, [6])), history)
    manifest = spark.read.parquet(history)
    assert manifest.dtypes == [
        ("year", "int"), ("month", "int"), ("source_url", "string"), ("landing_path", "string"),
        ("status", "string"), ("file_size_bytes", "bigint"), ("ingestion_started_at", "string"),
        ("ingestion_finished_at", "string")]
    outcomes = manifest.groupBy(F.substring_index("status", ":", 1).alias("outcome")).count()
    assert dict(outcomes.collect()) == {"success": 2, "skipped_already_exists": 1, "failed": 2}
    assert manifest.where("ingestion_started_at > ingestion_finished_at").count() == 0
    last = manifest_latest(manifest).sort("month").collect()
    assert [(row.month, row.status) for row in last] == [(1, "skipped_already_exists"), (6, "success")]
    assert failed_files(manifest).count() == 0
    assert failed_files(manifest.where("status != 'success'")).select("month").collect() == [(6,)]


def test_a_run_that_is_added_again_counts_once(spark, published, tmp_path):
    """A failure after the write and before the run's end: its attempts replace themselves, others stay."""
    history = str(tmp_path / "history")
    files = landing_files(spark, f"file://{published}", str(tmp_path / "landing"), 2023, [1, 2])
    attempts = land_files(files)
    run = append_manifest(attempts, history)
    assert append_manifest(attempts, history, run) == run
    append_manifest(land_files(files), history)
    rows = spark.read.parquet(history).groupBy("status").count().collect()
    assert sorted(map(tuple, rows)) == [("skipped_already_exists", 2), ("success", 2)]
    assert read_manifest(spark, history).count() == 4
    assert len([name for name in os.listdir(history) if name.endswith(".parquet")]) == 2


def test_failure_is_described(spark, published, tmp_path):
    row = land_files(landing_files(spark, str(published), str(tmp_path / "l"), 2023, [6])).first()
    assert row.status.startswith("failed: FileNotFoundError: ") and "2023-06" in row.status


def test_repeated_attempts_of_a_task_change_nothing(tmp_path):
    source, target, staged = tmp_path / "source", tmp_path / "to" / "target", tmp_path / "to" / ".staged"
    source.write_bytes(b"0123456789")
    for offset, length in [(4, 6), (0, 4), (4, 6)]:
        assert transfer.copy_range(str(source), "", str(staged), offset, length) == (length, None)
    first = transfer.publish(str(target), str(staged), False, 10, None)
    again = transfer.publish(str(target), str(staged), False, 10, None)
    assert first[:2] == again[:2] == ("success", 10)
    assert target.read_bytes() == b"0123456789"


def test_incomplete_copies_are_not_published(tmp_path):
    source, target, staged = tmp_path / "source", tmp_path / "target", tmp_path / ".staged"
    source.write_bytes(b"0123")
    copied, error = transfer.copy_range(str(source), "", str(staged), 2, 6)
    assert copied is None and "ended after 4 bytes" in error
    assert transfer.publish(str(target), str(staged), False, 10, None)[0].startswith("failed: OSError")
    assert transfer.publish(str(target), str(staged), False, 10, error)[0] == f"failed: {error}"
    assert not staged.exists() and not target.exists()
    assert transfer.publish(str(target), str(staged), False, None, None)[0].startswith("failed: FileNotFoundError")


class Web:
    """Answers in place of a web server: one file, with or without byte ranges and a known length."""

    def __init__(self, body: bytes, ranges: bool, length: bool, head: bool = True):
        self.body, self.ranges, self.length, self.head = body, ranges, length, head
        self.asked = []

    def __call__(self, request, timeout):
        if not request.full_url.endswith("/file"):
            raise HTTPError(request.full_url, 404, "Not Found", None, None)
        if request.get_method() == "HEAD" and not self.head:
            raise HTTPError(request.full_url, 405, "Method Not Allowed", None, None)
        wanted = request.get_header("Range")
        self.asked.append((request.get_method(), wanted))
        reply = io.BytesIO(self.body)
        reply.status, reply.headers = 200, {}
        if self.length:
            reply.headers["Content-Length"] = str(len(self.body))
        if self.ranges:
            reply.headers["Accept-Ranges"] = "bytes"
            if wanted:
                first, last = wanted.removeprefix("bytes=").split("-")
                reply = io.BytesIO(self.body[int(first): int(last) + 1 if last else None])
                reply.status = 206
        return reply


@pytest.mark.parametrize("ranges", [True, False])
@pytest.mark.parametrize("length", [True, False])
def test_web_source(tmp_path, monkeypatch, ranges, length):
    web = Web(b"0123456789", ranges, length)
    monkeypatch.setattr(transfer.urllib.request, "urlopen", web)
    url, staged = "https://data.example.org/file", str(tmp_path / ".staged")
    _, kept, parts, error = transfer.inspect(url, str(tmp_path / "target"), False)
    assert (kept, parts, error) == (False, [("", 10 if length else -1, ranges and length, None)], None)
    if ranges and length:
        assert transfer.copy_range(url, "", staged, 6, 4) == (4, None)
        assert transfer.copy_range(url, "", staged, 0, 6) == (6, None)
        assert web.asked[1:] == [("GET", "bytes=6-9"), ("GET", "bytes=0-5")]
    else:
        assert transfer.copy_range(url, "", staged, 0, parts[0][1]) == (10, None)
        copied, error = transfer.copy_range(url, "", staged, 6, 4)
        assert ranges or (copied is None and "ignored the byte range" in error)
    assert transfer.publish(str(tmp_path / "target"), staged, False, 10, None)[:2] == ("success", 10)
    assert (tmp_path / "target").read_bytes() == b"0123456789"


@pytest.mark.parametrize("tag", ['"v1"', 'W/"v1"', None])
def test_ranges_are_of_one_version(tmp_path, monkeypatch, tag):
    """A server that has published the file again answers a conditional range with the whole new file."""
    sent = []

    def answer(request, timeout):
        sent.append(request.get_header("If-range"))
        reply = io.BytesIO(b"0123456789")
        reply.status, reply.headers = 200, {"Content-Length": "10", "Accept-Ranges": "bytes"} | ({"ETag": tag} if tag else {})
        return reply

    monkeypatch.setattr(transfer.urllib.request, "urlopen", answer)
    url, staged = "https://data.example.org/file", str(tmp_path / ".staged")
    _, _, [(_, size, seekable, version)], _ = transfer.inspect(url, str(tmp_path / "target"), False)
    assert (size, seekable, version) == (10, True, tag if tag == '"v1"' else None)
    copied, error = transfer.copy_range(url, "", staged, 0, 10, version)
    assert sent == [None, version]
    assert (copied, "another version" in (error or "")) == ((None, True) if version else (10, False))


def test_an_old_folder_is_put_back_when_publishing_fails(tmp_path, monkeypatch):
    target, staged = tmp_path / "target", tmp_path / ".staged"
    for folder, text in ((target, "old"), (staged, "new")):
        folder.mkdir()
        (folder / "part-0").write_text(text)
    rename = os.rename

    def failing(source, place):
        if str(source) == str(staged):
            raise OSError("disk is gone")
        rename(source, place)

    monkeypatch.setattr(os, "rename", failing)
    status, *_ = transfer.publish(str(target), str(staged), False, 3, None)
    assert status == "failed: OSError: disk is gone"
    assert (target / "part-0").read_text() == "old"


def test_an_address_that_no_task_can_write_to(spark, published):
    files = landing_files(spark, str(published), "s3a://bucket/landing", 2023, [1])
    with pytest.raises(ValueError, match="mount.*s3a://bucket/landing"):
        land_files(files)


def test_web_source_without_head(tmp_path, monkeypatch):
    monkeypatch.setattr(transfer.urllib.request, "urlopen", Web(b"0123456789", True, True, head=False))
    url, staged = "https://data.example.org/file", str(tmp_path / ".staged")
    *_, parts, error = transfer.inspect(url, str(tmp_path / "target"), False)
    assert (parts, error) == ([("", -1, False, None)], None)
    assert transfer.copy_range(url, "", staged, 0, -1) == (10, None)


def test_web_source_that_is_not_there(tmp_path, monkeypatch):
    monkeypatch.setattr(transfer.urllib.request, "urlopen", Web(b"", True, True))
    *_, parts, error = transfer.inspect("https://data.example.org/other", str(tmp_path / "target"), False)
    assert parts == [] and error.startswith("HTTPError: HTTP Error 404")


def test_local_paths():
    assert transfer.local_path("/data/a%20b#c?d") == "/data/a%20b#c?d"
    assert transfer.local_path("file:///data/a%20b") == "/data/a b"
    assert transfer.local_path("https://data.example.org/file") is None


def test_odd_names_of_parts(tmp_path):
    folder = tmp_path / "a b"
    folder.mkdir()
    (folder / "part 100%25.parquet").write_bytes(b"xyz")
    url, staged = folder.as_uri(), str(tmp_path / ".staged")
    _, _, [(part, size, *_)], error = transfer.inspect(url, str(tmp_path / "target"), False)
    assert (part, size, error) == ("part 100%25.parquet", 3, None)
    assert transfer.copy_range(url, part, staged, 0, 3) == (3, None)
    assert transfer.publish(str(tmp_path / "target"), staged, False, 3, None)[0] == "success"


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 60), st.randoms())
def test_ranges_in_any_order_make_the_file(content, step, random):
    with tempfile.TemporaryDirectory() as folder:
        source, staged = os.path.join(folder, "source"), os.path.join(folder, "to", ".staged")
        with open(source, "wb") as file:
            file.write(content)
        offsets = list(range(0, max(len(content), 1), step))
        random.shuffle(offsets)
        for offset in offsets + offsets[:1]:
            length = min(step, len(content) - offset)
            assert transfer.copy_range(source, "", staged, offset, length) == (length, None)
        target = os.path.join(folder, "to", "target")
        assert transfer.publish(target, staged, False, len(content), None)[:2] == ("success", len(content))
        with open(target, "rb") as file:
            assert file.read() == content
