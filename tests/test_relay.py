"""Landing by rows, into storage that only Spark opens."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_fetch import Web
from tripline.contract import landed_path
from tripline.plans import registry
from tripline.plans.standin import Standin
from tripline.sources import ingest_landing, landing_files, landing_types, read_landing, relay, relay_files, relay_web
from tripline.sources.filesystem import exists


@pytest.fixture(scope="module")
def published(spark):
    return Standin.of(spark, "/root/testdata/sf0.001").landing


@pytest.fixture
def base(tmp_path):
    return f"viewfs://trips{tmp_path}/landing"


def files_of(spark, published, base, months):
    found = landing_files(spark, "x", base, 2023, months)
    return found.withColumn("source_url", F.replace("landing_path", F.lit(base), F.lit(published)))


def statuses(manifest):
    return [row.status.split(":")[0] for row in manifest.sort("month").collect()]


def content(spark, base, months):
    return sorted(map(tuple, read_landing(spark, base, months=months).drop("source_file", "raw_loaded_at").collect()), key=repr)


def types(spark, base, months):
    return {tuple(row) for row in landing_types(spark, base, months=months).drop("path").collect()}


def test_fetch_skip_overwrite_and_fail(spark, published, base):
    files = files_of(spark, published, base, [1, 2, 6])
    first = relay_files(files)
    assert statuses(first) == ["success", "success", "failed"]
    assert all(row.file_size_bytes > 0 for row in first.where("month < 3").collect())
    assert statuses(relay_files(files)) == ["skipped_already_exists"] * 2 + ["failed"]
    assert statuses(relay_files(files, overwrite=True)) == ["success", "success", "failed"]
    assert content(spark, base, [1, 2]) == content(spark, published, [1, 2])
    assert types(spark, base, [1, 2]) == types(spark, published, [1, 2])  # they still drift
    left = [name for _, folders, names in os.walk(base.removeprefix("viewfs://trips")) for name in folders + names]
    assert not [name for name in left if name.startswith(".") and not name.endswith(".crc")]


def test_parts_whose_types_differ(spark, published, base, tmp_path):
    source, month = str(tmp_path / "published"), spark.read.parquet(landed_path(published, 2023, 1))
    month.limit(5).write.parquet(landed_path(source, 2023, 1))
    month.limit(7).withColumn("total_amount", F.col("total_amount").cast("float")).write.mode("append").parquet(
        landed_path(source, 2023, 1))
    assert statuses(relay_files(files_of(spark, source, base, [1]))) == ["success"]
    assert types(spark, base, [1]) == types(spark, source, [1])
    assert content(spark, base, [1]) == content(spark, source, [1])


def test_a_month_cut_off_is_landed_again(spark, published, base, monkeypatch):
    files, target = files_of(spark, published, base, [2]), landed_path(base, 2023, 2)
    with monkeypatch.context() as patched:  # all parts are there, the driver is lost before the marker
        patched.setattr(relay, "touch", lambda *_: (_ for _ in ()).throw(SystemExit))
        patched.setattr(relay, "delete", lambda *_: None)
        with pytest.raises(SystemExit):
            relay_files(files).collect()
    assert exists(spark, target) and not relay.is_whole(spark, target)
    assert statuses(relay_files(files)) == ["success"]
    assert content(spark, base, [2]) == content(spark, published, [2])


def test_a_failed_overwrite_leaves_the_old_month(spark, published, base, monkeypatch):
    files = files_of(spark, published, base, [2])
    relay_files(files)
    monkeypatch.setattr(relay, "_replaced", lambda *_: (_ for _ in ()).throw(OSError("no rename")))
    row = relay_files(files, overwrite=True).first()
    assert row.status == "failed: OSError: no rename"
    monkeypatch.undo()
    assert relay.is_whole(spark, landed_path(base, 2023, 2))
    assert content(spark, base, [2]) == content(spark, published, [2])


def test_a_folder_without_marker_stays_until_it_can_be_replaced(spark, published, base, tmp_path):
    """Parts that were landed in another way are not given up for a source that is not there."""
    target = landed_path(base, 2023, 2)
    spark.read.parquet(landed_path(published, 2023, 2)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target)
    assert not relay.is_whole(spark, target)
    assert statuses(relay_files(files_of(spark, str(tmp_path / "nowhere"), base, [2]))) == ["failed"]
    assert content(spark, base, [2]) == content(spark, published, [2])
    assert statuses(relay_files(files_of(spark, published, base, [2]))) == ["success"]
    assert relay.is_whole(spark, target) and content(spark, base, [2]) == content(spark, published, [2])


def test_a_new_folder_that_cannot_be_renamed(spark, published, base, monkeypatch):
    files, rename = files_of(spark, published, base, [2]), relay.rename
    relay_files(files)

    def failing(session, path, target):
        if path.rsplit("/", 1)[-1].startswith(".") and not path.endswith(".previous"):
            raise OSError("no rename")
        rename(session, path, target)

    monkeypatch.setattr(relay, "rename", failing)
    assert statuses(relay_files(files, overwrite=True)) == ["failed"]
    assert content(spark, base, [2]) == content(spark, published, [2])


def test_ingest_by_rows(spark, published, tmp_path):
    folder, base = tmp_path / "published", f"viewfs://trips{tmp_path}/landing"
    spark.read.parquet(landed_path(published, 2023, 1)).write.parquet(f"{folder}/yellow_tripdata_2023-01.parquet")
    manifest = ingest_landing(spark, str(folder), base, 2023, [1], by="rows", manifest_path=f"{base}/manifest")
    assert statuses(manifest) == ["success"]
    assert content(spark, base, [1]) == content(spark, published, [1])
    with pytest.raises(ValueError, match="by must be"):
        ingest_landing(spark, str(folder), base, 2023, [1], by="hand")


def test_the_manifest_query_into_storage_that_only_spark_opens(spark, published, base):
    rows = registry._three_runs(spark, published, base, relay_files).sort("month").collect()
    assert [(row.fetched, row.skipped, row.failed, row.last_status) for row in rows] == [(2, 1, 0, "success")] * 5 + [(0, 0, 3, "failed")]
    assert sum(row.record_count for row in rows) == read_landing(spark, published).count()


def test_row_groups_of_a_web_source(tmp_path, monkeypatch):
    table = pa.table({"n": pa.array(range(100), pa.int32()), "text": [str(k) for k in range(100)], "at": pa.array(range(100), pa.timestamp("ns"))})
    pq.write_table(table, tmp_path / "file", row_group_size=30)
    web = Web((tmp_path / "file").read_bytes(), True, True)
    monkeypatch.setattr(relay_web.urllib.request, "urlopen", web)
    file, source = relay_web.opened("https://example.org/file")
    assert file.num_row_groups == 4
    schema = pa.schema([("n", pa.int64()), ("text", pa.string()), ("at", pa.timestamp("us"))])
    groups = pa.RecordBatch.from_pydict({"group": pa.array([3, 1], pa.int32())})
    found = pa.Table.from_batches(relay_web.row_groups("https://example.org/file", source.version, schema)(iter([groups])))
    assert found.schema == schema and found.column("n").to_pylist() == [*range(90, 100), *range(30, 60)]
    assert all(method == "HEAD" or wanted for method, wanted in web.asked)
    with pytest.raises(OSError, match="changed"):
        relay_web.WebFile("https://example.org/file", "another version")
    monkeypatch.setattr(relay_web.urllib.request, "urlopen", Web(web.body, False, True))
    with pytest.raises(OSError, match="ranges"):
        relay_web.opened("https://example.org/file")
