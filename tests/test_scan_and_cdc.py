from __future__ import annotations

import hashlib
import os
import threading

import pytest
from conftest import MAIL_A, MAIL_B, set_mtime
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill import sources
from lettermill.operators import cdc
from lettermill.plans.ingest import scan_bucket
from lettermill.sources.opening import hash_files


@pytest.fixture(autouse=True)
def _formats(spark):
    sources.register(spark)


def scan(spark, bucket, **options):
    return spark.read.format("bucket_scan").options(**options).load(str(bucket))


def listed(frame):
    return {(r.namespace, r.partition, r.relpath) for r in frame.collect()}


# --- scan -------------------------------------------------------------------


def test_files_with_size_and_time(spark, bucket):
    path = bucket.put(MAIL_A, "a.eml")
    [row] = scan(spark, bucket).collect()
    info = path.stat()
    assert (row.size_bytes, row.mtime_ns, row.abspath) == (info.st_size, info.st_mtime_ns, str(path))


def test_only_date_directories_of_namespaces(spark, bucket):
    bucket.put(b"x", "a.eml")
    bucket.put(b"x", "b.eml", day="2024-99-99", namespace="other")
    bucket.put(b"x", "c.eml", day="bad-format")
    (bucket.root / "ns" / "_metadata").mkdir()
    (bucket.root / "ns" / "_metadata" / "d.eml").write_bytes(b"x")
    (bucket.root / "stray.eml").write_bytes(b"x")
    assert listed(scan(spark, bucket)) == {
        ("ns", "timestamp=2024-07-15", "a.eml"), ("other", "timestamp=2024-99-99", "b.eml")
    }


def test_subfolders_hidden_and_empty_files(spark, bucket):
    for name in ("a.eml", "sub/b.eml", "sub/deep/c.eml", ".hidden.eml", "_under.eml", "sp ace#%.eml"):
        bucket.put(b"", name)
    assert {r for _, _, r in listed(scan(spark, bucket))} == {
        "a.eml", "sub/b.eml", "sub/deep/c.eml", ".hidden.eml", "_under.eml", "sp ace#%.eml"
    }


def test_links_and_special_files(spark, bucket):
    real = bucket.put(MAIL_A, "real.eml")
    os.symlink(real, real.parent / "link.eml")
    os.symlink(real.parent / "gone", real.parent / "broken.eml")
    os.symlink(bucket.root, real.parent / "loop")
    os.mkfifo(real.parent / "pipe.eml")
    assert {r for _, _, r in listed(scan(spark, bucket))} == {"real.eml", "link.eml"}


def test_root_contract(spark, bucket, tmp_path):
    assert scan(spark, tmp_path / "missing").count() == 0
    assert scan(spark, bucket).count() == 0
    (tmp_path / "file").write_bytes(b"")
    with pytest.raises(Exception, match="not a directory"):
        scan(spark, tmp_path / "file").count()


def test_bounds_slices_and_tasks_list_every_file_once(spark, bucket):
    for day in ("2024-07-14", "2024-07-15", "2024-07-16"):
        for i in range(20):
            bucket.put(b"x", f"f{i}.eml", day=day, namespace=f"n{i % 2}")
    every = scan(spark, bucket).collect()
    assert len(every) == 60
    for options in ({"slices": 3}, {"tasks": 2}, {"slices": 4, "tasks": 5}):
        assert sorted(scan(spark, bucket, **options).collect()) == sorted(every)
    some = scan(spark, bucket, min_partition="timestamp=2024-07-15", max_partition="timestamp=2024-07-15", namespaces="n1")
    assert listed(some) == {("n1", "timestamp=2024-07-15", f"f{i}.eml") for i in range(1, 20, 2)}


def test_names_first_then_stats(spark, bucket):
    real = bucket.put(MAIL_A, "real.eml")
    bucket.put(b"", "sub/empty.eml")
    os.symlink(real, real.parent / "link.eml")
    os.symlink(real.parent / "gone", real.parent / "broken.eml")
    os.mkfifo(real.parent / "pipe.eml")
    assert sorted(scan_bucket(spark, str(bucket)).collect()) == sorted(scan(spark, bucket).collect())
    names = scan(spark, bucket, names_only="true")
    assert names.filter("size_bytes IS NOT NULL OR mtime_ns IS NOT NULL").count() == 0


def test_file_uri_lists_the_same(spark, bucket):
    bucket.put(MAIL_A, "a.eml")
    rows = spark.read.format("bucket_scan").load(f"file://{bucket.root}").collect()
    assert [(r.namespace, r.relpath, r.size_bytes) for r in rows] == [("ns", "a.eml", len(MAIL_A))]


def test_scanning_opens_no_file(spark, bucket):
    """A pipe would block a reader for ever; unreadable files are listed too."""
    bucket.put(MAIL_A, "a.eml").chmod(0)
    done = threading.Event()
    threading.Timer(60, done.set).start()
    assert scan(spark, bucket).count() == 1 and not done.is_set()


# --- change detection -------------------------------------------------------


def ledger_row(spark, scanned, **changes):
    row = cdc.with_source_id(scanned).drop("abspath").withColumns(
        {
            "content_sha256": F.lit(hashlib.sha256(MAIL_A).hexdigest()),
            "status": F.lit(S.DONE),
            "first_seen_at": F.timestamp_seconds(F.lit(1)),
            "last_processed_at": F.timestamp_seconds(F.lit(2)),
        }
    )
    for name, value in changes.items():
        row = row.withColumn(name, F.lit(value))
    return row.select(*[f.name for f in S.SOURCE_FILES.fields])


def hashing(rows):
    return hash_files(rows).drop("hash_error")


def verdict(spark, bucket, ledger):
    [row] = cdc.classify(scan(spark, bucket), ledger, hashing).collect()
    return row


SHA_A = hashlib.sha256(MAIL_A).hexdigest()


def test_new(spark, bucket):
    bucket.put(MAIL_A, "a.eml")
    row = verdict(spark, bucket, spark.createDataFrame([], S.SOURCE_FILES))
    assert (row.decision, row.content_sha256, row.previous) == (S.NEW, SHA_A, None)


def test_unchanged_is_not_read(spark, bucket):
    path = bucket.put(MAIL_A, "a.eml")
    ledger = ledger_row(spark, scan(spark, bucket))
    rows = cdc.classify(
        scan(spark, bucket), ledger, lambda r: r.withColumn("content_sha256", F.raise_error(F.lit("read")))
    ).collect()
    assert [(r.decision, r.content_sha256) for r in rows] == [(S.UNCHANGED, None)]
    assert rows[0].previous.status == S.DONE and path.exists()


def test_touched_only(spark, bucket):
    path = bucket.put(MAIL_A, "a.eml")
    ledger = spark.createDataFrame(ledger_row(spark, scan(spark, bucket)).collect(), S.SOURCE_FILES)
    set_mtime(path, 10_000_000)
    row = verdict(spark, bucket, ledger)
    assert (row.decision, row.content_sha256) == (S.METADATA_ONLY, SHA_A)


@pytest.mark.parametrize("changes", [
    {"size_bytes": 1, "content_sha256": "0" * 64},
    {"mtime_ns": 1, "content_sha256": "0" * 64},
    {"status": S.IN_PROGRESS},
    {"status": S.FAILED},
    {"status": S.DISCOVERED},
])
def test_changed(spark, bucket, changes):
    bucket.put(MAIL_A, "a.eml")
    row = verdict(spark, bucket, ledger_row(spark, scan(spark, bucket), **changes))
    assert (row.decision, row.content_sha256) == (S.CHANGED, SHA_A)


def test_vanished_files_keep_their_ledger_row(spark, bucket):
    path = bucket.put(MAIL_A, "a.eml")
    ledger = spark.createDataFrame(ledger_row(spark, scan(spark, bucket)).collect(), S.SOURCE_FILES)
    path.unlink()
    bucket.put(MAIL_B, "b.eml")
    rows = cdc.classify(scan(spark, bucket), ledger, hashing).collect()
    assert [(r.relpath, r.decision) for r in rows] == [("b.eml", S.NEW)]


def test_current_ledger_takes_the_last_step(spark):
    def event(source, run, step, status, first):
        return (source, "n", "p", "r", run, step, "h", status, first, None, run, step)

    from datetime import datetime as dt

    rows = [
        event("a", 1, cdc.STARTED, S.IN_PROGRESS, dt(2024, 1, 1)),
        event("a", 1, cdc.FINISHED, S.DONE, dt(2024, 1, 1)),
        event("b", 1, cdc.STARTED, S.IN_PROGRESS, dt(2024, 1, 1)),
        event("b", 2, cdc.RECOVERED, S.DISCOVERED, dt(2024, 1, 2)),
        event("c", 3, cdc.STARTED, S.IN_PROGRESS, dt(2024, 1, 3)),
        event("c", 3, cdc.ABORTED, S.FAILED, dt(2024, 1, 3)),
    ]
    state = cdc.current_ledger(spark.createDataFrame(rows, S.LEDGER_EVENTS)).collect()
    assert {r.source_id: (r.status, r.first_seen_at.day) for r in state} == {
        "a": (S.DONE, 1), "b": (S.DISCOVERED, 1), "c": (S.FAILED, 3)
    }
