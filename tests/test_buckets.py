"""What whole runs over buckets leave on disk on their way."""

from __future__ import annotations

import os
import time

import duckdb

from lettermill.catalog import buckets, load_all
from lettermill.plans.ingest import ingest, ingest_scanned, scan_bucket
from lettermill.plans.state import StateStore


def files_below(root: str) -> set[str]:
    return {os.path.relpath(f"{d}/{f}", root) for d, _, names in os.walk(root) for f in names}


def write_documents(spark, root: str) -> None:
    """Copies of a text on every day of both tenants, framed in six ways, and texts of their own."""
    rows = [
        (n, ("copy\nof one" if n % 2 else f"text {n}\nof its own") + "\n", "en", "ab"[n // 7 % 2], 20) for n in range(56)
    ]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(
        f"{root}/documents.parquet"
    )


def test_pool_export_holds_a_share_of_the_bucket_at_a_time(spark, tmp_path, monkeypatch):
    sf, work = str(tmp_path / "sf"), tmp_path / "work"
    write_documents(spark, sf)
    monkeypatch.setattr(buckets, "ROUND_BYTES", 1, raising=False)
    monkeypatch.setattr(buckets, "new_work_dir", lambda spark, label: str(work))
    held = []

    def watched(spark, bucket, *args):
        held.append(files_below(bucket))
        return ingest(spark, bucket, *args)

    monkeypatch.setattr(buckets, "ingest", watched)
    query = load_all()["pool_export"]
    got = query.run(spark, sf).select("pool_file", "size_bytes", "content_sha256").collect()

    whole = set().union(*held)
    # a plain file of every document, a mailbox or an archive next to two of three
    assert len(whole) == 56 + 19 + 19 == sum(map(len, held))
    assert max(map(len, held)) <= len(whole) // 2
    days = [{path.split("/")[1] for path in part} for part in held]
    assert all(max(a) < min(b) for a, b in zip(days, days[1:]))
    assert not files_below(str(work / "bucket"))

    tables = duckdb.connect()
    tables.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet/*.parquet'")
    wanted = tables.execute(f"SELECT pool_file, size_bytes, content_sha256 FROM ({query.sql})").fetchall()
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert files_below(str(work / "state" / "export")) == {r.pool_file for r in got}


def test_rounds_take_every_day_once(spark, tmp_path, monkeypatch):
    days = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(-9, "a" * 50, "en", "s", 1), (None, None, None, None, None), *[(n, "b" * n, "en", "s", 1) for n in range(9)]]
    spark.createDataFrame(rows, days).write.parquet(str(tmp_path / "documents.parquet"))
    assert buckets._rounds(spark, str(tmp_path)) == [None]
    monkeypatch.setattr(buckets, "ROUND_BYTES", 1)
    rounds = buckets._rounds(spark, str(tmp_path))
    named = [f"timestamp=2024-07-{d}" for d in (13, *range(15, 22))]
    assert [d for part in rounds for d in part] == ["", *named]
    assert 1 < len(rounds) <= buckets.ROUNDS
    counts = [buckets.contents(spark, str(tmp_path), part).count() for part in rounds]
    assert sum(counts) == buckets.contents(spark, str(tmp_path)).count()


def test_no_documents_are_one_round(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert buckets._rounds(spark, str(tmp_path)) == [None]


def shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_a_run_leaves_no_shuffled_mail(spark, bucket):
    for n in range(20):
        bucket.put(f"Subject: {n % 15}\n\nmail".encode(), f"{n}.eml")
    scanned = scan_bucket(spark, str(bucket))
    before = shuffle_files(spark)
    ingest_scanned(spark, scanned, bucket.state)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert StateStore(spark, bucket.state).read("pool").count() == 15
