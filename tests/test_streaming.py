from __future__ import annotations

from conftest import MAIL_A, MAIL_B, MAIL_C

from lettermill import schemas as S
from lettermill.plans.state import StateStore
from lettermill.streaming.runs import ingest_stream, latest_notice, notified_ingest


def finish(query):
    assert query.awaitTermination(300)
    assert query.exception() is None


def test_passes_over_a_bucket(spark, bucket, work):
    seen = []

    def one_pass():
        finish(ingest_stream(spark, str(bucket), bucket.state, work, every=None, on_run=seen.append))

    bucket.put(MAIL_A, "a.eml", day="2024-07-16")
    one_pass()
    bucket.put(MAIL_B, "b.eml", day="2024-01-01")  # late: an older day
    bucket.put(MAIL_C, "a.eml", day="2024-07-16")  # overwritten in place
    one_pass()
    one_pass()
    assert [(s.files_new, s.files_changed, s.files_unchanged) for s in seen] == [(1, 0, 0), (1, 1, 0), (0, 0, 2)]
    assert StateStore(spark, bucket.state).read("emails").count() == 3


def test_repeated_triggers(spark, bucket, work):
    import time

    seen = []
    bucket.put(MAIL_A, "a.eml")
    query = ingest_stream(spark, str(bucket), bucket.state, work, every="1 second", on_run=seen.append)
    try:
        deadline = time.time() + 120
        while len(seen) < 2 and time.time() < deadline and query.isActive:
            time.sleep(0.5)
    finally:
        query.stop()
    assert seen[0].files_new == 1 and seen[1].files_unchanged == 1


def test_notices_drive_the_same_run(spark, bucket, work, tmp_path):
    seen = []
    paths = [bucket.put(MAIL_A, "a.eml"), bucket.put(MAIL_B, "b.eml")]

    def notify(*files, stale=0):
        rows = [
            ("ns", "timestamp=2024-07-15", p.name, str(p), p.stat().st_size, p.stat().st_mtime_ns - d)
            for p in files for d in range(stale + 1)
        ]
        spark.createDataFrame(rows, S.SCANNED).write.mode("append").parquet(f"{work}-inbox")
        stream = spark.readStream.schema(S.SCANNED).parquet(f"{work}-inbox")
        finish(notified_ingest(stream, bucket.state, work, every=None, on_run=seen.append))

    notify(paths[0], stale=2)
    notify(*paths)
    assert [(s.files_scanned, s.files_new, s.files_unchanged) for s in seen] == [(1, 1, 0), (2, 1, 1)]


def test_latest_notice(spark):
    rows = [("n", "p", "r", "x", 1, 5), ("n", "p", "r", "y", 2, 9), ("n", "p", "s", "z", 3, 1)]
    got = latest_notice(spark.createDataFrame(rows, S.SCANNED)).collect()
    assert {(r.relpath, r.abspath) for r in got} == {("r", "y"), ("s", "z")}
