from __future__ import annotations

import json
import os

import pytest
from conftest import MAIL_A, MAIL_B, MAIL_C, MAIL_D, PAGE, fill_edge_cases, make_mbox, set_mtime
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.catalog.builders import make_zip
from lettermill.operators import reports
from lettermill.plans import ingest as plan
from lettermill.plans.ingest import RunOptions, SourcesFailed, export_pool, ingest
from lettermill.plans.state import ConcurrentRun, StateStore


def store(spark, bucket):
    return StateStore(spark, bucket.state)


def assert_whole(spark, bucket):
    """Cross-table checks that must hold after every run."""
    s = store(spark, bucket)
    emails, lineage, pool = s.read("emails"), s.read("lineage"), s.read("pool")
    assert reports.manifest_mismatches(s.manifest(), emails).count() == 0
    assert reports.pool_missing(emails, pool).count() == 0
    assert reports.orphans(lineage, s.read("skipped"), emails, s.source_files()).count() == 0
    assert emails.count() == emails.select("email_id").distinct().count()
    assert pool.count() == pool.select("email_id", "ext").distinct().count()
    assert lineage.count() == lineage.select("email_id", "source_id", "internal_path").distinct().count()
    wrong = pool.join(emails, "email_id").filter(
        (F.concat("email_id", "ext") == F.substring_index("pool_path", "/", -1))
        & (F.sha2("raw", 256) != F.col("content_sha256"))
    )
    assert wrong.count() == 0


def realistic(bucket):
    bucket.put(MAIL_A, "simple.eml")
    bucket.put(PAGE, "page.html")
    bucket.put(make_zip([("b.eml", MAIL_B), ("c.eml", MAIL_C)]), "batch.zip")
    bucket.put(make_mbox(MAIL_A, MAIL_B), "conv.mbox")
    bucket.put(MAIL_D, "new.eml", day="2024-07-16")


def test_realistic_bucket_and_rerun(spark, bucket):
    realistic(bucket)
    stats = ingest(spark, bucket.root.as_posix(), bucket.state, RunOptions(mode="backfill"))
    assert (stats.files_scanned, stats.files_new, stats.emails_staged, stats.emails_relinked, stats.skipped) == (5, 5, 5, 2, 0)
    s = store(spark, bucket)
    assert s.read("lineage").count() == 7
    per_day = {r.timestamp: r["count"] for r in s.manifest().groupBy("timestamp").count().collect()}
    assert per_day == {"2024-07-15": 6, "2024-07-16": 1}
    assert {r.status for r in s.source_files().collect()} == {S.DONE}
    assert_whole(spark, bucket)

    again = ingest(spark, bucket.root.as_posix(), bucket.state)
    assert (again.files_scanned, again.files_unchanged) == (5, 5)
    assert (again.files_new, again.emails_staged, again.emails_relinked, again.skipped) == (0, 0, 0, 0)
    assert store(spark, bucket).read("lineage").count() == 7


def test_edge_cases_all_in_one(spark, bucket):
    fill_edge_cases(bucket)
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_scanned, stats.emails_staged, stats.emails_relinked, stats.skipped) == (14, 6, 2, 7)
    s = store(spark, bucket)
    reasons = {r.reason: r.skips for r in reports.skip_counts(s.read("skipped")).collect()}
    assert reasons == {
        S.NOT_AN_EMAIL: 2, S.EMPTY_CONTAINER: 2, S.CORRUPT_ARCHIVE: 1, S.PASSWORD_PROTECTED: 1,
        S.UNSUPPORTED_FORMAT_DEFERRED: 1,
    }
    assert s.source_files().filter(F.col("status") == S.DONE).count() == 14
    deep = s.read("lineage").filter(F.col("container_depth") == 3)
    assert {r.internal_path for r in deep.collect()} == {
        "nested.zip!inner.zip!mail.mbox#0", "nested.zip!inner.zip!mail.mbox#1"
    }
    assert_whole(spark, bucket)
    again = ingest(spark, str(bucket), bucket.state)
    assert (again.files_unchanged, again.emails_staged, again.emails_relinked, again.skipped) == (14, 0, 0, 0)


@pytest.mark.parametrize("inline", [200])
def test_big_files_take_other_ways_to_the_same_result(spark, bucket, inline):
    fill_edge_cases(bucket)
    bucket.put(make_zip([(f"m{i:02d}.eml", MAIL_A + b"%d" % i) for i in range(40)]), "wide.zip")
    bucket.put(b"preamble\n" + make_mbox(*[MAIL_B + b"%d" % i for i in range(9)]), "sub dir/big #1 %.mbox")
    bucket.put(make_mbox(*[MAIL_B + b"%d" % i for i in range(9)]), "sub dir/big 1%20+.mbox")
    ingest(spark, str(bucket), bucket.state)
    small = store(spark, bucket)
    other = bucket.state + "-other"
    ingest(spark, str(bucket), other, RunOptions(inline_bytes=inline, slice_bytes=500))
    big = StateStore(spark, other)
    for table, columns in {
        "emails": ["email_id", "content_sha256", "size_bytes", "pool_path"],
        "lineage": ["email_id", "source_id", "internal_path", "container_depth"],
        "skipped": ["source_id", "internal_path", "reason", "details"],
        "pool": ["email_id", "ext", "raw"],
    }.items():
        a, b = small.read(table).select(*columns), big.read(table).select(*columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table
    key = ["source_id", "content_sha256", "status"]
    assert small.source_files().select(*key).exceptAll(big.source_files().select(*key)).count() == 0


def test_bad_member_of_a_big_archive_loses_all_of_it(spark, bucket):
    inner = make_zip([("deep.eml", MAIL_C)])
    raw = make_zip([("a.eml", MAIL_A), ("in.zip", inner), ("z.eml", MAIL_B * 50), ("zz.eml", MAIL_B * 60)])
    bucket.put(raw, "x.zip")
    bucket.put(MAIL_D, "ok.eml")
    stats = ingest(
        spark, str(bucket), bucket.state,
        RunOptions(inline_bytes=0, slice_bytes=1, max_member_bytes=len(MAIL_B) * 40),
    )
    assert (stats.emails_staged, stats.skipped) == (1, 1)
    [skip] = store(spark, bucket).read("skipped").collect()
    assert (skip.internal_path, skip.reason) == ("x.zip", S.CORRUPT_ARCHIVE)
    assert skip.details == f"member too large: member 'z.eml' declares {len(MAIL_B) * 50} bytes"
    assert_whole(spark, bucket)


def test_tenants_are_isolated(spark, bucket):
    bucket.put(MAIL_A, "x.eml", namespace="one")
    bucket.put(MAIL_A, "x.eml", namespace="two")
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.emails_staged, stats.emails_relinked) == (2, 0)


def test_same_mail_on_two_days_is_one_email_with_two_places(spark, bucket):
    bucket.put(MAIL_A, "x.eml")
    bucket.put(MAIL_A, "x.eml", day="2024-07-16")
    ingest(spark, str(bucket), bucket.state)
    s = store(spark, bucket)
    assert (s.read("emails").count(), s.read("lineage").count(), s.source_files().count()) == (1, 2, 2)


def test_first_seen_across_runs_and_late_files(spark, bucket):
    bucket.put(MAIL_A, "x.eml", day="2024-07-16")
    ingest(spark, str(bucket), bucket.state)
    first = store(spark, bucket).read("emails").collect()
    bucket.put(MAIL_A.replace(b"\r\n", b"\n"), "late.eml", day="2024-01-01")
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_new, stats.emails_staged, stats.emails_relinked) == (1, 0, 1)
    assert store(spark, bucket).read("emails").collect() == first
    assert_whole(spark, bucket)


def test_changed_file_adds_a_version_and_repeats_its_skips(spark, bucket):
    bucket.put(make_zip([("a.eml", MAIL_A), ("n.png", b"x")]), "f.zip")
    ingest(spark, str(bucket), bucket.state)
    bucket.put(make_zip([("a.eml", MAIL_B), ("b.eml", MAIL_A), ("n.png", b"x")]), "f.zip")
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_changed, stats.emails_staged, stats.emails_relinked, stats.skipped) == (1, 1, 1, 1)
    s = store(spark, bucket)
    assert (s.read("emails").count(), s.read("lineage").count(), s.read("skipped").count()) == (2, 3, 2)
    assert s.manifest().count() == 3
    assert_whole(spark, bucket)


def test_touched_file_refreshes_the_ledger_only(spark, bucket):
    path = bucket.put(MAIL_A, "x.eml")
    ingest(spark, str(bucket), bucket.state)
    before = store(spark, bucket).source_files().first()
    set_mtime(path, 5_000_000)
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_metadata_only, stats.emails_staged, stats.emails_relinked) == (1, 0, 0)
    after = store(spark, bucket).source_files().first()
    assert after.mtime_ns == path.stat().st_mtime_ns != before.mtime_ns
    assert (after.content_sha256, after.first_seen_at, after.status) == (before.content_sha256, before.first_seen_at, S.DONE)
    assert ingest(spark, str(bucket), bucket.state).files_unchanged == 1


def test_one_id_as_mail_and_page_keeps_both_blobs(spark, bucket):
    bucket.put(PAGE, "a.eml")
    bucket.put(PAGE, "b.html")
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.emails_staged, stats.emails_relinked) == (1, 1)
    s = store(spark, bucket)
    assert s.read("emails").first().format == "eml"
    assert {r.ext for r in s.read("pool").collect()} == {".eml", ".html"}
    assert {r.format for r in s.manifest().collect()} == {"eml", "html"}
    assert_whole(spark, bucket)


def test_files_that_share_a_source_id(spark, bucket):
    bucket.put(MAIL_A, "in\\x.eml")
    bucket.put(MAIL_B, "in/x.eml")
    bucket.put(MAIL_A, "a.eml")
    bucket.put(MAIL_C, "c.eml")
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_new, stats.emails_staged, stats.emails_relinked) == (4, 3, 1)
    s = store(spark, bucket)
    assert s.read("lineage").count() == 4
    assert s.source_files().count() == 3
    assert s.source_files().filter("relpath = 'in/x.eml'").count() == 1
    assert_whole(spark, bucket)


def test_unreadable_file_is_skipped(spark, bucket, monkeypatch):
    bucket.put(MAIL_A, "x.eml")
    os.symlink(bucket.root / "nowhere", bucket.root / "ns" / "timestamp=2024-07-15" / "gone.eml")
    scanned = spark.createDataFrame(
        [("ns", "timestamp=2024-07-15", n, f"{bucket.root}/ns/timestamp=2024-07-15/{n}", 1, 1) for n in ("x.eml", "gone.eml")],
        S.SCANNED,
    )
    stats = plan.ingest_scanned(spark, scanned, bucket.state)
    assert (stats.emails_staged, stats.skipped, stats.files_failed) == (1, 1, 0)
    [skip] = store(spark, bucket).read("skipped").collect()
    assert skip.reason == S.UNREADABLE and "gone.eml" in skip.details
    assert {r.status for r in store(spark, bucket).source_files().collect()} == {S.DONE}


def test_a_source_that_breaks_fails_alone_and_is_retried(spark, bucket, monkeypatch):
    from lettermill.sources import opening

    bucket.put(MAIL_A, "x.eml")
    bucket.put(MAIL_B, "y.eml")
    monkeypatch.setattr(opening, "ROW_BYTES", -1)
    with pytest.raises(SourcesFailed):
        ingest(spark, str(bucket), bucket.state, RunOptions(fail_fast=True))
    assert {r.status for r in store(spark, bucket).source_files().collect()} == {S.FAILED}
    monkeypatch.undo()
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_changed, stats.emails_staged, stats.files_failed) == (2, 2, 0)
    assert_whole(spark, bucket)


def test_manifest_files(spark, bucket):
    bucket.put(MAIL_A, "x.eml")
    ingest(spark, str(bucket), bucket.state)
    from pathlib import Path

    [part] = Path(bucket.state).glob("tables/manifest/run_id=*/namespace=ns/timestamp=2024-07-15/*.json")
    line = json.loads(part.read_text())
    assert list(line) == ["email_id", "pool_path", "format", "lineage"]
    assert line["lineage"] == [{"source": "x.eml", "internal_path": "x.eml", "depth": 0}]


def test_pool_export_is_repeatable(spark, bucket, tmp_path):
    bucket.put(MAIL_A, "x.eml")
    bucket.put(PAGE, "p.html")
    ingest(spark, str(bucket), bucket.state)
    target = tmp_path / "pool"
    for _ in range(2):
        export_pool(spark, bucket.state, str(target))
    files = sorted(p for p in target.rglob("*") if p.is_file())
    assert sorted(p.read_bytes() for p in files) == sorted([MAIL_A, PAGE])
    assert all(p.parent.name == p.name[:2] and p.suffix in (".eml", ".html") for p in files)


# --- crashes and concurrency ------------------------------------------------


class Killed(BaseException):
    """Like a kill: no handler of the run gets to act."""


STEPS = ["_write:emails", "_write:manifest", "_commit"]


def break_at(monkeypatch, step: str, failure: type[BaseException]):
    method, _, table = step.partition(":")
    original = getattr(plan._Run, method)

    def broken(self, *args, **kwargs):
        if not table:
            raise failure("simulated")
        result = original(self, *args, **kwargs)
        if args[0] == table:
            raise failure("simulated")
        return result

    monkeypatch.setattr(plan._Run, method, broken)


@pytest.mark.parametrize("step", ["_write:pool"])
def test_failed_run_leaves_nothing_visible_and_is_repeated(spark, bucket, monkeypatch, step):
    realistic(bucket)
    break_at(monkeypatch, step, RuntimeError)
    with pytest.raises(RuntimeError, match="simulated"):
        ingest(spark, str(bucket), bucket.state)
    s = store(spark, bucket)
    assert s.read("emails").count() == s.read("lineage").count() == s.manifest().count() == 0
    assert {r.status for r in s.source_files().collect()} == {S.FAILED}
    monkeypatch.undo()
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_changed, stats.emails_staged, stats.emails_relinked) == (5, 5, 2)
    assert stats.recovered_in_progress == 0
    assert_whole(spark, bucket)


@pytest.mark.parametrize("step", STEPS)
def test_killed_run_is_recovered(spark, bucket, monkeypatch, step):
    bucket.put(make_mbox(MAIL_A, MAIL_B), "x.mbox")
    break_at(monkeypatch, step, Killed)
    with pytest.raises(Killed):
        ingest(spark, str(bucket), bucket.state)
    s = store(spark, bucket)
    assert s.read("emails").count() == 0
    assert {r.status for r in s.source_files().collect()} == {S.IN_PROGRESS}
    monkeypatch.undo()
    stats = ingest(spark, str(bucket), bucket.state)
    assert stats.recovered_in_progress == 1 and stats.recovered_tmp_files >= 1
    assert (stats.files_changed, stats.emails_staged) == (1, 2)
    assert_whole(spark, bucket)
    if step == "_commit":
        calm = ingest(spark, str(bucket), bucket.state)
        assert (calm.recovered_in_progress, calm.recovered_tmp_files, calm.files_unchanged) == (0, 0, 1)


@pytest.mark.parametrize("slice_bytes", [7, 100, 1 << 20])
def test_big_mailboxes_of_any_name(spark, bucket, slice_bytes):
    names = ["_h.mbox", ".d.mbox", "Inbox [1].mbox", "{a,b}.mbox", "st*r?.mbox", "100%20.mbox", "plain.mbox"]
    for i, name in enumerate(names):
        bucket.put(make_mbox(MAIL_A, MAIL_B + b"%d\n" % i), name)
    bucket.put(b"no separator\n\nat all", "none.mbox")
    bucket.put(b"before\nFrom x\nFrom y\nbody\nFrom z", "odd.mbox")
    tables = []
    for inline in (1 << 20, 0):
        state = f"{bucket.state}-{inline}"
        stats = ingest(spark, str(bucket), state, RunOptions(inline_bytes=inline, slice_bytes=slice_bytes))
        s = StateStore(spark, state)
        lineage = s.read("lineage").select("email_id", "source_id", "internal_path")
        skips = s.read("skipped").select("source_id", "internal_path", "reason")
        tables.append([sorted(map(str, t.collect())) for t in (lineage, skips, s.read("emails").select("email_id"))])
        assert stats.files_failed == 0
    assert tables[0] == tables[1]
    assert len(tables[0][2]) == 1 + len(names) + 2


def test_many_small_slices_share_tasks(spark, bucket, monkeypatch):
    for i in range(40):
        bucket.put(make_mbox(MAIL_A, MAIL_B + b"%d\n" % i), f"{i}.mbox")
        bucket.put(make_zip([("a.eml", MAIL_C + b"%d" % i), ("b.eml", MAIL_D)]), f"{i}.zip")
    tasks = {"slices": [], "ranges": []}
    spread, read = plan.spread, plan.read_large_mboxes

    def dealt(rows, *keys, partitions=None):
        if "slice_lo" in keys:
            tasks["slices"].append(partitions)
        return spread(rows, *keys, partitions=partitions)

    def ranged(rows, n, scratch):
        tasks["ranges"].append(n)
        return read(rows, n, scratch)

    monkeypatch.setattr(plan, "spread", dealt)
    monkeypatch.setattr(plan, "read_large_mboxes", ranged)
    stats = ingest(spark, str(bucket), bucket.state, RunOptions(inline_bytes=0, slice_bytes=10))
    assert (stats.files_failed, stats.emails_staged) == (0, 1 + 40 + 40 + 1)
    most = spark.sparkContext.defaultParallelism
    assert tasks == {"slices": [most], "ranges": [most]}
    # a full slice still has a task of its own
    run = plan._Run(spark, None, bucket.state, RunOptions())
    full = spark.range(3 * most).select(F.lit(plan.SLICE_BYTES).alias("n"))
    assert run._slice_tasks(full, F.col("n")) == 3 * most


def test_big_mailbox_that_fails_is_one_source(spark, bucket, monkeypatch):
    bucket.put(make_mbox(MAIL_A, MAIL_B), "a.mbox")
    bucket.put(make_mbox(MAIL_C, b"long " * 500), "b.mbox")
    original = plan.read_large_mboxes

    def gone(files, *rest):  # b.mbox goes away between the passes
        path = F.when(F.col("relpath") == "b.mbox", F.lit("/nowhere/b.mbox")).otherwise(F.col("abspath"))
        return original(files.withColumn("abspath", path), *rest)

    monkeypatch.setattr(plan, "read_large_mboxes", gone)
    stats = ingest(spark, str(bucket), bucket.state, RunOptions(inline_bytes=0))
    monkeypatch.undo()
    assert (stats.files_failed, stats.emails_staged) == (1, 2)
    assert_whole(spark, bucket)
    assert ingest(spark, str(bucket), bucket.state).emails_staged == 2


def test_second_writer_adds_what_is_left(spark, bucket, monkeypatch):
    """Another process, whose files this run can't see at work, takes the same file and ends first."""
    bucket.put(MAIL_A, "x.eml")
    bucket.put(make_zip([("b.eml", MAIL_B), ("n.png", b"x")]), "f.zip")
    original, started = plan._Run._publish_mail, StateStore.started

    def overtaken(self):
        monkeypatch.setattr(plan._Run, "_publish_mail", original)
        monkeypatch.setattr(StateStore, "started", lambda self, runs: None)
        bucket.put(MAIL_C, "late.eml")
        ingest(spark, str(bucket), bucket.state)
        monkeypatch.setattr(StateStore, "started", started)
        original(self)

    monkeypatch.setattr(plan._Run, "_publish_mail", overtaken)
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.emails_staged, stats.emails_relinked) == (0, 2)
    s = store(spark, bucket)
    assert (s.read("emails").count(), s.read("lineage").count(), s.read("skipped").count(), s.manifest().count()) == (3, 3, 1, 3)
    assert_whole(spark, bucket)
    assert ingest(spark, str(bucket), bucket.state).files_unchanged == 3


@pytest.mark.parametrize("merge_parts", [3, 0])
def test_long_run_beside_short_ones(spark, bucket, monkeypatch, merge_parts):
    bucket.put(make_mbox(MAIL_A, MAIL_B), "big.mbox")
    original, seen = plan._Run._publish_mail, []

    def overtaken(self):
        monkeypatch.setattr(plan._Run, "_publish_mail", original)
        for i in range(5):
            bucket.put(MAIL_C + b"%d" % (i // 2), f"short{i}.eml")
            bucket.put(MAIL_A, f"copy{i}.eml")
            seen.append(ingest(spark, str(bucket), bucket.state, RunOptions(merge_parts=merge_parts)))
        original(self)

    monkeypatch.setattr(plan._Run, "_publish_mail", overtaken)
    stats = ingest(spark, str(bucket), bucket.state, RunOptions(mode="backfill"))
    assert [(s.files_new, s.files_elsewhere, s.files_unchanged) for s in seen] == [(2, 1, 2 * i) for i in range(5)]
    assert (stats.files_new, stats.emails_staged, stats.emails_relinked) == (1, 1, 1)  # MAIL_A was committed meanwhile
    s = store(spark, bucket)
    assert (s.read("emails").count(), s.read("lineage").count(), s.manifest().count()) == (5, 12, 12)
    assert_whole(spark, bucket)
    calm = ingest(spark, str(bucket), bucket.state)
    assert (calm.files_unchanged, calm.files_elsewhere, calm.recovered_in_progress) == (11, 0, 0)


def test_torn_commit_files_are_passed_over(spark, bucket):
    bucket.put(MAIL_A, "x.eml")
    ingest(spark, str(bucket), bucket.state)
    from pathlib import Path

    commits = Path(bucket.state) / "commits"
    for count, torn in enumerate(("", '{"number": 7', "[]"), 1):
        newest = max(int(p.name[:10]) for p in commits.iterdir())
        (commits / f"{newest + 1:010d}.json").write_text(torn)
        s = store(spark, bucket)
        assert s.read("emails").count() == count
        bucket.put(MAIL_B + torn.encode(), f"y{newest}.eml")
        assert ingest(spark, str(bucket), bucket.state).files_new == 1
    assert store(spark, bucket).read("emails").count() == 4
    assert not list(commits.glob("*.tmp"))
    assert_whole(spark, bucket)


def test_runs_of_other_processes_live_by_their_lease(spark, bucket, monkeypatch):
    from lettermill.plans import state

    bucket.put(MAIL_A, "x.eml")
    break_at(monkeypatch, "_commit", Killed)
    with pytest.raises(Killed):
        ingest(spark, str(bucket), bucket.state)
    monkeypatch.undo()
    monkeypatch.setattr(state, "_PROCESS", "another")
    stats = ingest(spark, str(bucket), bucket.state)  # its claim is fresh: it may be at work
    assert (stats.files_new, stats.files_elsewhere, stats.recovered_in_progress) == (0, 1, 0)
    lost = StateStore(spark, bucket.state)
    monkeypatch.setattr(state, "LEASE", -1)
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_changed, stats.recovered_in_progress, stats.emails_staged) == (1, 1, 1)
    with pytest.raises(ConcurrentRun):  # the revoked run was only slow
        lost.commit(1, {}, {})
    assert_whole(spark, bucket)


def test_run_that_starts_late_does_not_destroy_the_other(spark, bucket, monkeypatch):
    """The first run has written its tables when the second one starts and breaks off."""
    bucket.put(MAIL_A, "x.eml")
    bucket.put(MAIL_B, "y.eml")
    original = plan._Run._commit

    def broken(self):
        raise RuntimeError("killed")

    def overtaken(self):
        monkeypatch.setattr(plan._Run, "_commit", broken)
        with pytest.raises(RuntimeError, match="killed"):
            ingest(spark, str(bucket), bucket.state)
        monkeypatch.setattr(plan._Run, "_commit", original)
        original(self)

    monkeypatch.setattr(plan._Run, "_commit", overtaken)
    assert ingest(spark, str(bucket), bucket.state).emails_staged == 2
    assert_whole(spark, bucket)
    assert ingest(spark, str(bucket), bucket.state).files_unchanged == 2
    assert_whole(spark, bucket)


@pytest.mark.parametrize("compaction_first", [True, False])
def test_run_during_compaction(spark, bucket, monkeypatch, compaction_first):
    bucket.put(MAIL_A, "x.eml")
    ingest(spark, str(bucket), bucket.state)
    bucket.put(MAIL_B, "y.eml")
    bucket.put(MAIL_A, "x2.eml")
    s = store(spark, bucket)
    if compaction_first:
        publish = plan._Run._commit

        def late(self):
            monkeypatch.setattr(plan._Run, "_commit", publish)
            assert s.compact()
            publish(self)

        monkeypatch.setattr(plan._Run, "_commit", late)
        ingest(spark, str(bucket), bucket.state)
    else:
        original = s.commit

        def overtaken(*args, **kwargs):
            ingest(spark, str(bucket), bucket.state)
            original(*args, **kwargs)

        monkeypatch.setattr(s, "commit", overtaken)
        assert s.compact()
    assert ingest(spark, str(bucket), bucket.state).files_unchanged == 3
    assert (store(spark, bucket).read("emails").count(), store(spark, bucket).read("lineage").count()) == (2, 3)
    assert_whole(spark, bucket)


def test_compaction_recovers_what_broke_off(spark, bucket, monkeypatch):
    bucket.put(MAIL_A, "x.eml")
    ingest(spark, str(bucket), bucket.state)
    bucket.put(MAIL_B, "y.eml")
    break_at(monkeypatch, "_commit", Killed)
    with pytest.raises(Killed):
        ingest(spark, str(bucket), bucket.state)
    monkeypatch.undo()
    s = store(spark, bucket)
    assert s.folders_of(s.unfinished_runs())
    assert s.compact()
    s = store(spark, bucket)
    assert not s.unfinished_runs() and not (folders(bucket) & {(t, "run_id=2") for t in s.snapshot.tables})
    s.clean(keep=1)
    assert {r.relpath: r.status for r in s.source_files().collect()} == {"x.eml": S.DONE, "y.eml": S.DISCOVERED}
    assert folders(bucket) == {(t, p.path.split("/")[0]) for t, parts in s.snapshot.tables.items() for p in parts}
    stats = ingest(spark, str(bucket), bucket.state)
    assert (stats.files_changed, stats.emails_staged, stats.recovered_in_progress) == (1, 1, 0)
    assert_whole(spark, bucket)


def folders(bucket) -> set:
    from pathlib import Path

    return {(p.parent.name, p.name) for p in Path(bucket.state).glob("tables/*/run_id=*")}


def test_parts_merge_by_themselves_and_old_ones_go(spark, bucket):
    runs = 8
    for i in range(runs):
        bucket.put(MAIL_A + b"%d" % i, f"m{i}.eml")
        stats = ingest(spark, str(bucket), bucket.state, RunOptions(merge_parts=3))
        assert (stats.files_new, stats.files_unchanged, stats.emails_staged) == (1, i, 1)
    s = store(spark, bucket)
    assert all(len(parts) <= 5 for parts in s.snapshot.tables.values())
    assert any(p.buckets for p in s.parts("ledger_events"))
    assert sum(p.buckets > 0 for p in s.parts("ledger_events")) == 1
    # a run without changes does not move the ledger that is stored in buckets
    scanned = plan.scan_bucket(spark, str(bucket))
    from lettermill.operators import cdc

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layer = next(layer for layer in s.ledger_layers())
        text = cdc.lookup_layers(cdc.with_source_id(scanned), [layer])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    join = text[text.index("SortMergeJoin") :]
    assert join.count("Exchange hashpartitioning(source_id") == 1  # the scan's side only
    s.compact()
    s.clean(keep=1)
    s = store(spark, bucket)
    assert folders(bucket) == {(t, p.path.split("/")[0]) for t, parts in s.snapshot.tables.items() for p in parts}
    assert len(s._commits()) == 1 and len(s._claims()) == 0
    assert ingest(spark, str(bucket), bucket.state).files_unchanged == runs
    assert_whole(spark, bucket)


def test_compaction_keeps_the_state(spark, bucket):
    realistic(bucket)
    ingest(spark, str(bucket), bucket.state)
    bucket.put(MAIL_C + b"!", "more.eml")
    ingest(spark, str(bucket), bucket.state)
    s = store(spark, bucket)
    before = {t: sorted(map(str, s.read(t).collect())) for t in ("emails", "lineage", "skipped")}
    ledger = sorted(map(str, s.source_files().collect()))
    manifest = s.manifest().count()
    s.compact()
    s = store(spark, bucket)
    assert {t: sorted(map(str, s.read(t).collect())) for t in before} == before
    assert sorted(map(str, s.source_files().collect())) == ledger
    assert s.manifest().count() == manifest
    assert all(len(p) == 1 for p in s.snapshot.tables.values())
    assert ingest(spark, str(bucket), bucket.state).files_unchanged == 6
    bucket.put(MAIL_D + b"!", "last.eml")
    assert ingest(spark, str(bucket), bucket.state).emails_staged == 1
    assert_whole(spark, bucket)
