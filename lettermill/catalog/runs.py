"""Runs that break off, overlap or fail, and what a scan takes for a file, over buckets written from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettermill import sources
from lettermill.catalog import query
from lettermill.catalog.buckets import write_bucket
from lettermill.catalog.derived import FILES_CTE, bucket_files, email_id_sql, kind_sql, table
from lettermill.functions import identity
from lettermill.plans.ingest import RunOptions, _Run, ingest, ingest_scanned, scan_bucket
from lettermill.plans.state import StateStore
from lettermill.storage import new_work_dir, write_text

_MAIL = f"{kind_sql('relpath')} IN ('eml', 'html')"
_PLACES_SQL = f"""WITH {FILES_CTE} SELECT namespace, partition, relpath, {email_id_sql('namespace', 'body')} AS email_id,
    CAST(1 AS BIGINT) AS email_rows, 'done' AS status FROM files WHERE {_MAIL}"""


def _files(spark, sf_dir):
    return bucket_files(spark, sf_dir).withColumn("content", F.col("raw"))


def _number():
    """The document number in a file name."""
    return F.regexp_extract("relpath", r"(\d+)[^/]*$", 1).cast("bigint")


def _places(spark, state):
    """Every place of an email, with the rows that the email has and the state of its file."""
    store = StateStore(spark, state)
    rows = store.read("emails").groupBy("email_id").agg(F.count("*").alias("email_rows"))
    located = store.source_files().select("source_id", "relpath", "status")
    return store.read("lineage").join(rows, "email_id").join(located, "source_id").select(
        "namespace", "partition", "relpath", "email_id", "email_rows", "status"
    )


@query("concurrent_runs", _PLACES_SQL)
def concurrent_runs(spark, sf_dir):
    """A backfill of a quarter of the files that ends after three runs over the others, which start and end
    while it is open, leave its files to it, and merge the tables under it."""
    work = new_work_dir(spark, "concurrent")
    bucket, state = f"{work}/bucket", f"{work}/state"
    files = _files(spark, sf_dir)
    write_bucket(files.filter("doc_id % 4 = 0"), bucket)
    backfill = _Run(spark, scan_bucket(spark, bucket), state, RunOptions(mode="backfill"))
    backfill.open()
    for k in (1, 2, 3):
        write_bucket(files.filter(F.col("doc_id") % 4 == k), bucket)
        ingest(spark, bucket, state, RunOptions(merge_parts=2))
    backfill.work_off()
    return _places(spark, state)


@query("torn_commit", _PLACES_SQL)
def torn_commit(spark, sf_dir):
    """Two runs; between them a commit was torn off while its file was written."""
    work = new_work_dir(spark, "torn")
    bucket, state = f"{work}/bucket", f"{work}/state"
    files = _files(spark, sf_dir)
    write_bucket(files.filter("doc_id % 2 = 0"), bucket)
    ingest(spark, bucket, state)
    store = StateStore(spark, state)
    write_text(spark, f"{state}/commits/{store.next_number:010d}.json", '{"number": ')
    write_bucket(files.filter("doc_id % 2 = 1"), bucket)
    ingest(spark, bucket, state)
    return _places(spark, state)


def _broken_off(spark, sf_dir, label):
    """A bucket and the state of a run over it that wrote all its tables and went no further."""
    work = new_work_dir(spark, label)
    bucket, state = f"{work}/bucket", f"{work}/state"
    write_bucket(_files(spark, sf_dir), bucket)
    run = _Run(spark, scan_bucket(spark, bucket), state, RunOptions(mode="backfill"))
    run.open()
    run._process()
    run._publish_mail()
    run.close()
    return bucket, state


@query("crash_recovery", _PLACES_SQL)
def crash_recovery(spark, sf_dir):
    """A run that broke off before its commit, and the run that repeats it."""
    bucket, state = _broken_off(spark, sf_dir, "crash")
    ingest(spark, bucket, state)
    return _places(spark, state)


@query(
    "recovery_counts",
    f"""WITH {FILES_CTE} SELECT count(*) AS files_changed, count(*) AS recovered_in_progress,
      CAST(5 AS BIGINT) AS recovered_tmp_files FROM files""",
)
def recovery_counts(spark, sf_dir):
    """Counters of the run that finds another one broken off: sources in progress, and the folders it left
    (emails, lineage, skipped, pool, manifest)."""
    bucket, state = _broken_off(spark, sf_dir, "crash-counts")
    stats = ingest(spark, bucket, state)
    return stats.frame(spark).select("files_changed", "recovered_in_progress", "recovered_tmp_files")


@query(
    "failed_sources",
    f"""WITH {FILES_CTE} SELECT namespace, partition, relpath,
      CASE WHEN doc_id % 2 = 1 THEN 'failed' ELSE 'done' END AS first_status, 'done' AS status FROM files""",
)
def failed_sources(spark, sf_dir):
    """A run over half of the files, then one over all that fails at work: its files are marked failed and the
    others stay as they were; the next run takes them up."""
    work = new_work_dir(spark, "failed")
    bucket, state = f"{work}/bucket", f"{work}/state"
    write_bucket(_files(spark, sf_dir), bucket)
    ingest_scanned(spark, scan_bucket(spark, bucket).filter(_number() % 2 == 0), state)
    run = _Run(spark, scan_bucket(spark, bucket), state, RunOptions())
    run.open()
    run._abort()
    run.close()
    where = ["namespace", "partition", "relpath"]
    first = StateStore(spark, state).source_files().select(*where, F.col("status").alias("first_status"))
    ingest(spark, bucket, state)
    # the first states are read from folders that stay: nothing is merged after three runs
    return first.join(StateStore(spark, state).source_files().select(*where, "status"), where)


@query(
    "removed_files",
    f"""WITH {FILES_CTE} SELECT namespace, partition, relpath, 'done' AS status FROM files""",
)
def removed_files(spark, sf_dir):
    """The ledger after a pass over a bucket from which half of the files are gone: it keeps them as they were."""
    work = new_work_dir(spark, "removed")
    bucket, state = f"{work}/bucket", f"{work}/state"
    write_bucket(_files(spark, sf_dir), bucket)
    ingest(spark, bucket, state)
    ingest_scanned(spark, scan_bucket(spark, bucket).filter(_number() % 2 == 0), state)
    return StateStore(spark, state).source_files().select("namespace", "partition", "relpath", "status")


_PLACE_OF = {
    0: ("timestamp=2024-07-15/like.eml/", True),  # a directory that is named like a mail
    1: ("", False),  # beside the date directories
    2: ("day=2024-07-15/", False),
    3: ("timestamp=2024-7-15/", False),
    4: ("timestamp=2024-07-15/a/.b/c d/", True),
}


@query(
    "scan_root_contract",
    """SELECT source AS namespace, 'timestamp=2024-07-15' AS partition,
      CASE doc_id % 5 WHEN 0 THEN 'like.eml/' ELSE 'a/.b/c d/' END || doc_id || '.eml' AS relpath,
      CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes FROM documents WHERE doc_id % 5 IN (0, 4)""",
)
def scan_root_contract(spark, sf_dir):
    """What a scan takes for a file of the bucket: regular files at any depth below date directories, whatever
    the directories are named; nothing that lies beside those; and nothing of a bucket that is missing."""
    root = f"{new_work_dir(spark, 'contract')}/bucket"
    folder = F.lit(None).cast("string")
    for k, (place, _) in _PLACE_OF.items():
        folder = F.when(F.col("doc_id") % 5 == k, place).otherwise(folder)
    sources.register(spark)
    table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), folder, F.col("doc_id").cast("string"), F.lit(".eml")).alias("path"),
        F.col("text").cast("binary").alias("content"),
    ).write.format("file_tree").mode("append").save(root)
    found = scan_bucket(spark, root).unionByName(scan_bucket(spark, f"{root}-missing"))
    return found.select("namespace", "partition", "relpath", "size_bytes")


@query(
    "ledger_times",
    f"""WITH {FILES_CTE} SELECT namespace, partition, relpath,
      strftime(make_timestamp((1700000000 + doc_id * 3601) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS first_seen
    FROM files""",
)
def ledger_times(spark, sf_dir):
    """Times of the ledger as text, to the second and in UTC."""
    seen = F.timestamp_seconds(F.col("doc_id") * 3601 + 1_700_000_000)
    return bucket_files(spark, sf_dir).select(
        "namespace", "partition", "relpath", identity.render_utc(seen).alias("first_seen")
    )
