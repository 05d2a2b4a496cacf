"""Whole runs over buckets written from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettermill import sources
from lettermill.catalog import query
from lettermill.catalog.builders import mailbox, mailbox_sql, members, messages_cte, pack_zip
from lettermill.catalog.derived import (
    FILES_CTE,
    bucket_files,
    email_id_sql,
    framed_text,
    kind_sql,
    table,
)
from lettermill.functions import identity
from lettermill.plans.ingest import RunOptions, export_pool, ingest, scan_bucket
from lettermill.plans.state import StateStore
from lettermill.sources.opening import hash_files
from lettermill.storage import FREE_SHUFFLES, delete_tree, new_work_dir, session_settings, small_batches

#: Rounds in which a bucket is filled and emptied, at most, and bytes of documents that one stands for, at least.
ROUNDS, ROUND_BYTES = 4, 32 << 20


def _partition():
    day = F.lpad((F.col("doc_id") % 7 + 15).cast("string"), 2, "0")
    return F.concat(F.lit("timestamp=2024-07-"), day)


def _day():
    return F.coalesce(_partition(), F.lit(""))


def contents(spark, sf_dir, days=None):
    """namespace, partition, relpath and content of every file of the bucket:
    the derived mail files, a mailbox or an archive next to two of three.
    With `days`, the files of these date directories alone."""
    wanted = F.lit(True) if days is None else _day().isin(days)
    docs = table(spark, sf_dir, "documents").filter(wanted).withColumns(
        {"namespace": F.col("source"), "partition": _partition()}
    )
    number, text = F.col("doc_id").cast("string"), F.col("text")
    columns = ["doc_id", "namespace", "partition", "relpath", "content"]
    plain = bucket_files(spark, sf_dir).filter(wanted).withColumn("content", F.col("raw"))
    boxes = docs.filter(F.col("doc_id") % 3 == 0).withColumns(
        {
            "relpath": F.concat(F.lit("boxes/"), number, F.lit(".mbox")),
            "content": mailbox(text, F.concat(F.col("lang"), F.lit(" "), text)).cast("binary"),
        }
    )
    packs = docs.filter(F.col("doc_id") % 3 == 1).repartition("doc_id").withColumn(
        "relpath", F.concat(F.lit("packs/"), number, F.lit(".zip"))
    )
    packs = pack_zip(
        packs.withColumn("inner_members", members(("deep.html", framed_text()))),
        "inner_members", "inner",
    )
    packs = pack_zip(
        packs.withColumn("outer_members", members(("in.eml", text), ("inner.zip", F.col("inner")))),
        "outer_members", "content",
    )
    return (
        plain.select(*columns).unionByName(boxes.select(*columns)).unionByName(packs.select(*columns))
    )


def write_bucket(files, root, overwrite=False):
    """Write the files, one task per share of them."""
    sources.register(files.sparkSession)
    small_batches(files.sparkSession)
    rows = files.select(F.concat_ws("/", "namespace", "partition", "relpath").alias("path"), "content")
    with session_settings(files.sparkSession, FREE_SHUFFLES):
        rows.write.format("file_tree").mode("append").option(
            "overwrite_files", str(overwrite).lower()
        ).save(root)


def _fresh(spark, sf_dir, label):
    work = new_work_dir(spark, label)
    write_bucket(contents(spark, sf_dir), f"{work}/bucket")
    return f"{work}/bucket", f"{work}/state"


def _rounds(spark, sf_dir):
    """The days of the bucket in their order, in rounds of about equal bytes; None stands for all of them."""
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    days = docs.groupBy(_day().alias("day")).agg(F.sum(size).alias("bytes")).orderBy("day").collect()
    total = sum(r["bytes"] for r in days)
    n = min(ROUNDS, total // ROUND_BYTES)
    if n < 2:
        return [None]
    rounds, before = {}, 0
    for day, own in days:
        at = n * (2 * before + own) // (2 * total)  # where the middle of the day lies
        rounds.setdefault(min(n - 1, at), []).append(day)
        before += own
    return list(rounds.values())


def _ingested(spark, sf_dir, label):
    """The state after a backfill of the bucket.

    As files the bucket is several times as large as its documents, so it never stands there as a
    whole: the files of some days are written, ingested and deleted before those of the next days.
    Ids are scoped by tenant, and a tenant's files are in order of their days: who was seen first is
    the same as in a single run.
    """
    work = new_work_dir(spark, label)
    bucket, state = f"{work}/bucket", f"{work}/state"
    for days in _rounds(spark, sf_dir):
        write_bucket(contents(spark, sf_dir, days), bucket)
        ingest(spark, bucket, state, RunOptions(mode="backfill"))
        delete_tree(spark, bucket)
    return state


BUCKET_CTE = f"""{FILES_CTE},
  boxes AS (SELECT doc_id, namespace, partition, {mailbox_sql('text', "d.lang || ' ' || text")} AS box
    FROM files f JOIN documents d USING (doc_id) WHERE doc_id % 3 = 0),
  {messages_cte('boxes', 'doc_id, namespace, partition')},
  places AS (
    SELECT namespace, partition, relpath, relpath AS internal_path, 0 AS container_depth,
      {kind_sql('relpath')} AS format, 0 AS hops, '' AS pos, -1 AS msg_idx, body FROM files
      WHERE {kind_sql('relpath')} IN ('eml', 'html')
    UNION ALL SELECT namespace, partition, 'boxes/' || doc_id || '.mbox',
      'boxes/' || doc_id || '.mbox#' || msg_idx, 1, 'eml', 0, '', msg_idx, body FROM messages
    UNION ALL SELECT namespace, partition, 'packs/' || doc_id || '.zip',
      'packs/' || doc_id || '.zip!in.eml', 1, 'eml', 1, '0', -1, text
      FROM files JOIN documents d USING (doc_id) WHERE doc_id % 3 = 1
    UNION ALL SELECT namespace, partition, 'packs/' || doc_id || '.zip',
      'packs/' || doc_id || '.zip!inner.zip!deep.html', 2, 'html', 2, '1.0', -1, body
      FROM files WHERE doc_id % 3 = 1),
  found AS (SELECT *, {email_id_sql('namespace', 'body')} AS email_id, sha256(body) AS content_sha256,
    CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes,
    list_transform(string_split(relpath, '/'), lambda p, i:
      {{'is_dir': i < len(string_split(relpath, '/')), 'name': p}}) AS path_key FROM places),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY email_id
    ORDER BY namespace, partition, path_key, hops, pos, msg_idx) AS rn FROM found)"""

_EMAILS_SQL = f"""WITH {BUCKET_CTE} SELECT email_id, namespace, content_sha256,
    content_sha256 AS blob_sha256, size_bytes, format,
    'emails/' || substr(email_id, 1, 2) || '/' || email_id ||
      CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS pool_path
  FROM ranked WHERE rn = 1"""


def _emails_with_blob(store):
    blobs = store.read("pool").select(
        "email_id", "ext", identity.content_sha256("raw").alias("blob_sha256")
    )
    keyed = store.read("emails").withColumn("ext", identity.leaf_suffix("format"))
    return keyed.join(blobs, ["email_id", "ext"]).select(
        "email_id", "namespace", "content_sha256", "blob_sha256", "size_bytes", "format", "pool_path"
    )


@query(
    "bucket_scan_files",
    f"""WITH {FILES_CTE} SELECT namespace, partition, relpath,
      CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes FROM files
    WHERE partition >= 'timestamp=2024-07-17'""",
)
def bucket_scan_files(spark, sf_dir):
    """A bucket written out and listed again, from one day on."""
    root = f"{new_work_dir(spark, 'scan')}/bucket"
    write_bucket(bucket_files(spark, sf_dir).withColumn("content", F.col("raw")), root)
    columns = ["namespace", "partition", "relpath", "size_bytes"]
    return scan_bucket(spark, root, {"min_partition": "timestamp=2024-07-17"}).select(*columns)


@query(
    "bucket_ingest",
    f"""WITH {BUCKET_CTE} SELECT namespace, partition, relpath, internal_path, container_depth, email_id
    FROM found""",
)
def bucket_ingest(spark, sf_dir):
    """A backfill from files to tables; every lineage edge with its file."""
    bucket, state = _fresh(spark, sf_dir, "ingest")
    ingest(spark, bucket, state, RunOptions(mode="backfill"))
    store = StateStore(spark, state)
    located = store.source_files().select("source_id", "relpath")
    return store.read("lineage").join(located, "source_id").select(
        "namespace", "partition", "relpath", "internal_path", "container_depth", "email_id"
    )


@query("bucket_emails", _EMAILS_SQL)
def bucket_emails(spark, sf_dir):
    """Emails of a backfill, checked against the bytes in the pool."""
    bucket, state = _fresh(spark, sf_dir, "emails")
    ingest(spark, bucket, state, RunOptions(mode="backfill"))
    return _emails_with_blob(StateStore(spark, state))


@query("bucket_in_slices", _EMAILS_SQL)
def bucket_in_slices(spark, sf_dir):
    """The same backfill with every mailbox and archive treated as too big for
    a row: mailboxes as splittable text, archives member range by member range."""
    bucket, state = _fresh(spark, sf_dir, "slices")
    ingest(spark, bucket, state, RunOptions(mode="backfill", inline_bytes=0, slice_bytes=1000))
    return _emails_with_blob(StateStore(spark, state))


@query(
    "bucket_rerun",
    f"""WITH {FILES_CTE}, one AS (SELECT doc_id, {kind_sql('relpath')} IN ('eml', 'html') AS mail,
        {email_id_sql('namespace', 'body')} AS id FROM files),
      two AS (SELECT doc_id, {email_id_sql('namespace', "body || ' again'")} AS id FROM files
        WHERE doc_id % 4 = 1 AND {kind_sql('relpath')} IN ('eml', 'html')),
      n AS (SELECT count(*) AS files, count(*) FILTER (mail) AS mails,
        count(DISTINCT id) FILTER (mail) AS ids FROM one),
      c AS (SELECT count(*) AS files, count(*) FILTER (NOT mail) AS skips FROM one WHERE doc_id % 4 = 1),
      s AS (SELECT count(*) AS leaves, count(DISTINCT id) AS distinct_ids,
        count(DISTINCT id) FILTER (id NOT IN (SELECT id FROM one WHERE mail)) AS staged FROM two)
    SELECT 1 AS run, n.files AS files_scanned, n.files AS files_new, 0 AS files_changed,
      0 AS files_unchanged, 0 AS files_metadata_only, ids AS emails_staged,
      mails - ids AS emails_relinked, n.files - mails AS skipped FROM n
    UNION ALL SELECT 2, n.files, 0, c.files,
      (SELECT count(*) FROM files WHERE doc_id % 4 IN (2, 3)),
      (SELECT count(*) FROM files WHERE doc_id % 4 = 0), staged, leaves - staged, c.skips FROM n, c, s
    UNION ALL SELECT 3, n.files, 0, 0, n.files, 0, 0, 0, 0 FROM n""",
)
def bucket_rerun(spark, sf_dir):
    """Counters of three runs: a backfill; one after a quarter of the files was
    written again and a quarter was changed; one after nothing happened."""
    work = new_work_dir(spark, "rerun")
    bucket, state = f"{work}/bucket", f"{work}/state"
    files = bucket_files(spark, sf_dir).withColumn("content", F.col("raw"))
    write_bucket(files, bucket)
    runs = [ingest(spark, bucket, state, RunOptions(mode="backfill"))]
    k = F.col("doc_id") % 4
    # As a suffix the addition is not undone by the canonical form.
    changed = F.when(k == 1, F.concat("raw", F.lit(" again").cast("binary"))).otherwise(F.col("raw"))
    write_bucket(files.filter(k < 2).withColumn("content", changed), bucket, overwrite=True)
    runs += [ingest(spark, bucket, state), ingest(spark, bucket, state)]
    rows = None
    for number, stats in enumerate(runs, 1):
        row = stats.frame(spark).withColumn("run", F.lit(number))
        rows = row if rows is None else rows.unionByName(row)
    return rows.drop("files_failed", "files_elsewhere", "recovered_in_progress", "recovered_tmp_files")


@query(
    "pool_export",
    f"""WITH {BUCKET_CTE}, ext AS (SELECT *, CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS ext
        FROM found),
      blobs AS (SELECT *, row_number() OVER (PARTITION BY email_id, ext
        ORDER BY namespace, partition, path_key, hops, pos, msg_idx) AS bn FROM ext)
    SELECT substr(email_id, 1, 2) || '/' || email_id || ext AS pool_file, size_bytes, content_sha256
    FROM blobs WHERE bn = 1""",
)
def pool_export(spark, sf_dir):
    """The pool as files; a second export finds them all in place."""
    state = _ingested(spark, sf_dir, "export")
    target = f"{state}/export"
    export_pool(spark, state, target)
    export_pool(spark, state, target)
    rows = StateStore(spark, state).read("pool").select(
        identity.pool_relpath("email_id", F.col("ext")).alias("pool_file"),
        F.octet_length("raw").cast("bigint").alias("size_bytes"),
    )
    hashed = hash_files(rows.withColumn("abspath", F.concat(F.lit(f"{target}/"), F.col("pool_file"))))
    return hashed.select("pool_file", "size_bytes", "content_sha256")
