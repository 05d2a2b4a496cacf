"""First-seen deduplication, lineage, manifest and run counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.catalog import query
from lettermill.catalog.derived import LEAVES_CTE, bucket_files, leaves, mail_leaves
from lettermill.functions.manifest import manifest_json
from lettermill.operators import dedup, reports
from lettermill.storage import stored

# Days up to this one make up the first run, later days the second.
FIRST_RUN_UNTIL = "timestamp=2024-07-17"


def two_runs(spark, sf_dir):
    mail = stored(leaves(spark, sf_dir).drop("raw"), "leaves")
    early = F.col("partition") <= FIRST_RUN_UNTIL
    return mail.filter(early), mail.filter(~early)


def emails_of(mail, committed=None):
    now = F.timestamp_seconds(F.lit(1_721_000_000))
    return dedup.new_emails(dedup.email_winners(dedup.blob_winners(mail)), committed, now)


WINNERS_CTE = f"""{LEAVES_CTE}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY namespace, partition, path_key) AS rn,
    count(*) OVER (PARTITION BY email_id) AS copies FROM leaves),
  emails AS (SELECT * FROM ranked WHERE rn = 1)"""

RUNS_CTE = f"""{LEAVES_CTE}, runs AS (
  SELECT *, CASE WHEN partition <= '{FIRST_RUN_UNTIL}' THEN 1 ELSE 2 END AS run FROM leaves),
  staged AS (SELECT email_id, min(run) AS run FROM runs GROUP BY email_id)"""


@query(
    "dedup_first_seen",
    f"""WITH {LEAVES_CTE.replace('source AS namespace', 'lang AS namespace')},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY email_id
        ORDER BY namespace, partition, path_key) AS rn,
      count(*) OVER (PARTITION BY email_id) AS copies FROM leaves)
    SELECT email_id, copies, namespace, source_id, content_sha256, size_bytes, format
    FROM ranked WHERE rn = 1""",
)
def dedup_first_seen(spark, sf_dir):
    """The first copy in scan order supplies the attributes of an email."""
    files = bucket_files(spark, sf_dir).withColumn("namespace", F.col("lang"))
    winners = dedup.email_winners(dedup.blob_winners(mail_leaves(files)))
    return winners.select(
        "email_id", "copies", "namespace", "source_id", "content_sha256", "size_bytes", "format"
    )


@query(
    "pool_blobs",
    f"""WITH {LEAVES_CTE}, ext AS (SELECT *, CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS ext
      FROM leaves), ranked AS (SELECT *, row_number() OVER (PARTITION BY email_id, ext
        ORDER BY namespace, partition, path_key) AS rn,
      count(*) OVER (PARTITION BY email_id, ext) AS copies FROM ext)
    SELECT email_id, ext, copies, content_sha256, size_bytes FROM ranked WHERE rn = 1""",
)
def pool_blobs(spark, sf_dir):
    """One blob per id and suffix, from the first copy."""
    blobs = dedup.blob_winners(leaves(spark, sf_dir))
    return blobs.select(
        "email_id", "ext", "copies",
        F.col("w.content_sha256").alias("content_sha256"), F.col("w.size_bytes").alias("size_bytes"),
    )


@query(
    "dedup_across_runs",
    f"""WITH {RUNS_CTE} SELECT email_id, run FROM staged""",
)
def dedup_across_runs(spark, sf_dir):
    """Which run staged each email: the second run stages only what is new."""
    first, second = two_runs(spark, sf_dir)
    one = stored(emails_of(first), "first-run")
    two = emails_of(second, one)
    return one.select("email_id", F.lit(1).alias("run")).unionByName(
        two.select("email_id", F.lit(2).alias("run"))
    )


@query(
    "lineage_edges",
    f"""WITH {LEAVES_CTE}, places AS (
      SELECT namespace, partition, relpath, email_id FROM leaves
      UNION ALL SELECT namespace, 'timestamp=2024-08-01', relpath, email_id FROM leaves)
    SELECT DISTINCT email_id,
      sha256(concat(namespace, chr(0), partition, chr(0), relpath)) AS source_id,
      partition, relpath AS internal_path, 0 AS container_depth FROM places""",
)
def lineage_edges(spark, sf_dir):
    """Edges of a bucket that was uploaded, uploaded again, and copied to a later
    day: the repeat adds nothing, the copy adds one edge per file."""
    files = bucket_files(spark, sf_dir)
    first = stored(dedup.lineage_edges(mail_leaves(files)), "first-lineage")
    copied = files.withColumn("partition", F.lit("timestamp=2024-08-01"))
    again = stored(dedup.lineage_edges(mail_leaves(files.unionByName(copied))), "second-lineage")
    added = dedup.new_lineage(again, first)
    return first.unionByName(added).select(
        "email_id", "source_id", "partition", "internal_path", "container_depth"
    )


@query(
    "manifest_lines",
    f"""WITH {LEAVES_CTE} SELECT namespace, substr(partition, 11) AS timestamp, email_id,
      'emails/' || substr(email_id, 1, 2) || '/' || email_id ||
        CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS pool_path,
      format, relpath AS source, relpath AS internal_path, 0 AS depth, 1 AS places FROM leaves""",
)
def manifest_lines(spark, sf_dir):
    """Manifest lines, written as JSON and parsed back."""
    edges = dedup.lineage_edges(leaves(spark, sf_dir))
    lines = edges.select(
        "namespace", F.substring("partition", 11, 10).alias("timestamp"),
        manifest_json().alias("line"),
    )
    parsed = lines.withColumn("m", F.from_json("line", S.MANIFEST_LINE))
    return parsed.select(
        "namespace", "timestamp", "m.email_id", "m.pool_path", "m.format",
        F.col("m.lineage")[0]["source"].alias("source"),
        F.col("m.lineage")[0]["internal_path"].alias("internal_path"),
        F.col("m.lineage")[0]["depth"].alias("depth"),
        F.size("m.lineage").alias("places"),
    )


@query(
    "run_stats",
    f"""WITH {RUNS_CTE}, c AS (
      SELECT r.run, count(*) AS scanned,
        (SELECT count(*) FROM staged s WHERE s.run = r.run) AS staged
      FROM runs r GROUP BY r.run)
    SELECT run, scanned AS files_scanned, staged AS emails_staged, scanned - staged AS emails_relinked,
      format('mode=incremental scanned={{}} new={{}} changed=0 unchanged=0 metadata_only=0 failed=0 '
        || 'emails_staged={{}} relinked={{}} skipped=0', scanned, scanned, staged, scanned - staged) AS summary
    FROM c""",
)
def run_stats(spark, sf_dir):
    """Counters and summary line of two runs, one row each."""
    first, second = two_runs(spark, sf_dir)
    one = stored(emails_of(first), "first-run")
    two = emails_of(second, one)
    rows = None
    for number, mail, staged in ((1, first, one), (2, second, two)):
        scanned = mail.agg(F.count("*").alias("files_scanned"))
        counts = reports.mail_counts(mail, staged).crossJoin(scanned)
        line = counts.withColumns(
            {"run": F.lit(number), "files_new": F.col("files_scanned")}
            | {c: F.lit(0) for c in ("files_changed", "files_unchanged", "files_metadata_only",
                                     "files_failed", "skipped")}
        ).withColumn("summary", reports.summary_line("incremental"))
        line = line.select("run", "files_scanned", "emails_staged", "emails_relinked", "summary")
        rows = line if rows is None else rows.unionByName(line)
    return rows
