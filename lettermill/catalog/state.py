"""Queries consumers run on the state tables, over tables derived from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettermill.catalog import query
from lettermill.catalog.changes import LEDGER_CTE, derived_ledger
from lettermill.catalog.dedup import WINNERS_CTE, emails_of
from lettermill.catalog.derived import (
    FILES_CTE,
    LEAVES_CTE,
    as_items,
    bucket_files,
    kind_sql,
    leaves,
    source_id_sql,
)
from lettermill.operators import dedup, reports
from lettermill.operators.unpack import classify_wave

_PATH_SQL = """'emails/' || substr(email_id, 1, 2) || '/' || email_id ||
  CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END"""


def lineage(spark, sf_dir):
    return dedup.lineage_edges(leaves(spark, sf_dir))


def emails(spark, sf_dir):
    return emails_of(leaves(spark, sf_dir))


def skipped(spark, sf_dir):
    wave = classify_wave(as_items(bucket_files(spark, sf_dir)))
    return wave.filter(F.col("entry") == "skip")


@query(
    "lineage_by_email",
    f"""WITH {LEAVES_CTE} SELECT email_id, source_id, partition, relpath AS internal_path
    FROM leaves WHERE email_id = (SELECT min(email_id) FROM (
      SELECT email_id FROM leaves GROUP BY email_id HAVING count(*) = (
        SELECT max(n) FROM (SELECT count(*) AS n FROM leaves GROUP BY email_id))))""",
)
def lineage_by_email(spark, sf_dir):
    """All places of the email that was found most often."""
    edges = lineage(spark, sf_dir)
    most = (
        edges.groupBy("email_id").agg(F.count("*").alias("n"))
        .agg(F.min_by("email_id", F.struct(-F.col("n"), F.col("email_id"))).alias("email_id"))
    )
    return reports.lineage_of_emails(edges, most).select(
        "email_id", "source_id", "partition", "internal_path"
    )


@query(
    "lineage_by_partition",
    f"""WITH {LEAVES_CTE} SELECT email_id, source_id, namespace, relpath AS internal_path
    FROM leaves WHERE partition = 'timestamp=2024-07-15'""",
)
def lineage_by_partition(spark, sf_dir):
    return reports.lineage_of_partition(lineage(spark, sf_dir), "timestamp=2024-07-15").select(
        "email_id", "source_id", "namespace", "internal_path"
    )


@query(
    "source_status",
    f"""WITH {LEDGER_CTE} SELECT {source_id_sql()} AS source_id, namespace, partition, relpath, status
    FROM files JOIN ledger USING (doc_id)""",
)
def source_status(spark, sf_dir):
    return reports.source_status(derived_ledger(bucket_files(spark, sf_dir)))


@query(
    "source_lookup",
    f"""WITH {LEDGER_CTE} SELECT {source_id_sql()} AS source_id, status, old_size AS size_bytes
    FROM files JOIN ledger USING (doc_id)
    WHERE namespace = 'src1' AND partition = 'timestamp=2024-07-16' AND relpath = 'in/1.html'""",
)
def source_lookup(spark, sf_dir):
    """One source by its location."""
    ledger = derived_ledger(bucket_files(spark, sf_dir))
    return reports.source_at(ledger, "src1", "timestamp=2024-07-16", "in/1.html").select(
        "source_id", "status", "size_bytes"
    )


@query(
    "skip_counts",
    f"""WITH {FILES_CTE} SELECT CASE {kind_sql('relpath')} WHEN 'unsupported'
      THEN 'unsupported_format_deferred' ELSE 'not_an_email' END AS reason, count(*) AS skips
    FROM files WHERE {kind_sql('relpath')} IN ('unsupported', 'noise') GROUP BY 1""",
)
def skip_counts(spark, sf_dir):
    return reports.skip_counts(skipped(spark, sf_dir))


@query(
    "reconcile_manifest",
    f"""WITH {WINNERS_CTE}, e AS (SELECT email_id FROM emails WHERE size_bytes % 17 <> 0),
    m AS (SELECT DISTINCT email_id FROM leaves WHERE size_bytes % 13 <> 0)
    SELECT email_id, 'emails' AS missing_in FROM m WHERE email_id NOT IN (SELECT email_id FROM e)
    UNION ALL
    SELECT email_id, 'manifest' FROM e WHERE email_id NOT IN (SELECT email_id FROM m)""",
)
def reconcile_manifest(spark, sf_dir):
    """Ids that only one of manifest and emails holds; gaps planted on both sides."""
    mail = leaves(spark, sf_dir)
    manifest = mail.filter(F.col("size_bytes") % 13 != 0)
    return reports.manifest_mismatches(
        manifest, emails(spark, sf_dir).filter(F.col("size_bytes") % 17 != 0)
    )


@query(
    "integrity_orphans",
    f"""WITH {WINNERS_CTE}, src AS (SELECT {source_id_sql()} AS source_id FROM files WHERE doc_id % 19 <> 0),
    e AS (SELECT email_id FROM emails WHERE size_bytes % 17 <> 0),
    s AS (SELECT {source_id_sql()} AS source_id, relpath FROM files
      WHERE {kind_sql('relpath')} IN ('unsupported', 'noise'))
    SELECT 'lineage.email_id' AS reference, email_id AS missing_id, relpath AS internal_path
      FROM leaves WHERE email_id NOT IN (SELECT email_id FROM e)
    UNION ALL SELECT 'lineage.source_id', source_id, relpath FROM leaves
      WHERE source_id NOT IN (SELECT source_id FROM src)
    UNION ALL SELECT 'skipped.source_id', source_id, relpath FROM s
      WHERE source_id NOT IN (SELECT source_id FROM src)""",
)
def integrity_orphans(spark, sf_dir):
    """References to emails and sources that are gone; some are planted."""
    files = bucket_files(spark, sf_dir)
    known = as_items(files.filter(F.col("doc_id") % 19 != 0)).select("source_id")
    kept = emails(spark, sf_dir).filter(F.col("size_bytes") % 17 != 0)
    return reports.orphans(lineage(spark, sf_dir), skipped(spark, sf_dir), kept, known)


def planted_pool(spark, sf_dir):
    blobs = dedup.blob_winners(leaves(spark, sf_dir))
    return blobs.filter(F.col("w.size_bytes") % 11 != 0)


POOL_CTE = f"""{WINNERS_CTE}, ext AS (SELECT *, CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS ext
    FROM leaves),
  blobs AS (SELECT email_id, ext, size_bytes, row_number() OVER (PARTITION BY email_id, ext
    ORDER BY namespace, partition, path_key) AS bn FROM ext),
  pool AS (SELECT email_id, ext FROM blobs WHERE bn = 1 AND size_bytes % 11 <> 0),
  keyed AS (SELECT *, CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS ext FROM emails)"""


@query(
    "pool_missing",
    f"""WITH {POOL_CTE} SELECT k.email_id, {_PATH_SQL.replace('email_id', 'k.email_id')} AS pool_path
    FROM keyed k LEFT JOIN pool p ON k.email_id = p.email_id AND k.ext = p.ext WHERE p.email_id IS NULL""",
)
def pool_missing(spark, sf_dir):
    """Emails whose blob is gone; some blobs are left out on purpose."""
    return reports.pool_missing(emails(spark, sf_dir), planted_pool(spark, sf_dir)).select(
        "email_id", "pool_path"
    )


@query(
    "pool_membership",
    f"""WITH {POOL_CTE} SELECT k.email_id, k.format FROM keyed k
    JOIN pool p ON k.email_id = p.email_id AND k.ext = p.ext""",
)
def pool_membership(spark, sf_dir):
    return reports.in_pool(emails(spark, sf_dir), planted_pool(spark, sf_dir)).select(
        "email_id", "format"
    )


@query(
    "lineage_trace",
    f"""WITH {LEAVES_CTE} SELECT email_id, source_id, namespace, partition, relpath,
      relpath || '!a/mail.mbox#' || (doc_id % 3) AS internal_path, 2 AS container_depth,
      relpath AS bucket_file, 3 AS hops, CAST(doc_id % 3 AS VARCHAR) AS last_hop FROM leaves""",
)
def lineage_trace(spark, sf_dir):
    """Leaves traced through their containers to the bucket file."""
    mail = leaves(spark, sf_dir).withColumns(
        {
            "internal_path": F.concat(
                "relpath", F.lit("!a/mail.mbox#"), (F.col("doc_id") % 3).cast("string")
            ),
            "container_depth": F.lit(2),
        }
    )
    files = as_items(bucket_files(spark, sf_dir)).select("source_id", "relpath")
    return reports.trace(dedup.lineage_edges(mail).drop("relpath", "format"), files)


@query(
    "partition_contents",
    f"""WITH {WINNERS_CTE}, present AS (SELECT DISTINCT partition, email_id FROM leaves)
    SELECT p.partition, e.email_id, e.namespace, e.size_bytes, e.format,
      {_PATH_SQL.replace('email_id', 'e.email_id')} AS pool_path
    FROM present p JOIN emails e USING (email_id)""",
)
def partition_contents(spark, sf_dir):
    """Emails present in each date partition."""
    return reports.partition_contents(lineage(spark, sf_dir), emails(spark, sf_dir)).select(
        "partition", "email_id", "namespace", "size_bytes", "format", "pool_path"
    )
