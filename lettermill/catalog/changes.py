"""Change detection and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.catalog import query
from lettermill.catalog.derived import FILES_CTE, bucket_files, source_id_sql, table
from lettermill.functions import identity
from lettermill.operators import cdc, reports

# --- documents against a ledger derived from them ---------------------------

LEDGER_CTE = f"""{FILES_CTE}, ledger AS (
  SELECT doc_id,
    CASE doc_id % 11 WHEN 1 THEN 'in_progress' WHEN 2 THEN 'failed' WHEN 3 THEN 'discovered'
      ELSE 'done' END AS status,
    size_bytes + CASE WHEN doc_id % 5 = 1 THEN 1 ELSE 0 END AS old_size,
    mtime_ns - CASE WHEN doc_id % 3 = 1 THEN 10000000 ELSE 0 END AS old_mtime,
    CASE WHEN doc_id % 4 = 2 THEN sha256('stale') ELSE sha256(body) END AS old_sha
  FROM files WHERE doc_id % 7 <> 0),
verdicts AS (
  SELECT f.doc_id, f.namespace, f.partition, f.relpath, f.size_bytes, f.mtime_ns,
    CASE WHEN l.doc_id IS NULL THEN 'new'
      WHEN l.status <> 'done' THEN 'changed'
      WHEN old_size = size_bytes AND old_mtime = mtime_ns THEN 'unchanged'
      WHEN old_sha = sha256(body) THEN 'metadata_only'
      ELSE 'changed' END AS decision,
    sha256(body) AS sha
  FROM files f LEFT JOIN ledger l USING (doc_id))"""


def derived_ledger(files):
    """What an earlier, partly broken run could have left behind."""
    k = F.col("doc_id")
    status = (
        F.when(k % 11 == 1, S.IN_PROGRESS).when(k % 11 == 2, S.FAILED)
        .when(k % 11 == 3, S.DISCOVERED).otherwise(S.DONE)
    )
    seen = F.timestamp_seconds(F.lit(1_720_000_000))
    return cdc.with_source_id(files.filter(k % 7 != 0)).select(
        "source_id", "namespace", "partition", "relpath",
        (F.col("size_bytes") + F.when(k % 5 == 1, 1).otherwise(0)).alias("size_bytes"),
        (F.col("mtime_ns") - F.when(k % 3 == 1, 10_000_000).otherwise(0)).alias("mtime_ns"),
        F.when(k % 4 == 2, F.sha2(F.lit("stale"), 256))
        .otherwise(identity.content_sha256("raw")).alias("content_sha256"),
        status.alias("status"),
        seen.alias("first_seen_at"),
        seen.alias("last_processed_at"),
    )


def content_hash():
    """Content hash of files whose content is a column."""
    return identity.content_sha256("raw")


def verdicts(spark, sf_dir):
    files = bucket_files(spark, sf_dir)
    return cdc.classify(files, derived_ledger(files), content_hash())


@query(
    "cdc_verdicts",
    f"""WITH {LEDGER_CTE} SELECT doc_id, decision,
      CASE WHEN decision <> 'unchanged' THEN sha END AS content_sha256 FROM verdicts""",
)
def cdc_verdicts(spark, sf_dir):
    return verdicts(spark, sf_dir).select("doc_id", "decision", "content_sha256")


@query(
    "cdc_step_counts",
    f"""WITH {LEDGER_CTE} SELECT count(*) AS files_scanned,
      count(*) FILTER (decision = 'new') AS files_new,
      count(*) FILTER (decision = 'unchanged') AS files_unchanged,
      count(*) FILTER (decision = 'metadata_only') AS files_metadata_only,
      count(*) FILTER (decision = 'changed') AS files_changed FROM verdicts""",
)
def cdc_step_counts(spark, sf_dir):
    return reports.decision_counts(verdicts(spark, sf_dir))


@query(
    "ledger_after_run",
    f"""WITH {LEDGER_CTE} SELECT {source_id_sql()} AS source_id, decision,
      size_bytes, mtime_ns, sha AS content_sha256, 'done' AS status
      FROM verdicts WHERE decision <> 'unchanged'""",
)
def ledger_after_run(spark, sf_dir):
    """State of the touched sources once a run has started and finished them."""
    decided = verdicts(spark, sf_dir)
    now = F.timestamp_seconds(F.lit(1_721_000_000))
    started = cdc.started(decided.filter(F.col("decision").isin(S.NEW, S.CHANGED)), 2, now)
    outcome = started.select(
        "source_id", "relpath", F.col("content_sha256").alias("file_sha256"),
        F.lit(None).cast("string").alias("error"),
    )
    events = (
        started.unionByName(cdc.finished(started, outcome, 2, now))
        .unionByName(cdc.refreshed(decided, 2, now))
    )
    state = cdc.current_ledger(events)
    touched = decided.filter(F.col("decision") != S.UNCHANGED).select("source_id", "decision")
    return touched.join(state, "source_id").select(
        "source_id", "decision", "size_bytes", "mtime_ns", "content_sha256", "status"
    )


@query(
    "rerun_unchanged",
    f"""WITH {FILES_CTE} SELECT count(*) AS files_scanned, 0 AS files_new,
      count(*) AS files_unchanged, 0 AS files_metadata_only, 0 AS files_changed FROM files""",
)
def rerun_unchanged(spark, sf_dir):
    """A second run over the same files finds nothing to do."""
    files = bucket_files(spark, sf_dir)
    now = F.timestamp_seconds(F.lit(1_721_000_000))
    first = cdc.classify(files, spark.createDataFrame([], S.SOURCE_FILES), content_hash())
    started = cdc.started(first, 1, now)
    outcome = first.select(
        "source_id", "relpath", F.col("content_sha256").alias("file_sha256"),
        F.lit(None).cast("string").alias("error"),
    )
    ledger = cdc.current_ledger(started.unionByName(cdc.finished(started, outcome, 1, now)))
    return reports.decision_counts(cdc.classify(files, ledger, content_hash()))


@query(
    "source_collisions",
    """WITH p AS (SELECT doc_id, source, doc_id // 2 AS pair,
      CASE WHEN doc_id % 2 = 0 THEN 'in/' ELSE 'in' || chr(92) END || (doc_id // 2) || '.eml' AS relpath
      FROM documents)
    SELECT sha256(concat('tenant', chr(0), 'timestamp=2024-07-15', chr(0), replace(relpath, chr(92), '/')))
      AS source_id, count(*) AS files, min(relpath) AS first_relpath, max(relpath) AS last_relpath
    FROM p GROUP BY 1 HAVING count(*) > 1""",
)
def source_collisions(spark, sf_dir):
    """Files whose names differ only by the kind of slash share an id."""
    k = F.col("doc_id")
    files = table(spark, sf_dir, "documents").select(
        F.lit("tenant").alias("namespace"),
        F.lit("timestamp=2024-07-15").alias("partition"),
        F.concat(
            F.when(k % 2 == 0, "in/").otherwise("in\\"),
            F.floor(k / 2).cast("string"), F.lit(".eml"),
        ).alias("relpath"),
    )
    return cdc.source_id_collisions(files)


# --- the ledger as a log ----------------------------------------------------

_STATUS = {"signup": "discovered", "view": "in_progress", "click": "done",
           "purchase": "done", "error": "failed"}

EVENTS_CTE = """log AS (SELECT 'u' || user_id AS source_id, event_id, ts,
    CASE event_type WHEN 'signup' THEN 'discovered' WHEN 'view' THEN 'in_progress'
      WHEN 'error' THEN 'failed' ELSE 'done' END AS status,
    CAST(floor(value * 100) AS BIGINT) AS size_bytes FROM events),
  latest AS (SELECT source_id, arg_max(status, event_id) AS status,
    arg_max(size_bytes, event_id) AS size_bytes, max(event_id) AS run_seq,
    min(ts) AS first_seen_at, arg_max(ts, event_id) AS last_processed_at
    FROM log GROUP BY source_id)"""


def event_log(spark, sf_dir):
    """`events` read as ledger rows: a user is a source, an event a state change."""
    pairs = [F.lit(x) for kv in _STATUS.items() for x in kv]
    text = F.lit("").alias
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_id"),
        text("namespace"), text("partition"), text("relpath"),
        F.floor(F.col("value") * 100).cast("bigint").alias("size_bytes"),
        F.col("event_id").alias("mtime_ns"),
        text("content_sha256"),
        F.create_map(*pairs)[F.col("event_type")].alias("status"),
        F.col("ts").alias("first_seen_at"),
        F.col("ts").alias("last_processed_at"),
        F.col("event_id").alias("run_seq"),
        F.lit(cdc.FINISHED).alias("step"),
    )


@query(
    "ledger_current",
    f"""WITH {EVENTS_CTE} SELECT source_id, status, size_bytes, run_seq AS mtime_ns,
      first_seen_at, last_processed_at FROM latest""",
)
def ledger_current(spark, sf_dir):
    return cdc.current_ledger(event_log(spark, sf_dir)).select(
        "source_id", "status", "size_bytes", "mtime_ns", "first_seen_at", "last_processed_at"
    )


@query(
    "ledger_recovery",
    f"""WITH {EVENTS_CTE} SELECT source_id,
      CASE status WHEN 'in_progress' THEN 'discovered' ELSE status END AS status,
      first_seen_at FROM latest""",
)
def ledger_recovery(spark, sf_dir):
    """The ledger after the sweep that a run starts with."""
    log = event_log(spark, sf_dir)
    next_run = 1 << 60
    swept = log.unionByName(cdc.recovered(cdc.current_ledger(log), next_run))
    return cdc.current_ledger(swept).select("source_id", "status", "first_seen_at")


@query(
    "recovery_report",
    f"""WITH {EVENTS_CTE} SELECT count(*) FILTER (status = 'in_progress') AS in_progress_reset,
      count(*) AS sources FROM latest""",
)
def recovery_report(spark, sf_dir):
    ledger = cdc.current_ledger(event_log(spark, sf_dir))
    return ledger.agg(
        F.count_if(F.col("status") == S.IN_PROGRESS).alias("in_progress_reset"),
        F.count("*").alias("sources"),
    )
