"""Streaming runs over notices derived from events, and over a bucket."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettermill.catalog import query
from lettermill.catalog.buckets import BUCKET_CTE, contents, write_bucket
from lettermill.catalog.derived import table
from lettermill.plans.state import StateStore
from lettermill.storage import new_work_dir
from lettermill.streaming.runs import VerdictLog, ingest_stream

_BATCHES = 3


def _finish(stream) -> None:
    """Wait for a stream that ends by itself, as long as it takes; its failure is raised."""
    stream.awaitTermination()


@query(
    "incremental_stream",
    f"""WITH n AS (SELECT event_id % {_BATCHES} AS batch, 'u' || user_id AS namespace,
      event_type || '.eml' AS relpath, event_id,
      CAST(floor(value * 100) AS BIGINT) % 7 AS size_bytes, event_id // 5 AS mtime_ns,
      sha256(CAST(CAST(floor(value * 100) AS BIGINT) % 3 AS VARCHAR)) AS sha FROM events),
    last AS (SELECT batch, namespace, relpath, arg_max(size_bytes, event_id) AS size_bytes,
      arg_max(mtime_ns, event_id) AS mtime_ns, arg_max(sha, event_id) AS sha
      FROM n GROUP BY batch, namespace, relpath),
    prev AS (SELECT *, lag(size_bytes) OVER w AS old_size, lag(mtime_ns) OVER w AS old_mtime,
      lag(sha) OVER w AS old_sha FROM last WINDOW w AS (PARTITION BY namespace, relpath ORDER BY batch))
    SELECT batch, namespace, relpath, CASE WHEN old_size IS NULL THEN 'new'
      WHEN old_size = size_bytes AND old_mtime = mtime_ns THEN 'unchanged'
      WHEN old_sha = sha THEN 'metadata_only' ELSE 'changed' END AS decision FROM prev""",
)
def incremental_stream(spark, sf_dir):
    """Events as file notices in three deliveries; each delivery is one run of
    the stream, judged against the ledger the earlier ones left."""
    work = new_work_dir(spark, "stream")
    amount = F.floor(F.col("value") * 100).cast("bigint")
    notices = table(spark, sf_dir, "events").select(
        (F.col("event_id") % _BATCHES).alias("delivery"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("namespace"),
        F.lit("timestamp=2024-07-15").alias("partition"),
        F.concat("event_type", F.lit(".eml")).alias("relpath"),
        F.col("event_id"),
        (amount % 7).alias("size_bytes"),
        F.floor(F.col("event_id") / 5).cast("bigint").alias("mtime_ns"),
        F.sha2((amount % 3).cast("string"), 256).alias("sha256"),
    )
    log = VerdictLog(spark, f"{work}/log", order="event_id")
    for delivery in range(_BATCHES):
        rows = notices.filter(F.col("delivery") == delivery).drop("delivery")
        rows.write.mode("append").parquet(f"{work}/inbox")
        stream = spark.readStream.schema(rows.schema).parquet(f"{work}/inbox")
        _finish(log.run(stream, f"{work}/checkpoint"))
    return log.verdicts().select(
        F.col("batch").cast("bigint").alias("batch"), "namespace", "relpath", "decision"
    )


@query(
    "bucket_stream",
    f"""WITH {BUCKET_CTE} SELECT namespace, partition, internal_path, container_depth, email_id FROM found""",
)
def bucket_stream(spark, sf_dir):
    """The bucket as a stream source: days up to the 18th are there for the
    first pass, the others, older days among them, arrive before the second."""
    work = new_work_dir(spark, "bucket-stream")
    files = contents(spark, sf_dir)
    late = F.col("partition").isin("timestamp=2024-07-15", "timestamp=2024-07-19",
                                   "timestamp=2024-07-20", "timestamp=2024-07-21")
    for part in (files.filter(~late), files.filter(late)):
        write_bucket(part, f"{work}/bucket")
        _finish(
            ingest_stream(spark, f"{work}/bucket", f"{work}/state", f"{work}/checkpoint", every=None)
        )
    return StateStore(spark, f"{work}/state").read("lineage").select(
        "namespace", "partition", "internal_path", "container_depth", "email_id"
    )
