"""Repeated and event-driven runs.

Both forms end in the same batch run per micro-batch. Its state is the ledger,
keyed by location and never expired, so a file that turns up late in an old date
directory is work like any other, and no watermark may drop it. A micro-batch
that is repeated after a crash finds its files done and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lettermill import schemas as S
from lettermill.operators import cdc
from lettermill.plans.ingest import RunOptions, RunStats, ingest_scanned, scan_bucket
from lettermill.plans.state import ConcurrentRun
from lettermill.storage import children, exists

CADENCE = "15 minutes"


def _start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _ingest_batch(batch: DataFrame, state: str, options: RunOptions, attempts: int = 3) -> RunStats:
    """A run that another one revoked is repeated: the stream goes on."""
    while True:
        try:
            return ingest_scanned(batch.sparkSession, batch, state, options)
        except ConcurrentRun:
            attempts -= 1
            if not attempts:
                raise


def ingest_stream(
    spark: SparkSession,
    bucket: str,
    state: str,
    checkpoint: str,
    every: str | None = CADENCE,
    options: RunOptions = RunOptions(),
    on_run: Callable[[RunStats], None] = lambda stats: None,
) -> StreamingQuery:
    """Bring the state up to date with a bucket again and again.

    Every trigger is one pass over the bucket. `every=None` does one pass.
    """
    passes = scan_bucket(spark, bucket, options.scan, stream=True)

    def each(batch: DataFrame, number: int) -> None:
        on_run(_ingest_batch(batch, state, options))

    return _start(passes, each, checkpoint, every)


def latest_notice(notices: DataFrame, order: str = "mtime_ns") -> DataFrame:
    """The last notice of each location within a batch."""
    place = ["namespace", "partition", "relpath"]
    rest = [c for c in notices.columns if c not in place]
    last = notices.groupBy(*place).agg(F.max_by(F.struct(*rest), order).alias("n"))
    return last.select(*place, *[F.col("n")[c].alias(c) for c in rest])


def notified_ingest(
    notices: DataFrame,
    state: str,
    checkpoint: str,
    every: str | None = CADENCE,
    options: RunOptions = RunOptions(),
    on_run: Callable[[RunStats], None] = lambda stats: None,
) -> StreamingQuery:
    """Ingest the files a stream of notices names (columns of `schemas.SCANNED`),
    without listing the bucket."""

    def each(batch: DataFrame, number: int) -> None:
        on_run(_ingest_batch(latest_notice(batch), state, options))

    return _start(notices, each, checkpoint, every)


class VerdictLog:
    """Change detection alone, on a stream of notices that carry a content hash.

    Each micro-batch writes its verdicts and the ledger rows that follow from
    them to folders named after the batch, so a repeated batch replaces its own
    output and sees the ledger as it was before.
    """

    def __init__(self, spark: SparkSession, root: str, order: str = "mtime_ns"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.order = order  # column that tells the last notice of a location

    def _folders(self, table: str, before: int | None = None) -> list[str]:
        names = children(self.spark, f"{self.root}/{table}")
        done = [n for n in names if exists(self.spark, f"{self.root}/{table}/{n}/_SUCCESS")]
        return [
            f"{self.root}/{table}/{n}" for n in done
            if before is None or int(n.split("=")[1]) < before
        ]

    def ledger(self, before: int | None = None) -> DataFrame:
        folders = self._folders("ledger", before)
        if not folders:
            return self.spark.createDataFrame([], S.SOURCE_FILES)
        return cdc.current_ledger(self.spark.read.schema(S.LEDGER_EVENTS).parquet(*folders))

    def verdicts(self) -> DataFrame:
        """Verdicts of all batches with their `batch` number."""
        return self.spark.read.option("basePath", f"{self.root}/verdicts").parquet(
            *self._folders("verdicts")
        )

    def _each(self, batch: DataFrame, number: int) -> None:
        notices = latest_notice(batch, self.order)
        verdicts = cdc.classify(notices, self.ledger(before=number), F.col("sha256"))
        path = f"{self.root}/verdicts/batch={number}"
        verdicts.write.mode("overwrite").parquet(path)
        stored = batch.sparkSession.read.schema(verdicts.schema).parquet(path)
        now = F.current_timestamp()
        work = cdc.started(stored.filter(F.col("decision").isin(S.NEW, S.CHANGED)), number, now)
        outcome = work.select(
            "source_id", "relpath", F.col("content_sha256").alias("file_sha256"),
            F.lit(None).cast("string").alias("error"),
        )
        rows = cdc.finished(work, outcome, number, now).unionByName(
            cdc.refreshed(stored, number, now)
        )
        rows.write.mode("overwrite").parquet(f"{self.root}/ledger/batch={number}")

    def run(self, notices: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        return _start(notices, self._each, checkpoint, every)
