"""One ingestion run: scan, decide, open, unpack, deduplicate, publish."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, fields
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill import sources
from lettermill.functions import identity, paths
from lettermill.functions.manifest import manifest_struct
from lettermill.operators import cdc, dedup
from lettermill.operators.archive import PLACES_DDL, spread
from lettermill.operators.mbox import rewrite_rows
from lettermill.operators.unpack import (
    LEAF_COLUMNS,
    Unpacked,
    UnpackLimits,
    classify_wave,
    leaf_key,
    open_nested,
)
from lettermill.plans.state import LEDGER, MERGE, ConcurrentRun, Part, StateStore
from lettermill.sources.listing import Wanted, list_bucket, with_stats
from lettermill.sources.large_mbox import read_large_mboxes
from lettermill.sources.opening import SLICE_BYTES, ReadLimits, hash_files, open_slices, open_sources
from lettermill.storage import BLOB_SETTINGS, delete, new_work_dir, session_settings, small_batches

MODES = ("backfill", "incremental")
_CARRY = ("file_sha256", "error", "abspath", "slice_lo", "slice_hi", "places")


@dataclass(frozen=True)
class RunOptions:
    mode: str = "incremental"
    max_depth: int = S.MAX_CONTAINER_DEPTH
    max_member_bytes: int = S.MAX_MEMBER_BYTES
    inline_bytes: int = ReadLimits.inline_bytes
    slice_bytes: int = ReadLimits.slice_bytes
    cut_hash: bool = True
    rewrite_mbox: bool = False
    fail_fast: bool = False          # raise after the commit if a source failed
    merge_parts: int = MERGE         # merge parts of the tables when so many of one size have gathered; 0: never
    bytes_per_task: int = 128 * 1024 * 1024
    files_per_task: int = 20_000
    scan: dict = field(default_factory=dict)  # options of the bucket_scan format

    @property
    def unpack(self) -> UnpackLimits:
        return UnpackLimits(self.max_depth, self.max_member_bytes, self.cut_hash, self.rewrite_mbox)

    @property
    def read(self) -> ReadLimits:
        return ReadLimits(self.max_depth, self.max_member_bytes, self.inline_bytes, self.slice_bytes, self.cut_hash)


@dataclass
class RunStats:
    files_scanned: int = 0
    files_new: int = 0
    files_changed: int = 0
    files_unchanged: int = 0
    files_metadata_only: int = 0
    files_failed: int = 0
    files_elsewhere: int = 0         # a live run is at work on them
    emails_staged: int = 0
    emails_relinked: int = 0
    skipped: int = 0
    recovered_in_progress: int = 0
    recovered_tmp_files: int = 0

    def frame(self, spark: SparkSession) -> DataFrame:
        ddl = ", ".join(f"{f.name} bigint" for f in fields(self))
        return spark.createDataFrame([tuple(asdict(self).values())], ddl)

    def summary(self, mode: str) -> str:
        return (
            f"mode={mode} scanned={self.files_scanned} new={self.files_new} "
            f"changed={self.files_changed} unchanged={self.files_unchanged} "
            f"metadata_only={self.files_metadata_only} failed={self.files_failed} "
            f"emails_staged={self.emails_staged} relinked={self.emails_relinked} "
            f"skipped={self.skipped}"
        )


class SourcesFailed(RuntimeError):
    """Some sources failed; everything else of the run is committed."""


def ingest(
    spark: SparkSession, bucket: str, state: str, options: RunOptions = RunOptions()
) -> RunStats:
    """Scan a bucket and bring the state up to date with it.

    Backfill and incremental are the same plan: the ledger alone decides what
    is work.
    """
    work = new_work_dir(spark, "listing")
    try:
        return ingest_scanned(spark, scan_bucket(spark, bucket, options.scan, work=work), state, options)
    finally:
        delete(spark, work)


def scan_bucket(
    spark: SparkSession, bucket: str, scan: dict | None = None, stream: bool = False, work: str | None = None
) -> DataFrame:
    """Files of a bucket with size and time, as a batch or as a stream.

    Directories are listed by name; size and time are then looked up in equal
    shares of the files. More tasks than a few per core would each see a handful.
    A batch is listed at once, in rounds, below `work`.
    """
    scan = scan or {}
    tasks = int(scan.get("tasks", 4 * spark.sparkContext.defaultParallelism))
    if not stream:
        only = frozenset(n.strip() for n in scan.get("namespaces", "").split(",") if n.strip())
        wanted = Wanted(scan.get("min_partition"), scan.get("max_partition"), only)
        return with_stats(list_bucket(spark, bucket, work or new_work_dir(spark, "listing"), wanted, tasks), tasks)
    sources.register(spark)
    options = {"tasks": tasks, "names_only": "true"} | scan
    return with_stats(spark.readStream.format("bucket_scan").options(**options).load(bucket), tasks)


def ingest_scanned(
    spark: SparkSession, scanned: DataFrame, state: str, options: RunOptions = RunOptions()
) -> RunStats:
    """The same for files listed by the caller (columns of `schemas.SCANNED`)."""
    if options.mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    with session_settings(spark, BLOB_SETTINGS):
        return _Run(spark, scanned, state, options).execute()


class _Run:
    def __init__(self, spark: SparkSession, scanned: DataFrame, state: str, options: RunOptions):
        self.spark = spark
        self.scanned = scanned
        self.options = options
        self.store = StateStore(spark, state)
        self.stats = RunStats()
        self.added: dict[str, list[str]] = {}
        self.broken: list[int] = []

    def execute(self) -> RunStats:
        self.open()
        self.work_off()
        return self.stats

    def open(self) -> None:
        """Claim a run, decide what is work, and say so."""
        self.run = self.store.claim()
        self.work = new_work_dir(self.spark, f"run-{self.run}")
        self.now = F.lit(datetime.now(timezone.utc).replace(microsecond=0))
        try:
            self._recover()
            self._decide()
            if self.n_candidates:
                self._write(LEDGER, self._started_rows(), step=cdc.STARTED, visible=False)
        except BaseException:
            self.close()
            raise

    def work_off(self) -> None:
        """Do the work and commit."""
        try:
            if self.n_candidates:
                try:
                    self._process()
                    self._finish()
                except Exception:
                    self._abort()
                    raise
            elif self.stats.files_metadata_only:
                self._finish()
            else:
                self._commit()
        finally:
            self.close()
        self._tidy()
        if self.stats.files_failed and self.options.fail_fast:
            raise SourcesFailed(f"{self.stats.files_failed} sources failed")

    def close(self) -> None:
        """The run is over; without a commit it counts as broken off."""
        self.store.release(self.run)
        delete(self.spark, self.work)

    # --- small helpers ------------------------------------------------------

    def _scratch(self, name: str, rows: DataFrame) -> DataFrame:
        """Write an intermediate table and read it back: later steps neither
        recompute it nor depend on the executors that made it."""
        path = f"{self.work}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _write(
        self, table: str, rows: DataFrame, step: int | None = None, visible: bool = True
    ) -> DataFrame:
        part = f"run_id={self.run}" + ("" if step is None else f"/step={step}")
        path = self.store.path(table, part)
        self._save(table, rows, path)
        if visible:
            self.added.setdefault(table, []).append(part)
        return rows if table == "manifest" else self.spark.read.schema(rows.schema).parquet(path)

    def _save(self, table: str, rows: DataFrame, path: str) -> None:
        writer = rows.write.mode("overwrite")
        if table == "manifest":
            writer.partitionBy("namespace", "timestamp").json(path)
        else:
            writer.parquet(path)

    def _committed(self, table: str) -> DataFrame | None:
        return None if self.store.is_empty(table) else self.store.read(table)

    # --- steps --------------------------------------------------------------

    def _recover(self) -> None:
        # Only a run that broke off can have left anything to recover.
        self.broken = self.store.broken_runs(self.run)
        self.recovered = None
        if not self.broken:
            return
        self.stats.recovered_tmp_files = len(self.store.folders_of(self.broken))
        rows = self.store.recovered(self.broken, self.run)
        if rows is not None:
            self.recovered = self._write(LEDGER, rows, step=cdc.RECOVERED)
            self.stats.recovered_in_progress = self.recovered.count()

    def _decide(self) -> None:
        """Verdicts; only files that need something are kept."""
        looked_up = cdc.lookup_layers(
            cdc.with_source_id(self.scanned), self.store.ledger_layers(self.recovered)
        )
        by_metadata = cdc.decide_looked_up(looked_up).withColumn("elsewhere", F.lit(False))
        others = [n for n in self.store.unfinished_runs() if n != self.run and n not in self.broken]
        started = self.store.started(others)
        if started is not None:
            # What a live run has started, as it is now, is left to it.
            same = started.groupBy("source_id", "size_bytes", "mtime_ns").agg(F.lit(True).alias("at_work"))
            by_metadata = by_metadata.join(same, ["source_id", "size_bytes", "mtime_ns"], "left").withColumn(
                "elsewhere", F.col("at_work").isNotNull() & ~F.col("decision").eqNullSafe(F.lit(S.UNCHANGED))
            ).drop("at_work")
        # The scan is listed once: counted on the fly, and only what is not
        # settled as unchanged is kept.
        seen = Observation()
        open_, here = F.col("decision").isNull(), ~F.col("elsewhere")
        kept = (
            by_metadata.observe(
                seen,
                F.count("*").alias("scanned"),
                F.count_if(F.col("decision") == S.UNCHANGED).alias("unchanged"),
                F.count_if("elsewhere").alias("elsewhere"),
                F.count_if(open_ & here).alias("open"),
                F.coalesce(F.sum(F.when(open_ & here, F.col("size_bytes"))), F.lit(0)).alias("open_bytes"),
            )
            .filter(here & (open_ | (F.col("decision") != S.UNCHANGED)))
            .drop("elsewhere")
            .withColumn("kind", paths.classify_item("relpath", self.options.cut_hash))
        )
        kept = self._scratch("by_metadata", kept)
        counts = seen.get
        self.stats.files_scanned = counts["scanned"]
        self.stats.files_unchanged = counts["unchanged"]
        self.stats.files_elsewhere = counts["elsewhere"]

        # Content is read here only where the decision hangs on it; new files
        # are read, and hashed, when they are opened.
        no_hash = F.lit(None).cast("string")
        self.todo = kept.withColumn("content_sha256", no_hash)
        if counts["open"]:
            # Rows are short and files are not: the number of tasks follows the
            # files, where Spark would go by the size of the rows.
            share = spread(
                kept.filter(open_), "source_id",
                partitions=self._tasks(counts["open"], counts["open_bytes"]),
            )
            hashed = cdc.decide_by_content(hash_files(share).drop("hash_error"))
            self.todo = self._scratch(
                "verdicts", self.todo.filter(~open_).unionByName(hashed)
            )
        by_decision = {
            r["decision"]: r
            for r in self.todo.groupBy("decision")
            .agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes")).collect()
        }

        def total(column: str, *decisions: str) -> int:
            return sum(by_decision[d][column] for d in decisions if d in by_decision)

        self.stats.files_new = total("files", S.NEW)
        self.stats.files_changed = total("files", S.CHANGED)
        self.stats.files_metadata_only = total("files", S.METADATA_ONLY)
        self.n_candidates = total("files", S.NEW, S.CHANGED)
        self.candidates = self.todo.filter(F.col("decision").isin(S.NEW, S.CHANGED))
        self.tasks = self._tasks(self.n_candidates, total("bytes", S.NEW, S.CHANGED))

    def _tasks(self, files: int, size: int) -> int:
        """Tasks for reading this many files of this many bytes."""
        return max(
            1,
            size // self.options.bytes_per_task,
            files // self.options.files_per_task,
            min(files, self.spark.sparkContext.defaultParallelism),
        )

    def _slice_tasks(self, slices: DataFrame, size: Column) -> int:
        """Tasks for slices: a short row stands for much work, so a full slice has one to itself, but
        small ones share it, however many they are."""
        n, total = slices.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
        return max(
            1,
            -(-total // SLICE_BYTES),
            n // self.options.files_per_task,
            min(n, self.spark.sparkContext.defaultParallelism),
        )

    def _started_rows(self) -> DataFrame:
        return cdc.started(self.candidates, self.run, self.now)

    def _process(self) -> None:
        limits = self.options.unpack
        result = Unpacked(self.spark, f"{self.work}/waves")
        opened = open_sources(
            spread(self.candidates, "source_id", partitions=self.tasks), self.options.read
        )
        first = result.write(classify_wave(opened, limits, _CARRY))
        self.outcome = result.raw_read("source", [first]).select(
            "source_id", "relpath", "file_sha256", "error"
        )

        slices = result.raw_read("slice", [first])
        if slices is not None:
            unpacked = F.aggregate("places", F.lit(0).cast("bigint"), lambda n, p: n + p["size"])
            members = open_slices(
                spread(slices, "source_id", "slice_lo", partitions=self._slice_tasks(slices, unpacked)),
                self.options.read,
            )
            wave = result.write(classify_wave(members, limits, _CARRY))
            bad = result.raw_read("skip", [wave])
            if bad is not None:
                bad = bad.filter(F.col("container_depth") == 0).select("source_id").distinct()
                result.refused = self._scratch("refused", bad)

        big = result.raw_read("big_mbox", [first])
        if big is not None:
            own = F.coalesce("slice_hi", F.col("slice_lo") + self.options.slice_bytes) - F.col("slice_lo")
            messages, unread = read_large_mboxes(
                big, self._slice_tasks(big, own), lambda name, rows: self._scratch(f"mbox-{name}", rows)
            )
            result.write(self._large_mbox_wave(messages))
            # a mailbox that can't be read fails its source, not the run
            why = unread.withColumnRenamed("error", "unread")
            self.outcome = self._scratch("outcome", (
                self.outcome.join(why, "source_id", "left")
                .withColumn("error", F.coalesce("error", "unread")).drop("unread")
            ))

        self.stats.files_failed = self.outcome.filter(F.col("error").isNotNull()).count()
        if self.stats.files_failed:
            result.failed = self.outcome.filter(F.col("error").isNotNull()).select("source_id")
        self.result = open_nested(result, limits)

    def _large_mbox_wave(self, messages: DataFrame) -> DataFrame:
        """Messages of big mailboxes in the shape of a wave."""
        if self.options.rewrite_mbox:
            messages = rewrite_rows(messages)
        else:
            messages = messages.withColumn("rewrite_error", F.lit(None).cast("string"))
        broken = F.col("rewrite_error").isNotNull()
        reason = F.when(broken, S.CORRUPT_ARCHIVE).when(F.col("msg_idx").isNull(), S.EMPTY_CONTAINER)
        leaf = reason.isNull()
        null = F.lit(None).cast("string")
        return messages.select(
            "source_id", "namespace", "partition", "relpath",
            F.when(leaf, paths.mbox_hop("internal_path", "msg_idx"))
            .otherwise(F.col("internal_path")).alias("internal_path"),
            F.when(leaf, 1).otherwise(0).alias("container_depth"),
            F.array().cast("array<int>").alias("pos"),
            "msg_idx",
            F.when(leaf, S.EML).alias("format"),
            F.when(leaf, identity.email_id("namespace", "raw")).alias("email_id"),
            F.when(leaf, identity.content_sha256("raw")).alias("content_sha256"),
            F.when(leaf, F.octet_length("raw").cast("bigint")).alias("size_bytes"),
            F.when(leaf, F.col("raw")).alias("raw"),
            reason.alias("reason"),
            F.when(~leaf, F.coalesce("rewrite_error", F.lit(""))).alias("details"),
            *[null.alias(c) for c in ("file_sha256", "error", "abspath")],
            *[F.lit(None).cast("bigint").alias(c) for c in ("slice_lo", "slice_hi")],
            F.lit(None).cast(PLACES_DDL).alias("places"),
            F.when(leaf, "leaf").otherwise("skip").alias("entry"),
        )

    def _finish(self) -> None:
        if self.n_candidates:
            self._publish_mail()
            done = cdc.finished(self._started_rows(), self.outcome, self.run, self.now)
        else:
            done = None
        touched = cdc.refreshed(self.todo, self.run, self.now)
        self._write(LEDGER, touched if done is None else done.unionByName(touched), step=cdc.FINISHED)
        self._commit()

    def _publish_mail(self) -> None:
        leaves = self.result.leaves
        ids = leaves.drop("raw")

        # Winners per blob and per email, on ids alone.
        total = Observation()
        blobs = self._scratch(
            "blobs",
            dedup.blob_winners(ids).observe(
                total, F.coalesce(F.sum("copies"), F.lit(0)).alias("leaves")
            ),
        )
        n_leaves = total.get["leaves"]
        # The tables do not depend on each other: their jobs share the cluster,
        # and none waits for the last tasks of another.
        steps = [lambda: self._publish_emails(blobs, n_leaves), self._publish_skips]
        if n_leaves:
            steps += [
                lambda: self._publish_pool(leaves, blobs, n_leaves),
                lambda: self._publish_lineage(ids),
            ]
        with ThreadPoolExecutor(len(steps)) as pool:
            for step in [pool.submit(step) for step in steps]:
                step.result()

    def _publish_emails(self, blobs: DataFrame, n_leaves: int) -> None:
        winners = self._scratch("winners", dedup.email_winners(blobs))
        emails = self._write(
            "emails", dedup.new_emails(winners, self._committed("emails"), self.now)
        )
        self.stats.emails_staged = emails.count()
        self.stats.emails_relinked = n_leaves - self.stats.emails_staged

    def _publish_skips(self) -> None:
        skips = self.result.skips.withColumn("skipped_at", self.now)
        self.stats.skipped = self._write("skipped", skips).count()

    def _publish_pool(self, leaves: DataFrame, blobs: DataFrame, n_leaves: int) -> None:
        on = dedup.LEAF_NAME
        keys = blobs.select(
            "email_id", "ext", *[F.col(f"w.{c}") for c in on], F.col("w.size_bytes")
        )
        keys = dedup.unseen(keys, self._committed("pool"), "email_id", "ext")
        fresh = self._scratch("fresh_blobs", keys.select(*on, "size_bytes"))
        n_fresh, n_bytes = fresh.agg(
            F.count("*"), F.coalesce(F.sum("size_bytes"), F.lit(0))
        ).first()
        fresh = fresh.drop("size_bytes")
        # Mail bytes meet the shorter of the two lists: leaves to keep or leaves
        # to leave out. Written out, its size is known and decides the join.
        if n_fresh == n_leaves:
            chosen = leaves
        elif n_fresh <= n_leaves // 2:
            chosen = leaves.join(fresh, on, "left_semi")
        else:
            copies = self._scratch("copies", leaves.select(*on).join(fresh, on, "left_anti"))
            chosen = leaves.join(copies, on, "left_anti")
        pool = chosen.select(
            "email_id",
            identity.leaf_suffix("format").alias("ext"),
            "raw",
            identity.shard("email_id").alias("shard"),
        )
        # Ids are uniform digests: equal ranges of their first digits are equal
        # shares, without sampling. Every file covers a narrow range of ids, so
        # lookups by shard or id skip the others by their column statistics.
        files = max(1, n_bytes // self.options.bytes_per_task)
        files = max(files, min(n_fresh, self.spark.sparkContext.defaultParallelism))
        prefix = F.conv(F.substring("email_id", 1, 8), 16, 10).cast("bigint")
        self._write("pool", pool.repartitionById(files, F.floor(prefix * files / 2**32).cast("int")))

    def _publish_lineage(self, ids: DataFrame) -> None:
        edges = dedup.lineage_edges(ids)
        # A source that is new to the ledger has no committed lineage.
        if self.stats.files_changed:
            edges = dedup.new_lineage(self._scratch("all_edges", edges), self._committed("lineage"))
        edges = self._scratch("edges", edges)
        self._write("lineage", dedup.lineage_rows(edges, self.now))
        lines = edges.select(
            manifest_struct().alias("m"),
            "namespace",
            F.substring("partition", len("timestamp=") + 1, 10).alias("timestamp"),
        ).select("m.*", "namespace", "timestamp")
        # One file per date directory; the rows of a hot directory are split over
        # tasks, at run time and by size.
        self._write("manifest", lines.hint("rebalance", "namespace", "timestamp"))

    def _commit(self) -> None:
        self.store.commit(
            self.run, self.added, {"mode": self.options.mode, "stats": asdict(self.stats)},
            revoked=tuple(self.broken), rebase=self._rebase,
        )
        self.store.discard([self.run, *self.broken])  # what is not committed of them never will be

    def _rebase(self, between: dict[str, list[Part]], added: dict[str, list[str]]) -> dict[str, list[str]]:
        """This run's folders without what other runs have committed since it started."""
        keys = {
            "emails": ["email_id"],
            "pool": ["email_id", "ext"],
            "lineage": ["email_id", "source_id", "internal_path"],
            "manifest": ["email_id", "namespace", "timestamp", "source", "internal_path"],
            # a source that another run has finished is that run's
            "skipped": ["source_id"],
            LEDGER: ["source_id"],
        }
        self.attempt = getattr(self, "attempt", 0) + 1
        out = dict(added)
        for table, own in added.items():
            base = LEDGER if table == "skipped" else table
            if base not in between or not own:
                continue
            theirs = self._keyed(base, [p.path for p in between[base]]).select(*keys[table]).distinct()
            mine = self._keyed(table, own)
            kept = mine.join(theirs, keys[table], "left_anti").select(*self.store.load(table, own).columns)
            before, after = self.store.load(table, own).count(), kept.count()
            if before == after:
                continue
            part = f"run_id={self.run}.{self.attempt}"
            self._save(table, kept, self.store.path(table, part))
            out[table] = [part]
            if table == "emails":
                self.stats.emails_staged -= before - after
                self.stats.emails_relinked += before - after
        self.added = out
        return out

    def _keyed(self, table: str, paths: list[str]) -> DataFrame:
        rows = self.store.load(table, paths)
        if table == "manifest":
            first = F.col("lineage")[0]
            rows = rows.withColumns({"source": first["source"], "internal_path": first["internal_path"]})
        return rows

    def _tidy(self) -> None:
        """Merge small parts, now that the run is visible; if another run does so too, one of them wins."""
        chosen = self.store.due(self.options.merge_parts) if self.options.merge_parts else None
        if chosen:
            self.store.compact(chosen)
        elif self.store.snapshot.number % max(self.options.merge_parts, MERGE) == 0:
            self.store.clean()

    def _abort(self) -> None:
        """Mark the files of this run failed, so that the next one retries them, and let go of what it wrote."""
        self.added = {}
        self._write(LEDGER, cdc.aborted(self._started_rows(), self.run), step=cdc.ABORTED)
        try:
            self._commit()
        except ConcurrentRun:
            return  # revoked: another run has taken its files over


def export_pool(spark: SparkSession, state: str, target: str) -> None:
    """Write committed pool blobs as files `<aa>/<id><ext>` below `target`."""
    sources.register(spark)
    small_batches(spark)
    pool = StateStore(spark, state).read("pool")
    pool.select(
        identity.pool_relpath("email_id", F.col("ext")).alias("path"),
        F.col("raw").alias("content"),
    ).write.format("file_tree").mode("append").save(target)

