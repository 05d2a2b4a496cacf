"""Recursive unpacking as waves of DataFrames.

Each wave classifies its items, splits mailboxes into messages, and writes what
it found: mail leaves with their ids, skips, and the archives still to open.
The next wave opens those archives, spread over the cluster one by one. Waves
end when no archive is left, at the latest at the depth limit. Small archives
are opened where they are met: moving them costs more than opening them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.functions import identity, paths
from lettermill.operators.archive import explode_zip, open_small, spread
from lettermill.operators.mbox import (
    message_bytes,
    message_parts,
    rewrite_bodies,
    split_messages,
)
from lettermill.storage import BLOB_SETTINGS, exists, session_settings

LEAF, SKIP, ZIP = "leaf", "skip", "zip"
# Archives that a task of a wave opens, about.
TASK_BYTES = 64 * 1024 * 1024

LEAF_COLUMNS = [
    "source_id", "namespace", "partition", "relpath", "internal_path",
    "container_depth", "pos", "msg_idx", "format", "email_id",
    "content_sha256", "size_bytes",
]
SKIP_COLUMNS = ["source_id", "internal_path", "reason", "details"]


@dataclass(frozen=True)
class UnpackLimits:
    max_depth: int = S.MAX_CONTAINER_DEPTH
    max_member_bytes: int = S.MAX_MEMBER_BYTES
    cut_hash: bool = True       # a `#` in a file name hides its suffix
    rewrite_mbox: bool = False  # messages as the email package writes them


def leaf_key(pos: str = "pos", msg_idx: str = "msg_idx") -> Column:
    """Text that names a leaf within its source, whatever its path looks like."""
    return F.concat_ws("#", F.array_join(F.col(pos).cast("array<string>"), "."), F.col(msg_idx).cast("string"))


def _messages(frame: DataFrame, limits: UnpackLimits) -> DataFrame:
    """Mailbox rows become message rows, other rows stay as they are."""
    opens = (F.col("kind") == "mbox") & F.col("reason").isNull() & ~F.col("too_deep")
    others = [c for c in frame.columns if c != "raw"]
    if limits.rewrite_mbox:
        bodies = F.when(opens, split_messages("raw")).otherwise(F.array("raw"))
        rows = frame.select(*others, opens.alias("opened"), bodies.alias("bodies"))
        rows = rewrite_bodies(rows, "bodies", only="opened").select(
            *others, "opened", "rewrite_error", F.posexplode_outer("bodies").alias("i", "raw")
        )
    else:
        # Message parts travel through the explode as they are and become bytes
        # row by row; other rows keep theirs.
        bodies = F.when(opens, message_parts(F.col("raw")).cast("array<binary>"))
        rows = frame.select(
            *others, opens.alias("opened"), bodies.otherwise(F.array("raw")).alias("bodies")
        ).select(
            *others, "opened", F.size("bodies").alias("n"),
            F.posexplode_outer("bodies").alias("i", "raw"),
        )
        message = message_bytes(F.col("raw").cast("string"), F.col("i") == F.col("n") - 1)
        rows = rows.withColumns(
            {
                "raw": F.when(F.col("opened"), message).otherwise(F.col("raw")),
                "rewrite_error": F.lit(None).cast("string"),
            }
        ).drop("n")
    # The message that could not be written back comes last, without a body.
    failed = F.col("opened") & F.col("rewrite_error").isNotNull() & F.col("raw").isNull()
    return rows.withColumns(
        {
            "reason": F.when(failed, S.CORRUPT_ARCHIVE).otherwise(F.col("reason")),
            "details": F.when(failed, F.col("rewrite_error")).otherwise(F.col("details")),
            "opened": F.col("opened") & ~failed,
            "msg_idx": F.when(F.col("opened") & ~failed, F.col("i")),
        }
    ).drop("i", "rewrite_error")


def classify_wave(
    items: DataFrame, limits: UnpackLimits = UnpackLimits(), carry: tuple[str, ...] = ()
) -> DataFrame:
    """Every item as an `entry`: leaf (one per message for mailboxes), skip or zip.

    Items may carry a `reason` already; they pass through as skips. Rows with a
    `row_type` other than item keep that as their entry. `carry` names columns
    to pass along.
    """
    for name in ("reason", "details"):
        if name not in items.columns:
            items = items.withColumn(name, F.lit(None).cast("string"))
    child = F.col("container_depth") + 1
    typed = items.withColumn("kind", paths.classify_item("internal_path", limits.cut_hash))
    container = F.col("kind").isin("mbox", "zip")
    typed = typed.withColumn("too_deep", container & (child > limits.max_depth))

    rows = _messages(typed, limits)
    kind = F.col("kind")
    empty = F.col("opened") & F.col("msg_idx").isNull()
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("too_deep"), S.DEPTH_LIMIT_EXCEEDED)
        .when(empty, S.EMPTY_CONTAINER)
        .when(kind == "unsupported", S.UNSUPPORTED_FORMAT_DEFERRED)
        .when(kind == paths.NOISE, S.NOT_AN_EMAIL)
    )
    details = (
        F.when(F.col("reason").isNotNull(), F.coalesce("details", F.lit("")))
        .when(F.col("too_deep"), F.format_string(f"depth %d > {limits.max_depth}", child))
        .when(
            kind == "unsupported",
            F.concat(
                F.lit("format not yet implemented: "),
                paths.basename_of("internal_path", limits.cut_hash),
            ),
        )
        .otherwise("")
    )
    rows = rows.select(
        "source_id", "namespace", "partition", "relpath",
        F.when(
            F.col("opened") & F.col("msg_idx").isNotNull(), paths.mbox_hop("internal_path", "msg_idx")
        ).otherwise(F.col("internal_path")).alias("internal_path"),
        F.when(F.col("opened") & ~empty, child).otherwise(F.col("container_depth")).cast("int").alias("container_depth"),
        "pos", "msg_idx", "raw", "kind",
        reason.alias("reason"),
        details.alias("details"),
        *carry, *(["row_type"] if "row_type" in items.columns else []),
    )
    entry = F.when(F.col("reason").isNotNull(), SKIP).when(kind == "zip", ZIP).otherwise(LEAF)
    if "row_type" in items.columns:
        entry = F.when(F.col("row_type") != "item", F.col("row_type")).otherwise(entry)
    rows = rows.withColumn("entry", entry)
    leaf = F.col("entry") == LEAF
    return rows.select(
        "source_id", "namespace", "partition", "relpath", "internal_path",
        "container_depth", "pos", "msg_idx",
        F.when(leaf, F.when(kind == "html", S.HTML).otherwise(S.EML)).alias("format"),
        F.when(leaf, identity.email_id("namespace", "raw")).alias("email_id"),
        F.when(leaf, identity.content_sha256("raw")).alias("content_sha256"),
        F.when(leaf | (F.col("entry") == ZIP), F.octet_length("raw").cast("bigint")).alias("size_bytes"),
        F.when(F.col("entry") != SKIP, F.col("raw")).alias("raw"),
        "reason",
        F.when(F.col("entry") == SKIP, F.col("details")).alias("details"),
        *carry,
        "entry",
    )


@dataclass
class Unpacked:
    """Result tables of an unpacking, kept as written waves."""

    spark: SparkSession
    root: str
    waves: int = 0
    refused: DataFrame | None = None  # source_id of big archives with a bad member
    failed: DataFrame | None = None   # source_id of files that broke while being read
    schema: object = field(default=None, repr=False)

    def path(self, wave: int) -> str:
        return f"{self.root}/wave={wave}"

    def write(self, rows: DataFrame) -> int:
        """Write one wave; its rows are split by entry so that later reads touch
        only the kind they need."""
        wave = self.waves
        with session_settings(self.spark, BLOB_SETTINGS):
            rows.write.mode("overwrite").partitionBy("entry").parquet(self.path(wave))
        self.schema = self.schema or rows.drop("entry").schema
        self.waves += 1
        return wave

    def raw_read(self, entry: str, waves) -> DataFrame | None:
        found = [p for w in waves if exists(self.spark, p := f"{self.path(w)}/entry={entry}")]
        if not found:
            return None
        return self.spark.read.schema(self.schema).parquet(*found)

    def read(self, entry: str, waves=None) -> DataFrame | None:
        rows = self.raw_read(entry, range(self.waves) if waves is None else waves)
        if rows is None or entry not in (LEAF, SKIP, ZIP):
            return rows
        if self.failed is not None:
            rows = rows.join(self.failed, "source_id", "left_anti")
        if self.refused is None:
            return rows
        if entry != SKIP:
            return rows.join(self.refused, "source_id", "left_anti")
        # A refused archive leaves its own reason and nothing from inside.
        inside = F.col("container_depth") > 0
        return rows.filter(~inside).unionByName(
            rows.filter(inside).join(self.refused, "source_id", "left_anti")
        )

    def _or_empty(self, rows: DataFrame | None) -> DataFrame:
        return self.spark.createDataFrame([], self.schema) if rows is None else rows

    @property
    def leaves(self) -> DataFrame:
        """Mail leaves with `raw`; columns LEAF_COLUMNS, raw and leaf_key."""
        rows = self._or_empty(self.read(LEAF))
        return rows.select(*LEAF_COLUMNS, "raw", leaf_key().alias("leaf_key"))

    @property
    def skips(self) -> DataFrame:
        rows = self._or_empty(self.read(SKIP)).select(*SKIP_COLUMNS, "container_depth", "pos")
        if self.refused is None:
            return rows.select(*SKIP_COLUMNS)
        # Slices of one archive may each have met a bad member; the first counts.
        sliced = rows.join(self.refused, "source_id", "left_semi")
        first = sliced.groupBy("source_id", "internal_path").agg(
            F.min_by(F.struct("reason", "details"), "pos").alias("r")
        )
        return (
            rows.join(self.refused, "source_id", "left_anti").select(*SKIP_COLUMNS)
            .unionByName(first.select("source_id", "internal_path", "r.reason", "r.details"))
        )


def unpack(
    items: DataFrame, work: str, limits: UnpackLimits = UnpackLimits(), partitions: int | None = None
) -> Unpacked:
    """Unpack items held in rows (columns of `schemas.ITEMS`, optionally reason
    and details). `work` is a shared folder that must outlive the result."""
    result = Unpacked(items.sparkSession, work)
    opened = open_small(items, limits.max_member_bytes, limits.max_depth, limits.cut_hash)
    result.write(classify_wave(opened, limits))
    return open_nested(result, limits, partitions)


def by_bytes(archives: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Archives dealt to tasks of about equal bytes. One of more than half a task's share has a task
    of its own; the others are dealt out by hash. Sizes are read without the archives, and what is
    numbered and broadcast is at most two rows per task."""
    sizes = archives.select("source_id", "pos", "size_bytes")
    n, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size_bytes"), F.lit(0))).first()
    tasks = max(1, total // task_bytes, min(n, archives.sparkSession.sparkContext.defaultParallelism))
    share = max(1, total // tasks)
    large = sizes.filter(F.col("size_bytes") * 2 > share)
    n_large, in_large = large.agg(F.count(F.lit(1)), F.coalesce(F.sum("size_bytes"), F.lit(0))).first()
    shared = -(-(total - in_large) // share) if n > n_large else 0
    by_size = Window.orderBy(F.desc("size_bytes"), "source_id", "pos")
    places = large.select("source_id", "pos", (F.row_number().over(by_size) - 1 + shared).alias("task"))
    dealt = archives.join(F.broadcast(places), ["source_id", "pos"], "left").withColumn(
        "task", F.coalesce("task", F.pmod(F.xxhash64("source_id", "pos"), F.lit(max(1, shared))).cast("int"))
    )
    return dealt.repartitionById(max(1, shared + n_large), F.col("task")).drop("task")


def open_nested(
    result: Unpacked,
    limits: UnpackLimits,
    partitions: int | None = None,
    waves=None,
) -> Unpacked:
    """Open the archives found by the given waves (default: all so far), and
    those inside them, until none is left."""
    waves = range(result.waves) if waves is None else waves
    while (archives := result.read(ZIP, waves)) is not None:
        archives = spread(archives, "source_id", "pos", partitions=partitions) if partitions else by_bytes(archives)
        opened = explode_zip(archives, limits.max_member_bytes, limits.max_depth, limits.cut_hash)
        rows = classify_wave(opened, limits)
        waves = [result.write(rows)]
    return result
