"""Change detection: scanned files against the ledger.

The ledger is a log of state changes; the current state of a source is its
latest row. Decisions come in two steps: size and time first, which needs no
file content, then the content hash for the few rows that step cannot settle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.functions import identity, paths

_LEDGER_STATE = [f.name for f in S.SOURCE_FILES.fields]


def with_source_id(scanned: DataFrame) -> DataFrame:
    return scanned.withColumn("source_id", identity.source_id("namespace", "partition", "relpath"))


def fold(events: DataFrame) -> DataFrame:
    """The latest event of every source, with its earliest `first_seen_at`.

    One partial aggregate per task, so a source with very many events costs one
    row per task in the shuffle. Folding what was folded before changes nothing.
    """
    names = [f.name for f in S.LEDGER_EVENTS.fields]
    state = [c for c in names if c not in ("source_id", "first_seen_at")]
    latest = events.groupBy("source_id").agg(
        F.max_by(F.struct(*state), _event_order()).alias("s"),
        F.min("first_seen_at").alias("first_seen_at"),
    )
    return latest.select(*[F.col("s")[c].alias(c) if c in state else F.col(c) for c in names])


def _event_order() -> Column:
    # Two files of one scan can share an id; the later one in scan order stays.
    return F.struct("run_seq", "step", paths.scan_order_key("relpath").alias("path"))


def current_ledger(events: DataFrame) -> DataFrame:
    """Latest state of every source; `first_seen_at` is its earliest one."""
    return fold(events).select(*_LEDGER_STATE)


def lookup_layers(scanned: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """`lookup` where the ledger lies in layers of events with one row per source each.

    Each layer is joined as it lies, so a layer that is stored by source is not moved; the
    latest of the rows found counts.
    """
    names = [f"layer_{i}" for i in range(len(layers))]
    state = [c for c in _LEDGER_STATE if c != "first_seen_at"]
    for name, layer in zip(names, layers, strict=True):
        row = F.struct(
            F.struct(_event_order().alias("order"), F.struct(*state).alias("state")).alias("event"), "first_seen_at"
        )
        scanned = scanned.join(layer.select("source_id", row.alias(name)), "source_id", "left")
    if not names:
        state_type = S.SOURCE_FILES.simpleString()
        return scanned.withColumn("previous", F.lit(None).cast(state_type))
    event, seen = ([F.col(n)[c] for n in names] for c in ("event", "first_seen_at"))
    latest = F.greatest(*event) if len(names) > 1 else event[0]
    first = F.least(*seen) if len(names) > 1 else seen[0]
    fields = [(first if c == "first_seen_at" else latest["state"][c]).alias(c) for c in _LEDGER_STATE]
    return scanned.withColumn("previous", F.when(latest.isNotNull(), F.struct(*fields))).drop(*names)


def lookup(scanned: DataFrame, ledger: DataFrame) -> DataFrame:
    """Scanned files with their ledger row in `previous` (NULL if none).

    A left join from the scan: files gone from the bucket keep their ledger row
    and are not looked at.
    """
    previous = ledger.select("source_id", F.struct(*_LEDGER_STATE).alias("previous"))
    return scanned.join(previous, "source_id", "left")


def step_one(looked_up: DataFrame) -> Column:
    """new, unchanged, changed, or NULL where only the content can tell."""
    prev = F.col("previous")
    finished = prev["status"] == S.DONE
    same = (prev["size_bytes"] == F.col("size_bytes")) & (prev["mtime_ns"] == F.col("mtime_ns"))
    return (
        F.when(prev.isNull(), S.NEW)
        .when(~finished, S.CHANGED)
        .when(same, S.UNCHANGED)
    )


def step_two(content_sha256: Column) -> Column:
    same = F.col("previous")["content_sha256"] == content_sha256
    return F.when(same, S.METADATA_ONLY).otherwise(S.CHANGED)


def classify(
    scanned: DataFrame, ledger: DataFrame, content: Column | Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Scanned files with `source_id`, `previous`, `decision`, `content_sha256`.

    `content` is the only part that reads content, and unchanged files never
    reach it: either an expression for the hash, or a function that adds
    `content_sha256` to the rows it gets. With a function `scanned` is read
    twice, for the rows it gets and for the others; pass a stored table.
    """
    if "source_id" not in scanned.columns:
        scanned = with_source_id(scanned)
    joined = decide_by_metadata(scanned, ledger)
    reads = F.col("decision").isNull() | (F.col("decision") != S.UNCHANGED)
    if isinstance(content, Column):
        hashed = joined.withColumn("content_sha256", F.when(reads, content))
        return decide_by_content(hashed)
    settled = joined.filter(~reads).withColumn("content_sha256", F.lit(None).cast("string"))
    hashed = decide_by_content(content(joined.filter(reads)))
    return settled.unionByName(hashed.select(*settled.columns))


def decide_by_metadata(scanned: DataFrame, ledger: DataFrame) -> DataFrame:
    """First step: `previous`, and `decision` where no content is needed."""
    return decide_looked_up(lookup(scanned, ledger))


def decide_looked_up(looked_up: DataFrame) -> DataFrame:
    return looked_up.withColumn("decision", step_one(looked_up))


def decide_by_content(hashed: DataFrame) -> DataFrame:
    """Second step, for rows the first one left open."""
    return hashed.withColumn(
        "decision", F.coalesce("decision", step_two(F.col("content_sha256")))
    )


def source_id_collisions(scanned: DataFrame) -> DataFrame:
    """Different files that share one source_id (backslash names)."""
    return (
        with_source_id(scanned).groupBy("source_id")
        .agg(F.count("*").alias("files"), F.min("relpath").alias("first_relpath"),
             F.max("relpath").alias("last_relpath"))
        .filter(F.col("files") > 1)
    )


# --- ledger events ----------------------------------------------------------

# Order of the steps within one run.
RECOVERED, STARTED, FINISHED, ABORTED = 0, 1, 2, 3


def _event(rows: DataFrame, status: str | Column, run_seq: int, step: int, **changed: Column) -> DataFrame:
    fixed = {
        "status": F.lit(status) if isinstance(status, str) else status,
        "run_seq": F.lit(run_seq).cast("bigint"),
        "step": F.lit(step),
    } | changed
    return rows.select(
        *[
            (fixed[f.name] if f.name in fixed else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in S.LEDGER_EVENTS.fields
        ]
    )


def started(verdicts: DataFrame, run_seq: int, now: Column) -> DataFrame:
    """in_progress rows for files about to be processed."""
    prev = F.col("previous")
    return _event(
        verdicts, S.IN_PROGRESS, run_seq, STARTED,
        first_seen_at=F.coalesce(prev["first_seen_at"], now),
        last_processed_at=prev["last_processed_at"],
    )


def refreshed(verdicts: DataFrame, run_seq: int, now: Column) -> DataFrame:
    """New size and time for files whose content stayed the same."""
    return _event(
        verdicts.filter(F.col("decision") == S.METADATA_ONLY), S.DONE, run_seq, FINISHED,
        content_sha256=F.col("previous")["content_sha256"],
        first_seen_at=F.col("previous")["first_seen_at"],
        last_processed_at=now,
    )


def finished(started_rows: DataFrame, outcome: DataFrame, run_seq: int, now: Column) -> DataFrame:
    """done or failed for every started file; `outcome` has file_sha256 and
    error per source_id and relpath."""
    joined = started_rows.join(outcome, ["source_id", "relpath"], "left")
    failed = F.col("error").isNotNull()
    return _event(
        joined,
        F.when(failed, S.FAILED).otherwise(S.DONE),
        run_seq, FINISHED,
        content_sha256=F.coalesce("file_sha256", "content_sha256"),
        last_processed_at=F.when(failed, F.col("last_processed_at")).otherwise(now),
    )


def aborted(started_rows: DataFrame, run_seq: int) -> DataFrame:
    """failed for every file of a run that broke off."""
    return _event(started_rows, S.FAILED, run_seq, ABORTED)


def recovered(ledger: DataFrame, run_seq: int) -> DataFrame:
    """discovered for every source a crashed run left in progress."""
    return _event(
        ledger.filter(F.col("status") == S.IN_PROGRESS), S.DISCOVERED, run_seq, RECOVERED
    )
