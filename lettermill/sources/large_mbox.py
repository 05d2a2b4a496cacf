"""Mailboxes too big for a row, read as byte ranges of the file by any number of tasks.

A message belongs to the range that its separator starts in; its end is read from
the bytes after the range. Message numbers come from the counts of the ranges
before, never from a sort of the whole file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lettermill.operators.archive import RowBatcher
from lettermill.sources.files import open_binary

# A row cannot exceed 2 GiB; a message above this fails its source.
MESSAGE_BYTES = 2_000_000_000
_STEP = 1 << 20
_KEYS = ["source_id", "namespace", "partition", "relpath", "internal_path"]
_DDL = ", ".join(f"{c} string" for c in _KEYS) + ", slice_lo bigint, nth bigint, raw binary, error string"
_ARROW = pa.schema(
    [*[(c, pa.string()) for c in _KEYS], ("slice_lo", pa.int64()), ("nth", pa.int64()),
     ("raw", pa.binary()), ("error", pa.string())]
)


def ranges(size: int, step: int) -> Iterator[tuple[int, int | None]]:
    """(lo, hi) of a file in ranges of `step` bytes; the last one goes to the end of the file."""
    starts = range(0, max(size, 1), max(step, 1))
    for lo in starts:
        yield lo, None if lo == starts[-1] else lo + max(step, 1)


def _message(part: bytes, last: bool) -> bytes:
    """The message of what lies between two separators, as `operators.mbox` has it."""
    if not part:
        return b""
    if last:
        return part[1:-1] if part.endswith(b"\n\n") else part[1:]
    return part[1:] if part.endswith(b"\n") else part[1:] + b"\n"


def range_messages(path: str, lo: int, hi: int | None) -> Iterator[bytes]:
    """Messages whose separator starts at lo or later and before hi."""
    with open_binary(path) as f:
        f.seek(max(lo - 1, 0))
        # a bytearray grows in place: a message over many steps is not copied at each
        data = bytearray(b"\n" if lo == 0 else b"")
        data += f.read() if hi is None else f.read(hi - max(lo - 1, 0) + 5)
        # data[0] is the byte before lo, so a separator found at i starts at lo + i
        at = data.find(b"\nFrom ")
        while at >= 0 and (hi is None or lo + at < hi):
            following = data.find(b"\nFrom ", at + 1)
            while following < 0 and (more := f.read(_STEP)):
                seen = max(at + 1, len(data) - 5)
                data += more
                if len(data) - at > MESSAGE_BYTES:
                    raise ValueError(f"message of more than {MESSAGE_BYTES} bytes does not fit a row")
                following = data.find(b"\nFrom ", seen)
            end = data.find(b"\n", at + 1)
            stop = len(data) if following < 0 else following
            yield _message(bytes(data[end:stop]) if 0 <= end < stop else b"", following < 0)
            at = following


def read_large_mboxes(files: DataFrame, tasks: int, scratch) -> tuple[DataFrame, DataFrame]:
    """Messages of the mailboxes in `files`, and the sources that could not be read.

    Input: a row per range with the columns source_id, namespace, partition, relpath,
    internal_path, abspath, slice_lo and slice_hi. Output: the first five, `msg_idx`
    and `raw`, one row per message; a mailbox without messages has one row with
    NULLs. Then source_id and error. `scratch` writes an intermediate table.
    """

    def read(part: dict) -> Iterator[dict]:
        same = {k: part[k] for k in [*_KEYS, "slice_lo"]}
        try:
            for nth, raw in enumerate(range_messages(part["abspath"], part["slice_lo"], part["slice_hi"])):
                yield same | {"nth": nth, "raw": raw}
        except Exception as failure:  # of this source only
            yield same | {"error": f"{type(failure).__name__}: {failure}"}

    def run(batches):
        out = RowBatcher(_ARROW)
        for batch in batches:
            for part in batch.to_pylist():
                for row in read(part):
                    yield from out.add(row)
        yield from out.flush()

    wanted = files.select(*_KEYS, "abspath", "slice_lo", "slice_hi")
    spread = wanted.repartition(tasks, "source_id", "slice_lo")
    rows = scratch("records", spread.mapInArrow(run, _DDL))
    errors = rows.filter(F.col("error").isNotNull()).groupBy("source_id").agg(F.min("error").alias("error"))
    errors = scratch("unread", errors)
    good = rows.filter(F.col("error").isNull()).join(errors.select("source_id"), "source_id", "left_anti")
    # One row per range that holds a message.
    before = Window.partitionBy("source_id").orderBy("slice_lo").rowsBetween(Window.unboundedPreceding, -1)
    counts = good.groupBy("source_id", "slice_lo").agg(F.count(F.lit(1)).alias("n"))
    offsets = scratch("offsets", counts.select(
        "source_id", "slice_lo", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    ))
    messages = good.join(offsets, ["source_id", "slice_lo"]).select(
        *_KEYS, (F.col("offset") + F.col("nth")).cast("int").alias("msg_idx"), "raw"
    )
    none = offsets.select("source_id").unionByName(errors.select("source_id"))
    empty = (
        files.select(*_KEYS).distinct().join(none, "source_id", "left_anti")
        .select(*_KEYS, F.lit(None).cast("int").alias("msg_idx"), F.lit(None).cast("binary").alias("raw"))
    )
    return messages.unionByName(empty), errors
