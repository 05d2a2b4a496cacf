"""`bucket_scan`: the files of a date-partitioned bucket, without their content.

    spark.read.format("bucket_scan").load("/bucket")

Layout: `<root>/<namespace>/timestamp=YYYY-MM-DD/**`. The driver lists the two
fixed directory levels; the walk and the per-file stat run on executors, one
task or more per date directory. `listing.list_bucket` lists buckets in which
even these levels are too many for one process; runs use it.

Options
  min_partition, max_partition   bounds on the date directory name (inclusive)
  namespaces                     comma separated list of tenants to scan
  slices                         parts per date directory (default 1). A part
                                 looks only at the files whose path hashes to
                                 it, so one directory that holds most of a
                                 bucket is not one task's work.
  tasks                          upper bound on the number of tasks (default:
                                 one per part); parts are dealt out evenly
  names_only                     true: list names and leave size and time of
                                 local files to `listing.with_stats`, which shares
                                 that work out file by file

As a stream, every trigger is one full pass over the bucket: files may appear
or change in any date directory at any time, so nothing bounds a pass by time.
"""

from __future__ import annotations

import re
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.types import StructType

from lettermill.functions.paths import PARTITION_PATTERN
from lettermill.schemas import SCANNED
from lettermill.sources.files import regular_files, root_kind, subdirs

_PARTITION = re.compile(PARTITION_PATTERN)
_ROWS_PER_BATCH = 4096

_ARROW = pa.schema(
    [
        ("namespace", pa.string()),
        ("partition", pa.string()),
        ("relpath", pa.string()),
        ("abspath", pa.string()),
        ("size_bytes", pa.int64()),
        ("mtime_ns", pa.int64()),
    ]
)


@dataclass(frozen=True)
class DateDirectory:
    """One part of one date directory."""

    namespace: str
    partition: str
    path: str
    index: int
    slices: int
    names_only: bool


class Share(InputPartition):
    """What one task lists."""

    def __init__(self, parts: list[DateDirectory]):
        self.parts = parts


def _date_directories(options: dict) -> list[InputPartition]:
    root = options.get("path")
    if not root:
        raise ValueError("bucket_scan needs a path")
    kind = root_kind(root)
    if kind == "missing":
        return []
    if kind != "directory":
        raise NotADirectoryError(f"bucket root is not a directory: {root}")
    low, high = options.get("min_partition"), options.get("max_partition")
    only = {n.strip() for n in options.get("namespaces", "").split(",") if n.strip()}
    slices = max(1, int(options.get("slices", "1")))
    names_only = options.get("names_only", "false") == "true"
    base = root.rstrip("/")
    found: list[DateDirectory] = []
    for namespace in subdirs(root):
        if only and namespace not in only:
            continue
        for partition in subdirs(f"{base}/{namespace}"):
            if not _PARTITION.match(partition):
                continue
            if (low and partition < low) or (high and partition > high):
                continue
            path = f"{base}/{namespace}/{partition}"
            found += [
                DateDirectory(namespace, partition, path, i, slices, names_only)
                for i in range(slices)
            ]
    tasks = min(len(found), int(options.get("tasks", len(found))))
    return [Share(found[i::tasks]) for i in range(tasks)]


def _batch(part: DateDirectory, rows: list[tuple]) -> pa.RecordBatch:
    rel, absolute, size, mtime = zip(*rows)
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part.namespace] * n, pa.string()),
            pa.array([part.partition] * n, pa.string()),
            pa.array(rel, pa.string()),
            pa.array(absolute, pa.string()),
            pa.array(size, pa.int64()),
            pa.array(mtime, pa.int64()),
        ],
        schema=_ARROW,
    )


def _read(share: Share | None) -> Iterator[pa.RecordBatch]:
    for part in share.parts if share else ():
        yield from _read_part(part)


def _read_part(part: DateDirectory) -> Iterator[pa.RecordBatch]:
    def mine(rel: str) -> bool:
        return part.slices == 1 or zlib.crc32(rel.encode()) % part.slices == part.index

    rows: list[tuple] = []
    for row in regular_files(part.path, mine, part.names_only):
        rows.append(row)
        if len(rows) == _ROWS_PER_BATCH:
            yield _batch(part, rows)
            rows = []
    if rows:
        yield _batch(part, rows)


class BucketReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return _date_directories(self.options)

    def read(self, partition):
        return _read(partition)


class BucketStreamReader(DataSourceStreamReader):
    """Offsets count passes by wall clock; a pass reads the bucket as it is."""

    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self):
        return {"pass_ms": 0}

    def latestOffset(self):
        return {"pass_ms": time.time_ns() // 1_000_000}

    def partitions(self, start, end):
        return _date_directories(self.options)

    def read(self, partition):
        return _read(partition)


class BucketScan(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bucket_scan"

    def schema(self) -> StructType:
        return SCANNED

    def reader(self, schema: StructType) -> DataSourceReader:
        return BucketReader(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return BucketStreamReader(dict(self.options))
