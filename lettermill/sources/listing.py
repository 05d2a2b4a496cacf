"""A bucket listed in rounds, by many tasks.

A task walks the directories it is given and lists what is below them, entry by entry. Once
it has listed its share it hands the directories it has not entered back, as rows; they are
dealt out again in the next round. So tenants, date directories and deep trees are all
listed by as many tasks as there are directories, and the driver lists nothing. What is
listed is written, round by round: a lost executor costs its tasks only.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions.paths import PARTITION_PATTERN
from lettermill.schemas import SCANNED
from lettermill.sources.files import _utf8, file_stat, local_path, remote, root_kind

#: Entries that a task lists before it hands the rest back: at first, when it may hold the whole bucket, and later.
FIRST_SHARE, SHARE = 2_000, 50_000
_ROWS = 4096
_ARROW = pa.schema(
    [("is_dir", pa.bool_()), *[(f.name, pa.int64() if f.name in ("size_bytes", "mtime_ns") else pa.string()) for f in SCANNED.fields]]
)
_DDL = "is_dir boolean, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCANNED.fields)


@dataclass(frozen=True)
class Wanted:
    """Which parts of a bucket are listed."""

    min_partition: str | None = None
    max_partition: str | None = None
    namespaces: frozenset[str] = frozenset()

    def tenant(self, name: str) -> bool:
        return not self.namespaces or name in self.namespaces

    def date(self, name: str) -> bool:
        return bool(
            re.match(PARTITION_PATTERN, name)
            and not (self.min_partition and name < self.min_partition)
            and not (self.max_partition and name > self.max_partition)
        )


@dataclass(frozen=True)
class Place:
    """A directory: the bucket, a tenant, a date directory or one below it."""

    namespace: str | None
    partition: str | None
    relpath: str  # below the date directory, with a slash at its end
    path: str


def entries(path: str) -> Iterator[tuple[str, str, bool, bool, int | None, int | None]]:
    """name, path, whether it is a directory to enter, whether it may be a file, size and time (None: look later)."""
    local = local_path(path)
    if local is not None:
        try:
            listing = os.scandir(local)
        except OSError:
            return
        with listing:
            for e in listing:  # streamed: a directory of any size
                inner = e.is_dir()
                yield _utf8(e.name), _utf8(e.path), inner and not e.is_symlink(), not inner, None, None
        return
    from pyarrow import fs

    filesystem, inner = remote(path)
    for info in filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        directory = info.type == fs.FileType.Directory
        yield info.base_name, f"{path.rstrip('/')}/{info.base_name}", directory, info.type == fs.FileType.File, info.size, info.mtime_ns or 0


def _inside(place: Place, name: str, path: str, wanted: Wanted) -> Place | None:
    """A directory of `place` as a place; None if it is not listed."""
    if place.namespace is None:
        return Place(name, None, "", path) if wanted.tenant(name) else None
    if place.partition is None:
        return Place(place.namespace, name, "", path) if wanted.date(name) else None
    return Place(place.namespace, place.partition, f"{place.relpath}{name}/", path)


def _listed(wanted: Wanted, share: int):
    def run(batches):
        rows: list[tuple] = []

        def full() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _ARROW]
            out = pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
            rows.clear()
            return out

        pending: list[Place] = []
        seen = 0
        for batch in batches:
            names = ("namespace", "partition", "relpath", "abspath")
            pending += [Place(*r) for r in zip(*[batch.column(c).to_pylist() for c in names], strict=True)]
            while pending:
                place = pending.pop()
                if seen >= share:
                    rows.append((True, place.namespace, place.partition, place.relpath, place.path, None, None))
                else:
                    links = place.partition is None  # linked tenants and date directories are entered
                    for name, path, enter, is_file, size, mtime in entries(place.path):
                        seen += 1
                        if not is_file and (enter or links):
                            inner = _inside(place, name, path, wanted)
                            if inner is None:
                                continue
                            if len(pending) < share:
                                pending.append(inner)
                            else:
                                rows.append((True, inner.namespace, inner.partition, inner.relpath, inner.path, None, None))
                        elif is_file and place.partition is not None:
                            rows.append((False, place.namespace, place.partition, place.relpath + name, path, size, mtime))
                        if len(rows) >= _ROWS:
                            yield full()
                if len(rows) >= _ROWS:
                    yield full()
        yield full()

    return run


def list_bucket(spark: SparkSession, root: str, work: str, wanted: Wanted = Wanted(), tasks: int | None = None) -> DataFrame:
    """The files of a bucket by name (columns of `SCANNED`; size and time of local files are null), written
    below `work`. A missing bucket has none; a root that is no directory is an error."""
    kind = root_kind(root)
    if kind == "missing":
        return spark.createDataFrame([], SCANNED)
    if kind != "directory":
        raise NotADirectoryError(f"bucket root is not a directory: {root}")
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    level = spark.createDataFrame([(True, None, None, "", root.rstrip("/") or "/", None, None)], _DDL)
    n, number, share = 1, 0, FIRST_SHARE
    while n:
        path = f"{work}/round={number}"
        dealt = level.repartition(min(n, tasks)) if n > 1 else level.coalesce(1)
        dealt.mapInArrow(_listed(wanted, share), _DDL).write.mode("overwrite").parquet(path)
        level = spark.read.schema(_DDL).parquet(path).filter("is_dir")
        n, number, share = level.count(), number + 1, SHARE
    return spark.read.schema(_DDL).parquet(work).filter("NOT is_dir").select(*SCANNED.names)


def with_stats(names: DataFrame, tasks: int) -> DataFrame:
    """Size and time for rows listed by name only, without files that are gone or not regular. Rows are shared
    out by path: however full one directory is, no task looks at more than its share of the files."""

    def run(batches):
        for batch in batches:
            paths = batch.column("abspath").to_pylist()
            sizes, times = batch.column("size_bytes").to_pylist(), batch.column("mtime_ns").to_pylist()
            kept = []
            for i, path in enumerate(paths):
                if sizes[i] is None:
                    found = file_stat(path)
                    if found is None:
                        continue
                    sizes[i], times[i] = found
                kept.append(i)
            at = pa.array(kept, pa.int64())
            fixed = [batch.column(c).take(at) for c in SCANNED.names[:4]]
            yield pa.record_batch(
                [*fixed, pa.array([sizes[i] for i in kept], pa.int64()), pa.array([times[i] for i in kept], pa.int64())],
                names=SCANNED.names,
            )

    return names.select(*SCANNED.names).repartition(tasks, "abspath").mapInArrow(run, SCANNED)
