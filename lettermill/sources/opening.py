"""Reading bucket files on executors: content, hash and first container level.

Each file is opened once. Its bytes are hashed while they are read, mail files
and mailboxes leave as one row, small archives as one row per member. Files
over `inline_bytes` never travel as one row: big archives leave as slices of
their member list, big mailboxes as byte ranges, both opened again in parallel.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lettermill.operators.archive import (
    OPENED_ARROW,
    OPENED_DDL,
    PLACES_ARROW,
    PLACES_DDL,
    Refused,
    RowBatcher,
    nested_rows,
    open_archive,
    places,
    read_place,
)
from lettermill.schemas import (
    EMPTY_CONTAINER,
    HASH_CHUNK_BYTES,
    MAX_CONTAINER_DEPTH,
    MAX_MEMBER_BYTES,
    UNREADABLE,
)
from lettermill.sources.files import open_binary
from lettermill.sources.large_mbox import ranges

INLINE_BYTES = 256 * 1024 * 1024
SLICE_BYTES = 64 * 1024 * 1024
# Members of a slice, at most: its row carries where they lie.
SLICE_MEMBERS = 8192
# A Spark row cannot exceed 2 GiB; a single message above this fails its source.
ROW_BYTES = 2_000_000_000

ITEM, SOURCE, SLICE, BIG_MBOX = "item", "source", "slice", "big_mbox"

SOURCE_ROWS_DDL = (
    OPENED_DDL
    + ", row_type string, file_sha256 string, error string, abspath string, "
    f"slice_lo bigint, slice_hi bigint, places {PLACES_DDL}"
)
SOURCE_ROWS_ARROW = pa.schema(
    [
        *OPENED_ARROW,
        ("row_type", pa.string()),
        ("file_sha256", pa.string()),
        ("error", pa.string()),
        ("abspath", pa.string()),
        ("slice_lo", pa.int64()),
        ("slice_hi", pa.int64()),
        ("places", PLACES_ARROW),
    ]
)


@dataclass(frozen=True)
class ReadLimits:
    max_depth: int = MAX_CONTAINER_DEPTH
    max_member_bytes: int = MAX_MEMBER_BYTES
    inline_bytes: int = INLINE_BYTES
    slice_bytes: int = SLICE_BYTES
    cut_hash: bool = True


def hash_stream(path: str) -> str:
    digest = hashlib.sha256()
    with open_binary(path) as f:
        while chunk := f.read(HASH_CHUNK_BYTES):
            digest.update(chunk)
    return digest.hexdigest()


def _slices(path: str, limits: ReadLimits) -> Iterator[tuple[int, list[dict]]]:
    """Usable members, with the number of the first, whose declared sizes sum to about one slice."""
    with open_binary(path) as f, open_archive(f) as archive:
        start, own, held = 0, [], 0
        for place in places(archive):
            if own and (held + place["size"] > limits.slice_bytes or len(own) == SLICE_MEMBERS):
                yield start, own
                start, own, held = start + len(own), [], 0
            own.append(place)
            held += place["size"]
        if not own:
            raise Refused(EMPTY_CONTAINER, "")
        yield start, own


def _open_one(file: dict, limits: ReadLimits) -> Iterator[dict]:
    """Rows of one bucket file; the `source` row comes last, once all is read."""
    same = {k: file[k] for k in ("source_id", "namespace", "partition", "relpath")}
    path, kind = file["abspath"], file["kind"]
    item = same | {"internal_path": file["relpath"], "container_depth": 0, "pos": [], "row_type": ITEM}
    source = same | {"internal_path": file["relpath"], "row_type": SOURCE, "abspath": path}
    opens = kind in ("mbox", "zip") and limits.max_depth >= 1
    try:
        if not (opens or kind in ("eml", "html")):
            sha = hash_stream(path)
            yield item
        elif kind in ("eml", "html") or file["size_bytes"] <= limits.inline_bytes:
            with open_binary(path) as f:
                if file["size_bytes"] > ROW_BYTES:
                    raise ValueError(f"message of {file['size_bytes']} bytes does not fit a row")
                content = f.read()
            sha = hashlib.sha256(content).hexdigest()
            if kind == "zip":
                rows = nested_rows(
                    item, io.BytesIO(content), limits.max_member_bytes, limits.max_depth, limits.cut_hash
                )
                yield from ({"row_type": ITEM} | row for row in rows)
            else:
                yield item | {"raw": content}
        elif kind == "zip":
            sha = hash_stream(path)
            try:
                for lo, own in _slices(path, limits):
                    part = {"row_type": SLICE, "abspath": path, "places": own}
                    yield item | part | {"slice_lo": lo, "slice_hi": lo + len(own)}
            except Refused as refused:
                yield item | {"reason": refused.reason, "details": refused.details}
        else:
            sha = hash_stream(path)
            for lo, hi in ranges(file["size_bytes"], limits.slice_bytes):
                yield item | {"row_type": BIG_MBOX, "abspath": path, "slice_lo": lo, "slice_hi": hi}
        yield source | {"file_sha256": sha}
    except OSError as failure:
        yield item | {"reason": UNREADABLE, "details": str(failure)}
        yield source
    except Exception as failure:
        yield source | {"error": f"{type(failure).__name__}: {failure}"}


def open_sources(files: DataFrame, limits: ReadLimits = ReadLimits()) -> DataFrame:
    """Open bucket files given by source_id, namespace, partition, relpath,
    abspath, size_bytes and kind."""

    def run(batches):
        out = RowBatcher(SOURCE_ROWS_ARROW)
        for batch in batches:
            for file in batch.to_pylist():
                for row in _open_one(file, limits):
                    yield from out.add(row)
        yield from out.flush()

    wanted = ["source_id", "namespace", "partition", "relpath", "abspath", "size_bytes", "kind"]
    return files.select(*wanted).mapInArrow(run, SOURCE_ROWS_DDL)


def open_slices(slices: DataFrame, limits: ReadLimits = ReadLimits()) -> DataFrame:
    """Members of big archives, slice by slice, read from the files in parallel: a task seeks to
    its members, whatever else the archive holds.

    A bad member gives a reason row; the caller drops the other rows of that
    archive, which may come from other tasks.
    """

    def read(part: dict) -> Iterator[dict]:
        same = {k: part[k] for k in ("source_id", "namespace", "partition", "relpath")}
        try:
            with open_binary(part["abspath"]) as f:
                for i, place in enumerate(part["places"], part["slice_lo"]):
                    raw = read_place(f, place, limits.max_member_bytes)
                    yield same | {
                        "internal_path": f"{part['internal_path']}!{place['name']}",
                        "container_depth": 1,
                        "pos": [i],
                        "raw": raw,
                        "row_type": ITEM,
                    }
        except (Refused, OSError) as failure:
            refused = failure if isinstance(failure, Refused) else Refused(UNREADABLE, str(failure))
            yield same | {
                "internal_path": part["internal_path"],
                "container_depth": 0,
                "pos": [part["slice_lo"]],
                "reason": refused.reason,
                "details": refused.details,
                "row_type": ITEM,
            }

    def run(batches):
        out = RowBatcher(SOURCE_ROWS_ARROW)
        for batch in batches:
            for i in range(batch.num_rows):  # a row may carry thousands of places
                for row in read(batch.slice(i, 1).to_pylist()[0]):
                    yield from out.add(row)
        yield from out.flush()

    wanted = ["source_id", "namespace", "partition", "relpath", "internal_path",
              "abspath", "slice_lo", "places"]
    return slices.select(*wanted).mapInArrow(run, SOURCE_ROWS_DDL)


def hash_files(files: DataFrame) -> DataFrame:
    """`files` plus `content_sha256` and `hash_error`, read in chunks."""
    columns = files.columns
    at = columns.index("abspath")

    def run(batches):
        for batch in batches:
            hashes, errors = [], []
            for path in batch.column(at).to_pylist():
                try:
                    hashes.append(hash_stream(path))
                    errors.append(None)
                except OSError as failure:
                    hashes.append(None)
                    errors.append(str(failure))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hashes, pa.string()), pa.array(errors, pa.string())],
                names=[*columns, "content_sha256", "hash_error"],
            )

    added = [T.StructField(n, T.StringType()) for n in ("content_sha256", "hash_error")]
    return files.mapInArrow(run, T.StructType([*files.schema.fields, *added]))
