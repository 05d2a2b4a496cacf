"""ZIP containers: one row in, one row per usable member out.

An archive is all or nothing: the first member (by name) that is too large,
encrypted or damaged refuses the whole archive with one reason row.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.schemas import (
    CORRUPT_ARCHIVE,
    EMPTY_CONTAINER,
    HASH_CHUNK_BYTES,
    MAX_MEMBER_BYTES,
    PASSWORD_PROTECTED,
)
from lettermill.storage import small_batches

# Archives that unpack to at most this much are decoded once and held; larger
# ones are checked first and decoded a second time, one member at a time.
HOLD_BYTES = 64 * 1024 * 1024
# Archives inside an archive are opened along with it up to this many bytes of them;
# the others go to the next wave, which spreads them over the cluster.
NESTED_BYTES = 4 * 1024 * 1024
# Rows leave a task in batches of about this size.
BATCH_BYTES = 8 * 1024 * 1024
BATCH_ROWS = 1024

# Bits of a member's flags (the ZIP format).
ENCRYPTED, PATCHED, STRONG_ENCRYPTION, UTF8_NAME = 1 << 0, 1 << 5, 1 << 6, 1 << 11
# A member's own header: signature, flags, lengths of its name and of its extra field.
LOCAL_HEADER, LOCAL_BYTES = "<4s2xH18xHH", 30
LOCAL_SIGNATURE = b"PK\x03\x04"

_DECODE_ERRORS = (zipfile.BadZipFile, zlib.error, EOFError, struct.error, OSError, ValueError)


@dataclass
class Refused(Exception):
    reason: str
    details: str


def _translate(error: Exception, info: zipfile.ZipInfo | None = None) -> Refused:
    # Without a password an encrypted member is the one plain RuntimeError (others are its subclasses).
    if type(error) is RuntimeError and info is not None and info.flag_bits & ENCRYPTED:
        return Refused(PASSWORD_PROTECTED, str(error))
    return Refused(CORRUPT_ARCHIVE, str(error))


def open_archive(file: BinaryIO) -> zipfile.ZipFile:
    try:
        return zipfile.ZipFile(file)
    except (*_DECODE_ERRORS, RuntimeError) as error:
        raise _translate(error) from error


def usable_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """Members by name, without directories and names that leave the archive."""

    def usable(info: zipfile.ZipInfo) -> bool:
        slashed = info.filename.replace("\\", "/")
        return not (info.is_dir() or slashed.startswith("/") or ".." in slashed.split("/"))

    return sorted(filter(usable, archive.infolist()), key=lambda i: i.filename)


def _check_size(info: zipfile.ZipInfo, limit: int) -> None:
    if info.file_size > limit:
        raise Refused(
            CORRUPT_ARCHIVE,
            f"member too large: member {info.filename!r} declares {info.file_size} bytes",
        )


def read_member(archive: zipfile.ZipFile, info: zipfile.ZipInfo, limit: int) -> bytes:
    _check_size(info, limit)
    try:
        return archive.read(info)
    except (*_DECODE_ERRORS, RuntimeError) as error:
        raise _translate(error, info) from error


def _verify(archive: zipfile.ZipFile, info: zipfile.ZipInfo, limit: int) -> None:
    _check_size(info, limit)
    try:
        with archive.open(info) as member:
            while member.read(HASH_CHUNK_BYTES):
                pass
    except (*_DECODE_ERRORS, RuntimeError) as error:
        raise _translate(error, info) from error


def member_name(info: zipfile.ZipInfo) -> str:
    """Member name as text a table can hold."""
    return info.filename.encode("utf-8", "replace").decode("utf-8")


def members(file: BinaryIO, limit: int = MAX_MEMBER_BYTES) -> Iterator[tuple[int, str, bytes]]:
    """(position, name, bytes) of each usable member; Refused before the first
    row if any member is bad."""
    with open_archive(file) as archive:
        infos = usable_members(archive)
        if not infos:
            raise Refused(EMPTY_CONTAINER, "")
        if sum(i.file_size for i in infos) <= HOLD_BYTES:
            held = [read_member(archive, info, limit) for info in infos]
            for i, info in enumerate(infos):
                yield i, member_name(info), held[i]
            return
        for info in infos:
            _verify(archive, info, limit)
        for i, info in enumerate(infos):
            yield i, member_name(info), read_member(archive, info, limit)


# --- members without the directory ------------------------------------------

# Where a member lies (`until`: start of what follows) and what it takes to read it.
PLACES_DDL = (
    "array<struct<name string, header_name string, at bigint, until bigint, packed bigint, "
    "size bigint, method int, flags int, crc bigint, attributes bigint>>"
)
PLACES_ARROW = pa.list_(
    pa.struct(
        [
            ("name", pa.string()),
            ("header_name", pa.string()),
            ("at", pa.int64()),
            ("until", pa.int64()),
            ("packed", pa.int64()),
            ("size", pa.int64()),
            ("method", pa.int32()),
            ("flags", pa.int32()),
            ("crc", pa.int64()),
            ("attributes", pa.int64()),
        ]
    )
)


def places(archive: zipfile.ZipFile) -> Iterator[dict]:
    """The usable members by name, from one look at the directory of the archive."""
    until, end = {}, archive.start_dir
    for info in sorted(archive.infolist(), key=lambda i: i.header_offset, reverse=True):  # ties as zipfile has them
        until[id(info)], end = end, info.header_offset
    for info in usable_members(archive):
        yield {
            "name": member_name(info),
            "header_name": info.orig_filename,
            "at": info.header_offset,
            "until": until[id(info)],
            "packed": info.compress_size,
            "size": info.file_size,
            "method": info.compress_type,
            "flags": info.flag_bits,
            "crc": info.CRC,
            "attributes": info.external_attr,
        }


def _past_header(file: BinaryIO, place: dict) -> None:
    """Move to the data of a member, if its own header agrees with its place."""
    file.seek(place["at"])
    header = file.read(LOCAL_BYTES)
    if len(header) < LOCAL_BYTES:
        raise zipfile.BadZipFile("Truncated file header")
    signature, flags, name_size, extra_size = struct.unpack(LOCAL_HEADER, header)
    if signature != LOCAL_SIGNATURE:
        raise zipfile.BadZipFile("Bad magic number for file header")
    name = file.read(name_size)
    for bit, what in ((PATCHED, "compressed patched data (flag bit 5)"), (STRONG_ENCRYPTION, "strong encryption (flag bit 6)")):
        if place["flags"] & bit:
            raise NotImplementedError(what)
    if name.decode("utf-8" if flags & UTF8_NAME else "cp437") != place["header_name"]:
        raise zipfile.BadZipFile(f"File name in directory {place['header_name']!r} and header {name!r} differ.")
    data = place["at"] + LOCAL_BYTES + name_size + extra_size
    if data + place["packed"] > place["until"]:
        raise zipfile.BadZipFile(f"Overlapped entries: {place['header_name']!r} (possible zip bomb)")
    file.seek(data)


def read_place(file: BinaryIO, place: dict, limit: int) -> bytes:
    """Bytes of one member, with the same refusals as when the whole archive is opened."""
    info = zipfile.ZipInfo(place["header_name"])
    info.filename = place["name"]
    info.compress_type, info.compress_size = place["method"], place["packed"]
    info.file_size, info.CRC = place["size"], place["crc"]
    info.flag_bits, info.external_attr = place["flags"], place["attributes"]
    _check_size(info, limit)
    try:
        _past_header(file, place)
        if place["flags"] & ENCRYPTED:
            raise RuntimeError(f"File {info!r} is encrypted, password required for extraction")
        return zipfile.ZipExtFile(file, "rb", info).read()
    except (*_DECODE_ERRORS, RuntimeError) as error:
        raise _translate(error, info) from error


# --- rows out of tasks ------------------------------------------------------

# What opening a file or a container produces. `reason` is set on rows that
# stand for a refused container or an unreadable file.
OPENED_DDL = (
    "source_id string, namespace string, partition string, relpath string, "
    "internal_path string, container_depth int, pos array<int>, raw binary, "
    "reason string, details string"
)
OPENED_ARROW = pa.schema(
    [
        ("source_id", pa.string()),
        ("namespace", pa.string()),
        ("partition", pa.string()),
        ("relpath", pa.string()),
        ("internal_path", pa.string()),
        ("container_depth", pa.int32()),
        ("pos", pa.list_(pa.int32())),
        ("raw", pa.binary()),
        ("reason", pa.string()),
        ("details", pa.string()),
    ]
)


class RowBatcher:
    """Collects output rows and hands them out in batches bounded by bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.rows: list[dict] = []
        self.size = 0

    def add(self, row: dict) -> Iterator[pa.RecordBatch]:
        incoming = len(row.get("raw") or b"")
        if self.rows and (self.size + incoming > BATCH_BYTES or len(self.rows) >= BATCH_ROWS):
            yield self._take()
        self.rows.append(row)
        self.size += incoming

    def _take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.size = [], 0
        return batch

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield self._take()


def member_rows(container: dict, file: BinaryIO, limit: int) -> Iterator[dict]:
    """Rows of one archive; `container` carries the columns of its own row."""
    same = {k: container[k] for k in ("source_id", "namespace", "partition", "relpath")}
    depth, pos = container["container_depth"], container["pos"] or []
    try:
        for i, name, raw in members(file, limit):
            yield same | {
                "internal_path": f"{container['internal_path']}!{name}",
                "container_depth": depth + 1,
                "pos": [*pos, i],
                "raw": raw,
            }
    except Refused as refused:
        yield same | {
            "internal_path": container["internal_path"],
            "container_depth": depth,
            "pos": pos,
            "reason": refused.reason,
            "details": refused.details,
        }


def names_zip(internal_path: str, cut_hash: bool = True) -> bool:
    """Whether `paths.classify_item` surely calls this a zip."""
    path = internal_path.split("#", 1)[0] if cut_hash else internal_path
    return path[-4:] in _ZIP_SUFFIXES


_ZIP_SUFFIXES = frozenset("." + z + i + p for z in "zZ" for i in "iI" for p in "pP")


def nested_rows(container: dict, file: BinaryIO, limit: int, max_depth: int, cut_hash: bool = True) -> Iterator[dict]:
    """The same, with small archives inside opened too, down to `max_depth` containers. What they
    hold together is bounded by NESTED_BYTES; further ones stay rows."""
    left = NESTED_BYTES

    def walk(row: dict, file: BinaryIO) -> Iterator[dict]:
        nonlocal left
        for member in member_rows(row, file, limit):
            raw = member.get("raw")
            size = len(raw or b"")
            # a refused archive is a row without bytes, and stays one
            if (
                raw is not None and size <= left and member["container_depth"] < max_depth
                and names_zip(member["internal_path"], cut_hash)
            ):
                left -= size
                yield from walk(member, io.BytesIO(raw))
            else:
                yield member

    return walk(container, file)


def explode_zip(
    containers: DataFrame, max_member_bytes: int = MAX_MEMBER_BYTES, max_depth: int = 0, cut_hash: bool = True
) -> DataFrame:
    """Members of archives held in rows (columns of `schemas.ITEMS`); small archives among them are
    opened along with theirs as far as `max_depth` allows."""

    def run(batches):
        out = RowBatcher(OPENED_ARROW)
        for batch in batches:
            columns = batch.schema.names
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in columns}
                for member in nested_rows(row, io.BytesIO(row["raw"] or b""), max_member_bytes, max_depth, cut_hash):
                    yield from out.add(member)
        yield from out.flush()

    small_batches(containers.sparkSession)
    return containers.select(*_ITEM_COLUMNS).mapInArrow(run, OPENED_DDL)


_ITEM_COLUMNS = [
    "source_id", "namespace", "partition", "relpath", "internal_path", "container_depth", "pos", "raw"
]


def open_small(items: DataFrame, max_member_bytes: int, max_depth: int, cut_hash: bool = True) -> DataFrame:
    """Items with the members of small archives in their place; other rows pass as they are."""

    def run(batches):
        out = RowBatcher(OPENED_ARROW)
        for batch in batches:
            columns = batch.schema.names
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in columns}
                opens = (
                    row["reason"] is None and len(row["raw"] or b"") <= NESTED_BYTES
                    and names_zip(row["internal_path"] or "", cut_hash) and row["container_depth"] < max_depth
                )
                rows = (
                    nested_rows(row, io.BytesIO(row["raw"] or b""), max_member_bytes, max_depth, cut_hash)
                    if opens else [row]
                )
                for own in rows:
                    yield from out.add(own)
        yield from out.flush()

    small_batches(items.sparkSession)
    for name in ("reason", "details"):
        if name not in items.columns:
            items = items.withColumn(name, F.lit(None).cast("string"))
    return items.select(*_ITEM_COLUMNS, "reason", "details").mapInArrow(run, OPENED_DDL)


def spread(frame: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Shuffle on keys that name single rows, so that no hot tenant, source or
    archive decides how much one task gets."""
    if partitions:
        return frame.repartition(partitions, *[F.col(k) for k in keys])
    return frame.repartition(*[F.col(k) for k in keys])
