"""Containers built from rows, as inputs for the unpacking queries."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettermill.storage import small_batches


def make_zip(members: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members:
            archive.writestr(zipfile.ZipInfo(name, (2024, 7, 15, 0, 0, 0)), content,
                             zipfile.ZIP_DEFLATED)
    return out.getvalue()


def mark_encrypted(archive: bytes) -> bytes:
    """Set the encryption bit of every member, in both of its headers."""
    out = bytearray(archive)
    with zipfile.ZipFile(io.BytesIO(archive)) as opened:
        at = opened.start_dir
        for info in opened.infolist():
            out[info.header_offset + 6] |= 1
            out[at + 8] |= 1
            name, extra, comment = (int.from_bytes(out[at + o:at + o + 2], "little") for o in (28, 30, 32))
            at += 46 + name + extra + comment
    return bytes(out)


def damage(archive: bytes) -> bytes:
    """Break the compressed data of the first member."""
    out = bytearray(archive)
    start = 30 + int.from_bytes(out[26:28], "little") + int.from_bytes(out[28:30], "little")
    for i in range(start, min(start + 6, len(out))):
        out[i] ^= 0xFF
    return bytes(out)


def members(*pairs: tuple[str, Column]) -> Column:
    """array<struct<name, content>> for pack_zip."""
    return F.array(
        *[F.struct(F.lit(n).alias("name"), c.cast("binary").alias("content")) for n, c in pairs]
    )


def pack_zip(frame: DataFrame, column: str, out: str) -> DataFrame:
    """Replace an array<struct<name, content>> column by an archive of it, where the rows are.

    Compressing costs far more than a shuffle of the texts: callers spread the table first,
    once, before the texts are repeated in members.
    """
    small_batches(frame.sparkSession)
    at = frame.columns.index(column)
    kept = [f for f in frame.schema.fields if f.name != column]

    def run(batches):
        for batch in batches:
            packed = [
                make_zip([(m["name"], m["content"]) for m in row.as_py()]) if row.is_valid else None
                for row in batch.column(at)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(packed, pa.binary())],
                names=[*[f.name for f in kept], out],
            )

    return frame.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.BinaryType())]))


def mailbox(*messages: Column) -> Column:
    """Messages with separator lines before and a blank line after each."""
    parts = []
    for i, message in enumerate(messages):
        parts += [F.lit(f"From sender{i}@example.com Mon Jul 15 10:00:0{i} 2024\n"), message, F.lit("\n\n")]
    return F.concat(*parts)


def mailbox_sql(*messages: str) -> str:
    return " || ".join(
        f"'From sender{i}@example.com Mon Jul 15 10:00:0{i} 2024' || chr(10) || {m} || chr(10) || chr(10)"
        for i, m in enumerate(messages)
    )


def messages_cte(source: str, columns: str, box: str = "box", name: str = "messages") -> str:
    """CTEs that split mailboxes by plain text search.

    The pieces between `LF From ` marks start with the rest of a separator line
    and lack the line break that the mark took.
    """
    return f"""{name}_pieces AS (
      SELECT {columns}, string_split(chr(10) || {box}, chr(10) || 'From ') AS pieces FROM {source}),
    {name}_rows AS (
      SELECT {columns}, unnest(pieces[2:]) AS piece, generate_subscripts(pieces[2:], 1) - 1 AS idx,
        len(pieces) - 2 AS last FROM {name}_pieces),
    {name}_bodies AS (
      SELECT {columns}, idx, CASE WHEN strpos(piece, chr(10)) = 0 THEN ''
        WHEN idx = last THEN substr(piece, strpos(piece, chr(10)) + 1)
        ELSE substr(piece, strpos(piece, chr(10)) + 1) || chr(10) END AS m FROM {name}_rows),
    {name} AS (
      SELECT {columns}, CAST(idx AS INTEGER) AS msg_idx,
        CASE WHEN m = chr(10) OR ends_with(m, chr(10) || chr(10)) THEN left(m, length(m) - 1)
        ELSE m END AS body FROM {name}_bodies)"""
