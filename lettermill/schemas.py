"""Table schemas and closed vocabularies.

The string values below are fixed: they are stored in the tables and consumers
filter on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

PASSWORD_PROTECTED = "password_protected"
CORRUPT_ARCHIVE = "corrupt_archive"
UNSUPPORTED_FORMAT_DEFERRED = "unsupported_format_deferred"
NOT_AN_EMAIL = "not_an_email"
EMPTY_CONTAINER = "empty_container"
DEPTH_LIMIT_EXCEEDED = "depth_limit_exceeded"
UNREADABLE = "unreadable"

SKIP_REASONS = (
    PASSWORD_PROTECTED,
    CORRUPT_ARCHIVE,
    UNSUPPORTED_FORMAT_DEFERRED,
    NOT_AN_EMAIL,
    EMPTY_CONTAINER,
    DEPTH_LIMIT_EXCEEDED,
    UNREADABLE,
)

DISCOVERED = "discovered"
IN_PROGRESS = "in_progress"
DONE = "done"
FAILED = "failed"

SOURCE_STATUSES = (DISCOVERED, IN_PROGRESS, DONE, FAILED)

NEW = "new"
UNCHANGED = "unchanged"
METADATA_ONLY = "metadata_only"
CHANGED = "changed"

DECISIONS = (NEW, UNCHANGED, METADATA_ONLY, CHANGED)

EML = "eml"
HTML = "html"

# --- limits (fixed defaults) ------------------------------------------------

MAX_CONTAINER_DEPTH = 8
MAX_MEMBER_BYTES = 256 * 1024 * 1024
HASH_CHUNK_BYTES = 1024 * 1024

# --- table schemas ----------------------------------------------------------


_TEXT, _LONG, _INT, _TIME, _BYTES = (
    T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType(), T.BinaryType()
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SCANNED = _struct(
    namespace=_TEXT, partition=_TEXT, relpath=_TEXT, abspath=_TEXT,
    size_bytes=_LONG, mtime_ns=_LONG,
)

SOURCE_FILES = _struct(
    source_id=_TEXT, namespace=_TEXT, partition=_TEXT, relpath=_TEXT,
    size_bytes=_LONG, mtime_ns=_LONG, content_sha256=_TEXT, status=_TEXT,
    first_seen_at=_TIME, last_processed_at=_TIME,
)

# One row per state change of a source; SOURCE_FILES is the latest row of each.
LEDGER_EVENTS = T.StructType(
    [*SOURCE_FILES.fields, *_struct(run_seq=_LONG, step=_INT).fields]
)

EMAILS = _struct(
    email_id=_TEXT, namespace=_TEXT, content_sha256=_TEXT, pool_path=_TEXT,
    size_bytes=_LONG, format=_TEXT, first_staged_at=_TIME,
)

LINEAGE = _struct(
    email_id=_TEXT, source_id=_TEXT, namespace=_TEXT, partition=_TEXT,
    internal_path=_TEXT, container_depth=_INT, discovered_at=_TIME,
)

SKIPPED = _struct(
    source_id=_TEXT, internal_path=_TEXT, reason=_TEXT, details=_TEXT, skipped_at=_TIME
)

POOL = _struct(email_id=_TEXT, ext=_TEXT, raw=_BYTES, shard=_TEXT)

MANIFEST_LINE = _struct(
    email_id=_TEXT, pool_path=_TEXT, format=_TEXT,
    lineage=T.ArrayType(_struct(source=_TEXT, internal_path=_TEXT, depth=_INT)),
)

# --- frames inside a run ----------------------------------------------------

# A thing still to be classified: a bucket file or a member of a container.
# `pos` holds the sibling position at every archive hop, so (size(pos), pos)
# is breadth-first order and (source_id, pos) names one item uniquely.
ITEMS = _struct(
    source_id=_TEXT, namespace=_TEXT, partition=_TEXT, relpath=_TEXT,
    internal_path=_TEXT, container_depth=_INT, pos=T.ArrayType(_INT), raw=_BYTES,
)
