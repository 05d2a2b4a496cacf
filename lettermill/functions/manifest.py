"""Manifest lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.functions.identity import pool_path


def manifest_struct(
    email_id: str = "email_id",
    fmt: str = "format",
    source: str = "relpath",
    internal_path: str = "internal_path",
    depth: str = "container_depth",
) -> Column:
    """One manifest record; the field order is part of the format."""
    return F.struct(
        F.col(email_id).alias("email_id"),
        pool_path(email_id, fmt).alias("pool_path"),
        F.col(fmt).alias("format"),
        F.array(
            F.struct(
                F.col(source).alias("source"),
                F.col(internal_path).alias("internal_path"),
                F.col(depth).alias("depth"),
            )
        ).alias("lineage"),
    )


def manifest_json(**columns: str) -> Column:
    return F.to_json(manifest_struct(**columns))
