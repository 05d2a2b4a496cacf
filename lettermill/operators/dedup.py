"""First-seen deduplication and lineage.

Groups of copies are reduced with an aggregate that combines inside each task
before anything is shuffled, so one email held by a third of all rows costs one
row per task. Only ids, order keys and small attributes take part; the bytes of
the winners are picked up afterwards by their unique leaf key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.functions import identity, paths

# What names one leaf of a run. Two files can share a source_id (backslash names).
LEAF_NAME = ["source_id", "relpath", "leaf_key"]

_ATTRIBUTES = ["namespace", "content_sha256", "size_bytes", "format", *LEAF_NAME]


def first_seen_order() -> Column:
    """Scan order of the source, then breadth-first order inside it."""
    return F.struct(
        F.col("namespace"),
        F.col("partition"),
        paths.scan_order_key("relpath").alias("path"),
        F.size("pos").alias("hops"),
        F.col("pos"),
        F.coalesce("msg_idx", F.lit(-1)).alias("msg"),
    )


def blob_winners(leaves: DataFrame) -> DataFrame:
    """First leaf of every (email_id, ext): the blobs the pool must hold."""
    ranked = leaves.select(
        "email_id",
        identity.leaf_suffix("format").alias("ext"),
        F.struct(first_seen_order().alias("o"), *_ATTRIBUTES).alias("w"),
    )
    return ranked.groupBy("email_id", "ext").agg(
        F.min("w").alias("w"), F.count("*").alias("copies")
    )


def email_winners(blobs: DataFrame) -> DataFrame:
    """First leaf of every email_id, from the winners per extension."""
    return blobs.groupBy("email_id").agg(
        F.min(F.struct("w", "ext")).alias("b"), F.sum("copies").alias("copies")
    ).select(
        "email_id",
        "copies",
        F.col("b.ext").alias("ext"),
        *[F.col("b.w")[c].alias(c) for c in _ATTRIBUTES],
    )


def unseen(candidates: DataFrame, committed: DataFrame | None, *keys: str) -> DataFrame:
    """Candidates whose key is not committed yet (None: nothing is).

    The committed side, which only grows, is first reduced to the candidates'
    keys: a small run filters the history where it lies instead of shuffling it.
    """
    if committed is None:
        return candidates
    seen = committed.select(*keys).join(candidates.select(*keys), list(keys), "left_semi")
    return candidates.join(seen, list(keys), "left_anti")


def new_emails(winners: DataFrame, committed_emails: DataFrame | None, now: Column) -> DataFrame:
    """Rows to append to the emails table, with the winner's leaf key."""
    fresh = unseen(winners, committed_emails, "email_id")
    return fresh.select(
        "email_id",
        "namespace",
        "content_sha256",
        identity.pool_path("email_id", "format").alias("pool_path"),
        "size_bytes",
        "format",
        now.alias("first_staged_at"),
    )


def lineage_edges(leaves: DataFrame) -> DataFrame:
    """Distinct (email_id, source_id, internal_path) edges of a run."""
    return leaves.select(
        "email_id", "source_id", "namespace", "partition", "relpath", "internal_path",
        "container_depth", "format",
    ).dropDuplicates(["email_id", "source_id", "internal_path"])


def new_lineage(edges: DataFrame, committed_lineage: DataFrame | None) -> DataFrame:
    return unseen(edges, committed_lineage, "email_id", "source_id", "internal_path")


def lineage_rows(edges: DataFrame, now: Column) -> DataFrame:
    return edges.withColumn("discovered_at", now).select(*[f.name for f in S.LINEAGE.fields])
