"""Reports and lookups on the state tables (plain DataFrames in, DataFrames out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.functions import identity, paths


def decision_counts(verdicts: DataFrame) -> DataFrame:
    """One row: scanned files and files per decision."""
    return verdicts.agg(
        F.count("*").alias("files_scanned"),
        *[F.count_if(F.col("decision") == d).alias(f"files_{d}") for d in S.DECISIONS],
    )


def mail_counts(leaves: DataFrame, staged: DataFrame) -> DataFrame:
    """One row: emails staged by this run, and all other leaves."""
    counts = leaves.agg(F.count("*").alias("leaves"), F.lit(0).alias("staged")).unionByName(
        staged.agg(F.lit(0).alias("leaves"), F.count("*").alias("staged"))
    )
    return counts.agg(
        F.sum("staged").alias("emails_staged"), (F.sum("leaves") - F.sum("staged")).alias("emails_relinked")
    )


def summary_line(mode: str) -> Column:
    """The one-line run summary over the counter columns."""
    names = [
        ("scanned", "files_scanned"), ("new", "files_new"), ("changed", "files_changed"),
        ("unchanged", "files_unchanged"), ("metadata_only", "files_metadata_only"),
        ("failed", "files_failed"), ("emails_staged", "emails_staged"),
        ("relinked", "emails_relinked"), ("skipped", "skipped"),
    ]
    text = f"mode={mode} " + " ".join(f"{label}=%d" for label, _ in names)
    return F.format_string(text, *[F.col(c) for _, c in names])


# --- lookups ----------------------------------------------------------------


def lineage_of_email(lineage: DataFrame, email_id: str) -> DataFrame:
    return lineage.filter(F.col("email_id") == email_id)


def lineage_of_emails(lineage: DataFrame, emails: DataFrame) -> DataFrame:
    """Places of all emails in a table of email_id, of any size."""
    return lineage.join(emails.select("email_id").distinct(), "email_id", "left_semi")


def lineage_of_partition(lineage: DataFrame, partition: str, namespace: str | None = None) -> DataFrame:
    rows = lineage.filter(F.col("partition") == partition)
    return rows if namespace is None else rows.filter(F.col("namespace") == namespace)


def source_at(source_files: DataFrame, namespace: str, partition: str, relpath: str) -> DataFrame:
    return source_files.filter(
        (F.col("namespace") == namespace)
        & (F.col("partition") == partition)
        & (F.col("relpath") == relpath)
    )


def source_status(source_files: DataFrame) -> DataFrame:
    return source_files.select("source_id", "namespace", "partition", "relpath", "status")


def skip_counts(skipped: DataFrame) -> DataFrame:
    return skipped.groupBy("reason").agg(F.count("*").alias("skips"))


def partition_contents(lineage: DataFrame, emails: DataFrame) -> DataFrame:
    """Distinct emails present in each partition, as a downstream reader sees them."""
    present = lineage.select("partition", "email_id").distinct()
    return present.join(emails, "email_id")


def trace(lineage: DataFrame, source_files: DataFrame) -> DataFrame:
    """Every leaf with its container chain and the bucket file it came from."""
    located = source_files.select("source_id", "relpath")
    chain = paths.hops("internal_path")
    return lineage.join(located, "source_id").select(
        "email_id", "source_id", "namespace", "partition", "relpath", "internal_path",
        "container_depth",
        chain[0].alias("bucket_file"),
        F.size(chain).alias("hops"),
        F.element_at(chain, -1).alias("last_hop"),
    )


# --- checks; every one of them must come back empty -------------------------


def manifest_mismatches(manifest: DataFrame, emails: DataFrame) -> DataFrame:
    """Ids on one side only, with the side that misses them."""
    ours = manifest.select("email_id").distinct().withColumn("in_manifest", F.lit(True))
    theirs = emails.select("email_id").withColumn("in_emails", F.lit(True))
    both = ours.join(theirs, "email_id", "full_outer")
    return both.filter(F.col("in_manifest").isNull() | F.col("in_emails").isNull()).select(
        "email_id",
        F.when(F.col("in_manifest").isNull(), "manifest").otherwise("emails").alias("missing_in"),
    )


def in_pool(emails: DataFrame, pool: DataFrame) -> DataFrame:
    """Emails whose blob is in the pool."""
    keyed = emails.withColumn("ext", identity.leaf_suffix("format"))
    return keyed.join(pool.select("email_id", "ext"), ["email_id", "ext"], "left_semi").drop("ext")


def pool_missing(emails: DataFrame, pool: DataFrame) -> DataFrame:
    """Emails whose blob is missing from the pool."""
    keyed = emails.withColumn("ext", identity.leaf_suffix("format"))
    return keyed.join(pool.select("email_id", "ext"), ["email_id", "ext"], "left_anti").drop("ext")


def orphans(lineage: DataFrame, skipped: DataFrame, emails: DataFrame, source_files: DataFrame) -> DataFrame:
    """Rows that refer to an email or a source that is not there."""

    def missing(rows: DataFrame, target: DataFrame, key: str, label: str) -> DataFrame:
        return rows.join(target.select(key), key, "left_anti").select(
            F.lit(label).alias("reference"), F.col(key).alias("missing_id"), "internal_path"
        )

    return (
        missing(lineage, emails, "email_id", "lineage.email_id")
        .unionByName(missing(lineage, source_files, "source_id", "lineage.source_id"))
        .unionByName(missing(skipped, source_files, "source_id", "skipped.source_id"))
    )
