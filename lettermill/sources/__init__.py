"""Sources and file sinks that run on executors."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lettermill.sources.bucket import BucketScan
from lettermill.sources.file_tree import FileTree


def register(spark: SparkSession) -> None:
    """Make the `bucket_scan` and `file_tree` formats known to a session."""
    spark.dataSource.register(BucketScan)
    spark.dataSource.register(FileTree)
