"""Scan order as numbers, without one task that sees everything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lettermill.functions import paths


def scan_rank(scanned: DataFrame, work: str) -> DataFrame:
    """`rank` (from 1) of every scanned file in bucket order.

    A range-partitioned sort, then an offset per sorted part. The parts are
    written first, since the cut points of a sort are drawn anew each time.
    """
    spark = scanned.sparkSession
    ordered = scanned.orderBy(
        "namespace", "partition", paths.scan_order_key("relpath")
    ).withColumn("seq", F.monotonically_increasing_id())
    ordered.write.mode("overwrite").parquet(f"{work}/ordered")
    parts = spark.read.schema(ordered.schema).parquet(f"{work}/ordered")
    # monotonically_increasing_id holds the task number above 33 bits.
    task = F.shiftright("seq", 33)
    counts = parts.groupBy(task.alias("task")).agg(F.count("*").alias("n"), F.min("seq").alias("low"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the sort.
    counts.select(
        "task", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    ).write.mode("overwrite").parquet(f"{work}/offsets")
    offsets = spark.read.parquet(f"{work}/offsets")
    return (
        parts.withColumn("task", task).join(offsets, "task")
        .withColumn("rank", F.col("seq") - F.col("low") + F.col("offset") + 1)
        .drop("task", "low", "offset", "seq")
    )
