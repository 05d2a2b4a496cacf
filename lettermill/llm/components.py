"""Connected components of a link table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.storage import stored

MOST_ROUNDS = 60  # stars at least halve a path in two rounds


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node point to the least in its neighbourhood."""
    both = _both(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, point to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> node, root: the least node that it is connected with, for every node
    that has a link and is not the least itself. Nodes of any type that can be ordered.

    Nodes with very many links are counted by partial minima; nothing is gathered.
    """
    stars = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    mark = None
    for _ in range(MOST_ROUNDS):
        stars = stored(_small(_large(stars)), "links")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
