"""Connected components of links by alternating stars, without the driver holding any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landsync.llm.common import settled


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(a, b) for every linked a but the least of its component, b being that least.

    ``links`` has long columns a and b. Each round writes its links to the shared
    folder; the rounds needed grow as the logarithm of a component's size.
    """
    now = settled(links.where("a <> b").select("a", "b").distinct(), "links")

    def mark(df: DataFrame) -> tuple:
        # the sum of hashes in decimal: ANSI mode has no overflow to wrap
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(now)
    while before[0]:
        now = settled(_small_star(_large_star(now)).where("a <> b").distinct(), "links")
        after = mark(now)
        if after == before:
            break
        before = after
    return now
