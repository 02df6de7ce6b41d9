"""Keep-first, caps, work batches and global positions.

Spark rows have no order, so "first" always names sequence columns. A row
number with an upper bound makes Spark cut each group inside every map task
before the shuffle, so a key that holds a third of the rows still sends only a
handful of rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landsync.session import settle


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               n: int = 1) -> DataFrame:
    """First ``n`` rows of each key by ``order``. The order must be total within
    a key for the result to be fixed."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(window))
            .filter(F.col("_rank") <= n).drop("_rank"))


def with_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows that have an id."""
    return df.filter(F.col(id_col).isNotNull() & (F.col(id_col) != ""))


def unique_facilities(records: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """One record per facility id, the first in input order."""
    return keep_first(records, ["id"], list(order))


def unique_plans(plans: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """One record per plan id, the first in input order; rows without id go."""
    return keep_first(with_id(plans), ["id"], list(order))


def unique_names(candidates: DataFrame, order: Sequence[str] = ("strategy", "rank", "pos", "url", "name"),
                 provider: str = "provider_key", name: str = "name") -> DataFrame:
    """One candidate per provider and name, blind to case; the most trusted
    strategy wins, then the place on the page, then page and spelling."""
    keyed = candidates.withColumn("_name", F.lower(F.col(name)))
    return keep_first(keyed, [provider, "_name"], list(order)).drop("_name")


def first_links(links: DataFrame, caps: dict[str, int] | int | None = None,
                order: Sequence[str] = ("rank", "pos"), group: str = "provider_key",
                url: str = "url") -> DataFrame:
    """Distinct links by first place, with ``link_rank`` (1, 2, ...).

    ``caps`` keeps at most so many per group, for sites that must not be visited
    often; a group missing from a table of caps keeps all.
    """
    firsts = keep_first(links, [group, url], list(order))
    if isinstance(caps, int):
        window = Window.partitionBy(group).orderBy(*order, url)
        return firsts.withColumn("link_rank", F.row_number().over(window)).filter(F.col("link_rank") <= caps)
    # without a cap on each group the rank can't be bounded, so a large group is ranked in pieces
    ranked = running_total(firsts, [group], [*order, url], out="_before")
    ranked = ranked.withColumn("link_rank", (F.col("_before") + 1).cast("int")).drop("_before")
    if caps is None:
        return ranked
    capped = [F.when(F.col(group) == k, F.col("link_rank") <= v) for k, v in caps.items()]
    return ranked.filter(F.coalesce(*capped, F.lit(True)))


def work_batch(pending: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The next ``n`` rows of a work queue, lowest key first."""
    return pending.orderBy(key).limit(n)


def duplicate_report(records: DataFrame, key: str = "id") -> DataFrame:
    """Rows in, unique keys and duplicates removed, as one row.

    Counting per key first keeps the distinct count free of hot keys: each map
    task sends one row per key.
    """
    per_key = records.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_in"),
        F.count(F.lit(1)).alias("unique_rows"),
    ).withColumn("removed", F.col("rows_in") - F.col("unique_rows"))


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column | None = None,
                  out: str = "before", blocks: int | None = None) -> DataFrame:
    """With the sum of ``value`` (default: the count of rows) over the rows of the same group that come
    before, by an order that should be total within a group. A group of any size is spread over tasks.

    Rows are dealt to ``blocks`` (default: the shuffle partitions) by ranges of group and order, summed per
    group and block, and each block's start is joined back. A null group is a group of its own.
    """
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.lit(1) if value is None else value
    # Stored, because the ranges come from a sample and must be the same for both uses.
    tagged = settle(df.withColumn("_value", value.cast("long")).repartitionByRange(blocks, *group, *order)
                    .withColumn("_block", F.spark_partition_id()))
    sums = tagged.groupBy("_block", *group).agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("_block").alias("_of"), *[F.col(g).alias(f"_of_{g}") for g in group],
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_block", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_block") == F.col("_of")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return (tagged.withColumn("_inside", F.coalesce(F.sum("_value").over(within), F.lit(0)))
            .join(starts, same).withColumn(out, F.col("_start") + F.col("_inside"))
            .select(*df.columns, out))


def global_position(df: DataFrame, seq: str, blocks: int | None = None,
                    out: str = "position") -> DataFrame:
    """Zero-based place of each row in the order of a unique column, dense or sparse,
    without sorting the table in one task.

    Rows are dealt to ``blocks`` (default: the shuffle partitions) by ranges of the data
    itself, counted per block, and the running total of the counts is joined back. Only
    one count per block meets in one task.
    """
    spark = df.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Stored, because the ranges come from a sample and must be the same for both uses.
    tagged = settle(df.repartitionByRange(blocks, seq).withColumn("_block", F.spark_partition_id()))
    counts = tagged.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(seq))
    return (tagged.join(offsets, "_block")
            .withColumn(out, F.col("_offset") + inside - 1)
            .drop("_block", "_offset"))
