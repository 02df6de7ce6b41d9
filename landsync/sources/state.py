"""Source change detection: run only if the source is newer than the stored time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.functions.text import col
from landsync.sources.store import read_snapshot, write_snapshot

STATE_SCHEMA = "source_id string, last_modified string"


def newer(current: Column | str, last: Column | str) -> Column:
    """Is an ISO time (text, ``Z`` allowed) later than the stored one? True also
    where either is missing or unreadable."""
    now = F.try_to_timestamp(col(current))
    then = F.try_to_timestamp(col(last))
    return F.coalesce(now > then, F.lit(True))


def changed_sources(sources: DataFrame, state: DataFrame) -> DataFrame:
    """Each source with ``changed``. ``sources`` has ``source_id, modified_time``."""
    return (sources.join(state.select("source_id", "last_modified"), "source_id", "left")
            .withColumn("changed", newer("modified_time", "last_modified")))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    return read_snapshot(spark, root, STATE_SCHEMA)


def commit_state(checked: DataFrame, root: str) -> None:
    """Store the new times; call only after the data has been written. A source
    whose time could not be read keeps its stored time."""
    spark = checked.sparkSession
    fresh = checked.filter(F.col("changed") & F.col("modified_time").isNotNull()).select(
        "source_id", F.col("modified_time").alias("_new"))
    state = read_state(spark, root)
    merged = state.join(fresh, "source_id", "full_outer").select(
        "source_id", F.coalesce("_new", "last_modified").alias("last_modified"))
    write_snapshot(merged, root)
