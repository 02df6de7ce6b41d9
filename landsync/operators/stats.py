"""Run statistics as small DataFrames.

Counts are plain grouped or conditional sums, so each map task sends one row
per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsync.operators.dedup import global_position


def count_if(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")


def sync_stats(diffed: DataFrame, status: str = "status") -> DataFrame:
    """One row: new, updated, unchanged, errors (conflicts)."""
    s = F.col(status)
    return diffed.agg(count_if(s == "new").alias("new"),
                      count_if(s == "updated").alias("updated"),
                      count_if(s == "unchanged").alias("unchanged"),
                      count_if(s == "conflict").alias("errors"))


def sync_report(diffed: DataFrame, status: str = "status") -> DataFrame:
    """The six-field form with ``processed`` and ``success`` added."""
    return sync_stats(diffed, status).select(
        (F.col("new") + F.col("updated") + F.col("unchanged")).alias("processed"),
        (F.col("new") + F.col("updated")).alias("success"),
        "errors", "new", "updated", "unchanged")


def plans_per_provider(providers: DataFrame, plans: DataFrame, key: str = "provider_key",
                       item: str = "id") -> DataFrame:
    """Plans per provider, zero for silent ones. Plans are counted before the join,
    so a provider with most of the plans is one row by then."""
    counts = plans.groupBy(key).agg(F.count(item).alias("_n"))
    return (providers.select(key).join(counts, key, "left")
            .select(key, F.coalesce(F.col("_n"), F.lit(0)).alias("plans")))


def scrape_totals(results: DataFrame) -> DataFrame:
    good = F.coalesce(F.col("scrape_success"), F.lit(False))
    return results.agg(F.count(F.lit(1)).alias("total"), count_if(good).alias("success"),
                       count_if(~good).alias("failed"))


def update_totals(results: DataFrame, merged: DataFrame, id_col: str = "clinic_id") -> DataFrame:
    """updated / failed of a run and how many facilities remain pending.

    A result without id, or of a failed lookup, counts as failed.
    """
    good = (F.coalesce(F.col("scrape_success"), F.lit(False))
            & F.coalesce(F.col(id_col) != "", F.lit(False)))
    zero, one = F.lit(0), F.lit(1)
    marks = results.select(F.when(good, one).otherwise(zero).alias("updated"),
                           F.when(good, zero).otherwise(one).alias("failed"),
                           zero.alias("remaining"))
    waiting = (merged.filter(F.col("latitude").isNull() & F.col("is_active"))
               .select(zero.alias("updated"), zero.alias("failed"), one.alias("remaining")))
    return marks.unionByName(waiting).agg(
        *[F.coalesce(F.sum(c), zero).cast("long").alias(c)
          for c in ("updated", "failed", "remaining")])


def pending_count(facilities: DataFrame) -> DataFrame:
    return (facilities.filter(F.col("latitude").isNull() & F.col("is_active"))
            .agg(F.count(F.lit(1)).alias("pending")))


def active_count(plans: DataFrame, provider_name: str | None = None) -> DataFrame:
    """Active plans, of one provider if named, as one row."""
    kept = plans.filter(F.col("is_active"))
    if provider_name is not None:
        kept = kept.filter(F.col("provider_name") == provider_name)
    return kept.agg(F.count(F.lit(1)).alias("plans"))


def active_count_by_provider(plans: DataFrame) -> DataFrame:
    return (plans.filter(F.col("is_active")).groupBy("provider_name")
            .agg(F.count(F.lit(1)).alias("plans")))


def group_by_provider(plans: DataFrame) -> DataFrame:
    """Plans and distinct ids per provider; a missing provider reads Unknown."""
    per_id = (plans.groupBy(F.coalesce(F.col("provider_name"), F.lit("Unknown"))
                            .alias("provider_name"), "id")
              .agg(F.count(F.lit(1)).alias("_n")))
    return per_id.groupBy("provider_name").agg(
        F.sum("_n").alias("plans"), F.count("id").alias("unique_ids"))


def batch_accounting(records: DataFrame, seq: str = "seq", batch_size: int = 500,
                     failed: Column | None = None) -> DataFrame:
    """Rows and errors per write batch of ``batch_size`` rows in input order.

    A batch with any failed row counts whole as errors, as batches are written
    all or nothing.
    """
    bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    placed = global_position(records.withColumn("_bad", bad), seq)
    batch = F.expr(f"position div {int(batch_size)}") + 1
    per = placed.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("records"), F.max("_bad").alias("_bad"))
    return per.select(
        "batch", "records",
        F.when(F.col("_bad"), F.lit(0)).otherwise(F.col("records")).alias("success"),
        F.when(F.col("_bad"), F.col("records")).otherwise(F.lit(0)).alias("errors"))


def without_id_report(records: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows with and without an id, in one pass."""
    has = F.coalesce(F.col(id_col) != "", F.lit(False))
    return records.agg(F.coalesce(count_if(has), F.lit(0)).alias("kept"),
                       F.coalesce(count_if(~has), F.lit(0)).alias("rejected"))
