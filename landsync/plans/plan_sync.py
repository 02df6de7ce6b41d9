"""Plan sync: union of providers, diff against the stored table, write, report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync import schemas
from landsync.operators.dedup import unique_plans
from landsync.operators.merge import align, long_enough, missing_plans, sync_plans
from landsync.session import as_files, settle
from landsync.sources.log_table import append_log, changed_live, live_counts, read_ids, read_log
from landsync.sources.store import (prefixes_of, read_folders, read_snapshot, replace_folders,
                                    write_snapshot)


def union_providers(parts: list[DataFrame]) -> DataFrame:
    """Plans of several providers in the given order (``provider_rank``)."""
    ranked = [p.withColumn("provider_rank", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def sync_stored_plans(plans: DataFrame, root: str, order: tuple[str, ...],
                      run_ts: Column | None = None, null_policy: str = "overwrite",
                      reactivate: bool = False,
                      buckets: int | None = None) -> dict[str, int]:
    """Diff scraped plans with the stored table and write its next version.

    The statistics are taken while the version is written. See the store for
    ``buckets``.
    """
    spark = plans.sparkSession
    stored = align(read_snapshot(spark, root, schemas.PLAN, buckets), schemas.PLAN)
    incoming = unique_plans(plans, order)
    nexts = sync_plans(stored, incoming, run_ts, null_policy, reactivate)
    return _report(write_snapshot(nexts, root, buckets=buckets, observe=_hits()))


def sync_plans_in_place(plans: DataFrame, root: str, order: tuple[str, ...],
                        run_ts: Column | None = None, null_policy: str = "overwrite",
                        reactivate: bool = False, digits: int = 2) -> dict[str, int]:
    """As above for a table kept in id-prefix folders: a day's change of a few thousand plans
    reads and writes only the folders these fall into."""
    spark = plans.sparkSession
    incoming = settle(unique_plans(plans, order))
    hit = prefixes_of(incoming, digits)
    part = align(read_folders(spark, root, hit, digits, schemas.PLAN), schemas.PLAN)
    nexts = sync_plans(part, incoming, run_ts, null_policy, reactivate)
    return _report(replace_folders(nexts, root, digits, hit, _hits()))


def deactivate_in_place(root: str, active: DataFrame, providers: DataFrame | None = None,
                        run_ts: Column | None = None, digits: int = 2) -> int:
    """Soft delete in a table kept in id-prefix folders: id, provider and state of all plans are
    read, and only folders that hold a plan to deactivate are written. Returns the number of
    plans."""
    spark = active.sparkSession
    gone = settle(missing_plans(read_folders(spark, root, digits=digits), active, providers))
    hit = prefixes_of(gone, digits)
    if not hit:
        return 0
    part = read_folders(spark, root, hit, digits)
    marked = part.join(gone.select("id", F.lit(True).alias("_gone")), "id", "left")
    changed = {"is_active": F.col("is_active") & F.col("_gone").isNull()}
    if "updated_at" in part.columns:
        now = F.current_timestamp() if run_ts is None else run_ts
        changed["updated_at"] = F.when(F.col("_gone"), now).otherwise(F.col("updated_at"))
    replace_folders(marked.withColumns(changed).select(*part.columns), root, digits, hit)
    return gone.count()


def sync_plans_log(plans: DataFrame, root: str, order: tuple[str, ...], run_ts: Column | None = None,
                   null_policy: str = "overwrite", reactivate: bool = False) -> dict[str, int]:
    """As above for a table kept as a log by provider: only new and changed plans are written. The stored side
    is scanned for the ids at hand, those being broadcast, and never shuffled or rewritten."""
    spark = plans.sparkSession
    incoming = settle(unique_plans(plans, order))
    part = align(read_ids(spark, root, incoming, incoming.count(), schemas.PLAN), schemas.PLAN)
    # what is stored now rides along, so that the table is scanned once and its rows meet the batch once
    part = part.withColumn("_was", F.col("is_active"))
    nexts = as_files(sync_plans(part, incoming, run_ts, null_policy, reactivate))
    counts = nexts.agg(*[v.alias(k) for k, v in _hits().items()]).first().asDict()
    taken = nexts.filter(F.col("sync_status").isin("new", "updated"))
    append_log(taken.select(*schemas.PLAN.names, changed_live(F.col("is_active"), F.col("_was"))), root, "provider_name")
    return _report(counts)


def deactivate_log(root: str, active: DataFrame, providers: Sequence[str], run_ts: Column | None = None,
                   min_active: int = 0) -> int:
    """Soft delete in a table kept as a log by provider: reads the files of the named providers, and writes the
    plans it deactivates. Returns their number."""
    spark = active.sparkSession
    if min_active > 0:
        providers = [r["provider_name"] for r in long_enough(active, list(providers), min_active).collect()]
    stored = read_log(spark, root, list(providers), schemas.PLAN)
    gone = settle(missing_plans(stored, active, list(providers)))
    n = gone.count()
    if n:
        now = F.current_timestamp() if run_ts is None else run_ts
        rows = read_ids(spark, root, gone, n, groups=list(providers)).withColumns(
            {"is_active": F.lit(False), "updated_at": now.cast("timestamp")})
        append_log(rows.select("*", changed_live(F.lit(False), F.lit(True))), root, "provider_name")
    return n


def active_in_log(spark: SparkSession, root: str) -> DataFrame:
    """Active plans of each provider, counted from the manifest without reading a row."""
    return spark.createDataFrame(sorted(live_counts(spark, root).items(), key=str), "provider_name string, plans long")


def _hits() -> dict[str, Column]:
    def hits(status: str) -> Column:
        return F.sum(F.when(F.col("sync_status") == status, 1).otherwise(0))

    return {"new": hits("new"), "updated": hits("updated"), "unchanged": hits("unchanged"),
            "errors": hits("conflict")}


def _report(counts: dict[str, int]) -> dict[str, int]:
    counts = {k: v or 0 for k, v in counts.items()}
    counts["processed"] = counts["new"] + counts["updated"] + counts["unchanged"]
    counts["success"] = counts["new"] + counts["updated"]
    return counts
