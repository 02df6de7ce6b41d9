"""Daily facility load: sheet rows to the next facility table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsync import schemas
from landsync.operators.dedup import unique_facilities
from landsync.operators.merge import align, upsert
from landsync.operators.records import facility_records, rename_sheet
from landsync.session import settle
from landsync.sources.log_table import append_log, changed_live, read_ids
from landsync.sources.store import (prefixes_of, read_folders, read_snapshot, replace_folders,
                                    write_snapshot)


def facility_batch(rows: DataFrame, run_ts: Column | None = None,
                   protect_enrichment: bool = False, keep_seq: bool = False) -> DataFrame:
    """Renamed rows (with ``seq``) to unique facility records. Rows that cannot have
    an id go first, which spares computing the id twice."""
    whole = rows.filter(F.col("name").isNotNull() & F.col("address").isNotNull())
    records = unique_facilities(facility_records(whole, run_ts, protect_enrichment))
    return records if keep_seq else records.drop("seq")


def sync_facilities(sheet: DataFrame, root: str, run_ts: Column | None = None,
                    protect_enrichment: bool = False,
                    buckets: int | None = None) -> dict[str, int]:
    """Upsert a raw sheet into the stored facility table; returns the counts
    ``rows`` and ``pending`` of the new version. See the store for ``buckets``."""
    spark = sheet.sparkSession
    batch = facility_batch(rename_sheet(sheet), run_ts, protect_enrichment)
    stored = align(read_snapshot(spark, root, schemas.FACILITY, buckets), schemas.FACILITY)
    waiting = F.col("latitude").isNull() & F.col("is_active")
    return write_snapshot(upsert(stored, batch), root, buckets=buckets, observe={
        "rows": F.count(F.lit(1)),
        "pending": F.sum(F.when(waiting, 1).otherwise(0)),
    })


def sync_facilities_in_place(sheet: DataFrame, root: str, run_ts: Column | None = None,
                             protect_enrichment: bool = False, digits: int = 2) -> None:
    """As above for a table kept in id-prefix folders: reads and writes only the
    folders the batch falls into. For small batches into a large table."""
    spark = sheet.sparkSession
    # Stored once: it tells the folders, and is then written into them.
    batch = settle(facility_batch(rename_sheet(sheet), run_ts, protect_enrichment))
    hit = prefixes_of(batch, digits)
    part = align(read_folders(spark, root, hit, digits, schemas.FACILITY), schemas.FACILITY)
    replace_folders(upsert(part, batch), root, digits, hit)


def sync_facilities_log(sheet: DataFrame, root: str, run_ts: Column | None = None,
                        protect_enrichment: bool = False) -> int:
    """As above for a table kept as a log: writes the batch's rows and nothing else. Returns their number."""
    spark = sheet.sparkSession
    batch = settle(facility_batch(rename_sheet(sheet), run_ts, protect_enrichment))
    part = align(read_ids(spark, root, batch, batch.count(), schemas.FACILITY), schemas.FACILITY)
    rows = upsert(part.withColumn("_was", F.col("is_active")), batch)
    return append_log(rows.select(*schemas.FACILITY.names, changed_live(F.col("is_active"), F.col("_was"))), root)
