"""Incremental runs with Structured Streaming.

Each job reads what landed since its last run and stops (``availableNow``), or
keeps running if given another trigger. The checkpoint holds the source
position and moves only after the batch has been written. A repeated batch
gives the same table, so a restart is safe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from landsync import schemas
from landsync.operators.dedup import keep_first
from landsync.operators.merge import (align, apply_results, fold_state, folded_of, merge_states,
                                      upsert)
from landsync.operators.stats import count_if
from landsync.plans.enrichment import apply_in_place, apply_log
from landsync.plans.facility_sync import facility_batch
from landsync.session import settle
from landsync.sources.log_table import (DELETED, FANOUT, NET, append_log, compact, read_all, read_ids)
from landsync.sources.store import (prefixes_of, read_folders, read_snapshot, replace_folders,
                                    write_snapshot)


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
           mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    return (stream.writeStream.outputMode(mode).foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _this_batch(spark: SparkSession, checkpoint: str, batch_id: int) -> tuple[str, int]:
    """The batch's name: the stream's id, which its checkpoint holds, and its number."""
    return spark.read.text(f"{checkpoint}/metadata").first()[0], batch_id


def landed(spark: SparkSession, path: str, schema, fmt: str = "parquet",
           files_per_batch: int | None = None) -> DataFrame:
    """A stream over files as they land."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_facilities(rows: DataFrame, root: str, checkpoint: str, load: str | None = None,
                      protect_enrichment: bool = False, in_place: bool = False,
                      digits: int = 2, trigger: dict | None = None) -> StreamingQuery:
    """Upsert facility rows (renamed, with ``seq``) into the stored table.

    Of rows with one id the latest ``load`` (a whole-number column; without it all rows
    are one load) counts, and in a load the first ``seq``. The table keeps both values,
    so files give the same table however they fall into batches. ``in_place`` is for a
    table in id-prefix folders; else every batch writes a version (see ``expire``).
    """
    fields = T.StructType([*schemas.FACILITY.fields, T.StructField("_load", T.LongType()),
                           T.StructField("_seq", T.LongType())])

    def each(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        number = F.col(load).cast("long") if load else F.lit(0).cast("long")
        # The first "seq" is kept: that of the latest load, and in it of the first row.
        place = F.struct((-number).alias("load"), F.col("seq").cast("long").alias("row"))
        records = settle(
            facility_batch(batch.withColumn("seq", place), protect_enrichment=protect_enrichment,
                           keep_seq=True)
            .withColumns({"_load": -F.col("seq.load"), "_seq": F.col("seq.row")}).drop("seq"))
        hit = prefixes_of(records, digits) if in_place else None
        stored = (read_folders(spark, root, hit, digits, fields) if in_place
                  else read_snapshot(spark, root, fields))
        stored = align(stored, fields)
        known = stored.select("id", F.col("_load").alias("_l"), F.col("_seq").alias("_s"))
        later = (F.col("_l").isNull() | (F.col("_load") > F.col("_l"))
                 | ((F.col("_load") == F.col("_l")) & (F.col("_seq") < F.col("_s"))))
        fresh = records.join(known, "id", "left").filter(later).drop("_l", "_s")
        out = upsert(stored, fresh)
        if in_place:
            replace_folders(out, root, digits, hit)
        else:
            write_snapshot(out, root)

    return _start(rows, each, checkpoint, trigger=trigger)


def stream_results(results: DataFrame, root: str, checkpoint: str,
                   seq: tuple[str, ...] = ("seq",), dedup: str | None = None,
                   in_place: bool = False, digits: int = 2, as_log: bool = False,
                   fanout: int = FANOUT, trigger: dict | None = None) -> StreamingQuery:
    """Apply lookup results to the stored facility table as they arrive.

    A state per facility, under ``root``, holds what decided each field, so results give
    the same table in any order and however late. With ``dedup`` (a result id) the ids seen
    are kept too, and a result counts once. Both are logs: a batch appends its own facilities and ids,
    and segments are merged level by level. The facility table is a log too with ``as_log``; ``in_place``
    is for a table in id-prefix folders; else every batch writes a version (see ``expire``).
    """
    state, seen = f"{root}/_state", f"{root}/_seen"

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ids, this = None, _this_batch(spark, checkpoint, batch_id)
        if dedup:
            first = keep_first(batch, [dedup], list(seq))
            keyed = settle(first.withColumn("_id", F.sha2(F.col(dedup).cast("string"), 256)))
            ids = keyed.select(F.col("_id").alias("id")).filter(F.col("id").isNotNull())
            old = read_ids(spark, seen, ids, ids.count(), ids.schema).withColumnRenamed("id", "_id")
            batch = keyed.join(old, "_id", "left_anti").drop("_id")
            ids = settle(ids.join(old.withColumnRenamed("_id", "id"), "id", "left_anti"))
        fresh = settle(fold_state(batch, seq))
        merged = settle(merge_states(read_ids(spark, state, fresh, fresh.count(), fresh.schema), fresh))
        folded = folded_of(merged)
        if as_log:
            apply_log(settle(folded), root)
        elif in_place:
            apply_in_place(folded, root, digits=digits)
        else:
            write_snapshot(apply_results(read_snapshot(spark, root), folded), root)
        # The table first: a batch that is repeated finds the state of before, or one that
        # already holds it, and either gives the same table.
        append_log(merged, state, batch=this)
        compact(spark, state, fanout)
        if ids is not None:
            append_log(ids, seen, batch=this)
            compact(spark, seen, fanout)

    return _start(results, each, checkpoint, trigger=trigger)


def hourly_counts(results: DataFrame, time: str = "ts") -> DataFrame:
    """Success and failure per hour."""
    good = F.coalesce(F.col("scrape_success"), F.lit(False))
    return (results.groupBy(F.window(time, "1 hour").alias("hour"))
            .agg(F.count(F.lit(1)).alias("total"), count_if(good).alias("success"),
                 count_if(~good).alias("failed"))
            .select(F.col("hour.start").alias("hour"), "total", "success", "failed"))


_COUNTED = ("total", "success", "failed")


def _added(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("hour").agg(*[F.sum(c).cast("long").alias(c) for c in _COUNTED])
    return sums.withColumns({DELETED: F.lit(False), NET: F.lit(1)})


def stream_counts(results: DataFrame, out: str, checkpoint: str, time: str = "ts",
                  fanout: int = FANOUT, trigger: dict | None = None) -> StreamingQuery:
    """Keep hourly counts under ``out``: every batch appends what it adds to each hour to a log, whose segments
    are summed level by level, so that any number of batches leaves few files. A batch that is repeated counts
    once, and no row is too late."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_log(hourly_counts(batch, time).select("hour", *_COUNTED), out,
                   batch=_this_batch(spark, checkpoint, batch_id))
        compact(spark, out, fanout, combine=_added)

    return _start(results, each, checkpoint, trigger=trigger)


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """The count of each hour over all batches."""
    return _added(read_all(spark, out)).select("hour", *_COUNTED)
