"""Kept tables as versioned Parquet snapshots, and row sinks.

A Parquet table cannot be replaced while it is read, so every write goes to a
new folder ``v=N``. A version counts once Spark has put ``_SUCCESS`` into it,
so a lost executor or a failed job leaves the old version in force.

Given a number of ``buckets``, a snapshot is clustered by ``id``: the join of the
next run then reads the stored side without a shuffle, and its result is written
as it lies. With as many buckets as shuffle partitions the input is shuffled once,
for its de-duplication.

For a large table with a small batch, keep the table in folders by a prefix of its
id: only folders the batch falls into are read and written. A manifest, itself a
versioned snapshot, tells which folder holds a prefix and how long prefixes are. New
folders are written beside the old ones and count once the next manifest does, so a
write that is cut off loses nothing, and old folders stay until they are expired.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = "id_prefix"


def _folder(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions below ``root``, oldest first."""
    path, fs = _folder(spark, root)
    if not fs.exists(path):
        return []
    jvm = spark.sparkContext._jvm
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(done):
            found.append(int(name[2:]))
    return sorted(found)


def _bucketed_table(root: str, number: int) -> str:
    return f"landsync_{hashlib.sha256(root.encode()).hexdigest()[:16]}_v{number}"


def _bucketed(spark: SparkSession, root: str, number: int, buckets: int) -> DataFrame:
    """A version as a table clustered by id; the session's catalog learns of it
    on first use."""
    name = _bucketed_table(root, number)
    if not spark.catalog.tableExists(name):
        path = f"{root}/v={number}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                            for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (id) "
                  f"SORTED BY (id) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read_snapshot(spark: SparkSession, root: str, schema=None,
                  buckets: int | None = None) -> DataFrame:
    """The newest complete version; an empty table of ``schema`` if there is none.
    ``buckets`` must be the number the version was written with."""
    have = versions(spark, root)
    if not have:
        if schema is None:
            raise FileNotFoundError(f"no complete version under {root}")
        return spark.createDataFrame([], schema)
    if buckets:
        return _bucketed(spark, root, have[-1], buckets)
    return spark.read.parquet(f"{root}/v={have[-1]}")


def write_snapshot(df: DataFrame, root: str, partition_by: list[str] | None = None,
                   observe: dict[str, Column] | None = None,
                   buckets: int | None = None) -> dict[str, int]:
    """Write the next version. ``observe`` names aggregates to take during the
    write, so statistics need no second pass."""
    spark = df.sparkSession
    have = versions(spark, root)
    number = have[-1] + 1 if have else 0
    path = f"{root}/v={number}"
    watch = None
    if observe:
        watch = Observation("snapshot")
        df = df.observe(watch, *[v.alias(k) for k, v in observe.items()])
    # A leftover of a failed attempt at this number is overwritten.
    if buckets:
        name = _bucketed_table(root, number)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        (df.write.mode("overwrite").bucketBy(buckets, "id").sortBy("id")
         .format("parquet").option("path", path).saveAsTable(name))
    elif partition_by:
        (_per_folder(df, partition_by).write.mode("overwrite")
         .partitionBy(*partition_by).parquet(path))
    else:
        df.write.mode("overwrite").parquet(path)
    return dict(watch.get) if watch else {}


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions; returns the deleted numbers."""
    old = versions(spark, root)[:-keep] if keep > 0 else []
    for number in old:
        spark.sql(f"DROP TABLE IF EXISTS {_bucketed_table(root, number)}")
        path, fs = _folder(spark, f"{root}/v={number}")
        fs.delete(path, True)
    return old


_MANIFEST = "prefix string, path string, digits int, columns string"


def with_prefix(df: DataFrame, digits: int = 2) -> DataFrame:
    """Add the partition column: the first hex digits of the id, evenly filled."""
    return df.withColumn(PREFIX, F.substring("id", 1, digits))


def _manifest(spark: SparkSession, root: str, digits: int | None) -> tuple[dict[str, str], str | None]:
    """Folder by prefix, at most 16 to the power of the digits, and the columns."""
    rows = read_snapshot(spark, f"{root}/manifest", _MANIFEST).collect()
    for row in rows:
        if digits is not None and row["digits"] != digits:
            raise ValueError(f"{root} is kept by {row['digits']} digits of the id, not {digits}")
    return ({r["prefix"]: r["path"] for r in rows if r["path"]},
            next((r["columns"] for r in rows if r["columns"]), None))


def prefixes_of(batch: DataFrame, digits: int = 2) -> list[str]:
    """The prefixes that a batch falls into; ids are hex, which bounds their number."""
    most = 16 ** digits
    found = batch.select(F.substring("id", 1, digits).alias("p")).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError("ids must begin with hex digits")
    return sorted(r["p"] for r in found if r["p"] is not None)


def read_folders(spark: SparkSession, root: str, prefixes: Sequence[str] | None = None,
                 digits: int | None = None, schema=None) -> DataFrame:
    """A table in folders, or the part of it in some prefixes; an empty table of ``schema``
    where nothing is stored."""
    have, columns = _manifest(spark, root, digits)
    paths = [have[p] for p in (sorted(have) if prefixes is None else prefixes) if p in have]
    if columns is None and schema is None:
        raise FileNotFoundError(f"no table in folders under {root}")
    kind = T.StructType.fromJson(json.loads(columns)) if columns else schema
    if not paths:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(*[f"{root}/{p}" for p in paths])


def replace_folders(df: DataFrame, root: str, digits: int = 2, prefixes: Sequence[str] = (),
                    observe: dict[str, Column] | None = None) -> dict[str, int]:
    """Put ``df`` in place of the folders it falls into, and of those in ``prefixes``.

    ``df`` may read from the table. Readers see all of the old folders or all of the new ones.
    """
    spark = df.sparkSession
    have, _ = _manifest(spark, root, digits)
    run, watch = f"data/u={uuid.uuid4().hex}", None
    columns = json.dumps(df.schema.jsonValue())
    if observe:
        watch = Observation("folders")
        df = df.observe(watch, *[v.alias(k) for k, v in observe.items()])
    (_per_folder(with_prefix(df, digits), [PREFIX]).write.partitionBy(PREFIX).parquet(f"{root}/{run}"))
    path, fs = _folder(spark, f"{root}/{run}")
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
    fresh = {n.split("=", 1)[1]: f"{run}/{n}" for n in names if n.startswith(f"{PREFIX}=")}
    kept = {p: f for p, f in have.items() if p not in set(prefixes)} | fresh
    rows = [(None, None, digits, columns), *((p, f, digits, None) for p, f in sorted(kept.items()))]
    write_snapshot(spark.createDataFrame(rows, _MANIFEST).coalesce(1), f"{root}/manifest")
    return dict(watch.get) if watch else {}


def expire_folders(spark: SparkSession, root: str) -> int:
    """Delete folders and manifests that the newest manifest does not need; returns the number of
    folders deleted. Not while another job reads or writes the table."""
    have, _ = _manifest(spark, root, None)
    path, fs = _folder(spark, f"{root}/data")
    gone, used = 0, set(have.values())
    for run in fs.listStatus(path):
        for part in fs.listStatus(run.getPath()):
            name = f"data/{run.getPath().getName()}/{part.getPath().getName()}"
            if part.isDirectory() and name not in used:
                gone += fs.delete(part.getPath(), True)
    expire(spark, f"{root}/manifest", 1)
    return gone


def _per_folder(df: DataFrame, columns: list[str]) -> DataFrame:
    """Gather the rows of a folder, so that tasks do not each write a small file
    into every folder; adaptive execution splits folders that are too large for
    one task."""
    return df.hint("rebalance", *columns)


def write_batches(df: DataFrame, url: str, table: str, batch_size: int = 500,
                  properties: dict[str, str] | None = None) -> None:
    """Append rows to a database table in batches; upserting from there is the
    database's own MERGE. Needs a JDBC driver on the class path."""
    writer = (df.write.format("jdbc").mode("append").option("url", url)
              .option("dbtable", table).option("batchsize", batch_size))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()
