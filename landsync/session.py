"""Session factory and the few settings the jobs rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "landsync", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew-join handling on.

    Shuffle partition count is left to the cluster (adaptive execution merges
    small ones); pass ``**conf`` with dots written as ``__`` to override, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dir: str | None = None


def use_local_dir(path: str) -> None:
    """Name the shared folder of sessions that run in one process and set none, such as tests."""
    global _local_dir
    _local_dir = path.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if _local_dir and (master == "local" or master.startswith("local[")):
        return _local_dir
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def settle(df: DataFrame) -> DataFrame:
    """Compute a table once and go on from a reliable checkpoint in the shared
    folder, for results that are costly to get and used more than once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def as_files(df: DataFrame) -> DataFrame:
    """As ``settle`` for wide tables of which later steps read some columns or rows: Parquet files in the
    shared folder, which take a fraction of a checkpoint's bytes."""
    path = f"{shared_dir(df.sparkSession)}/stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
