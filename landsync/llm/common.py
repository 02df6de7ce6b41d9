"""Helpers the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.session import shared_dir

#: The white space of the contracts: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows up to which a side that was counted may be broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again.

    Cuts the lineage at a place that outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: str, m: int) -> Column:
    """crc32 of the id as text, modulo m."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % m


def fold_case(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Runs of characters that are no white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it was counted and is within the bound,
    else as it is, so that the join shuffles. For stored tables of short rows."""
    return F.broadcast(df) if df.count() <= rows else df


def hashed_sample(df: DataFrame, of: int, rows: int, *columns: str) -> DataFrame:
    """About ``rows`` of the ``of`` rows, chosen by a hash of the columns: filtered where they
    lie, so that no task and no driver sees more."""
    scale = 1 << 30
    share = scale if of <= rows else -(-rows * scale // of)
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(scale)) < share)
