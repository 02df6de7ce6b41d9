"""Readers for landed pages, responses, replies and brochures.

All name their columns, so scans read nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landsync.operators.extract import provider_of
from landsync.operators.inference import join_page_texts, parse_replies
from landsync.operators.records import flatten_places


def read_pages(spark: SparkSession, path: str, providers: list[tuple] | None = None) -> DataFrame:
    """Crawled pages with the provider their host belongs to."""
    pages = spark.read.parquet(path).select("page_id", "url", "html")
    return pages.withColumn("provider_key", provider_of("url", providers))


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """Landed search and details responses (``clinic_id, search_json,
    details_json`` as JSON lines) as lookup columns."""
    raw = spark.read.schema("clinic_id string, search_json string, details_json string").json(path)
    return flatten_places(raw).drop("search_json", "details_json")


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """Landed model replies (``url, reply``) with typed fields."""
    return parse_replies(spark.read.parquet(path).select("url", "reply")).drop("reply")


def read_brochures(spark: SparkSession, path: str, separator: str = "\n\n") -> DataFrame:
    """Landed brochure pages (``brochure_url, page_no, text``), one text each."""
    pages = spark.read.parquet(path).select("brochure_url", "page_no", "text")
    return join_page_texts(pages, "brochure_url", separator=separator)


def read_since(spark: SparkSession, path: str, modified_after: str | None,
               fmt: str = "parquet", schema=None) -> DataFrame:
    """Only files modified after a time (``yyyy-MM-ddTHH:mm:ss``)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path)


