"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the
last return the columns of ``docs``. What a stage returns is written as Parquet and
read again as the next one's ``docs``.

Cases: tables may be empty and columns null (each operator's module says what follows).
Documents are known by doc_id: rows that repeat an id stay or go together, and a row
without an id is never dropped as a copy of another or as a leak. Extra columns are
carried along; those named like a column that an operator adds (lang_pred, lang_score,
lang_accepted, kept, n_bytes, n_removed, n_spans) are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync.llm import decontaminate, language, packing, simhash, substring
from landsync.llm.common import settled, small, table


def _without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``docs`` but those with an id in the list; the list is stored, and broadcast only if it is small."""
    return docs.join(small(settled(ids.select("doc_id").distinct(), name)), "doc_id", "left_anti").select(docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin. The dictionaries come from the labelled ones."""
    judged = language.identify(docs, language.language_dictionaries(docs))
    return judged.where(F.col("lang_accepted")).drop("lang_pred", "lang_score", "lang_accepted")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link them, the one with the smallest id."""
    found = settled(simhash.near_duplicates(docs), "near-duplicates")
    return _without(docs, found.where("doc_id <> component_id"), "copies")


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stands in a document with a smaller id; whole characters only."""
    swept = substring.sweep(docs, whole_characters=True)
    out = swept.withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(dict(docs.dtypes)["n_chars"]))
    return out.drop("kept", "n_bytes", "n_removed", "n_spans")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found, "leaks")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", no_repeated_passages),
    ("benchmark", no_benchmark),
    ("packing", packed),
]

#: No SQL can express compression, suffix sorting or tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
