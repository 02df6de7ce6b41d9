"""Physical plans: what is pushed down, what is shuffled and what never appears."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from landsync.catalog import facility, plan
from landsync.operators import dedup, extract, filters, merge, records
from landsync.plans import plan_detail, plan_listing
from landsync import rules

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
RUNS = ("snk1", "snk2", "src8", "str")  # these write; their plan is only the read-back


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith(RUNS)))
def test_no_python_and_no_cross_join(spark, name):
    got = text(entry.queries()[name](spark, SF))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "MapInPandas"):
        assert word not in got


def test_active_scan_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "plans")
    plan.stored(spark, SF).write.partitionBy("provider_name").parquet(path)
    got = text(filters.active_plans(spark.read.parquet(path), "2-HIGH").select("id"))
    assert "EqualTo(is_active,true)" in got
    assert re.search(r"PartitionFilters: \[[^\]]*provider_name", got)
    assert "ReadSchema: struct<id:string,is_active:boolean>" in got


def test_pending_scan_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "facilities")
    facility.stored(spark, SF).write.parquet(path)
    got = text(filters.pending(spark.read.parquet(path)).select("id"))
    assert "IsNull(latitude)" in got and "EqualTo(is_active,true)" in got


def test_keep_first_cuts_before_the_shuffle(spark):
    df = spark.range(10).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("id"))
    got = text(dedup.unique_facilities(df))
    assert re.search(r"Exchange hashpartitioning.*?WindowGroupLimit.*?Partial", got, re.S)


def test_sync_shuffles_each_side_once(spark):
    """The join reuses the partitioning of the de-duplication."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        incoming = dedup.unique_plans(plan.incoming(spark, SF))
        got = text(merge.sync_plans(plan.stored(spark, SF), incoming))
        assert got.count("Exchange hashpartitioning") == 2
        batch = dedup.unique_facilities(
            records.facility_records(records.rename_sheet(facility.sheet(spark, SF))))
        got = text(merge.upsert(facility.stored(spark, SF), batch.drop("seq")))
        assert got.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_provider_dimension_is_broadcast(spark):
    raw = spark.createDataFrame([("AIA", "AIA Med Plan")], "provider_key string, plan_name string")
    built_in = rules.provider_table(spark)
    assert "BroadcastHashJoin" in text(records.plan_records(raw, built_in))


def shuffled_columns(spark, df):
    """Names of all columns that pass an exchange."""
    shown = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\) (?:Broadcast)?Exchange\s*\nInput \[\d+\]: \[(.*?)\]", shown)
    assert inputs
    return {c.split("#")[0].strip() for line in inputs for c in line.split(",")}


def test_no_html_in_a_shuffle(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select(
        "url", "html", F.lit("AIA").alias("provider_key"), F.lit(1).alias("link_rank"))
    providers = rules.provider_table(spark)
    links = dedup.first_links(extract.product_links(pages), rules.DETAIL_LINK_CAPS)
    assert "html" not in shuffled_columns(spark, links)
    assert "html" not in shuffled_columns(spark, extract.landed_products(links, pages))
    fast = plan_listing.listing_plans(pages, pages, providers)
    assert "html" not in shuffled_columns(spark, fast)
    named = plan_detail.named_pages(pages)
    assert "Exchange" not in text(named)
    replies = spark.createDataFrame([], "url string, reply string")
    assert "html" not in shuffled_columns(spark, plan_detail.accepted_pages(named, replies))
