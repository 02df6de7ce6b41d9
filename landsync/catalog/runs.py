"""Queries that write: stores, committed state and streams.

Each run writes to a new folder under the shared folder and returns what it
reads back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsync import rules, schemas
from landsync.catalog import facility, plan, web
from landsync.catalog.registry import ORACLES, query, run_time, sql_id, table
from landsync.operators.filters import active_plans
from landsync.operators.merge import align
from landsync.operators.records import rename_sheet
from landsync.plans.facility_sync import sync_facilities, sync_facilities_log
from landsync.plans.plan_sync import active_in_log, deactivate_log, sync_plans_log, sync_stored_plans
from landsync.session import shared_dir
from landsync.sources import log_table as log
from landsync.sources import sheet as sheets
from landsync.sources import state as S
from landsync.sources.store import read_snapshot, write_snapshot
from landsync.streaming import jobs


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/runs/{name}-{uuid.uuid4().hex}"


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table as a stream, be it one file or a folder of files."""
    schema = table(spark, sf, name).schema
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(f"{sf}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf)


_FACILITIES = f"""
SELECT id, name, is_24_hours FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn
  FROM (SELECT {sql_id('name', 'address')} AS id, seq, name,
          facility_type = 'ECONOMY' AS is_24_hours FROM ({facility.SHEET}))) WHERE rn = 1"""


@query(_FACILITIES)
def snk1_facility_store(spark: SparkSession, sf: str) -> DataFrame:
    """The facility load written to a new store, twice: the second run changes nothing."""
    root = new_dir(spark, "facility")
    for _ in range(2):
        sync_facilities(facility.sheet(spark, sf), root, run_time())
    return read_snapshot(spark, root).select("id", "name", "is_24_hours")


@query(f"""SELECT CASE WHEN n.id IS NULL THEN 'kept' ELSE d.status END AS sync_status,
  count(*) AS plans
FROM ({plan.STORED}) o FULL JOIN ({plan.INCOMING}) n ON n.id = o.id
LEFT JOIN ({plan.DIFF}) d ON d.id = n.id GROUP BY ALL""")
def snk2_plan_store(spark: SparkSession, sf: str) -> DataFrame:
    """The stored plans as version 0, then a sync into version 1."""
    root = new_dir(spark, "plan")
    write_snapshot(plan.stored(spark, sf), root)
    sync_stored_plans(plan.incoming(spark, sf), root, ("seq",), run_time())
    return (read_snapshot(spark, root).groupBy("sync_status")
            .agg(F.count(F.lit(1)).alias("plans")))


@query(ORACLES["ext1_rule_table"])
def ext1_rule_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Headings, body names and links by rules that are rows of a stored table."""
    root = new_dir(spark, "rules")
    rules.rule_rows(spark, rules.RuleTable(headings=web._EXT_HEADINGS, body_names=web._EXT_BODY,
                                           detail_links=web._EXT_LINKS)).write.parquet(root)
    return web.by_rules(spark, sf, rules.read_rules(spark.read.parquet(root)))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS bil, c_name AS nama_penuh_fasiliti,
  'Lot ' || c_nationkey || chr(10) || '"' || c_mktsegment || '", Road' AS alamat,
  c_mktsegment AS jenis_fasiliti FROM customer WHERE c_acctbal >= 0""")
def src1_sheet_files(spark: SparkSession, sf: str) -> DataFrame:
    """Customers exported as one sheet a segment, with quotes and line breaks in cells, title, header, blank rows
    and rows without a name, read back by the reader of sheets."""
    c, root = table(spark, sf, "customer"), new_dir(spark, "sheets")
    cell = lambda v: F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
    address = F.concat(F.lit("Lot "), F.col("c_nationkey").cast("string"), F.lit('\n"'), "c_mktsegment", F.lit('", Road'))
    row = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment", cell(address),
                      F.when(F.col("c_acctbal") >= 0, cell(F.concat(F.lit(" "), "c_name"))).otherwise(""))
    rows = c.select("c_mktsegment", F.col("c_custkey").alias("place"), row.alias("value"))
    top = c.select("c_mktsegment").distinct().select("c_mktsegment", F.posexplode(F.array(
        F.lit('"A sheet,\nupdated",,,'), F.lit(" bil ,Jenis_Fasiliti,ALAMAT,NAMA_PENUH_FASILITI"), F.lit(",,,"))).alias("place", "value"))
    top = top.withColumn("place", F.col("place").cast("long") - 10)
    (top.unionByName(rows).repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "place")
     .select("c_mktsegment", "value").write.partitionBy("c_mktsegment").text(root))
    files = [r[0] for r in spark.read.text(root).select("_metadata.file_path").distinct().orderBy("file_path").collect()]
    return sheets.read_sheets(spark, files).select("bil", "nama_penuh_fasiliti", "alamat", "jenis_fasiliti")


@query(_FACILITIES)
def snk1_facility_log(spark: SparkSession, sf: str) -> DataFrame:
    """The facility load into a table kept as a log, whole and then every fifth row again."""
    root, sheet = new_dir(spark, "facility-log"), facility.sheet(spark, sf)
    for part in (sheet, sheet.where(F.col("seq") % 5 == 0)):
        sync_facilities_log(part, root, run_time())
    return log.read_log(spark, root).select("id", "name", "is_24_hours")


def plan_log(spark: SparkSession, sf: str) -> str:
    """The stored plans as the first segment of a log by provider."""
    root = new_dir(spark, "plan-log")
    rows = align(plan.stored(spark, sf), schemas.PLAN)
    log.append_log(rows.select("*", log.changed_live(F.col("is_active"), F.lit(False))), root, "provider_name")
    return root


def synced_log(spark: SparkSession, sf: str) -> str:
    """Today's plans synced on top in three batches."""
    root = plan_log(spark, sf)
    for k in range(3):
        sync_plans_log(plan.incoming(spark, sf).where(F.col("seq") % 3 == k), root, ("seq",), run_time())
    return root


@query(f"""SELECT coalesce(o.id, n.id) AS id,
  CASE WHEN d.status IN ('new', 'updated') THEN n.annual_limit ELSE o.annual_limit END AS annual_limit,
  array_to_string(CASE WHEN d.status IN ('new', 'updated') THEN n.covered_conditions
    ELSE o.covered_conditions END, '|') AS covered, o.claim_process AS claim_process,
  CASE WHEN d.status IN ('new', 'updated') THEN 2026 ELSE 2020 END AS updated_year
FROM ({plan.STORED}) o FULL JOIN ({plan.INCOMING}) n ON n.id = o.id LEFT JOIN ({plan.DIFF}) d ON d.id = n.id""")
def snk2_plan_log(spark: SparkSession, sf: str) -> DataFrame:
    """A first segment and three segments of changed plans, merged into one."""
    root = synced_log(spark, sf)
    log.compact(spark, root, fanout=4)
    return log.read_log(spark, root).select(
        "id", "annual_limit", F.array_join("covered_conditions", "|").alias("covered"), "claim_process",
        F.year("updated_at").alias("updated_year"))


@query(f"""SELECT s.id, s.is_active AND g.id IS NULL AS is_active,
  CASE WHEN g.id IS NOT NULL THEN 2026 ELSE 2020 END AS updated_year
FROM ({plan.STORED}) s LEFT JOIN ({plan.GONE}) g ON s.id = g.id""")
def ant1_deactivate_log(spark: SparkSession, sf: str) -> DataFrame:
    """The soft delete as a segment of its own."""
    root = plan_log(spark, sf)
    called = [r["provider_name"] for r in plan.called(spark, sf).collect()]
    deactivate_log(root, plan.listed(spark, sf), called, run_time())
    return log.read_log(spark, root).select("id", "is_active", F.year("updated_at").alias("updated_year"))


@query(f"""SELECT id, annual_limit FROM ({plan.STORED}) WHERE is_active AND provider_name = '1-URGENT'""")
def src6_provider_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Active plans of one provider: only the provider's files are listed."""
    root = plan_log(spark, sf)
    return active_plans(log.read_log(spark, root, ["1-URGENT"]), "1-URGENT").select("id", "annual_limit")


@query(f"""SELECT s.provider_name, count(*) FILTER (WHERE s.is_active AND g.id IS NULL) AS plans
FROM ({plan.STORED}) s LEFT JOIN ({plan.GONE}) g ON s.id = g.id GROUP BY ALL""")
def agg6_manifest_count(spark: SparkSession, sf: str) -> DataFrame:
    """Active plans of each provider after a soft delete, counted from the manifest."""
    root = plan_log(spark, sf)
    called = [r["provider_name"] for r in plan.called(spark, sf).collect()]
    deactivate_log(root, plan.listed(spark, sf), called, run_time())
    return active_in_log(spark, root)


@query(f"""SELECT coalesce(s.source_id, t.source_id) AS source_id,
  strftime(coalesce(greatest(modified_time, last_modified), modified_time, last_modified),
    '%Y-%m-%dT%H:%M:%S') AS last_modified
FROM ({plan.SOURCES}) s FULL JOIN ({plan.STATE}) t ON s.source_id = t.source_id
WHERE coalesce(modified_time, last_modified) IS NOT NULL""")
def src8_commit_state(spark: SparkSession, sf: str) -> DataFrame:
    """Source times committed after a run and read back."""
    root = new_dir(spark, "state")
    write_snapshot(plan.state(spark, sf), root)
    S.commit_state(S.changed_sources(plan.sources(spark, sf), S.read_state(spark, root)), root)
    return S.read_state(spark, root).select(
        "source_id", F.substring("last_modified", 1, 19).alias("last_modified"))


@query(_FACILITIES)
def str1_stream_facilities(spark: SparkSession, sf: str) -> DataFrame:
    """The facility load as a stream into a new store."""
    root = new_dir(spark, "facility-stream")
    rows = rename_sheet(facility.sheet_of(stream_of(spark, sf, "part")))
    jobs.stream_facilities(rows, root, f"{root}/checkpoint").awaitTermination()
    return read_snapshot(spark, root).select("id", "name", "is_24_hours")


@query(f"""
SELECT f.id, CASE WHEN r.clinic_id IS NOT NULL THEN r.latitude ELSE f.latitude END AS latitude,
  coalesce(r.phone, f.phone) AS phone, r.website AS website, r.google_rating AS google_rating
FROM ({facility.STORED}) f LEFT JOIN ({facility.FOLDED}) r ON f.id = r.clinic_id""")
def str2_stream_results(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup results as a stream onto a stored table, replays dropped."""
    root = new_dir(spark, "enrichment-stream")
    write_snapshot(facility.stored(spark, sf), root)
    results = facility.results_of(stream_of(spark, sf, "events"))
    jobs.stream_results(results, root, f"{root}/checkpoint", dedup="seq").awaitTermination()
    return read_snapshot(spark, root).select("id", "latitude", "phone", "website", "google_rating")


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS total,
  count(*) FILTER (WHERE event_type <> 'error') AS success,
  count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1""")
def str3_hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = new_dir(spark, "counts-stream")
    results = facility.results_of(stream_of(spark, sf, "events"))
    jobs.stream_counts(results, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return jobs.read_counts(spark, f"{out}/data").select(
        F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "total", "success", "failed")
